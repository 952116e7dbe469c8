"""Dataset bias: moments, KS test, Gini coefficient, ratios, hubs and histograms."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pairloom.operators.graph import degrees
from pairloom.operators.keys import saved


def moments(deg: DataFrame) -> DataFrame:
    """Nodes, mean and median degree of both classes, over the nodes that the class has; 0 for none."""
    out = []
    for c in ("pos", "neg"):
        own = F.when(F.col(c) > 0, F.col(c))
        out += [F.count(own).alias(f"n_{c}"), F.coalesce(F.avg(own), F.lit(0.0)).alias(f"{c}_mean"), F.coalesce(F.median(own), F.lit(0.0)).alias(f"{c}_median")]
    return deg.agg(*out)


def kolmogorov_p(d: Column, n_a: Column, n_b: Column) -> Column:
    """Two-sided p value of the KS statistic by the asymptotic series of 100 terms."""
    root = F.sqrt(n_a * n_b / (n_a + n_b))
    lam = (root + 0.12 + 0.11 / root) * d
    term = lambda acc, k: acc + F.when(k % 2 == 1, 1.0).otherwise(-1.0) * F.exp(-2.0 * k * k * lam * lam)
    series = F.aggregate(F.sequence(F.lit(1), F.lit(100)), F.lit(0.0), term)
    return F.when(lam < 1e-10, 1.0).otherwise(F.greatest(F.lit(0.0), F.least(F.lit(1.0), 2 * series)))


def ks_test(deg: DataFrame) -> DataFrame:
    """(ks_statistic, ks_p_value) of the two degree samples; (0, 1) if either has at most one value.

    The window runs over distinct degrees, of which there are few.
    """
    counts = deg.select(F.explode(F.array(F.struct(F.col("pos").alias("v"), F.lit(1).alias("p")), F.struct(F.col("neg").alias("v"), F.lit(0).alias("p")))).alias("x")).select("x.*").filter("v > 0")
    counts = counts.groupBy("v").agg(F.sum("p").alias("p"), F.sum(1 - F.col("p")).alias("n"))
    upto, every = Window.orderBy("v").rowsBetween(Window.unboundedPreceding, 0), Window.orderBy("v").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    cdf = counts.select(*[F.sum(c).over(w).cast("double").alias(f"{c}{i}") for c in "pn" for i, w in enumerate((upto, every))])
    d = cdf.agg(F.max(F.abs(F.col("p0") / F.when(F.col("p1") > 0, F.col("p1")) - F.col("n0") / F.when(F.col("n1") > 0, F.col("n1")))).alias("d"), F.max("p1").alias("p1"), F.max("n1").alias("n1"))
    enough = (F.col("p1") > 1) & (F.col("n1") > 1)
    return d.select(F.when(enough, F.col("d")).otherwise(0.0).alias("ks_statistic"), F.when(enough, kolmogorov_p(F.col("d"), F.col("p1"), F.col("n1"))).otherwise(1.0).alias("ks_p_value"))


def gini(deg: DataFrame, value: Column) -> DataFrame:
    """Gini coefficient of value over all rows; 0 if there are none or all are 0.

    Equal values share their ranks' sum, so the window runs over distinct values.
    """
    counts = deg.select(value.cast("double").alias("x")).groupBy("x").agg(F.count("*").cast("double").alias("c"))
    before = F.coalesce(F.sum("c").over(Window.orderBy("x").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    ranks = counts.withColumn("r", F.col("c") * before + F.col("c") * (F.col("c") + 1) / 2)
    sums = ranks.agg(F.sum("c").alias("n"), F.sum(F.col("c") * F.col("x")).alias("s"), F.sum(F.col("x") * F.col("r")).alias("w"))
    return sums.select(F.when(F.col("s") > 0, (2 * F.col("w") - (F.col("n") + 1) * F.col("s")) / (F.col("n") * F.col("s"))).otherwise(0.0).alias("gini"))


def ratios(deg: DataFrame) -> DataFrame:
    return deg.withColumn("ratio", F.col("pos") / (F.col("pos") + F.col("neg")))


def pure_fractions(deg: DataFrame) -> DataFrame:
    """Counts and fractions of nodes with one label alone, ratio mean and median, and a warning above one half."""
    n = F.greatest(F.lit(1), F.count("*"))
    out = ratios(deg).agg(
        F.count("*").alias("n_total"), F.count_if(F.col("ratio") == 1.0).alias("n_pure_positive"), F.count_if(F.col("ratio") == 0.0).alias("n_pure_negative"), (F.count_if(F.col("ratio") == 1.0) / n).alias("frac_pure_positive"),
        (F.count_if(F.col("ratio") == 0.0) / n).alias("frac_pure_negative"), F.coalesce(F.avg("ratio"), F.lit(0.0)).alias("mean_ratio"), F.coalesce(F.median("ratio"), F.lit(0.0)).alias("median_ratio"),
    )
    return out.withColumn("warning", F.col("frac_pure_positive") + F.col("frac_pure_negative") > 0.5)


def hubs(deg: DataFrame, names: DataFrame, k: int = 20) -> DataFrame:
    """The k nodes of the largest degree, by id among equals, with their names or "?"."""
    top = deg.withColumn("total", F.col("pos") + F.col("neg")).orderBy(F.desc("total"), "node").limit(k)
    return top.join(names.select(F.col("id").alias("node"), "pfam_id"), "node", "left").select("node", F.coalesce("pfam_id", F.lit("?")).alias("pfam_id"), "pos", "neg", "total")


def log_histogram(deg: DataFrame, bins: int = 29) -> DataFrame:
    """(bin, pos, neg) over log-spaced edges from 1 to the largest degree + 1, shared by both classes; the last bin is closed."""
    top = deg.agg(F.max(F.greatest("pos", "neg"))).first()[0]
    if not top:
        return deg.sparkSession.createDataFrame([], "bin int, pos long, neg long")
    edges = [10 ** (i * math.log10(top + 1) / bins) for i in range(bins + 1)]
    place = lambda c: F.least(F.size(F.filter(F.lit(edges), lambda e: e <= c)) - 1, F.lit(bins - 1))
    both = deg.select(F.explode(F.array(*[F.struct(F.col(c).alias("v"), F.lit(c == "pos").alias("p")) for c in ("pos", "neg")])).alias("x")).select("x.*").filter("v > 0")
    return both.groupBy(place(F.col("v")).alias("bin")).agg(F.count_if("p").alias("pos"), F.count_if(~F.col("p")).alias("neg"))


def ratio_histogram(deg: DataFrame, bins: int = 20) -> DataFrame:
    return ratios(deg).groupBy(F.least(F.floor(F.col("ratio") * bins), F.lit(bins - 1)).cast("int").alias("bin")).agg(F.count("*").alias("n"))


def summary(deg: DataFrame) -> DataFrame:
    """Edges of both labels and their ratio; each edge has two ends."""
    p, n = (F.expr(f"coalesce(sum({c}), 0) div 2") for c in ("pos", "neg"))
    return deg.agg(p.alias("n_positive"), n.alias("n_negative"), (p / F.greatest(F.lit(1), n)).alias("ratio"))


def bias_report(edges: DataFrame, names: DataFrame) -> DataFrame:
    """One row with all metrics; its joins are of one row each.  The degrees are written once, and every metric comes from them."""
    deg = saved(degrees(edges))
    out = moments(deg)
    for part in (ks_test(deg), pure_fractions(deg), gini(deg, F.col("pos") + F.col("neg")), summary(deg), hubs(deg, names).agg(F.array_sort(F.collect_list(F.struct((-F.col("total")).alias("k"), "node", "pfam_id", "pos", "neg"))).alias("top"))):
        out = out.crossJoin(F.broadcast(part))
    return out


