"""Random and smoke samples, and the materialisation of splits."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.operators.cascade import Rule, prune
from pairloom.operators.keys import positions, saved, seeded
from pairloom.schema import FOREIGN, Database


def random_split(ids: DataFrame, fractions, seed: str) -> DataFrame:
    """(id, split): shuffled by seed, int(total * fraction) each, the last takes the rest."""
    total = ids.count()
    ranked = positions(ids.select("id", seeded(seed, "id").alias("_o")), "_o", "id", name="_r")
    label, upto = F.lit(fractions[-1][0]), []
    at = 0
    for name, f in fractions[:-1]:
        at += int(total * f)
        upto.append((name, at))
    for name, at in reversed(upto):
        label = F.when(F.col("_r") < at, name).otherwise(label)
    return ranked.select("id", label.alias("split"))


def smoke_sample(edges: DataFrame, n: int, seed: str) -> DataFrame:
    """n div 2 edges of each label, by the seed's order; a top-k for each label, taken before the rank is."""
    half = n // 2
    own = lambda neg: edges.filter(F.col("negative") == neg).orderBy(seeded(seed, "id"), "id").limit(half)
    return own(False).union(own(True))


#: What a split keeps: mapped domains at the ends of its interactions, and proteins that its map names.
RULES = (Rule("domain", ((("ddi", "domain_id_a"), ("ddi", "domain_id_b")), (("domain_protein_map", "domain_id"),))), Rule("protein", ((("domain_protein_map", "protein_id"),),)))
_SMOKE = (Rule("domain", ((("ddi", "domain_id_a"), ("ddi", "domain_id_b")),)),)


def materialize(edges: DataFrame, mapped: DataFrame, keep: DataFrame) -> dict[str, DataFrame]:
    """For all splits at once, from edges (id, a, b), mapped (domain, protein) and keep (id, split).

    Edges are those kept whose two ends are mapped; domains are the mapped ends of kept
    edges, even if all their edges go, as the pruning runs once; proteins are those
    mapped from the domains.
    """
    first = saved(edges.join(keep, "id"))
    domains = first.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    tables = {"edges": first, "mapped": mapped.select("domain", "protein"), "domains": domains}
    keys = (("edges", "a", "domains"), ("edges", "b", "domains"), ("mapped", "domain", "domains"))
    out = prune(tables, keys, (Rule("domains", ((("edges", "a"), ("edges", "b")), (("mapped", "domain"),))),), ("split",))
    return {"edges": out["edges"], "domains": out["domains"].select("split", F.col("id").alias("domain")), "mapped": out["mapped"], "proteins": out["mapped"].select("split", "protein").distinct()}


def split_database(db: Database, keep: DataFrame) -> dict[str, DataFrame]:
    """Every table with a split column; write each partitioned by it."""
    return prune(db.tables() | {"ddi": saved(db.ddi.join(keep, "id"))}, FOREIGN, RULES, ("split",))


def smoke_filter(db: Database, n: int, seed: str) -> Database:
    """The smoke sample of interactions and the domains that they name."""
    return db.with_(**prune(db.tables() | {"ddi": saved(smoke_sample(db.ddi, n, seed))}, FOREIGN, _SMOKE))
