"""Line dedup by site-relative frequency, in DataFrame functions alone.

A line's share is the number of its site's pages that contain it over all pages of the
site; lines with a share above RATIO, on MIN_PAGES pages at least, are boilerplate and go
from all pages of the site.  Pages of one text count as one, so that no text makes its own lines
boilerplate by being copied.  A site has at most (mean lines of a page) / RATIO such lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.llm.shared import settled, stored

#: Greatest share of a site's pages that an ordinary line has, and fewest pages of boilerplate.
RATIO = 0.02
MIN_PAGES = 4
#: Bytes of boilerplate hashes up to which they are broadcast; salts of a site beyond.
BROADCAST_BYTES = 8 << 20
SALTS = 32


def site_of(host: Column) -> Column:
    """The host of a URL or of a bare name, in lower case; an empty one for null."""
    return F.coalesce(F.lower(F.regexp_extract(host, r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*://)?([^/?#]*)", 1)), F.lit(""))


def _name(line: Column) -> Column:
    """128 bits of a line."""
    return F.struct(F.xxhash64(line, F.lit(1)).alias("a"), F.xxhash64(line, F.lit(2)).alias("b"))


def boilerplate(docs: DataFrame, ratio: float, min_pages: int, host_col: str, text_col: str) -> DataFrame:
    """(site, lines): names of each site's boilerplate lines."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    pages = docs.select(site_of(F.col(host_col)).alias("site"), F.xxhash64(text).alias("page"), F.split(text, "\n").alias("lines"))
    totals = pages.groupBy("site").agg(F.count_distinct("page").alias("pages"))
    lines = pages.select("site", "page", F.explode(F.array_distinct(F.transform("lines", lambda x: F.when(F.trim(x) != "", _name(x))))).alias("line")).filter("line is not null")
    counts = lines.groupBy("site", "line").agg(F.count_distinct("page").alias("n")).filter(F.col("n") >= min_pages)
    return counts.join(totals, "site").filter(F.col("n") > F.col("pages") * ratio).groupBy("site").agg(F.collect_set("line").alias("boilerplate"))


def dedup_lines(docs: DataFrame, ratio: float = RATIO, min_pages: int = MIN_PAGES, host_col: str = "source", text_col: str = "text") -> DataFrame:
    """docs with boilerplate lines gone from the text, and n_lines, n_dropped.

    Lines stand between line feeds and count once a text of the site; blank ones always stay.
    A null text stays null and has no lines; documents with a null host are one site.  All
    columns and rows stay, repeated ones too; an empty table gives no rows.
    """
    settled(docs.sparkSession)
    found = stored(boilerplate(docs, ratio, min_pages, host_col, text_col))
    small = (found.agg(F.sum(F.size("boilerplate"))).first()[0] or 0) * 48 <= BROADCAST_BYTES
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), site_of(F.col(host_col)).alias("site"))
    text = F.col("row").getField(text_col)
    if small:
        joined = rows.join(F.broadcast(found), "site", "left")
    else:  # a hot site's pages go to SALTS tasks
        salted = found.select("site", "boilerplate", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("salt"))
        joined = rows.withColumn("salt", F.pmod(F.xxhash64(text), F.lit(SALTS)).cast("int")).join(salted, ["site", "salt"], "left")
    lines = F.split(text, "\n")
    kept = F.filter(lines, lambda x: (F.trim(x) == "") | ~F.array_contains(F.col("boilerplate"), _name(x)))
    joined = joined.withColumn("kept", F.when(F.col("boilerplate").isNull(), lines).otherwise(kept))
    count = lambda c: F.when(text.isNull() | (text == ""), 0).otherwise(F.size(c)).cast("long")
    others = [F.col("row").getField(c).alias(c) for c in docs.columns if c not in (text_col, "n_lines", "n_dropped")]
    return joined.select(*others, F.array_join("kept", "\n").alias(text_col), count(lines).alias("n_lines"), (count(lines) - count(F.col("kept"))).alias("n_dropped"))


#: The same in DuckDB SQL, over documents; source is the host.
SQL = f"""
WITH pages AS (
  SELECT doc_id, text, coalesce(lower(regexp_extract(source, '^(?:[a-zA-Z][a-zA-Z0-9+.-]*://)?([^/?#]*)', 1)), '') AS site FROM documents
), lines AS (
  SELECT doc_id, site, text, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS pos FROM pages WHERE text IS NOT NULL
), totals AS (
  SELECT site, count(DISTINCT coalesce(text, '')) AS pages FROM pages GROUP BY site
), boilerplate AS (
  SELECT l.site, l.line FROM (SELECT site, line, count(DISTINCT text) AS n FROM lines WHERE trim(line) <> '' GROUP BY site, line) l
  JOIN totals t USING (site) WHERE n >= {MIN_PAGES} AND n > t.pages * {RATIO}::DOUBLE
), kept AS (
  SELECT l.doc_id, count(*) AS n_lines, count(*) FILTER (b.line IS NOT NULL) AS n_dropped,
         coalesce(string_agg(l.line, chr(10) ORDER BY l.pos) FILTER (b.line IS NULL), '') AS text
  FROM lines l LEFT JOIN boilerplate b ON b.site = l.site AND b.line = l.line GROUP BY l.doc_id
)
SELECT d.doc_id, CASE WHEN d.text = '' THEN 0 ELSE coalesce(k.n_lines, 0) END::BIGINT AS n_lines, coalesce(k.n_dropped, 0)::BIGINT AS n_dropped, sha256(k.text) AS kept_sha256
FROM documents d LEFT JOIN kept k USING (doc_id)
"""
