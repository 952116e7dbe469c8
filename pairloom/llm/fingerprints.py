"""Document fingerprints by closed syncmers, in DataFrame functions alone.

Of all K-word pieces those are kept whose smallest S-word piece, by hash, is the first or the
last within: a choice that looks at nothing around the piece, so equal passages give equal
anchors wherever they stand.  Any K - S + 1 pieces in a row have one that is kept, so the step from
one anchor to the next fits into a hexadecimal digit.  A fingerprint is a digit for the step and
eight for the hash of each anchor, packed to text; likeness compares the sets of hashes, and
anchors with equal hashes at equal positions show how far two documents run beside each other.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pairloom.llm.shared import RANGE_BYTES, n_blocks, settled, spread, text_bytes

#: Words of a piece and of the inner pieces that decide.
K, S = 8, 2
#: Bits of an anchor's hash.
BITS = 32
#: Id ranges, at most, and sampled rows for the bounds of each.
RANGES, SAMPLES = 1 << 16, 20


def _let(value: Column, then) -> Column:
    """then(value) with value computed once for a row."""
    return F.transform(F.array(value), then)[0]


def anchors(text: Column) -> Column:
    """Array of (position, hash) of the closed syncmers of a text, in order; position counts words.

    Words stand between runs of ASCII white space.  A text with words but without a closed
    syncmer, which has few, has all of it as its one anchor; null, empty and blank texts have none.
    """
    words = F.filter(F.split(F.coalesce(text, F.lit("")), "[ \\t-\\r]+"), lambda w: w != "")
    hashes = F.transform(words, lambda w: F.xxhash64(w))
    inner = K - S  # the last inner piece's index
    cut = F.lit((1 << BITS) - 1)

    def chosen(h: Column) -> Column:
        n = F.size(h)
        small = F.transform(F.sequence(F.lit(1), n - (S - 1)), lambda i: F.xxhash64(*[F.get(h, i - 1 + d) for d in range(S)]))

        def pick(g: Column) -> Column:
            edge = lambda i: F.least(F.get(g, i), F.get(g, i + inner))
            middle = lambda i: F.least(*[F.get(g, i + d) for d in range(1, inner)])
            at = F.filter(F.sequence(F.lit(0), n - K), lambda i: edge(i) <= middle(i))
            return F.transform(at, lambda i: F.struct(i.alias("position"), F.xxhash64(*[F.get(h, i + d) for d in range(K)]).bitwiseAND(cut).alias("hash")))

        none = F.array().cast("array<struct<position:int,hash:bigint>>")
        whole = F.array(F.struct(F.lit(0).alias("position"), F.xxhash64(h).bitwiseAND(cut).alias("hash")))
        kept = lambda found: F.when(F.size(found) > 0, found).otherwise(whole)
        return F.when(n >= K, _let(_let(small, pick), kept)).when(n > 0, whole).otherwise(none)

    return _let(hashes, chosen)


def hashes(fp: Column) -> Column:
    """Sorted distinct hashes of a fingerprint."""
    return F.array_sort(F.array_distinct(fp["hash"]))


def likeness(a: Column, b: Column) -> Column:
    """Jaccard index of two sets of hashes; 1 for two empty ones, 0 for one."""
    both = F.size(F.array_intersect(a, b))
    union = F.size(a) + F.size(b) - both
    return F.when(union == 0, 1.0).otherwise(both / union)


def as_string(fp: Column) -> Column:
    """The anchors in order, nine hexadecimal digits each (step, hash), as base64; read_string() reads them."""
    step = lambda a, i: a["position"] - F.when(i > 0, F.get(fp, i - 1)["position"]).otherwise(0)
    digits = F.array_join(F.transform(fp, lambda a, i: F.concat(F.lower(F.hex(step(a, i))), F.lpad(F.lower(F.hex(a["hash"])), BITS // 4, "0"))), "")
    return F.base64(F.unhex(F.concat(digits, F.when(F.length(digits) % 2 == 1, "0").otherwise(""))))


def read_string(text: Column) -> Column:
    """The (step, hash) of each anchor of a string of as_string()."""
    digits, each = F.hex(F.unbase64(text)), 1 + BITS // 4
    number = lambda at, n: F.conv(F.substring(digits, at, n), 16, 10).cast("long")
    count = F.floor(F.length(digits) / each).cast("int")
    # an odd number of digits was filled up with one
    at = F.when(count > 0, F.sequence(F.lit(0), count - 1)).otherwise(F.array().cast("array<int>"))
    return F.transform(at, lambda i: F.struct(number(i * each + 1, F.lit(1)).alias("step"), number(i * each + 2, F.lit(BITS // 4)).alias("hash")))


def beside(a: Column, b: Column) -> Column:
    """Words from the start on that the anchors of both show to be the same: up to the end of the last anchor before the first that differs in position or hash."""
    differ = F.array_position(F.zip_with(a, b, lambda x, y: x.eqNullSafe(y)), False)
    same = F.when(differ > 0, differ - 1).otherwise(F.size(a)).cast("int")
    return F.when(same > 0, F.get(a, same - 1)["position"] + K).otherwise(0).cast("long")


def with_next(docs: DataFrame) -> DataFrame:
    """(doc_id, text, fp, next_text, next_fp): the next document by ascending doc_id, the first after the last.

    Documents are dealt to ranges of (id, hash of the text), one for each RANGE_BYTES of text
    and RANGES at most, with bounds from a sample of SAMPLES rows a range; each range's
    first document also goes to the end of the range before.  The driver gets the sample
    and a row for each range.  Equal ids are ordered by the hash of the text, null ids
    come first, a null text counts as empty.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.withColumn("id", F.coalesce("doc_id", F.lit(-(1 << 63)))).withColumn("h", F.xxhash64("text"))
    ranges = min(RANGES, n_blocks(docs.sparkSession, text_bytes(docs), RANGE_BYTES))
    share = min(1.0, SAMPLES * ranges / max(1, rows.count()))
    sample = rows.filter(F.pmod(F.xxhash64("id", "h", F.lit("bounds")), F.lit(1 << 30)) < F.lit(int(share * (1 << 30)))).select("id", "h").collect()
    sample = sorted((r.id, r.h) for r in sample)
    bounds = sorted({sample[i * len(sample) // ranges] for i in range(1, ranges)}) if sample else []
    rows = rows.withColumn("part", _place(F.col("id"), F.col("h"), bounds))
    heads = sorted((r.part, r.first.id, r.first.h) for r in rows.groupBy("part").agg(F.min(F.struct("id", "h")).alias("first")).collect())
    first, before = [(None, None)] * (len(bounds) + 1), [0] * (len(bounds) + 1)
    for k, (part, *head) in enumerate(heads):
        first[part], before[part] = head, heads[k - 1][0]
    of = lambda k: F.get(F.lit([f[k] for f in first]).cast("array<long>"), F.col("part"))
    twice = (F.col("id") == of(0)) & (F.col("h") == of(1))
    own = F.struct(F.col("part"), F.lit(0).alias("ghost"))
    ghost = F.struct(F.get(F.lit(before).cast("array<int>"), F.col("part")).alias("part"), F.lit(1).alias("ghost"))
    dealt = rows.select("doc_id", "text", "id", "h", F.explode(F.when(twice, F.array(own, ghost)).otherwise(F.array(own))).alias("at"))
    dealt = spread(dealt.select("doc_id", "text", "id", "h", "at.part", "at.ghost"), "part", 2 * len(first)).withColumn("fp", anchors(F.col("text")))
    order = Window.partitionBy("part").orderBy("ghost", "id", "h")
    dealt = dealt.withColumn("next_text", F.lead("text").over(order)).withColumn("next_fp", F.lead("fp").over(order))
    return dealt.filter("ghost = 0").select("doc_id", "text", "fp", "next_text", "next_fp")


def _place(id_: Column, h: Column, bounds: list[tuple[int, int]]) -> Column:
    """How many bounds (ascending) are at most (id, h), by binary search."""
    if not bounds:
        return F.lit(0)
    ids, hs = (F.lit([b[k] for b in bounds]).cast("array<long>") for k in (0, 1))
    size, steps = 1 << len(bounds).bit_length(), []
    while size > 1:
        size //= 2
        steps.append(size)
    passed = lambda at: (F.get(ids, at) < id_) | ((F.get(ids, at) == id_) & (F.get(hs, at) <= h))
    # lifts the count by a step wherever the bound before the lifted place is at most (id, h)
    return F.aggregate(F.lit(steps).cast("array<int>"), F.lit(0), lambda n, step: F.when(passed(n + step - 1), n + step).otherwise(n))


def fingerprint_edits(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, words_kept.

    The edited text has its last floor(n_chars / 2) code points replaced by the first as
    many (or all) of the next document; see with_next() for the order.  Fingerprints are strings
    of as_string(), empty without words.  words_kept is beside() of both; a text that is its own
    one anchor counts as K words.  Other columns are ignored; an empty table gives no rows.
    """
    settled(docs.sparkSession)
    pairs = with_next(docs)
    n = F.char_length("text")
    half = F.floor(n / 2).cast("int")
    out = pairs.select("doc_id", "fp", "next_fp", n.cast("long").alias("n_chars"), F.concat(F.substring("text", F.lit(1), n - half), F.substring("next_text", F.lit(1), half)).alias("edited"))
    out = out.withColumn("edited_fp", anchors(F.col("edited"))).withColumn("own", hashes(F.col("fp")))
    return out.select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"), as_string(F.col("fp")).alias("fingerprint"), as_string(F.col("edited_fp")).alias("edited_fingerprint"),
        likeness(F.col("own"), hashes(F.col("edited_fp"))).alias("near_edited"), likeness(F.col("own"), hashes(F.col("next_fp"))).alias("near_next"), beside(F.col("fp"), F.col("edited_fp")).alias("words_kept"),
    )


#: Lengths and edited texts in DuckDB SQL, over documents.
EDITS_SQL = """
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text, length(coalesce(text, '')) AS n FROM documents
), pairs AS (
  SELECT doc_id, text, n, coalesce(lead(text) OVER (ORDER BY doc_id), first_value(text) OVER (ORDER BY doc_id)) AS following FROM d
)
SELECT doc_id, n::BIGINT AS n_chars, sha256(substring(text, 1, n - n // 2) || substring(following, 1, n // 2)) AS edited_sha256 FROM pairs
"""
