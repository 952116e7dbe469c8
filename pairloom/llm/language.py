"""Language ID by Bayesian evidence fusion.

Three kinds of evidence are multiplied with a prior: the text's likelihood under byte trigram
models, a declared markup language, and the address.  The prior is smoothed down a hierarchy,
all documents - address suffix - host, from counts of the languages that text and
declaration alone find, by grouped aggregation.  UNKNOWN competes with its own flat trigram
model, so text like no known language is rejected.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pairloom.llm import scan
from pairloom.llm.shared import settled, sized_join, stored

UNKNOWN = "und"
#: Labelled texts of a language that the trigram models are fitted to, at most.
FIT_DOCS = 1500
#: Trigram cells; counts added to each; weight of one trigram, as neighbours overlap and repeat.
CELLS, PRIOR_COUNT, WEIGHT = 1 << 14, 0.5, 0.15
#: Probability that a declaration is right; counts that a level's parent weighs in its prior.
DECLARED_RIGHT, PARENT = 0.9, 20.0
#: Nats a trigram by which UNKNOWN's flat model is favoured, and the least posterior of an accepted document.
UNKNOWN_GAIN, ACCEPT = 0.0, 0.5

#: Bytes that count as letters: ASCII letters and all of non-ASCII; all others become one blank.
_LETTER = np.full(256, 32, np.uint8)
_LETTER[97:123], _LETTER[65:91], _LETTER[128:] = np.arange(97, 123), np.arange(97, 123), np.arange(128, 256)


def _trigrams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Cell and text of each byte trigram within a text that has a letter in its middle."""
    data = _LETTER[data].astype(np.uint32)
    if len(data) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    code = (data[:-2] * np.uint32(0x9E3779B1) ^ data[1:-1] * np.uint32(0x85EBCA77) ^ data[2:] * np.uint32(0xC2B2AE3D)) * np.uint32(0x27D4EB2F) >> np.uint32(18)
    text = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))
    keep = (text[2:] == text[:-2]) & (data[1:-1] != 32)
    return code[keep].astype(np.int64), text[:-2][keep]


def fit_models(labelled: DataFrame, text_col: str, lang_col: str) -> tuple[list[str], np.ndarray]:
    """Languages and log probabilities (language, cell), from at most FIT_DOCS different whole texts of each, chosen by hash; for UNKNOWN a flat row."""
    from pyspark.sql import Window

    rows = labelled.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).filter(f"lang is not null and text <> '' and lang <> '{UNKNOWN}'").withColumn("h", F.xxhash64("text"))
    # a first cut by hash and the merging of copies, so that no language's documents are all ranked in one task
    counts = rows.groupBy("lang").agg(F.approx_count_distinct("h").alias("count"))
    rows = sized_join(rows, stored(counts), "lang", "inner").filter(F.pmod("h", F.lit(1 << 30)) * F.col("count") < F.lit(2 * FIT_DOCS << 30)).dropDuplicates(["lang", "h"])
    rows = rows.withColumn("r", F.row_number().over(Window.partitionBy("lang").orderBy("h"))).filter(F.col("r") <= FIT_DOCS)

    def count(batches):
        for batch in batches:
            langs = batch.column(0).dictionary_encode()
            which, table = langs.indices.to_numpy(), np.zeros(len(langs.dictionary) * CELLS, np.int64)
            for at, to, data, own in scan.pieces(*scan.text_buffer(batch.column(1))):
                cells, text = _trigrams(data, own)
                table += np.bincount(which[at:to][text] * CELLS + cells, minlength=len(table))
            at = np.flatnonzero(table)
            yield pa.RecordBatch.from_pydict({"lang": langs.dictionary.take(pa.array(at // CELLS)), "cell": pa.array(at % CELLS, pa.int32()), "n": pa.array(table[at], pa.int64())})

    found = rows.select("lang", "text").mapInArrow(count, "lang string, cell int, n long").groupBy("lang", "cell").agg(F.sum("n").alias("n")).toPandas()
    langs = sorted(found.lang.unique())
    table = np.full((len(langs) + 1, CELLS), PRIOR_COUNT)
    for i, lang in enumerate(langs):
        own = found[found.lang == lang]
        table[i, own.cell.to_numpy()] += own.n.to_numpy()
    log = np.log(table / table.sum(axis=1, keepdims=True))
    # flat over the cells that any language fills, with the rest sharing one cell's probability
    used = (table[:-1] > PRIOR_COUNT).any(axis=0) if langs else np.zeros(CELLS, bool)
    log[-1] = -np.log(max(1, used.sum())) + UNKNOWN_GAIN
    return [*langs, UNKNOWN], log


def suffix_of(host: Column) -> Column:
    """The last label of a host that has several, else an empty string."""
    return F.when(F.instr(host, ".") > 0, F.substring_index(host, ".", -1)).otherwise("")


def declared_in(html: Column) -> Column:
    """The primary language of an html element's lang attribute, in lower case; null without one."""
    found = F.regexp_extract(html, r"(?i)<html[^>]*?\slang\s*=\s*[\"']?([a-zA-Z]{2,3})", 1)
    return F.when(found != "", F.lower(found))


def _evidence(docs: DataFrame, langs: list[str], log: np.ndarray) -> DataFrame:
    """(id columns, e): log evidence of text and declaration for each language."""
    known = len(langs) - 1

    def weigh(batches):
        scan.trim()
        for batch in batches:
            flat, offsets = scan.text_buffer(batch.column(1))
            out = np.zeros((len(offsets) - 1, len(langs)))
            for at, to, data, own in scan.pieces(flat, offsets):
                cells, text = _trigrams(data, own)
                for i in range(len(langs)):
                    out[at:to, i] = np.bincount(text, log[i][cells], minlength=to - at) * WEIGHT
            bare = np.bincount(np.zeros(0, np.int64), minlength=len(out)) if not len(flat) else np.diff(offsets)
            out[bare == 0, -1] += 1.0  # nothing to read
            declared = batch.column(2).to_pylist()
            for i, lang in enumerate(declared):
                if lang in langs[:known]:
                    out[i, :known] += np.log((1 - DECLARED_RIGHT) / max(1, known - 1)) if known > 1 else 0.0
                    out[i, langs.index(lang)] += np.log(DECLARED_RIGHT) - (np.log((1 - DECLARED_RIGHT) / (known - 1)) if known > 1 else 0.0)
                    out[i, known] += np.log((1 - DECLARED_RIGHT) / max(1, known))
            e = pa.ListArray.from_arrays(pa.array(np.arange(len(out) + 1) * len(langs), pa.int32()), pa.array(out.ravel(), pa.float64()))
            yield pa.RecordBatch.from_pydict({"row": batch.column(0), "host": batch.column(3), "e": e})

    return docs.mapInArrow(weigh, "row struct<doc_id: long, tag: long, carried: string>, host string, e array<double>")


def identify(docs: DataFrame, labelled: DataFrame, declared: Column, host: Column, id_col: str = "doc_id", text_col: str = "text", labelled_text: str = "text", labelled_lang: str = "lang", carried: Column | None = None) -> DataFrame:
    """One row per document: doc_id, tag (hash of its text), carried, language, probability, accepted.

    carried: a column of docs, as text, that goes along and is no evidence (none: null).
    declared and host: columns of docs with a declared language (or null) and a host.
    labelled: documents that the text models are fitted to, a bounded sample.  A document is
    accepted if its language is not UNKNOWN and has a posterior of at least ACCEPT.  Null
    texts count as empty and are UNKNOWN, unless declaration and prior say otherwise;
    documents without a host share one.  Null and repeated doc_ids keep a row each; other
    columns are ignored; an empty table gives no rows; without labelled documents all is
    UNKNOWN.
    """
    settled(docs.sparkSession)
    langs, log = fit_models(labelled, labelled_text, labelled_lang)
    tag = F.xxhash64(F.col(text_col)).alias("tag")
    rows = docs.select(F.struct(F.col(id_col).cast("long").alias("doc_id"), tag, (F.lit(None) if carried is None else carried).cast("string").alias("carried")).alias("row"), F.col(text_col).cast("string").alias("text"), declared.cast("string").alias("declared"), F.coalesce(F.lower(host.cast("string")), F.lit("")).alias("host"))
    seen = stored(_evidence(rows, langs, log).withColumn("suffix", suffix_of(F.col("host"))))
    first = seen.select("host", "suffix", (F.array_position("e", F.array_max("e")) - 1).cast("int").alias("k"))
    one_hot = [F.count_if(F.col("k") == i).cast("double") for i in range(len(langs))]
    by_host = stored(first.groupBy("suffix", "host").agg(F.array(*one_hot).alias("c")))
    up = lambda df, *keys: df.groupBy(*keys).agg(F.array(*[F.sum(F.col("c")[i]) for i in range(len(langs))]).alias("u"))
    total = lambda c: F.aggregate(c, F.lit(0.0), lambda a, x: a + x)
    smooth = lambda c, parent: F.zip_with(c, parent, lambda x, p: (x + PARENT * p) / (total(c) + PARENT))
    root = (by_host.agg(F.array(*[F.sum(F.col("c")[i]) for i in range(len(langs))]).alias("u")).first().u) or []
    root = [((x or 0.0) + 1.0) / (sum(y or 0.0 for y in root) + len(langs)) for x in root]
    by_suffix = up(by_host, "suffix").select("suffix", smooth(F.col("u"), F.lit(root).cast("array<double>")).alias("p"))
    priors = stored(by_host.join(by_suffix, "suffix").select("host", smooth(F.col("c"), F.col("p")).alias("prior")))
    joined = sized_join(seen.select("row", "host", "e"), priors, "host", "inner", 64 + 8 * len(langs))
    log_post = F.zip_with("e", "prior", lambda e, p: e + F.ln(p))
    joined = joined.select("row.*", log_post.alias("l"), F.array_max(log_post).alias("m"))
    probability = 1 / F.aggregate("l", F.lit(0.0), lambda a, x: a + F.exp(x - F.col("m")))
    language = F.get(F.lit(langs), (F.array_position("l", F.col("m")) - 1).cast("int"))
    out = joined.select("doc_id", "tag", "carried", language.alias("language"), probability.alias("probability"))
    return out.withColumn("accepted", (F.col("language") != UNKNOWN) & (F.col("probability") >= ACCEPT))
