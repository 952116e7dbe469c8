"""Quality classifier: regularised quadratic discriminant analysis on document statistics.

Each class has its own mean and a covariance shrunk towards the pooled one and towards a
multiple of the identity.  A score is the posterior of class 1 from the difference of the two
log densities; the Cholesky factors and log determinants are computed once and cached.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.llm import scan
from pairloom.llm.shared import settled, stored

#: Weight of the pooled covariance, and of the identity, in a class's covariance.
SHRINK, RIDGE = 0.2, 0.02
#: Score from which a document is predicted to be of class 1.
THRESHOLD = 0.7

STATISTICS = (
    "log_words", "mean_word", "spread_word", "upper", "upper_words", "digits", "signs", "sign_kinds", "sign_tails",
    "distinct_words", "top_word", "repeated_pairs", "repeated_lines", "line_words", "short_words", "non_ascii", "sentence_ends", "byte_entropy",
)

_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True
_DIGIT = np.zeros(256, bool)
_DIGIT[48:58] = True
_SIGN = np.zeros(256, bool)
_SIGN[[b for b in range(33, 127) if not chr(b).isalnum() and chr(b) not in ".,"]] = True
_STOP = np.zeros(256, bool)
_STOP[[33, 46, 63]] = True
_LINE = np.ones(256, bool)
_LINE[10] = False


def _per(owner: np.ndarray, n: int, weights=None) -> np.ndarray:
    return np.bincount(owner, weights, minlength=n).astype(np.float64)


def _most(hashes: np.ndarray, owner: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values of each text, and the count of its commonest."""
    out = np.zeros(n)
    if not len(hashes):
        return out, out.copy()
    order = scan.order_of(hashes)
    order = order[np.argsort(owner[order].astype(np.uint16), kind="stable")]  # a piece has at most 4096 texts
    h, o = hashes[order], owner[order]
    first = np.flatnonzero(np.concatenate([[True], (h[1:] != h[:-1]) | (o[1:] != o[:-1])]))
    np.maximum.at(out, o[first], np.diff(np.append(first, len(h))))
    return _per(o[first], n), out


def _share(x: np.ndarray, of: np.ndarray) -> np.ndarray:
    """A smoothed logit of x / of."""
    return np.log((x + 0.05) / (np.maximum(of - x, 0) + 0.05 + 0.02 * of))


def statistics(flat: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Transformed statistics of each whole text, one row each; finite for empty texts too."""
    n = len(offsets) - 1
    out = np.zeros((n, len(STATISTICS)))
    for at, to, data, own in scan.pieces(flat, offsets):
        n = to - at
        text = np.repeat(np.arange(n), np.diff(own))
        size = np.diff(own).astype(np.float64)
        starts, ends, owner = scan.word_spans(data, own, scan.NON_SPACE)
        folded = scan.FOLD[data]
        hashes = scan.spans_hash(folded, starts, ends)
        words, length = _per(owner, n), (ends - starts).astype(np.float64)
        mean = _per(owner, n, length) / np.maximum(words, 1)
        spread = np.sqrt(np.maximum(_per(owner, n, length**2) / np.maximum(words, 1) - mean**2, 0))
        histogram = np.bincount(text * 256 + data, minlength=n * 256).reshape(n, 256).astype(np.float64)
        upper, digit, sign, stop = (histogram[:, mask].sum(axis=1) for mask in (_UPPER, _DIGIT, _SIGN, _STOP))
        ups = np.concatenate([[0], np.cumsum(_UPPER[data])])
        loud = _per(owner[(ups[ends] - ups[starts]) * 2 > length], n)
        tails = _per(owner[_SIGN[data[ends - 1]]], n) if len(ends) else np.zeros(n)
        distinct, top = _most(hashes, owner, n)
        begins = np.searchsorted(owner, np.arange(n + 1))
        pairs, pair_owner = scan.ngrams(hashes, begins, 2)
        pair_distinct, _ = _most(pairs, pair_owner, n)
        l_starts, l_ends, l_owner = scan.word_spans(data, own, _LINE)
        lines = _per(l_owner, n)
        line_distinct, _ = _most(scan.spans_hash(folded, l_starts, l_ends), l_owner, n)
        kinds = (histogram[:, _SIGN] > 0).sum(axis=1)
        p = histogram / np.maximum(size, 1)[:, None]
        entropy = -(p * np.log2(np.where(p > 0, p, 1))).sum(axis=1)
        out[at:to] = np.stack([
            np.log1p(words), np.log1p(mean), np.log1p(spread), _share(upper, size), _share(loud, words), _share(digit, size), _share(sign, size), np.log1p(kinds), _share(tails, words),
            _share(distinct, words), _share(top, words), _share(_per(pair_owner, n) - pair_distinct, _per(pair_owner, n)), _share(lines - line_distinct, lines), np.log1p(words / np.maximum(lines, 1)),
            _share(_per(owner[length <= 3], n), words), _share(histogram[:, 128:].sum(axis=1), size), _share(stop, words), entropy,
        ], axis=1)
    return out


class Discriminant:
    """Two Gaussians with cached Cholesky factors."""

    def __init__(self, counts, sums, squares, shrink: float = SHRINK, ridge: float = RIDGE):
        """counts (2), sums (2, d) and sums of outer products (2, d, d) of the classes."""
        counts = np.asarray(counts, float)
        d = sums.shape[1]
        self.known = bool((counts > 1).all())
        total = max(counts.sum(), 1)
        self.centre = sums.sum(axis=0) / total
        self.scale = np.sqrt(np.maximum(np.diag(squares.sum(axis=0)) / total - self.centre**2, 1e-6))
        self.prior = np.log((counts + 1) / (counts.sum() + 2))
        if not self.known:
            return
        means = sums / counts[:, None]
        covs = [(q / c - np.outer(m, m)) / np.outer(self.scale, self.scale) for c, m, q in zip(counts, means, squares, strict=True)]
        pooled = (counts[0] * covs[0] + counts[1] * covs[1]) / total
        self.means = (means - self.centre) / self.scale
        self.factors = []
        for cov in covs:
            cov = (1 - shrink) * cov + shrink * pooled
            cov = (1 - ridge) * cov + ridge * max(np.trace(cov) / d, 1e-3) * np.eye(d)
            self.factors.append(np.linalg.cholesky(cov))
        self.inverses = [np.linalg.inv(f) for f in self.factors]
        self.log_dets = [2 * np.log(np.diag(f)).sum() for f in self.factors]

    def scores(self, x: np.ndarray) -> np.ndarray:
        """Posterior of class 1; the prior where a class has no two examples."""
        if not self.known:
            return np.full(len(x), np.exp(self.prior[1]))
        z = (x - self.centre) / self.scale
        log = [p - 0.5 * (det + (((z - m) @ inv.T) ** 2).sum(axis=1)) for p, det, m, inv in zip(self.prior, self.log_dets, self.means, self.inverses, strict=True)]
        return 1 / (1 + np.exp(np.clip(log[0] - log[1], -700, 700)))


def document_statistics(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, x): transformed statistics of each whole text."""

    def measure(batches):
        for batch in batches:
            x = statistics(*scan.text_buffer(batch.column(1)))
            values = pa.array(x.ravel(), pa.float64())
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column(0), "x": pa.ListArray.from_arrays(pa.array(np.arange(len(x) + 1) * x.shape[1], pa.int32()), values)})

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(measure, "doc_id long, x array<double>")


def fit(measured: DataFrame, labels: DataFrame) -> Discriminant:
    """From (doc_id, x) and labels (doc_id, label 0/1): sums by class are added up by grouped aggregation; rows with other or no labels are left out."""
    d = len(STATISTICS)
    rows = measured.join(labels.filter("label in (0, 1) and doc_id is not null"), "doc_id").select("label", "x")

    def moments(batches):
        counts, sums, squares = np.zeros(2), np.zeros((2, d)), np.zeros((2, d, d))
        for batch in batches:
            x = batch.column(1).flatten().to_numpy().reshape(-1, d)
            y = batch.column(0).to_numpy()
            for c in (0, 1):
                own = x[y == c]
                counts[c] += len(own)
                sums[c] += own.sum(axis=0)
                squares[c] += own.T @ own
        flat = np.concatenate([counts, sums.ravel(), squares.ravel()])
        yield pa.RecordBatch.from_pydict({"i": pa.array(np.arange(len(flat)), pa.int32()), "v": pa.array(flat, pa.float64())})

    found = {r.i: r.v for r in rows.mapInArrow(moments, "i int, v double").groupBy("i").agg(F.sum("v").alias("v")).collect()}
    flat = np.array([found.get(i, 0.0) for i in range(2 + 2 * d + 2 * d * d)])
    return Discriminant(flat[:2], flat[2 : 2 + 2 * d].reshape(2, d), flat[2 + 2 * d :].reshape(2, d, d))


def score_quality(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, score (0 to 1, higher: class 1 likelier), predicted (1 from threshold).

    labels (doc_id, label): what to learn from; only texts make a score.  Null texts count
    as empty and get a score as well; null and repeated doc_ids keep a row each; without two
    examples of each class the score is the smoothed prior.  Other columns are ignored; an
    empty table gives no rows.
    """
    settled(docs.sparkSession)
    measured = stored(document_statistics(docs, id_col, text_col))
    model, d = fit(measured, labels), len(STATISTICS)

    def score(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column(0), "score": pa.array(model.scores(batch.column(1).flatten().to_numpy().reshape(-1, d)), pa.float64())})

    out = measured.mapInArrow(score, "doc_id long, score double")
    return out.withColumn("predicted", (F.col("score") >= threshold).cast("int"))
