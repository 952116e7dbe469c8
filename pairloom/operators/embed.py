"""Embeddings by a pluggable model in Arrow batches, and pooling."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def hash_model(dims: int = 16) -> Callable[[list[str]], list[np.ndarray]]:
    """A deterministic stand-in for a protein model: (length + 2, dims) for each sequence, begin and end included."""
    table = np.random.RandomState(7).standard_normal((258, dims)).astype(np.float32)

    def embed(seqs: list[str]) -> list[np.ndarray]:
        return [table[np.concatenate([[256], np.frombuffer(s.encode("latin-1", "replace"), np.uint8), [257]])] for s in seqs]

    return embed


def code_model() -> Callable[[list[str]], list[np.ndarray]]:
    """A model that can be told in a line: a token's vector is its code and the code's square; the begin is 0, the end 1."""

    def embed(seqs: list[str]) -> list[np.ndarray]:
        codes = (np.concatenate([[0], np.frombuffer(s.encode("latin-1", "replace"), np.uint8), [1]]).astype(np.float64) for s in seqs)
        return [np.stack([c, c * c], axis=1) for c in codes]

    return embed


def embed_with_halving(model, seqs: list[str]) -> list[np.ndarray | None]:
    """The model's output; where memory runs out the batch is halved, and a single sequence skipped (None)."""
    try:
        return list(model(seqs))
    except MemoryError:
        if len(seqs) == 1:
            return [None]
        half = len(seqs) // 2
        return embed_with_halving(model, seqs[:half]) + embed_with_halving(model, seqs[half:])


def embed(df: DataFrame, make_model: Callable[[], Callable], batch: int = 8, pooled: bool = True, max_length: int = 4096) -> DataFrame:
    """(seq_id, embedding) of df (seq_id, seq); sequences are dealt to partitions by length and sorted within, so that a batch holds like lengths; too long or empty ones have a null."""
    kind = "seq_id string, embedding array<float>" if pooled else "seq_id string, embedding array<array<float>>"

    def run(batches):
        model = make_model()
        for rows in batches:
            ids, seqs = rows.column(0).to_pylist(), [s or "" for s in rows.column(1).to_pylist()]
            out: list = []
            for at in range(0, len(seqs), batch):
                own = seqs[at : at + batch]
                fit = [s for s in own if 0 < len(s) <= max_length]
                found = iter(embed_with_halving(model, fit) if fit else [])
                out += [next(found) if 0 < len(s) <= max_length else None for s in own]
            values = [None if x is None else (x.mean(axis=0) if pooled else x).astype(np.float32).tolist() for x in out]
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.string()), pa.array(values, pa.list_(pa.float32()) if pooled else pa.list_(pa.list_(pa.float32())))], ["seq_id", "embedding"])

    return df.select("seq_id", "seq").repartitionByRange(F.length("seq"), "seq_id").sortWithinPartitions(F.length("seq"), "seq_id").mapInArrow(run, kind)


def mean_pool(tokens: Column, length: Column) -> Column:
    """Mean over the first length tokens (at least one) of an array of vectors."""
    own = F.slice(tokens, F.lit(1), F.greatest(F.lit(1), length).cast("int"))
    total = F.aggregate(F.slice(own, F.lit(2), F.size(own)), F.transform(own[0], lambda x: x.cast("double")), lambda a, v: F.zip_with(a, v, lambda x, y: x + y.cast("double")))
    return F.transform(total, lambda x: x / F.greatest(F.lit(1), F.size(own)))
