"""Staging of remote files: the caller gives fetch(url), which returns bytes or raises; nothing here opens a connection."""

from __future__ import annotations

import time
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_retries(fetch: Callable[[str], bytes], url: str, attempts: int = 5, wait: Callable[[float], None] = time.sleep) -> bytes:
    """fetch(url), again after min(2 ** n, 30) seconds where it raises, so many times in all; then its last error.  A failed check of a certificate is an error as any other."""
    for n in range(1, attempts + 1):
        try:
            return fetch(url)
        except OSError:
            if n == attempts:
                raise
            wait(min(2**n, 30))
    raise ValueError("attempts must be at least 1")


def fetched(ids: DataFrame, template: str, fetch: Callable[[str], bytes], attempts: int = 5, wait: Callable[[float], None] = time.sleep) -> DataFrame:
    """(id, url, content, error) of ids (id): the template with {id} filled in; content is null and error a text where all attempts failed."""

    def run(batches):
        for batch in batches:
            rows = []
            for i in batch.column(0).to_pylist():
                url = template.replace("{id}", i)
                try:
                    rows.append((i, url, with_retries(fetch, url, attempts, wait), None))
                except OSError as e:
                    rows.append((i, url, None, str(e)))
            columns = zip(*rows, strict=True) if rows else ((), (), (), ())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, (pa.string(), pa.string(), pa.binary(), pa.string()), strict=True)], ["id", "url", "content", "error"])

    return ids.select(F.col("id").cast("string").alias("id")).distinct().mapInArrow(run, "id string, url string, content binary, error string")


def require_some(found: DataFrame) -> DataFrame:
    """Those of a stored fetched() that have a content; an error if there are rows and none has."""
    good = found.filter("error is null")
    if not good.take(1) and found.take(1):
        raise OSError(f"nothing could be fetched: {found.first().error}")
    return good
