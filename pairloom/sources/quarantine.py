"""Text files that may be broken: their lines, and a table of what is wrong with which file.

A file may be cut off, have a damaged gzip member, or bytes that are no UTF-8.  Such a file does not end the
run and is not passed over in silence: it gives a row (file, offset, reason), and its lines up to the break are
kept or dropped whole, as the caller says.
"""

from __future__ import annotations

import codecs
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pairloom.operators.keys import saved

#: Bytes unpacked at once, and lines of an Arrow batch.
STEP, LINES = 1 << 20, 5000
_SCHEMA = "file string, line_no long, value string, offset long, reason string"


class Broken(Exception):
    """A file's break: reason and the offset in what was stored (gzip) or read (plain)."""

    def __init__(self, offset: int, reason: str):
        super().__init__(f"{reason} at {offset}")
        self.offset, self.reason = offset, reason


def _unpacked(data: memoryview) -> Iterator[tuple[bytes, int]]:
    """Parts of a plain or gzip file, and where in it each ends."""
    if bytes(data[:2]) != b"\x1f\x8b":
        for at in range(0, len(data), STEP):
            yield bytes(data[at : at + STEP]), min(at + STEP, len(data))
        return
    at = 0
    while at < len(data):
        member = zlib.decompressobj(31)
        while not member.eof:
            part = data[at : at + STEP]
            if not len(part):
                raise Broken(at, "cut off")
            try:
                out = member.decompress(part)
            except zlib.error as e:
                raise Broken(at, "damaged gzip") from e
            at += len(part) - len(member.unused_data)
            yield out, at
        while at < len(data) and data[at] == 0:  # padding between members
            at += 1


def lines_of(content) -> Iterator[str]:
    """The lines of a file's bytes, without their ends; Broken after the last whole line where the file breaks."""
    decode, held, at = codecs.getincrementaldecoder("utf-8")(), "", 0
    try:
        for part, at in _unpacked(memoryview(content)):
            try:
                held += decode.decode(part)
            except UnicodeDecodeError as e:
                held += part[: e.start].decode("utf-8", "ignore")
                raise Broken(at - len(part) + e.start, "not UTF-8") from e
            *whole, held = held.split("\n")
            yield from (x.removesuffix("\r") for x in whole)
        try:
            held += decode.decode(b"", True)
        except UnicodeDecodeError as e:
            raise Broken(at, "not UTF-8") from e
    except Broken:
        *whole, _ = held.split("\n")  # what follows the last line end may be half a line
        yield from (x.removesuffix("\r") for x in whole)
        raise
    if held:
        yield held.removesuffix("\r")


def read_lines(files: DataFrame, keep_before_break: bool = False) -> tuple[DataFrame, DataFrame]:
    """Lines (file, line_no, value) and breaks (file, offset, reason) of files (path, content).

    Without keep_before_break a broken file gives no lines.  Each file is read by one task and
    none is held as a whole but for its packed bytes and, unless lines before a break are kept,
    its lines.
    """

    def batch(rows: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.string(), pa.int64(), pa.string(), pa.int64(), pa.string()), strict=True)], ["file", "line_no", "value", "offset", "reason"])

    def read(batches):
        for some in batches:
            for path, content in zip(some.column("path").to_pylist(), some.column("content"), strict=True):
                rows: list = []
                try:
                    for n, line in enumerate(lines_of(content.as_buffer() if content.is_valid else b"")):
                        rows.append((path, n, line, None, None))
                        if keep_before_break and len(rows) == LINES:
                            yield batch(rows)
                            rows = []
                except Broken as e:
                    rows = [*(rows if keep_before_break else ()), (path, None, None, e.offset, e.reason)]
                for at in range(0, len(rows), LINES):
                    yield batch(rows[at : at + LINES])

    found = saved(files.select("path", "content").mapInArrow(read, _SCHEMA))
    return found.filter("reason is null").select("file", "line_no", "value"), found.filter("reason is not null").select("file", "offset", "reason")


def text_files(spark: SparkSession, path: str, keep_before_break: bool = False) -> tuple[DataFrame, DataFrame]:
    """read_lines() of the files under path."""
    return read_lines(spark.read.format("binaryFile").load(path), keep_before_break)


def unmapped_endpoints(edges: DataFrame, mapped: DataFrame) -> DataFrame:
    """(domain, n): the ends of edges (a, b) that have no row in mapped (domain), such as those of broken files, with the number of edges that a split drops for it."""
    ends = edges.select(F.explode(F.array_distinct(F.array("a", "b"))).alias("domain")).groupBy("domain").agg(F.count("*").alias("n"))
    return ends.join(mapped.select("domain").distinct(), "domain", "left_anti")
