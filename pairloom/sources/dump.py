"""Tables of MySQL dumps: read through Spark's text source, in parallel, whatever the statements' quotes span.

Whether a line stands within a statement or a literal depends on all lines before it, but a
split's effect on that is a function of five states.  A first pass finds each split's function, the
driver chains them (a row for each split), and a second pass cuts every split into statements; only
those that cross a split's end are put together by a shuffle.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: States before a line: outside of any statement, within one, and within a literal of each quote.
IDLE, OPEN = "-", "+"
STATES = (IDLE, OPEN, "'", '"', "`")
#: Escapes of string literals.
_ESCAPES = {"n": "\n", "r": "\r", "t": "\t", "0": "\0", "Z": "\x1a"}
_MARK = re.compile(r"\\.|['\"`]", re.S)
_SESSION = re.compile(r"\s*(PRAGMA|BEGIN|END|COMMIT|SET|LOCK|UNLOCK|USE|DROP)\b", re.I)


def after(line: str, state: str) -> str:
    """The state after a line: statements end at a semicolon at a line's end outside of literals; between them, blank lines and comments count for nothing."""
    if state == IDLE and (not line.strip() or line.lstrip().startswith(("--", "/*", "#"))):
        return IDLE
    quote = state if state not in (IDLE, OPEN) else ""
    for m in _MARK.finditer(line):
        c = m[0][-1]
        if len(m[0]) > 1:  # a backslash escapes within literals alone
            if not quote and c in STATES[2:]:
                quote = c
        elif not quote:
            quote = c
        elif c == quote:
            quote = ""
    return quote or (IDLE if line.rstrip().endswith(";") else OPEN)


def statements(lines: Iterable[str]) -> Iterator[str]:
    """Statements of a dump, without those of the session."""
    held: list[str] = []
    state = IDLE
    for line in lines:
        line = line.rstrip("\r\n")
        before, state = state, after(line, state)
        if before != IDLE or state != IDLE or line.rstrip().endswith(";"):
            if before != IDLE or not line.lstrip().startswith(("--", "/*", "#")):
                held.append(line)
        if state == IDLE and held:
            whole = "\n".join(held)
            held = []
            if not _SESSION.match(whole):
                yield whole


#: A literal in quotes, a sign of the list, or a word; nothing is tried twice.
_TOKEN = re.compile(r"'((?:[^'\\]++|\\.|'')*+)'|\"((?:[^\"\\]++|\\.|\"\")*+)\"|([(),])|([^\s(),'\"]++)", re.S)
_ESCAPED = re.compile(r"\\(.)|(['\"])\2", re.S)


def _plain(literal: str, quote: str) -> str:
    """A literal without its escapes and doubled quotes."""
    if "\\" not in literal and quote not in literal:
        return literal
    return _ESCAPED.sub(lambda m: _ESCAPES.get(m[1], m[1]) if m[1] else m[2] if m[2] == quote else m[0], literal)


def tuples(values: str) -> Iterator[list]:
    """Rows of a VALUES list; NULL is None, bit literals are ints, all else text."""
    row, cell = None, None
    for m in _TOKEN.finditer(values):
        kind, text = m.lastindex, m[m.lastindex]
        if row is None:
            if text == "(" and kind == 3:
                row, cell = [], None
        elif kind < 3:
            text = _plain(text, "'\""[kind - 1])
            cell = str(int(text, 2)) if cell == "b" else text
        elif kind == 4:
            cell = None if text.upper() == "NULL" else text
        elif text in ",)":
            row.append(cell)
            cell = None
            if text == ")":
                yield row
                row = None


def columns_of(statement: str) -> list[str]:
    """Column names of a CREATE TABLE statement."""
    body = statement[statement.index("(") + 1 : statement.rindex(")")]
    out = []
    for line in body.split("\n"):
        if m := re.match(r"\s*[`\"](\w+)[`\"]\s", line) or re.match(r"\s*(?!PRIMARY|UNIQUE|KEY|CONSTRAINT|FOREIGN|FULLTEXT|INDEX)(\w+)\s+\w", line, re.I):
            out.append(m[1])
    return out


def _name(table: str) -> str:
    return rf"[`\"]?{re.escape(table)}[`\"]?"


def insert_rows(statement: str, table: str, known: list[str], columns: list[str]) -> Iterator[tuple]:
    """Rows of an INSERT into the table, by the statement's own columns or those known; nothing for other statements."""
    if m := re.match(rf"\s*(?:INSERT|REPLACE)\s+(?:IGNORE\s+)?INTO\s+{_name(table)}\s*(?:\(([^)]*)\))?\s*VALUES\s*(.*);\s*$", statement, re.S | re.I):
        names = [c.strip(" `\"") for c in m[1].split(",")] if m[1] else known
        for row in tuples(m[2]):
            own = dict(zip(names, row, strict=False))
            yield tuple(own.get(c) for c in columns)


def dump_rows(lines: Iterable[str], table: str, columns: list[str]) -> Iterator[tuple]:
    """Rows of one table, the columns by their order in its CREATE TABLE or in the statement."""
    known: list[str] = []
    for s in statements(lines):
        if re.match(rf"\s*CREATE TABLE (?:IF NOT EXISTS )?{_name(table)}\s*\(", s, re.I):
            known = columns_of(s)
        yield from insert_rows(s, table, known, columns)


def _effects(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each split: the state that each state leads to, and whether a statement ends on the way."""
    key, now, ended = None, {}, {}

    def row():
        return pa.RecordBatch.from_pydict({"file": [key[0]], "begin": pa.array([key[1]], pa.int64()), "to": ["".join(now[s] for s in STATES)], "ends": ["".join("1" if ended[s] else "0" for s in STATES)]})

    for batch in batches:
        for file, begin, line in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if (file, begin) != key:
                if key:
                    yield row()
                key, now, ended = (file, begin), {s: s for s in STATES}, dict.fromkeys(STATES, False)
            step = {s: after(line, s) for s in set(now.values())}
            for s in STATES:
                ended[s] |= now[s] != IDLE and step[now[s]] == IDLE
                now[s] = step[now[s]]
    if key:
        yield row()


def _statements(spark: SparkSession, path: str) -> DataFrame:
    """(statement) of all files of path, without those of the session."""
    lines = spark.read.text(path).select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("begin"), "value")
    effects = sorted((r.file, r.begin, r.to, r.ends) for r in lines.mapInArrow(_effects, "file string, begin long, to string, ends string").collect())
    start, owner = {}, {}
    for k, (file, begin, to, ends) in enumerate(effects):
        if not k or effects[k - 1][0] != file:
            state, opened = IDLE, begin
        start[file, begin], owner[file, begin] = state, opened
        which = STATES.index(state)
        if state == IDLE or ends[which] == "1":
            opened = begin  # whatever is open at this split's end began in it
        state = to[which]
    shared = spark.sparkContext.broadcast((start, owner))

    def cut(batches):
        start, owner = shared.value
        key, state, held, first = None, IDLE, [], False

        def part(whole: bool):
            """A whole statement, or a piece for the split that the statement began in."""
            at = owner[key] if first else key[1]
            return pa.RecordBatch.from_pydict({"file": [key[0]], "owner": pa.array([at], pa.int64()), "begin": pa.array([key[1]], pa.int64()), "whole": [whole], "text": ["\n".join(held)]})

        for batch in batches:
            for file, begin, line in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (file, begin) != key:
                    if held:
                        yield part(False)
                    key, held = (file, begin), []
                    state = start[key]
                    first = state != IDLE
                before, state = state, after(line, state)
                if before != IDLE or not (not line.strip() or line.lstrip().startswith(("--", "/*", "#"))):
                    held.append(line)
                if state == IDLE and held:
                    yield part(not first)
                    held, first = [], False
        if held:
            yield part(False)

    parts = lines.mapInArrow(cut, "file string, owner long, begin long, whole boolean, text string")
    joined = parts.filter("NOT whole").groupBy("file", "owner").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("begin", "text"))), lambda x: x["text"]), "\n").alias("text"))
    return parts.filter("whole").select("text").union(joined.select("text")).filter(~F.col("text").rlike(r"(?i)^\s*(PRAGMA|BEGIN|END|COMMIT|SET|LOCK|UNLOCK|USE|DROP)\b"))


def mysql_table(spark: SparkSession, path: str, table: str, schema: str) -> DataFrame:
    """A table of a MySQL dump, plain (split) or gz (one task a file); values are cast to schema, columns that the dump lacks are null.  Repeated unique keys are dropped by keep_first() downstream."""
    found = _statements(spark, path)
    made = found.filter(F.col("text").rlike(rf"(?i)^\s*CREATE TABLE (IF NOT EXISTS )?{_name(table)}\s*\(")).first()
    known, fields = columns_of(made.text) if made else [], spark.createDataFrame([], schema).schema.fields
    names = [f.name for f in fields]

    def parse(batches):
        for batch in batches:
            for text in batch.column(0).to_pylist():
                rows = list(insert_rows(text, table, known, names))
                for at in range(0, len(rows), 2000):
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in zip(*rows[at : at + 2000], strict=True)], names)

    rows = found.mapInArrow(parse, ", ".join(f"`{n}` string" for n in names))
    return rows.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in fields])
