"""Deletes that cascade along declared keys, as semi joins.

Tables are linked by keys (child, column, parent): a child's row lives only while the row of its parent
with that id does.  A rule says what a parent's rows need: for each of its needs, one of the
named columns must refer to them.  Pruning applies the rules in their order and cascades after
each, once, as a sequence of deletes does, or again until nothing more goes.

With `by` columns (such as a split) the tables are pruned for all their values at once: a table without
them gets them from the first parent that has them.
"""

from __future__ import annotations

import functools
from collections.abc import Sequence
from dataclasses import dataclass
from graphlib import TopologicalSorter

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pairloom.operators.keys import saved

Key = tuple[str, str, str]


@dataclass(frozen=True)
class Rule:
    """Rows of parent stay if each of needs, a tuple of (child, column), has a row that refers to them."""

    parent: str
    needs: tuple[tuple[tuple[str, str], ...], ...]


def _kept(rows: DataFrame, ids: DataFrame, column: str, by: Sequence[str]) -> DataFrame:
    """rows whose column is an id of ids (id, by columns); rows without one of the by columns get it."""
    shared = [c for c in by if c in ids.columns and c in rows.columns]
    gained = [c for c in by if c in ids.columns and c not in rows.columns]
    return rows.join(ids.withColumnRenamed("id", column), [column, *shared], "inner" if gained else "left_semi").select(*rows.columns, *gained)


def cascade(tables: dict[str, DataFrame], keys: Sequence[Key], changed: Sequence[str], by: Sequence[str] = ()) -> dict[str, DataFrame]:
    """tables after the rows of changed tables went: all that refer to them, directly or through others, keep the rows whose parents are left.  A null reference has no parent.  Keys must not form a circle."""
    out, touched = dict(tables), set(changed)
    order = TopologicalSorter({t: {p for c, _, p in keys if c == t and p != t} for t in tables}).static_order()
    for child in order:
        for _, column, parent in (k for k in keys if k[0] == child and k[2] in touched):
            ids = out[parent].select("id", *[c for c in by if c in out[parent].columns])
            out[child] = _kept(out[child], ids, column, by)
            touched.add(child)
    return out


def referred(tables: dict[str, DataFrame], columns: Sequence[tuple[str, str]], by: Sequence[str] = ()) -> DataFrame:
    """Distinct (id, by columns) that any of the columns (child, column) has."""
    parts = []
    for child in dict.fromkeys(c for c, _ in columns):
        own = [c for c in by if c in tables[child].columns]
        parts.append(tables[child].select(*own, F.explode(F.array(*[column for c, column in columns if c == child])).alias("id")).select("id", *own))
    return functools.reduce(DataFrame.unionByName, parts).filter("id is not null").distinct()


def prune(tables: dict[str, DataFrame], keys: Sequence[Key], rules: Sequence[Rule], by: Sequence[str] = (), fixpoint: bool = False) -> dict[str, DataFrame]:
    """tables after the rules, once, or until no rule takes a row; then each round is written and cut off from the one before."""
    parents, last = {r.parent for r in rules}, None
    while True:
        for rule in rules:
            rows = tables[rule.parent]
            for need in rule.needs:
                rows = _kept(rows, referred(tables, need, by), "id", by)
            tables = cascade(tables | {rule.parent: rows}, keys, [rule.parent], by)
        if not fixpoint:
            return tables
        linked = parents | {c for c, _, p in keys if p in parents}
        tables = tables | {name: saved(tables[name]) for name in linked}
        # rows only go, so equal counts mean equal tables
        now = {name: tables[name].count() for name in linked}
        if now == last:
            return tables
        last = now
