"""Column lineage, read off the analysed plan.

``sources_of`` follows every output column through the named expressions of the
plan to the columns of the relations at its leaves.  Only the plan is walked; no
job runs.  A count of rows reads no column: its sources are the relations below
the aggregate, as ``table.*``.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame


def _items(seq) -> Iterator:
    it = seq.iterator()
    while it.hasNext():
        yield it.next()


def _kind(node) -> str:
    return node.getClass().getSimpleName()


def _table(leaf) -> str:
    if _kind(leaf) != "LogicalRelation":
        return _kind(leaf)
    paths = [str(p.toString()) for p in _items(leaf.relation().location().rootPaths())]
    return paths[0].rstrip("/").rsplit("/", 1)[-1].removesuffix(".parquet") if paths else "relation"


def _id(attribute) -> int:
    return attribute.exprId().id()


def sources_of(df: DataFrame) -> dict[str, list[str]]:
    """``{column: ["table.column", ...]}`` for the columns of ``df``."""
    plan = df._jdf.queryExecution().analyzed()
    made: dict[int, set[int]] = {}              # named expression -> attributes it reads
    rows: dict[int, set[str]] = {}              # named expression without columns -> tables
    leaves: dict[int, str] = {}

    def walk(node) -> set[str]:
        below: set[str] = set()
        children = list(_items(node.children()))
        for child in children:
            below |= walk(child)
        if not children:
            table = _table(node)
            for attribute in _items(node.output()):
                leaves[_id(attribute)] = f"{table}.{attribute.name()}"
            return {table}
        for expression in _items(node.expressions()):
            for named in aliases(expression):
                refs = {_id(a) for a in _items(named.references().toSeq())}
                made.setdefault(_id(named), set()).update(refs)
                if not refs and "count(" in named.child().toString().lower():
                    rows[_id(named)] = {f"{t}.*" for t in below}
        if _kind(node) == "Union":
            out = list(_items(node.output()))
            for child in children:
                for o, c in zip(out, _items(child.output())):
                    if _id(o) != _id(c):
                        made.setdefault(_id(o), set()).add(_id(c))
        return below

    def aliases(expression) -> Iterator:
        if _kind(expression) == "Alias":
            yield expression
        else:
            for child in _items(expression.children()):
                yield from aliases(child)

    walk(plan)
    out = {}
    for attribute in _items(plan.output()):
        found, seen, todo = set(), set(), [_id(attribute)]
        while todo:
            i = todo.pop()
            if i in seen:
                continue
            seen.add(i)
            found |= rows.get(i, set())
            if i in leaves:
                found.add(leaves[i])
            todo += made.get(i, ())
        out[attribute.name()] = sorted(found)
    return out
