"""Cohort cells, cohort aggregation, the spine, wide assembly and roll-up.

A cohort cell is a tuple of dimension values (site, ethnicity, gender in the
reference).  Every KPI table is unique on the cell and carries integer
numerators/denominators; ratios are formed only at display grain
(``ratio_rollup``), never averaged.
"""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpiloom.functions.indicators import flag, ratio


@dataclass(frozen=True)
class CohortSpec:
    """Group key of every KPI table, plus the roll-up hierarchy.

    ``hierarchy`` lists the coarse-to-fine display levels (e.g. region, site);
    the finest level must be one of ``dims``.
    """

    dims: tuple[str, ...]
    hierarchy: tuple[str, ...] = ()

    def __post_init__(self) -> None:
        if len(set(self.dims)) != len(self.dims):
            raise ValueError(f"duplicate cohort dims {self.dims}")

    @property
    def cols(self) -> list[Column]:
        return [F.col(d) for d in self.dims]

    def with_extra(self, *extra: str) -> tuple[str, ...]:
        return tuple(self.dims) + tuple(e for e in extra if e not in self.dims)


def cohort_agg(df: DataFrame, cohort: CohortSpec, aggs: Mapping[str, Column],
               extra_keys: Sequence[str] = ()) -> DataFrame:
    """One grouped pass: every metric of the table in a single ``agg``.

    Spark plans a partial (map-side) aggregate before the shuffle, so a cell
    that holds a third of the rows is combined on every task first.
    """
    keys = list(cohort.with_extra(*extra_keys))
    return df.groupBy(*keys).agg(*[expr.alias(name) for name, expr in aggs.items()])


def sum_long(col) -> Column:
    c = F.col(col) if isinstance(col, str) else col
    return F.sum(c).cast("bigint")


def indicator_cohort_sum(df: DataFrame, cohort: CohortSpec, flags: Mapping[str, Column],
                         count: tuple[str, str] | None = None,
                         extra_keys: Sequence[str] = ()) -> DataFrame:
    """Many 0/1 indicators (``ELSE 0`` kind) summed per cell in one pass.

    ``count=(name, column)`` adds ``COUNT(column)`` (non-null) beside them.
    """
    aggs: dict[str, Column] = {}
    if count is not None:
        aggs[count[0]] = F.count(F.col(count[1]))
    for name, pred in flags.items():
        aggs[name] = sum_long(flag(pred))
    return cohort_agg(df, cohort, aggs, extra_keys)


def spine(df: DataFrame, cohort: CohortSpec, extra: Sequence[str] = ()) -> DataFrame:
    """The distinct cells every KPI table is left-joined to."""
    return df.select(*cohort.with_extra(*extra)).distinct()


def _check_disjoint(frames: Sequence[DataFrame], keys: Iterable[str]) -> None:
    seen: dict[str, int] = {}
    keyset = {k.lower() for k in keys}
    for i, f in enumerate(frames):
        for c in f.columns:
            lc = c.lower()
            if lc in keyset:
                continue
            if lc in seen:
                raise ValueError(f"column {c!r} appears in table {seen[lc]} and table {i}")
            seen[lc] = i


def assert_unique(tables: Sequence[DataFrame], keys: Sequence[str]) -> None:
    """Action: fail if ``keys`` repeat in a table (a duplicate would fan out the
    join); one job for all of them."""
    if not tables:
        return
    cells = reduce(DataFrame.unionByName, [t.select(F.lit(i).alias("__table"), *keys) for i, t in enumerate(tables)])
    dup = cells.groupBy("__table", *keys).count().filter(F.col("count") > 1).select("__table").first()
    if dup:
        columns = [c for c in tables[dup[0]].columns if c not in keys]
        raise ValueError(f"the table with {columns} is not unique on {list(keys)}")


def assemble(spine_df: DataFrame, tables: Sequence[DataFrame], cohort: CohortSpec,
             null_safe: bool = False, check_unique: bool = False,
             method: str = "joins") -> DataFrame:
    """Left-join KPI tables onto the spine on the cohort key.

    Plain ``=`` by default, as in the reference: a cell with a NULL dimension
    never matches and gets NULL metrics.  ``null_safe=True`` uses ``<=>``.
    Column names must be disjoint apart from the keys (checked on the schema,
    no job).  Each KPI table is cohort-grain (bounded by the number of cells),
    so AQE turns these joins into broadcast hash joins at runtime; nothing is
    broadcast on a guess.

    ``method="union"`` is the one-shuffle alternative for many tables: all
    tables are stacked (``unionByName``, missing columns NULL), reduced to one
    row per cell with MAX per metric, and joined onto the spine once.  Rows
    with a NULL key are dropped first under plain ``=`` (they could never
    match), so both methods give the same table.
    """
    keys = list(cohort.dims)
    _check_disjoint([spine_df, *tables], keys)
    if check_unique:
        assert_unique(tables, keys)
    if method == "union":
        return _assemble_union(spine_df, tables, keys, null_safe)
    if method != "joins":
        raise ValueError("method must be 'joins' or 'union'")
    out = spine_df
    for i, t in enumerate(tables):
        if null_safe:
            renamed = t.withColumnsRenamed({k: f"__k{i}_{k}" for k in keys})
            cond = None
            for k in keys:
                term = F.col(k).eqNullSafe(F.col(f"__k{i}_{k}"))
                cond = term if cond is None else cond & term
            out = out.join(renamed, cond, "left").drop(*[f"__k{i}_{k}" for k in keys])
        else:
            out = out.join(t, keys, "left")
    return out


def _assemble_union(spine_df: DataFrame, tables: Sequence[DataFrame], keys: list[str],
                    null_safe: bool) -> DataFrame:
    metrics = [c for t in tables for c in t.columns if c not in keys]
    stacked = None
    for t in tables:
        if not null_safe:
            known = None
            for k in keys:
                known = F.col(k).isNotNull() if known is None else known & F.col(k).isNotNull()
            t = t.filter(known)
        stacked = t if stacked is None else stacked.unionByName(t, allowMissingColumns=True)
    merged = stacked.groupBy(*keys).agg(*[F.max(c).alias(c) for c in metrics])
    if null_safe:
        renamed = merged.withColumnsRenamed({k: f"__u_{k}" for k in keys})
        cond = None
        for k in keys:
            term = F.col(k).eqNullSafe(F.col(f"__u_{k}"))
            cond = term if cond is None else cond & term
        return spine_df.join(renamed, cond, "left").drop(*[f"__u_{k}" for k in keys])
    return spine_df.join(merged, keys, "left")


def reconcile(spine_df: DataFrame, tables: Mapping[str, DataFrame], cohort: CohortSpec) -> DataFrame:
    """What ``assemble`` under plain ``=`` takes of each table: its cells, those
    that match a cell of the spine, and why the others are lost (a NULL in the
    key, or no such cell).  One pass over all tables, one join with the spine."""
    keys = list(cohort.dims)
    known = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    cells = reduce(DataFrame.unionByName, [t.select(*keys, F.lit(n).alias("table_name")) for n, t in tables.items()])
    there = spine_df.select(*keys).distinct().withColumn("__there", F.lit(True))
    joined = cells.join(there, keys, "left")
    return joined.groupBy("table_name").agg(
        F.count(F.lit(1)).alias("cells"), sum_long(flag(~known)).alias("null_key_cells"),
        sum_long(flag(F.col("__there"))).alias("matched_cells"), sum_long(flag(known & F.col("__there").isNull())).alias("absent_cells"))


def ratio_rollup(df: DataFrame, metrics: Mapping[str, tuple[str, str]],
                 levels: Sequence[str], top_label: str = "National",
                 level_names: Sequence[str] | None = None,
                 carry: Mapping[str, str] | None = None) -> DataFrame:
    """Σnum/Σden at every level of the hierarchy, never an average of ratios.

    ``levels`` is coarse-to-fine (e.g. ``["r_name", "n_name"]``).  Output has a
    ``level`` column (``top_label`` or the level's name), the level columns
    (NULL above their own level), and for each metric ``<m>_num``,
    ``<m>_den`` and ``<m>_ratio``.  One shuffle (``Expand`` + hash aggregate).
    ``carry`` maps an attribute to the level it belongs to: its greatest value
    there, NULL on the levels above.
    """
    names = list(level_names or levels)
    aggs = []
    for m, (num, den) in metrics.items():
        aggs += [sum_long(num).alias(f"{m}_num"), sum_long(den).alias(f"{m}_den")]
    for c, l in (carry or {}).items():
        aggs.append(F.when(F.grouping(l) == 0, F.max(c)).alias(c))
    grouped = df.rollup(*levels).agg(*aggs, *[F.grouping(l).alias(f"__g_{l}") for l in levels])
    level = F.lit(top_label)
    for l, n in zip(levels, names):
        level = F.when(F.col(f"__g_{l}") == 0, F.lit(n)).otherwise(level)
    out = grouped.withColumns({"level": level, **{
        f"{m}_ratio": F.round(ratio(f"{m}_num", f"{m}_den"), 6) for m in metrics}})
    return out.drop(*[f"__g_{l}" for l in levels])


def attribute_carry(entities: DataFrame, units: DataFrame, entity_unit_key: str,
                    unit_key: str, attr: str, cohort: CohortSpec,
                    count: tuple[str, str], carried: str) -> DataFrame:
    """Count entities per cell and carry a unit attribute with MAX.

    ``units`` may hold several rows per unit; the greatest value is its
    attribute.  Entities are counted per (cell, unit) first; the join then
    sees one row per (cell, unit) and one per unit.
    """
    units = units.groupBy(unit_key).agg(F.max(attr).alias(attr))
    per_unit = entities.groupBy(*cohort.dims, entity_unit_key).agg(
        F.count(F.col(count[1])).alias("__n"))
    joined = per_unit.join(units,
                           per_unit[entity_unit_key] == units[unit_key], "left")
    return joined.groupBy(*cohort.dims).agg(
        F.sum("__n").cast("bigint").alias(count[0]), F.max(attr).alias(carried))
