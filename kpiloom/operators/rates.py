"""Denominators and rates: K03 shared denominators, K04/K26 rate flags,
K05 three-state rates, K19 average support per entity."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpiloom.functions.indicators import ratio, three_state, weighted
from kpiloom.operators.cohort import CohortSpec, cohort_agg, sum_long


def count_cube(df: DataFrame, keys: Sequence[str], entity: str, name: str = "student_count") -> DataFrame:
    """Fine-grain count cube: ``COUNT(entity)`` per combination of ``keys``.

    It is the reusable pre-aggregate behind shared denominators; it has at
    most one row per distinct key combination, whatever the entity count.
    """
    return df.groupBy(*keys).agg(F.count(F.col(entity)).alias(name))


def shared_denominators(df: DataFrame, cohort: CohortSpec, preds: Mapping[str, Column],
                        weight: str | None = None, entity: str | None = None) -> DataFrame:
    """``SUM(IF(p, n, NULL))`` per cell — NULL (not 0) when no row has p.

    Over a count cube pass ``weight`` (the count column); over raw entity
    rows pass ``entity`` (each non-null entity counts 1, a NULL one 0, as
    ``COUNT`` would).  Both give the same numbers: a predicate that depends
    only on cube keys is true for a cube cell exactly when it is true for
    that cell's rows.
    """
    if (weight is None) == (entity is None):
        raise ValueError("pass exactly one of weight= or entity=")
    w = F.col(weight) if weight else F.when(F.col(entity).isNotNull(), 1).otherwise(0)
    return cohort_agg(df, cohort, {n: sum_long(weighted(p, w)) for n, p in preds.items()})


def period_weights(periods: DataFrame, period_col: str, name: str = "__w") -> DataFrame:
    """Rows per period of an (already filtered) period table.

    Bounded by the number of distinct periods (terms), not by the data.
    """
    return periods.groupBy(period_col).agg(F.count(F.lit(1)).alias(name))


def entity_rate(facts: DataFrame, entity: str, num: Column, den: Column,
                period: str | None = None, weights: DataFrame | None = None,
                keep: Sequence[str] = ()) -> DataFrame:
    """Σnum / Σden per entity (``rate`` NULL when Σden is 0 or NULL).

    With ``weights`` (columns ``period``, ``__w``) the sums are weighted by
    the rows the period has in a period table.  That is what joining every
    fact to all period rows of its period (a many-to-many join on the period
    id alone) computes, without materialising the join: facts are summed per
    (entity, period) first and one weight per period multiplies each sum.
    Periods without a weight row are dropped, as the inner join would.
    """
    keys = [entity, *keep]
    if weights is None:
        agg = facts.groupBy(*keys).agg(F.sum(num).alias("num_sum"), F.sum(den).alias("den_sum"))
    else:
        per = facts.groupBy(*keys, period).agg(F.sum(num).alias("__n"), F.sum(den).alias("__d"))
        per = per.join(weights, period, "inner")
        agg = per.groupBy(*keys).agg(F.sum(F.col("__n") * F.col("__w")).alias("num_sum"),
                                     F.sum(F.col("__d") * F.col("__w")).alias("den_sum"))
    return agg.withColumn("rate", ratio("num_sum", "den_sum"))


def rate_flag(facts: DataFrame, entity: str, num: Column, den: Column, threshold: float,
              name: str, period: str | None = None, weights: DataFrame | None = None,
              keep: Sequence[str] = ()) -> DataFrame:
    """Per entity ``rate`` and ``name`` = 1 if rate >= threshold else 0.

    A NULL rate (no denominator) gives 0, like ``CASE … ELSE 0``.
    """
    r = entity_rate(facts, entity, num, den, period, weights, keep)
    return r.withColumn(name, F.when(F.col("rate") >= threshold, 1).otherwise(0))


def three_state_rate(df: DataFrame, num: str, den: str, threshold: float, name: str) -> DataFrame:
    """NULL when the denominator is 0, else 1/0 against ``threshold``."""
    return df.withColumn(name, three_state(num, den, threshold))


def average_support(sessions: DataFrame, notes: DataFrame, need: DataFrame,
                    cohort: CohortSpec, site: str, grain: str = "cohort",
                    sessions_col: str = "sessions", notes_col: str = "notes",
                    need_col: str = "need_count") -> DataFrame:
    """Σ(sessions + notes) per cell / number of entities in need.

    Inputs are cohort-grain tables.  ``sessions`` drives (a cell needs
    sessions to get a value) and ``need`` must hold a non-NULL count (inner).

    ``grain="cohort"`` joins notes on the full cell, missing notes count 0.
    ``grain="site"`` reproduces joining notes on the site alone: each
    sessions cell pairs with every notes cell of its site, so its total is
    ``k·sessions + Σnotes`` over the site's k notes cells, NULL when the site
    has none — computed from one per-site row instead of the fan-out.
    """
    dims = list(cohort.dims)
    if grain == "cohort":
        joined = sessions.join(notes.select(*dims, notes_col), dims, "left")
        support = F.col(sessions_col) + F.coalesce(F.col(notes_col), F.lit(0))
    elif grain == "site":
        per_site = notes.groupBy(site).agg(F.count(F.lit(1)).alias("__k"),
                                           F.sum(notes_col).alias("__s"))
        joined = sessions.join(per_site, site, "left")
        support = F.col("__k") * F.col(sessions_col) + F.col("__s")
    else:
        raise ValueError("grain must be 'cohort' or 'site'")
    totals = joined.select(*dims, support.alias("support_total"))
    needy = need.filter(F.col(need_col).isNotNull()).select(*dims, need_col)
    out = totals.join(needy, dims, "inner")
    return out.withColumn("avg_support", ratio("support_total", need_col))


def split_population(entities: DataFrame, numerators: DataFrame, keys: Sequence[str],
                     cohort: CohortSpec, aggs: Mapping[str, Column]) -> DataFrame:
    """Denominators from the entity table, numerators from a period
    table, joined per entity *and* dimensions (plain ``=``, so an entity whose
    dimension is NULL gets no numerator), then summed per cell."""
    return cohort_agg(entities.join(numerators, list(keys), "left"), cohort, aggs)
