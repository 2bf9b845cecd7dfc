"""Period operators: K08 growth, K12 retention, K13 persistence, K14 exact
period presence, K16 as-of switch, K17 open-records snapshot, K20 distinct
population."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kpiloom.functions.indicators import flag
from kpiloom.operators.cohort import CohortSpec, sum_long


def _date(d) -> dt.date:
    return d if isinstance(d, dt.date) else dt.date.fromisoformat(str(d))


def score_growth(scores: DataFrame, entity: str, period: str, score: Column,
                 cohort: CohortSpec, grew: str = "grew", pairs: str = "pairs",
                 extra: Sequence[str] = ()) -> DataFrame:
    """MIN score per (entity, cell, period), growth = x - lag(x).

    The window runs over each entity's periods ordered by ``period`` (a
    label that sorts chronologically, or a term start date).
    The first period has no predecessor and is dropped; so is any growth
    that is NULL because a score is.  Per cell: ``grew`` = growth > 0,
    ``pairs`` = number of growth pairs.  Ties (same entity and period in two
    cells) are ordered by the cell key to keep the result deterministic.

    ``extra`` columns join the MIN's group key (e.g. a term name next to its
    start date) and break ties after the cell.

    Scale: the MIN aggregate runs first (partial + final), so each window
    partition holds one row per period of one entity, whatever the input.
    """
    keys = [entity, *cohort.dims, period, *extra]
    per = scores.groupBy(*keys).agg(F.min(score).alias("__score"))
    w = Window.partitionBy(entity).orderBy(F.col(period), *cohort.cols, *[F.col(e) for e in extra])
    growth = per.withColumn("__growth", F.col("__score") - F.lag("__score").over(w))
    growth = growth.filter(F.col("__growth").isNotNull())
    return growth.groupBy(*cohort.dims).agg(sum_long(flag(F.col("__growth") > 0)).alias(grew),
                                            F.count(F.col(entity)).alias(pairs))


def retention_rows(activity: DataFrame, entity: str, active: Column, cohort: CohortSpec,
                   extra: Sequence[str] = ()) -> DataFrame:
    """Distinct (entity, cell, extra..., ``active``) tuples behind K12."""
    return activity.select(entity, *cohort.dims, *extra, flag(active).alias("active")).distinct()


def retention(activity: DataFrame, entity: str, active: Column, cohort: CohortSpec,
              denom: str = "retention_denom", num: str = "retention_num",
              extra: Sequence[str] = ()) -> DataFrame:
    """Distinct (entity, cell, active, extra...) tuples, then per cell
    the count and the number still active.

    An entity in two sites (``extra``) counts twice, as in the reference.
    """
    rows = retention_rows(activity, entity, active, cohort, extra)
    return rows.groupBy(*cohort.dims).agg(F.count(F.col(entity)).alias(denom),
                                          sum_long("active").alias(num))


def persistence_entities(terms: DataFrame, entity: str, base: Column, group_pred: Column,
                         later: Column, persisted_pred: Column, cohort: CohortSpec,
                         site: str | None = None, denom: str = "persist_denom",
                         num: str = "persist_num") -> DataFrame:
    """K13 at entity grain: one row per (entity, cell) of the reporting group
    with ``denom`` = 1 and ``num`` = 1 if persisted (at any site), else 0.

    * reporting group: entity has a base-period row with ``group_pred``;
    * per (entity, cell, site) over later rows: count(all) vs count(qualifying);
    * persisted at any site is enough (MAX); entities without later rows
      never enter.

    One pass: a single conditional aggregate per (entity, cell, site) carries
    both the base flag and the later-row counts; the entity's group flag is
    a window MAX over its (few) groups — no second scan, no join.
    """
    site_keys = [site] if site and site not in cohort.dims else []
    # without an entity there is nobody to persist (NULLs must not pool)
    per = terms.filter((base | later) & F.col(entity).isNotNull()).groupBy(entity, *cohort.dims, *site_keys).agg(
        F.max(F.when(base, flag(group_pred))).alias("__base"),
        F.sum(flag(later)).alias("__n"),
        F.sum(flag(later & persisted_pred)).alias("__k"))
    in_group = F.max("__base").over(Window.partitionBy(entity))
    per = per.withColumn("__in_group", in_group).filter((F.col("__in_group") == 1) & (F.col("__n") > 0))
    return per.groupBy(entity, *cohort.dims).agg(
        F.max(F.col("__in_group")).alias(denom),
        F.max(flag(F.col("__n") == F.col("__k"))).alias(num))


def persistence(terms: DataFrame, entity: str, base: Column, group_pred: Column,
                later: Column, persisted_pred: Column, cohort: CohortSpec,
                site: str | None = None, denom: str = "persist_denom",
                num: str = "persist_num") -> DataFrame:
    """Persisted iff every later period row qualifies; per cell the
    reporting-group size and the number persisted."""
    ent = persistence_entities(terms, entity, base, group_pred, later, persisted_pred, cohort,
                               site, denom, num)
    return ent.groupBy(*cohort.dims).agg(sum_long(denom).alias(denom), sum_long(num).alias(num))


def period_presence_entities(terms: DataFrame, entity: str, pred: Column, periods: Column,
                             k: int, keep: Sequence[str] = ()) -> DataFrame:
    """Entities (with ``keep`` columns) having exactly ``k`` qualifying rows
    over the named periods — one partial+final aggregate by entity."""
    per = terms.filter(pred & periods).groupBy(entity, *keep).agg(F.count(F.lit(1)).alias("__n"))
    return per.filter(F.col("__n") == k).drop("__n")


def exact_period_presence(terms: DataFrame, entity: str, pred: Column, periods: Column,
                          k: int, cohort: CohortSpec, name: str) -> DataFrame:
    """Entities with exactly ``k`` qualifying rows over the named periods."""
    ents = period_presence_entities(terms, entity, pred, periods, k, cohort.dims)
    return ents.groupBy(*cohort.dims).agg(F.count(F.col(entity)).alias(name))


def as_of_switch(as_of, cutoff, current: Column, previous: Column,
                 inclusive: bool = False) -> Column:
    """Before the cut-off use the current period, after it the previous.

    ``as_of`` is a parameter, never ``current_date()``, so reruns are
    reproducible; the branch is chosen here and the plan keeps one filter.
    On the cut-off day itself no row qualifies unless ``inclusive`` (then
    the day counts as "after").
    """
    a, c = _date(as_of), _date(cutoff)
    if a < c:
        return current
    if a > c or inclusive:
        return previous
    return F.lit(False)


def open_before(date_col: Column, as_of, year_aware: bool = False) -> Column:
    """K17 date test: literal month-of-year comparison (ignores the year,
    so nothing qualifies in January) or, ``year_aware``, strictly before the
    first day of the as-of month."""
    a = _date(as_of)
    if year_aware:
        return F.to_date(date_col) < F.lit(a.replace(day=1))
    return F.month(date_col) < F.lit(a.month)


def distinct_population(terms: DataFrame, entity: str, cols: Sequence[str],
                        cohort: CohortSpec, status: Column, denom: str, num: str) -> DataFrame:
    """DISTINCT (entity, cell, cols) tuples counted per cell, with a
    status flag summed over the same population."""
    tuples = terms.select(entity, *cohort.with_extra(*cols)).distinct()
    return tuples.groupBy(*cohort.dims).agg(F.count(F.col(entity)).alias(denom),
                                            sum_long(flag(status)).alias(num))
