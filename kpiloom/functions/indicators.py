"""The three indicator kinds and NULL-safe ratios.

The kinds differ only in what an unmet predicate yields, and that decides
whether a cohort sum over nobody is 0 or NULL:

* ``flag``          CASE WHEN p THEN 1 ELSE 0   -> sum over no match is 0
* ``flag_or_null``  CASE WHEN p THEN 1 [ELSE NULL] -> sum over no match is NULL
* ``weighted``      IF(p, x, NULL)             -> sum of x where p, else NULL

A predicate that is NULL (three-valued logic) is "not true" in all of them.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def flag(pred: Column) -> Column:
    return F.when(pred, F.lit(1)).otherwise(F.lit(0))


def flag_or_null(pred: Column) -> Column:
    return F.when(pred, F.lit(1))


def weighted(pred: Column, weight) -> Column:
    return F.when(pred, _c(weight))


def ratio(num, den) -> Column:
    """num / den as double, NULL when den is 0 or NULL (never raises)."""
    return F.try_divide(_c(num).cast("double"), _c(den).cast("double"))


def three_state(num, den, threshold: float) -> Column:
    """NULL when the denominator is 0, else 1 if num/den >= threshold, else 0.

    A NULL denominator is not "= 0", and its ratio is NULL, so it falls to 0.
    """
    d = _c(den)
    return (F.when(d == 0, F.lit(None).cast("int"))
            .when(ratio(num, den) >= threshold, F.lit(1))
            .otherwise(F.lit(0)))


def ratio_at_most(num, den, threshold: float) -> Column:
    """Per-row quotient test ``num/den <= threshold``; zero divisor -> NULL."""
    return ratio(num, den) <= threshold


def like_any(col, patterns: Iterable[str]) -> Column:
    c = _c(col)
    out = None
    for p in patterns:
        term = c.like(p)
        out = term if out is None else (out | term)
    return out if out is not None else F.lit(False)


def like_none(col, patterns: Iterable[str]) -> Column:
    """AND of NOT LIKE; a NULL value is not "not like" anything (drops)."""
    c = _c(col)
    out = None
    for p in patterns:
        term = ~c.like(p)
        out = term if out is None else (out & term)
    return out if out is not None else F.lit(True)
