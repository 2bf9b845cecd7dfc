"""Parent/child operators: K06 existence flags, K07 child-count thresholds,
K15 membership semi-joins, K25 any-flags over an activity table."""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpiloom.functions.indicators import flag


def existence_flags(parents: DataFrame, parent_key: str, children: DataFrame,
                    child_key: str, flags: Mapping[str, Column]) -> DataFrame:
    """One 0/1 column per predicate: does the parent have a child with p?

    The reference runs one correlated subquery per flag; here the child is
    scanned once and reduced, before the shuffle, to one row per key with MAX
    per flag, and one left join attaches them.  Parents without such children
    get 0.  No filter on any of the predicates comes first: it would evaluate
    them all twice, in one method too large for the JVM to compile.
    """
    names = list(flags)
    per_child = (children.groupBy(F.col(child_key).alias("__fk"))
                 .agg(*[F.max(flag(p)).alias(n) for n, p in flags.items()]))
    out = parents.join(per_child, parents[parent_key] == per_child["__fk"], "left").drop("__fk")
    return out.fillna(0, subset=names)


def child_counts(parents: DataFrame, parent_key: str, children: DataFrame, child_key: str,
                 counts: Mapping[str, Column | None]) -> DataFrame:
    """Conditional child counts per parent (``None`` counts every child).

    Parents without children are kept, with counts 0.
    """
    aggs = [(F.count(F.lit(1)) if p is None else F.sum(flag(p))).cast("bigint").alias(n)
            for n, p in counts.items()]
    per_child = children.groupBy(F.col(child_key).alias("__fk")).agg(*aggs)
    out = parents.join(per_child, parents[parent_key] == per_child["__fk"], "left").drop("__fk")
    return out.fillna(0, subset=list(counts))


def child_count_threshold(parents: DataFrame, parent_key: str, children: DataFrame,
                          child_key: str, counts: Mapping[str, Column | None],
                          rule: Callable[..., Column], name: str) -> DataFrame:
    """Flag parents whose conditional child counts satisfy ``rule``.

    ``rule`` receives the count columns as keyword arguments, e.g.
    ``lambda any_app, affordable: (any_app >= 6) & (affordable >= 3)``.
    """
    out = child_counts(parents, parent_key, children, child_key, counts)
    cond = rule(**{n: F.col(n) for n in counts})
    return out.withColumn(name, flag(cond))


def members(df: DataFrame, key: str, pred: Column | None = None) -> DataFrame:
    """Key set of a filtered table (the ``IN (SELECT key …)`` subquery)."""
    src = df if pred is None else df.filter(pred)
    return src.select(F.col(key).alias("__member"))


def restrict_to_members(facts: DataFrame, fact_key: str, member_keys: DataFrame) -> DataFrame:
    """Facts whose key is in the member set — a left semi join.

    Semi join never multiplies fact rows, so the member set need not be
    deduplicated; AQE broadcasts it when it is small and otherwise shuffles
    both sides on the key.
    """
    return facts.join(member_keys, facts[fact_key] == member_keys["__member"], "left_semi")


def activity_flags_any(activities: DataFrame, entity: str, flags: Mapping[str, Column],
                       keep: tuple[str, ...] = ()) -> DataFrame:
    """Per entity (and ``keep`` columns), MAX of each 0/1 flag over its
    activity rows."""
    return activities.groupBy(entity, *keep).agg(*[F.max(flag(p)).alias(n) for n, p in flags.items()])
