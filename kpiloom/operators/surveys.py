"""Survey operators: K09 distinct entities, K10 NPS, K11 Likert agreement,
K29 survey completion."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from kpiloom.functions.indicators import flag
from kpiloom.operators.cohort import CohortSpec, sum_long


def distinct_entity_count(df: DataFrame, entity: str, cohort: CohortSpec, name: str,
                          pred: Column | None = None,
                          extra: Mapping[str, Column] | None = None) -> DataFrame:
    """Distinct entities per cell after a qualifying filter.

    Spark plans one distinct column as two aggregates (by cell+entity, then
    by cell), both with map-side partial aggregation; when the input is
    already hash-partitioned by the entity (e.g. after a join on it) the
    first one needs no shuffle.  ``extra`` adds plain aggregates to the
    same pass (e.g. the non-distinct row count).
    """
    src = df if pred is None else df.filter(pred)
    aggs = [F.count_distinct(F.col(entity)).alias(name)]
    aggs += [e.alias(n) for n, e in (extra or {}).items()]
    return src.groupBy(*cohort.dims).agg(*aggs)


def nps_flags(answer: Column, promoters: Sequence[str], passives: Sequence[str]) -> dict[str, Column]:
    """promoter = answer in promoters; detractor = answer not in
    promoters or passives.  A NULL answer is neither (falls to ELSE 0)."""
    return {
        "promoter": flag(answer.isin(*promoters)),
        "detractor": flag(~answer.isin(*promoters, *passives)),
    }


def nps_score(promoters: str, detractors: str, respondents: str) -> Column:
    """100 * (promoters - detractors) / respondents, NULL with no respondent."""
    return F.try_divide(F.lit(100.0) * (F.col(promoters) - F.col(detractors)),
                        F.col(respondents).cast("double"))


def agree(answer: Column, agree_set: Sequence[str]) -> Column:
    """Exact match against an agree-set (labels, translations and misspelt
    variants are all listed explicitly)."""
    return answer.isin(*agree_set)


def likert_agree(questions: Mapping[str, Sequence[str]], mode: str = "one") -> Column:
    """0/1 agreement over one question, all (AND) or any (OR) of several.

    ``questions`` maps an answer column name to its agree-set.
    """
    terms = [agree(F.col(q), s) for q, s in questions.items()]
    if mode == "one":
        if len(terms) != 1:
            raise ValueError("mode='one' takes exactly one question")
        return flag(terms[0])
    out = terms[0]
    for t in terms[1:]:
        out = (out & t) if mode == "all" else (out | t)
    if mode not in ("all", "any"):
        raise ValueError("mode must be one, all or any")
    return flag(out)


def survey_completion(completion: DataFrame, cohort: CohortSpec,
                      sums: Mapping[str, str]) -> DataFrame:
    """Sum pre-counted survey totals per cell (``{out: in_column}``)."""
    return completion.groupBy(*cohort.dims).agg(*[sum_long(c).alias(o) for o, c in sums.items()])
