"""Each twin query tells its operator from a wrong one: with the wrong version
put in, the comparison with the oracle fails."""

import duckdb
import pytest
from pyspark.sql import functions as F

from check_oracle import rows_of
from kpiloom.operators import cohort, periods, surveys
from kpiloom.plans import commerce as Q
from kpiloom.plans.commerce_sql import SQL
from tests.conftest import SF01

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


class Swapped:
    """The functions module with some names replaced."""

    def __init__(self, **names):
        self.names = names

    def __getattr__(self, name):
        return self.names.get(name) or getattr(F, name)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF01}/{t}.parquet')")
    return con


def agrees(spark, duck, name):
    df = Q.QUERIES[name](spark, SF01)
    result = duck.execute(SQL[name])
    return rows_of(df.columns, df.collect()) == rows_of([d[0] for d in result.description], result.fetchall())


def not_distinct(activity, entity, active, cohort_, extra=()):
    return activity.select(entity, *cohort_.dims, *extra, F.when(active, 1).otherwise(0).alias("active"))


def all_tuples(terms, entity, cols, cohort_, status, denom, num):
    return terms.groupBy(*cohort_.dims).agg(F.count(entity).alias(denom), F.sum(F.when(status, 1).otherwise(0)).cast("long").alias(num))


WRONG = {
    "score_growth_year: greatest score": ("score_growth_year", periods, "F", Swapped(min=F.max)),
    "score_growth_term: greatest score": ("score_growth_term", periods, "F", Swapped(min=F.max)),
    "distinct_entity_count: plain count": ("distinct_entity_count", surveys, "F", Swapped(count_distinct=F.count)),
    "average_support: plain count of notes": ("average_support_per_entity", surveys, "F", Swapped(count_distinct=F.count)),
    "retention: repeated customers": ("retention", periods, "retention_rows", not_distinct),
    "persistence: sites ignored": ("persistence", Q, "persistence",
                                   lambda *a, **k: periods.persistence(*a, **{**k, "site": None})),
    "exact_period_presence: any number": ("exact_period_presence", Q, "exact_period_presence",
                                          lambda t, e, p, when, k, c, n: periods.exact_period_presence(t, e, p, when, 1, c, n)),
    "distinct_population: repeated tuples": ("distinct_population_denominator", Q, "distinct_population", all_tuples),
    "attribute_carry: least value": ("dimension_attribute_carry", cohort, "F", Swapped(max=F.min)),
    "survey_completion: greatest instead of sum": ("survey_completion_join", surveys, "sum_long", lambda c: F.max(c).cast("long")),
    "nps: no answer counts as an answer": ("nps", Q, "nps_flags", lambda a, p, q: {
        "promoter": F.when(F.coalesce(a, F.lit("9")).isin(*p), 1).otherwise(0), "detractor": F.when(~a.isin(*p, *q), 1).otherwise(0)}),
}


@pytest.mark.parametrize("case", sorted(WRONG))
def test_wrong_operator_is_seen(spark, duck, monkeypatch, case):
    name, module, attribute, wrong = WRONG[case]
    monkeypatch.setattr(module, attribute, wrong)
    assert not agrees(spark, duck, name)


def test_right_operators_agree(spark, duck):
    for name in sorted({w[0] for w in WRONG.values()}):
        assert agrees(spark, duck, name), name


def test_rows_without_an_entity_do_not_qualify_each_other(spark):
    rows = spark.createDataFrame([(None, 1, True), (None, 2, True), (7, 1, True), (7, 2, True)], "who int, term int, ok boolean")
    out = periods.persistence(rows, "who", F.col("term") == 1, F.col("ok"), F.col("term") == 2, F.col("ok"), cohort.CohortSpec(()))
    assert tuple(out.first()) == (1, 1)
