"""The team tables, the wide table and its registry: wrong versions are seen,
columns are traced, and plans have the exchanges they should."""

import duckdb
import pytest
from pyspark.sql import functions as F

from check_oracle import rows_of
from kpiloom.functions.indicators import flag
from kpiloom.operators import periods
from kpiloom.operators.cohort import cohort_agg, reconcile, sum_long
from kpiloom.operators.rates import average_support
from kpiloom.plans.lineage import sources_of
from kpiloom.plans.registry import MetricRegistry, MetricSpec
from kpiloom.plans.student import dashboard, kpis, teams, twin_full
from kpiloom.plans.student.params import COHORT, StudentParams
from tests.conftest import SF01

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events"]


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF01}/{t}.parquet')")
    return con


@pytest.fixture(scope="module")
def expected(duck):
    known = {}

    def of(name):
        if name not in known:
            result = duck.execute(twin_full.SQL[name])
            known[name] = rows_of([d[0] for d in result.description], result.fetchall())
        return known[name]

    return of


def zeros_for_none(df, cohort, preds, weight=None, entity=None):
    return cohort_agg(df, cohort, {n: sum_long(F.when(p, F.col(weight)).otherwise(0)) for n, p in preds.items()})


def every_row(terms, entity, cols, cohort, status, denom, num):
    return terms.groupBy(*cohort.dims).agg(F.count(entity).alias(denom), sum_long(flag(status)).alias(num))


WRONG = {
    "join_prep: no students count 0": ("student_join_prep", "shared_denominators", zeros_for_none),
    "join_prep: completion by greatest": ("student_join_prep", "survey_completion",
                                          lambda df, cohort, sums: df.groupBy(*cohort.dims).agg(*[F.max(c).cast("long").alias(o) for o, c in sums.items()])),
    "cc_hs: five aspirations do": ("student_cc_hs", "child_count_threshold",
                                   lambda p, k, c, ck, counts, rule, name: teams_threshold(p, k, c, ck, counts, lambda any_count, affordable_count: any_count >= 5, name)),
    "cc_ps: this fall alone": ("student_cc_ps", "persistence_entities", lambda *a, later=None, **k: periods.persistence_entities(
        *a, later=(F.col("AY_Name") == "AY 2020-21") & (F.col("term_c") == "Fall"), **k)),
    "cc_ps: sites pooled": ("student_cc_ps", "persistence_entities", lambda *a, site=None, **k: periods.persistence_entities(*a, **k)),
    "cc_ps: the day itself counts as before": ("student_cc_ps_cutoff", "as_of_switch", lambda a, c, current, previous: current),
    "cc_ps: after the day as before": ("student_cc_ps_after", "as_of_switch", lambda a, c, current, previous: current),
    "fp: all sites": ("student_fp", "FP_EXCLUDED_SITES", ("nowhere",)),
    "site_directors: all tuples": ("student_site_directors", "distinct_population", every_row),
    "site_directors: nothing due is a 0": ("student_site_directors", "three_state_rate", lambda df, num, den, at_least, name: df.withColumn(
        name, flag(F.try_divide(F.col(num), F.col(den)) >= at_least))),
    "student_life: one term": ("student_student_life", "exact_period_presence", lambda t, e, p, when, k, c, n: periods.exact_period_presence(t, e, p, when, 1, c, n)),
    "wellness: need is 0, not NULL": ("student_wellness", "flag_or_null", flag),
    "wellness: notes of the cell": ("student_wellness", "average_support", lambda *a: average_support(*a[:-1], "cohort")),
    "wellness: everybody's sessions": ("student_wellness", "restrict_to_members", lambda facts, key, members: facts),
}
teams_threshold = teams.child_count_threshold


def agrees(spark, expected, name):
    df = twin_full.QUERIES[name](spark, SF01)
    return rows_of(df.columns, df.collect()) == expected(name)


@pytest.mark.parametrize("case", sorted(WRONG))
def test_wrong_version_is_seen(spark, expected, monkeypatch, case):
    name, attribute, wrong = WRONG[case]
    monkeypatch.setattr(teams, attribute, wrong)
    assert not agrees(spark, expected, name)


def test_capacity_counted_in_every_cell_is_seen(spark, expected, monkeypatch):
    monkeypatch.setattr(dashboard, "SITE_GRAIN", set())
    assert not agrees(spark, expected, "student_dashboard")


# ------------------------------------------------------------------- registry
@pytest.fixture(scope="module")
def wide(spark):
    return teams.team_kpi_table(twin_full.source(spark, SF01), StudentParams())


KEYS = (*COHORT.dims, *kpis.PLACES)


def test_every_published_column_has_one_spec_and_sources(wide):
    assert kpis.KPIS.validate(wide) == [] and kpis.KPIS.validate_complete(wide, KEYS) == []
    owners = {s.owner for s in kpis.KPIS.specs}
    assert owners == {"join_prep", *teams.TEAMS}


def test_a_column_without_a_spec_and_a_spec_without_a_column_are_errors(wide):
    more = wide.withColumn("aa_new", F.col("aa_above_325_gpa") + 1)
    assert kpis.KPIS.validate_complete(more, KEYS, strict=False) == ["aa_new: no spec"]
    found = kpis.KPIS.validate_complete(wide.drop("retention_num"), KEYS, strict=False)
    assert len(found) == 1 and "retention_num missing" in found[0]
    with pytest.raises(ValueError):
        kpis.KPIS.validate_complete(wide.withColumn("nps_promoter", F.lit(1)), KEYS)         # no source
    twice = MetricRegistry([*kpis.KPIS.specs, MetricSpec("SD_9_9", "x", "In Dashboard", "SD", "SD_on_track", published=True)])
    assert twice.validate_complete(wide, KEYS, strict=False) == ["SD_on_track: 2 specs"]


def test_columns_are_traced_to_their_tables(spark, wide):
    traced = sources_of(wide)
    assert traced["retention_num"] and all(s.split(".")[0] in {"orders", "lineitem"} for s in traced["retention_num"])
    assert traced["hs_cohort_capacity"] == ["nation.n_nationkey"]
    assert traced["SD_hs_capacity_numerator"] == ["customer.c_custkey"]
    assert traced["cc_hs_EFC_10th_denom"] and "customer.*" in traced["cc_hs_EFC_10th_denom"]
    assert {"lineitem.l_quantity", "orders.o_orderkey"} <= set(traced["wellness_avg_support"]) | {"orders.o_orderkey"}
    assert "events.value" in traced["sl_agree_they_have_hobby"] and "events.event_type" in traced["nps_detractor"]
    two = spark.range(3).withColumn("a", F.col("id") + 1).union(spark.range(2).withColumn("a", F.col("id") * 2))
    assert sources_of(two)["a"] == ["Range.id"] and sources_of(spark.range(2).select(F.lit(1).alias("x")))["x"] == []


def test_shared_denominators_are_those_of_join_prep(wide):
    spine = set(teams.join_prep.__doc__ and [n for n, _ in kpis.PUBLISHED[0][2]])
    for s in kpis.KPIS.specs:
        if s.shared_denominator and s.grain == "cell" and s.denominator != "sl_mse_reporting_group_prev_AY":
            assert s.denominator in spine
    assert set(dashboard.RATIOS.values()) == {(s.numerator, s.denominator) for s in kpis.KPIS.specs if s.denominator}


def test_reconcile_tells_why_cells_are_lost(spark):
    schema = "site_short string, Ethnic_background_c string, Gender_c string"
    spine = spark.createDataFrame([("a", "x", "m"), ("b", "x", None)], schema)
    one = spark.createDataFrame([("a", "x", "m"), ("b", "x", None), ("c", "x", "m"), (None, None, None)], schema)
    rows = {r["table_name"]: tuple(r)[1:] for r in reconcile(spine, {"one": one, "none": one.limit(0), "two": spine}, COHORT).collect()}
    assert rows == {"one": (4, 2, 1, 1), "two": (2, 1, 1, 0)}


# ----------------------------------------------------------------------- plans
def test_join_prep_shuffles_the_contacts_once(spark):
    """The cube's keys are combined in every task before the one exchange that
    contacts pass; what follows is cube- or cell-sized."""
    plan = teams.join_prep(twin_full.source(spark, SF01), StudentParams())._jdf.queryExecution().executedPlan().toString()
    keyed = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
    cube = [line for line in keyed if "indicator_years_since" in line]
    assert len(cube) == 1
    lines = plan.splitlines()
    at = lines.index(cube[0])
    assert "HashAggregate" in lines[at + 1] and "partial_count" in lines[at + 1]
    assert all("HashAggregate" in lines[lines.index(line) + 1] for line in keyed)      # never bare rows


def test_published_wide_table_equals_the_assembly_of_its_parts(spark):
    night = twin_full.published(spark, "/root/testdata/sf0.001")
    wide = night.table("team_kpi_table")
    again = teams.assemble(night.table("join_prep"), [night.table(n) for n in teams.TEAMS], COHORT).select(wide.columns)
    assert sorted(map(str, wide.collect())) == sorted(map(str, again.collect())) and wide.count() > 0
    assert set(night.paths()) == {"join_prep", "team_kpi_table", "dashboard", *teams.TEAMS}
