"""Invariants of the KPI tables on the sf0.01 twins."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from tests.conftest import SF01

# numerator <= denominator where both count the same population
PAIRS = {
    "child_count_threshold": [("cc_num", "cc_denom")],
    "retention": [("ret_num", "ret_denom")],
    "persistence": [("persist_num", "persist_denom")],
    "cohort_projected_completion": [("pc_num", "pc_denom")],
    "distinct_population_denominator": [("dp_on_track", "dp_denom")],
    "ratio_rate_threshold": [("rr_above", "rr_rated"), ("rr_above_all", "rr_rated")],
    "three_state_rate": [("ts_above", "ts_rated")],
    "split_population_ratio": [("sp_num_of_den", "sp_den")],
    "ratio_predicate": [("rp_ok", "rp_lines"), ("rp_zero_divisor", "rp_lines")],
    "nps": [("nps_promoters", "nps_respondents"), ("nps_detractors", "nps_respondents")],
    "likert_agree": [("lk_agree_both", "lk_agree_band"), ("lk_agree_band", "lk_agree_any"),
                     ("lk_distinct_respondents", "lk_respondents")],
    "indicator_cohort_sum": [("ind_high_balance", "ind_contact_count")],
    "distinct_entity_count": [("dc_urgent_customers", "dc_urgent_orders")],
}


@pytest.mark.parametrize("name", sorted(PAIRS))
def test_numerator_not_above_denominator(spark, name):
    df = E.queries()[name](spark, SF01)
    for num, den in PAIRS[name]:
        assert df.filter(F.col(num) > F.col(den)).count() == 0, (num, den)


def test_rollup_national_equals_sum_of_sites(spark):
    df = E.queries()["ratio_rollup"](spark, SF01)
    sites = df.filter(F.col("level") == "site").agg(F.sum("high_balance_num"), F.sum("high_balance_den")).first()
    regions = df.filter(F.col("level") == "region").agg(F.sum("high_balance_num"), F.sum("high_balance_den")).first()
    nat = df.filter(F.col("level") == "National").first()
    assert (nat["high_balance_num"], nat["high_balance_den"]) == tuple(sites) == tuple(regions)


def test_wide_rows_equal_spine_rows(spark):
    wide = E.queries()["wide_assembly"](spark, SF01)
    spine = E.queries()["indicator_cohort_sum"](spark, SF01)
    assert wide.count() == spine.count()


def test_flags_are_zero_or_one(spark):
    from kpiloom.plans.commerce import contact_profile
    from kpiloom.sources.commerce import Commerce
    prof = contact_profile(Commerce(spark, SF01))
    flags = ["has_lines", "ef_urgent_1998", "ef_finished_high", "ret_active_97", "ret_active_98", "p_group"]
    bad = prof.filter(" OR ".join(f"({c} IS NOT NULL AND {c} NOT IN (0, 1))" for c in flags)).count()
    assert bad == 0
