"""Twin KPI queries on the commerce tables — one per composite operator.

Each function takes ``(spark, root)`` and returns a lazy cohort-grain
DataFrame keyed by ``(n_name, c_mktsegment, band)`` (or the roll-up levels).
The matching DuckDB oracle SQL lives in ``commerce_sql`` under the same name,
written from the definition of the metric.

Plan conventions at scale: where the operator allows it, facts (lineitem,
orders, events) are reduced to order or customer grain with partial
aggregation before a join, so a key holding a third of the rows is combined
map-side.  Operators that have to see repeated rows (growth, distinct counts,
retention, persistence) get the fact rows joined to the cell; there Spark's
skew join splits a hot key.  Only fixed-size dimensions (nation, region) and
derived tables whose size AQE measures at runtime are broadcast.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kpiloom.functions.indicators import flag, like_any, like_none, ratio_at_most
from kpiloom.functions.segments import SegmentRegistry
from kpiloom.operators.cohort import (CohortSpec, assemble, attribute_carry, cohort_agg,
                                      indicator_cohort_sum, ratio_rollup, spine, sum_long)
from kpiloom.operators.links import (activity_flags_any, child_count_threshold,
                                     existence_flags, members, restrict_to_members)
from kpiloom.operators.periods import (as_of_switch, distinct_population, open_before,
                                       exact_period_presence, persistence, retention,
                                       score_growth)
from kpiloom.operators.rates import (average_support, count_cube, entity_rate, period_weights,
                                     rate_flag, shared_denominators, split_population,
                                     three_state_rate)
from kpiloom.operators.surveys import (distinct_entity_count, likert_agree, nps_flags, nps_score,
                                       survey_completion)
from kpiloom.session import shared_dir
from kpiloom.sources.commerce import (COHORT, HIGH, KEYS, LOW, MEDIUM, NOT_SPECIFIED, URGENT,
                                      Commerce, gterm_of, in_quarters, in_year, prev_gterm)

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}

AS_OF = "1998-03-05"          # default run date of the twin
CUTOFF = "1998-07-01"         # term switch-over date of the twin
RATE_THRESHOLD = 0.7

# NPS answer labels and Likert agree-sets of the twin surveys.
NPS_PROMOTERS = ("10 - extremely likely", "9")
NPS_PASSIVES = ("8", "7")
AGREE_EN = ("Strongly Agree", "Agree")
AGREE_ES = ("Totalmente de acuerdo", "De acuerdo")
AGREE_MISSPELT = ("Strongly Agree", "StronglyAgree", "Agree")
AGREE_TYPES = ("purchase", "signup")
# Base and later quarters of the twin, and the "sites" of an order.
P_BASE, P_LATER = 19974, (19981, 19982, 19984)
PRIORITIES = (URGENT, HIGH, MEDIUM, NOT_SPECIFIED, LOW)


def register(name: str):
    def deco(fn):
        QUERIES[name] = lambda spark, root, _fn=fn: _fn(Commerce(spark, root))
        QUERIES[name].__name__ = name
        QUERIES[name].__doc__ = fn.__doc__
        return fn
    return deco


st = lambda: F.col("o_orderstatus")       # noqa: E731
pr = lambda: F.col("o_orderpriority")     # noqa: E731


def dims(t: Commerce) -> DataFrame:
    return t.memo("dims", lambda: t.contacts().select("contact_id", *KEYS))


def order_keys(t: Commerce, *extra: str) -> DataFrame:
    return t.orders().select(F.col("o_orderkey"), "contact_id", *extra)


def lines_to_contacts(t: Commerce, per_order: DataFrame, sums: dict[str, Column],
                      extra: tuple[str, ...] = ()) -> DataFrame:
    """Order-grain line aggregates -> customer grain (one join, one agg)."""
    j = per_order.join(order_keys(t, *extra), per_order["l_orderkey"] == F.col("o_orderkey"))
    return j.groupBy("contact_id").agg(*[c.alias(n) for n, c in sums.items()])


# --------------------------------------------------------------- K01 / K21 / K22
def k01_table(t: Commerce, extra_keys=()) -> DataFrame:
    bal, seg = F.col("c_acctbal"), F.col("c_mktsegment")
    return indicator_cohort_sum(t.contacts(region="r_name" in extra_keys), COHORT, {
        "ind_high_balance": bal >= 7500,
        "ind_negative_balance": bal < 0,
        "ind_building_high": (seg == "BUILDING") & (bal >= 5000),
        "ind_other_mid": ~seg.isin("MACHINERY", "AUTOMOBILE") & (bal > 1000),
    }, count=("ind_contact_count", "contact_id"), extra_keys=extra_keys)


@register("indicator_cohort_sum")
def indicator_cohort_sum_q(t: Commerce) -> DataFrame:
    """Four 0/1 balance/segment flags and the head-count per cell."""
    return k01_table(t)


@register("ratio_rollup")
def ratio_rollup_q(t: Commerce) -> DataFrame:
    """High-balance share at site, region and national level."""
    k = k01_table(t, extra_keys=("r_name",))
    return ratio_rollup(k, {"high_balance": ("ind_high_balance", "ind_contact_count")},
                        levels=["r_name", "n_name"], level_names=["region", "site"])


@register("dimension_attribute_carry")
def attribute_carry_q(t: Commerce) -> DataFrame:
    """Head-count per cell next to the site's capacity (MAX s_acctbal)."""
    units = t.supplier().select("s_nationkey", F.col("s_acctbal").alias("capacity"))  # many rows per site
    out = attribute_carry(t.contacts(), units, "c_nationkey", "s_nationkey", "capacity", COHORT,
                          ("dc_head_count", "contact_id"), "dc_capacity")
    return out.withColumn("dc_capacity", F.round("dc_capacity", 6))


# --------------------------------------------------------------- K02 / K03 / K29
SEGMENTS = SegmentRegistry()
SEGMENTS.register("priority_senior", lambda: pr().isin(URGENT, HIGH) | (
    (pr() == MEDIUM) & in_year("o_orderdate", 1998)))
SEGMENTS.register("not_pending", lambda: st() != "P")
SEGMENTS.register("open", lambda: st() == "O")


@register("named_segment_filter")
def named_segment_q(t: Commerce) -> DataFrame:
    """Orders in the named segment 'priority_senior' ∧ 'not_pending'."""
    o = t.orders().filter(SEGMENTS.all_of("priority_senior", "not_pending"))
    per = o.groupBy("contact_id").agg(F.count(F.lit(1)).alias("n"),
                                      F.sum(flag(SEGMENTS("open"))).alias("n_open"))
    j = per.join(dims(t), "contact_id")
    return cohort_agg(j, COHORT, {"seg_orders": sum_long("n"), "seg_open_orders": sum_long("n_open"),
                                  "seg_customers": F.count("contact_id")})


@register("shared_denominators")
def shared_denominators_q(t: Commerce) -> DataFrame:
    """1998 order counts per cell from a (customer, status, priority) cube;
    NULL where no order qualifies."""
    o = t.orders().filter(in_year("o_orderdate", 1998))
    cube = count_cube(o, ["contact_id", "o_orderstatus", "o_orderpriority"], "o_orderkey", "n")
    j = cube.join(dims(t), "contact_id")
    return shared_denominators(j, COHORT, {
        "sd_order_count": F.lit(True),
        "sd_finished": st() == "F",
        "sd_open": st() == "O",
        "sd_pending_urgent": (st() == "P") & (pr() == URGENT),
        "sd_urgent_high": pr().isin(URGENT, HIGH),
    }, weight="n")


def event_profile(t: Commerce) -> DataFrame:
    """Respondent grain, one events pass: NPS flags and survey completion."""
    # an error event carries no answer: NULL, neither promoter nor detractor
    ans = F.when(F.col("event_type") != "error", F.floor(F.col("value") / 10))
    label = F.when(ans >= 10, NPS_PROMOTERS[0]).otherwise(ans.cast("string"))
    fl = nps_flags(label, NPS_PROMOTERS, NPS_PASSIVES)
    return t.events().groupBy(F.col("user_id").alias("contact_id")).agg(
        F.sum(fl["promoter"]).alias("p"), F.sum(fl["detractor"]).alias("d"),
        F.count(label).alias("n"),
        F.sum(flag(F.col("event_type") == "purchase")).alias("completed_survey_count"))


def event_metrics(t: Commerce) -> DataFrame:
    """Cell grain: NPS counts and survey-completion totals from one events
    pass (respondents outside the contact table land in the NULL cell,
    which never joins the spine)."""
    j = event_profile(t).join(dims(t), "contact_id", "left")
    return cohort_agg(j, COHORT, {
        "nps_promoters": sum_long("p"), "nps_detractors": sum_long("d"), "nps_respondents": sum_long("n"),
        "sc_denominator": F.count("contact_id"), "sc_count": sum_long("completed_survey_count")})


def join_prep_table(t: Commerce, events: DataFrame | None = None) -> DataFrame:
    """Spine with shared denominators over all contacts, plus survey totals.

    ``events`` is the cell-grain event aggregate when a job shares one."""
    c = t.contacts(region=True).withColumn("national", F.lit("National")).withColumn(
        "tier", F.floor(F.col("c_acctbal") / 2500).cast("int"))
    cube = count_cube(c, ["national", "r_name", *KEYS, "tier"], "contact_id", "n")
    tier = F.col("tier")
    denoms = shared_denominators(cube, CohortSpec(("national", "r_name", *KEYS)), {
        "jp_contact_count": F.lit(True),
        "jp_top_tier": tier >= 3,
        "jp_negative": tier < 0,
    }, weight="n")
    if events is not None:
        sc = events.select(*KEYS, "sc_denominator", "sc_count")
        return denoms.join(sc, KEYS, "left")
    # The survey-completion table arrives pre-counted per respondent; K29 sums
    # it per cell and joins it on.
    per_user = event_profile(t).select("contact_id", F.lit(1).alias("student_count"),
                                       "completed_survey_count")
    completion = per_user.join(dims(t), "contact_id")      # many rows per cell: K29 sums them
    sc = survey_completion(completion, COHORT, {"sc_denominator": "student_count",
                                                "sc_count": "completed_survey_count"})
    return denoms.join(sc, KEYS, "left")


@register("survey_completion_join")
def survey_completion_q(t: Commerce) -> DataFrame:
    """Shared denominators on the contact spine ⟕ summed survey totals."""
    return join_prep_table(t)


# --------------------------------------------------------------- K04 / K05 / K24 / K26
def per_order_rate_inputs(t: Commerce, part_filter: Column | None = None) -> DataFrame:
    li = t.lineitem()
    if part_filter is not None:
        parts = t.part().filter(part_filter).select("p_partkey")
        li = li.join(parts, li["l_partkey"] == parts["p_partkey"], "left_semi")
    q = F.col("l_quantity")
    return li.groupBy("l_orderkey").agg(
        F.sum(F.when(F.col("l_returnflag") != "R", q).otherwise(0)).alias("n"),
        F.sum(q).alias("d"))


def rate_cells(t: Commerce, rates: DataFrame, prefix: str) -> DataFrame:
    j = dims(t).join(rates, "contact_id", "left")
    return cohort_agg(j, COHORT, {
        f"{prefix}_rated": F.count("rate"),
        f"{prefix}_above": sum_long("above"),
        f"{prefix}_above_all": sum_long(flag(F.col("rate") >= RATE_THRESHOLD)),
    })


def k04_table(t: Commerce) -> DataFrame:
    po = per_order_rate_inputs(t)
    facts = po.join(order_keys(t), po["l_orderkey"] == F.col("o_orderkey"))
    r = rate_flag(facts, "contact_id", F.col("n"), F.col("d"), RATE_THRESHOLD, "above")
    return rate_cells(t, r, "rr")


@register("ratio_rate_threshold")
def rate_threshold_q(t: Commerce) -> DataFrame:
    """Σ non-returned qty / Σ qty per customer, flag >= 0.7."""
    return k04_table(t)


@register("ratio_rate_threshold_term")
def rate_threshold_term_q(t: Commerce) -> DataFrame:
    """K04 term form: each line counts once per URGENT order of its quarter
    (the literal many-to-many term join), computed with period weights."""
    po = per_order_rate_inputs(t)
    facts = po.join(order_keys(t, "gterm"), po["l_orderkey"] == F.col("o_orderkey"))
    w = period_weights(t.orders().filter(pr() == URGENT), "gterm")
    r = rate_flag(facts, "contact_id", F.col("n"), F.col("d"), RATE_THRESHOLD, "above",
                  period="gterm", weights=w)
    return rate_cells(t, r, "rt")


@register("pattern_filtered_rate")
def pattern_rate_q(t: Commerce) -> DataFrame:
    """K04 over lines whose part name is like widget/gizmo, not red."""
    pf = like_any("p_name", ["%widget%", "%gizmo%"]) & like_none("p_name", ["%red%"])
    po = per_order_rate_inputs(t, pf)
    facts = po.join(order_keys(t), po["l_orderkey"] == F.col("o_orderkey"))
    r = rate_flag(facts, "contact_id", F.col("n"), F.col("d"), RATE_THRESHOLD, "above")
    return rate_cells(t, r, "pf")


@register("three_state_rate")
def three_state_q(t: Commerce) -> DataFrame:
    """Undiscounted returned qty that is final / all undiscounted
    returned qty; NULL flag where that denominator is 0."""
    q = F.col("l_quantity")
    base = (F.col("l_discount") == 0) & (F.col("l_returnflag") == "R")
    po = t.lineitem().groupBy("l_orderkey").agg(
        F.sum(F.when(base & (F.col("l_linestatus") == "F"), q).otherwise(0)).alias("n"),
        F.sum(F.when(base, q).otherwise(0)).alias("d"))
    facts = po.join(order_keys(t), po["l_orderkey"] == F.col("o_orderkey"))
    sums = entity_rate(facts, "contact_id", F.col("n"), F.col("d"))
    j = three_state_rate(dims(t).join(sums, "contact_id", "left"), "num_sum", "den_sum", 0.5, "flag")
    return cohort_agg(j, COHORT, {"ts_above": sum_long("flag"), "ts_rated": F.count("flag")})


@register("ratio_predicate")
def ratio_predicate_q(t: Commerce) -> DataFrame:
    """Lines with l_tax / l_discount <= 0.5 (zero divisor -> not counted)."""
    po = t.lineitem().groupBy("l_orderkey").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(flag(ratio_at_most("l_tax", "l_discount", 0.5))).alias("ok"),
        F.sum(flag(F.col("l_discount") == 0)).alias("z"))
    per = lines_to_contacts(t, po, {"n": F.sum("n"), "ok": F.sum("ok"), "z": F.sum("z")})
    j = per.join(dims(t), "contact_id")
    return cohort_agg(j, COHORT, {"rp_lines": sum_long("n"), "rp_ok": sum_long("ok"),
                                  "rp_zero_divisor": sum_long("z")})


# --------------------------------------------------------------- K06 / K07 / K15 / K25
# the flags of K06, for its own table and the nightly job's profile
EF_FLAGS = {
    "ef_urgent_1998": lambda: (pr() == URGENT) & in_year("o_orderdate", 1998),
    "ef_finished_high": lambda: (st() == "F") & (pr() == HIGH),
    "ef_pending_low": lambda: (st() == "P") & (pr() == LOW),
    "ef_open_2001": lambda: (st() == "O") & in_year("o_orderdate", 2001),
}


def k06_table(t: Commerce) -> DataFrame:
    flags = {n: p() for n, p in EF_FLAGS.items()}
    p = existence_flags(dims(t), "contact_id", t.orders(), "contact_id", flags)
    p = p.withColumn("ef_urgent_or_pending_low", F.greatest("ef_urgent_1998", "ef_pending_low"))
    names = [*flags, "ef_urgent_or_pending_low"]
    return cohort_agg(p, COHORT, {n: sum_long(n) for n in names})


@register("existence_flags")
def existence_flags_q(t: Commerce) -> DataFrame:
    """Five has-an-order-with flags per customer from one orders scan."""
    return k06_table(t)


def k07_table(t: Commerce) -> DataFrame:
    p = child_count_threshold(
        dims(t), "contact_id", t.orders(), "contact_id",
        {"cc_orders": None, "cc_urgent_high": pr().isin(URGENT, HIGH)},
        lambda cc_orders, cc_urgent_high: (cc_orders >= 12) & (cc_urgent_high >= 5), "cc_flag")
    return cohort_agg(p, COHORT, {"cc_num": sum_long("cc_flag"), "cc_denom": F.count("contact_id")})


@register("child_count_threshold")
def child_count_q(t: Commerce) -> DataFrame:
    """Customers with >= 12 orders of which >= 5 URGENT/HIGH."""
    return k07_table(t)


@register("membership_semi_join")
def membership_q(t: Commerce) -> DataFrame:
    """Lines of customers who placed an URGENT order in 1998Q4."""
    o = t.orders()
    m = members(o, "contact_id", (pr() == URGENT) & in_quarters("o_orderdate", [19984]))
    om = restrict_to_members(o.select("o_orderkey", "contact_id"), "contact_id", m)
    li = t.lineitem().select("l_orderkey", "l_quantity")
    li = li.join(om, li["l_orderkey"] == om["o_orderkey"], "left_semi")   # restrict, then aggregate
    po = li.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("lines"), F.sum("l_quantity").alias("qty"))
    f = po.join(om, po["l_orderkey"] == om["o_orderkey"])
    per = f.groupBy("contact_id").agg(F.sum("lines").alias("lines"), F.sum("qty").alias("qty"),
                                      F.count(F.lit(1)).alias("orders"))
    j = per.join(dims(t), "contact_id", "left")
    return cohort_agg(j, COHORT, {"ms_lines": sum_long("lines"), "ms_quantity": sum_long("qty"),
                                  "ms_orders": sum_long("orders")})


@register("activity_flags_any")
def activity_flags_q(t: Commerce) -> DataFrame:
    """Any ECONOMY part / any returned large part / any widget in 1998."""
    # part and line become flags before the join: no strings are shuffled
    li = t.lineitem().select("l_orderkey", "l_partkey", (F.col("l_returnflag") == "R").alias("returned"))
    p = t.part().select("p_partkey", (F.col("p_type") == "ECONOMY").alias("is_economy"),
                        (F.col("p_size") >= 40).alias("is_large"), F.col("p_name").like("%widget%").alias("is_widget"))
    lp = li.join(p, li["l_partkey"] == p["p_partkey"])
    per_order = activity_flags_any(lp, "l_orderkey", {
        "econ": F.col("is_economy"),
        "large_ret": F.col("returned") & F.col("is_large"),
        "widget": F.col("is_widget"),
    })
    j = per_order.join(order_keys(t, "yr"), per_order["l_orderkey"] == F.col("o_orderkey"))
    per = activity_flags_any(j, "contact_id", {
        "af_economy": F.col("econ") == 1,
        "af_large_returned": F.col("large_ret") == 1,
        "af_widget_1998": (F.col("widget") == 1) & (F.col("yr") == 1998),
    })
    cells = dims(t).join(per, "contact_id", "left")
    return cohort_agg(cells, COHORT, {
        "af_economy": sum_long("af_economy"), "af_large_returned": sum_long("af_large_returned"),
        "af_widget_1998": sum_long("af_widget_1998"), "af_active": F.count("af_economy")})


# --------------------------------------------------------------- K08 / K12 / K13 / K14
@register("score_growth_year")
def growth_year_q(t: Commerce) -> DataFrame:
    """K08 year grain: MIN order price per customer-year, growth vs previous."""
    orders = t.orders().select("contact_id", F.col("yr").cast("string").alias("ay"), "o_totalprice")
    scores = orders.join(dims(t), "contact_id")
    return score_growth(scores, "contact_id", "ay", F.col("o_totalprice"), COHORT,
                        "sg_year_grew", "sg_year_pairs")


@register("score_growth_term")
def growth_term_q(t: Commerce) -> DataFrame:
    """K08 term grain: MIN order price per customer-quarter, ordered by date."""
    start = F.to_date(F.date_trunc("quarter", F.col("o_orderdate"))).alias("term_start")
    scores = t.orders().select("contact_id", start, "o_totalprice").join(dims(t), "contact_id")
    return score_growth(scores, "contact_id", "term_start", F.col("o_totalprice"), COHORT,
                        "sg_term_grew", "sg_term_pairs")


def k12_table(t: Commerce) -> DataFrame:
    o = t.orders()
    li = t.lineitem().select("l_orderkey")
    o97 = o.filter(in_year("o_orderdate", 1997)).select("o_orderkey", "contact_id")
    # one row per 1997 order with lines; K12 makes the customers distinct
    act = o97.join(li, li["l_orderkey"] == o97["o_orderkey"], "left_semi").select("contact_id")
    active = existence_flags(dims(t), "contact_id", o, "contact_id",
                             {"active": in_year("o_orderdate", 1998)})
    return retention(act.join(active, "contact_id"), "contact_id", F.col("active") == 1, COHORT,
                     "ret_denom", "ret_num")


@register("retention")
def retention_q(t: Commerce) -> DataFrame:
    """Customers with lines on 1997 orders, and those still ordering in 1998."""
    return k12_table(t)


def k13_table(t: Commerce) -> DataFrame:
    o = t.orders().filter(in_quarters("o_orderdate", [P_BASE, *P_LATER]))
    ok = st() != "P"
    return persistence(o.join(dims(t), "contact_id"), "contact_id", base=F.col("gterm") == P_BASE, group_pred=ok,
                       later=F.col("gterm").isin(*P_LATER), persisted_pred=ok, cohort=COHORT,
                       site="o_orderpriority", denom="persist_denom", num="persist_num")


@register("persistence")
def persistence_q(t: Commerce) -> DataFrame:
    """Customers with a non-pending 1997Q4 order; persisted if the orders
    of 1998Q1, Q2 and Q4 of at least one priority ("site") are all non-pending."""
    return k13_table(t)


@register("exact_period_presence")
def exact_presence_q(t: Commerce) -> DataFrame:
    """Customers with exactly two finished orders over 1998Q1 and 1998Q3."""
    o = t.orders().filter(in_quarters("o_orderdate", [19981, 19983]))
    return exact_period_presence(o.join(dims(t), "contact_id"), "contact_id", st() == "F",
                                 F.col("gterm").isin(19981, 19983), 2, COHORT, "ep_two_periods")


# --------------------------------------------------------------- K16 / K17 / K20 / K23 / K30
def switch_table(t: Commerce, as_of: str, cutoff: str = CUTOFF) -> DataFrame:
    cur = gterm_of(dt.date.fromisoformat(as_of))
    pred = as_of_switch(as_of, cutoff, in_quarters("o_orderdate", [cur]),
                        in_quarters("o_orderdate", [prev_gterm(cur)]))
    per = t.orders().filter(pred).groupBy("contact_id").agg(
        F.count(F.lit(1)).alias("n"), F.sum(flag(st() == "F")).alias("f"))
    j = per.join(dims(t), "contact_id")
    return cohort_agg(j, COHORT, {"sw_rows": sum_long("n"), "sw_finished": sum_long("f")})


@register("as_of_period_switch")
def switch_q(t: Commerce) -> DataFrame:
    """As of 1998-03-05 (before the 07-01 cut-off) use the current quarter."""
    return switch_table(t, AS_OF)


@register("as_of_period_switch_after")
def switch_after_q(t: Commerce) -> DataFrame:
    """As of 1998-09-05 (after the cut-off) use the previous quarter."""
    return switch_table(t, "1998-09-05")


def open_records_table(t: Commerce, as_of: str = AS_OF, year_aware: bool = False) -> DataFrame:
    li = t.lineitem().filter((F.col("l_linestatus") == "O") &
                             open_before(F.col("l_shipdate"), as_of, year_aware))
    po = li.groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"))
    per = lines_to_contacts(t, po, {"n": F.sum("n")})
    j = per.join(dims(t), "contact_id", "left")
    return cohort_agg(j, COHORT, {"or_open_records": sum_long("n")})


@register("open_records_snapshot")
def open_records_q(t: Commerce) -> DataFrame:
    """K17 literal: open lines shipped in a month-of-year before the as-of month."""
    return open_records_table(t)


@register("open_records_snapshot_year_aware")
def open_records_year_q(t: Commerce) -> DataFrame:
    """K17 year-aware: open lines shipped before the first of the as-of month."""
    return open_records_table(t, year_aware=True)


@register("distinct_population_denominator")
def distinct_population_q(t: Commerce) -> DataFrame:
    """Distinct (customer, priority) of non-pending 1995 orders; on-track
    = priority not 4/5."""
    o = t.orders().filter(in_year("o_orderdate", 1995) & (st() != "P"))
    rows = o.select("contact_id", "o_orderpriority").join(dims(t), "contact_id")
    return distinct_population(rows, "contact_id", ["o_orderpriority"], COHORT,
                               ~pr().isin(NOT_SPECIFIED, LOW), "dp_denom", "dp_on_track")


@register("split_population_ratio")
def split_population_q(t: Commerce) -> DataFrame:
    """Positive-balance customers (entity table) vs finished-1996 orders
    (term table), joined on customer and dims with plain '='."""
    per = t.orders().groupBy("contact_id").agg(
        F.max(flag((st() == "F") & in_year("o_orderdate", 1996))).alias("num_flag"))
    nums = per.join(t.contacts().select("contact_id", "c_mktsegment", "band"), "contact_id")
    ents = t.contacts().withColumn("den_flag", flag(F.col("c_acctbal") > 0))
    return split_population(ents, nums, ["contact_id", "c_mktsegment", "band"], COHORT, {
        "sp_den": sum_long("den_flag"),
        "sp_num": sum_long("num_flag"),
        "sp_num_of_den": sum_long(flag((F.col("num_flag") == 1) & (F.col("den_flag") == 1))),
    })


@register("cohort_projected_completion")
def projected_completion_q(t: Commerce) -> DataFrame:
    """Year-2000 orders finished, or pending with price >= 150000 and
    priority not 4/5, over all year-2000 orders."""
    price = F.col("o_totalprice")
    num = (st() == "F") | ((st() == "P") & (price >= 150000) & ~pr().isin(NOT_SPECIFIED, LOW))
    per = t.orders().filter(in_year("o_orderdate", 2000)).groupBy("contact_id").agg(
        F.sum(flag(num)).alias("n"), F.count(F.lit(1)).alias("d"))
    j = per.join(dims(t), "contact_id")
    return cohort_agg(j, COHORT, {"pc_num": sum_long("n"), "pc_denom": sum_long("d")})


# --------------------------------------------------------------- K09 / K10 / K11 / K19
@register("distinct_entity_count")
def distinct_count_q(t: Commerce) -> DataFrame:
    """Distinct customers with an URGENT order, beside the order count."""
    j = t.orders().filter(pr() == URGENT).select("contact_id").join(dims(t), "contact_id")
    return distinct_entity_count(j, "contact_id", COHORT, "dc_urgent_customers",
                                 extra={"dc_urgent_orders": F.count(F.lit(1))})


def nps_from_cells(cells: DataFrame) -> DataFrame:
    out = cells.filter(F.col("nps_respondents").isNotNull()).select(
        *KEYS, "nps_promoters", "nps_detractors", "nps_respondents")
    return out.withColumn("nps_score", F.round(nps_score("nps_promoters", "nps_detractors",
                                                         "nps_respondents"), 6))


def nps_table(t: Commerce) -> DataFrame:
    return nps_from_cells(event_metrics(t))


@register("nps")
def nps_q(t: Commerce) -> DataFrame:
    """answer = least(floor(value/10), 10); 9-10 promote, 0-6 detract."""
    return nps_table(t)


@register("likert_agree")
def likert_q(t: Commerce) -> DataFrame:
    """One question, AND of two, OR of three (English, Spanish, misspelt)."""
    v, et = F.col("value"), F.col("event_type")
    band = (F.when(v >= 60, "Strongly Agree").when(v >= 30, "Agree")
            .when(v >= 10, "Disagree").otherwise("Strongly Disagree"))
    es = F.when(v >= 80, "Totalmente de acuerdo").when(v >= 45, "De acuerdo").otherwise("En desacuerdo")
    typo = F.when(et == "click", "StronglyAgree").when(et == "view", "Agree").otherwise("Disagree")
    r = t.events().select(F.col("user_id").alias("contact_id"), et.alias("q_type"),
                          band.alias("q_band"), es.alias("q_es"), typo.alias("q_typo"))
    per = r.groupBy("contact_id").agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(likert_agree({"q_band": AGREE_EN})).alias("a1"),
        F.sum(likert_agree({"q_type": AGREE_TYPES, "q_band": AGREE_EN}, "all")).alias("a2"),
        F.sum(likert_agree({"q_band": AGREE_EN, "q_es": AGREE_ES, "q_typo": AGREE_MISSPELT},
                           "any")).alias("a3"))
    j = per.join(dims(t), "contact_id", "left")
    return cohort_agg(j, COHORT, {
        "lk_respondents": sum_long("n"), "lk_distinct_respondents": F.count("contact_id"),
        "lk_agree_band": sum_long("a1"), "lk_agree_both": sum_long("a2"),
        "lk_agree_any": sum_long("a3")})


def support_table(t: Commerce, grain: str) -> DataFrame:
    o98 = t.orders().filter(in_year("o_orderdate", 1998))
    need_pred = pr().isin(URGENT, HIGH)
    # need: one row per (customer, qualifying priority) — two priorities count twice
    need_rows = o98.filter(need_pred).select("contact_id", "o_orderpriority").distinct()
    need = need_rows.join(dims(t), "contact_id").groupBy(*KEYS).agg(
        F.count(F.lit(1)).alias("need_count"))
    # the customers in need with their cell, once; each fact is joined to them once
    needy = restrict_to_members(dims(t), "contact_id", members(o98, "contact_id", need_pred))
    sess_orders = o98.select("o_orderkey", "contact_id").join(needy, "contact_id")
    li = t.lineitem().filter(F.col("l_quantity") > 0).select("l_orderkey", "l_quantity")
    sessions = (li.join(sess_orders, li["l_orderkey"] == sess_orders["o_orderkey"])
                .groupBy(*KEYS).agg(F.sum("l_quantity").alias("sessions")))
    # a note is a customer's day with clicks: several click events make one note
    ev = t.events().filter(F.col("event_type") == "click").select(
        F.col("user_id").alias("contact_id"), F.concat_ws("/", "user_id", F.to_date("ts")).alias("note"))
    notes = distinct_entity_count(ev.join(needy, "contact_id"), "note", COHORT, "notes")
    out = average_support(sessions, notes, need, COHORT, site="n_name", grain=grain)
    return out.select(*KEYS, F.col("support_total").cast("bigint").alias("support_total"),
                      "need_count", F.round("avg_support", 6).alias("avg_support"))


@register("average_support_per_entity")
def support_q(t: Commerce) -> DataFrame:
    """K19 cohort grain: (quantity + click notes) per customer in need."""
    return support_table(t, "cohort")


@register("average_support_per_entity_site")
def support_site_q(t: Commerce) -> DataFrame:
    """K19 literal: notes joined on the site alone (fan-out semantics)."""
    return support_table(t, "site")


# --------------------------------------------------------------- K18 / K27 / K28
def wide_tables(t: Commerce) -> list[DataFrame]:
    return [k01_table(t), k06_table(t), k07_table(t), k12_table(t)]


@register("wide_assembly")
def wide_q(t: Commerce) -> DataFrame:
    """Contact spine ⟕ K01, K06, K07, K12 on the cell (plain '=')."""
    return assemble(spine(t.contacts(), COHORT), wide_tables(t), COHORT)


@register("wide_assembly_null_safe")
def wide_null_safe_q(t: Commerce) -> DataFrame:
    """K18 options: NULL-safe keys (a NULL-band cell gets its values) on the
    one-shuffle union plan (stack, MAX per cell, one join)."""
    return assemble(spine(t.contacts(), COHORT), wide_tables(t), COHORT, null_safe=True,
                    method="union")


@register("metric_registry")
def registry_q(t: Commerce) -> DataFrame:
    """Validate the wide table against the registry, add _percent columns."""
    from kpiloom.plans.registry import TWIN_REGISTRY
    wide = assemble(spine(t.contacts(), COHORT), wide_tables(t), COHORT)
    TWIN_REGISTRY.validate(wide, strict=True)
    return TWIN_REGISTRY.add_percent_columns(wide)


# ---- K28: the nightly job on shared profiles --------------------------------
# Every team table above re-reads its facts, which is right for one table on
# its own.  The job that builds them all shares two fact profiles instead:
# lineitem is reduced to order grain once and orders (with that) to customer
# grain once, carrying every per-customer quantity the teams need.  The job
# writes the cohort aggregate of it and reads it back (lineage cut).

def line_profile(t: Commerce, as_of: str = AS_OF) -> DataFrame:
    """Order grain: rate inputs and open-line counts from one lineitem pass."""
    q = F.col("l_quantity")
    is_open = (F.col("l_linestatus") == "O") & open_before(F.col("l_shipdate"), as_of)
    return t.lineitem().groupBy("l_orderkey").agg(
        F.sum(F.when(F.col("l_returnflag") != "R", q).otherwise(0)).alias("n"),
        F.sum(q).alias("d"), F.sum(flag(is_open)).alias("open_lines"))


def contact_profile(t: Commerce, as_of: str = AS_OF) -> DataFrame:
    """Customer grain, one orders pass: everything the order-based teams use,
    joined to the customer's cell."""
    o = t.orders()
    lp = line_profile(t, as_of)
    j = o.join(lp, o["o_orderkey"] == lp["l_orderkey"], "left")
    has_lines = F.col("l_orderkey").isNotNull()
    base = F.col("gterm") == P_BASE
    later = F.col("gterm").isin(*P_LATER)
    ok = st() != "P"
    prof = j.groupBy("contact_id").agg(
        F.sum("n").alias("rr_n"), F.sum("d").alias("rr_d"), F.max(flag(has_lines)).alias("has_lines"),
        *[F.max(flag(p())).alias(n) for n, p in EF_FLAGS.items()],
        F.count(F.lit(1)).alias("cc_orders"), F.sum(flag(pr().isin(URGENT, HIGH))).alias("cc_urgent_high"),
        F.max(flag(in_year("o_orderdate", 1997) & has_lines)).alias("ret_active_97"),
        F.max(flag(in_year("o_orderdate", 1998))).alias("ret_active_98"),
        F.max(F.when(base, flag(ok))).alias("p_group"),
        # K13 per site (order priority): later orders, and those that qualify
        *[F.sum(flag(later & (pr() == p))).alias(f"p_n{i}") for i, p in enumerate(PRIORITIES)],
        *[F.sum(flag(later & ok & (pr() == p))).alias(f"p_k{i}") for i, p in enumerate(PRIORITIES)],
        F.sum("open_lines").alias("open_lines"))
    return dims(t).join(prof, "contact_id", "left")


def order_team_metrics(pc: DataFrame) -> DataFrame:
    """All six order-based team tables in one cohort aggregate.

    Each team's row filter becomes a conditional aggregate of the NULL kind
    (``sum(when(p, x))``), so a cell where nobody qualifies keeps NULL, as
    the team's own table (where the cell is absent) gives after the join.
    """
    rate = F.try_divide(F.col("rr_n"), F.col("rr_d"))
    ef = {n: F.coalesce(F.col(n), F.lit(0)) for n in EF_FLAGS}
    ef["ef_urgent_or_pending_low"] = F.greatest(ef["ef_urgent_1998"], ef["ef_pending_low"])
    cc_ok = ((F.coalesce(F.col("cc_orders"), F.lit(0)) >= 12)
             & (F.coalesce(F.col("cc_urgent_high"), F.lit(0)) >= 5))
    ret = F.col("ret_active_97") == 1
    sites = [(F.col(f"p_n{i}"), F.col(f"p_k{i}")) for i in range(len(PRIORITIES))]
    grp = (F.col("p_group") == 1) & (sum((n for n, _ in sites), F.lit(0)) > 0)
    persisted = F.greatest(*[flag((n > 0) & (n == k)) for n, k in sites])
    return cohort_agg(pc, COHORT, {
        "rr_rated": F.count(rate),
        "rr_above": sum_long(F.when(F.col("has_lines") == 1, flag(rate >= RATE_THRESHOLD))),
        "rr_above_all": sum_long(flag(rate >= RATE_THRESHOLD)),
        **{n: sum_long(c) for n, c in ef.items()},
        "cc_num": sum_long(flag(cc_ok)), "cc_denom": F.count("contact_id"),
        "ret_denom": sum_long(F.when(ret, 1)), "ret_num": sum_long(F.when(ret, F.col("ret_active_98"))),
        "persist_denom": sum_long(F.when(grp, 1)),
        "persist_num": sum_long(F.when(grp, persisted)),
        "or_open_records": sum_long(F.when(F.col("open_lines") > 0, F.col("open_lines"))),
    })


# team table = its columns of the shared cohort aggregate; the column named
# second says whether the team has a row for the cell at all
ORDER_TEAMS = {
    "rates": (["rr_rated", "rr_above", "rr_above_all"], None),
    "existence": ([*EF_FLAGS, "ef_urgent_or_pending_low"], None),
    "child_counts": (["cc_num", "cc_denom"], None),
    "retention": (["ret_denom", "ret_num"], "ret_denom"),
    "persistence": (["persist_denom", "persist_num"], "persist_denom"),
    "open_records": (["or_open_records"], "or_open_records"),
}


def order_team(name: str):
    cols, present = ORDER_TEAMS[name]

    def build(shared):
        m = shared["order_metrics"]
        if present:
            m = m.filter(F.col(present).isNotNull())
        return m.select(*KEYS, *cols)
    return build


def job_teams(t: Commerce) -> list:
    from kpiloom.plans.job import Team
    return [
        Team("indicators", lambda shared: k01_table(t)),
        *[Team(n, order_team(n), cadence="monthly" if n == "open_records" else "nightly")
          for n in ORDER_TEAMS],
        Team("nps", lambda shared: nps_from_cells(shared["event_metrics"])),
    ]


def twin_nightly_job(t: Commerce, sink: str, as_of: str = AS_OF) -> DataFrame:
    """One pass over lineitem and orders for all order-based teams: the
    customer profile feeds one cohort aggregate, which is materialised
    (cohort grain: small) and projected into the team tables.  The monthly
    snapshot's numbers are those of its own day."""
    from kpiloom.plans.job import KpiJob
    teams = job_teams(t)
    due = {team.due(dt.date.fromisoformat(as_of)).isoformat() for team in teams if team.cadence == "monthly"}
    p = KpiJob(spine=lambda shared: join_prep_table(t, shared["event_metrics"]), teams=teams,
               cohort=COHORT,
               shared={"order_metrics": lambda: order_team_metrics(contact_profile(t, *due)),
                       "event_metrics": lambda: event_metrics(t)})
    return p.run(as_of=as_of, sink=sink, spark=t.spark)


@register("kpi_nightly_job")
def nightly_job_q(t: Commerce) -> DataFrame:
    """join_prep spine ⟕ eight team tables built from shared profiles,
    written to and published in the session's shared folder when called."""
    return twin_nightly_job(t, shared_dir(t.spark, f"nightly-{uuid.uuid4().hex}"))


#: Two nights: the second falls before the next month's snapshot day.
NIGHTS = ("1998-03-10", "1998-04-02")


@register("kpi_two_nights")
def two_nights_q(t: Commerce) -> DataFrame:
    """Two runs into one sink, then the published tables read back.

    The second night finds March's snapshot published by the first and keeps
    it; both nights' wide tables and the snapshot are read by name from what
    the manifests say."""
    from kpiloom.sources.published import Published
    sink = shared_dir(t.spark, f"nights-{uuid.uuid4().hex}")
    for night in NIGHTS:
        twin_nightly_job(Commerce(t.spark, t.cat.root), sink, night)
    published = Published(t.spark, sink)
    first, second = (published.table("team_kpi_table", as_of=dt.date.fromisoformat(night)) for night in NIGHTS)
    kept = published.table("open_records").select(*KEYS, F.col("or_open_records").alias("kept_open_records"))
    earlier = first.select(*KEYS, *[F.col(c).alias(f"first_{c}") for c in ("nps_promoters", "or_open_records")])
    return second.join(earlier, KEYS, "left").join(kept, KEYS, "left")
