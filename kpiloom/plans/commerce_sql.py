"""Oracle SQL (DuckDB) for the twin queries in ``commerce``.

Written from the definition of each metric, in a structure of its own
(grouped subqueries, EXISTS, filtered counts), so that agreement with the
Spark plans is an independent check.  Integers are cast to BIGINT and ratios
rounded to 6 digits on both sides.
"""

from __future__ import annotations

CONTACTS = """contacts AS (
  SELECT c.c_custkey AS contact_id, c.c_nationkey, r.r_name, n.n_name, c.c_mktsegment,
         CASE WHEN c.c_acctbal >= 5000 THEN 'HIGH' WHEN c.c_acctbal >= 0 THEN 'LOW' END AS band,
         c.c_acctbal
  FROM customer c
  LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
  LEFT JOIN region r ON n.n_regionkey = r.r_regionkey)"""

TERMS = """terms AS (
  SELECT o_orderkey AS at_id, o_custkey AS contact_id, o_orderstatus, o_orderpriority,
         o_totalprice, o_orderdate, year(o_orderdate) AS yr,
         year(o_orderdate) * 10 + quarter(o_orderdate) AS gterm
  FROM orders)"""

KEYS = "n_name, c_mktsegment, band"


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"


def on_keys(a: str, b: str) -> str:
    return " AND ".join(f"{a}.{k} = {b}.{k}" for k in ("n_name", "c_mktsegment", "band"))


SQL: dict[str, str] = {}

SQL["indicator_cohort_sum"] = with_(CONTACTS) + f"""
SELECT {KEYS},
  CAST(COUNT(contact_id) AS BIGINT) AS ind_contact_count,
  CAST(SUM(CASE WHEN c_acctbal >= 7500 THEN 1 ELSE 0 END) AS BIGINT) AS ind_high_balance,
  CAST(SUM(CASE WHEN c_acctbal < 0 THEN 1 ELSE 0 END) AS BIGINT) AS ind_negative_balance,
  CAST(SUM(CASE WHEN c_mktsegment = 'BUILDING' AND c_acctbal >= 5000 THEN 1 ELSE 0 END) AS BIGINT)
    AS ind_building_high,
  CAST(SUM(CASE WHEN c_mktsegment NOT IN ('MACHINERY', 'AUTOMOBILE') AND c_acctbal > 1000
           THEN 1 ELSE 0 END) AS BIGINT) AS ind_other_mid
FROM contacts
GROUP BY {KEYS}"""

_ROLL = """CAST(SUM(num) AS BIGINT) AS high_balance_num, CAST(SUM(den) AS BIGINT) AS high_balance_den,
  ROUND(CAST(SUM(num) AS DOUBLE) / NULLIF(SUM(den), 0), 6) AS high_balance_ratio"""
SQL["ratio_rollup"] = with_(CONTACTS, """k AS (
  SELECT r_name, n_name, c_mktsegment, band, COUNT(contact_id) AS den,
         SUM(CASE WHEN c_acctbal >= 7500 THEN 1 ELSE 0 END) AS num
  FROM contacts GROUP BY r_name, n_name, c_mktsegment, band)""") + f"""
SELECT 'National' AS level, CAST(NULL AS VARCHAR) AS r_name, CAST(NULL AS VARCHAR) AS n_name, {_ROLL}
FROM k
UNION ALL
SELECT 'region' AS level, r_name, CAST(NULL AS VARCHAR) AS n_name, {_ROLL} FROM k GROUP BY r_name
UNION ALL
SELECT 'site' AS level, r_name, n_name, {_ROLL} FROM k GROUP BY r_name, n_name"""

SQL["dimension_attribute_carry"] = with_(CONTACTS) + f"""
SELECT c.n_name, c.c_mktsegment, c.band,
  CAST(COUNT(c.contact_id) AS BIGINT) AS dc_head_count,
  ROUND(MAX(a.capacity), 6) AS dc_capacity
FROM contacts c
LEFT JOIN (SELECT s_nationkey, MAX(s_acctbal) AS capacity FROM supplier GROUP BY s_nationkey) a
  ON a.s_nationkey = c.c_nationkey
GROUP BY c.n_name, c.c_mktsegment, c.band"""

SQL["named_segment_filter"] = with_(CONTACTS, TERMS) + """
SELECT c.n_name, c.c_mktsegment, c.band,
  CAST(COUNT(*) AS BIGINT) AS seg_orders,
  CAST(SUM(CASE WHEN t.o_orderstatus = 'O' THEN 1 ELSE 0 END) AS BIGINT) AS seg_open_orders,
  CAST(COUNT(DISTINCT t.contact_id) AS BIGINT) AS seg_customers
FROM terms t JOIN contacts c ON c.contact_id = t.contact_id
WHERE (t.o_orderpriority IN ('1-URGENT', '2-HIGH')
       OR (t.o_orderpriority = '3-MEDIUM' AND t.yr = 1998))
  AND t.o_orderstatus != 'P'
GROUP BY c.n_name, c.c_mktsegment, c.band"""

# a count is NULL, not 0, in a cell where no order qualifies
SQL["shared_denominators"] = with_(CONTACTS) + f"""
SELECT {KEYS}, COUNT(*)::BIGINT AS sd_order_count,
  NULLIF(COUNT(*) FILTER (WHERE o_orderstatus = 'F'), 0)::BIGINT AS sd_finished,
  NULLIF(COUNT(*) FILTER (WHERE o_orderstatus = 'O'), 0)::BIGINT AS sd_open,
  NULLIF(COUNT(*) FILTER (WHERE (o_orderstatus, o_orderpriority) = ('P', '1-URGENT')), 0)::BIGINT AS sd_pending_urgent,
  NULLIF(COUNT(*) FILTER (WHERE o_orderpriority < '3'), 0)::BIGINT AS sd_urgent_high
FROM orders JOIN contacts ON contact_id = o_custkey
WHERE o_orderdate >= DATE '1998-01-01' AND o_orderdate < DATE '1999-01-01'
GROUP BY {KEYS}"""

SQL["survey_completion_join"] = with_(CONTACTS) + f"""
SELECT 'National' AS national, c.r_name, c.n_name, c.c_mktsegment, c.band,
  COUNT(*)::BIGINT AS jp_contact_count,
  NULLIF(COUNT(*) FILTER (WHERE c_acctbal >= 7500), 0)::BIGINT AS jp_top_tier,
  NULLIF(COUNT(*) FILTER (WHERE c_acctbal < 0), 0)::BIGINT AS jp_negative,
  ANY_VALUE(s.people)::BIGINT AS sc_denominator, ANY_VALUE(s.done)::BIGINT AS sc_count
FROM contacts c
LEFT JOIN (SELECT {KEYS}, COUNT(DISTINCT user_id) AS people, COUNT(*) FILTER (WHERE event_type = 'purchase') AS done
           FROM events JOIN contacts ON contact_id = user_id GROUP BY ALL) s ON {on_keys('s', 'c')}
GROUP BY c.r_name, c.n_name, c.c_mktsegment, c.band"""



def _rate_sql(p: str, weight: str = "1", where: str = "true", tables: str = "lineitem JOIN orders ON o_orderkey = l_orderkey") -> str:
    """Share of a customer's quantity that was not returned, each line counted
    ``weight`` times: customers with a rate, and those at 0.7 or more."""
    return with_(CONTACTS, f"""quantities AS (
  SELECT o_custkey AS who, SUM(l_quantity * {weight}) AS bought,
         SUM(l_quantity * {weight}) FILTER (WHERE l_returnflag IN ('A', 'N')) AS kept
  FROM {tables} WHERE {where} GROUP BY who)""", """rates AS (
  SELECT who, COALESCE(kept, 0) / bought AS rate FROM quantities WHERE bought <> 0
  UNION ALL SELECT who, NULL FROM quantities WHERE bought = 0 OR bought IS NULL)""") + f"""
SELECT {KEYS}, COUNT(rate)::BIGINT AS {p}_rated,
  CASE WHEN COUNT(who) > 0 THEN COUNT(*) FILTER (WHERE rate >= 0.7) END::BIGINT AS {p}_above,
  COUNT(*) FILTER (WHERE rate >= 0.7)::BIGINT AS {p}_above_all
FROM contacts LEFT JOIN rates ON who = contact_id
GROUP BY {KEYS}"""


SQL["ratio_rate_threshold"] = _rate_sql("rr")

# a line counts once for every URGENT order of its quarter, and not at all without one
SQL["ratio_rate_threshold_term"] = _rate_sql("rt", "urgent", tables="""lineitem JOIN orders ON o_orderkey = l_orderkey
  JOIN (SELECT date_trunc('quarter', o_orderdate) AS q, COUNT(*) AS urgent FROM orders WHERE o_orderpriority = '1-URGENT' GROUP BY q)
    ON q = date_trunc('quarter', o_orderdate)""")

SQL["pattern_filtered_rate"] = _rate_sql("pf", where="""l_partkey IN (
    SELECT p_partkey FROM part WHERE regexp_matches(p_name, 'widget|gizmo') AND NOT contains(p_name, 'red'))""")

SQL["three_state_rate"] = with_(CONTACTS, TERMS, """att AS (
  SELECT t.contact_id,
    SUM(CASE WHEN l.l_discount = 0 AND l.l_returnflag = 'R' AND l.l_linestatus = 'F'
             THEN l.l_quantity ELSE 0 END) AS attended,
    SUM(CASE WHEN l.l_discount = 0 AND l.l_returnflag = 'R' THEN l.l_quantity ELSE 0 END) AS enrolled
  FROM lineitem l JOIN terms t ON t.at_id = l.l_orderkey
  GROUP BY t.contact_id)""", """j AS (
  SELECT c.n_name, c.c_mktsegment, c.band,
    CASE WHEN a.enrolled = 0 THEN NULL
         WHEN a.attended / a.enrolled >= 0.5 THEN 1 ELSE 0 END AS above
  FROM contacts c LEFT JOIN att a ON a.contact_id = c.contact_id)""") + f"""
SELECT {KEYS}, CAST(SUM(above) AS BIGINT) AS ts_above, CAST(COUNT(above) AS BIGINT) AS ts_rated
FROM j GROUP BY {KEYS}"""

SQL["ratio_predicate"] = with_(CONTACTS, TERMS) + """
SELECT c.n_name, c.c_mktsegment, c.band,
  CAST(COUNT(*) AS BIGINT) AS rp_lines,
  CAST(SUM(CASE WHEN l.l_tax / NULLIF(l.l_discount, 0) <= 0.5 THEN 1 ELSE 0 END) AS BIGINT) AS rp_ok,
  CAST(SUM(CASE WHEN l.l_discount = 0 THEN 1 ELSE 0 END) AS BIGINT) AS rp_zero_divisor
FROM lineitem l JOIN terms t ON t.at_id = l.l_orderkey
JOIN contacts c ON c.contact_id = t.contact_id
GROUP BY c.n_name, c.c_mktsegment, c.band"""


_EXISTS = {
    "ef_urgent_1998": "o_orderpriority = '1-URGENT' AND year(o_orderdate) = 1998",
    "ef_finished_high": "o_orderstatus = 'F' AND o_orderpriority = '2-HIGH'",
    "ef_pending_low": "o_orderstatus = 'P' AND o_orderpriority = '5-LOW'",
    "ef_open_2001": "o_orderstatus = 'O' AND year(o_orderdate) = 2001",
}
_EXISTS["ef_urgent_or_pending_low"] = f"{_EXISTS['ef_urgent_1998']} OR {_EXISTS['ef_pending_low']}"
SQL["existence_flags"] = with_(CONTACTS) + f"""
SELECT {KEYS}, {', '.join(f'COUNT(*) FILTER (WHERE contact_id IN (SELECT o_custkey FROM orders WHERE {p}))::BIGINT AS {n}' for n, p in _EXISTS.items())}
FROM contacts GROUP BY {KEYS}"""

SQL["child_count_threshold"] = with_(CONTACTS, """per AS (
  SELECT c.contact_id, c.n_name, c.c_mktsegment, c.band,
    SUM(CASE WHEN o.o_orderkey IS NOT NULL THEN 1 ELSE 0 END) AS any_orders,
    SUM(CASE WHEN o.o_orderpriority IN ('1-URGENT', '2-HIGH') THEN 1 ELSE 0 END) AS urgent_high
  FROM contacts c LEFT JOIN orders o ON o.o_custkey = c.contact_id
  GROUP BY c.contact_id, c.n_name, c.c_mktsegment, c.band)""") + f"""
SELECT {KEYS},
  CAST(SUM(CASE WHEN any_orders >= 12 AND urgent_high >= 5 THEN 1 ELSE 0 END) AS BIGINT) AS cc_num,
  CAST(COUNT(contact_id) AS BIGINT) AS cc_denom
FROM per GROUP BY {KEYS}"""

SQL["membership_semi_join"] = with_(CONTACTS, TERMS) + """
SELECT c.n_name, c.c_mktsegment, c.band,
  CAST(COUNT(*) AS BIGINT) AS ms_lines,
  CAST(SUM(l.l_quantity) AS BIGINT) AS ms_quantity,
  CAST(COUNT(DISTINCT l.l_orderkey) AS BIGINT) AS ms_orders
FROM lineitem l
LEFT JOIN terms t ON t.at_id = l.l_orderkey
LEFT JOIN contacts c ON c.contact_id = t.contact_id
WHERE t.contact_id IN (SELECT contact_id FROM terms
                       WHERE o_orderpriority = '1-URGENT' AND gterm = 19984)
GROUP BY c.n_name, c.c_mktsegment, c.band"""

SQL["activity_flags_any"] = with_(CONTACTS, TERMS, """act AS (
  SELECT t.contact_id,
    MAX(CASE WHEN p.p_type = 'ECONOMY' THEN 1 ELSE 0 END) AS af_economy,
    MAX(CASE WHEN l.l_returnflag = 'R' AND p.p_size >= 40 THEN 1 ELSE 0 END) AS af_large_returned,
    MAX(CASE WHEN t.yr = 1998 AND p.p_name LIKE '%widget%' THEN 1 ELSE 0 END) AS af_widget_1998
  FROM lineitem l
  JOIN part p ON p.p_partkey = l.l_partkey
  JOIN terms t ON t.at_id = l.l_orderkey
  GROUP BY t.contact_id)""") + """
SELECT c.n_name, c.c_mktsegment, c.band,
  CAST(SUM(a.af_economy) AS BIGINT) AS af_economy,
  CAST(SUM(a.af_large_returned) AS BIGINT) AS af_large_returned,
  CAST(SUM(a.af_widget_1998) AS BIGINT) AS af_widget_1998,
  CAST(COUNT(a.contact_id) AS BIGINT) AS af_active
FROM contacts c LEFT JOIN act a ON a.contact_id = c.contact_id
GROUP BY c.n_name, c.c_mktsegment, c.band"""


def _growth_sql(period_expr: str, p: str) -> str:
    """Each customer's periods against the period before, found by a maximum."""
    low = f"""low AS (
  SELECT o.o_custkey AS who, {period_expr} AS period, MIN(o.o_totalprice) AS price FROM orders o GROUP BY ALL)"""
    return with_(CONTACTS, low) + f"""
SELECT {KEYS}, COUNT(*) FILTER (WHERE now.price > earlier.price)::BIGINT AS {p}_grew, COUNT(*)::BIGINT AS {p}_pairs
FROM (SELECT a.who, a.period, a.price, MAX(b.period) AS before
      FROM low a JOIN low b ON b.who = a.who AND b.period < a.period GROUP BY ALL) now
JOIN low earlier ON earlier.who = now.who AND earlier.period = now.before
JOIN contacts ON contact_id = now.who
GROUP BY {KEYS}"""


SQL["score_growth_year"] = _growth_sql("CAST(year(o.o_orderdate) AS VARCHAR)", "sg_year")
SQL["score_growth_term"] = _growth_sql("CAST(date_trunc('quarter', o.o_orderdate) AS DATE)", "sg_term")

SQL["retention"] = with_(CONTACTS) + f"""
SELECT {KEYS}, COUNT(*)::BIGINT AS ret_denom,
  COUNT(*) FILTER (WHERE contact_id IN (SELECT o_custkey FROM orders WHERE year(o_orderdate) = 1998))::BIGINT AS ret_num
FROM contacts
WHERE contact_id IN (SELECT o_custkey FROM orders
                     WHERE year(o_orderdate) = 1997 AND o_orderkey IN (SELECT l_orderkey FROM lineitem))
GROUP BY {KEYS}"""

_LATER = "gterm IN (19981, 19982, 19984)"
SQL["persistence"] = with_(CONTACTS, TERMS) + f"""
SELECT {KEYS}, COUNT(*)::BIGINT AS persist_denom,
  COUNT(*) FILTER (WHERE contact_id IN (
    SELECT contact_id FROM terms WHERE {_LATER}
    GROUP BY contact_id, o_orderpriority HAVING bool_and(o_orderstatus <> 'P')))::BIGINT AS persist_num
FROM contacts
WHERE contact_id IN (SELECT contact_id FROM terms WHERE gterm = 19974 AND o_orderstatus <> 'P')
  AND contact_id IN (SELECT contact_id FROM terms WHERE {_LATER})
GROUP BY {KEYS}"""

SQL["exact_period_presence"] = with_(CONTACTS, TERMS, """rg AS (
  SELECT t.contact_id, c.n_name, c.c_mktsegment, c.band, COUNT(t.at_id) AS n
  FROM terms t LEFT JOIN contacts c ON c.contact_id = t.contact_id
  WHERE t.o_orderstatus = 'F' AND t.gterm IN (19981, 19983)
  GROUP BY t.contact_id, c.n_name, c.c_mktsegment, c.band)""") + f"""
SELECT {KEYS}, CAST(COUNT(contact_id) AS BIGINT) AS ep_two_periods
FROM rg WHERE n = 2 GROUP BY {KEYS}"""


def _switch_sql(first: str, next_: str) -> str:
    """Orders of the quarter that counts on the day: before the cut-off the
    day's own, after it the one before (the bounds are chosen here)."""
    return with_(CONTACTS) + f"""
SELECT {KEYS}, COUNT(*)::BIGINT AS sw_rows, COUNT(*) FILTER (WHERE o_orderstatus = 'F')::BIGINT AS sw_finished
FROM orders JOIN contacts ON contact_id = o_custkey
WHERE o_orderdate >= DATE '{first}' AND o_orderdate < DATE '{next_}' GROUP BY {KEYS}"""


SQL["as_of_period_switch"] = _switch_sql("1998-01-01", "1998-04-01")        # on 1998-03-05: this quarter
SQL["as_of_period_switch_after"] = _switch_sql("1998-04-01", "1998-07-01")  # on 1998-09-05: the quarter before


def _open_sql(cond: str) -> str:
    return with_(CONTACTS, TERMS) + f"""
SELECT c.n_name, c.c_mktsegment, c.band, CAST(COUNT(*) AS BIGINT) AS or_open_records
FROM lineitem l
LEFT JOIN terms t ON t.at_id = l.l_orderkey
LEFT JOIN contacts c ON c.contact_id = t.contact_id
WHERE l.l_linestatus = 'O' AND {cond}
GROUP BY c.n_name, c.c_mktsegment, c.band"""


SQL["open_records_snapshot"] = _open_sql(
    "EXTRACT(MONTH FROM l.l_shipdate) < EXTRACT(MONTH FROM DATE '1998-03-05')")
SQL["open_records_snapshot_year_aware"] = _open_sql(
    "CAST(l.l_shipdate AS DATE) < date_trunc('month', DATE '1998-03-05')")

SQL["distinct_population_denominator"] = with_(CONTACTS, TERMS, """g AS (
  SELECT DISTINCT t.contact_id, c.n_name, c.c_mktsegment, c.band, t.o_orderpriority
  FROM terms t LEFT JOIN contacts c ON c.contact_id = t.contact_id
  WHERE t.yr = 1995 AND t.o_orderstatus != 'P')""") + f"""
SELECT {KEYS}, CAST(COUNT(contact_id) AS BIGINT) AS dp_denom,
  CAST(SUM(CASE WHEN o_orderpriority NOT IN ('4-NOT SPECIFIED', '5-LOW') THEN 1 ELSE 0 END) AS BIGINT)
    AS dp_on_track
FROM g GROUP BY {KEYS}"""

SQL["split_population_ratio"] = with_(CONTACTS, TERMS, """nums AS (
  SELECT t.contact_id, c.c_mktsegment, c.band,
    MAX(CASE WHEN t.o_orderstatus = 'F' AND t.yr = 1996 THEN 1 ELSE 0 END) AS num_flag
  FROM terms t LEFT JOIN contacts c ON c.contact_id = t.contact_id
  GROUP BY t.contact_id, c.c_mktsegment, c.band)""", """j AS (
  SELECT c.n_name, c.c_mktsegment, c.band,
    CASE WHEN c.c_acctbal > 0 THEN 1 ELSE 0 END AS den_flag, n.num_flag
  FROM contacts c
  LEFT JOIN nums n ON n.contact_id = c.contact_id AND n.c_mktsegment = c.c_mktsegment
                  AND n.band = c.band)""") + f"""
SELECT {KEYS}, CAST(SUM(den_flag) AS BIGINT) AS sp_den, CAST(SUM(num_flag) AS BIGINT) AS sp_num,
  CAST(SUM(CASE WHEN num_flag = 1 AND den_flag = 1 THEN 1 ELSE 0 END) AS BIGINT) AS sp_num_of_den
FROM j GROUP BY {KEYS}"""

SQL["cohort_projected_completion"] = with_(CONTACTS, TERMS) + """
SELECT c.n_name, c.c_mktsegment, c.band,
  CAST(SUM(CASE WHEN t.o_orderstatus = 'F'
                  OR (t.o_orderstatus = 'P' AND t.o_totalprice >= 150000
                      AND t.o_orderpriority NOT IN ('4-NOT SPECIFIED', '5-LOW'))
           THEN 1 ELSE 0 END) AS BIGINT) AS pc_num,
  CAST(COUNT(*) AS BIGINT) AS pc_denom
FROM terms t JOIN contacts c ON c.contact_id = t.contact_id
WHERE t.yr = 2000
GROUP BY c.n_name, c.c_mktsegment, c.band"""

SQL["distinct_entity_count"] = with_(CONTACTS, TERMS) + """
SELECT c.n_name, c.c_mktsegment, c.band,
  CAST(COUNT(DISTINCT t.contact_id) AS BIGINT) AS dc_urgent_customers,
  CAST(COUNT(*) AS BIGINT) AS dc_urgent_orders
FROM terms t JOIN contacts c ON c.contact_id = t.contact_id
WHERE t.o_orderpriority = '1-URGENT'
GROUP BY c.n_name, c.c_mktsegment, c.band"""

SQL["nps"] = with_(CONTACTS, """answers AS (
  SELECT user_id, CASE WHEN event_type <> 'error' THEN LEAST(FLOOR(value / 10), 10) END AS points FROM events)""") + f"""
SELECT {KEYS},
  COUNT(*) FILTER (WHERE points >= 9)::BIGINT AS nps_promoters,
  COUNT(*) FILTER (WHERE points < 7)::BIGINT AS nps_detractors,
  COUNT(points)::BIGINT AS nps_respondents,
  ROUND(100.0::DOUBLE * (COUNT(*) FILTER (WHERE points >= 9) - COUNT(*) FILTER (WHERE points < 7))
        / NULLIF(COUNT(points), 0), 6) AS nps_score
FROM answers LEFT JOIN contacts ON contact_id = user_id
GROUP BY {KEYS}"""

SQL["likert_agree"] = with_(CONTACTS, """sv AS (
  SELECT user_id, event_type AS q_type,
    CASE WHEN value >= 60 THEN 'Strongly Agree' WHEN value >= 30 THEN 'Agree'
         WHEN value >= 10 THEN 'Disagree' ELSE 'Strongly Disagree' END AS q_band,
    CASE WHEN value >= 80 THEN 'Totalmente de acuerdo' WHEN value >= 45 THEN 'De acuerdo'
         ELSE 'En desacuerdo' END AS q_es,
    CASE WHEN event_type = 'click' THEN 'StronglyAgree' WHEN event_type = 'view' THEN 'Agree'
         ELSE 'Disagree' END AS q_typo
  FROM events)""", """fl AS (
  SELECT c.n_name, c.c_mktsegment, c.band, s.user_id,
    CASE WHEN q_band IN ('Strongly Agree', 'Agree') THEN 1 ELSE 0 END AS a1,
    CASE WHEN q_type IN ('purchase', 'signup') AND q_band IN ('Strongly Agree', 'Agree')
         THEN 1 ELSE 0 END AS a2,
    CASE WHEN q_band IN ('Strongly Agree', 'Agree')
           OR q_es IN ('Totalmente de acuerdo', 'De acuerdo')
           OR q_typo IN ('Strongly Agree', 'StronglyAgree', 'Agree') THEN 1 ELSE 0 END AS a3
  FROM sv s LEFT JOIN contacts c ON c.contact_id = s.user_id)""") + f"""
SELECT {KEYS},
  CAST(COUNT(*) AS BIGINT) AS lk_respondents,
  CAST(COUNT(DISTINCT user_id) AS BIGINT) AS lk_distinct_respondents,
  CAST(SUM(a1) AS BIGINT) AS lk_agree_band,
  CAST(SUM(a2) AS BIGINT) AS lk_agree_both,
  CAST(SUM(a3) AS BIGINT) AS lk_agree_any
FROM fl GROUP BY {KEYS}"""

def _support_sql(total: str) -> str:
    """Quantities and click days of customers in need, per customer in need
    (counted once for each priority that puts them there)."""
    return with_(CONTACTS, TERMS, f"""needy AS (
  SELECT contact_id, {KEYS}, COUNT(DISTINCT o_orderpriority) AS needs
  FROM terms JOIN contacts USING (contact_id)
  WHERE yr = 1998 AND o_orderpriority IN ('1-URGENT', '2-HIGH') GROUP BY ALL)""", f"""days AS (
  SELECT {KEYS}, COUNT(DISTINCT (user_id, CAST(ts AS DATE))) AS notes
  FROM events JOIN needy ON contact_id = user_id WHERE event_type = 'click' GROUP BY ALL)""", f"""bought AS (
  SELECT {KEYS}, SUM(l_quantity) AS q
  FROM lineitem JOIN terms ON at_id = l_orderkey JOIN needy USING (contact_id)
  WHERE yr = 1998 AND l_quantity > 0 GROUP BY ALL)""", f"""totals AS (
  SELECT b.*, ({total}) AS total FROM bought b)""") + f"""
SELECT t.n_name, t.c_mktsegment, t.band, total::BIGINT AS support_total, SUM(needs)::BIGINT AS need_count,
  ROUND(total / SUM(needs), 6) AS avg_support
FROM totals t JOIN needy n ON {on_keys('t', 'n')}
GROUP BY t.n_name, t.c_mktsegment, t.band, total"""


SQL["average_support_per_entity"] = _support_sql(
    f"b.q + COALESCE((SELECT SUM(notes) FROM days d WHERE {on_keys('d', 'b')}), 0)")
# notes meet sessions by site alone: every notes cell of the site adds the sessions once
SQL["average_support_per_entity_site"] = _support_sql(
    "SELECT COUNT(*) * b.q + SUM(notes) FROM days d WHERE d.n_name = b.n_name")


def assemble_sql(spine_sql: str, parts: list[str], null_safe: bool = False) -> str:
    """Left-join the oracle tables onto a spine query, keys kept once."""
    eq = "IS NOT DISTINCT FROM" if null_safe else "="
    sql = f"SELECT * FROM ({spine_sql}) s"
    for i, p in enumerate(parts):
        sql += (f"\nLEFT JOIN (SELECT * RENAME (n_name AS k{i}_n, c_mktsegment AS k{i}_s, "
                f"band AS k{i}_b) FROM ({p})) t{i}"
                f" ON s.n_name {eq} t{i}.k{i}_n AND s.c_mktsegment {eq} t{i}.k{i}_s"
                f" AND s.band {eq} t{i}.k{i}_b")
    drops = ", ".join(f"k{i}_n, k{i}_s, k{i}_b" for i in range(len(parts)))
    return f"SELECT * EXCLUDE ({drops}) FROM ({sql})"


SPINE = with_(CONTACTS) + f"SELECT DISTINCT {KEYS} FROM contacts"
WIDE_PARTS = ["indicator_cohort_sum", "existence_flags", "child_count_threshold", "retention"]
SQL["wide_assembly"] = assemble_sql(SPINE, [SQL[n] for n in WIDE_PARTS])
SQL["wide_assembly_null_safe"] = assemble_sql(SPINE, [SQL[n] for n in WIDE_PARTS], null_safe=True)
SQL["metric_registry"] = f"""
SELECT *,
  ROUND(CAST(ind_high_balance AS DOUBLE) / NULLIF(ind_contact_count, 0), 6) AS ind_high_balance_percent,
  ROUND(CAST(ef_urgent_1998 AS DOUBLE) / NULLIF(ind_contact_count, 0), 6) AS ef_urgent_1998_percent,
  ROUND(CAST(cc_num AS DOUBLE) / NULLIF(cc_denom, 0), 6) AS cc_num_percent,
  ROUND(CAST(ret_num AS DOUBLE) / NULLIF(ret_denom, 0), 6) AS ret_num_percent
FROM ({SQL['wide_assembly']}) w"""

JOB_PARTS = ["indicator_cohort_sum", "ratio_rate_threshold", "existence_flags",
                  "child_count_threshold", "nps", "retention", "persistence",
                  "open_records_snapshot"]
SQL["kpi_nightly_job"] = assemble_sql(SQL["survey_completion_join"], [SQL[n] for n in JOB_PARTS])

# both nights have the numbers of March's snapshot day; the events do not change
_NIGHT = SQL["kpi_nightly_job"]
SQL["kpi_two_nights"] = f"""
SELECT w.*, CASE WHEN band IS NOT NULL THEN nps_promoters END AS first_nps_promoters,
  CASE WHEN band IS NOT NULL THEN or_open_records END AS first_or_open_records,
  CASE WHEN band IS NOT NULL THEN or_open_records END AS kept_open_records
FROM ({_NIGHT}) w"""
