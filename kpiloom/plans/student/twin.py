"""The student team tables on the commerce test tables.

Views give the commerce tables the columns that a team table reads (contacts
from customers, contact terms from orders, sessions from order lines, survey
answers from events), with NULLs and repeated rows, so that the team builders
themselves run on real reads.  ``SQL`` holds the metrics' definitions over the
same views for DuckDB.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kpiloom.plans.student import teams
from kpiloom.plans.student.params import DIMS, StudentParams
from kpiloom.sources.catalog import ParquetCatalog, dealt_by

AA_CONTROL = "ct_helps_me_better_understand_that_i_am_in_control_of_my_academic_performance"
AA_STRETCH = "i_feel_prepared_to_engage_in_academic_stretch_opportunities"
AA_THINKING = "i_have_new_or_improved_critical_thinking_skills"
AA_HABITS = "i_have_new_or_improved_study_habits_skills"

# Columns of the views as expressions that Spark and DuckDB read alike.
CONTACT = {
    "contact_id": "c_custkey", "site_short": "n_name", "Ethnic_background_c": "c_mktsegment",
    "Gender_c": "CASE WHEN c_acctbal >= 5000 THEN 'HIGH' WHEN c_acctbal >= 0 THEN 'LOW' END",
    "grade_c": "CASE c_custkey % 4 WHEN 0 THEN '9th Grade' WHEN 1 THEN '11th Grade' WHEN 2 THEN '12th Grade' END",
    "college_track_status_c": "CASE c_custkey % 6 WHEN 0 THEN '11A' WHEN 1 THEN '11A' WHEN 2 THEN '12A' "
                              "WHEN 3 THEN '15A' WHEN 4 THEN '11A' ELSE '99Z' END",
    "indicator_first_generation_c": "CASE c_custkey % 3 WHEN 0 THEN true WHEN 1 THEN false END",
    "indicator_low_income_c": "CASE c_custkey % 5 WHEN 0 THEN 'No' WHEN 1 THEN NULL ELSE 'Yes' END",
}
TERM = {
    "AT_Id": "o_orderkey", "Contact_Id": "o_custkey",
    "site_short": "site_short", "Ethnic_background_c": "Ethnic_background_c", "Gender_c": "Gender_c",
    "AY_Name": "CASE year(o_orderdate) WHEN 1998 THEN 'AY 2020-21' WHEN 1997 THEN 'AY 2019-20' ELSE 'earlier' END",
    "global_academic_semester_c": "year(o_orderdate) * 10 + quarter(o_orderdate)",
    "current_as_c": "CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE year(o_orderdate) >= 2000 END",
    "grade_c": "CASE o_orderpriority WHEN '1-URGENT' THEN '9th Grade' WHEN '2-HIGH' THEN '11th Grade' "
               "WHEN '3-MEDIUM' THEN '12th Grade' WHEN '4-NOT SPECIFIED' THEN 'Year 1' ELSE '8th Grade' END",
    "college_track_status_c": "CASE WHEN o_orderkey % 11 = 0 THEN NULL WHEN o_orderstatus = 'F' THEN '11A' "
                              "WHEN o_orderstatus = 'O' THEN '18a' ELSE '15A' END",
    "most_recent_valid_cumulative_gpa": "CASE WHEN o_orderkey % 13 = 0 THEN NULL "
                                        "ELSE CAST(o_orderkey % 400 AS DOUBLE) / 100 END",
    "Readiness_Composite_Off_c": "CASE o_orderkey % 3 WHEN 0 THEN '1. Ready' WHEN 1 THEN '2. Near Ready' END",
    "Readiness_10_th_Composite_c": "CASE o_custkey % 3 WHEN 0 THEN '2. Near Ready' WHEN 1 THEN '3. Not Ready' END",
    "composite_readiness_most_recent_c": "CASE o_custkey % 2 WHEN 0 THEN '1. Ready' END",
    "contact_official_test_prep_withdrawal": "CASE WHEN o_custkey % 5 = 0 THEN 'withdrawn' END",
    "indicator_years_since_hs_graduation_c": "o_custkey % 2",
}
SESSION = {
    "Class_Attendance_Id": "l_orderkey * 10 + l_linenumber", "student_c": "o_custkey",
    "Academic_Semester_c": "l_orderkey", "global_academic_semester_c": "year(o_orderdate) * 10 + quarter(o_orderdate)",
    "department_c": "CASE l_returnflag WHEN 'R' THEN 'Academic Affairs' WHEN 'A' THEN 'Wellness' END",
    "Cancelled_c": "l_linenumber = 7", "workshop_display_name_c": "CASE WHEN l_linenumber = 1 THEN 'Senior Seminar' END",
    "dosage_types_c": "CASE l_linenumber % 3 WHEN 0 THEN 'NSO;other' WHEN 1 THEN 'other' END",
    "Outcome_c": "CASE WHEN l_linenumber = 6 THEN 'Cancelled' WHEN l_linestatus = 'O' THEN 'Scheduled' ELSE 'Attended' END",
    "is_deleted": "CASE WHEN l_linenumber = 5 THEN NULL ELSE l_linenumber = 4 END", "date_c": "l_shipdate",
    "Attendance_Numerator_c": "CASE WHEN l_quantity < 5 THEN NULL WHEN l_quantity < 20 THEN 0 ELSE l_quantity END",
    "Attendance_Denominator_c": "l_quantity",
}
_AGREE = "CASE WHEN event_type = '{0}' THEN NULL WHEN value >= {1} THEN 'Strongly Agree' WHEN value >= {2} THEN 'Agree' ELSE 'Disagree' END"
ANSWER = {
    "contact_id": "user_id", AA_CONTROL: _AGREE.format("error", 20, 8), AA_STRETCH: _AGREE.format("view", 15, 5),
    AA_THINKING: _AGREE.format("click", 12, 4), AA_HABITS: _AGREE.format("signup", 18, 9),
    teams.SITE_RUN_Q: _AGREE.format("purchase", 10, 6),
    teams.NPS_Q: "CASE WHEN event_type = 'error' THEN NULL WHEN value >= 20 THEN '10 - extremely likely' "
                 "WHEN value >= 15 THEN '9' WHEN value >= 10 THEN '8' ELSE '3' END",
}


def _view(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    return df.select(*[F.expr(e).alias(n) for n, e in columns.items()])


def source(spark: SparkSession, root: str) -> Callable[[str], DataFrame]:
    """The views by the names that the team builders read."""
    cat = ParquetCatalog(spark, root)
    nation = cat("nation").select("n_nationkey", "n_name")
    contacts = _view(cat("customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left"), CONTACT)
    dims = contacts.select(F.col("contact_id").alias("who"), *DIMS)
    orders = cat("orders")
    tables = {
        "contact_template": contacts,
        "contact_at_template": _view(orders.join(dims, orders["o_custkey"] == dims["who"], "left"), TERM),
        "class_template": _view(dealt_by(cat("lineitem"), "l_orderkey").join(orders, F.col("l_orderkey") == F.col("o_orderkey")), SESSION),
        "fy21_hs_survey": _view(cat("events"), ANSWER),
    }
    return tables.__getitem__


BUILDERS = {"student_academic_affairs": teams.academic_affairs, "student_om": teams.om,
            "student_om_incomplete_attendance": teams.om_incomplete_attendance,
            "student_program_ops": teams.program_ops, "student_red": teams.red}
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name: (lambda spark, root, build=build: build(source(spark, root), StudentParams())) for name, build in BUILDERS.items()}


# ------------------------------------------------------------------ DuckDB SQL
def _select(columns: dict[str, str]) -> str:
    return ", ".join(f'{e} AS "{n}"' for n, e in columns.items())


_VIEWS = f"""WITH people AS (SELECT {_select(CONTACT)} FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey),
terms AS (SELECT {_select(TERM)} FROM orders LEFT JOIN people ON contact_id = o_custkey),
sessions AS (SELECT {_select(SESSION)} FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
answers AS (SELECT {_select(ANSWER)} FROM events)"""
_DIMS = "site_short, Ethnic_background_c, Gender_c"
_YES = "IN ('Strongly Agree', 'Agree')"


def _sum(condition: str, name: str) -> str:
    """0/1 sum over the rows where the row's side of a join is there."""
    return f"SUM(CASE WHEN {condition} THEN 1 ELSE 0 END)::BIGINT AS {name}"


def _sum_if(there: str, condition: str, name: str) -> str:
    return f"SUM(CASE WHEN {there} IS NOT NULL THEN (CASE WHEN {condition} THEN 1 ELSE 0 END) END)::BIGINT AS {name}"


_SENIOR = "(t.grade_c = '12th Grade' OR t.grade_c = 'Year 1' AND t.indicator_years_since_hs_graduation_c = 0)"
_OPT_IN = "t.contact_official_test_prep_withdrawal IS NULL"
_READY = "t.Readiness_Composite_Off_c = '1. Ready'"
_NOT_10 = "t.Readiness_10_th_Composite_c IN ('2. Near Ready', '3. Not Ready')"

SQL: dict[str, str] = {
    # a session counts once for each contact term of this year in its global term
    "student_academic_affairs": _VIEWS + f""",
weights AS (SELECT global_academic_semester_c AS g, COUNT(*) AS n FROM terms WHERE AY_Name = 'AY 2020-21' GROUP BY g),
rates AS (SELECT student_c, SUM(Attendance_Numerator_c * n) / NULLIF(SUM(Attendance_Denominator_c * n), 0) AS rate
          FROM sessions JOIN weights ON g = global_academic_semester_c
          WHERE department_c = 'Academic Affairs' GROUP BY student_c)
SELECT {', '.join('t.' + d for d in DIMS)},
  {_sum('t.most_recent_valid_cumulative_gpa >= 3.25', 'aa_above_325_gpa')},
  {_sum(f'{_READY} AND {_SENIOR} AND {_OPT_IN}', 'aa_composite_ready')},
  {_sum(f"{_READY} AND {_OPT_IN} AND t.grade_c = '11th Grade'", 'aa_composite_ready_eleventh_grade')},
  {_sum(f"{_NOT_10} AND {_OPT_IN} AND t.grade_c NOT IN ('9th Grade', '10th Grade', '11th Grade')", 'aa_tenth_grade_test_not_ready')},
  {_sum(f'{_READY} AND {_OPT_IN} AND {_NOT_10}', 'aa_offical_test_ready')},
  {_sum_if('r.student_c', 'r.rate >= 0.8', 'aa_above_80_aa_attendance')},
  {_sum_if('a.contact_id', f'a.{AA_CONTROL} {_YES}', 'aa_i_am_in_control_of_my_academic_performance')},
  {_sum_if('a.contact_id', f'a.{AA_STRETCH} {_YES}', 'aa_i_feel_prepared_to_engage_in_academic_stretch_opportunities')},
  {_sum_if('a.contact_id', f'a.{AA_THINKING} {_YES} AND a.{AA_HABITS} {_YES}', 'aa_self_perceived_growth_in_executive_functioning_skill')}
FROM terms t LEFT JOIN rates r ON r.student_c = t.Contact_Id LEFT JOIN answers a ON a.contact_id = t.Contact_Id
WHERE t.current_as_c AND t.college_track_status_c = '11A'
GROUP BY ALL""",
    "student_om": _VIEWS + f"""
SELECT {_DIMS}, COUNT(*) FILTER (WHERE a.{teams.SITE_RUN_Q} {_YES})::BIGINT AS OM_agree_site_is_run_effectively
FROM answers a JOIN people p ON p.contact_id = a.contact_id WHERE site_short IS NOT NULL GROUP BY {_DIMS}""",
    "student_om_incomplete_attendance": _VIEWS + f"""
SELECT {_DIMS}, COUNT(*)::BIGINT AS OM_incomplete_wsa_records
FROM sessions s JOIN terms t ON t.AT_Id = s.Academic_Semester_c AND t.current_as_c
WHERE Outcome_c = 'Scheduled' AND month(date_c) < 3 AND NOT is_deleted GROUP BY {_DIMS}""",
    "student_program_ops": _VIEWS + f"""
SELECT {_DIMS},
  {_sum("grade_c = '9th Grade' AND college_track_status_c = '11A' AND indicator_first_generation_c", 'pro_ops_incoming_cohort_first_gen')},
  {_sum("grade_c = '9th Grade' AND college_track_status_c = '11A' AND indicator_low_income_c = 'Yes'", 'pro_ops_incoming_cohort_low_income')},
  {_sum_if('a.contact_id', f"a.{teams.NPS_Q} IN ('10 - extremely likely', '9')", 'nps_promoter')},
  {_sum_if('a.contact_id', f"a.{teams.NPS_Q} NOT IN ('10 - extremely likely', '9', '8', '7')", 'nps_detractor')}
FROM people p LEFT JOIN answers a ON a.contact_id = p.contact_id
WHERE college_track_status_c IN ('11A', '12A', '13A', '15A', '16A', '17A')
GROUP BY {_DIMS}""",
    "student_red": _VIEWS + f""",
there AS (
  SELECT DISTINCT s.student_c, {_DIMS}, COALESCE(college_track_status_c IN ('11A', '18a', '12A'), false) AS active
  FROM sessions s JOIN terms ON AT_Id = Academic_Semester_c
  WHERE Attendance_Numerator_c > 0 AND dosage_types_c NOT LIKE '%NSO%' AND Outcome_c <> 'Cancelled'
    AND AY_Name = 'AY 2020-21' AND grade_c <> '8th Grade'),
ready AS (
  SELECT t.Contact_Id AS who, t.most_recent_valid_cumulative_gpa >= 3.25 AND t.composite_readiness_most_recent_c = '1. Ready'
           AND t.college_track_status_c = '11A' AS good,
         {_SENIOR} AND {_OPT_IN} AS senior, t.grade_c = '11th Grade' AS eleventh
  FROM terms t WHERE t.current_as_c AND t.college_track_status_c IN ('11A', '12A', '13A', '15A', '16A', '17A'))
SELECT {_DIMS}, COUNT(*)::BIGINT AS retention_denom, COUNT(*) FILTER (WHERE active)::BIGINT AS retention_num,
  {_sum_if('who', 'good AND senior', 'red_gpa_3_25_test_ready')},
  {_sum_if('who', 'good AND eleventh', 'red_gpa_3_25__test_ready_eleventh')}
FROM there LEFT JOIN ready ON who = student_c GROUP BY {_DIMS}""",
}
