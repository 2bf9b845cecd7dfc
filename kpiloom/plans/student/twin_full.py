"""Every team table, the wide table and its roll-up on the commerce tables.

The views of ``twin``, widened to all columns and tables that the builders read
(applications and aspirations from orders; activities, case notes and tests from
order lines; surveys from events and customers), with missing sites, two sites
that financial planning leaves out, NULL flags and repeated rows.  ``SQL`` holds
the metrics' definitions over the same views for DuckDB.
"""

from __future__ import annotations

import dataclasses
import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kpiloom.operators.cohort import assemble, reconcile
from kpiloom.plans.student import teams, twin
from kpiloom.plans.student.dashboard import RATIOS
from kpiloom.plans.student.kpis import KPIS, PLACES, SITE_GRAIN
from kpiloom.plans.student.params import COHORT, COVI_RECORD_TYPE, DIMS, SUMMER_EXPERIENCE_RECORD_TYPE, StudentParams
from kpiloom.session import shared_dir
from kpiloom.sources.catalog import ParquetCatalog, dealt_by
from kpiloom.sources.published import Published


def _school(word: str) -> str:
    return f"concat('Predominantly {word}', chr(39), 's-degree granting')"


_PACE = "CASE {0} % 5 WHEN 0 THEN '6+ Years' WHEN 1 THEN 'Credit Data Missing' WHEN 2 THEN '4-Year' WHEN 3 THEN '5-Year' END"
_FIRST_SCHOOL = (f"CASE {{0}} % 4 WHEN 0 THEN {_school('associate')} WHEN 1 THEN 'Predominantly certificate-degree granting' "
                 "WHEN 2 THEN 'other' END")

CONTACT = {
    **twin.CONTACT,
    "Gender_c": "CASE WHEN c_acctbal >= 5000 THEN 'Male' WHEN c_acctbal >= 0 THEN 'Female' END",
    "site_short": "CASE n_nationkey WHEN 3 THEN 'Ward 8' WHEN 7 THEN 'Crenshaw' WHEN 24 THEN NULL ELSE n_name END",
    "site_c": "c_nationkey", "site_sort": "n_nationkey", "region_abrev": "r_name",
    "Contact_Record_Type_Name": "CASE c_custkey % 3 WHEN 0 THEN 'Student: High School' WHEN 1 THEN 'Student: Post-Secondary' END",
    "grade_c": "CASE c_custkey % 8 WHEN 0 THEN '9th Grade' WHEN 1 THEN '11th Grade' WHEN 2 THEN '12th Grade' WHEN 3 THEN '10th Grade' "
               "WHEN 4 THEN 'Year 3' WHEN 5 THEN 'Year 6' WHEN 6 THEN 'Year 1' END",
    "college_track_status_c": "CASE c_custkey % 9 WHEN 0 THEN '11A' WHEN 1 THEN '11A' WHEN 2 THEN '11A' WHEN 3 THEN '12A' WHEN 4 THEN '15A' "
                              "WHEN 5 THEN '15A' WHEN 6 THEN '17A' WHEN 7 THEN '18a' END",
    "indicator_years_since_hs_graduation_c": "CASE WHEN c_custkey % 23 = 0 THEN NULL ELSE c_custkey % 5 * 2 END",
    "indicator_completed_ct_hs_program_c": "CASE WHEN c_custkey % 11 = 0 THEN NULL ELSE c_custkey % 3 < 2 END",
    "contact_official_test_prep_withdrawal": "CASE WHEN c_custkey % 5 = 0 THEN 'withdrawn' END",
    "FA_Req_Expected_Financial_Contribution_c": "CASE WHEN c_custkey % 3 > 0 THEN c_acctbal END",
    "fa_req_efc_source_c": "CASE WHEN c_custkey % 10 < 6 THEN 'FAFSA4caster' WHEN c_custkey % 10 < 8 THEN 'EFC' END",
    "Credit_Accumulation_Pace_c": _PACE.format("c_custkey"),
    "credits_accumulated_most_recent_c": "CASE WHEN c_custkey % 17 = 0 THEN NULL ELSE CAST(c_custkey % 120 AS DOUBLE) + 40 END",
    "Current_Enrollment_Status_c": "CASE WHEN c_custkey % 4 < 3 THEN 'Full-time' ELSE 'Part-time' END",
    "Current_School_Type_c_degree": f"CASE WHEN c_custkey % 6 < 5 THEN {_school('bachelor')} END",
    "college_first_enrolled_school_type_c": _FIRST_SCHOOL.format("c_custkey"),
    "ps_internships_c": "CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE c_custkey % 3 END",
    "anticipated_date_of_graduation_ay_c": "CASE WHEN c_custkey % 2 = 0 THEN 'AY 2020-21' END",
    "academic_year_4_year_degree_earned_c": "CASE c_custkey % 13 WHEN 0 THEN 'AY 2020-21' WHEN 1 THEN 'AY 2019-20' END",
    "most_recent_valid_cumulative_gpa": "CASE WHEN c_custkey % 19 = 0 THEN NULL ELSE CAST(c_custkey % 41 AS DOUBLE) / 10 END",
    "summer_experiences_previous_summer_c": "CASE WHEN c_custkey % 6 = 0 THEN NULL ELSE c_custkey % 2 END",
    "Dream_Statement_filled_out_c": "CASE c_custkey % 3 WHEN 0 THEN true WHEN 1 THEN false END",
}
TERM = {
    **twin.TERM,
    "student_c": "o_custkey", "site_c": "site_c",
    "site_short": "CASE WHEN o_orderkey % 6 = 0 THEN 'NATION_2' ELSE site_short END",       # students at two sites
    "term_c": "CASE quarter(o_orderdate) WHEN 1 THEN 'Spring' WHEN 2 THEN 'Summer' WHEN 3 THEN 'Fall' ELSE 'Winter' END",
    "AT_Name": "concat('T', CAST(year(o_orderdate) * 10 + quarter(o_orderdate) AS VARCHAR(9)))",
    "GAS_Name": "CASE year(o_orderdate) * 10 + quarter(o_orderdate) WHEN 19971 THEN 'Spring 2019-20 (Semester)' "
                "WHEN 19972 THEN 'Summer 2019-20 (Semester)' ELSE 'other' END",
    "start_date_c": "CAST(date_trunc('quarter', o_orderdate) AS DATE)",
    "previous_as_c": "CASE WHEN o_orderkey % 19 = 0 THEN NULL ELSE year(o_orderdate) = 1999 END",
    "grade_c": "CASE o_orderpriority WHEN '1-URGENT' THEN '9th Grade' WHEN '2-HIGH' THEN '11th Grade' WHEN '3-MEDIUM' THEN '12th Grade' "
               "WHEN '4-NOT SPECIFIED' THEN (CASE WHEN o_orderkey % 2 = 0 THEN 'Year 1' ELSE 'Year 3' END) "
               "ELSE (CASE WHEN o_orderkey % 2 = 0 THEN '8th Grade' ELSE '10th Grade' END) END",
    "AT_Grade_c": "CASE o_orderpriority WHEN '4-NOT SPECIFIED' THEN 'Year 1' WHEN '5-LOW' THEN 'Year 2' END",
    "college_track_status_c": "CASE WHEN o_orderkey % 11 = 0 THEN NULL WHEN o_orderstatus = 'F' THEN '11A' WHEN o_orderstatus = 'P' THEN '15A' "
                              "WHEN o_orderkey % 3 = 0 THEN '18a' WHEN o_orderkey % 3 = 1 THEN '15A' ELSE '17A' END",
    "College_Track_Status_Name": "CASE o_orderstatus WHEN 'O' THEN 'Current CT HS Student' WHEN 'F' THEN 'CT Alumni' END",
    "student_audit_status_c": "CASE o_orderkey % 5 WHEN 0 THEN 'Current CT HS Student' WHEN 1 THEN 'Active: Post-Secondary' "
                              "WHEN 2 THEN 'Active: Post-Secondary' WHEN 3 THEN 'CT Alumni' END",
    "filing_status_c": "CASE o_orderkey % 4 WHEN 0 THEN 'FS_G' WHEN 1 THEN 'FS_R' END",
    "loans_c": "CASE o_orderkey % 3 WHEN 0 THEN 'LN_G' WHEN 1 THEN 'LN_Y' END",
    "Overall_Rubric_Color": "CASE WHEN o_orderkey % 5 < 2 THEN 'Green' WHEN o_orderkey % 5 = 2 THEN 'Red' END",
    "advising_rubric_career_readiness_v_2_c": "CASE WHEN o_orderkey % 7 < 4 THEN 'Green' END",
    "academic_networking_50_cred_c": "CASE WHEN o_orderkey % 2 = 0 THEN 'AN1_G' END",
    "academic_networking_over_50_credits_c": "CASE WHEN o_orderkey % 5 = 1 THEN 'AN2_G' END",
    "indicator_completed_ct_hs_program_c": "CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE o_custkey % 3 < 2 END",
    "AT_school_type": "CASE WHEN o_orderkey % 3 > 0 THEN '4-Year' ELSE '2-Year' END",
    "AT_Enrollment_Status_c": "CASE o_orderkey % 4 WHEN 0 THEN 'Full-time' WHEN 1 THEN 'Part-time' WHEN 2 THEN 'Approved Gap Year' END",
    "college_first_enrolled_school_type_c": _FIRST_SCHOOL.format("o_custkey"),
    "enrolled_in_any_college_c": "CASE WHEN o_orderkey % 8 = 0 THEN NULL ELSE o_orderkey % 8 < 6 END",
    "indicator_persisted_at_c": "CASE WHEN o_orderkey % 5 = 0 THEN 0 WHEN o_orderkey % 5 < 4 THEN 1 END",
    "e_fund_c": "CASE WHEN o_orderkey % 3 = 0 THEN 'EF_G' END",
    "attended_workshops_c": "CAST(o_orderkey % 10 AS DOUBLE)",
    "enrolled_sessions_c": "CASE WHEN o_orderkey % 3 = 0 THEN CAST(0 AS DOUBLE) ELSE CAST(9 AS DOUBLE) END",
    "credit_accumulation_pace_c": _PACE.format("o_custkey"),
    "current_enrollment_status_c": "CASE WHEN o_orderkey % 2 = 0 THEN 'Full-time' ELSE 'Part-time' END",
    "co_vitality_scorecard_color_c": "CASE o_orderkey % 4 WHEN 0 THEN 'Blue' WHEN 1 THEN 'Red' WHEN 2 THEN 'Green' END",
}
SESSION = {
    **twin.SESSION,
    "department_c": "CASE WHEN l_linenumber % 4 = 0 THEN 'Student Life' WHEN l_linenumber % 4 = 1 THEN 'College Completion' "
                    "WHEN l_returnflag = 'R' THEN 'Academic Affairs' WHEN l_returnflag = 'A' THEN 'Wellness' END",
    "Cancelled_c": "CASE WHEN l_linenumber = 7 OR l_suppkey % 11 = 0 THEN true WHEN l_suppkey % 11 = 1 THEN NULL ELSE false END",
    "workshop_display_name_c": "CASE l_linenumber WHEN 1 THEN 'Senior Seminar' WHEN 5 THEN 'My Junior Advisory 2' WHEN 4 THEN 'Yoga' END",
}
_BAND = twin._AGREE
ANSWER = {
    **twin.ANSWER,
    teams.HOBBY_Q: _BAND.format("signup", 40, 25),
    "did_you_engage_with_wellness_services_at_your_site": "CASE event_type WHEN 'view' THEN 'No' WHEN 'error' THEN NULL ELSE 'Yes' END",
    teams.WELLNESS_QS[0]: "CASE WHEN value >= 60 THEN 'Totalmente de acuerdo' WHEN value >= 50 THEN 'De acuerdo' END",
    teams.WELLNESS_QS[1]: _BAND.format("click", 90, 70), teams.WELLNESS_QS[2]: _BAND.format("purchase", 95, 80),
}
APPLICATION = {
    "student_c": "o_custkey",
    "FA_Req_FAFSA_c": "CASE WHEN o_orderkey % 3 < 2 THEN 'Submitted' END",
    "verification_status_c": "CASE o_orderkey % 4 WHEN 0 THEN 'Submitted' WHEN 1 THEN 'Not Applicable' WHEN 2 THEN 'Pending' END",
    "admission_status_c": "CASE o_orderkey % 7 WHEN 0 THEN 'Accepted' WHEN 1 THEN 'Accepted' WHEN 2 THEN 'Accepted and Enrolled' "
                          "WHEN 3 THEN 'Accepted and Deferred' WHEN 4 THEN 'Wait-listed' WHEN 5 THEN 'Denied' END",
    "College_Fit_Type_Applied_c": "CASE o_orderkey % 11 WHEN 0 THEN 'Best Fit' WHEN 1 THEN 'Best Fit' WHEN 2 THEN 'Good Fit' "
                                  "WHEN 3 THEN 'Local Affordable' WHEN 4 THEN 'Situational' WHEN 5 THEN 'Reach' END",
    "fit_type_enrolled_c": "CASE o_orderkey % 13 WHEN 0 THEN 'Best Fit' WHEN 1 THEN 'Best Fit' WHEN 2 THEN 'Good Fit' "
                           "WHEN 3 THEN 'Local Affordable' WHEN 4 THEN 'Situational' END",
}
ASPIRATION = {"id": "CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE o_orderkey END", "student_c": "o_custkey",
              "fit_type_current_c": "CASE o_orderkey % 4 WHEN 0 THEN 'Best Fit' WHEN 1 THEN 'Good Fit' WHEN 2 THEN 'Reach' END"}
ACCOUNT = {"Id": "n_nationkey", "College_Track_High_School_Capacity_v_2_c": "CASE WHEN n_nationkey % 6 > 0 THEN n_nationkey * 10 + 100 END"}
ACTIVITY = {
    "semester_c": "l_orderkey",
    "record_type_id": f"CASE WHEN l_linenumber % 3 > 0 THEN '{SUMMER_EXPERIENCE_RECORD_TYPE}' ELSE 'other' END",
    "experience_meaningful_c": "CASE WHEN l_linenumber = 5 THEN NULL ELSE l_linenumber % 4 > 0 END",
    "status_c": "CASE WHEN l_returnflag = 'R' THEN 'Pending' ELSE 'Approved' END",
    "competitive_c": "CASE WHEN l_quantity < 10 THEN NULL ELSE l_quantity > 25 END",
    "type_c": "CASE WHEN l_linestatus = 'F' THEN 'Internship' ELSE 'Camp' END",
}
NOTE = {"id": "l_partkey", "Academic_Semester_c": "l_orderkey",
        "Type_Counseling_c": "CASE WHEN l_linenumber = 3 THEN NULL ELSE l_returnflag = 'A' END"}
TEST = {
    "id": "CASE WHEN l_linenumber = 6 THEN NULL ELSE l_orderkey * 10 + l_linenumber END", "contact_name_c": "o_custkey",
    "academic_semester_c": "l_orderkey", "record_type_id": f"CASE WHEN l_linenumber <> 4 THEN '{COVI_RECORD_TYPE}' END",
    "status_c": "CASE WHEN l_linestatus = 'O' THEN 'Completed' ELSE 'In Progress' END",
    "belief_in_self_raw_score_c": "CASE WHEN l_quantity < 4 THEN NULL ELSE CAST(l_quantity AS DOUBLE) END",
    "engaged_living_raw_score_c": "CAST(l_linenumber AS DOUBLE)", "belief_in_others_raw_score_c": "CAST(l_suppkey % 7 AS DOUBLE)",
    "emotional_competence_raw_score_c": "CASE WHEN l_linenumber = 5 THEN NULL ELSE CAST(l_partkey % 5 AS DOUBLE) END",
}
COMPLETION = {**{d: d for d in DIMS}, "student_count": "1 + contact_id % 3", "completed_survey_count": "contact_id % 2"}
SCHOLARSHIP_Q = "i_am_able_to_receive_my_scholarship_funds_from_college_track"
PS_ANSWER = {
    "contact_id": "CASE WHEN event_type = 'click' THEN NULL ELSE contact_id END", **{d: d for d in DIMS},
    SCHOLARSHIP_Q: "CASE event_type WHEN 'view' THEN 'StronglyAgree' WHEN 'signup' THEN 'Agree' WHEN 'error' THEN NULL ELSE 'Disagree' END",
}
ALUMNUS = {
    "Contact_Id": "contact_id", "gender": "Gender_c", "ethnicity": "Ethnic_background_c",
    "ct_site": "CASE WHEN contact_id % 5 = 0 THEN 'College Track Boyle Heights' WHEN contact_id % 17 = 1 THEN NULL ELSE site_short END",
    "survey_year": "CASE WHEN contact_id % 2 = 0 THEN 'FD20' ELSE 'FY20' END",
    "i_feel_my_current_job_is_meaningful": "CASE contact_id % 4 WHEN 0 THEN 'Strongly Agree' WHEN 1 THEN 'Agree' WHEN 2 THEN 'Disagree' END",
    "indicator_annual_loan_repayment_amount_current_loan_debt_125": "CAST(contact_id % 10 AS DOUBLE)",
    "indicator_income_proxy": "CAST(contact_id % 9 * 25 AS DOUBLE)",
    "indicator_ft_job_or_grad_school_within_6_months": "CASE WHEN contact_id % 7 = 0 THEN NULL ELSE contact_id % 2 + contact_id % 3 END",
}
_IN_SURVEY = "contact_id % 4 < 3"       # alumni who answered


def source(spark: SparkSession, root: str) -> Callable[[str], DataFrame]:
    """All views by the names that the team builders read."""
    cat, view = ParquetCatalog(spark, root), twin._view
    nation = cat("nation").select("n_nationkey", "n_name", "n_regionkey")
    region = cat("region").select("r_regionkey", "r_name")
    orders, lines = cat("orders"), dealt_by(cat("lineitem"), "l_orderkey")
    contacts = view(cat("customer").join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
                    .join(region, F.col("n_regionkey") == F.col("r_regionkey"), "left"), CONTACT)
    dims = contacts.select(F.col("contact_id").alias("who"), *DIMS, "site_c")
    dealt = lines.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
    answered = cat("events").join(contacts.select("contact_id", *DIMS), F.col("contact_id") == F.col("user_id"))
    tables = {
        "contact_template": contacts,
        "contact_at_template": view(orders.join(dims, orders["o_custkey"] == dims["who"], "left"), TERM),
        "class_template": view(dealt, SESSION),
        "fy21_hs_survey": view(cat("events"), ANSWER),
        "college_application_clean": view(orders, APPLICATION),
        "college_aspiration_c": view(orders, ASPIRATION),
        "account": view(cat("nation").where("n_nationkey % 7 <> 1"), ACCOUNT),
        "student_life_activity_c": view(cat("lineitem"), ACTIVITY),
        "progress_note_c": view(cat("lineitem"), NOTE),
        "test_clean": view(dealt, TEST),
        "fy21_hs_survey_completion": view(contacts, COMPLETION),
        "fy21_ps_survey_wide_prepped": view(answered, PS_ANSWER),
        "fy20_alumni_survey": view(contacts.where(_IN_SURVEY), ALUMNUS),
    }
    return tables.__getitem__


# ------------------------------------------------------------------ DuckDB SQL
_S = twin._select
VIEWS = f"""WITH people AS (SELECT {_S(CONTACT)} FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey),
dims AS (SELECT contact_id, {', '.join(DIMS)}, site_c FROM people),
terms AS (SELECT {_S(TERM)} FROM orders LEFT JOIN dims ON contact_id = o_custkey),
dealt AS (SELECT * FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
sessions AS (SELECT {_S(SESSION)} FROM dealt),
answers AS (SELECT {_S(ANSWER)} FROM events),
applications AS (SELECT {_S(APPLICATION)} FROM orders),
aspirations AS (SELECT {_S(ASPIRATION)} FROM orders),
accounts AS (SELECT {_S(ACCOUNT)} FROM nation WHERE n_nationkey % 7 <> 1),
activities AS (SELECT {_S(ACTIVITY)} FROM lineitem),
notes AS (SELECT {_S(NOTE)} FROM lineitem),
tests AS (SELECT {_S(TEST)} FROM dealt),
completion AS (SELECT {_S(COMPLETION)} FROM people),
ps_answers AS (SELECT {_S(PS_ANSWER)} FROM events JOIN people ON contact_id = user_id),
alumni AS (SELECT {_S(ALUMNUS)} FROM people WHERE {_IN_SURVEY})"""
_D = ", ".join(DIMS)
_AY, _PREV = "'AY 2020-21'", "'AY 2019-20'"
_SENIOR = "(grade_c = '12th Grade' OR grade_c = 'Year 1' AND indicator_years_since_hs_graduation_c = 0)"
_OPT_IN = "contact_official_test_prep_withdrawal IS NULL"
_HS = "college_track_status_c = '11A'"
_YES = "IN ('Strongly Agree', 'Agree')"
_FITS = "('Best Fit', 'Good Fit', 'Local Affordable')"
_GONE_ON = "('Accepted and Enrolled', 'Accepted and Deferred')"
_TWO_YEAR = f"IN ({_school('associate')}, 'Predominantly certificate-degree granting')"
_BACHELOR = _school("bachelor")


def _n(condition: str, name: str) -> str:
    return f"COUNT(*) FILTER (WHERE {condition})::BIGINT AS {name}"


def _some(condition: str, name: str) -> str:
    """A count that is NULL where nothing qualifies."""
    return f"NULLIF(COUNT(*) FILTER (WHERE {condition}), 0)::BIGINT AS {name}"


def _of(there: str, condition: str, name: str) -> str:
    """A count among rows that have a match; NULL where none has."""
    return f"CASE WHEN COUNT({there}) > 0 THEN COUNT(*) FILTER (WHERE {condition}) END::BIGINT AS {name}"


def _joined(first: str, *others: str) -> str:
    """Tables left-joined on the cell by plain equality."""
    return f"SELECT * FROM ({first}) " + " ".join(f"LEFT JOIN ({o}) USING ({_D})" for o in others)


def _rates(sessions: str, terms: str) -> str:
    """Attendance per student; a session counts once a matching contact term."""
    return f"""(SELECT student_c AS who, SUM(Attendance_Numerator_c * n) / NULLIF(SUM(Attendance_Denominator_c * n), 0) AS rate
  FROM sessions JOIN (SELECT global_academic_semester_c AS g, COUNT(*) AS n FROM terms WHERE {terms} GROUP BY g)
    ON g = global_academic_semester_c WHERE {sessions} GROUP BY student_c)"""


def _growth(score: str, period: str, grew: str, pairs: str) -> str:
    """Least score a period, against that of the period before."""
    return f"""SELECT {_D}, COUNT(*) FILTER (WHERE now > before)::BIGINT AS {grew}, COUNT(*)::BIGINT AS {pairs}
FROM (SELECT {_D}, now, LAG(now) OVER (PARTITION BY contact_name_c ORDER BY period, {', '.join(d + ' NULLS FIRST' for d in DIMS)}) AS before
      FROM (SELECT contact_name_c, {_D}, {period} AS period, MIN({score}) AS now FROM tests JOIN terms ON AT_Id = academic_semester_c
            WHERE record_type_id = '{COVI_RECORD_TYPE}' AND AY_Name IN ({_AY}, {_PREV}) AND {_HS} GROUP BY ALL))
WHERE now IS NOT NULL AND before IS NOT NULL GROUP BY {_D}"""


def _has(what: str) -> str:
    return f"contact_id IN (SELECT student_c FROM applications WHERE {what})"


_BODIES: dict[str, str] = {}

_BODIES["join_prep"] = "\n" + _joined(f"""SELECT 'National' AS national, site_sort, region_abrev, {_D},
  {_some("Contact_Record_Type_Name = 'Student: Post-Secondary' AND college_track_status_c = '15A'", 'active_ps_student_count')},
  {_some("Contact_Record_Type_Name = 'Student: High School'", 'hs_student_count')},
  {_some(_SENIOR, 'hs_senior_student_count')}, {_some(f'{_SENIOR} AND {_OPT_IN}', 'hs_senior_student_count_test_opt_in')},
  {_some("grade_c = '9th Grade'", 'hs_ninth_grade_student_count')}, {_some("grade_c = '11th Grade'", 'hs_eleventh_student_count')},
  {_some(f"grade_c = '11th Grade' AND {_OPT_IN}", 'hs_eleventh_student_count_test_opt_in')},
  {_some('indicator_completed_ct_hs_program_c', 'completed_hs_program_count')}
FROM people WHERE college_track_status_c IN ('11A', '15A', '16A', '17A') AND indicator_years_since_hs_graduation_c <= 6
GROUP BY site_sort, region_abrev, {_D}""", f"""SELECT {_D}, SUM(student_count)::BIGINT AS hs_survey_completion_denominator,
  SUM(completed_survey_count)::BIGINT AS hs_survey_completion_count FROM completion GROUP BY {_D}""")

_BODIES["cc_hs"] = "\n" + _joined(
    f"SELECT DISTINCT {_D} FROM people",
    f"""SELECT {_D}, {_n("FA_Req_Expected_Financial_Contribution_c IS NOT NULL AND fa_req_efc_source_c = 'FAFSA4caster'", 'cc_hs_EFC_10th_num')},
  COUNT(*)::BIGINT AS cc_hs_EFC_10th_denom FROM people WHERE {_HS} AND grade_c = '10th Grade' GROUP BY {_D}""",
    f"""SELECT {_D}, {_n(f'''(SELECT COUNT(id) FROM aspirations WHERE student_c = contact_id) >= 6
    AND (SELECT COUNT(*) FROM aspirations WHERE student_c = contact_id AND fit_type_current_c IN {_FITS}) >= 3''', 'cc_hs_aspirations_num')},
  COUNT(*)::BIGINT AS cc_hs_aspirations_denom FROM people WHERE {_HS} AND grade_c = '11th Grade' GROUP BY {_D}""",
    f"""SELECT {_D}, {_n('rate >= 0.8', 'cc_hs_above_80_cc_attendance')},
  {_n(_has(f"admission_status_c = 'Accepted' AND College_Fit_Type_Applied_c IN {_FITS}") + " OR " + _has(
      f"admission_status_c IN {_GONE_ON} AND fit_type_enrolled_c IN ('Best Fit', 'Good Fit', 'Local Affordable', 'Situational')"), 'cc_hs_accepted_affordable')},
  {_n(_has("College_Fit_Type_Applied_c IN ('Best Fit', 'Good Fit')"), 'cc_hs_applied_best_good')},
  {_n(_has("admission_status_c = 'Accepted' AND College_Fit_Type_Applied_c IN ('Best Fit', 'Good Fit')") + " OR " + _has(
      f"admission_status_c IN {_GONE_ON} AND fit_type_enrolled_c IN ('Best Fit', 'Good Fit', 'Situational')"), 'cc_hs_accepted_best_good_situational')},
  {_n(_has("admission_status_c IN ('Accepted and Enrolled', 'Accepted and Deferred', 'Wait-listed')"), 'cc_hs_strong_college_situations')},
  {_n(_has("FA_Req_FAFSA_c = 'Submitted' AND verification_status_c IN ('Submitted', 'Not Applicable')"), 'cc_hs_financial_aid_submission_verification')},
  {_n(_has(f"admission_status_c IN {_GONE_ON} AND fit_type_enrolled_c IN ('Best Fit', 'Good Fit', 'Situational')"), 'cc_hs_enrolled_best_good_situational')},
  {_n(_has(f"admission_status_c IN {_GONE_ON} AND fit_type_enrolled_c IN ('Best Fit', 'Good Fit', 'Local Affordable', 'Situational')"), 'cc_hs_enrolled_affordable')}
FROM people LEFT JOIN {_rates('''department_c = 'College Completion' AND NOT Cancelled_c AND (workshop_display_name_c LIKE '%Junior Advisory%'
    OR workshop_display_name_c LIKE '%Senior Advisory%' OR workshop_display_name_c LIKE '%Senior Seminar%'
    OR workshop_display_name_c LIKE '%College Exposure%')''', f"AY_Name = {_AY} AND {_HS} AND {_SENIOR}")} ON who = contact_id
WHERE {_HS} AND {_SENIOR} GROUP BY {_D}""")


def _cc_ps(term: str) -> str:
    """``term``: which terms count on the day (current, previous, none)."""
    pace = f"""(college_track_status_c = '15A' AND Credit_Accumulation_Pace_c NOT IN ('6+ Years', 'Credit Data Missing')
    AND credits_accumulated_most_recent_c >= 80 AND Current_Enrollment_Status_c = 'Full-time' AND Current_School_Type_c_degree = {_BACHELOR})"""
    leaving = f"(anticipated_date_of_graduation_ay_c = {_AY} AND {pace} OR academic_year_4_year_degree_earned_c = {_AY})"
    later = f"(AY_Name = {_PREV} AND term_c IN ('Winter', 'Spring') OR AY_Name = {_AY} AND term_c = 'Fall')"
    key = "contact_id, Gender_c, Ethnic_background_c"
    return f""",
rubric AS (SELECT Contact_Id AS contact_id, Gender_c, Ethnic_background_c, filing_status_c = 'FS_G' AS fafsa, loans_c IN ('LN_G', 'LN_Y') AS loans,
    Overall_Rubric_Color = 'Green' AS balanced, true AS rated,
    advising_rubric_career_readiness_v_2_c = 'Green' AND (academic_networking_50_cred_c = 'AN1_G' OR academic_networking_over_50_credits_c = 'AN2_G') AS skills,
    indicator_completed_ct_hs_program_c AND grade_c = 'Year 3' AND AT_school_type = '4-Year' AND AT_Enrollment_Status_c IN ('Full-time', 'Part-time')
      AND college_first_enrolled_school_type_c {_TWO_YEAR} AS moved
  FROM terms WHERE college_track_status_c = '15A' AND {term}),
stayed AS (SELECT {key}, bool_or(every_term) AS persisted, true AS reported
  FROM (SELECT Contact_Id AS contact_id, Gender_c, Ethnic_background_c, site_short,
          bool_and(COALESCE(student_audit_status_c = 'CT Alumni', false) OR COALESCE(indicator_persisted_at_c = 1, false)) AS every_term
        FROM terms WHERE {later} GROUP BY ALL)
  WHERE contact_id IN (SELECT Contact_Id FROM terms WHERE AY_Name = {_PREV} AND term_c = 'Fall' AND enrolled_in_any_college_c
                       AND student_audit_status_c = 'Active: Post-Secondary') GROUP BY {key}),
replies AS (SELECT Contact_Id AS contact_id, gender AS Gender_c, ethnicity AS Ethnic_background_c, true AS replied,
    i_feel_my_current_job_is_meaningful {_YES} AS meaningful, survey_year = 'FD20' AS recent,
    indicator_annual_loan_repayment_amount_current_loan_debt_125 / NULLIF(indicator_income_proxy, 0) <= 0.08 AS gainful,
    survey_year = 'FD20' AND indicator_ft_job_or_grad_school_within_6_months = 1 AS employed
  FROM alumni WHERE ct_site <> 'College Track Boyle Heights')
SELECT site_short, Ethnic_background_c, Gender_c,
  {_n(f"grade_c = 'Year 6' AND ({pace} OR college_track_status_c = '17A')", 'cc_ps_projected_grad_num')}, {_n("grade_c = 'Year 6'", 'cc_ps_projected_grad_denom')},
  {_of('rated', 'moved', 'cc_ps_2_yr_transfer_num')},
  {_n(f"grade_c = 'Year 3' AND college_first_enrolled_school_type_c {_TWO_YEAR}", 'cc_ps_2_yr_transfer_denom')},
  {_n(f'ps_internships_c > 0 AND {leaving}', 'cc_ps_grad_internship_num')}, {_n(leaving, 'cc_ps_grad_internship_denom')},
  {_n("college_track_status_c = '15A' AND most_recent_valid_cumulative_gpa >= 2.5", 'cc_ps_gpa_2_5_num')},
  {_of('rated', 'loans', 'cc_ps_loans_30k')}, {_of('rated', 'fafsa', 'cc_ps_fasfa_complete')},
  {_of('rated', 'balanced', 'cc_ps_well_balanced_lifestyle')}, {_of('rated', 'skills', 'cc_ps_tech_interpersonal_skills')},
  {_of('reported', 'persisted', 'cc_ps_persist_num')}, {_of('reported', 'reported', 'cc_persist_denom')},
  {_of('replied', 'meaningful', 'cc_ps_meaningful_num')}, {_of('replied', 'gainful', 'cc_ps_gainful_num')},
  {_of('replied', 'replied', 'cc_ps_meaningful_gainful_denom')}, {_of('replied', 'employed', 'cc_ps_employed_grad_6_months_num')},
  {_of('replied', 'recent', 'cc_ps_employed_grad_6_months_denom')}
FROM people LEFT JOIN rubric USING ({key}) LEFT JOIN stayed USING ({key}) LEFT JOIN replies USING ({key})
WHERE indicator_completed_ct_hs_program_c GROUP BY {_D}"""


_BODIES["cc_ps"] = _cc_ps("current_as_c")
_BODIES["fp"] = f"\nSELECT * FROM (" + _joined(
    f"""SELECT {_D}, {_n(f"{_HS} AND {_SENIOR} AND FA_Req_Expected_Financial_Contribution_c IS NOT NULL", 'fp_12_efc_num')}
FROM people WHERE college_track_status_c IN ('11A', '12A', '15A') GROUP BY {_D}""",
    f"""SELECT {_D}, COUNT(contact_id)::BIGINT AS ps_survey_scholarship_denom, {_n(f"{SCHOLARSHIP_Q} IN ('StronglyAgree', 'Strongly Agree', 'Agree')", 'ps_survey_scholarship_num')}
FROM ps_answers WHERE {SCHOLARSHIP_Q} IS NOT NULL GROUP BY {_D}""",
    f"SELECT {_D}, {_n("e_fund_c = 'EF_G'", 'fp_efund_num')} FROM terms WHERE college_track_status_c = '15A' AND current_as_c GROUP BY {_D}",
    f"""SELECT {_D}, {_n(_has("admission_status_c = 'Accepted' AND College_Fit_Type_Applied_c = 'Best Fit'"), 'fp_accepted_best_fit_denom')},
  {_n(_has(f"admission_status_c IN {_GONE_ON} AND fit_type_enrolled_c = 'Best Fit'"), 'fp_enrolled_best_fit_numerator')}
FROM people WHERE {_HS} AND {_SENIOR} GROUP BY {_D}""") + ") WHERE site_short NOT IN ('The Durant Center', 'Ward 8', 'Crenshaw')"

_BODIES["site_directors"] = f""",
attended AS (SELECT Contact_Id AS who, SUM(attended_workshops_c) AS went, SUM(enrolled_sessions_c) AS due
             FROM terms WHERE AY_Name = {_AY} AND term_c <> 'Summer' AND {_HS} GROUP BY Contact_Id)
""" + _joined(f"""SELECT {_D}, COUNT(contact_id)::BIGINT AS SD_hs_capacity_numerator,
  {_n(f"{_SENIOR} AND most_recent_valid_cumulative_gpa >= 3.25 AND {_HS}", 'SD_senior_above_325')},
  {_n(f"grade_c = '11th Grade' AND most_recent_valid_cumulative_gpa >= 3.25 AND {_HS}", 'SD_above_325_gpa_eleventh_grade')},
  {_n(f"grade_c = '9th Grade' AND Gender_c = 'Male' AND {_HS}", 'SD_ninth_grade_male')},
  {_n(f"grade_c = '9th Grade' AND indicator_low_income_c = 'Yes' AND indicator_first_generation_c AND {_HS}", 'SD_ninth_grade_first_gen_low_income')},
  SUM(CASE WHEN due = 0 THEN NULL WHEN went / due >= 0.8 THEN 1 ELSE 0 END)::BIGINT AS SD_above_80_attendance,
  {_n(f'summer_experiences_previous_summer_c > 0 AND {_HS}', 'SD_summer_experience')},
  MAX(College_Track_High_School_Capacity_v_2_c) AS hs_cohort_capacity
FROM people LEFT JOIN attended ON who = contact_id LEFT JOIN accounts ON Id = site_c
WHERE college_track_status_c IN ('11A', '18a', '12A') GROUP BY {_D}""", f"""SELECT {_D}, COUNT(Contact_Id)::BIGINT AS SD_on_track_student_count,
  {_n("college_track_status_c = '15A' AND credit_accumulation_pace_c NOT IN ('6+ Years', 'Credit Data Missing') OR college_track_status_c = '17A'", 'SD_on_track')}
FROM (SELECT DISTINCT Contact_Id, {_D}, site_c, credit_accumulation_pace_c, current_enrollment_status_c, college_track_status_c FROM terms
      WHERE AT_Grade_c = 'Year 1' AND AT_Enrollment_Status_c <> 'Approved Gap Year' AND indicator_years_since_hs_graduation_c <= 6
        AND indicator_completed_ct_hs_program_c) GROUP BY {_D}""", _growth(
    "belief_in_self_raw_score_c + engaged_living_raw_score_c + belief_in_others_raw_score_c + emotional_competence_raw_score_c",
    "AY_Name", "SD_covi_student_grew", "SD_covi_denominator"))

_BODIES["student_life"] = "\n" + _joined(
    f"SELECT DISTINCT {_D} FROM people",
    f"SELECT {_D}, {_n(f'Dream_Statement_filled_out_c AND {_HS}', 'sl_dreams_declared')} FROM people GROUP BY {_D}",
    f"""SELECT {_D}, {_n('rate >= 0.8', 'sl_above_80_attendance')} FROM people
LEFT JOIN {_rates("department_c = 'Student Life' AND NOT Cancelled_c", f"AY_Name = {_AY}")} ON who = contact_id GROUP BY {_D}""",
    f"""SELECT {_D}, {_n('completed', 'sl_mse_completed_prev_AY')}, {_n('competitive', 'sl_mse_competitive_prev_AY')}, {_n('intern', 'sl_mse_internship_prev_AY')}
FROM (SELECT Contact_Id, {_D}, bool_or(AY_Name = {_PREV}) AS completed, bool_or(AY_Name = {_PREV} AND competitive_c) AS competitive,
        bool_or(AY_Name = {_PREV} AND type_c = 'Internship') AS intern
      FROM activities JOIN terms ON AT_Id = semester_c
      WHERE record_type_id = '{SUMMER_EXPERIENCE_RECORD_TYPE}' AND experience_meaningful_c AND status_c = 'Approved'
        AND AY_Name IN ({_AY}, {_PREV}) AND term_c = 'Summer' GROUP BY ALL) GROUP BY {_D}""",
    f"""SELECT {_D}, COUNT(student_c)::BIGINT AS sl_mse_reporting_group_prev_AY
FROM (SELECT student_c, {_D} FROM terms WHERE grade_c <> '8th Grade' AND student_audit_status_c = 'Current CT HS Student'
        AND GAS_Name IN ('Spring 2019-20 (Semester)', 'Summer 2019-20 (Semester)') GROUP BY ALL HAVING COUNT(*) = 2) GROUP BY {_D}""",
    f"""SELECT {_D}, {_n(f'{teams.HOBBY_Q} {_YES}', 'sl_agree_they_have_hobby')}
FROM answers a LEFT JOIN dims d ON d.contact_id = a.contact_id GROUP BY {_D}""",
    _growth("belief_in_self_raw_score_c", "start_date_c", "SL_covi_belief_student_grew", "SL_covi_belief_denominator"))

_NEEDY = "co_vitality_scorecard_color_c IN ('Blue', 'Red')"
_FALL = f"AY_Name = {_AY} AND term_c = 'Fall'"
_HELPED = " OR ".join(f"{q} IN ('Agree', 'Strongly Agree', 'Totalmente de acuerdo')" for q in teams.WELLNESS_QS)
_BODIES["wellness"] = f""",
needy AS (SELECT DISTINCT Contact_Id AS who FROM terms WHERE {_NEEDY} AND {_FALL}),
theirs AS (SELECT * FROM terms WHERE AY_Name = {_AY} AND {_HS} AND Contact_Id IN (SELECT who FROM needy)),
needs AS (SELECT {_D}, NULLIF(COUNT(DISTINCT (Contact_Id, co_vitality_scorecard_color_c)) FILTER (WHERE {_NEEDY}), 0)::BIGINT AS sum_of_blue_red_covi_for_avg
          FROM terms WHERE grade_c <> '8th Grade' AND {_HS} AND {_FALL} GROUP BY {_D}),
met AS (SELECT {_D.replace('site_short', 't.site_short')}, SUM(Attendance_Numerator_c) AS sum_attended_wellness_sessions
        FROM sessions s JOIN theirs t ON t.AT_Id = s.Academic_Semester_c
        WHERE Attendance_Numerator_c > 0 AND department_c = 'Wellness' AND dosage_types_c NOT LIKE '%NSO%' AND Outcome_c <> 'Cancelled'
          AND grade_c <> '8th Grade' GROUP BY {_D}),
noted AS (SELECT {_D}, COUNT(DISTINCT id)::BIGINT AS case_note_count FROM notes n JOIN theirs t ON t.AT_Id = n.Academic_Semester_c
          WHERE Type_Counseling_c GROUP BY {_D}),
average AS (SELECT m.site_short, m.Ethnic_background_c, m.Gender_c,
              (SELECT COUNT(*) * m.sum_attended_wellness_sessions + SUM(case_note_count) FROM noted c WHERE c.site_short = m.site_short)::DOUBLE
                / x.sum_of_blue_red_covi_for_avg AS wellness_avg_support
            FROM met m JOIN needs x ON x.site_short = m.site_short AND x.Ethnic_background_c = m.Ethnic_background_c AND x.Gender_c = m.Gender_c
            WHERE x.sum_of_blue_red_covi_for_avg IS NOT NULL)
""" + _joined(f"""SELECT {_D}, COUNT(DISTINCT Contact_Id)::BIGINT AS wellness_covi_assessment_completed_ay
FROM tests JOIN terms ON AT_Id = academic_semester_c
WHERE id IS NOT NULL AND record_type_id = '{COVI_RECORD_TYPE}' AND status_c = 'Completed' AND College_Track_Status_Name = 'Current CT HS Student'
  AND AY_Name = {_AY} AND (grade_c IN ('9th Grade', '10th Grade', '11th Grade') OR {_SENIOR}) GROUP BY {_D}""",
    f"""SELECT {_D}, COUNT(DISTINCT a.contact_id)::BIGINT AS wellness_survey_wellness_services_assisted_denom,
  {_n(_HELPED, 'wellness_survey_wellness_services_assisted_num')}
FROM answers a LEFT JOIN dims d ON d.contact_id = a.contact_id
WHERE did_you_engage_with_wellness_services_at_your_site = 'Yes' GROUP BY {_D}""",
    "SELECT * FROM average", "SELECT * FROM met", "SELECT * FROM noted", "SELECT * FROM needs")

# the tables that ``twin`` defines, over the wider views
for _name, _key in (("academic_affairs", "student_academic_affairs"), ("om", "student_om"), ("red", "student_red"),
                    ("program_ops", "student_program_ops"), ("om_incomplete_attendance", "student_om_incomplete_attendance")):
    _BODIES[_name] = twin.SQL[_key].removeprefix(twin._VIEWS)

_TABLES = {name: VIEWS + body for name, body in _BODIES.items()}
_WIDE = _joined(_TABLES["join_prep"], *[_TABLES[n] for n in teams.TEAMS])


def _plain(names) -> str:
    return " AND ".join(f"{n} IS NOT NULL" for n in names)


SQL: dict[str, str] = {f"student_{n}": _TABLES[n] for n in ("join_prep", "cc_hs", "cc_ps", "fp", "site_directors", "student_life", "wellness")}
SQL["student_cc_ps_after"] = VIEWS + _cc_ps("previous_as_c")
SQL["student_cc_ps_cutoff"] = VIEWS + _cc_ps("false")
SQL["student_team_kpi_table"] = _WIDE
SQL["student_wide_reconciliation"] = "\nUNION ALL ".join(f"""
SELECT '{n}' AS table_name, COUNT(*)::BIGINT AS cells, COUNT(*) FILTER (WHERE NOT ({_plain(DIMS)}))::BIGINT AS null_key_cells,
  COUNT(*) FILTER (WHERE there)::BIGINT AS matched_cells, COUNT(*) FILTER (WHERE {_plain(DIMS)} AND there IS NULL)::BIGINT AS absent_cells
FROM ({_TABLES[n]}) LEFT JOIN (SELECT DISTINCT {_D}, true AS there FROM ({_TABLES['join_prep']})) USING ({_D})""" for n in teams.TEAMS)
SQL["student_kpi_percents"] = f"""SELECT *, {', '.join(
    f"ROUND({s.numerator}::DOUBLE / NULLIF({s.denominator}, 0), 6) AS {s.percent}" for s in KPIS.specs if s.denominator)} FROM ({_WIDE})"""
_CELL = sorted({c for pair in RATIOS.values() for c in pair} - SITE_GRAIN)
_PARTS = ", ".join(f"SUM({n})::{t} AS {k}_num, SUM({d})::{t} AS {k}_den, ROUND(SUM({n})::DOUBLE / NULLIF(SUM({d}), 0), 6) AS {k}_ratio"
                   for k, (n, d) in RATIOS.items() for t in ["BIGINT"])
# a site's capacity stands in each of its cells and counts once
SQL["student_dashboard"] = f"""
WITH sites AS (SELECT region_abrev, site_short, site_sort, {', '.join(f'SUM({c}) AS {c}' for c in _CELL)},
                 {', '.join(f'MAX({c}) AS {c}' for c in sorted(SITE_GRAIN))} FROM ({_WIDE}) GROUP BY region_abrev, site_short, site_sort)
SELECT CASE GROUPING(region_abrev, site_short) WHEN 3 THEN 'National' WHEN 1 THEN 'region' ELSE 'site' END AS level,
  region_abrev, site_short, CASE WHEN GROUPING(site_short) = 0 THEN MAX(site_sort) END AS site_sort, {_PARTS}
FROM sites GROUP BY GROUPING SETS ((), (region_abrev), (region_abrev, site_short))"""


# --------------------------------------------------------------------- queries
def _team(build, **params):
    return lambda spark, root: build(source(spark, root), dataclasses.replace(StudentParams(), **params))


def published(spark: SparkSession, root: str) -> Published:
    """A night's tables, published in the session's shared folder."""
    sink = shared_dir(spark, f"student-{uuid.uuid4().hex}")
    teams.student_nightly_job(source(spark, root), StudentParams(), sink, spark)
    return Published(spark, sink)


def _from_published(spark: SparkSession, root: str) -> DataFrame:
    """The wide table from the twelve published tables read back."""
    night = published(spark, root)
    return assemble(night.table("join_prep"), [night.table(n) for n in teams.TEAMS], COHORT)


def _reconciled(spark: SparkSession, root: str) -> DataFrame:
    night = published(spark, root)
    return reconcile(night.table("join_prep"), {n: night.table(n) for n in teams.TEAMS}, COHORT)


def _percents(spark: SparkSession, root: str) -> DataFrame:
    """The wide table, every column of it held against its spec."""
    wide = teams.team_kpi_table(source(spark, root))
    KPIS.validate(wide)
    KPIS.validate_complete(wide, (*COHORT.dims, *PLACES))
    return KPIS.add_percent_columns(wide)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "student_join_prep": _team(teams.join_prep), "student_cc_hs": _team(teams.cc_hs), "student_cc_ps": _team(teams.cc_ps),
    "student_cc_ps_after": _team(teams.cc_ps, as_of=dt.date(2021, 7, 2)),
    "student_cc_ps_cutoff": _team(teams.cc_ps, as_of=dt.date(2021, 7, 1)),
    "student_fp": _team(teams.fp), "student_site_directors": _team(teams.site_directors),
    "student_student_life": _team(teams.student_life), "student_wellness": _team(teams.wellness),
    "student_team_kpi_table": _from_published, "student_wide_reconciliation": _reconciled,
    "student_kpi_percents": _percents,
    "student_dashboard": lambda spark, root: published(spark, root).table("dashboard"),
}
