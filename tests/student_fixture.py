"""Golden fixture in the reference's table shapes (FIXTURES.md §A).

Small, hand-made rows that cover the cases of FIXTURES.md §C: NULL gender
and NULL site, cells without qualifying students, zero attendance
denominators, two terms of different sizes, duplicate survey respondents,
NULL/misspelt/Spanish answers, parents without children, one- and
three-period test takers with a NULL sub-score, the term cut-off, students
at two sites, zero loan divisors, sites without case notes, '18a' vs '18A'
and cells missing from the spine.
"""

from __future__ import annotations

import datetime as dt

D = dt.date

CONTACT_SCHEMA = """contact_id string, site_short string, site_c string, site_sort int, region_abrev string,
 Contact_Record_Type_Name string, grade_c string, college_track_status_c string,
 indicator_years_since_hs_graduation_c int, indicator_completed_ct_hs_program_c boolean,
 Ethnic_background_c string, Gender_c string, contact_official_test_prep_withdrawal string,
 FA_Req_Expected_Financial_Contribution_c double, fa_req_efc_source_c string,
 Credit_Accumulation_Pace_c string, credits_accumulated_most_recent_c double,
 Current_Enrollment_Status_c string, Current_School_Type_c_degree string,
 college_first_enrolled_school_type_c string, ps_internships_c int,
 anticipated_date_of_graduation_ay_c string, academic_year_4_year_degree_earned_c string,
 most_recent_valid_cumulative_gpa double, indicator_first_generation_c boolean,
 indicator_low_income_c string, summer_experiences_previous_summer_c int,
 Dream_Statement_filled_out_c boolean, high_school_graduating_class_c string"""

AT_SCHEMA = """AT_Id string, Contact_Id string, student_c string, full_name_c string, site_short string,
 site_c string, grade_c string, college_track_status_c string, Ethnic_background_c string,
 Gender_c string, indicator_years_since_hs_graduation_c int, indicator_completed_ct_hs_program_c boolean,
 contact_official_test_prep_withdrawal string, most_recent_valid_cumulative_gpa double,
 credit_accumulation_pace_c string, current_enrollment_status_c string,
 college_first_enrolled_school_type_c string, AY_Name string, term_c string, GAS_Name string,
 AT_Name string, start_date_c date, global_academic_semester_c string, current_as_c boolean,
 previous_as_c boolean, AT_Grade_c string, AT_Enrollment_Status_c string, AT_school_type string,
 College_Track_Status_Name string, student_audit_status_c string, Readiness_Composite_Off_c string,
 Readiness_10_th_Composite_c string, composite_readiness_most_recent_c string,
 filing_status_c string, loans_c string, e_fund_c string, Overall_Rubric_Color string,
 advising_rubric_career_readiness_v_2_c string, academic_networking_50_cred_c string,
 academic_networking_over_50_credits_c string, enrolled_in_any_college_c boolean,
 indicator_persisted_at_c int, attended_workshops_c double, enrolled_sessions_c double,
 co_vitality_scorecard_color_c string"""

CLASS_SCHEMA = """Class_Attendance_Id string, student_c string, Academic_Semester_c string,
 global_academic_semester_c string, Attendance_Numerator_c double, Attendance_Denominator_c double,
 department_c string, Cancelled_c boolean, workshop_display_name_c string, dosage_types_c string,
 Outcome_c string, date_c date, is_deleted boolean"""

APP_SCHEMA = """student_c string, FA_Req_FAFSA_c string, verification_status_c string,
 admission_status_c string, College_Fit_Type_Applied_c string, fit_type_enrolled_c string"""
ASP_SCHEMA = "id string, student_c string, fit_type_current_c string"
ACCOUNT_SCHEMA = "Id string, College_Track_High_School_Capacity_v_2_c int"
ACTIVITY_SCHEMA = """semester_c string, record_type_id string, experience_meaningful_c boolean,
 status_c string, competitive_c boolean, type_c string"""
NOTE_SCHEMA = "id string, Academic_Semester_c string, Type_Counseling_c boolean"
TEST_SCHEMA = """id string, contact_name_c string, academic_semester_c string, record_type_id string,
 status_c string, belief_in_self_raw_score_c double, engaged_living_raw_score_c double,
 belief_in_others_raw_score_c double, emotional_competence_raw_score_c double,
 co_vitality_scorecard_color_c string"""
HS_SURVEY_SCHEMA = """contact_id string,
 ct_helps_me_better_understand_that_i_am_in_control_of_my_academic_performance string,
 i_feel_prepared_to_engage_in_academic_stretch_opportunities string,
 i_have_new_or_improved_critical_thinking_skills string, i_have_new_or_improved_study_habits_skills string,
 my_site_is_run_effectively_examples_i_know_how_to_find_zoom_links_i_receive_site string,
 i_have_a_hobby_or_interest_that_i_am_passionate_about_this_year string,
 how_likely_are_you_to_recommend_college_track_to_a_student_who_wants_to_get string,
 did_you_engage_with_wellness_services_at_your_site string,
 working_with_college_track_wellness_services_has_assisted_you_in_managing_your_s string,
 working_with_college_tracks_wellness_programming_has_helped_you_engage_in_self_c string,
 working_with_college_tracks_wellness_services_has_enhanced_your_mental_health string"""
COMPLETION_SCHEMA = """site_short string, Ethnic_background_c string, Gender_c string,
 student_count int, completed_survey_count int"""
PS_SURVEY_SCHEMA = """contact_id string, site_short string, Gender_c string, Ethnic_background_c string,
 i_am_able_to_receive_my_scholarship_funds_from_college_track string"""
ALUMNI_SCHEMA = """Contact_Id string, gender string, ethnicity string, ct_site string, survey_year string,
 i_feel_my_current_job_is_meaningful string,
 indicator_annual_loan_repayment_amount_current_loan_debt_125 double, indicator_income_proxy double,
 indicator_ft_job_or_grad_school_within_6_months int"""

SITES = {"Ward 8": ("acc1", 1, "DC"), "The Durant Center": ("acc4", 2, "DC"),
         "Crenshaw": ("acc2", 3, "LA"), "Oakland": ("acc3", 4, "NorCal"), None: (None, None, None)}

HS, PS = "Student: High School", "Student: Post-Secondary"
BACH = "Predominantly bachelor's-degree granting"
ASSOC = "Predominantly associate's-degree granting"


def contact(cid, site, eth, gender, status, grade, years, **kw):
    site_c, sort, region = SITES[site]
    row = dict(contact_id=cid, site_short=site, site_c=site_c, site_sort=sort, region_abrev=region,
               Contact_Record_Type_Name=PS if grade.startswith("Year") else HS, grade_c=grade,
               college_track_status_c=status, indicator_years_since_hs_graduation_c=years,
               indicator_completed_ct_hs_program_c=grade.startswith("Year"),
               Ethnic_background_c=eth, Gender_c=gender)
    row.update(kw)
    return row


CONTACTS = [
    contact("c1", "Ward 8", "Black", "Male", "11A", "12th Grade", -1, most_recent_valid_cumulative_gpa=3.5,
            FA_Req_Expected_Financial_Contribution_c=1000.0, fa_req_efc_source_c="FAFSA4caster",
            indicator_first_generation_c=True, indicator_low_income_c="Yes",
            summer_experiences_previous_summer_c=1, Dream_Statement_filled_out_c=True),
    contact("c2", "Ward 8", "Black", "Male", "11A", "11th Grade", -2, most_recent_valid_cumulative_gpa=3.3,
            contact_official_test_prep_withdrawal="withdrew", Dream_Statement_filled_out_c=False),
    contact("c3", "Ward 8", "Black", None, "11A", "9th Grade", -4, most_recent_valid_cumulative_gpa=2.0,
            indicator_first_generation_c=True, indicator_low_income_c="Yes"),
    contact("c4", "Crenshaw", "Latinx", "Female", "11A", "10th Grade", -3, most_recent_valid_cumulative_gpa=3.0,
            FA_Req_Expected_Financial_Contribution_c=500.0, fa_req_efc_source_c="FAFSA4caster"),
    contact("c5", "Crenshaw", "Latinx", "Female", "15A", "Year 6", 5, most_recent_valid_cumulative_gpa=2.8,
            Credit_Accumulation_Pace_c="4 Years", credits_accumulated_most_recent_c=100.0,
            Current_Enrollment_Status_c="Full-time", Current_School_Type_c_degree=BACH, ps_internships_c=2,
            anticipated_date_of_graduation_ay_c="AY 2020-21"),
    contact("c6", "Oakland", "Asian", "Male", "17A", "Year 6", 6, ps_internships_c=0,
            academic_year_4_year_degree_earned_c="AY 2020-21"),
    contact("c7", "Oakland", "Asian", "Male", "15A", "Year 3", 3, most_recent_valid_cumulative_gpa=2.4,
            college_first_enrolled_school_type_c=ASSOC, Credit_Accumulation_Pace_c="6+ Years"),
    contact("c8", None, "Asian", "Female", "11A", "12th Grade", -1, most_recent_valid_cumulative_gpa=3.9),
    contact("c9", "The Durant Center", "Black", "Male", "18a", "11th Grade", -2,
            most_recent_valid_cumulative_gpa=3.4),
    contact("c10", "Ward 8", "Black", "Male", "11A", "Year 1", 0, most_recent_valid_cumulative_gpa=3.0,
            indicator_completed_ct_hs_program_c=False),
]
BY_ID = {c["contact_id"]: c for c in CONTACTS}

TERMS = {  # gterm: (AY, term, GAS name, start date)
    "F19": ("AY 2019-20", "Fall", "Fall 2019-20 (Semester)", D(2019, 8, 15)),
    "W20": ("AY 2019-20", "Winter", "Winter 2019-20 (Semester)", D(2019, 12, 1)),
    "S20": ("AY 2019-20", "Spring", "Spring 2019-20 (Semester)", D(2020, 1, 10)),
    "U20": ("AY 2019-20", "Summer", "Summer 2019-20 (Semester)", D(2020, 6, 15)),
    "F20": ("AY 2020-21", "Fall", "Fall 2020-21 (Semester)", D(2020, 8, 15)),
    "S21": ("AY 2020-21", "Spring", "Spring 2020-21 (Semester)", D(2021, 1, 10)),
}


def at(cid, gterm, **kw):
    c = BY_ID[cid]
    ay, term, gas, start = TERMS[gterm]
    row = {k: c.get(k) for k in ("site_short", "site_c", "grade_c", "college_track_status_c",
                                 "Ethnic_background_c", "Gender_c", "indicator_years_since_hs_graduation_c",
                                 "indicator_completed_ct_hs_program_c", "contact_official_test_prep_withdrawal",
                                 "most_recent_valid_cumulative_gpa", "college_first_enrolled_school_type_c")}
    row.update(AT_Id=f"{cid}-{gterm}", Contact_Id=cid, student_c=cid, full_name_c=cid.upper(), AY_Name=ay,
               term_c=term, GAS_Name=gas, AT_Name=f"{cid} {gas}", start_date_c=start,
               global_academic_semester_c=gterm, current_as_c=(gterm == "S21"), previous_as_c=(gterm == "F20"),
               credit_accumulation_pace_c=c.get("Credit_Accumulation_Pace_c"),
               current_enrollment_status_c=c.get("Current_Enrollment_Status_c"),
               College_Track_Status_Name="Current CT HS Student" if c["college_track_status_c"] == "11A" else None)
    row.update(kw)
    return row


AT_ROWS = [
    # HS students: fall and (current) spring of 2020-21
    at("c1", "F20", co_vitality_scorecard_color_c="Blue", attended_workshops_c=8.0, enrolled_sessions_c=10.0),
    at("c1", "S21", Readiness_Composite_Off_c="1. Ready", Readiness_10_th_Composite_c="2. Near Ready",
       composite_readiness_most_recent_c="1. Ready", attended_workshops_c=9.0, enrolled_sessions_c=10.0),
    at("c1", "S20", student_audit_status_c="Current CT HS Student", grade_c="11th Grade"),
    at("c1", "U20", student_audit_status_c="Current CT HS Student", grade_c="11th Grade"),
    at("c2", "F20", co_vitality_scorecard_color_c="Red", attended_workshops_c=0.0, enrolled_sessions_c=0.0),
    at("c2", "F20", AT_Id="c2-F20b", co_vitality_scorecard_color_c="Blue"),       # two colours: counts twice
    at("c2", "S21", Readiness_Composite_Off_c="1. Ready", composite_readiness_most_recent_c="1. Ready"),
    at("c2", "S20", student_audit_status_c="Current CT HS Student", grade_c="10th Grade"),
    at("c3", "F20", co_vitality_scorecard_color_c="Green", attended_workshops_c=1.0, enrolled_sessions_c=10.0),
    at("c3", "S21"),
    at("c4", "F20", co_vitality_scorecard_color_c="Red"),
    at("c4", "S21"),
    at("c8", "F20"),
    at("c8", "S21", composite_readiness_most_recent_c="1. Ready"),
    at("c9", "S21"),
    at("c10", "S21", composite_readiness_most_recent_c="1. Ready"),
    # PS students: persistence base term F19, later W20, S20, F20; rubric on current term S21
    at("c5", "F19", enrolled_in_any_college_c=True, student_audit_status_c="Active: Post-Secondary"),
    at("c5", "W20", indicator_persisted_at_c=1),
    at("c5", "S20", indicator_persisted_at_c=1),
    at("c5", "F20", indicator_persisted_at_c=1),
    at("c5", "S21", filing_status_c="FS_G", loans_c="LN_Y", e_fund_c="EF_G", Overall_Rubric_Color="Green",
       advising_rubric_career_readiness_v_2_c="Green", academic_networking_over_50_credits_c="AN2_G"),
    at("c7", "F19", enrolled_in_any_college_c=True, student_audit_status_c="Active: Post-Secondary"),
    at("c7", "W20", indicator_persisted_at_c=1),
    at("c7", "S20", indicator_persisted_at_c=0),                                  # breaks persistence
    at("c7", "S21", AT_school_type="4-Year", AT_Enrollment_Status_c="Part-time", filing_status_c="FS_R",
       loans_c="LN_G", e_fund_c="EF_R"),
    at("c6", "F20", AT_Grade_c="Year 1", AT_Enrollment_Status_c="Full-time"),
    at("c6", "S21", AT_Grade_c="Year 1", AT_Enrollment_Status_c="Full-time"),    # same distinct tuple
    at("c7", "F20", AT_Grade_c="Year 1", AT_Enrollment_Status_c="Approved Gap Year"),
    at("c5", "F20", AT_Id="c5-F20y1", AT_Grade_c="Year 1", AT_Enrollment_Status_c="Full-time"),
]

CLASS_ROWS = [
    # Academic Affairs sessions: F20 has 6 AY 2020-21 term rows, S21 has 9 (weights differ)
    ("a1", "c1", "c1-F20", "F20", 1.0, 1.0, "Academic Affairs", False, "Math", None, "Attended", D(2020, 9, 1), False),
    ("a2", "c1", "c1-S21", "S21", 0.0, 1.0, "Academic Affairs", False, "Math", None, "Attended", D(2021, 1, 20), False),
    ("a3", "c2", "c2-S21", "S21", 1.0, 1.0, "Academic Affairs", False, "Math", None, "Attended", D(2021, 1, 20), False),
    ("a4", "c3", "c3-S21", "S21", 0.0, 0.0, "Academic Affairs", False, "Math", None, "Attended", D(2021, 1, 20), False),
    # College Completion: senior seminar (counts), other workshop (filtered), cancelled (filtered)
    ("b1", "c1", "c1-S21", "S21", 1.0, 1.0, "College Completion", False, "Senior Seminar A", None, "Attended",
     D(2021, 2, 1), False),
    ("b2", "c1", "c1-S21", "S21", 0.0, 1.0, "College Completion", False, "Essay Lab", None, "Attended",
     D(2021, 2, 2), False),
    ("b3", "c10", "c10-S21", "S21", 1.0, 1.0, "College Completion", True, "Senior Seminar A", None, "Attended",
     D(2021, 2, 3), False),
    # Student Life and Wellness sessions
    ("d1", "c1", "c1-F20", "F20", 1.0, 1.0, "Student Life", False, "Club", None, "Attended", D(2020, 9, 2), False),
    ("d2", "c4", "c4-F20", "F20", 0.0, 1.0, "Student Life", False, "Club", None, "Attended", D(2020, 9, 2), False),
    ("w1", "c1", "c1-F20", "F20", 2.0, 2.0, "Wellness", False, "Group", "Workshop", "Attended", D(2020, 10, 1), False),
    ("w2", "c2", "c2-F20", "F20", 1.0, 1.0, "Wellness", False, "Group", "NSO Orientation", "Attended",
     D(2020, 10, 1), False),
    ("w3", "c4", "c4-F20", "F20", 3.0, 3.0, "Wellness", False, "Group", "Workshop", "Attended", D(2020, 10, 2), False),
    ("w4", "c2", "c2-F20", "F20", 1.0, 1.0, "Wellness", False, "Group", None, "Attended", D(2020, 10, 3), False),
    # still scheduled (open) records for the monthly snapshot
    ("o1", "c1", "c1-S21", "S21", 0.0, 1.0, "Academic Affairs", False, "Math", None, "Scheduled", D(2021, 1, 15), False),
    ("o2", "c1", "c1-S21", "S21", 0.0, 1.0, "Academic Affairs", False, "Math", None, "Scheduled", D(2021, 2, 15), False),
    ("o3", "c2", "c2-S21", "S21", 0.0, 1.0, "Academic Affairs", False, "Math", None, "Scheduled", D(2020, 12, 15), False),
    ("o4", "c2", "c2-S21", "S21", 0.0, 1.0, "Academic Affairs", False, "Math", None, "Scheduled", D(2021, 2, 20), True),
]

APPS = [
    ("c1", "Submitted", "Submitted", "Accepted", "Best Fit", None),
    ("c1", None, None, "Accepted and Enrolled", "Best Fit", "Best Fit"),
    ("c1", None, None, "Wait-listed", "Reach", None),
    ("c10", "Submitted", "Pending", "Accepted", "Local Affordable", None),
    ("c8", None, None, "Denied", "Good Fit", None),
]
ASPIRATIONS = ([(f"a{i}", "c2", "Best Fit") for i in range(4)]
               + [("a4", "c2", "Local Affordable"), ("a5", "c2", "Reach"), ("a6", "c2", "Reach")])
ACCOUNTS = [("acc1", 120), ("acc2", 80), ("acc3", 60), ("acc4", 50)]
ACTIVITIES = [
    ("c1-U20", "01246000000ZNi8AAG", True, "Approved", True, "Internship"),
    ("c1-U20", "01246000000ZNi8AAG", True, "Pending", True, "Camp"),
    ("c2-S20", "01246000000ZNi8AAG", True, "Approved", False, "Internship"),       # not a Summer term
]
NOTES = [("n1", "c1-F20", True), ("n2", "c1-S21", True), ("n3", "c1-S21", False), ("n4", "c4-S21", True),
         ("n1", "c1-F20", True)]
TESTS = [
    ("t1", "c1", "c1-F20", "0121M000001cmuDQAQ", "Completed", 10.0, 10.0, 10.0, 10.0, "Blue"),
    ("t2", "c1", "c1-S21", "0121M000001cmuDQAQ", "Completed", 12.0, 10.0, 10.0, 10.0, "Blue"),
    ("t3", "c1", "c1-S20", "0121M000001cmuDQAQ", "Completed", 9.0, 9.0, 9.0, 9.0, "Blue"),
    ("t4", "c2", "c2-F20", "0121M000001cmuDQAQ", "Completed", 11.0, None, 10.0, 10.0, "Red"),
    ("t5", "c2", "c2-S21", "0121M000001cmuDQAQ", "Completed", 13.0, 10.0, 10.0, 10.0, "Red"),
    ("t6", "c4", "c4-S21", "0121M000001cmuDQAQ", "Completed", 8.0, 8.0, 8.0, 8.0, "Red"),
    ("t7", "c3", "c3-S21", "0121M000001cmuDQAQ", "In Progress", 8.0, 8.0, 8.0, 8.0, "Green"),
]
HS_SURVEY = [
    ("c1", "Strongly Agree", "Agree", "Agree", "Strongly Agree", "Agree", "Agree", "10 - extremely likely",
     "Yes", "Totalmente de acuerdo", None, None),
    ("c2", "Disagree", "Agree", "Agree", "Disagree", "Strongly Agree", "Disagree", "6",
     "Yes", "Disagree", "Disagree", "Disagree"),
    ("c2", "Agree", None, None, None, None, None, None, "Yes", None, None, None),     # duplicate respondent
    ("c4", "Agree", "Agree", "Agree", "Agree", None, "Agree", "8", "No", "Agree", None, None),
    ("c3", None, None, None, None, "Agree", None, "9", None, None, None, None),
]
COMPLETION = [("Ward 8", "Black", "Male", 3, 2), ("Crenshaw", "Latinx", "Female", 2, 1)]
PS_SURVEY = [("c5", "Crenshaw", "Female", "Latinx", "StronglyAgree"),
             ("c7", "Oakland", "Male", "Asian", "Disagree"),
             ("c6", "Oakland", "Male", "Asian", None)]
ALUMNI = [
    ("c6", "Male", "Asian", "Oakland", "FD20", "Agree", 100.0, 2000.0, 1),
    ("c5", "Female", "Latinx", "Crenshaw", "FY20", "Disagree", 100.0, 0.0, None),     # zero divisor
    ("c7", "Male", "Asian", "College Track Boyle Heights", "FD20", "Agree", 1.0, 100.0, 1),
]


def _frame(spark, rows, schema):
    cols = [c.strip().split(" ")[0] for c in schema.replace("\n", " ").split(",")]
    data = [tuple(r.get(c) for c in cols) if isinstance(r, dict) else r for r in rows]
    return spark.createDataFrame(data, schema)


def build(spark) -> dict:
    return {
        "contact_template": _frame(spark, CONTACTS, CONTACT_SCHEMA),
        "contact_at_template": _frame(spark, AT_ROWS, AT_SCHEMA),
        "class_template": _frame(spark, CLASS_ROWS, CLASS_SCHEMA),
        "college_application_clean": _frame(spark, APPS, APP_SCHEMA),
        "college_aspiration_c": _frame(spark, ASPIRATIONS, ASP_SCHEMA),
        "account": _frame(spark, ACCOUNTS, ACCOUNT_SCHEMA),
        "student_life_activity_c": _frame(spark, ACTIVITIES, ACTIVITY_SCHEMA),
        "progress_note_c": _frame(spark, NOTES, NOTE_SCHEMA),
        "test_clean": _frame(spark, TESTS, TEST_SCHEMA),
        "fy21_hs_survey": _frame(spark, HS_SURVEY, HS_SURVEY_SCHEMA),
        "fy21_hs_survey_completion": _frame(spark, COMPLETION, COMPLETION_SCHEMA),
        "fy21_ps_survey_wide_prepped": _frame(spark, PS_SURVEY, PS_SURVEY_SCHEMA),
        "fy20_alumni_survey": _frame(spark, ALUMNI, ALUMNI_SCHEMA),
    }
