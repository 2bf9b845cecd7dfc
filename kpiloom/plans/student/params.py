"""Parameters of the student KPI tables.

The reference hard-codes its periods and record-type ids in every file and
needs a manual edit when the year turns over; here they are one parameter
object whose defaults are the reference's values.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import functions as F

from kpiloom.operators.cohort import CohortSpec

COHORT = CohortSpec(("site_short", "Ethnic_background_c", "Gender_c"),
                    hierarchy=("region_abrev", "site_short"))
DIMS = list(COHORT.dims)

# Status codes, labels and record types the KPIs compare with.
ACTIVE_HS = "11A"
ACTIVE_PS = "15A"
PS_GRADUATE = "17A"
PROGRAM_STATUSES = ("11A", "12A", "13A", "15A", "16A", "17A")
RETAINED_STATUSES = ("11A", "18a", "12A")      # '18a' is lower case in the data
FP_STATUSES = ("11A", "12A", "15A")
AGREE = ("Strongly Agree", "Agree")
AGREE_WITH_MISSPELLING = ("StronglyAgree", "Strongly Agree", "Agree")
AGREE_BILINGUAL = ("Agree", "Strongly Agree", "Totalmente de acuerdo")
NPS_PROMOTERS = ("10 - extremely likely", "9")
NPS_PASSIVES = ("8", "7")
AFFORDABLE_FITS = ("Best Fit", "Good Fit", "Local Affordable")
AFFORDABLE_OR_SITUATIONAL = ("Best Fit", "Good Fit", "Local Affordable", "Situational")
BEST_GOOD = ("Best Fit", "Good Fit")
BEST_GOOD_SITUATIONAL = ("Best Fit", "Good Fit", "Situational")
ENROLLED_ADMISSIONS = ("Accepted and Enrolled", "Accepted and Deferred")
STRONG_ADMISSIONS = ("Accepted and Enrolled", "Accepted and Deferred", "Wait-listed")
OFF_PACE = ("6+ Years", "Credit Data Missing")
TWO_YEAR_STARTS = ("Predominantly associate's-degree granting",
                   "Predominantly certificate-degree granting")
BACHELORS_SCHOOL = "Predominantly bachelor's-degree granting"
NOT_READY_10TH = ("2. Near Ready", "3. Not Ready")
READY = "1. Ready"
CC_WORKSHOPS = ("%Junior Advisory%", "%Senior Advisory%", "%Senior Seminar%", "%College Exposure%")
COVI_RECORD_TYPE = "0121M000001cmuDQAQ"
SUMMER_EXPERIENCE_RECORD_TYPE = "01246000000ZNi8AAG"
NEED_COLORS = ("Blue", "Red")
FP_EXCLUDED_SITES = ("The Durant Center", "Ward 8", "Crenshaw")
ALUMNI_EXCLUDED_SITE = "College Track Boyle Heights"

# The columns that the team tables read of the two tables that
# most of them share (names as in the source).
CONTACT_COLUMNS = (
    "contact_id", "site_short", "Ethnic_background_c", "Gender_c", "site_c", "site_sort", "region_abrev",
    "Contact_Record_Type_Name", "grade_c", "college_track_status_c", "indicator_years_since_hs_graduation_c",
    "indicator_completed_ct_hs_program_c", "contact_official_test_prep_withdrawal",
    "FA_Req_Expected_Financial_Contribution_c", "fa_req_efc_source_c", "Credit_Accumulation_Pace_c",
    "credits_accumulated_most_recent_c", "Current_Enrollment_Status_c", "Current_School_Type_c_degree",
    "college_first_enrolled_school_type_c", "ps_internships_c", "anticipated_date_of_graduation_ay_c",
    "academic_year_4_year_degree_earned_c", "most_recent_valid_cumulative_gpa", "indicator_first_generation_c",
    "indicator_low_income_c", "summer_experiences_previous_summer_c", "Dream_Statement_filled_out_c",
)
TERM_COLUMNS = (
    "AT_Id", "Contact_Id", "student_c", "site_short", "Ethnic_background_c", "Gender_c", "site_c", "AY_Name", "term_c",
    "AT_Name", "GAS_Name", "start_date_c", "global_academic_semester_c", "current_as_c", "previous_as_c", "grade_c", "AT_Grade_c",
    "college_track_status_c", "College_Track_Status_Name", "student_audit_status_c", "most_recent_valid_cumulative_gpa",
    "Readiness_Composite_Off_c", "Readiness_10_th_Composite_c", "composite_readiness_most_recent_c",
    "contact_official_test_prep_withdrawal", "indicator_years_since_hs_graduation_c", "filing_status_c", "loans_c",
    "Overall_Rubric_Color", "advising_rubric_career_readiness_v_2_c", "academic_networking_50_cred_c",
    "academic_networking_over_50_credits_c", "indicator_completed_ct_hs_program_c", "AT_school_type", "AT_Enrollment_Status_c",
    "college_first_enrolled_school_type_c", "enrolled_in_any_college_c", "indicator_persisted_at_c", "e_fund_c",
    "attended_workshops_c", "enrolled_sessions_c", "credit_accumulation_pace_c", "current_enrollment_status_c",
    "co_vitality_scorecard_color_c",
)


@dataclass(frozen=True)
class StudentParams:
    as_of: dt.date = dt.date(2021, 3, 5)
    ay: str = "AY 2020-21"                  # current academic year
    prev_ay: str = "AY 2019-20"
    term_cutoff: dt.date = dt.date(2021, 7, 1)
    mse_terms: tuple[str, ...] = ("Spring 2019-20 (Semester)", "Summer 2019-20 (Semester)")
    graduation_ay: str = "AY 2020-21"
    support_grain: str = "site"             # "site" = the reference's join; "cohort" = intended
    open_records_year_aware: bool = False

    @property
    def as_of_lit(self):
        return F.lit(self.as_of)
