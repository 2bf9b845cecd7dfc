"""One builder per team table, on the reference's own table shapes.

``src(name)`` returns the DataFrame of a logical table (see
``kpiloom.sources.ParquetCatalog``); every builder returns a lazy
cohort-grain DataFrame keyed by (site_short, Ethnic_background_c, Gender_c).
Column names and semantics follow the reference's published KPI columns;
where a filter column exists in two joined tables the owner chosen in
FIXTURES.md is used.  Large fact tables (class attendance, activities,
notes, tests) are reduced to term or student grain before they are joined.
"""

from __future__ import annotations

import dataclasses
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kpiloom.functions.indicators import flag, flag_or_null, like_any, ratio_at_most
from kpiloom.functions.segments import segment
from kpiloom.operators.cohort import CohortSpec, assemble, cohort_agg, spine, sum_long
from kpiloom.operators.links import (activity_flags_any, child_count_threshold, existence_flags,
                                     members, restrict_to_members)
from kpiloom.operators.periods import (as_of_switch, distinct_population, exact_period_presence,
                                       open_before, persistence_entities, retention_rows,
                                       score_growth)
from kpiloom.operators.rates import (average_support, count_cube, entity_rate, period_weights,
                                     shared_denominators, three_state_rate)
from kpiloom.operators.surveys import distinct_entity_count, likert_agree, nps_flags, survey_completion
from kpiloom.plans.incremental import MergeableAggregate
from kpiloom.plans.job import KpiJob, Shared, Team
from kpiloom.plans.student.dashboard import dashboard_rollup
from kpiloom.plans.student.params import (
    ACTIVE_HS, ACTIVE_PS, AFFORDABLE_FITS, AFFORDABLE_OR_SITUATIONAL, AGREE, AGREE_BILINGUAL,
    AGREE_WITH_MISSPELLING, ALUMNI_EXCLUDED_SITE, BACHELORS_SCHOOL, BEST_GOOD,
    BEST_GOOD_SITUATIONAL, CC_WORKSHOPS, COHORT, CONTACT_COLUMNS, COVI_RECORD_TYPE, DIMS, ENROLLED_ADMISSIONS,
    FP_EXCLUDED_SITES, FP_STATUSES, NEED_COLORS, NOT_READY_10TH, NPS_PASSIVES, NPS_PROMOTERS,
    OFF_PACE, PROGRAM_STATUSES, PS_GRADUATE, READY, RETAINED_STATUSES, STRONG_ADMISSIONS,
    SUMMER_EXPERIENCE_RECORD_TYPE, TERM_COLUMNS, TWO_YEAR_STARTS, StudentParams)
from kpiloom.sources.catalog import ParquetCatalog

Source = Callable[[str], DataFrame]
c_ = F.col


def status() -> Column:
    return c_("college_track_status_c")


def grade() -> Column:
    return c_("grade_c")


def is_true(name: str) -> Column:
    return c_(name) == True  # noqa: E712 - NULL stays NULL (drops), as "= true"


def current_term(p: StudentParams) -> Column:
    """The date-switched term: current before the cut-off, previous after."""
    return as_of_switch(p.as_of, p.term_cutoff, is_true("current_as_c"), is_true("previous_as_c"))


def contact_dims(src: Source) -> DataFrame:
    return src("contact_template").select(c_("contact_id"), *DIMS)


def class_aggregate() -> MergeableAggregate:
    """The session fact table reduced, in one pass, to what every consumer
    needs: one row per (student, term, global term, department, workshop
    and NSO flags, outcome, cancelled, deleted, month) with summed
    numerators/denominators and counts.

    Each team's session filter is a predicate on these keys, and each of its
    sums is a sum of these partial sums, so the attendance rates, retention,
    wellness sessions and open-record counts are exact on the summary — and the
    summary of old months need not be computed again.
    """
    num = c_("Attendance_Numerator_c")
    names = ("student_c", "Academic_Semester_c", "global_academic_semester_c", "department_c", "Cancelled_c")
    return MergeableAggregate("class_summary", "class_template", keys={
        **{n: c_(n) for n in names}, "cc_workshop": like_any("workshop_display_name_c", CC_WORKSHOPS),
        "nso": c_("dosage_types_c").like("%NSO%"), "Outcome_c": c_("Outcome_c"), "is_deleted": c_("is_deleted"),
        "month_start": F.trunc(c_("date_c"), "MM"),
    }, sums={"num": num, "den": c_("Attendance_Denominator_c"), "ids": flag(c_("Class_Attendance_Id").isNotNull()),
             "pos_num": F.when(num > 0, num), "pos_rows": flag(num > 0)})


def class_summary(src: Source) -> DataFrame:
    aggregate = class_aggregate()
    return aggregate.partial(src(aggregate.source))


DERIVED: dict[str, Callable[[Source], DataFrame]] = {"class_summary": class_summary}


class Derived:
    """A source that also serves derived tables: given (materialised by a
    nightly job) or built on first use and then reused."""

    def __init__(self, src: Source, given: dict[str, DataFrame] | None = None):
        self.src = src.src if isinstance(src, Derived) else src
        self.frames = dict(src.frames) if isinstance(src, Derived) else {}
        self.frames.update(given or {})

    def __call__(self, name: str) -> DataFrame:
        if name not in self.frames and name in DERIVED:
            self.frames[name] = DERIVED[name](self.src)
        return self.frames[name] if name in self.frames else self.src(name)


def session_summary(src: Source) -> DataFrame:
    return Derived(src)("class_summary") if not isinstance(src, Derived) else src("class_summary")


def term_weighted_attendance(src: Source, class_pred: Column, term_pred: Column) -> DataFrame:
    """Attendance rate per student where each session counts once per
    contact-term row of its global term passing ``term_pred`` (the
    reference joins sessions to terms on the global term id alone).
    ``class_pred`` is a predicate on the session summary's keys."""
    cls = session_summary(src).filter(class_pred)
    w = period_weights(src("contact_at_template").filter(term_pred), "global_academic_semester_c")
    r = entity_rate(cls, "student_c", c_("num"), c_("den"), period="global_academic_semester_c", weights=w)
    return r.select(c_("student_c").alias("contact_id"), "rate")


# ----------------------------------------------------------------- join_prep
def join_prep(src: Source, p: StudentParams) -> DataFrame:
    """Spine and shared denominators (+ survey completion totals)."""
    c = src("contact_template").filter(segment("spine_status") &
                                       (c_("indicator_years_since_hs_graduation_c") <= 6))
    keys = ["site_short", "site_sort", "region_abrev", "Contact_Record_Type_Name", "grade_c",
            "indicator_completed_ct_hs_program_c", "college_track_status_c",
            "indicator_years_since_hs_graduation_c", *DIMS[1:], "contact_official_test_prep_withdrawal"]
    cube = count_cube(c, keys, "contact_id").withColumn("national", F.lit("National"))
    spec = CohortSpec(("national", "site_short", "site_sort", "region_abrev", *DIMS[1:]))
    denoms = shared_denominators(cube, spec, {
        "active_ps_student_count": segment("ps_record") & (status() == ACTIVE_PS),
        "hs_student_count": segment("hs_record"),
        "hs_senior_student_count": segment("senior"),
        "hs_senior_student_count_test_opt_in": segment.all_of("senior", "test_opt_in"),
        "hs_ninth_grade_student_count": segment("ninth_grade"),
        "hs_eleventh_student_count": segment("eleventh_grade"),
        "hs_eleventh_student_count_test_opt_in": segment.all_of("eleventh_grade", "test_opt_in"),
        "completed_hs_program_count": is_true("indicator_completed_ct_hs_program_c"),
    }, weight="student_count")
    sc = survey_completion(src("fy21_hs_survey_completion"), COHORT, {
        "hs_survey_completion_denominator": "student_count",
        "hs_survey_completion_count": "completed_survey_count"})
    return denoms.join(sc, DIMS, "left")


# ----------------------------------------------------------------- academic affairs
def academic_affairs(src: Source, p: StudentParams) -> DataFrame:
    at = src("contact_at_template").filter(is_true("current_as_c") & (status() == ACTIVE_HS))
    opt_in, ready = segment("test_opt_in"), c_("Readiness_Composite_Off_c") == READY
    not_ready_10th = c_("Readiness_10_th_Composite_c").isin(*NOT_READY_10TH)
    gd = at.select(c_("Contact_Id").alias("contact_id"), *DIMS,
                   flag(c_("most_recent_valid_cumulative_gpa") >= 3.25).alias("above_325_gpa"),
                   flag(ready & segment("senior") & opt_in).alias("composite_ready"),
                   flag(ready & opt_in & segment("eleventh_grade")).alias("ready_11"),
                   flag(not_ready_10th & opt_in &
                        ~grade().isin("9th Grade", "10th Grade", "11th Grade")).alias("not_ready_10"),
                   flag(ready & opt_in & not_ready_10th).alias("official_ready"))
    att = term_weighted_attendance(src, c_("department_c") == "Academic Affairs", c_("AY_Name") == p.ay)
    att = att.select("contact_id", flag(c_("rate") >= 0.8).alias("above_80"))
    survey = src("fy21_hs_survey").select(
        "contact_id",
        likert_agree({"ct_helps_me_better_understand_that_i_am_in_control_of_my_academic_performance":
                      AGREE}).alias("in_control"),
        likert_agree({"i_feel_prepared_to_engage_in_academic_stretch_opportunities": AGREE}).alias("stretch"),
        likert_agree({"i_have_new_or_improved_critical_thinking_skills": AGREE,
                      "i_have_new_or_improved_study_habits_skills": AGREE}, "all").alias("exec_fn"))
    j = gd.join(att, "contact_id", "left").join(survey, "contact_id", "left")
    return cohort_agg(j, COHORT, {
        "aa_above_325_gpa": sum_long("above_325_gpa"),
        "aa_composite_ready": sum_long("composite_ready"),
        "aa_composite_ready_eleventh_grade": sum_long("ready_11"),
        "aa_tenth_grade_test_not_ready": sum_long("not_ready_10"),
        "aa_offical_test_ready": sum_long("official_ready"),
        "aa_above_80_aa_attendance": sum_long("above_80"),
        "aa_i_am_in_control_of_my_academic_performance": sum_long("in_control"),
        "aa_i_feel_prepared_to_engage_in_academic_stretch_opportunities": sum_long("stretch"),
        "aa_self_perceived_growth_in_executive_functioning_skill": sum_long("exec_fn"),
    })


# ----------------------------------------------------------------- college completion, HS
def cc_hs(src: Source, p: StudentParams) -> DataFrame:
    c = src("contact_template")
    hs = c.filter(status() == ACTIVE_HS)
    tenth = hs.filter(grade() == "10th Grade")
    k10 = cohort_agg(tenth, COHORT, {
        "cc_hs_EFC_10th_num": sum_long(flag(c_("FA_Req_Expected_Financial_Contribution_c").isNotNull() &
                                            (c_("fa_req_efc_source_c") == "FAFSA4caster"))),
        "cc_hs_EFC_10th_denom": F.count(F.lit(1))})
    eleventh = hs.filter(grade() == "11th Grade").select("contact_id", *DIMS)
    asp = child_count_threshold(
        eleventh, "contact_id", src("college_aspiration_c"), "student_c",
        {"any_count": c_("id").isNotNull(), "affordable_count": c_("fit_type_current_c").isin(*AFFORDABLE_FITS)},
        lambda any_count, affordable_count: (any_count >= 6) & (affordable_count >= 3), "asp")
    k11 = cohort_agg(asp, COHORT, {"cc_hs_aspirations_num": sum_long("asp"),
                                   "cc_hs_aspirations_denom": F.count(F.lit(1))})
    att = term_weighted_attendance(
        src, (c_("department_c") == "College Completion") & (c_("Cancelled_c") == False)  # noqa: E712
        & c_("cc_workshop"),
        (c_("AY_Name") == p.ay) & (status() == ACTIVE_HS) & segment("senior"))
    seniors = hs.filter(segment("senior")).select("contact_id", *DIMS).join(att, "contact_id", "left")
    adm, applied, enrolled = c_("admission_status_c"), c_("College_Fit_Type_Applied_c"), c_("fit_type_enrolled_c")
    look = existence_flags(seniors, "contact_id", src("college_application_clean"), "student_c", {
        "fafsa": (c_("FA_Req_FAFSA_c") == "Submitted") &
                 c_("verification_status_c").isin("Submitted", "Not Applicable"),
        "acc_aff": (adm == "Accepted") & applied.isin(*AFFORDABLE_FITS),
        "enr_aff": adm.isin(*ENROLLED_ADMISSIONS) & enrolled.isin(*AFFORDABLE_OR_SITUATIONAL),
        "acc_bg": (adm == "Accepted") & applied.isin(*BEST_GOOD),
        "enr_bgs": adm.isin(*ENROLLED_ADMISSIONS) & enrolled.isin(*BEST_GOOD_SITUATIONAL),
        "app_bg": applied.isin(*BEST_GOOD),
        "strong": adm.isin(*STRONG_ADMISSIONS),
    })
    k12 = cohort_agg(look, COHORT, {
        "cc_hs_above_80_cc_attendance": sum_long(flag(c_("rate") >= 0.8)),
        "cc_hs_accepted_affordable": sum_long(F.greatest("enr_aff", "acc_aff")),
        "cc_hs_applied_best_good": sum_long("app_bg"),
        "cc_hs_accepted_best_good_situational": sum_long(F.greatest("enr_bgs", "acc_bg")),
        "cc_hs_strong_college_situations": sum_long("strong"),
        "cc_hs_financial_aid_submission_verification": sum_long("fafsa"),
        "cc_hs_enrolled_best_good_situational": sum_long("enr_bgs"),
        "cc_hs_enrolled_affordable": sum_long("enr_aff"),
    })
    return assemble(spine(c, COHORT), [k10, k11, k12], COHORT)


# ----------------------------------------------------------------- college completion, PS
def cc_ps(src: Source, p: StudentParams) -> DataFrame:
    c = src("contact_template").filter(is_true("indicator_completed_ct_hs_program_c"))
    on_pace = ((status() == ACTIVE_PS) & ~c_("Credit_Accumulation_Pace_c").isin(*OFF_PACE)
               & (c_("credits_accumulated_most_recent_c") >= 80)
               & (c_("Current_Enrollment_Status_c") == "Full-time")
               & (c_("Current_School_Type_c_degree") == BACHELORS_SCHOOL))
    graduating = (((c_("anticipated_date_of_graduation_ay_c") == p.graduation_ay) & on_pace)
                  | (c_("academic_year_4_year_degree_earned_c") == p.graduation_ay))
    two_year_start = c_("college_first_enrolled_school_type_c").isin(*TWO_YEAR_STARTS)
    year6 = grade() == "Year 6"
    ents = c.select(
        "contact_id", *DIMS,
        flag(year6 & (on_pace | (status() == PS_GRADUATE))).alias("grad_num"),
        flag(year6).alias("grad_denom"),
        flag((grade() == "Year 3") & two_year_start).alias("transfer_denom"),
        flag((c_("ps_internships_c") > 0) & graduating).alias("intern_num"),
        flag(graduating).alias("intern_denom"),
        flag((status() == ACTIVE_PS) & (c_("most_recent_valid_cumulative_gpa") >= 2.5)).alias("gpa_num"))
    keys = ["contact_id", "Gender_c", "Ethnic_background_c"]
    at = src("contact_at_template").filter((status() == ACTIVE_PS) & current_term(p))
    rubric = at.select(
        c_("Contact_Id").alias("contact_id"), "Gender_c", "Ethnic_background_c",
        flag(c_("filing_status_c") == "FS_G").alias("fafsa"),
        flag(c_("loans_c").isin("LN_G", "LN_Y")).alias("loans"),
        flag(c_("Overall_Rubric_Color") == "Green").alias("balanced"),
        flag((c_("advising_rubric_career_readiness_v_2_c") == "Green")
             & ((c_("academic_networking_50_cred_c") == "AN1_G")
                | (c_("academic_networking_over_50_credits_c") == "AN2_G"))).alias("skills"),
        flag(is_true("indicator_completed_ct_hs_program_c") & (grade() == "Year 3")
             & (c_("AT_school_type") == "4-Year")
             & c_("AT_Enrollment_Status_c").isin("Full-time", "Part-time") & two_year_start
             ).alias("transfer_num"))
    terms = src("contact_at_template").select(
        c_("Contact_Id").alias("contact_id"), "AY_Name", "term_c", "site_short", "Gender_c",
        "Ethnic_background_c", "enrolled_in_any_college_c", "student_audit_status_c",
        "indicator_persisted_at_c")
    ay, term = c_("AY_Name"), c_("term_c")
    persisted = persistence_entities(
        terms, "contact_id", base=(ay == p.prev_ay) & (term == "Fall"),
        group_pred=is_true("enrolled_in_any_college_c")
        & (c_("student_audit_status_c") == "Active: Post-Secondary"),
        later=((ay == p.prev_ay) & term.isin("Winter", "Spring")) | ((ay == p.ay) & (term == "Fall")),
        persisted_pred=(c_("student_audit_status_c") == "CT Alumni") | (c_("indicator_persisted_at_c") == 1),
        cohort=CohortSpec(("Gender_c", "Ethnic_background_c")), site="site_short",
        denom="persist_denom", num="persisted")
    alumni = src("fy20_alumni_survey").filter(c_("ct_site") != ALUMNI_EXCLUDED_SITE).select(
        c_("Contact_Id").alias("contact_id"), c_("gender").alias("Gender_c"),
        c_("ethnicity").alias("Ethnic_background_c"),
        likert_agree({"i_feel_my_current_job_is_meaningful": AGREE}).alias("meaningful"),
        flag(ratio_at_most("indicator_annual_loan_repayment_amount_current_loan_debt_125",
                           "indicator_income_proxy", 0.08)).alias("gainful"),
        flag(c_("Contact_Id").isNotNull()).alias("respondent"),
        flag((c_("survey_year") == "FD20")
             & (c_("indicator_ft_job_or_grad_school_within_6_months") == 1)).alias("employed"),
        flag(c_("survey_year") == "FD20").alias("recent_grad"))
    j = ents.join(rubric, keys, "left").join(persisted, keys, "left").join(alumni, keys, "left")
    return cohort_agg(j, COHORT, {
        "cc_ps_projected_grad_num": sum_long("grad_num"),
        "cc_ps_projected_grad_denom": sum_long("grad_denom"),
        "cc_ps_2_yr_transfer_num": sum_long("transfer_num"),
        "cc_ps_2_yr_transfer_denom": sum_long("transfer_denom"),
        "cc_ps_grad_internship_num": sum_long("intern_num"),
        "cc_ps_grad_internship_denom": sum_long("intern_denom"),
        "cc_ps_gpa_2_5_num": sum_long("gpa_num"),
        "cc_ps_loans_30k": sum_long("loans"),
        "cc_ps_fasfa_complete": sum_long("fafsa"),
        "cc_ps_well_balanced_lifestyle": sum_long("balanced"),
        "cc_ps_tech_interpersonal_skills": sum_long("skills"),
        "cc_ps_persist_num": sum_long("persisted"),
        "cc_persist_denom": sum_long("persist_denom"),
        "cc_ps_meaningful_num": sum_long("meaningful"),
        "cc_ps_gainful_num": sum_long("gainful"),
        "cc_ps_meaningful_gainful_denom": sum_long("respondent"),
        "cc_ps_employed_grad_6_months_num": sum_long("employed"),
        "cc_ps_employed_grad_6_months_denom": sum_long("recent_grad"),
    })


# ----------------------------------------------------------------- financial planning
def fp(src: Source, p: StudentParams) -> DataFrame:
    q = "i_am_able_to_receive_my_scholarship_funds_from_college_track"
    ps = src("fy21_ps_survey_wide_prepped").filter(c_(q).isNotNull())
    survey = cohort_agg(ps, COHORT, {
        "ps_survey_scholarship_denom": sum_long(flag(c_("contact_id").isNotNull())),
        "ps_survey_scholarship_num": sum_long(likert_agree({q: AGREE_WITH_MISSPELLING}))})
    at = src("contact_at_template").filter((status() == ACTIVE_PS) & current_term(p))
    efund = cohort_agg(at, COHORT, {"fp_efund_num": sum_long(flag(c_("e_fund_c") == "EF_G"))})
    c = src("contact_template")
    senior_hs = (status() == ACTIVE_HS) & segment("senior")
    base = cohort_agg(c.filter(status().isin(*FP_STATUSES)), COHORT, {
        "fp_12_efc_num": sum_long(flag(senior_hs & c_("fa_req_expected_financial_contribution_c").isNotNull()))})
    adm = c_("admission_status_c")
    bf = existence_flags(c.filter(senior_hs).select("contact_id", *DIMS), "contact_id",
                         src("college_application_clean"), "student_c", {
                             "acc": (adm == "Accepted") & (c_("College_Fit_Type_Applied_c") == "Best Fit"),
                             "enr": adm.isin(*ENROLLED_ADMISSIONS) & (c_("fit_type_enrolled_c") == "Best Fit")})
    best_fit = cohort_agg(bf, COHORT, {"fp_accepted_best_fit_denom": sum_long("acc"),
                                       "fp_enrolled_best_fit_numerator": sum_long("enr")})
    wide = assemble(base, [survey, efund, best_fit], COHORT)
    # NOT IN drops the excluded sites and a NULL site alike
    return wide.filter(~c_("site_short").isin(*FP_EXCLUDED_SITES))


# ----------------------------------------------------------------- operations
SITE_RUN_Q = "my_site_is_run_effectively_examples_i_know_how_to_find_zoom_links_i_receive_site"


def om(src: Source, p: StudentParams) -> DataFrame:
    s = src("fy21_hs_survey").select("contact_id", likert_agree({SITE_RUN_Q: AGREE}).alias("agree"))
    j = s.join(contact_dims(src), "contact_id", "left").filter(c_("site_short").isNotNull())
    return cohort_agg(j, COHORT, {"OM_agree_site_is_run_effectively": sum_long("agree")})


def om_incomplete_attendance(src: Source, p: StudentParams) -> DataFrame:
    """Monthly snapshot: still-scheduled sessions dated before the as-of month."""
    # month_start < first-of-month and month(month_start) = month(date_c), so
    # both date tests are exact on the summary's month
    cls = session_summary(src).filter(
        (c_("Outcome_c") == "Scheduled")
        & open_before(c_("month_start"), p.as_of, p.open_records_year_aware)
        & (c_("is_deleted") == False))  # noqa: E712
    per_term = cls.groupBy("Academic_Semester_c").agg(F.sum("ids").alias("n"))
    cat = src("contact_at_template").filter(is_true("current_as_c")).select("AT_Id", *DIMS)
    j = per_term.join(cat, per_term["Academic_Semester_c"] == cat["AT_Id"])
    return cohort_agg(j, COHORT, {"OM_incomplete_wsa_records": sum_long("n")})


NPS_Q = "how_likely_are_you_to_recommend_college_track_to_a_student_who_wants_to_get"


def program_ops(src: Source, p: StudentParams) -> DataFrame:
    c = src("contact_template").filter(status().isin(*PROGRAM_STATUSES))
    incoming = (grade() == "9th Grade") & (status() == ACTIVE_HS)
    gd = c.select("contact_id", *DIMS,
                  flag(incoming & is_true("indicator_first_generation_c")).alias("first_gen"),
                  flag(incoming & (c_("indicator_low_income_c") == "Yes")).alias("low_income"))
    fl = nps_flags(c_(NPS_Q), NPS_PROMOTERS, NPS_PASSIVES)
    s = src("fy21_hs_survey").select("contact_id", fl["promoter"].alias("promoter"),
                                     fl["detractor"].alias("detractor"))
    j = gd.join(s, "contact_id", "left")
    return cohort_agg(j, COHORT, {
        "pro_ops_incoming_cohort_first_gen": sum_long("first_gen"),
        "pro_ops_incoming_cohort_low_income": sum_long("low_income"),
        "nps_promoter": sum_long("promoter"), "nps_detractor": sum_long("detractor")})


# ----------------------------------------------------------------- regional directors
def red(src: Source, p: StudentParams) -> DataFrame:
    at = src("contact_at_template")
    gpa_ready = ((c_("most_recent_valid_cumulative_gpa") >= 3.25)
                 & (c_("composite_readiness_most_recent_c") == READY) & (status() == ACTIVE_HS))
    gd = at.filter(is_true("current_as_c") & status().isin(*PROGRAM_STATUSES)).select(
        c_("Contact_Id").alias("gd_contact"),
        flag(gpa_ready & segment("test_opt_in") & segment("senior")).alias("ready_12"),
        flag(gpa_ready & segment("eleventh_grade")).alias("ready_11"))
    attended = session_summary(src).filter(
        (c_("pos_rows") > 0) & ~c_("nso") & (c_("Outcome_c") != "Cancelled")
    ).select("student_c", "Academic_Semester_c").distinct()
    cat = at.filter((c_("AY_Name") == p.ay) & (grade() != "8th Grade")).select(
        "AT_Id", *DIMS, "college_track_status_c")
    act = attended.join(cat, attended["Academic_Semester_c"] == cat["AT_Id"])
    rows = retention_rows(act, "student_c", status().isin(*RETAINED_STATUSES), COHORT)
    j = rows.join(gd, rows["student_c"] == gd["gd_contact"], "left")
    return cohort_agg(j, COHORT, {
        "retention_denom": F.count("student_c"), "retention_num": sum_long("active"),
        "red_gpa_3_25_test_ready": sum_long("ready_12"),
        "red_gpa_3_25__test_ready_eleventh": sum_long("ready_11")})


# ----------------------------------------------------------------- site directors
def covi_tests(src: Source, p: StudentParams, *term_cols: str) -> DataFrame:
    t = src("test_clean").filter(c_("record_type_id") == COVI_RECORD_TYPE)
    cat = src("contact_at_template").filter(
        c_("AY_Name").isin(p.prev_ay, p.ay) & (status() == ACTIVE_HS)).select("AT_Id", *term_cols, *DIMS)
    return t.join(cat, t["academic_semester_c"] == cat["AT_Id"])


def site_directors(src: Source, p: StudentParams) -> DataFrame:
    c = src("contact_template").filter(status().isin(*RETAINED_STATUSES))
    a11, gpa = status() == ACTIVE_HS, c_("most_recent_valid_cumulative_gpa")
    hs = c.select(
        "contact_id", "site_c", *DIMS,
        flag(segment("senior") & (gpa >= 3.25) & a11).alias("senior_325"),
        flag(segment("eleventh_grade") & (gpa >= 3.25) & a11).alias("eleventh_325"),
        flag(segment("ninth_grade") & (c_("Gender_c") == "Male") & a11).alias("male_9"),
        flag(segment("ninth_grade") & (c_("indicator_low_income_c") == "Yes")
             & is_true("indicator_first_generation_c") & a11).alias("fgli_9"),
        flag((c_("summer_experiences_previous_summer_c") > 0) & a11).alias("summer"))
    at = src("contact_at_template")
    ay_att = (at.filter((c_("AY_Name") == p.ay) & (c_("term_c") != "Summer") & a11)
              .groupBy(c_("Contact_Id").alias("contact_id"))
              .agg(F.sum("attended_workshops_c").alias("attended"),
                   F.sum("enrolled_sessions_c").alias("enrolled")))
    hs = three_state_rate(hs.join(ay_att, "contact_id", "left"), "attended", "enrolled", 0.8, "above_80")
    account = src("account").select(c_("Id").alias("site_c"),
                                     c_("College_Track_High_School_Capacity_v_2_c").alias("capacity"))
    hs_metrics = cohort_agg(hs.join(account, "site_c", "left"), COHORT, {
        "SD_hs_capacity_numerator": F.count("contact_id"),
        "SD_senior_above_325": sum_long("senior_325"),
        "SD_above_325_gpa_eleventh_grade": sum_long("eleventh_325"),
        "SD_ninth_grade_male": sum_long("male_9"),
        "SD_ninth_grade_first_gen_low_income": sum_long("fgli_9"),
        "SD_above_80_attendance": sum_long("above_80"),
        "SD_summer_experience": sum_long("summer"),
        "hs_cohort_capacity": F.max("capacity"),
    })
    ps = at.filter((c_("AT_Grade_c") == "Year 1") & (c_("AT_Enrollment_Status_c") != "Approved Gap Year")
                   & (c_("indicator_years_since_hs_graduation_c") <= 6)
                   & is_true("indicator_completed_ct_hs_program_c"))
    on_track = ((~c_("credit_accumulation_pace_c").isin(*OFF_PACE) & (status() == ACTIVE_PS))
                | (status() == PS_GRADUATE))
    ps_metrics = distinct_population(
        ps, "Contact_Id", ["site_c", "credit_accumulation_pace_c", "current_enrollment_status_c",
                           "college_track_status_c"], COHORT, on_track,
        "SD_on_track_student_count", "SD_on_track")
    score = (c_("belief_in_self_raw_score_c") + c_("engaged_living_raw_score_c")
             + c_("belief_in_others_raw_score_c") + c_("emotional_competence_raw_score_c"))
    covi = score_growth(covi_tests(src, p, "AY_Name"), "contact_name_c", "AY_Name", score, COHORT,
                        "SD_covi_student_grew", "SD_covi_denominator")
    return assemble(hs_metrics, [ps_metrics, covi], COHORT)


# ----------------------------------------------------------------- student life
HOBBY_Q = "i_have_a_hobby_or_interest_that_i_am_passionate_about_this_year"


def student_life(src: Source, p: StudentParams) -> DataFrame:
    c = src("contact_template")
    dream = cohort_agg(c, COHORT, {"sl_dreams_declared": sum_long(
        flag(is_true("Dream_Statement_filled_out_c") & (status() == ACTIVE_HS)))})
    at = src("contact_at_template")
    mse_group = exact_period_presence(
        at.filter(grade() != "8th Grade"), "student_c",
        c_("student_audit_status_c") == "Current CT HS Student", c_("GAS_Name").isin(*p.mse_terms), 2,
        COHORT, "sl_mse_reporting_group_prev_AY")
    acts = src("student_life_activity_c").filter(
        (c_("record_type_id") == SUMMER_EXPERIENCE_RECORD_TYPE) & is_true("experience_meaningful_c")
        & (c_("status_c") == "Approved"))
    summers = at.filter(c_("AY_Name").isin(p.ay, p.prev_ay) & (c_("term_c") == "Summer")).select(
        "AT_Id", c_("Contact_Id").alias("contact_id"), "AY_Name", "term_c", *DIMS)
    aj = acts.join(summers, acts["semester_c"] == summers["AT_Id"])
    prev_summer = (c_("AY_Name") == p.prev_ay) & (c_("term_c") == "Summer")
    per = activity_flags_any(aj, "contact_id", {
        "completed": prev_summer,
        "competitive": is_true("competitive_c") & prev_summer,
        "internship": (c_("type_c") == "Internship") & (c_("AY_Name") == p.prev_ay),
    }, keep=tuple(DIMS))
    mse = cohort_agg(per, COHORT, {"sl_mse_completed_prev_AY": sum_long("completed"),
                                   "sl_mse_competitive_prev_AY": sum_long("competitive"),
                                   "sl_mse_internship_prev_AY": sum_long("internship")})
    att = term_weighted_attendance(src, (c_("department_c") == "Student Life")
                                   & (c_("Cancelled_c") == False), c_("AY_Name") == p.ay)  # noqa: E712
    attendance = cohort_agg(contact_dims(src).join(att, "contact_id", "left"), COHORT, {
        "sl_above_80_attendance": sum_long(flag(c_("rate") >= 0.8))})
    s = src("fy21_hs_survey").select("contact_id", likert_agree({HOBBY_Q: AGREE}).alias("hobby"))
    hobby = cohort_agg(s.join(contact_dims(src), "contact_id", "left"), COHORT,
                       {"sl_agree_they_have_hobby": sum_long("hobby")})
    covi = score_growth(covi_tests(src, p, "start_date_c", "AT_Name"), "contact_name_c", "start_date_c",
                        c_("belief_in_self_raw_score_c"), COHORT,
                        "SL_covi_belief_student_grew", "SL_covi_belief_denominator", extra=["AT_Name"])
    return assemble(spine(c, COHORT), [dream, attendance, mse, mse_group, hobby, covi], COHORT)


# ----------------------------------------------------------------- wellness
WELLNESS_QS = ("working_with_college_track_wellness_services_has_assisted_you_in_managing_your_s",
               "working_with_college_tracks_wellness_programming_has_helped_you_engage_in_self_c",
               "working_with_college_tracks_wellness_services_has_enhanced_your_mental_health")


def wellness(src: Source, p: StudentParams) -> DataFrame:
    at = src("contact_at_template")
    hs_terms = at.filter((c_("College_Track_Status_Name") == "Current CT HS Student")
                         & (grade().isin("9th Grade", "10th Grade", "11th Grade") | segment("senior"))
                         & (c_("AY_Name") == p.ay)).select("AT_Id", c_("Contact_Id").alias("contact_id"), *DIMS)
    tests = src("test_clean").filter((c_("record_type_id") == COVI_RECORD_TYPE) & (c_("status_c") == "Completed"))
    tj = tests.join(hs_terms, tests["academic_semester_c"] == hs_terms["AT_Id"])
    assessed = distinct_entity_count(tj, "contact_id", COHORT, "wellness_covi_assessment_completed_ay",
                                     pred=c_("id").isNotNull())
    s = src("fy21_hs_survey").filter(c_("did_you_engage_with_wellness_services_at_your_site") == "Yes")
    s = s.select("contact_id", likert_agree({q: AGREE_BILINGUAL for q in WELLNESS_QS}, "any").alias("agree"))
    survey = distinct_entity_count(
        s.join(contact_dims(src), "contact_id", "left"), "contact_id", COHORT,
        "wellness_survey_wellness_services_assisted_denom",
        extra={"wellness_survey_wellness_services_assisted_num": sum_long("agree")})
    fall = (c_("AY_Name") == p.ay) & (c_("term_c") == "Fall")
    color = c_("co_vitality_scorecard_color_c")
    need_rows = (at.filter((grade() != "8th Grade") & (status() == ACTIVE_HS) & fall)
                 .groupBy(c_("Contact_Id").alias("contact_id"), *DIMS, color)
                 .agg(F.max(flag_or_null(color.isin(*NEED_COLORS))).alias("need")))
    need = cohort_agg(need_rows, COHORT, {"sum_of_blue_red_covi_for_avg": sum_long("need")})
    in_need = members(at, "Contact_Id", color.isin(*NEED_COLORS) & fall)
    ay_terms = at.filter((c_("AY_Name") == p.ay) & (status() == ACTIVE_HS))
    sess_terms = restrict_to_members(ay_terms.filter(grade() != "8th Grade").select(
        "AT_Id", c_("Contact_Id").alias("contact_id"), *DIMS), "contact_id", in_need)
    cls = session_summary(src).filter(
        (c_("pos_rows") > 0) & (c_("department_c") == "Wellness") & ~c_("nso")
        & (c_("Outcome_c") != "Cancelled"))
    per_term = cls.groupBy("Academic_Semester_c").agg(F.sum("pos_num").alias("s"))
    sessions = cohort_agg(per_term.join(sess_terms, per_term["Academic_Semester_c"] == sess_terms["AT_Id"]),
                          COHORT, {"sum_attended_wellness_sessions": F.sum("s")})
    note_terms = restrict_to_members(ay_terms.select("AT_Id", c_("Contact_Id").alias("contact_id"), *DIMS),
                                     "contact_id", in_need)
    notes_t = src("progress_note_c").filter(is_true("Type_Counseling_c"))
    notes = distinct_entity_count(notes_t.join(note_terms, notes_t["Academic_Semester_c"] == note_terms["AT_Id"]),
                                  "id", COHORT, "case_note_count")
    support = average_support(
        sessions.withColumnRenamed("sum_attended_wellness_sessions", "sessions"),
        notes.withColumnRenamed("case_note_count", "notes"),
        need.withColumnRenamed("sum_of_blue_red_covi_for_avg", "need_count"),
        COHORT, "site_short", p.support_grain)
    avg = support.select(*DIMS, c_("avg_support").alias("wellness_avg_support"))
    return assemble(assessed, [survey, avg, sessions, notes, need], COHORT)


# ----------------------------------------------------------------- assembly
TEAMS: dict[str, Callable[[Source, StudentParams], DataFrame]] = {
    "academic_affairs": academic_affairs,
    "site_directors": site_directors,
    "cc_hs": cc_hs,
    "cc_ps": cc_ps,
    "student_life": student_life,
    "om": om,
    "red": red,
    "program_ops": program_ops,
    "om_incomplete_attendance": om_incomplete_attendance,
    "wellness": wellness,
    "fp": fp,
}


def build_all(src: Source, p: StudentParams | None = None) -> dict[str, DataFrame]:
    p = p or StudentParams()
    src = Derived(src)                  # one session summary for every team
    out = {"join_prep": join_prep(src, p)}
    out.update({name: fn(src, p) for name, fn in TEAMS.items()})
    return out


def team_kpi_table(src: Source, p: StudentParams | None = None) -> DataFrame:
    """join_prep ⟕ the eleven team tables on the cohort cell (plain '=')."""
    p = p or StudentParams()
    src = Derived(src)
    return assemble(join_prep(src, p), [fn(src, p) for fn in TEAMS.values()], COHORT)


def shared_stages(src: Source) -> dict[str, Shared]:
    """What most teams read, once a run: the columns they use of the contact and
    the term table, in the same buckets of the contact, so that joins per contact
    need no exchange, and the session summary (from the months that changed, if
    the sessions are files that this catalog reads).  The summary is as long as
    the facts and half of its readers join it by term: it stays as its aggregate
    leaves it, and each reader moves only the sums that it filters."""
    files = isinstance(src, ParquetCatalog) and "class_template" not in src.overrides
    return {
        "contact_template": Shared(lambda: src("contact_template").select(*CONTACT_COLUMNS), key="contact_id"),
        "contact_at_template": Shared(lambda: src("contact_at_template").select(*TERM_COLUMNS), key="Contact_Id"),
        "class_summary": (Shared(aggregate=class_aggregate(), root=src.path("class_template")) if files
                          else Shared(lambda: class_summary(src))),
    }


def student_nightly_job(src: Source, p: StudentParams | None, sink: str, spark: SparkSession | None = None) -> DataFrame:
    """Nightly run: each large table is read once into a shared stage, every
    team table is written under ``sink``, then assembled and published; the
    open-records snapshot changes on the 5th."""
    p = p or StudentParams()

    def monthly(shared, day):
        return om_incomplete_attendance(Derived(src, shared), dataclasses.replace(p, as_of=day))

    teams = [Team(name, build_on=monthly, cadence="monthly") if name == "om_incomplete_attendance"
             else Team(name, (lambda shared, fn=fn: fn(Derived(src, shared), p))) for name, fn in TEAMS.items()]
    return KpiJob(spine=lambda shared: join_prep(Derived(src, shared), p), teams=teams, cohort=COHORT,
                  shared=shared_stages(src), after={"dashboard": dashboard_rollup}).run(p.as_of, sink, spark)
