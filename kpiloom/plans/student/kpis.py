"""K27 for the published KPIs: one spec per column of the wide table.

The tracker that numbers the KPIs is not part of the published tables, so ids
follow the order below (area, objective 1, running number).  A denominator that
several KPIs share comes from ``join_prep``; one that is an attribute of a site
(``grain``) counts once a site when ratios are rolled up.
"""

from __future__ import annotations

from kpiloom.plans.registry import MetricRegistry, MetricSpec

# Fixed values: (area, owner table, [(numerator, denominator or None)]), with the
# columns as published.
_HS, _SENIOR, _ELEVENTH, _NINTH, _PS = ("hs_student_count", "hs_senior_student_count", "hs_eleventh_student_count",
                                       "hs_ninth_grade_student_count", "active_ps_student_count")
_ANSWERED = "hs_survey_completion_count"
_GROUP = "sl_mse_reporting_group_prev_AY"
PUBLISHED = (
    ("JP", "join_prep", [
        (_HS, None), (_PS, None), (_SENIOR, None), ("hs_senior_student_count_test_opt_in", None), (_NINTH, None), (_ELEVENTH, None),
        ("hs_eleventh_student_count_test_opt_in", None), ("completed_hs_program_count", None),
        (_ANSWERED, "hs_survey_completion_denominator")]),
    ("AA", "academic_affairs", [
        ("aa_above_325_gpa", _HS), ("aa_composite_ready", "hs_senior_student_count_test_opt_in"),
        ("aa_composite_ready_eleventh_grade", "hs_eleventh_student_count_test_opt_in"),
        ("aa_offical_test_ready", "aa_tenth_grade_test_not_ready"), ("aa_above_80_aa_attendance", _HS),
        ("aa_i_am_in_control_of_my_academic_performance", _ANSWERED),
        ("aa_i_feel_prepared_to_engage_in_academic_stretch_opportunities", _ANSWERED),
        ("aa_self_perceived_growth_in_executive_functioning_skill", _ANSWERED)]),
    ("CC", "cc_hs", [
        ("cc_hs_EFC_10th_num", "cc_hs_EFC_10th_denom"), ("cc_hs_aspirations_num", "cc_hs_aspirations_denom"),
        ("cc_hs_above_80_cc_attendance", _SENIOR), ("cc_hs_accepted_affordable", _SENIOR), ("cc_hs_applied_best_good", _SENIOR),
        ("cc_hs_accepted_best_good_situational", _SENIOR), ("cc_hs_strong_college_situations", _SENIOR),
        ("cc_hs_financial_aid_submission_verification", _SENIOR), ("cc_hs_enrolled_best_good_situational", _SENIOR),
        ("cc_hs_enrolled_affordable", _SENIOR)]),
    ("CC", "cc_ps", [
        ("cc_ps_projected_grad_num", "cc_ps_projected_grad_denom"), ("cc_ps_2_yr_transfer_num", "cc_ps_2_yr_transfer_denom"),
        ("cc_ps_grad_internship_num", "cc_ps_grad_internship_denom"), ("cc_ps_gpa_2_5_num", _PS), ("cc_ps_loans_30k", _PS),
        ("cc_ps_fasfa_complete", _PS), ("cc_ps_well_balanced_lifestyle", _PS), ("cc_ps_tech_interpersonal_skills", _PS),
        ("cc_ps_persist_num", "cc_persist_denom"), ("cc_ps_meaningful_num", "cc_ps_meaningful_gainful_denom"),
        ("cc_ps_gainful_num", "cc_ps_meaningful_gainful_denom"),
        ("cc_ps_employed_grad_6_months_num", "cc_ps_employed_grad_6_months_denom")]),
    ("FP", "fp", [
        ("ps_survey_scholarship_num", "ps_survey_scholarship_denom"), ("fp_efund_num", _PS), ("fp_12_efc_num", _SENIOR),
        ("fp_enrolled_best_fit_numerator", "fp_accepted_best_fit_denom")]),
    ("OM", "om", [("OM_agree_site_is_run_effectively", _ANSWERED)]),
    ("OM", "om_incomplete_attendance", [("OM_incomplete_wsa_records", None)]),
    ("PRO", "program_ops", [
        ("pro_ops_incoming_cohort_first_gen", _NINTH), ("pro_ops_incoming_cohort_low_income", _NINTH),
        ("nps_promoter", _ANSWERED), ("nps_detractor", _ANSWERED)]),
    ("RED", "red", [
        ("retention_num", "retention_denom"), ("red_gpa_3_25_test_ready", "hs_senior_student_count_test_opt_in"),
        ("red_gpa_3_25__test_ready_eleventh", _ELEVENTH)]),
    ("SD", "site_directors", [
        ("SD_hs_capacity_numerator", "hs_cohort_capacity"), ("SD_senior_above_325", _SENIOR), ("SD_above_325_gpa_eleventh_grade", _ELEVENTH),
        ("SD_ninth_grade_male", _NINTH), ("SD_ninth_grade_first_gen_low_income", _NINTH), ("SD_above_80_attendance", _HS),
        ("SD_summer_experience", _HS), ("SD_on_track", "SD_on_track_student_count"), ("SD_covi_student_grew", "SD_covi_denominator")]),
    ("SL", "student_life", [
        ("sl_dreams_declared", _HS), ("sl_above_80_attendance", _HS), ("sl_mse_completed_prev_AY", _GROUP),
        ("sl_mse_competitive_prev_AY", _GROUP), ("sl_mse_internship_prev_AY", _GROUP), ("sl_agree_they_have_hobby", _ANSWERED),
        ("SL_covi_belief_student_grew", "SL_covi_belief_denominator")]),
    ("WELLNESS", "wellness", [
        ("wellness_covi_assessment_completed_ay", _HS),
        ("wellness_survey_wellness_services_assisted_num", "wellness_survey_wellness_services_assisted_denom"),
        ("wellness_avg_support", None), ("sum_attended_wellness_sessions", None), ("case_note_count", None),
        ("sum_of_blue_red_covi_for_avg", None)]),
)
# Published names that do not begin with their area, or denominators that do not end as the rule asks.
AS_PUBLISHED = {"ps_survey_scholarship_num", "nps_promoter", "nps_detractor", "retention_num", "sum_attended_wellness_sessions",
                "case_note_count", "sum_of_blue_red_covi_for_avg", "aa_offical_test_ready", "SD_on_track", "SD_covi_student_grew",
                "SL_covi_belief_student_grew"}
SITE_GRAIN = {"hs_cohort_capacity"}
#: Columns of the wide table that place a cell and are no KPI.
PLACES = ("national", "site_sort", "region_abrev")


def _registry() -> MetricRegistry:
    shared = {n for n, _ in PUBLISHED[0][2]}
    out, numbers = MetricRegistry(), {}
    for area, owner, pairs in PUBLISHED:
        for numerator, denominator in pairs:
            numbers[area] = numbers.get(area, 0) + 1
            out.add(MetricSpec(
                f"{area}_1_{numbers[area]}", owner, "In Dashboard", area, numerator, denominator,
                shared_denominator=denominator in shared or denominator in SITE_GRAIN or denominator == _GROUP,
                published=area == "JP" or numerator in AS_PUBLISHED, grain="site" if denominator in SITE_GRAIN else "cell"))
    return out


KPIS = _registry()
