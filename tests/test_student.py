"""Golden tests of the team KPI tables on the reference-shaped fixture.

Expected values are derived by hand from the fixture rows (comments say
why); they pin the reference's semantics including its quirks.
"""

import dataclasses
import tempfile

import pytest

from kpiloom.plans.student import StudentParams, build_all, student_nightly_job, team_kpi_table
from kpiloom.plans.student.teams import wellness
from tests import student_fixture as fx

W8 = ("Ward 8", "Black", "Male")
W8_NULL = ("Ward 8", "Black", None)
CREN = ("Crenshaw", "Latinx", "Female")
OAK = ("Oakland", "Asian", "Male")
NOSITE = (None, "Asian", "Female")
KEY = ("site_short", "Ethnic_background_c", "Gender_c")

# every KPI column the reference publishes, per table
COLUMNS = {
    "join_prep": {"national", "site_sort", "region_abrev", "active_ps_student_count", "hs_student_count",
                  "hs_senior_student_count", "hs_senior_student_count_test_opt_in",
                  "hs_ninth_grade_student_count", "hs_eleventh_student_count",
                  "hs_eleventh_student_count_test_opt_in", "completed_hs_program_count",
                  "hs_survey_completion_denominator", "hs_survey_completion_count"},
    "academic_affairs": {"aa_above_325_gpa", "aa_composite_ready", "aa_composite_ready_eleventh_grade",
                         "aa_tenth_grade_test_not_ready", "aa_offical_test_ready", "aa_above_80_aa_attendance",
                         "aa_i_am_in_control_of_my_academic_performance",
                         "aa_i_feel_prepared_to_engage_in_academic_stretch_opportunities",
                         "aa_self_perceived_growth_in_executive_functioning_skill"},
    "cc_hs": {"cc_hs_EFC_10th_num", "cc_hs_EFC_10th_denom", "cc_hs_aspirations_num", "cc_hs_aspirations_denom",
              "cc_hs_above_80_cc_attendance", "cc_hs_accepted_affordable", "cc_hs_applied_best_good",
              "cc_hs_accepted_best_good_situational", "cc_hs_strong_college_situations",
              "cc_hs_financial_aid_submission_verification", "cc_hs_enrolled_best_good_situational",
              "cc_hs_enrolled_affordable"},
    "cc_ps": {"cc_ps_projected_grad_num", "cc_ps_projected_grad_denom", "cc_ps_2_yr_transfer_num",
              "cc_ps_2_yr_transfer_denom", "cc_ps_grad_internship_num", "cc_ps_grad_internship_denom",
              "cc_ps_gpa_2_5_num", "cc_ps_loans_30k", "cc_ps_fasfa_complete", "cc_ps_well_balanced_lifestyle",
              "cc_ps_tech_interpersonal_skills", "cc_ps_persist_num", "cc_persist_denom", "cc_ps_meaningful_num",
              "cc_ps_gainful_num", "cc_ps_meaningful_gainful_denom", "cc_ps_employed_grad_6_months_num",
              "cc_ps_employed_grad_6_months_denom"},
    "fp": {"fp_12_efc_num", "ps_survey_scholarship_denom", "ps_survey_scholarship_num", "fp_efund_num",
           "fp_accepted_best_fit_denom", "fp_enrolled_best_fit_numerator"},
    "om": {"OM_agree_site_is_run_effectively"},
    "om_incomplete_attendance": {"OM_incomplete_wsa_records"},
    "program_ops": {"pro_ops_incoming_cohort_first_gen", "pro_ops_incoming_cohort_low_income",
                    "nps_promoter", "nps_detractor"},
    "red": {"retention_denom", "retention_num", "red_gpa_3_25_test_ready", "red_gpa_3_25__test_ready_eleventh"},
    "site_directors": {"SD_hs_capacity_numerator", "hs_cohort_capacity", "SD_senior_above_325",
                       "SD_above_325_gpa_eleventh_grade", "SD_ninth_grade_male",
                       "SD_ninth_grade_first_gen_low_income", "SD_summer_experience", "SD_above_80_attendance",
                       "SD_on_track", "SD_on_track_student_count", "SD_covi_student_grew", "SD_covi_denominator"},
    "student_life": {"sl_dreams_declared", "sl_above_80_attendance", "sl_mse_completed_prev_AY",
                     "sl_mse_competitive_prev_AY", "sl_mse_internship_prev_AY", "sl_mse_reporting_group_prev_AY",
                     "sl_agree_they_have_hobby", "SL_covi_belief_student_grew", "SL_covi_belief_denominator"},
    "wellness": {"wellness_covi_assessment_completed_ay", "wellness_avg_support", "sum_attended_wellness_sessions",
                 "case_note_count", "sum_of_blue_red_covi_for_avg",
                 "wellness_survey_wellness_services_assisted_denom",
                 "wellness_survey_wellness_services_assisted_num"},
}


@pytest.fixture(scope="module")
def tables(spark):
    data = fx.build(spark)
    return data


@pytest.fixture(scope="module")
def out(tables):
    built = build_all(lambda n: tables[n], StudentParams())
    return {name: {tuple(r[k] for k in KEY): r.asDict() for r in df.collect()} for name, df in built.items()}


def test_columns_are_the_published_kpis(tables):
    built = build_all(lambda n: tables[n], StudentParams())
    for name, df in built.items():
        assert set(df.columns) - set(KEY) == COLUMNS[name], name


def test_join_prep(out):
    jp = out["join_prep"]
    assert jp[W8]["hs_senior_student_count"] == 2                # 12th grader + Year 1 with 0 years
    assert jp[W8]["hs_senior_student_count_test_opt_in"] == 2
    assert jp[W8]["hs_eleventh_student_count"] == 1
    assert jp[W8]["hs_eleventh_student_count_test_opt_in"] is None  # IF(p, n, NULL): only 11th withdrew
    assert jp[W8]["hs_survey_completion_denominator"] == 3
    assert jp[CREN]["active_ps_student_count"] == 1
    assert jp[OAK]["completed_hs_program_count"] == 2
    assert ("The Durant Center", "Black", "Male") not in jp     # '18a' is not a spine status
    assert jp[NOSITE]["hs_survey_completion_denominator"] is None


def test_academic_affairs(out):
    aa = out["academic_affairs"]
    assert aa[W8]["aa_above_325_gpa"] == 3                       # duplicate survey row fans out c2
    assert aa[W8]["aa_composite_ready"] == 1
    assert aa[W8]["aa_composite_ready_eleventh_grade"] == 0      # the ready 11th grader withdrew
    assert aa[W8]["aa_tenth_grade_test_not_ready"] == 1
    assert aa[W8]["aa_above_80_aa_attendance"] == 0              # 1/4 and 1/3: below 0.8
    assert aa[W8]["aa_i_am_in_control_of_my_academic_performance"] == 2
    assert aa[W8]["aa_self_perceived_growth_in_executive_functioning_skill"] == 1
    assert aa[CREN]["aa_above_80_aa_attendance"] is None         # nobody with sessions
    assert aa[NOSITE]["aa_above_325_gpa"] == 1


def test_cc_hs(out):
    cc = out["cc_hs"]
    assert (cc[CREN]["cc_hs_EFC_10th_num"], cc[CREN]["cc_hs_EFC_10th_denom"]) == (1, 1)
    assert (cc[W8]["cc_hs_aspirations_num"], cc[W8]["cc_hs_aspirations_denom"]) == (1, 1)  # 7 any, 5 affordable
    assert cc[W8]["cc_hs_above_80_cc_attendance"] == 1           # only the Senior Seminar session counts
    assert cc[W8]["cc_hs_accepted_affordable"] == 2              # enrolled lookup OR applied lookup
    assert cc[W8]["cc_hs_financial_aid_submission_verification"] == 1  # 'Pending' verification is not enough
    assert cc[W8]["cc_hs_strong_college_situations"] == 1
    assert cc[NOSITE]["cc_hs_applied_best_good"] is None         # NULL site never joins the spine
    assert len(cc) == 6                                          # one row per spine cell


def test_cc_ps(out):
    ps = out["cc_ps"]
    c = ps[CREN]
    assert (c["cc_ps_projected_grad_num"], c["cc_ps_grad_internship_num"], c["cc_ps_gpa_2_5_num"]) == (1, 1, 1)
    assert (c["cc_ps_fasfa_complete"], c["cc_ps_loans_30k"], c["cc_ps_tech_interpersonal_skills"]) == (1, 1, 1)
    assert (c["cc_ps_persist_num"], c["cc_persist_denom"]) == (0, 1)   # one later term does not qualify
    assert (c["cc_ps_gainful_num"], c["cc_ps_meaningful_gainful_denom"]) == (0, 1)  # zero income divisor
    o = ps[OAK]
    assert (o["cc_ps_2_yr_transfer_num"], o["cc_ps_2_yr_transfer_denom"]) == (1, 1)
    assert (o["cc_ps_grad_internship_num"], o["cc_ps_grad_internship_denom"]) == (0, 1)
    assert (o["cc_ps_meaningful_num"], o["cc_ps_gainful_num"], o["cc_ps_employed_grad_6_months_num"]) == (1, 1, 1)
    assert o["cc_ps_meaningful_gainful_denom"] == 1              # the excluded site's answer is dropped


def test_fp_excludes_sites(out):
    assert set(out["fp"]) == {OAK}
    assert out["fp"][OAK]["ps_survey_scholarship_denom"] == 1
    assert out["fp"][OAK]["fp_efund_num"] == 0


def test_om_program_ops_red(out):
    assert out["om"][W8]["OM_agree_site_is_run_effectively"] == 2
    assert out["om"][W8_NULL]["OM_agree_site_is_run_effectively"] == 1
    assert NOSITE not in out["om"]
    assert out["om_incomplete_attendance"] == {W8: {"site_short": "Ward 8", "Ethnic_background_c": "Black",
                                                    "Gender_c": "Male", "OM_incomplete_wsa_records": 2}}
    po = out["program_ops"]
    assert (po[W8]["nps_promoter"], po[W8]["nps_detractor"]) == (1, 1)   # NULL answer is neither
    assert (po[W8_NULL]["pro_ops_incoming_cohort_first_gen"], po[CREN]["nps_detractor"]) == (1, 0)
    r = out["red"]
    assert (r[W8]["retention_denom"], r[W8]["retention_num"], r[W8]["red_gpa_3_25_test_ready"]) == (1, 1, 1)
    assert set(r) == {W8, CREN}                                  # NULL dosage fails NOT LIKE


def test_site_directors(out):
    sd = out["site_directors"]
    assert sd[W8]["SD_hs_capacity_numerator"] == 3 and sd[W8]["hs_cohort_capacity"] == 120
    assert sd[W8]["SD_above_80_attendance"] == 1                 # 17/20; 0/0 -> NULL; no terms -> 0
    assert (sd[W8]["SD_covi_student_grew"], sd[W8]["SD_covi_denominator"]) == (1, 1)
    assert sd[W8_NULL]["SD_ninth_grade_first_gen_low_income"] == 1
    assert (sd[CREN]["SD_on_track"], sd[CREN]["SD_on_track_student_count"]) == (1, 1)
    assert OAK not in sd                                         # PS-only cell is not on the HS spine
    assert sd[("The Durant Center", "Black", "Male")]["hs_cohort_capacity"] == 50


def test_student_life(out):
    sl = out["student_life"][W8]
    assert (sl["sl_dreams_declared"], sl["sl_above_80_attendance"]) == (1, 1)
    assert (sl["sl_mse_completed_prev_AY"], sl["sl_mse_competitive_prev_AY"], sl["sl_mse_internship_prev_AY"]) == (1, 1, 1)
    assert sl["sl_mse_reporting_group_prev_AY"] == 1
    assert (sl["SL_covi_belief_student_grew"], sl["SL_covi_belief_denominator"]) == (3, 3)


def test_wellness(out):
    w = out["wellness"]
    assert set(w) == {W8, CREN}                                  # spine = cells with an assessed student
    assert w[W8]["wellness_covi_assessment_completed_ay"] == 2
    assert w[W8]["sum_of_blue_red_covi_for_avg"] == 3            # Blue and Red rows count twice
    assert w[W8]["case_note_count"] == 2                         # distinct note ids
    assert w[W8]["sum_attended_wellness_sessions"] == 2.0        # NSO and NULL dosage excluded
    assert w[W8]["wellness_avg_support"] == pytest.approx(4 / 3)  # (1·2 + 2) / 3, site-only join
    assert (w[W8]["wellness_survey_wellness_services_assisted_denom"],
            w[W8]["wellness_survey_wellness_services_assisted_num"]) == (2, 1)
    assert w[CREN]["wellness_avg_support"] == pytest.approx(4.0)


def test_wellness_cohort_grain(tables):
    p = dataclasses.replace(StudentParams(), support_grain="cohort")
    w = {tuple(r[k] for k in KEY): r for r in wellness(lambda n: tables[n], p).collect()}
    assert w[W8]["wellness_avg_support"] == pytest.approx(4 / 3)   # same here: one notes cell per site


def test_as_of_after_cutoff_uses_previous_term(tables):
    p = dataclasses.replace(StudentParams(), as_of=fx.D(2021, 7, 2))
    after = {tuple(r[k] for k in KEY): r for r in build_all(lambda n: tables[n], p)["cc_ps"].collect()}
    assert after[CREN]["cc_ps_fasfa_complete"] == 0              # previous (fall) term rubric
    assert after[CREN]["cc_ps_projected_grad_num"] == 2          # two fall rows fan out the contact
    on_day = dataclasses.replace(StudentParams(), as_of=fx.D(2021, 7, 1))
    cc = {tuple(r[k] for k in KEY): r for r in build_all(lambda n: tables[n], on_day)["cc_ps"].collect()}
    assert cc[CREN]["cc_ps_fasfa_complete"] is None              # cut-off day: neither term


def test_team_kpi_table_and_nightly_job(spark, tables):
    src = lambda n: tables[n]
    wide = team_kpi_table(src)
    jp = build_all(src)["join_prep"]
    assert wide.count() == jp.count()
    expected = set().union(*COLUMNS.values()) | set(KEY)
    assert set(wide.columns) == expected
    sink = tempfile.mkdtemp(prefix="kpiloom-student-", dir="/tmp")
    written = student_nightly_job(src, StudentParams(), sink=sink)
    assert sorted(map(str, written.collect())) == sorted(map(str, wide.select(*written.columns).collect()))
    import os
    from kpiloom.sources.published import Published
    published = Published(spark, sink)
    shared = published.folder(published.manifest()["run"])
    for name in ("class_summary", "contact_template", "contact_at_template"):       # one pass over each
        assert os.path.isdir(os.path.join(shared, f"_shared_{name}"))


def test_dashboard_rollup_sums_before_dividing(tables):
    from kpiloom.plans.student.dashboard import dashboard_rollup
    wide = team_kpi_table(lambda n: tables[n])
    out = {(r["level"], r["region_abrev"], r["site_short"]): r for r in dashboard_rollup(wide).collect()}
    nat = out[("National", None, None)]
    assert (nat["hs_survey_completion_num"], nat["hs_survey_completion_den"]) == (3, 5)
    assert nat["hs_survey_completion_ratio"] == pytest.approx(0.6)       # 3/5, not mean(2/3, 1/2)
    assert out[("site", "DC", "Ward 8")]["hs_survey_completion_ratio"] == pytest.approx(2 / 3)
    assert out[("region", "LA", None)]["cc_hs_EFC_10th_ratio"] == pytest.approx(1.0)


def test_nightly_cli_on_parquet_warehouse(spark, tables):
    from kpiloom.plans.student.run import main
    root = tempfile.mkdtemp(prefix="kpiloom-wh-", dir="/tmp")
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{root}/{name}")
    sink = main(["--root", root, "--sink", f"{root}/_out", "--as-of", "2021-03-05"], spark=spark)
    from kpiloom.sources.published import Published
    wide = Published(spark, sink).table("team_kpi_table")
    assert wide.count() == 5
    row = {tuple(r[k] for k in KEY): r for r in wide.collect()}[W8]
    assert row["aa_composite_ready"] == 1 and row["wellness_avg_support"] == pytest.approx(4 / 3)


def test_session_consumers_read_the_materialised_summary(spark, tables):
    from kpiloom.plans.student.teams import (Derived, academic_affairs, cc_hs, class_summary,
                                             om_incomplete_attendance, red, student_life)
    from kpiloom.plans.student.teams import wellness as wellness_team
    from kpiloom.sources.catalog import ParquetCatalog
    root = tempfile.mkdtemp(prefix="kpiloom-wh2-", dir="/tmp")
    for name, df in tables.items():
        df.write.mode("overwrite").parquet(f"{root}/{name}")
    src = ParquetCatalog(spark, root, suffix="")
    class_summary(src).write.mode("overwrite").parquet(f"{root}/_summary")
    shared = Derived(src, {"class_summary": spark.read.parquet(f"{root}/_summary")})
    p = StudentParams()
    for build in (academic_affairs, cc_hs, student_life, red, wellness_team, om_incomplete_attendance):
        text = build(shared, p)._jdf.queryExecution().executedPlan().toString()
        assert "class_template" not in text and "_summary" in text, build.__name__
