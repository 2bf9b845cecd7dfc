"""Display ratios of the team KPI table: Σnum/Σden at site, region and
national level (the dashboard's calculated fields, K21)."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from kpiloom.operators.cohort import ratio_rollup, sum_long
from kpiloom.plans.student.kpis import KPIS, SITE_GRAIN

# Names of ratios that differ from their numerator's.
_NAMES = {
    "cc_hs_EFC_10th_num": "cc_hs_EFC_10th", "cc_hs_aspirations_num": "cc_hs_aspirations", "cc_ps_projected_grad_num": "cc_ps_projected_grad",
    "cc_ps_2_yr_transfer_num": "cc_ps_2_yr_transfer", "cc_ps_grad_internship_num": "cc_ps_grad_internship",
    "cc_ps_persist_num": "cc_ps_persist", "cc_ps_meaningful_num": "cc_ps_meaningful", "cc_ps_gainful_num": "cc_ps_gainful",
    "cc_ps_employed_grad_6_months_num": "cc_ps_employed_grad_6_months", "ps_survey_scholarship_num": "ps_survey_scholarship",
    "fp_enrolled_best_fit_numerator": "fp_enrolled_best_fit", "retention_num": "retention", "SD_covi_student_grew": "SD_covi",
    "SL_covi_belief_student_grew": "SL_covi_belief", "hs_survey_completion_count": "hs_survey_completion",
    "wellness_survey_wellness_services_assisted_num": "wellness_services_assisted",
}
#: Every published ratio, with its own or the shared denominator of its spec.
RATIOS = {_NAMES.get(s.numerator, s.numerator): (s.numerator, s.denominator) for s in KPIS.specs if s.denominator}


def dashboard_rollup(wide: DataFrame, ratios: Mapping[str, tuple[str, str]] = RATIOS) -> DataFrame:
    """One row per national / region / site with ``<kpi>_num``, ``<kpi>_den``
    and ``<kpi>_ratio``, and the sites' ``site_sort``.

    Cells are summed to sites first; a denominator that is an attribute of the
    site stands in each of its cells and is taken once.  The roll-up then reads
    one row per site."""
    columns = sorted({c for pair in ratios.values() for c in pair})
    sites = wide.groupBy("region_abrev", "site_short", "site_sort").agg(
        *[F.max(c).alias(c) if c in SITE_GRAIN else sum_long(c).alias(c) for c in columns])
    levels = ["region_abrev", "site_short"]
    out = ratio_rollup(sites, ratios, levels=levels, level_names=["region", "site"], carry={"site_sort": "site_short"})
    return out
