"""Composite cohort-metric operators (DataFrame -> DataFrame, all lazy)."""

from kpiloom.operators.cohort import (  # noqa: F401
    CohortSpec, assemble, assert_unique, attribute_carry, cohort_agg, indicator_cohort_sum,
    ratio_rollup, spine, sum_long,
)
from kpiloom.operators.links import (  # noqa: F401
    activity_flags_any, child_count_threshold, child_counts, existence_flags, members,
    restrict_to_members,
)
from kpiloom.operators.periods import (  # noqa: F401
    as_of_switch, distinct_population, exact_period_presence, open_before,
    period_presence_entities, persistence, persistence_entities, retention, retention_rows,
    score_growth,
)
from kpiloom.operators.rates import (  # noqa: F401
    average_support, count_cube, entity_rate, period_weights, rate_flag, shared_denominators,
    split_population, three_state_rate,
)
from kpiloom.operators.surveys import (  # noqa: F401
    distinct_entity_count, likert_agree, nps_flags, nps_score, survey_completion,
)
