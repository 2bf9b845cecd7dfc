"""The reference's team KPI tables on its own (CRM-shaped) tables.

``build_all(src, params)`` returns every team table lazily; ``team_kpi_table``
assembles them onto ``join_prep``; ``student_nightly_job`` writes them.
"""

from kpiloom.plans.student.params import COHORT, StudentParams  # noqa: F401
from kpiloom.plans.student.teams import TEAMS, build_all, student_nightly_job, team_kpi_table  # noqa: F401
