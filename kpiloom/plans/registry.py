"""The metric registry — ids, owners, status, naming, percent columns.

Each KPI has an id ``<AREA>_<objective>_<kpi>``, an owner, one of six
statuses, a numerator column prefixed with its program area and either its
own ``_denom`` column or a shared denominator.  The display ratio is named
after the numerator with ``_percent`` and is always Σnum/Σden at the grain
it is shown (see ``ratio_rollup``).
"""

from __future__ import annotations

import re
from collections.abc import Iterable
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from kpiloom.functions.indicators import ratio

# The status choices of the KPI tracker, in order.
STATUSES = (
    "Not Currently Possible",
    "Requires External Data",
    "Needs Clarification",
    "In Development",
    "Changes Pending",
    "In Dashboard",
)
ID_PATTERN = r"^[A-Za-z]+_[0-9]+_[0-9]+$"
PERCENT_SUFFIX = "_percent"
DENOM_SUFFIX = "_denom"


@dataclass(frozen=True)
class MetricSpec:
    id: str
    owner: str
    status: str
    area: str                       # column prefix of the program area
    numerator: str
    denominator: str | None = None  # None: a count with no ratio
    shared_denominator: bool = False
    description: str = ""
    published: bool = False         # the name is given: the naming rules do not apply
    grain: str = "cell"             # "site": the denominator stands in every cell of its site

    @property
    def percent(self) -> str:
        return self.numerator + PERCENT_SUFFIX


class MetricRegistry:
    def __init__(self, specs: Iterable[MetricSpec] = ()):
        self.specs: list[MetricSpec] = []
        for s in specs:
            self.add(s)

    def add(self, spec: MetricSpec) -> None:
        if any(s.id == spec.id for s in self.specs):
            raise ValueError(f"duplicate KPI id {spec.id}")
        self.specs.append(spec)

    def problems(self, df: DataFrame | None = None) -> list[str]:
        """Naming/status problems, and (given a table) missing columns.

        Only the schema is read: no Spark job runs.
        """
        out: list[str] = []
        cols = {c.lower() for c in df.columns} if df is not None else None
        for s in self.specs:
            if not re.match(ID_PATTERN, s.id):
                out.append(f"{s.id}: id is not <area>_<objective>_<kpi>")
            if s.status not in STATUSES:
                out.append(f"{s.id}: unknown status {s.status!r}")
            if not s.published and not s.numerator.lower().startswith(s.area.lower() + "_"):
                out.append(f"{s.id}: numerator {s.numerator} lacks area prefix {s.area}_")
            if (s.denominator and not s.shared_denominator and not s.published
                    and not s.denominator.lower().endswith(DENOM_SUFFIX)):
                out.append(f"{s.id}: own denominator {s.denominator} must end in {DENOM_SUFFIX}")
            if cols is not None:
                for c in (s.numerator, s.denominator):
                    if c and c.lower() not in cols:
                        out.append(f"{s.id}: column {c} missing from the table")
        return out

    def validate(self, df: DataFrame | None = None, strict: bool = True) -> list[str]:
        found = self.problems(df)
        if found and strict:
            raise ValueError("metric registry check failed:\n" + "\n".join(found))
        return found

    def validate_complete(self, df: DataFrame, keys: Iterable[str] = (), strict: bool = True) -> list[str]:
        """Each column of the table has one spec as a numerator, or is some
        spec's denominator or a key; and each has a source: traced through the
        analysed plan, it comes from columns (or rows) of the tables read.  Only
        the schema and the plan are read."""
        from kpiloom.plans.lineage import sources_of

        specs: dict[str, int] = {}
        for s in self.specs:
            specs[s.numerator.lower()] = specs.get(s.numerator.lower(), 0) + 1
        dens = {s.denominator.lower() for s in self.specs if s.denominator}
        skip = {k.lower() for k in keys}
        found = [f"{s.id}: column {c} missing from the table" for s in self.specs for c in (s.numerator, s.denominator)
                 if c and c.lower() not in {x.lower() for x in df.columns}]
        traced = sources_of(df)
        for c in df.columns:
            if c.lower() in skip:
                continue
            if specs.get(c.lower(), 0) > 1:
                found.append(f"{c}: {specs[c.lower()]} specs")
            if c.lower() not in specs and c.lower() not in dens:
                found.append(f"{c}: no spec")
            if not traced.get(c):
                found.append(f"{c}: no source")
        if found and strict:
            raise ValueError("metric registry check failed:\n" + "\n".join(found))
        return found

    def add_percent_columns(self, df: DataFrame, digits: int = 6) -> DataFrame:
        """``<numerator>_percent`` = numerator / denominator (NULL on 0)."""
        return df.withColumns({
            s.percent: F.round(ratio(s.numerator, s.denominator), digits)
            for s in self.specs if s.denominator and s.status == "In Dashboard"})

    def to_frame(self, spark: SparkSession) -> DataFrame:
        rows = [asdict(s) for s in self.specs]
        return spark.createDataFrame(rows, schema=(
            "id string, owner string, status string, area string, numerator string, "
            "denominator string, shared_denominator boolean, description string, published boolean, grain string"))


TWIN_REGISTRY = MetricRegistry([
    MetricSpec("IND_1_1", "commerce", "In Dashboard", "ind", "ind_high_balance",
               "ind_contact_count", shared_denominator=True,
               description="customers with balance >= 7500"),
    MetricSpec("EF_1_1", "commerce", "In Dashboard", "ef", "ef_urgent_1998",
               "ind_contact_count", shared_denominator=True,
               description="customers with an URGENT order in 1998"),
    MetricSpec("CC_1_1", "commerce", "In Dashboard", "cc", "cc_num", "cc_denom",
               description=">= 12 orders, >= 5 URGENT/HIGH"),
    MetricSpec("RET_1_1", "commerce", "In Dashboard", "ret", "ret_num", "ret_denom",
               description="1997 buyers still ordering in 1998"),
    MetricSpec("RET_1_2", "commerce", "Changes Pending", "ret", "ret_denom", None,
               description="1997 buyers (count only)"),
])
