"""Named, composable population predicates.

The reference writes the same definitions ("senior", "opted in to test
prep", "active status") out by hand in many files.  Here each is defined
once and looked up by name; segments compose with ``&``/``|``/``~`` because
they are plain Columns.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F


class SegmentRegistry:
    def __init__(self) -> None:
        self._defs: dict[str, Callable[[], Column]] = {}

    def register(self, name: str, builder: Callable[[], Column]) -> None:
        if name in self._defs:
            raise ValueError(f"segment {name!r} already defined")
        self._defs[name] = builder

    def __call__(self, name: str) -> Column:
        try:
            return self._defs[name]()
        except KeyError:
            raise KeyError(f"unknown segment {name!r}; known: {sorted(self._defs)}") from None

    def all_of(self, *names: str) -> Column:
        out = F.lit(True)
        for n in names:
            out = out & self(n)
        return out

    def any_of(self, *names: str) -> Column:
        out = F.lit(False)
        for n in names:
            out = out | self(n)
        return out

    def names(self) -> list[str]:
        return sorted(self._defs)


# The reference's status codes, grades and record types.
ACTIVE_HS_STATUS = "11A"
ACTIVE_PS_STATUS = "15A"
SPINE_STATUSES = ("11A", "15A", "16A", "17A")
HS_RECORD_TYPE = "Student: High School"
PS_RECORD_TYPE = "Student: Post-Secondary"

segment = SegmentRegistry()

# senior: 12th grade, or first post-secondary year right after graduating.
segment.register("senior", lambda: (F.col("grade_c") == "12th Grade") | (
    (F.col("grade_c") == "Year 1") & (F.col("indicator_years_since_hs_graduation_c") == 0)))
segment.register("eleventh_grade", lambda: F.col("grade_c") == "11th Grade")
segment.register("tenth_grade", lambda: F.col("grade_c") == "10th Grade")
segment.register("ninth_grade", lambda: F.col("grade_c") == "9th Grade")
# opted in to test prep = no withdrawal on record (NULL means opted in).
segment.register("test_opt_in", lambda: F.col("contact_official_test_prep_withdrawal").isNull())
segment.register("active_hs", lambda: F.col("college_track_status_c") == ACTIVE_HS_STATUS)
segment.register("active_ps", lambda: F.col("college_track_status_c") == ACTIVE_PS_STATUS)
segment.register("spine_status", lambda: F.col("college_track_status_c").isin(*SPINE_STATUSES))
segment.register("hs_record", lambda: F.col("Contact_Record_Type_Name") == HS_RECORD_TYPE)
segment.register("ps_record", lambda: F.col("Contact_Record_Type_Name") == PS_RECORD_TYPE)
