"""Column-level building blocks: indicators, guarded ratios, named segments."""

from kpiloom.functions.indicators import (  # noqa: F401
    flag, flag_or_null, weighted, three_state, ratio, ratio_at_most,
    like_any, like_none,
)
from kpiloom.functions.segments import SegmentRegistry, segment  # noqa: F401
