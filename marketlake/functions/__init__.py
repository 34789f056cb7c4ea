"""Column-level building blocks (all JVM-side expressions, no UDFs)."""

from marketlake.functions.stats import (  # noqa: F401
    pairwise, safe_corr, safe_slope, round_doubles,
)
from marketlake.functions.timecols import (  # noqa: F401
    EASTERN, ceil_to, elapsed_hours, elapsed_minutes, floor_to,
    second_boundaries, to_eastern, to_utc,
)
