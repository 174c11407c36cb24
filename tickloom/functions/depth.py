"""Number of book levels from which level columns or keys there are. Level 0 has no suffix, level k has suffix _k."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

MAX_DEPTH = 25
#: The depths that records may have, how far presence is probed, and how far for diagnostics.
DEPTHS, PROBE, PROBE_HIGHEST = (1, 5, 10, 15, 20, 25), 52, 128


def book_depth(present: Callable[[int], bool]) -> int | None:
    """Levels 1..d-1 present without gap, none above up to PROBE, and d supported; else None."""
    d = next((k for k in range(1, PROBE + 1) if not present(k)), PROBE + 1)
    return d if d in DEPTHS and not any(present(k) for k in range(d + 1, PROBE + 1)) else None


def highest_level(present: Callable[[int], bool]) -> int:
    return max((k for k in range(1, PROBE_HIGHEST + 1) if present(k)), default=0)


def book_depth_column(levels: Column) -> Column:
    """book_depth over an array of the present level numbers (any order, repeats allowed)."""
    seen = F.array_distinct(F.filter(levels, lambda k: k.between(1, PROBE)))
    d = F.size(seen) + 1
    gapless = F.coalesce(F.array_max(seen), F.lit(0)) == F.size(seen)
    return F.when(gapless & d.isin(*DEPTHS), d)


def highest_level_column(levels: Column) -> Column:
    return F.coalesce(F.array_max(F.filter(levels, lambda k: k.between(1, PROBE_HIGHEST))), F.lit(0))
