"""Value rules: clips, bands, labels, rounding and request checks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Air-quality bands and the two threshold ladders (upper bounds, inclusive).
BANDS = ("Good", "Moderate", "Unhealthy (Sensitive)", "Unhealthy", "Very Unhealthy")
STRICT_LADDER = (15.0, 25.0, 37.5, 75.0)
LOCAL_LADDER = (25.0, 37.0, 50.0, 90.0)

# Pollution regimes, stability labels and request limits.
REGIME_BOUNDS = (35.0, 75.0)
PSI_BOUNDS = (0.1, 0.2)
MIN_HISTORY_ROWS = 15
VALUE_RANGE = (0.0, 500.0)


def clip(value: Column, low: float, high: float) -> Column:
    """Null stays null; `least` and `greatest` alone would replace it."""
    return F.when(value.isNotNull(), F.least(F.greatest(value, F.lit(low)), F.lit(high)))


def ladder(value: Column, bounds: Sequence[float], names: Sequence[str], inclusive: bool) -> Column:
    """Name of the first bound the value does not pass; the last name beyond all bounds."""
    result = F.when(value.isNull(), F.lit(None).cast("string"))
    for bound, name in zip(bounds, names):
        result = result.when(value <= bound if inclusive else value < bound, name)
    return result.otherwise(names[-1])


def aq_band(value: Column, bounds: Sequence[float] = STRICT_LADDER) -> Column:
    return ladder(value, bounds, BANDS, inclusive=True)


def regime(value: Column) -> Column:
    low, high = REGIME_BOUNDS
    return F.when(value < low, "low").when(value <= high, "moderate").when(value > high, "high")


def psi_status(psi: Column) -> Column:
    return ladder(psi, PSI_BOUNDS, ("stable", "moderate", "significant"), inclusive=False)


def round_half_up(value: Column, places: int) -> Column:
    """Exact-decimal rounding, half away from zero, as a SQL `numeric` column rounds."""
    return F.round(value.cast("decimal(38,12)"), places).cast("double")


def valid_history(history: Column, min_rows: int = MIN_HISTORY_ROWS) -> Column:
    """Request check: enough readings and every value inside the accepted range."""
    low, high = VALUE_RANGE
    in_range = F.forall(history, lambda r: r["pm25"].isNotNull() & r["pm25"].between(low, high))
    return (F.size(history) >= min_rows) & in_range
