"""Text and time parsing as column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The provider's local zone and its Buddhist-era offset.
LOCAL_TZ = "Asia/Bangkok"
BUDDHIST_OFFSET = 543

# Accepted date layouts of the forecast job and of the backfill job.
JOB_DATE_FORMATS = ("yyyy-M-d", "d/M/yyyy", "d-M-yyyy", "yyyy-M-d H:m:s")
BACKFILL_DATE_FORMATS = (
    "yyyy-M-d",
    "d/M/yyyy",
    "d-M-yyyy",
    "dMMMyyyy",
    "d MMM yyyy",
    "dMMMMyyyy",
    "d MMMM yyyy",
)


def to_utc(local: Column, tz: str = LOCAL_TZ) -> Column:
    """Local wall time (NTZ) to UTC wall time (NTZ)."""
    return F.convert_timezone(F.lit(tz), F.lit("UTC"), local)


def to_local(utc: Column, tz: str = LOCAL_TZ) -> Column:
    """UTC wall time (NTZ) to local wall time (NTZ)."""
    return F.convert_timezone(F.lit("UTC"), F.lit(tz), utc)


def parse_buddhist_ts(text: Column, tz: str = LOCAL_TZ) -> Column:
    """`dd/mm/yyyy hh:mm` with a Buddhist-era year and local time, as UTC (NTZ).

    The year is shifted as a number first: 29 February exists in the Gregorian year only.
    """
    parts = F.split(F.trim(text), "[/ :]")
    number = [F.get(parts, i).try_cast("int") for i in range(5)]
    local = F.try_make_timestamp_ntz(
        number[2] - BUDDHIST_OFFSET, number[1], number[0], number[3], number[4], F.lit(0)
    )
    return to_utc(local, tz)


def format_local(utc: Column, tz: str = LOCAL_TZ) -> Column:
    """UTC instant (NTZ) to local `dd/mm/yyyy HH:MM` text."""
    return F.date_format(to_local(utc, tz), "dd/MM/yyyy HH:mm")


def coerce_float(text: Column) -> Column:
    """Lenient number: blanks around it and commas are ignored, anything else is null.

    The provider's blank markers fail the cast or give NaN, so they need no list. A type suffix
    such as `1d`, which the cast would accept, is not a number here.
    """
    cleaned = F.replace(F.trim(text.cast("string")), F.lit(","), F.lit(""))
    number = F.when(~cleaned.rlike("[0-9.][dDfF]$"), cleaned.try_cast("double"))
    return F.nanvl(number, F.lit(None).cast("double"))


def parse_date_multi(
    text: Column, formats: Sequence[str] = JOB_DATE_FORMATS, iso: bool = True
) -> Column:
    """First layout that parses wins; with `iso`, ISO date-times (also with Z) are accepted last.

    Unparsable text gives null, so callers count bad rows instead of failing the job.
    """
    cleaned = F.trim(text)
    tries = [F.try_to_date(cleaned, layout) for layout in formats]
    if iso:
        tries.append(F.regexp_extract(cleaned, ISO_DATETIME, 1).try_cast("date"))
    return F.coalesce(*tries)


# Fixed pattern: an ISO date-time; the date part keeps its own offset, as written.
ISO_DATETIME = r"^(\d{4}-\d{2}-\d{2})[T ]\d{2}:\d{2}(?::\d{2}(?:\.\d+)?)?(?:Z|[+-]\d{2}:\d{2})?$"


def local_date(utc: Column, tz: str = LOCAL_TZ) -> Column:
    return to_local(utc, tz).cast("date")


def day_bounds(first: Column, last: Column, tz: str = LOCAL_TZ) -> tuple[Column, Column]:
    """UTC half-open bounds [first 00:00, last + 1 day 00:00) of local dates."""
    midnight = lambda day: to_utc(day.cast("timestamp_ntz"), tz)
    return midnight(first), midnight(F.date_add(last, 1))
