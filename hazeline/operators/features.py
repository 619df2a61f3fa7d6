"""Lag, rolling, change and calendar features.

Column builders take a window and return named columns, so one feature plan evaluates all of them
over a single sort. The feature names and orders are fixed by the models that read them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from hazeline.operators.validate import drop_incomplete
from hazeline.plans.series import KEYS, over_chunks, positioned
from hazeline.session import stage_table

# Lags and window lengths of the daily and hourly models, and the forecast horizon.
DAILY_LAGS = (1, 2, 3, 5, 7)
DAILY_WINDOWS = (3, 7, 14)
HOURLY_LAGS = (1, 2, 3, 6, 12, 24)
HOURLY_WINDOWS = (6, 12, 24)
HORIZON_HOURS = 24
CORRELATION_LAGS = (1, 2, 3, 5, 7, 14)

# Column orders the models expect.
DAILY_FEATURES = (
    *[f"pm25_lag_{n}" for n in DAILY_LAGS],
    *[f"pm25_rolling_{stat}_{n}" for n in DAILY_WINDOWS for stat in ("mean", "std")],
    *["day_of_week", "month", "day_of_year", "is_weekend"],
    *["pm25_diff_1", "pm25_pct_change_1"],
)
HOURLY_FEATURES = (
    *[f"pm25_lag_{n}" for n in HOURLY_LAGS],
    *[f"pm25_rolling_{stat}_{n}h" for n in HOURLY_WINDOWS for stat in ("mean", "std")],
    *["pm25_diff_1h", "pm25_diff_24h"],
    *["hour", "day_of_week", "month", "day_of_year", "is_weekend"],
)
HOURLY_TARGET = "pm25_h24"


def lag_columns(w: WindowSpec, lags: Sequence[int], value: str = "pm25") -> dict[str, Column]:
    return {f"{value}_lag_{n}": F.lag(value, n).over(w) for n in lags}


def rolling_columns(
    w: WindowSpec,
    windows: Sequence[int],
    value: str = "pm25",
    min_rows: int | None = None,
    suffix: str = "",
    include_current: bool = False,
) -> dict[str, Column]:
    """Mean and sample std of the previous n rows (or the last n with the current row).

    Null below `min_rows` values; `None` asks for a full window.
    """
    columns = {}
    for n in windows:
        frame = w.rowsBetween(1 - n, 0) if include_current else w.rowsBetween(-n, -1)
        enough = F.count(value).over(frame) >= (n if min_rows is None else min_rows)
        columns[f"{value}_rolling_mean_{n}{suffix}"] = F.when(enough, F.avg(value).over(frame))
        columns[f"{value}_rolling_std_{n}{suffix}"] = F.when(
            enough, F.stddev_samp(value).over(frame)
        )
    return columns


def lagged_diff(w: WindowSpec, step: int, value: str = "pm25") -> Column:
    """Change of the previous row against `step` rows before it."""
    return F.lag(value, 1).over(w) - F.lag(value, step + 1).over(w)


def lagged_pct_change(w: WindowSpec, value: str = "pm25") -> Column:
    """Relative change of the previous row; x/0 is an infinity (kept), 0/0 is NaN (dropped)."""
    return pct_change(F.lag(value, 1).over(w), F.lag(value, 2).over(w))


def pct_change(new: Column, old: Column) -> Column:
    infinity = F.lit(float("inf"))
    by_zero = F.when(new == 0, F.lit(float("nan"))).when(new > 0, infinity).otherwise(-infinity)
    return F.when(old.isNull() | new.isNull(), None).when(old == 0, by_zero).otherwise(
        F.try_divide(new, old) - 1
    )


def calendar_columns(at: Column, hourly: bool = False) -> dict[str, Column]:
    weekday = F.weekday(at)
    columns = {
        "day_of_week": weekday,
        "month": F.month(at),
        "day_of_year": F.dayofyear(at),
        "is_weekend": (weekday >= 5).cast("int"),
    }
    return {"hour": F.hour(at), **columns} if hourly else columns


def lead_target(w: WindowSpec, rows: int = HORIZON_HOURS, value: str = "pm25") -> Column:
    return F.lead(value, rows).over(w)


def build_daily_features(
    df: DataFrame,
    min_rows: int | None = 1,
    lags: Sequence[int] = DAILY_LAGS,
    windows: Sequence[int] = DAILY_WINDOWS,
    keys: Sequence[str] = KEYS,
) -> DataFrame:
    """(keys, date, pm25, 17 features); rows with a missing feature are dropped.

    `min_rows=1` is the training rule (n-7 rows stay), `None` the serving rule (n-14 stay).
    """

    def columns(w):
        return {
            **lag_columns(w, lags),
            **rolling_columns(w, windows, min_rows=min_rows),
            **calendar_columns(F.col("date")),
            "pm25_diff_1": lagged_diff(w, 1),
            "pm25_pct_change_1": lagged_pct_change(w),
        }

    numbered = positioned(df, "date", keys, pos="_pos")
    reach = max(*lags, *windows, 2)
    wide = over_chunks(numbered, columns, "_pos", back=reach, keys=keys)
    return drop_incomplete(wide.drop("_pos"))


def build_hourly_features(
    series: DataFrame, target: bool = True, keys: Sequence[str] = KEYS, keep: Sequence[str] = ()
) -> DataFrame:
    """(keys, hour, ts, pm25, 19 features[, pm25_h24]) of a gap-free hourly series (n-49 rows).

    Calendar columns read `ts` as it is; the hourly path keeps UTC. `keep` names further columns to
    carry along.
    """

    def columns(w):
        named = {
            **lag_columns(w, HOURLY_LAGS),
            **rolling_columns(w, HOURLY_WINDOWS, suffix="h"),
            "pm25_diff_1h": lagged_diff(w, 1),
            "pm25_diff_24h": lagged_diff(w, 24),
        }
        return {**named, HOURLY_TARGET: lead_target(w)} if target else named

    base = series.select(*keys, F.col("hour").alias("_hour"), "ts", "pm25", *keep)
    # lags reach 25 rows back; a row number without holes follows from the regular grid
    wide = over_chunks(
        base, columns, "_hour", back=25, ahead=HORIZON_HOURS if target else 0, keys=keys
    )
    calendar = calendar_columns(F.col("ts"), hourly=True)
    wide = wide.drop("_hour").withColumns(calendar)
    ordered = [*HOURLY_FEATURES, *([HOURLY_TARGET] if target else [])]
    return drop_incomplete(wide.select(*keys, "ts", "pm25", *ordered, *keep), ordered)


def history_features(values: Column, date: Column) -> dict[str, Column]:
    """The 17 daily features of `date` from an array of the readings before it, oldest first.

    Works inside one row: a request's features need no explode, window or shuffle.
    """
    back = lambda n: F.element_at(values, -n)
    columns = {f"pm25_lag_{n}": back(n) for n in DAILY_LAGS}
    for n in DAILY_WINDOWS:
        tail = F.slice(values, -n, n)
        mean = F.aggregate(tail, F.lit(0.0), lambda acc, v: acc + v) / n
        squares = F.transform(tail, lambda v: (v - mean) * (v - mean))
        columns[f"pm25_rolling_mean_{n}"] = mean
        columns[f"pm25_rolling_std_{n}"] = F.sqrt(
            F.aggregate(squares, F.lit(0.0), lambda acc, v: acc + v) / (n - 1)
        )
    return {
        **columns,
        **calendar_columns(date),
        "pm25_diff_1": back(1) - back(2),
        "pm25_pct_change_1": pct_change(back(1), back(2)),
    }


def build_guide_features(df: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """The documented alternative set: windows include the current day; more calendar columns."""

    def columns(w):
        return {
            **{f"pm25_lag_{n}": F.lag("pm25", n - 1).over(w) for n in DAILY_LAGS},
            **rolling_columns(w, (3, 7), include_current=True),
        }

    numbered = positioned(df, "date", keys, pos="_pos")
    wide = over_chunks(numbered, columns, "_pos", back=7, keys=keys).drop("_pos")
    date = F.col("date")
    calendar = {
        "month": F.month(date),
        "day_of_year": F.dayofyear(date),
        "day_of_week": F.weekday(date),
        "year": F.year(date),
        "quarter": F.quarter(date),
        "week_of_year": F.weekofyear(date),
        "day_of_month": F.dayofmonth(date),
        "is_weekend": (F.weekday(date) >= 5).cast("int"),
    }
    return drop_incomplete(wide.withColumns(calendar))


def feature_columns(
    df: DataFrame, exclude: Sequence[str] = ("station", "date", "ts", "pm25", HOURLY_TARGET)
) -> list[str]:
    """Feature names in column order: everything but keys, time and target."""
    return [c for c in df.columns if c not in exclude]


def trailing_window(
    df: DataFrame, days: int, order: str = "ts", keys: Sequence[str] = KEYS, last: DataFrame | None = None, stored: bool = False
) -> DataFrame:
    """Rows from `days` days before a station's last row, both ends included.

    The last rows are found first; then the oldest of their bounds goes to the scan as a constant, and
    each station's own bound is applied by a join. An input that is no stored table is stored once,
    so that its plan does not run twice. `last` (keys, _last) replaces the first step.
    """
    if last is None:
        df = df if stored else stage_table(df, "window-input")
        last = stage_table(df.groupBy(*keys).agg(F.max(order).alias("_last")), "last")
    since = F.col("_last") - F.make_dt_interval(days=F.lit(days))
    floor = last.agg(F.min(since.cast("timestamp_ntz")).cast("string").alias("since")).first()["since"]
    kind = dict(df.dtypes)[order]
    rows = df if floor is None else df.filter(F.col(order) >= F.lit(floor).cast("timestamp_ntz").cast(kind))
    return rows.join(last, list(keys)).filter(F.col(order) >= since).drop("_last")


def latest(df: DataFrame, n: int, order: str = "ts", keys: Sequence[str] = KEYS, ties: Sequence[str] = ()) -> DataFrame:
    """The newest n rows per station, numbered from the newest; Spark limits groups before the
    shuffle, so a hot station sends n rows per task."""
    w = Window.partitionBy(*keys).orderBy(F.col(order).desc(), *[F.col(t).desc() for t in ties])
    return df.withColumn("recency", F.row_number().over(w)).filter(F.col("recency") <= n)


def latest_report(df: DataFrame, order: str, keys: Sequence[str] = KEYS, ties: Sequence[str] = ()) -> DataFrame:
    return latest(df, 1, order, keys, ties).drop("recency")


def thin(
    df: DataFrame, every_kth: int = 4, order: str = "ts", keys: Sequence[str] = KEYS, segment: str = "MONTH"
) -> DataFrame:
    """Every k-th row of a station in time order, starting with the first."""
    numbered = positioned(df, order, keys, segment, pos="_pos")
    return numbered.filter((F.col("_pos") - 1) % every_kth == 0).drop("_pos")
