"""Filters and validation (F1-F8)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazeline.session import stage_table

# Accepted range per measure.
RANGE_RULES: Mapping[str, tuple[int, int]] = {
    "pm25": (0, 500),
    "pm10": (0, 1000),
    "temp": (-10, 60),
    "rh": (0, 100),
    "ws": (0, 30),
}

# Table constraints of the readings and of the predictions.
READING_CHECKS = ("pm25 BETWEEN 0 AND 500", "pm10 >= 0", "rh BETWEEN 0 AND 100", "ws >= 0")
PREDICTION_CHECKS = ("history_days > 0", "filled_history_days >= 0")


def validate(
    df: DataFrame, rules: Mapping[str, tuple[float, float]] = RANGE_RULES, keys: Sequence[str] = ()
) -> DataFrame:
    """Add `errors` (one text per broken rule), `is_valid` and `<field>_is_null` flags.

    A null in one of `keys` is an error, such as a time that could not be parsed.

    Null passes. Rules for absent columns are skipped. The caller splits on `is_valid`, so the
    rows are scanned once for both outputs.
    """
    present = {field: rule for field, rule in rules.items() if field in df.columns}
    errors = [
        F.when(
            ~F.col(field).between(low, high),
            F.format_string(f"{field}=%s out of range [{low}, {high}]", F.col(field).cast("string")),
        )
        for field, (low, high) in present.items()
    ]
    errors += [F.when(F.col(key).isNull(), F.lit(f"{key} is missing")) for key in keys]
    flags = {f"{field}_is_null": F.col(field).isNull() for field in present}
    checked = df.withColumns({"errors": F.array_compact(F.array(*errors)), **flags})
    return checked.withColumn("is_valid", F.size("errors") == 0)


def validation_summary(checked: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Rows that passed and failed, and the pass rate (0 when there are no rows)."""
    return checked.groupBy(*by).agg(
        F.count_if("is_valid").alias("validated"),
        F.count_if(~F.col("is_valid")).alias("failed"),
        F.coalesce(
            F.try_divide(F.count_if("is_valid").cast("double"), F.count("*")), F.lit(0.0)
        ).alias("pass_rate"),
    )


def check_constraints(df: DataFrame, checks: Sequence[str] = READING_CHECKS) -> DataFrame:
    """Rows that satisfy every check; as in SQL, an unknown (null) check passes."""
    for check in checks:
        df = df.filter(F.coalesce(F.expr(check), F.lit(True)))
    return df


def remove_outliers(
    df: DataFrame, low: float = 0.0, high: float = 500.0, value: str = "pm25"
) -> DataFrame:
    """Keep low <= value <= high; null is dropped."""
    return df.filter(F.col(value).between(low, high))


def positive_only(df: DataFrame, value: str = "pm25") -> DataFrame:
    return df.filter(F.col(value) > 0)


def drop_incomplete(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Drop rows with null or NaN in the columns; infinities stay."""
    return df.dropna(subset=list(columns) if columns else None)


def quality_gate(
    df: DataFrame,
    stations: DataFrame,
    as_of: Column,
    measures: Sequence[str] = ("pm25", "pm10"),
    max_missing: float = 0.20,
    keys: Sequence[str] = ("station",),
) -> DataFrame:
    """Per station: rows from the future, known station or not, missing ratio, and the verdict."""
    known = stations.select(*keys).distinct().withColumn("_known", F.lit(True))
    holes = sum((F.col(m).isNull().cast("double") for m in measures), F.lit(0.0)) / len(measures)
    stats = df.groupBy(*keys).agg(
        F.count("*").alias("rows"),
        F.count_if(F.col("ts") > as_of).alias("future_rows"),
        F.avg(holes).alias("missing_ratio"),
    )
    joined = stats.join(known, list(keys), "left").withColumn(
        "known_station", F.coalesce("_known", F.lit(False))
    )
    passed = (
        (F.col("future_rows") == 0) & F.col("known_station") & (F.col("missing_ratio") < max_missing)
    )
    return joined.drop("_known").withColumn("passed", passed)


def size_gate(
    df: DataFrame, minimums: Mapping[str, int], part: str = "split", keys: Sequence[str] = ("station",)
) -> DataFrame:
    """Per station: rows in each named part, and whether every part has its minimum."""
    counts = df.groupBy(*keys).agg(
        *[F.count_if(F.col(part) == name).alias(f"{name}_rows") for name in minimums]
    )
    enough = F.lit(True)
    for name, minimum in minimums.items():
        enough = enough & (F.col(f"{name}_rows") >= minimum)
    return counts.withColumn("status", F.when(enough, "ok").otherwise("insufficient_data"))


def keep_sized(df: DataFrame, gate: DataFrame, keys: Sequence[str] = ("station",)) -> DataFrame:
    """Rows of the stations that passed a `size_gate`."""
    passed = stage_table(gate.filter(F.col("status") == "ok").select(*keys), "passed")
    return df.join(passed, list(keys), "left_semi")
