"""Small literal cases with known results."""

import datetime as dt
import json
import random
from collections import Counter

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from hazeline.functions import parsing, scalar
from hazeline.operators import aggregate, drift, features, gaps, model, upsert, validate
from hazeline.plans.series import hour_index, hour_start
from hazeline.session import stage_table
from hazeline.sources import sheets, snapshots

DAY = dt.date(2024, 1, 1)


def daily(spark, values, station="a", start=DAY):
    rows = [(station, start + dt.timedelta(days=i), v) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "station string, date date, pm25 double")


def values(df, order="date", column="pm25"):
    return [r[column] for r in df.orderBy(order).collect()]


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    "method, given, expected",
    [
        ("ffill", [10.0, None, None, 20.0, 25.0], [10, 10, 10, 20, 25]),
        ("ffill", [None, 5.0, None], [5, 5, 5]),
        ("interpolate", [10.0, None, None, 40.0, 50.0], [10, 20, 30, 40, 50]),
        ("interpolate", [None, 10.0, None, 20.0, None], [10, 10, 15, 20, 20]),
        ("drop", [10.0, None, 20.0], [10, 20]),
        ("ffill", [None, None], []),
    ],
)
@pytest.mark.parametrize("every", ["YEAR", "DAY"])
def test_fill(spark, method, given, expected, every):
    assert values(gaps.fill_series(daily(spark, given), method, every=every)) == expected


def test_unknown_fill_raises(spark):
    with pytest.raises(ValueError):
        gaps.fill_series(daily(spark, [1.0]), "x")


def test_fill_flagged_and_limited(spark):
    df = daily(spark, [None, 4.0, None, None, None, 8.0])
    flagged = gaps.fill_flagged(df, every="DAY").orderBy("date").collect()
    assert [r["pm25"] for r in flagged] == [None, 4, 4, 4, 4, 8]
    assert [r["was_filled"] for r in flagged] == [False, False, True, True, True, False]
    assert values(gaps.fill_limited(df, 1)) == [4, 4, 4, None, 8, 8]


def test_outliers_and_checks(spark):
    df = daily(spark, [10.0, 50.0, -5.0, 600.0, 25.0, None])
    assert values(validate.remove_outliers(df)) == [10, 50, 25]
    assert values(validate.positive_only(df)) == [10, 50, 600, 25]
    checked = validate.check_constraints(df, validate.READING_CHECKS[:1])
    assert values(checked) == [10, 50, 25, None]


def test_validate_reasons(spark):
    df = spark.createDataFrame(
        [(1, 501.0, 101.0), (2, None, 50.0), (3, 0.0, 100.0)], "id int, pm25 double, rh double"
    )
    rows = {r["id"]: r for r in validate.validate(df).collect()}
    assert rows[1]["errors"] == ["pm25=501.0 out of range [0, 500]", "rh=101.0 out of range [0, 100]"]
    assert rows[2]["is_valid"] and rows[2]["pm25_is_null"] and rows[3]["is_valid"]
    empty = validate.validation_summary(validate.validate(df.limit(0))).first()
    assert empty.asDict() == {"validated": 0, "failed": 0, "pass_rate": 0.0}


@pytest.mark.parametrize(
    "text, number",
    [("1,234.5", 1234.5), ("-", None), ("", None), ("None", None), ("nan", None), ("abc", None), (" 7 ", 7.0), ("NAN", None), ("1d", None), ("2.f", None), ("-1e2", -100.0)],
)
def test_coerce_float(spark, text, number):
    assert one(spark, parsing.coerce_float(F.lit(text))) == number


def test_times(spark):
    parsed = one(spark, parsing.parse_buddhist_ts(F.lit("14/04/2569 02:00")))
    assert parsed == dt.datetime(2026, 4, 13, 19, 0)
    assert one(spark, parsing.parse_buddhist_ts(F.lit("29/02/2567 00:30"))) == dt.datetime(2024, 2, 28, 17, 30)
    assert one(spark, parsing.parse_buddhist_ts(F.lit("broken"))) is None
    stamp = F.lit("2026-04-13 19:00:00").cast("timestamp_ntz")
    assert one(spark, parsing.format_local(stamp)) == "14/04/2026 02:00"
    early = F.lit("1969-12-31 05:10:00").cast("timestamp_ntz")
    assert one(spark, hour_start(hour_index(early))) == dt.datetime(1969, 12, 31, 5)


@pytest.mark.parametrize(
    "text, job, backfill",
    [
        ("2024-01-05", "2024-01-05", "2024-01-05"),
        (" 5/1/2024 ", "2024-01-05", "2024-01-05"),
        ("05-01-2024", "2024-01-05", "2024-01-05"),
        ("2024-01-05 10:00:00", "2024-01-05", None),
        ("2024-01-05T23:30:00Z", "2024-01-05", None),
        ("2024-01-05T23:30:00+07:00", "2024-01-05", None),
        ("1Jan2024", None, "2024-01-01"),
        ("1 Jan 2024", None, "2024-01-01"),
        ("1January2024", None, "2024-01-01"),
        ("1 January 2024", None, "2024-01-01"),
        ("31/02/2024", None, None),
        ("soon", None, None),
    ],
)
def test_dates(spark, text, job, backfill):
    day = lambda x: x and dt.date.fromisoformat(x)
    assert one(spark, parsing.parse_date_multi(F.lit(text))) == day(job)
    wide = parsing.parse_date_multi(F.lit(text), parsing.BACKFILL_DATE_FORMATS, iso=False)
    assert one(spark, wide) == day(backfill)


def test_bands(spark):
    strict = [one(spark, scalar.aq_band(F.lit(v))) for v in (15.0, 25.0, 37.5, 75.0, 75.1)]
    local = [one(spark, scalar.aq_band(F.lit(v), scalar.LOCAL_LADDER)) for v in (25.0, 37.0, 50.0, 90.0, 90.1)]
    assert strict == local == list(scalar.BANDS)
    assert [one(spark, scalar.regime(F.lit(v))) for v in (34.9, 35.0, 75.0, 75.1)] == [
        "low", "moderate", "moderate", "high",
    ]
    assert [one(spark, scalar.psi_status(F.lit(v))) for v in (0.09, 0.1, 0.2)] == [
        "stable", "moderate", "significant",
    ]
    assert one(spark, scalar.clip(F.lit(None).cast("double"), 0, 500)) is None
    assert one(spark, scalar.round_half_up(F.lit(0.125), 2)) == 0.13


def test_log_dedupe(spark):
    rows = [(dt.date(2026, 4, 14), float(i), i) for i in range(7)] + [(dt.date(2024, 12, 16), 9.0, 1)]
    df = spark.createDataFrame(rows, "date date, predicted double, created int")
    kept = upsert.dedupe_latest(df, ["date"], ["created"]).orderBy("date").collect()
    assert [(r["predicted"], r["created"]) for r in kept] == [(9.0, 1), (6.0, 6)]


def test_insert_ignore_is_idempotent(spark):
    schema = "station string, ts int, v double"
    target = spark.createDataFrame([("a", 1, 1.0)], schema)
    batch = spark.createDataFrame([("a", 1, 9.0), ("a", 2, 2.0), ("a", 2, 3.0)], schema)
    once = upsert.insert_ignore(target, batch, ["v"])
    twice = upsert.insert_ignore(once, batch, ["v"])
    expected = [("a", 1, 1.0), ("a", 2, 2.0)]
    assert sorted(map(tuple, once.collect())) == sorted(map(tuple, twice.collect())) == expected
    counts = upsert.insert_counts(batch, upsert.new_rows(target, batch, ["v"])).first()
    assert counts.asDict() == {"inserted": 1, "duplicates": 2}
    none = upsert.insert_counts(batch.limit(0), batch.limit(0)).first()
    assert none.asDict() == {"inserted": 0, "duplicates": 0}


def test_delete_keeps_unknown(spark):
    df = spark.createDataFrame([("a", 1), ("a", None), ("b", 1)], "station string, ts int")
    kept = upsert.delete_range(df, F.lit(0), F.lit(5), ["a"])
    assert sorted(map(tuple, kept.collect()), key=str) == [("a", None), ("b", 1)]


@pytest.mark.parametrize("n", [1, 7, 8, 30])
def test_feature_counts(spark, n):
    df = daily(spark, [float(1 + (i * 7) % 13) for i in range(n)])
    assert features.build_daily_features(df).count() == max(n - 7, 0)
    assert features.build_daily_features(df, min_rows=None).count() == max(n - 14, 0)


@pytest.mark.parametrize("n", [49, 50, 100])
def test_hourly_feature_counts(spark, n):
    start = dt.datetime(2024, 2, 28)
    rows = [("a", start + dt.timedelta(hours=i), float(i % 9)) for i in range(n)]
    series = gaps.hourly_series(spark.createDataFrame(rows, "station string, ts timestamp_ntz, pm25 double"))
    built = features.build_hourly_features(series)
    assert built.count() == max(n - 49, 0)
    assert features.feature_columns(built) == list(features.HOURLY_FEATURES)
    assert len(features.HOURLY_FEATURES) == 19 and len(features.DAILY_FEATURES) == 17


def test_zero_change(spark):
    df = daily(spark, [0.0, 5.0, 0.0, 0.0, 3.0, 1.0])
    built = features.build_daily_features(df, lags=[1], windows=[3]).orderBy("date").collect()
    # 0 -> 5 is an infinity and stays, 5 -> 0 is -1, 0 -> 0 is not a number and its row goes
    assert [r["pm25_pct_change_1"] for r in built] == [float("inf"), -1.0, float("inf")]


def test_wide_sheet(spark):
    wide = spark.createDataFrame(
        [("2024-01-02", "n/a", "7"), ("2024-01-01", "1,000.5", None), ("Mean", "3", "4")],
        "Date string, `10T` string, `b.2` string",
    )
    assert values(sheets.load_station(wide, "10T")) == [1000.5, None]
    long = sheets.unpivot_stations(wide).orderBy("station", "date").collect()
    assert [(r["station"], r["pm25"]) for r in long] == [("10T", 1000.5), ("10T", None), ("b.2", None), ("b.2", 7.0)]
    with pytest.raises(ValueError):
        sheets.load_station(wide, "11T")


def test_header_after_ten_rows_is_not_found(spark):
    rows = [(i, "x") for i in range(10)] + [(10, "Station"), (11, "S1")]
    raw = spark.createDataFrame(rows, "row_no int, c0 string")
    found = sheets.read_with_header_marker(raw, "Station", {"Station": "s"}, "s")
    with pytest.raises(Exception, match="no header"):
        found.collect()
    found = sheets.read_with_header_marker(raw, "Station", {"Station": "s"}, "s", 11)
    assert [r["s"] for r in found.collect()] == ["S1"]


def test_snapshot(spark):
    body = """{"arrParameter": [
        {"Alias": "a", "MeasIndex": 56, "ShortName": "PM2.5"}, {"Alias": "b", "MeasIndex": 56, "ShortName": "RH"},
        {"Alias": "c", "MeasIndex": 99, "ShortName": "PM2.5"}, {"Alias": "d", "MeasIndex": 57, "ShortName": "CO"},
        {"Alias": "e", "MeasIndex": 57, "ShortName": "PM2.5"}],
      "arrData": [{"Date_Time": "14/04/2569 02:00", "a": "1,001.5", "b": "-", "c": "5", "d": "6", "e": "-"},
                  {"Date_Time": "14/04/2569 02:00", "b": "61"}, {"Date_Time": "", "a": "3"},
                  {"Date_Time": "14/04/2569 03:00", "a": "4", "zz": "9"}]}"""
    payloads = spark.createDataFrame([(1, body)], "payload_id int, body string")
    dim = spark.createDataFrame([(56, "n", "N"), (57, "m", "M")], "station_id int, station_name string, station_name_en string")
    rows = snapshots.decode_snapshots(payloads, dim, dim).orderBy("ts").collect()
    assert [(r["station_id"], r["ts"].hour, r["pm25"], r["rh"]) for r in rows] == [
        (56, 19, 1001.5, 61.0), (56, 20, 4.0, None),
    ]
    assert rows[0]["station_name_en"] == "N"


def test_snapshot_with_repeated_aliases(spark):
    body = """{"arrParameter": [
        {"Alias": "a", "MeasIndex": 1, "ShortName": "RH"}, {"Alias": "b", "MeasIndex": 1, "ShortName": "PM2.5"},
        {"Alias": "c", "MeasIndex": 1, "ShortName": "PM2.5"}, {"Alias": "a", "MeasIndex": 2, "ShortName": "WS"}],
      "arrData": [{"Date_Time": "01/01/2567 00:00", "c": "7", "b": "8", "a": "9"},
                  {"Date_Time": "01/01/2567 01:00", "b": "5"}, {"Date_Time": "01/01/2567 02:00", "a": "-", "b": "-"}]}"""
    payloads = spark.createDataFrame([(1, body), (2, "broken")], "payload_id int, body string")
    dim = spark.createDataFrame([(1, "n", "N")], "station_id int, station_name string, station_name_en string")
    rows = snapshots.decode_snapshots(payloads, dim).orderBy("ts", "station_id").collect()
    assert [(r["station_id"], r["pm25"], r["rh"], r["ws"]) for r in rows] == [
        (1, 8.0, None, None), (2, None, None, 9.0), (1, 5.0, None, None),
    ]
    assert rows[1]["station_name"] is None


def plain_readings(body):
    """{(station, time): {parameter: text}} of one payload, entry by entry and cell by cell."""
    parsed, found = json.loads(body), {}
    meaning = {
        e["Alias"]: (e["MeasIndex"], e["ShortName"]) for e in parsed.get("arrParameter") or ()
        if e and e.get("Alias") is not None and e.get("MeasIndex") is not None and e.get("ShortName") in sheets.PARAMETER_FIELDS
    }
    for row in parsed.get("arrData") or ():
        if row and row.get("Date_Time"):
            for alias, text in row.items():
                if alias in meaning:
                    station, name = meaning[alias]
                    found.setdefault((station, row["Date_Time"].strip(" ")), {})[name] = text
    return found


def random_payload(rng):
    names = [*sheets.PARAMETER_FIELDS, "CO", None]
    entries = [
        rng.choice([None, {"Alias": rng.choice(["a", "b", "c", "d", None]), "MeasIndex": rng.choice([1, 2, 3, None]), "ShortName": n}, *[
            {"Alias": a, "MeasIndex": rng.randint(1, 3), "ShortName": n} for a in "abcdef"]])
        for n in rng.choices(names, k=rng.randint(0, 14))
    ]
    times = ["01/01/2567 00:00", " 01/01/2567 00:00", "01/01/2567 01:00", "01/01/2567 02:00 ", "", None]
    cells = [
        rng.choice([None] + 6 * [{"Date_Time": rng.choice(times), **{a: rng.choice(["1", "2.5", "-", None]) for a in rng.sample("abcdefg", 4)}}])
        for _ in range(rng.randint(0, 9))
    ]
    return rng.choice([{"arrParameter": entries, "arrData": cells}] * 8 + [{"arrData": cells}, {"arrParameter": entries, "arrData": None}])


def test_snapshots_in_pieces_as_plain_decoding(spark, monkeypatch):
    rng = random.Random(5)
    bodies = [json.dumps(random_payload(rng)) for _ in range(120)]
    payloads = spark.createDataFrame([(i % 50 if i % 50 else None, b) for i, b in enumerate(bodies)], "payload_id int, body string").coalesce(1)
    pieces = snapshots.payload_pieces(payloads.select(F.col("payload_id").alias("id"), F.monotonically_increasing_id().alias("payload"), "body"))
    batches = pieces.toArrow().combine_chunks().to_batches()[0]
    wanted = Counter(
        (i % 50 if i % 50 else None, *key, *[texts.get(n) for n in sheets.PARAMETER_FIELDS])
        for i, b in enumerate(bodies) for key, texts in plain_readings(b).items()
    )
    for size, most in ((7, 1), (7, 100), (1000, 40), (1000, 100_000)):
        monkeypatch.setattr(snapshots, "CELLS_AT_ONCE", most)
        parts = [batches.slice(at, size) for at in range(0, len(batches), size)]
        groups = list(snapshots.whole_payloads(parts))
        assert sum(len(g) for g in groups) == len(batches)
        found = [tuple(r.values()) for g in groups for r in snapshots.cells_by_reading(g, sheets.PARAMETER_FIELDS).to_pylist()]
        assert Counter(found) == wanted
        if most == 1:
            assert all(len(set(g.column("payload").to_pylist())) <= 2 for g in groups)


def test_large_payload_leaves_the_parser_in_elements(spark):
    body = json.dumps({
        "arrParameter": [{"Alias": f"a{i}", "MeasIndex": i, "ShortName": "PM2.5"} for i in range(300)],
        "arrData": [{"Date_Time": f"01/01/2567 {h:02d}:00", **{f"a{i}": str(i) for i in range(300)}} for h in range(5)],
    })
    payloads = spark.createDataFrame([(1, 1, body)], "id int, payload bigint, body string")
    rows = snapshots.payload_pieces(payloads).collect()
    assert len(rows) == 300 and sorted(len(r["cells"]) for r in rows[:5]) == [301] * 5
    assert all(r["cells"] == [] for r in rows[5:])


def test_large_payloads_have_row_groups_of_their_own(spark):
    payloads = spark.range(5).select(F.col("id").alias("payload_id"), F.lit("{}").alias("body")).coalesce(1)
    stored = stage_table(payloads, "payloads", **snapshots.LARGE_PAYLOADS)
    files = [pq.ParquetFile(f.removeprefix("file:")).metadata for f in stored.inputFiles()]
    assert sum(f.num_row_groups for f in files) == 5


def test_fold_sizes(spark):
    df = daily(spark, [1.0] * 103)
    folds = model.fold_sizes(model.time_folds(df, 3, "date"), 3, "date").collect()
    assert sorted((r["fold"], r["role"], r["rows"]) for r in folds) == [
        (1, "test", 25), (1, "train", 28), (2, "test", 25), (2, "train", 53), (3, "test", 25), (3, "train", 78),
    ]


def test_champion_and_promotion(spark):
    rows = [
        ("145", "Linear", 4.5986, 6.6231), ("145", "Ridge", 4.5984, 6.6229), ("145", "Random Forest", 4.5713, 6.5123),
        ("145", "XGBoost", 4.5776, 6.6307), ("145", "LSTM", 6.1174, 8.8924),
    ]
    metrics = spark.createDataFrame(rows, "station string, model string, mae double, rmse double")
    for metric in ("mae", "rmse"):
        assert model.champion(metrics, metric).first()["model"] == "Random Forest"
    best = model.champion(metrics)
    same = best.select("station", "rmse", "mae")
    assert model.promote(best, same).first()["status"] == "NOT_DEPLOYED"
    assert model.promote(best, same.limit(0)).first()["status"] == "DEPLOYED"
    worse = same.withColumn("rmse", F.col("rmse") * 1.02)
    assert model.promote(best, worse).first()["status"] == "DEPLOYED"
    assert model.promote(best, worse, margin=0.05).first()["status"] == "NOT_DEPLOYED"


def test_history_check_and_compat(spark):
    def history(n, value=10.0):
        return [(DAY + dt.timedelta(days=i), value + i) for i in range(n)]

    rows = [("short", history(14)), ("good", list(reversed(history(15)))), ("high", history(15, 490.0))]
    requests = spark.createDataFrame(rows, "request string, history array<struct<date:date,pm25:double>>")
    score = F.col("pm25_lag_1")
    new = model.forecast_next_day(requests, score).collect()
    old = model.forecast_next_day(requests, score, compat=True).collect()
    assert [tuple(r) for r in new] == [("good", dt.date(2024, 1, 16), 24.0)]
    assert [tuple(r) for r in old] == [("good", dt.date(2024, 1, 16), 23.0)]


def test_history_features_equal_window_features(spark):
    df = daily(spark, [float(20 + (i * 37) % 23) for i in range(40)])
    built = features.build_daily_features(df, min_rows=None).orderBy("date").collect()[-1]
    earlier = [r["pm25"] for r in df.orderBy("date").collect()][:-1]
    made = features.history_features(
        F.array(*[F.lit(v) for v in earlier]), F.lit(built["date"])
    )
    row = spark.range(1).select(*[c.alias(n) for n, c in made.items()]).first()
    for name in features.DAILY_FEATURES:
        assert row[name] == pytest.approx(built[name])


def test_prediction_job_reasons(spark):
    def hours(station, first, days):
        return [(station, dt.datetime(2024, 1, first) + dt.timedelta(days=i), 10.0 + i) for i in range(days)]

    rows = hours("full", 1, 30) + hours("late", 20, 11) + hours("early", 1, 3)
    readings = spark.createDataFrame(rows, "station string, ts timestamp_ntz, pm25 double")
    stations = spark.createDataFrame([("full",), ("late",), ("early",), ("none",)], "station string")
    jobs = model.prediction_jobs(readings, stations, "2024-02-10", "2024-01-25", "2024-02-05")
    found = {(r["station"], r["target_date"]): r["skip_reason"] for r in jobs.collect()}
    assert found[("full", dt.date(2024, 1, 31))] is None
    assert ("full", dt.date(2024, 2, 1)) not in found
    assert found[("late", dt.date(2024, 1, 25))] == "history_contains_missing_pm25"
    assert found[("early", None)] == "requested_start_beyond_latest_history"
    assert found[("none", None)] == "no_daily_data"
    job = jobs.filter("station = 'full' AND target_date = '2024-01-31'").first()
    assert len(job["history"]) == 15 and job["history"][0]["date"] == dt.date(2024, 1, 16)


def test_monitor_outcomes(spark):
    """Healthy pairs stay, scaled pairs go to retraining, and six pairs are too few."""
    base = [40.0 + (i * 7) % 5 for i in range(30)]
    rows, actual = [], []
    for station, predicted in (("ok", [v + 0.5 for v in base]), ("bad", [v * 2.5 for v in base]), ("few", base[:6])):
        rows += [(station, DAY + dt.timedelta(days=i), v, i) for i, v in enumerate(predicted)]
        actual += [(station, DAY + dt.timedelta(days=i), v, i) for i, v in enumerate(base)]
    preds = spark.createDataFrame(rows, "station string, date date, predicted double, entry int")
    actuals = spark.createDataFrame(actual, "station string, date date, actual double, entry int")
    result = {r["station"]: r for r in drift.daily_monitor(preds, actuals, ["entry"], preds.select("station")).collect()}
    assert result["bad"]["needs_retraining"] and result["bad"]["mae_degraded"]
    assert result["few"]["mae"] is None and not result["few"]["needs_retraining"]
    assert result["ok"]["mae"] == 0.5 and not result["ok"]["mae_degraded"]
    few = drift.retrain_decision(preds, actuals, ["entry"]).filter("station = 'few'").first()
    assert few["mae"] is None and few["reason"] == "not_enough_pairs"


def test_raw_pairs_equal_the_join(spark):
    from hazeline.operators.pairs import pair_raw

    p = spark.createDataFrame([("a", 1, 3.0), ("a", 1, 4.0), ("a", 2, 1.0)], "station string, date int, predicted double")
    a = spark.createDataFrame([("a", 1, 1.0), ("a", 1, 2.0), ("a", 3, 9.0)], "station string, date int, actual double")
    row = aggregate.bias_of_raw_pairs(pair_raw(p, a)).first()
    joined = p.join(a, ["station", "date"])
    expect = joined.agg(F.count("*").alias("n"), F.avg(F.col("predicted") - F.col("actual")).alias("b")).first()
    assert (row["pairs"], row["bias"]) == (expect["n"], expect["b"])
