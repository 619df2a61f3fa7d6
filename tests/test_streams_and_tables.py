"""Streaming replay and late data, and table writers."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from hazeline.session import work_dir
from hazeline.sources import tables as stored
from hazeline.sources import versions
from hazeline.streaming import ingest

SCHEMA = "station string, ts timestamp_ntz, pm25 double"


def at(minutes):
    return dt.datetime(2024, 1, 1) + dt.timedelta(minutes=minutes)


def rows_file(spark, folder, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(folder)


def stream(spark, folder):
    return ingest.read_stream(spark, folder, SCHEMA, files_per_batch=1)


def test_ingest_replay_and_rejects(spark):
    source, path, state, bad = (work_dir(spark, n) for n in ("src", "table", "state", "bad"))
    rows_file(spark, source, [("a", at(0), 1.0), ("a", at(0), 2.0), ("a", at(60), 501.0)])
    log = work_dir(spark, "log")
    ingest.run_ingest(stream(spark, source), path, state, ["pm25"], bad, log)
    rows_file(spark, source, [("a", at(0), 9.0), ("b", at(0), 3.0)])
    ingest.run_ingest(stream(spark, source), path, state, ["pm25"], bad, log)
    ingest.run_ingest(stream(spark, source), path, work_dir(spark, "state"), ["pm25"], bad, log)  # full replay
    assert spark.read.parquet(log).count() == 2
    found = sorted((r["station"], r["pm25"]) for r in versions.read_table(spark, path).collect())
    assert found == [("a", 1.0), ("b", 3.0)]
    rejected = spark.read.parquet(bad).collect()
    assert [(r["pm25"], r["errors"]) for r in rejected] == [(501.0, ["pm25=501.0 out of range [0, 500]"])]


def test_rejects_of_several_runs_are_all_kept(spark):
    sources, path, bad, log = [work_dir(spark, n) for n in ("one", "two")], *(work_dir(spark, n) for n in ("table", "bad", "log"))
    rows_file(spark, sources[0], [("a", at(0), 501.0), ("a", None, 1.0), ("a", None, 1.0), ("a", at(0), 1.0)])
    rows_file(spark, sources[1], [("b", at(0), 502.0), ("b", at(1500), 503.0), ("b", at(0), 1.0)])
    for _ in range(2):  # new checkpoints each time
        for source in sources:
            ingest.run_ingest(stream(spark, source), path, work_dir(spark, "state"), ["pm25"], bad, log, source)
        found = sorted((r["station"], r["pm25"]) for r in spark.read.parquet(bad).collect())
        assert found == [("a", 1.0), ("a", 1.0), ("a", 501.0), ("b", 502.0), ("b", 503.0)]
        assert versions.read_table(spark, path).count() == 2
        rows = sorted((r["rows"], r["valid"], r["stored"], r["rejected"]) for r in spark.read.parquet(log).collect())
        assert rows == [(3, 1, 1, 2), (4, 1, 1, 3)]


def test_a_batch_that_failed_before_its_ledger_row_is_done_again(spark, monkeypatch):
    source, path, bad, log = (work_dir(spark, n) for n in ("src", "table", "bad", "log"))
    rows_file(spark, source, [("a", at(0), 501.0), ("a", at(0), 1.0)])

    def lost(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(ingest, "append_log", lost)
    with pytest.raises(Exception, match="lost"):
        ingest.run_ingest(stream(spark, source), path, work_dir(spark, "state"), ["pm25"], bad, log)
    monkeypatch.undo()
    ingest.run_ingest(stream(spark, source), path, work_dir(spark, "state"), ["pm25"], bad, log)
    assert versions.read_table(spark, path).count() == spark.read.parquet(bad).count() == spark.read.parquet(log).count() == 1


def test_late_rows_inside_and_outside_the_grace(spark):
    source, path, state = (work_dir(spark, n) for n in ("src", "rolled", "state"))
    steps = [
        [("a", at(10), 1.0), ("a", at(70), 2.0)],
        [("a", at(50), 3.0)],  # 20 minutes late, but its window is still open
        [("a", at(200), 4.0)],
        [("a", at(20), 100.0)],  # its window is closed: dropped
        [("a", at(500), 5.0)],
    ]
    for rows in steps:
        rows_file(spark, source, rows)
        ingest.run_to_table(ingest.rollup_stream(ingest.with_grace(stream(spark, source))), path, state)
    got = {r["start"].hour: (r["pm25"], r["readings"]) for r in spark.read.parquet(path).collect()}
    assert got == {0: (2.0, 2), 1: (2.0, 1), 3: (4.0, 1)}


def test_stream_dedupe_across_batches(spark):
    source, path, state = (work_dir(spark, n) for n in ("src", "unique", "state"))
    for _ in range(2):
        rows_file(spark, source, [("a", at(0), 1.0), ("b", at(5), 1.0)])
        unique = ingest.dedupe_stream(ingest.with_grace(stream(spark, source)))
        ingest.run_to_table(unique, path, state)
    assert spark.read.parquet(path).count() == 2


def test_replacing_a_range_keeps_other_stations_and_hours(spark):
    path = work_dir(spark, "table")
    rows = [(s, at(60 * h), float(h)) for s in "ab" for h in range(72)]
    versions.insert_ignore_table(spark, path, spark.createDataFrame(rows, SCHEMA), ["pm25"])
    batch = spark.createDataFrame([("a", at(61), 8.0), ("a", at(61), 9.0)], SCHEMA)
    for deleted, inserted in ((24, 1), (1, 1)):
        counts = versions.replace_range_table(spark, path, batch, F.lit(at(0)), F.lit(at(1440)), ["pm25"], ["a"]).first()
        assert tuple(counts) == (deleted, inserted, 1)
    found = sorted((r["station"], r["pm25"]) for r in versions.read_table(spark, path).collect())
    assert found == sorted([("a", 8.0)] + [("a", float(h)) for h in range(24, 72)] + [("b", float(h)) for h in range(72)])


def test_a_range_without_new_rows_loses_its_days(spark):
    path = work_dir(spark, "table")
    versions.insert_ignore_table(spark, path, spark.createDataFrame([("a", at(60 * h), 1.0) for h in range(72)], SCHEMA), ["pm25"])
    none = spark.createDataFrame([], SCHEMA)
    for _ in range(2):
        versions.replace_range_table(spark, path, none, F.lit(at(1440)), F.lit(at(2880)), ["pm25"])
        assert versions.read_table(spark, path).count() == 48
    versions.replace_range_table(spark, path, none, F.lit(at(0)), F.lit(at(9000)), ["pm25"])
    assert versions.read_table(spark, path, none.schema).count() == 0


def test_readers_see_a_change_whole_or_not_at_all(spark, monkeypatch):
    path = work_dir(spark, "table")
    content = lambda: sorted((r["station"], r["pm25"]) for r in versions.read_table(spark, path).collect())
    versions.insert_ignore_table(spark, path, spark.createDataFrame([("a", at(60 * h), float(h)) for h in range(72)], SCHEMA), ["pm25"])
    before, seen, commit = content(), [], versions.commit_change

    def between(*args):
        seen.append(content())  # all new files are there, the manifest is not
        raise RuntimeError("lost")

    monkeypatch.setattr(versions, "commit_change", between)
    fresh = spark.createDataFrame([("b", at(30), 5.0)], SCHEMA)
    change = lambda: versions.replace_range_table(spark, path, fresh, F.lit(at(0)), F.lit(at(2880)), ["pm25"])
    with pytest.raises(RuntimeError):
        change()
    assert seen == [before] and content() == before
    monkeypatch.setattr(versions, "commit_change", commit)
    # a manifest that is not complete is no version
    half = f"{path}/versions/{versions.current_version(spark, path) + 7:012d}"
    spark.createDataFrame([], versions.MANIFEST).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(half)
    change()
    assert content() == sorted([("b", 5.0)] + [("a", float(h)) for h in range(48, 72)])
    assert versions.read_table(spark, path, version=1).count() == 72


def test_a_change_of_an_old_version_is_refused(spark, monkeypatch):
    path, rows = work_dir(spark, "table"), [("a", at(0), 1.0)]
    versions.insert_ignore_table(spark, path, spark.createDataFrame(rows, SCHEMA), ["pm25"])
    write = versions.write_change

    def slow(*args):
        monkeypatch.setattr(versions, "write_change", write)
        versions.insert_ignore_table(spark, path, spark.createDataFrame([("b", at(0), 2.0)], SCHEMA), ["pm25"])
        return write(*args)

    monkeypatch.setattr(versions, "write_change", slow)
    with pytest.raises(versions.StaleVersion):
        versions.insert_ignore_table(spark, path, spark.createDataFrame([("c", at(0), 3.0)], SCHEMA), ["pm25"])
    assert sorted(r["station"] for r in versions.read_table(spark, path).collect()) == ["a", "b"]
    assert versions.manifest(spark, path, 2).count() == 2 and versions.compact(spark, path) == 1
    assert versions.manifest(spark, path, 3).count() == 1 and versions.read_table(spark, path).count() == 2


def test_unreadable_times_are_rejects_and_never_stored(spark):
    source, path, bad = (work_dir(spark, n) for n in ("src", "table", "bad"))
    rows_file(spark, source, [("a", at(0), 1.0), ("a", None, 2.0), ("b", None, 3.0)])
    for run in range(3):
        ingest.run_ingest(stream(spark, source), path, work_dir(spark, "state"), ["pm25"], bad, f"{bad}-log")
        assert versions.read_table(spark, path).count() == 1
    assert [r["errors"] for r in spark.read.parquet(bad).collect()] == [["ts is missing"]] * 2
    with pytest.raises(ValueError, match="lack a key"):
        versions.insert_ignore_table(spark, path, spark.createDataFrame([("a", None, 1.0)], SCHEMA), ["pm25"])


def test_upserting_rewrites_only_its_days(spark):
    path, schema = work_dir(spark, "predictions"), "prediction_date date, station string, value double"
    day = lambda n: dt.date(2024, 1, n)
    first = spark.createDataFrame([(day(1), "a", 1.0), (day(2), "a", 2.0), (day(2), "b", 3.0)], schema)
    versions.upsert_table(spark, path, first, ["value"])
    files = lambda: set(versions.read_table(spark, path, days=[day(1)]).inputFiles())
    before = files()
    for _ in range(2):
        versions.upsert_table(spark, path, spark.createDataFrame([(day(2), "a", 9.0)], schema), ["value"])
    assert before and files() == before
    assert sorted(r["value"] for r in versions.read_table(spark, path).collect()) == [1.0, 3.0, 9.0]
    versions.delete_dates_table(spark, path, "2024-01-02", "2024-01-09", ["a"])
    assert sorted(r["value"] for r in versions.read_table(spark, path, since="2024-01-01").collect()) == [1.0, 3.0]


def test_time_bounds_reach_the_event_scan(spark):
    import __spark_entry__ as driver

    for name in ("m9_forecast_monitor", "a2_daily_local_mean", "l16_prediction_jobs", "l16_scheduled_jobs", "l17_store_predictions"):
        plan = driver.queries()[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        scans = [line for line in plan.splitlines() if "events.parquet" in line and "value" in line and "PushedFilters" in line]
        assert scans and all("GreaterThanOrEqual(ts" in line and "LessThan(ts" in line for line in scans)


def test_the_daily_monitor_reads_its_window_only(spark):
    from hazeline.operators import drift

    path = {n: work_dir(spark, n) for n in ("predictions", "actuals")}
    for name, value in (("predictions", "predicted"), ("actuals", "actual")):
        rows = [(s, dt.date(2020, 1, 1) + dt.timedelta(d), float(d), d) for s in "ab" for d in range(400 if s == "a" else 390)]
        spark.createDataFrame(rows, f"station string, date date, {value} double, entry int").write.parquet(path[name])
    logs = [spark.read.parquet(p) for p in path.values()]
    found = drift.daily_monitor(*logs, ["entry"], logs[0].select("station"))
    plan = found._jdf.queryExecution().executedPlan().toString()
    for name in ("predicted", "actual"):
        scans = [x for x in plan.splitlines() if "FileScan" in x and f"{name}#" in x.split("Batched")[0]]
        assert scans and all("GreaterThanOrEqual(date,2020-12-25)" in x for x in scans)
    assert {r["station"]: r["evaluated_pairs"] for r in found.collect()} == {"a": 31, "b": 31}


def test_scan_reaches_the_files(spark):
    path = work_dir(spark, "table")
    stored.write_by_day(spark.createDataFrame([("a", at(i * 60), float(i)) for i in range(48)], SCHEMA), path)
    scan = stored.scan_station(spark.read.parquet(path), "a", F.lit(at(1440)))
    plan = scan._jdf.queryExecution().executedPlan().toString()
    pushed = plan.split("PushedFilters: [")[1]
    assert "GreaterThanOrEqual(ts,2024-01-02T00:00)" in pushed and "IsNotNull(pm25)" in pushed
    assert "isnotnull(station" in plan.split("DataFilters: [")[1]
    assert scan.count() == 24


def test_work_dir_needs_a_shared_folder_on_a_cluster(spark, monkeypatch):
    class Conf:
        def get(self, name, default=None):
            return default

    class Context:
        master = "spark://host"

    class Session:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(ValueError):
        work_dir(Session(), "x")
