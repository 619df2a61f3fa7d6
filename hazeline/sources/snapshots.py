"""Provider snapshots with dynamic keys."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Mapping, Sequence
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazeline.functions.parsing import LOCAL_TZ, coerce_float, parse_buddhist_ts
from hazeline.sources.sheets import PARAMETER_FIELDS

# Fixed format of the provider's payloads: two lists, and what their elements are.
LISTS = ("arrParameter", "arrData")
ENTRY_SCHEMA = "Alias string, MeasIndex int, ShortName string"
TIME_KEY = "Date_Time"
# Parquet options for large payloads: each has a row group of its own, as a reader decodes those whole.
LARGE_PAYLOADS = {"parquet.block.row.count.limit": 1, "parquet.enable.dictionary": "false", "compression": "zstd"}
# Bounds of what is held together, whatever the payloads' sizes.
CELLS_AT_ONCE = 500_000
READINGS_AT_ONCE = 10_000


def station_dim(
    raw: DataFrame, overrides: DataFrame, station: str = "MeasIndex", name: str = "District", english: str = "District_en"
) -> DataFrame:
    """(station_id, station_name, station_name_en); rows without an id go, overrides win."""
    known = raw.filter(F.col(station).isNotNull()).select(
        F.col(station).cast("int").alias("station_id"),
        F.col(name).alias("station_name"),
        F.col(english).alias("_en"),
    )
    return known.join(overrides.select("station_id", "override"), "station_id", "left").select(
        "station_id", "station_name", F.coalesce("override", "_en").alias("station_name_en")
    )


def resolve_stations(dim: DataFrame, requested: Sequence[int]) -> DataFrame:
    """(position, station_id) of the requested stations that exist, in requested order."""
    wanted = dim.sparkSession.createDataFrame(
        list(enumerate(requested)), "position int, station_id int"
    )
    return wanted.join(dim.select("station_id"), "station_id", "left_semi")


def payload_pieces(payloads: DataFrame) -> DataFrame:
    """(id, payload, alias, station, name, time, cells) of (id, payload, body): row by row the next entry of the
    parameter list and the next row of cells, with nulls beyond the end of either; a row without a time has no cells.

    The lists leave the parser as the texts of their elements, which are parsed one by one: no row holds a
    whole parsed payload. Lists of cells are empty, not null: Arrow's writer counts a run of null lists again
    for each row.
    """
    texts = [F.from_json("body", f"{name} array<string>")[name] for name in LISTS]
    padded = F.arrays_zip(*[F.coalesce(t, F.array().cast("array<string>")).alias(name) for t, name in zip(texts, LISTS)])
    elements = payloads.select("id", "payload", F.explode(padded).alias("text"))
    pieces = elements.select(
        "id",
        "payload",
        F.from_json(F.col("text")[LISTS[0]], ENTRY_SCHEMA).alias("entry"),
        F.from_json(F.col("text")[LISTS[1]], "map<string,string>").alias("cells"),
    )
    entry, time = F.col("entry"), F.col("cells")[TIME_KEY]
    return pieces.select(
        "id",
        "payload",
        entry["Alias"].alias("alias"),
        entry["MeasIndex"].alias("station"),
        entry["ShortName"].alias("name"),
        F.trim(time).alias("time"),
        F.when(F.length(time) > 0, F.map_entries("cells")).otherwise(F.array().cast("array<struct<key:string,value:string>>")).alias("cells"),
    )


def whole_payloads(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of whole payloads, with about `CELLS_AT_ONCE` entries and cells and one payload more at most.

    Rows of a payload (column `payload`) follow each other, also over the ends of batches.
    """
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not len(batch):
            continue
        payload = batch.column("payload").to_numpy()
        if held:
            other = np.flatnonzero(payload != held[0].column("payload")[0].as_py())
            goes_on = int(other[0]) if len(other) else len(batch)
            held.append(batch.slice(0, goes_on))
            if goes_on == len(batch):
                continue
            yield joined(held)
            batch, payload = batch.slice(goes_on), payload[goes_on:]
        starts = np.flatnonzero(np.diff(payload, prepend=-1))
        starts, last = starts[:-1], int(starts[-1])
        sizes = np.cumsum(1 + cells_in(batch))
        parts = np.diff(sizes[starts] // CELLS_AT_ONCE, prepend=-1) > 0
        for start, end in pairwise([*starts[parts].tolist(), last]):
            yield batch.slice(start, end - start)
        held = [batch.slice(last)]
    if held:
        yield joined(held)


def joined(held: list[pa.RecordBatch]) -> pa.RecordBatch:
    """One batch of those held, which are let go."""
    rows = pa.concat_batches(held)
    held.clear()
    return rows


def cells_in(rows: pa.RecordBatch) -> np.ndarray:
    return pc.fill_null(pc.list_value_length(rows.column("cells")), 0).to_numpy(zero_copy_only=False).astype(np.int64)


def cells_by_reading(rows: pa.RecordBatch, fields: Mapping[str, str]) -> pa.RecordBatch:
    """(id, station, time, a text per parameter) of whole payloads; later entries and cells replace earlier ones."""
    payload = np.cumsum(np.diff(rows.column("payload").to_numpy(), prepend=-1) != 0)
    parameters = pa.array(list(fields), pa.string())
    listed = pc.and_(rows.column("alias").is_valid(), rows.column("station").is_valid())
    listed = pc.and_(listed, pc.is_in(rows.column("name"), value_set=parameters))
    entries = rows.select(["alias", "station", "name"]).filter(listed)
    owner, alias = payload[listed.to_numpy(zero_copy_only=False)], entries.column("alias")
    key, text = rows.column("cells").flatten().flatten()
    row = np.repeat(np.arange(len(rows)), cells_in(rows))

    # an alias counts inside its payload, by its last entry
    codes = pa.concat_arrays([alias, key]).dictionary_encode()
    code = codes.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    width = max(len(codes.dictionary), 1)
    known, entry = np.unique((owner * width + code[: len(alias)])[::-1], return_index=True)
    entry = len(alias) - 1 - entry
    asked = payload[row] * width + code[len(alias):]
    place = np.searchsorted(known, asked)
    cell = np.flatnonzero(np.append(known, -1)[place] == asked)
    entry, row = entry[place[cell]], row[cell]
    del codes, code, known, asked, place
    station = entries.column("station").to_numpy()[entry]
    name = pc.index_in(entries.column("name"), value_set=parameters).to_numpy()[entry]

    # a reading is one station at one time of a payload
    times = rows.column("time").dictionary_encode()
    time = payload * max(len(times.dictionary), 1) + pc.fill_null(times.indices, 0).to_numpy(zero_copy_only=False)
    stations, at = np.unique(station, return_inverse=True)
    _, first, reading = np.unique(time[row] * max(len(stations), 1) + at, return_index=True, return_inverse=True)
    texts = []
    for number in range(len(fields)):
        last, mine = np.full(len(first), -1), np.flatnonzero(name == number)
        last[reading[mine]] = cell[mine]  # of repeated places numpy keeps the last
        texts.append(text.take(pa.array(last, mask=last < 0)))
    head = pa.array(row[first])
    return pa.RecordBatch.from_arrays(
        [rows.column("id").take(head), pa.array(station[first], pa.int32()), rows.column("time").take(head), *texts],
        names=["id", "station_id", "time", *[f"_{f}" for f in fields.values()]],
    )


def decode_snapshots(
    payloads: DataFrame,
    dim: DataFrame,
    stations: DataFrame | None = None,
    payload_id: str = "payload_id",
    fields: Mapping[str, str] = PARAMETER_FIELDS,
    tz: str = LOCAL_TZ,
) -> DataFrame:
    """Typed readings of JSON payloads: (payload_id, station_id, names, ts, six measures).

    A payload is one row, and its cells meet its parameter list by alias inside its task: one look at every
    entry and cell, which are never shuffled; only whole bodies are, once. Payloads leave the parser in pieces
    and their cells are held as columns, so a payload with very many stations needs a few times its own size.
    The last entry of an alias counts, and
    of the cells of a station, time and measure the last one, by row and place. Only the name table is
    joined (give it as a stored table, so Spark knows its size). Rows whose measures are all null are dropped.
    """
    kind = dict(payloads.dtypes)[payload_id]

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in whole_payloads(batches):
            readings = cells_by_reading(rows, fields)
            del rows  # not kept while the next payload gathers
            pa.default_memory_pool().release_unused()
            for start in range(0, len(readings), READINGS_AT_ONCE):
                yield readings.slice(start, READINGS_AT_ONCE)

    measures = list(fields.values())
    # bodies go to other tasks before they are parsed: the reader's copies of a large one are gone by then
    numbered = payloads.select(F.col(payload_id).alias("id"), F.monotonically_increasing_id().alias("payload"), "body")
    parsed = payload_pieces(numbered.repartition("payload"))
    schema = f"id {kind}, station_id int, time string, " + ", ".join(f"_{f} string" for f in measures)
    readings = parsed.mapInArrow(meet, schema).select(
        F.col("id").alias(payload_id),
        "station_id",
        parse_buddhist_ts(F.col("time"), tz).alias("ts"),
        *[coerce_float(F.col(f"_{f}")).alias(f) for f in measures],
    ).filter(F.coalesce(*measures).isNotNull())
    if stations is not None:
        readings = readings.join(stations.select("station_id"), "station_id", "left_semi")
    return readings.join(dim, "station_id", "left").select(
        payload_id, "station_id", "station_name", "station_name_en", "ts", *measures
    )
