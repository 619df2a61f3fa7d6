"""SimHash near-duplicates: pigeonhole blocks, Hamming check, components.

Fingerprints are computed in Arrow batches with numpy: every word shingle is hashed with XXH64 and
a bit of the fingerprint is 1 if it is set in over half of the hashes. Two fingerprints that
differ in at most `radius` bits agree in `BLOCKS - radius` of `BLOCKS` blocks, so distinct
fingerprints meet in equi-joins on each choice of that many blocks and the join condition checks
the Hamming distance. A block value shared by more than `limit` fingerprints is left out of that
join: each of its fingerprints looks up all its neighbours within the radius by equality instead,
which finds the same links without pairing the group.

Copies never meet as pairs: nodes of the link graph are distinct fingerprints. Components come
from alternating star contractions, one staged edge table a round.

Null and empty texts have fingerprint zero and link like any other. Rows that repeat a doc_id are
one document each, with the same component. An empty table gives an empty result. Texts of any
length are hashed in slices.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from hazeline.llm.common import id_text, text_digest, whole
from hazeline.session import stage_table

WORDS = 3
RADIUS = 2
BITS = 64
BLOCKS = 4
SEED = 42
SLICE = 1 << 16
GROUP_LIMIT = 1024


def fingerprint(text: bytes, words: int = WORDS, seed: int = SEED) -> int:
    """Signed 64-bit fingerprint of one text; `bytes.lower` and `bytes.split` are ASCII-only."""
    tokens = text.lower().split()
    if not tokens:
        return 0
    total, ones = max(1, len(tokens) - words + 1), np.zeros(BITS, dtype=np.int64)
    digest = xxhash.xxh64_intdigest
    for start in range(0, total, SLICE):
        part = tokens[start : min(start + SLICE, total) + words - 1]
        grams = map(b" ".join, zip(*[part[i:] for i in range(words)])) if len(tokens) >= words else [b" ".join(tokens)]
        hashes = np.fromiter((digest(g, seed) for g in grams), dtype="<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > total, bitorder="little").view("<i8")[0])


def fingerprints(
    docs: DataFrame, *carry: Column, key: str = "doc_id", text: str = "text", words: int = WORDS
) -> DataFrame:
    """(doc_id, fp, carry) for every row; `carry` are named columns that go along."""

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = [fingerprint(t.as_py(), words) for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(values, pa.int64()), *batch.columns[2:]],
                names=["doc_id", "fp", *batch.schema.names[2:]],
            )

    raw = docs.select(
        F.col(key).cast("long").alias("doc_id"), whole(F.col(text)).cast("binary").alias("text"), *carry
    )
    extra = "".join(f", {name} {kind}" for name, kind in raw.dtypes[2:])
    return raw.mapInArrow(hashed, f"doc_id long, fp long{extra}")


def block_masks(blocks: int = BLOCKS, radius: int = RADIUS) -> list[int]:
    """One signed mask for each choice of `blocks - radius` blocks."""
    edges = [BITS * i // blocks for i in range(blocks + 1)]
    single = [(1 << edges[i + 1]) - (1 << edges[i]) for i in range(blocks)]
    masks = [sum(chosen) for chosen in combinations(single, blocks - radius)]
    return [m - (1 << BITS) if m >> (BITS - 1) else m for m in masks]


def neighbour_masks(radius: int = RADIUS) -> list[int]:
    """Every difference of 1 to `radius` bits."""
    flips = [sum(1 << b for b in chosen) for k in range(1, radius + 1) for chosen in combinations(range(BITS), k)]
    return [m - (1 << BITS) if m >> (BITS - 1) else m for m in flips]


def links(nodes: DataFrame, radius: int = RADIUS, limit: int = GROUP_LIMIT) -> DataFrame:
    """(a, b), a < b: all pairs of distinct fingerprints that differ in at most `radius` bits.

    `nodes` has one row (fp) per distinct fingerprint and is read several times, so it should be
    a stored table.
    """
    masks = block_masks(radius=radius)
    tables = F.array(*[
        F.struct(F.lit(i).alias("block"), F.col("fp").bitwiseAND(F.lit(m)).alias("part")) for i, m in enumerate(masks)
    ])
    blocks = nodes.select("fp", F.explode(tables).alias("at")).select("at.block", "at.part", "fp")
    crowded = stage_table(
        blocks.groupBy("block", "part").agg(F.count(F.lit(1)).alias("n")).filter(F.col("n") > limit).drop("n"),
        "simhash-crowded",
    )
    calm = blocks.join(crowded, ["block", "part"], "left_anti")
    left = calm.withColumnRenamed("fp", "a").alias("l")
    right = calm.withColumnRenamed("fp", "b").alias("r")
    near = F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius
    met = left.join(
        right,
        (F.col("l.block") == F.col("r.block")) & (F.col("l.part") == F.col("r.part")) & (F.col("a") < F.col("b")) & near,
    ).select("a", "b")
    probes = blocks.join(crowded, ["block", "part"], "left_semi").select("fp").distinct()
    flips = F.array(*[F.lit(m) for m in neighbour_masks(radius)])
    looked = probes.select("fp", F.explode(F.transform(flips, lambda m: F.col("fp").bitwiseXOR(m))).alias("other"))
    found = looked.join(nodes.withColumnRenamed("fp", "other"), "other").select(
        F.least("fp", "other").alias("a"), F.greatest("fp", "other").alias("b")
    )
    return met.unionByName(found).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(fp, root) for every end of a link; root is the smallest fingerprint of its component.

    Alternating large and small stars halve the depth of the graph a round. Edges are staged once
    a round, as are the minima that meet them, so a hub's edges can be split over tasks.
    """

    def star(pairs: DataFrame, label: str) -> DataFrame:
        least = stage_table(pairs.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), f"{label}-minima")
        linked = pairs.join(least, "u")
        own = least.filter(F.col("m") != F.col("u")).select(F.col("u").alias("v"), "m")
        return linked, own

    current = stage_table(edges.select(F.col("a").alias("v"), F.col("b").alias("u")).filter("u != v"), "links")
    before = None
    while True:
        both = current.select("u", "v").unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        linked, _ = star(both, "large")
        large = stage_table(
            linked.filter("v > u AND v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "large"
        )
        linked, own = star(large.filter("u != v"), "small")
        small = linked.filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        current = stage_table(
            small.unionByName(own.select(F.col("v").alias("u"), F.col("m").alias("v"))).distinct(), "links"
        )
        # a star forest maps to itself, so equal sums of two rounds' edges mean an equal edge set
        mark = current.select(
            F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.bit_xor(F.xxhash64("v", "u"))
        ).first()
        if mark == before:
            break
        before = mark
    rooted = current.select(F.col("u").alias("fp"), F.col("v").alias("root"))
    return rooted.unionByName(rooted.select(F.col("root").alias("fp"), "root").distinct())


def rooted_nodes(nodes: DataFrame, radius: int = RADIUS) -> DataFrame:
    """`nodes`, a stored table with one row per fp, with the smallest fp of its component as root."""
    rooted = components(links(nodes.select("fp"), radius))
    placed = nodes.join(rooted, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    return stage_table(placed, "fingerprint-roots")


def near_groups(
    docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS, radius: int = RADIUS
) -> DataFrame:
    """(doc_id, fp, component_id) for every row; component_id is the smallest doc_id reachable."""
    rows = stage_table(fingerprints(docs, key=key, text=text, words=words), "fingerprints")
    nodes = stage_table(rows.groupBy("fp").agg(F.min("doc_id").alias("first")), "fingerprint-nodes")
    placed = rooted_nodes(nodes, radius)
    smallest = stage_table(placed.groupBy("root").agg(F.min("first").alias("component_id")), "component-ids")
    labels = stage_table(placed.join(smallest, "root").select("fp", "component_id"), "fingerprint-labels")
    return rows.join(labels, "fp").select("doc_id", "fp", "component_id")


def drop_near_copies(
    docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = WORDS, radius: int = RADIUS
) -> DataFrame:
    """`docs` with one row of each group: the one with the smallest doc_id, then text digest.

    Rows are told apart by doc_id and text, so rows without an id, and rows that repeat an id with
    another text, are judged each in its own group; a row without an id stays only where the whole
    group has none. Of rows that repeat both, one stays.
    """
    name = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "digest")
    rows = fingerprints(docs, text_digest(whole(F.col(text))).alias("digest"), key=key, text=text, words=words)
    placed = rooted_nodes(stage_table(rows.groupBy("fp").agg(F.min(name).alias("first")), "fingerprint-nodes"), radius)
    first = placed.groupBy("root").agg(F.min("first").alias("first"))
    row_key = lambda digest, doc_id: F.concat(digest, id_text(doc_id).cast("binary"))
    stays = first.select(row_key(F.col("first.digest"), F.col("first.doc_id")).alias("_kept_key"))
    own = row_key(text_digest(whole(F.col(f"rec.`{text}`"))), F.col(f"rec.`{key}`").cast("long"))
    # repeated rows are dropped before the shuffle that also serves the join, so no key is hot there
    left = docs.select(F.struct("*").alias("rec")).select("rec", own.alias("_own_key")).dropDuplicates(["_own_key"])
    kept = stage_table(stays, "kept-rows")
    return left.join(kept, F.col("_own_key") == F.col("_kept_key"), "left_semi").select("rec.*")
