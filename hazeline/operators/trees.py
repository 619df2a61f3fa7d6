"""Regression trees for all stations, folds and settings at once (L6, L7): histogram learning level
by level.

Features are cut into at most `BINS` bins per station. A level of every tree that is being grown is
one job: tasks sum the targets of their rows by (station, model, node, feature, bin), the sums of all
tasks are added up, and the best cut of a node is read off its running sums. Nodes are rows
of a table; the rows of the data never move after they were packed once into chunks of one station
(binned features as bytes), so a station with a third of all rows is just many chunks. What meets a
chunk is one row per station with the nodes since the last stored state, bounded by the rounds
between two states and the nodes of a tree.

A station whose rows all lie in one chunk needs no sums of other tasks: its task goes through all levels
with the same steps and only the nodes leave it. The exchange, job by job, is for the stations beyond a
chunk.

Boosting fits each round to what the rounds before left over; a forest grows all its trees of a
batch side by side on weights drawn from a hash of (row, tree), which repeats on a rerun and on
every machine. A forest of less depth is the upper part of a deeper one, so several depths cost one.
Folds are prefixes of time: fold f learns from blocks before f and is judged on block f; fold 0 is the
refit on all rows. The bins of a station serve all its folds.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from hazeline.session import stage_table, work_dir

BINS = 32
CHUNK = 1 << 16
STATE_EVERY = 10
NODES_AT_ONCE, FAN_IN = 256, 64
TREE_COLUMNS = ("depth", "tree", "node", "feature", "threshold", "left_value", "right_value", "base", "share")
TREE_LIST = (
    "array<struct<depth:int,tree:int,node:int,feature:int,threshold:double,left_value:double,right_value:double,base:double,"
    "share:double>>"
)
NODE = "round int, model int, node int, feature int, bin int, g double, n double, left_g double, left_n double"
CHUNKS = "whole boolean, x binary, y binary, block binary, row binary, state binary"


@dataclass(frozen=True)
class TreeSpec:
    """What to learn. `depths` are the settings of a search; leaf value: sum / (rows + l2)."""

    depths: Sequence[int]
    rounds: int = 100
    boosted: bool = True
    rate: float = 0.1
    l2: float = 1.0
    min_rows: float = 1.0
    sampled: bool = False
    together: int = 25  # trees of a forest that are grown side by side

    @property
    def settings(self) -> int:
        return len(self.depths)


# The hourly searches.
FOREST = TreeSpec((5, 10), rounds=100, boosted=False, l2=0.0, min_rows=4.0, sampled=True)
BOOSTED = TreeSpec((3, 5), rounds=100, rate=0.1)


def quantile_edges(df: DataFrame, features: Sequence[str], bins: int = BINS) -> DataFrame:
    """(station, edges): for each feature up to bins - 1 rising edges at its approximate quantiles."""
    shares = [i / bins for i in range(1, bins)]
    edges = [F.array_distinct(F.percentile_approx(F.col(f).cast("double"), shares)).alias(f"_{i}") for i, f in enumerate(features)]
    return df.groupBy("station").agg(*edges).select("station", F.array(*[f"_{i}" for i in range(len(features))]).alias("edges"))


def even_edges(df: DataFrame, features: Sequence[str], bins: int = BINS) -> DataFrame:
    """(station, edges): bins - 1 edges at equal steps between each feature's extremes."""
    spans = [s(F.col(f).cast("double")).alias(f"_{n}{i}") for i, f in enumerate(features) for n, s in (("a", F.min), ("b", F.max))]
    edge = lambda i, k: F.col(f"_a{i}") + (F.col(f"_b{i}") - F.col(f"_a{i}")) * F.lit(k / bins)
    edges = [F.array(*[edge(i, k) for k in range(1, bins)]) for i in range(len(features))]
    return df.groupBy("station").agg(*spans).select("station", F.array(*edges).alias("edges"))


def packed_rows(
    blocked: DataFrame, features: Sequence[str], target: str, edges: DataFrame, spec: TreeSpec, k: int, order: str
) -> DataFrame:
    """Chunks of one station, stored, in the shape of `CHUNKS`; a bin is the number of edges below
    the value."""
    base = F.array(
        F.avg(target), *[F.avg(F.when(F.col("block") < f, F.col(target))) for f in range(1, k + 1)]
    ).alias("base")
    count = F.count(F.lit(1)).alias("n")
    per_station = stage_table(blocked.groupBy("station").agg(base, count).join(edges, "station"), "tree-bins")
    def bin_of(i: int, feature: str) -> Column:
        number = F.coalesce(F.col(feature).cast("double"), F.lit(float("nan")))  # beyond every edge
        return F.size(F.filter(F.col("edges")[i], lambda e: e < number))

    number = F.xxhash64(F.col("station").cast("string"), F.col(order).cast("string"))
    rows = blocked.join(per_station, "station").select(
        "station",
        F.pmod(number, F.ceil(F.col("n") / CHUNK)).alias("chunk"),
        (F.col("n") <= CHUNK).alias("whole"),
        F.array(*[bin_of(i, f) for i, f in enumerate(features)]).alias("x"),
        F.col(target).cast("double").alias("y"),
        F.col("block").cast("int").alias("block"),
        number.alias("row"),
        "base",
    )
    width, kinds = len(features), dict(blocked.dtypes)

    def pack(own: pa.Table) -> pa.Table:
        base = np.array(own.column("base")[0].as_py(), dtype=float)
        state = np.tile(np.nan_to_num(base) if spec.boosted else np.zeros(k + 1), spec.settings)
        flat = own.column("x").combine_chunks().flatten().to_numpy(zero_copy_only=False)
        raw = lambda name, kind: pa.array([own.column(name).to_numpy().astype(kind).tobytes()], pa.binary())
        return pa.Table.from_arrays(
            [own.column("station").slice(0, 1).combine_chunks(), own.column("whole").slice(0, 1).combine_chunks(),
             pa.array([flat.astype(np.uint8).reshape(-1, width).tobytes()], pa.binary()), raw("y", np.float64),
             raw("block", np.int8), raw("row", np.int64), pa.array([np.repeat(state, len(own)).tobytes()], pa.binary())],
            names=["station", "whole", "x", "y", "block", "row", "state"],
        )

    # about `CHUNK` rows meet in a group
    packed = rows.groupBy("station", "chunk").applyInArrow(pack, f"station {kinds['station']}, {CHUNKS}")
    return stage_table(packed, "tree-rows")


class Rows:
    """One chunk, and the trees that its station has so far."""

    def __init__(self, batch: pa.RecordBatch, at: int, width: int, spec: TreeSpec, k: int):
        raw = lambda name, kind: np.frombuffer(batch.column(name)[at].as_py(), dtype=kind)
        self.y, self.block, self.row = raw("y", np.float64), raw("block", np.int8), raw("row", np.int64)
        self.x = raw("x", np.uint8).reshape(-1, width)
        self.state = raw("state", np.float64).reshape(spec.settings * (k + 1), -1).copy()
        self.spec, self.folds = spec, k + 1
        #: by (round, model): feature, bin, value and rows of every node
        self.trees: dict[tuple[int, int], tuple[np.ndarray, ...]] = {}
        nodes = batch.column("nodes")[at].values if batch.column("nodes")[at].is_valid else None
        if nodes is not None and len(nodes):
            self.plant({n: nodes.field(n).to_numpy(zero_copy_only=False) for n in nodes.type.names})

    def plant(self, field: dict[str, np.ndarray]) -> None:
        """Take over nodes; those of a tree come together."""
        order = np.lexsort((field["model"], field["round"]))
        keys = np.stack([field["round"][order], field["model"][order]], axis=1)
        firsts = np.flatnonzero(np.any(np.diff(keys, axis=0, prepend=keys[:1] - 1), axis=1))
        for start, stop in zip(firsts, [*firsts[1:], len(order)]):
            own = {n: v[order[start:stop]] for n, v in field.items()}
            self.trees[tuple(keys[start].tolist())] = self._tree(own, 2 << max(self.spec.depths))

    def _tree(self, own: dict[str, np.ndarray], size: int) -> tuple[np.ndarray, ...]:
        feature, cut, value, rows = np.full(size, -1), np.zeros(size, dtype=np.int64), np.zeros(size), np.zeros(size)
        node, l2 = own["node"], self.spec.l2
        feature[node], cut[node] = own["feature"], own["bin"]
        root = node == 1
        value[1] = own["g"][root][0] / (own["n"][root][0] + l2)
        split = own["feature"] >= 0
        left_g, left_n = own["left_g"][split], own["left_n"][split]
        value[2 * node[split]] = left_g / (left_n + l2)
        value[2 * node[split] + 1] = (own["g"][split] - left_g) / (own["n"][split] - left_n + l2)
        rows[2 * node[split]], rows[2 * node[split] + 1] = left_n, own["n"][split] - left_n
        return feature, cut, value, rows

    def walk(self, tree: tuple, depth: int) -> np.ndarray:
        """The node of every row after `depth` steps."""
        feature, cut = tree[:2]
        node, every = np.ones(len(self.y), dtype=np.int64), np.arange(len(self.y))
        for _ in range(depth):
            asks = feature[node]
            right = self.x[every, np.maximum(asks, 0)] > cut[node]
            node = np.where(asks >= 0, 2 * node + right, node)
        return node

    def applied(self, before: int) -> np.ndarray:
        """The state with all trees of rounds below `before`."""
        state = self.state.copy()
        for (round_, model), tree in self.trees.items():
            if round_ < before:
                for setting, depth in enumerate(self.spec.depths):
                    if self.spec.boosted and model // self.folds != setting:
                        continue
                    node = self.walk(tree, depth)
                    share = self.spec.rate if self.spec.boosted else 1 / self.spec.rounds
                    state[setting * self.folds + model % self.folds] += share * tree[2][node]
        return state

    def weights(self, tree: int) -> np.ndarray:
        """Copies of each row in a tree's sample: Poisson(1) by inversion of a mixed hash."""
        z = self.row.view(np.uint64) + np.uint64((tree + 1) * 0x9E3779B97F4A7C15 % (1 << 64))
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        u = ((z ^ (z >> np.uint64(31))) >> np.uint64(11)).astype(float) / 2.0**53
        limits = np.cumsum(np.exp(-1.0) / np.cumprod([1.0, *range(1, 12)]))
        return np.searchsorted(limits, u, side="right").astype(float)

    def sums(self, round_: int, level: int, model: int, target: np.ndarray, bins: int):
        """(nodes, g, n) of the model's nodes of a level: g and n by (node, feature, bin)."""
        fold = model % self.folds
        learns = self.block < fold if fold else np.ones(len(self.y), dtype=bool)
        weight = self.weights(round_ + model // self.folds) if self.spec.sampled else np.ones(len(self.y))
        learns &= weight > 0
        node = np.ones(len(self.y), dtype=np.int64)
        if level:
            tree = self.trees.get((round_, model))
            if tree is None:
                return None
            node = self.walk(tree, level)
            learns &= (node >= 1 << level) & (tree[3][node] >= 2 * self.spec.min_rows)
        at = np.flatnonzero(learns)
        if not len(at):
            return None
        nodes, own = np.unique(node[at], return_inverse=True)
        width = self.x.shape[1]
        cell = ((own[:, None] * width + np.arange(width)) * bins + self.x[at]).ravel()
        size, w = len(nodes) * width * bins, weight[at]
        g = np.bincount(cell, np.repeat(w * target[at], width), size).reshape(-1, bins)
        n = np.bincount(cell, np.repeat(w, width), size).reshape(-1, bins)
        return nodes, g, n


def models_at(spec: TreeSpec, round_: int, level: int, k: int) -> list[int]:
    """The trees that still grow at a level: one per setting and fold, or per tree of a batch and fold."""
    settings = [s for s, depth in enumerate(spec.depths) if depth > level] if spec.boosted else range(min(spec.together, spec.rounds - round_))
    return [s * (k + 1) + f for s in settings for f in range(k + 1)]


def choose(model: np.ndarray, node: np.ndarray, total: np.ndarray, spec: TreeSpec, round_: int, bins: int) -> dict[str, np.ndarray]:
    """Columns of `NODE`: the best cut of each node from its sums (node, feature, targets and rows by bin).

    Gains are compared in single precision; of equal cuts the lower feature, then the lower bin wins.
    Nodes that no cut improves are left out, but for roots, which get feature -1.
    """
    left_g, left_n = np.cumsum(total[..., :bins], axis=2), np.cumsum(total[..., bins:], axis=2)
    g, n = left_g[:, :1, -1:], left_n[:, :1, -1:]
    score = lambda a, m: a * a / np.where(m + spec.l2 > 0, m + spec.l2, 1.0)
    gain = (score(left_g, left_n) + score(g - left_g, n - left_n)).astype(np.float32)
    gain[(left_n < spec.min_rows) | (n - left_n < spec.min_rows)] = -np.inf
    flat = gain.reshape(len(node), -1)
    best = flat.argmax(axis=1)
    splits = flat[np.arange(len(node)), best] > score(g, n)[:, 0, 0].astype(np.float32)
    keep = np.flatnonzero(splits | (node == 1))
    feature, bin_ = np.where(splits, best // bins, -1)[keep], (best % bins)[keep]
    asked, whole = np.maximum(feature, 0), np.full(len(keep), round_)
    found = (whole, model[keep], node[keep], feature, bin_, g[keep, 0, 0], n[keep, 0, 0],
             left_g[keep, asked, bin_], left_n[keep, asked, bin_])
    names = [x.split() for x in NODE.split(", ")]
    return {name: x.astype(np.int32 if kind == "int" else np.float64) for (name, kind), x in zip(names, found)}


def level_sums(
    chunks: DataFrame, spec: TreeSpec, round_: int, level: int, width: int, k: int, bins: int, station: str
) -> DataFrame:
    """(station, model, node, lot, part, sums): each task's sums of its rows, by feature and bin.

    `sums` holds, for each feature, the targets by bin and the rows by bin.
    """
    models = models_at(spec, round_, level, k)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        kind, total = None, {}
        for batch in batches:
            kind = batch.schema.field("station").type
            for at in np.flatnonzero(~np.array(batch.column("whole").to_pylist(), dtype=bool)).tolist():
                own, name = Rows(batch, at, width, spec, k), batch.column("station")[at].as_py()
                state = own.applied(round_) if spec.boosted else None
                for model in models:
                    target = own.y - state[model] if spec.boosted else own.y
                    found = own.sums(round_, level, model, target, bins)
                    for i, node in enumerate(found[0].tolist() if found else ()):
                        rows, key = slice(i * width, (i + 1) * width), (name, model, node)
                        sums = np.concatenate([found[1][rows], found[2][rows]], axis=1)
                        total[key] = total[key] + sums if key in total else sums
        if total:
            names, model, node = (list(x) for x in zip(*total))
            lot = (np.array(model, dtype=np.int64) * (1 << level) + np.array(node)) // NODES_AT_ONCE
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, kind), pa.array(model, pa.int32()), pa.array(node, pa.int32()), pa.array(lot),
                 pa.array([TaskContext.get().partitionId()] * len(node), pa.int32()),
                 pa.array([x.tobytes() for x in total.values()], pa.binary())],
                names=["station", "model", "node", "lot", "part", "sums"],
            )

    return chunks.mapInArrow(run, f"station {station}, model int, node int, lot long, part int, sums binary")


def added(rows: pa.Table, width: int, bins: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(model, node, sums) with the sums of all parts of a node added up."""
    model, node = rows.column("model").to_numpy(), rows.column("node").to_numpy()
    order = np.lexsort((rows.column("part").to_numpy(), node, model))
    model, node = model[order], node[order]
    first = np.flatnonzero((np.diff(model, prepend=-1) != 0) | (np.diff(node, prepend=-1) != 0))
    data = np.frombuffer(b"".join(rows.column("sums").take(pa.array(order)).to_pylist()), dtype=np.float64)
    sums = np.add.reduceat(data.reshape(len(order), width, 2 * bins), first, axis=0)
    return model[first], node[first], sums


def best_cuts(sums: DataFrame, spec: TreeSpec, round_: int, width: int, bins: int, parts: int, station: str) -> DataFrame:
    """One row per node with its best cut, feature -1 where no cut lowers the squared error.

    A group holds up to `NODES_AT_ONCE` nodes from up to `FAN_IN` tasks; sums of more tasks are first added
    up in steps.
    """

    def add(rows: pa.Table) -> pa.Table:
        model, node, total = added(rows, width, bins)
        same = lambda name: rows.column(name).slice(0, 1).combine_chunks().take(pa.array([0] * len(node)))
        return pa.Table.from_arrays(
            [same("station"), pa.array(model), pa.array(node), same("lot"), same("part"), pa.array([x.tobytes() for x in total], pa.binary())],
            names=["station", "model", "node", "lot", "part", "sums"],
        )

    def cut(rows: pa.Table) -> pa.Table:
        found = choose(*added(rows, width, bins), spec, round_, bins)
        name = rows.column("station").slice(0, 1).combine_chunks().take(pa.array([0] * len(found["node"])))
        return pa.Table.from_arrays([name, *map(pa.array, found.values())], names=["station", *found])

    while parts > FAN_IN:
        merged = sums.withColumn("part", F.floor(F.col("part") / FAN_IN).cast("int")).groupBy("station", "lot", "part")
        sums, parts = merged.applyInArrow(add, sums.schema), -(-parts // FAN_IN)
    return sums.groupBy("station", "lot").applyInArrow(cut, f"station {station}, {NODE}")


class Learner:
    """The jobs of one training: stored chunks with their state, and the stored nodes."""

    def __init__(self, spark: SparkSession, chunks: DataFrame, station: str, width: int, spec: TreeSpec, k: int, bins: int):
        self.spark, self.chunks, self.station, self.width = spark, chunks, station, width
        self.spec, self.k, self.bins = spec, k, bins
        self.schema, self.stored, self.open = f"station {station}, {NODE}", [], []
        # tasks that a scan of the chunks, or a join with them, may have
        self.parts = max(chunks.rdd.getNumPartitions(), int(spark.conf.get("spark.sql.shuffle.partitions")))

    def read(self, paths: list[str]) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(*paths)

    def ready(self) -> DataFrame:
        """Chunks with their station's nodes since the last stored state."""
        if not self.open:
            return self.chunks.withColumn("nodes", F.lit(None).cast(f"array<struct<{NODE.replace(' ', ':').replace(',:', ',')}>>"))
        names = [x.split()[0] for x in NODE.split(", ")]
        nodes = self.read(self.open).groupBy("station").agg(F.collect_list(F.struct(*names)).alias("nodes"))
        return self.chunks.join(nodes, "station", "left")

    def grow(self, round_: int, level: int) -> None:
        sums = level_sums(self.ready(), self.spec, round_, level, self.width, self.k, self.bins, self.station)
        path = work_dir(self.spark, "tree-nodes")
        best_cuts(sums, self.spec, round_, self.width, self.bins, self.parts, self.station).write.parquet(path)
        self.stored.append(path)
        self.open.append(path)

    def grow_alone(self) -> None:
        """All rounds of the stations that lie in one chunk."""
        width, spec, k, bins = self.width, self.spec, self.k, self.bins

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for at in np.flatnonzero(np.array(batch.column("whole").to_pylist(), dtype=bool)).tolist():
                    own, name = Rows(batch, at, width, spec, k), batch.column("station").slice(at, 1)
                    for round_ in range(0, spec.rounds, 1 if spec.boosted else spec.together):
                        grown = None
                        for level in range(max(spec.depths)):
                            sums = [
                                (model, own.sums(round_, level, model, own.y - own.state[model] if spec.boosted else own.y, bins))
                                for model in models_at(spec, round_, level, k)
                            ]
                            sums = [(model, x) for model, x in sums if x is not None]
                            if not sums:
                                break
                            model = np.repeat([m for m, _ in sums], [len(x[0]) for _, x in sums])
                            node = np.concatenate([x[0] for _, x in sums])
                            total = np.concatenate([np.concatenate(x[1:], axis=1) for _, x in sums]).reshape(-1, width, 2 * bins)
                            found = choose(model, node, total, spec, round_, bins)
                            grown = found if grown is None else {n: np.concatenate([v, found[n]]) for n, v in grown.items()}
                            own.plant(grown)
                        if grown is not None:
                            names = name.take(pa.array([0] * len(grown["node"])))
                            yield pa.RecordBatch.from_arrays([names, *map(pa.array, grown.values())], names=["station", *grown])
                        own.state, own.trees = own.applied(spec.rounds), {}

        path = work_dir(self.spark, "tree-nodes")
        self.ready().mapInArrow(run, self.schema).write.parquet(path)
        self.stored.append(path)
        self.open.append(path)

    def store_state(self) -> None:
        """Add the open trees to the state of the rows."""
        width, spec, k = self.width, self.spec, self.k

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                states = [Rows(batch, at, width, spec, k).applied(spec.rounds).tobytes() for at in range(batch.num_rows)]
                columns = {n: batch.column(n) for n in ("station", "whole", "x", "y", "block", "row")}
                yield pa.RecordBatch.from_pydict({**columns, "state": pa.array(states, pa.binary())})

        self.chunks = stage_table(self.ready().mapInArrow(run, f"station {self.station}, {CHUNKS}"), "tree-rows")
        self.open = []

    def errors(self) -> DataFrame:
        """(station, setting, fold, mae, rows) of each fold on its test block, from the stored state."""
        width, spec, k = self.width, self.spec, self.k

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                rows = []
                for at in range(batch.num_rows):
                    own, name = Rows(batch, at, width, spec, k), batch.column("station")[at].as_py()
                    for setting in range(spec.settings):
                        for fold in range(1, k + 1):
                            tested = own.block == fold
                            gap = np.abs(own.y - own.state[setting * (k + 1) + fold])[tested]
                            rows.append((name, setting, fold, float(gap.sum()), int(tested.sum())))
                columns = list(zip(*rows)) or [[]] * 5
                kinds = [batch.schema.field("station").type, pa.int32(), pa.int32(), pa.float64(), pa.int64()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, kinds)], names=["station", "setting", "fold", "gap", "n"]
                )

        none = self.chunks.withColumn("nodes", F.lit(None).cast("array<int>"))
        sums = none.mapInArrow(run, f"station {self.station}, setting int, fold int, gap double, n long")
        return sums.groupBy("station", "setting", "fold").agg(
            (F.sum("gap") / F.sum("n")).alias("mae"), F.sum("n").alias("rows")
        )


def fit_trees(
    blocked: DataFrame, features: Sequence[str], target: str, spec: TreeSpec, k: int = 3, order: str = "ts",
    edges: DataFrame | None = None, bins: int = BINS,
) -> tuple[DataFrame, DataFrame]:
    """(trees, errors) for all stations of `blocked`, which has `block` 0..k and is read three times.

    `errors` has (station, setting, fold, mae, rows). `trees` has one row per node: (station, setting,
    fold, tree, node, feature, threshold, left_value, right_value, base, share); rows up to the threshold
    go left to node 2 * node, the others to 2 * node + 1, values are those of the two sides. A tree
    without a cut has one row with feature -1 and its value on both sides. A prediction is `base` and
    `share` times the sum of the trees' values. `setting` counts `depths`;
    a forest's shallower settings are cut from the trees of the deepest one, so its `setting` is null.
    """
    spark, station = blocked.sparkSession, dict(blocked.dtypes)["station"]
    edges = stage_table(quantile_edges(blocked, features, bins) if edges is None else edges, "tree-edges")
    chunks = packed_rows(blocked, features, target, edges, spec, k, order)
    job = Learner(spark, chunks, station, len(features), spec, k, bins)
    job.grow_alone()
    job.store_state()
    large = not chunks.filter(~F.col("whole")).isEmpty()
    for round_ in range(0, spec.rounds, 1 if spec.boosted else spec.together) if large else ():
        for level in range(max(spec.depths)):
            job.grow(round_, level)
        if not spec.boosted or (round_ + 1) % STATE_EVERY == 0:
            job.store_state()
    if job.open:
        job.store_state()
    l2, edge = F.lit(float(spec.l2)), F.col("edges")[F.greatest(F.col("feature"), F.lit(0))]
    own = F.col("g") / (F.col("n") + l2)
    value = lambda g, n: F.when(F.col("feature") < 0, own).otherwise(g / (n + l2))
    group = F.floor(F.col("model") / (k + 1)).cast("int")
    means = F.array(
        F.avg(target), *[F.avg(F.when(F.col("block") < f, F.col(target))) for f in range(1, k + 1)]
    )
    base = blocked.groupBy("station").agg((means if spec.boosted else F.array([F.lit(0.0)] * (k + 1))).alias("bases"))
    tables = stage_table(edges.join(base, "station"), "tree-bases")
    fold = F.col("model") % (k + 1)
    trees = job.read(job.stored).join(tables, "station").select(
        "station",
        (group if spec.boosted else F.lit(None).cast("int")).alias("setting"),
        fold.cast("int").alias("fold"),
        (F.col("round") + (F.lit(0) if spec.boosted else group)).cast("int").alias("tree"),
        "node", "feature",
        F.when(F.col("feature") >= 0, F.get(edge, F.col("bin"))).alias("threshold"),
        value(F.col("left_g"), F.col("left_n")).alias("left_value"),
        value(F.col("g") - F.col("left_g"), F.col("n") - F.col("left_n")).alias("right_value"),
        F.get("bases", fold).alias("base"),
        F.lit(spec.rate if spec.boosted else 1 / spec.rounds).alias("share"),
    )
    return stage_table(trees, "trees"), stage_table(job.errors(), "tree-errors")


def score_trees(
    rows: DataFrame, trees: DataFrame, features: Sequence[str], carry: Sequence[str], name: str = "predicted"
) -> DataFrame:
    """(carry, name): each row scored by its station's trees.

    `trees` has (station, `TREE_COLUMNS`) of one model per station; `depth` ends the walk. Rows are packed into chunks of one station before they
    meet the trees, so a model is copied once a chunk. Rows of stations without trees are left out.
    """
    node_names = TREE_COLUMNS
    models = stage_table(
        trees.groupBy(F.col("station").alias("_station")).agg(F.collect_list(F.struct(*node_names)).alias("_trees")), "models"
    )
    inputs = [F.col(f).cast("double").alias(f"_x{i}") for i, f in enumerate(features)]
    kept = [F.col(c).alias(f"_k{i}") for i, c in enumerate(carry)]
    chunk = F.floor(F.monotonically_increasing_id() / CHUNK)
    packed = rows.select("station", chunk.alias("_chunk"), F.struct(*inputs, *kept).alias("_row")).groupBy(
        "station", "_chunk"
    ).agg(F.collect_list("_row").alias("_rows"))
    kinds = dict(rows.dtypes)
    schema = ", ".join([f"_k{i} {kinds[c]}" for i, c in enumerate(carry)] + [f"{name} double"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(batch.num_rows):
                own, nodes = batch.column("_rows")[at].values, batch.column("_trees")[at].values
                x = np.stack([own.field(f"_x{i}").to_numpy(zero_copy_only=False) for i in range(len(features))], axis=1)
                field = {n: nodes.field(n).to_numpy(zero_copy_only=False) for n in node_names}
                total, every = np.zeros(len(x)), np.arange(len(x))
                size = 2 << int(field["depth"][0])
                for tree in np.unique(field["tree"]):
                    mine = field["tree"] == tree
                    node, split = field["node"][mine], field["feature"][mine] >= 0
                    feature, cut, value = np.full(size, -1), np.zeros(size), np.zeros(size)
                    value[1] = field["left_value"][mine][node == 1][0]
                    used = split & (2 * node + 1 < size)
                    feature[node[used]], cut[node[used]] = field["feature"][mine][used], field["threshold"][mine][used]
                    value[2 * node[used]] = field["left_value"][mine][used]
                    value[2 * node[used] + 1] = field["right_value"][mine][used]
                    place = np.ones(len(x), dtype=np.int64)
                    for _ in range(int(field["depth"][0])):
                        asks = feature[place]
                        right = ~(x[every, np.maximum(asks, 0)] <= cut[place])
                        place = np.where(asks >= 0, 2 * place + right, place)
                    total += value[place]
                total = field["base"][0] + field["share"][0] * total
                yield pa.RecordBatch.from_arrays(
                    [*[own.field(f"_k{i}") for i in range(len(carry))], pa.array(total)],
                    names=[*[f"_k{i}" for i in range(len(carry))], name],
                )

    scored = packed.join(models, F.col("station") == F.col("_station")).select("_rows", "_trees").mapInArrow(run, schema)
    return scored.select(*[F.col(f"_k{i}").alias(c) for i, c in enumerate(carry)], name)


def tree_search(
    blocked: DataFrame, features: Sequence[str], target: str, spec: TreeSpec, k: int = 3, order: str = "ts",
    edges: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """(results, best): grid search over `spec.depths` for all stations.

    `results` has (station, depth, mean_mae, rank); the score is the mean over folds, the first lowest
    wins. `best` holds the refit of the winner on all rows, in the shape that `score_trees` takes.
    """
    found, errors = fit_trees(blocked, features, target, spec, k, order, edges)
    depth = F.array(*[F.lit(d) for d in spec.depths])
    means = errors.groupBy("station", "setting").agg(F.avg("mae").alias("mean_mae"))
    ordered = F.array_sort(F.collect_list(F.struct("mean_mae", "setting")))
    results = stage_table(
        means.groupBy("station").agg(ordered.alias("s")).select("station", F.posexplode("s").alias("at", "s")).select(
            "station", "s.setting", F.get(depth, F.col("s.setting")).alias("depth"), "s.mean_mae", (F.col("at") + 1).alias("rank")
        ),
        "tree-search",
    )
    winner = results.filter(F.col("rank") == 1).select("station", F.col("setting").alias("_winner"), "depth")
    best = found.filter(F.col("fold") == 0).join(winner, "station").filter(
        F.coalesce(F.col("setting") == F.col("_winner"), F.lit(True))
    )
    return results.drop("setting"), best.drop("_winner")
