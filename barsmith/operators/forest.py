"""A random forest for tables that are too large for Spark's.

Spark's forest keeps two numbers per row and tree, and every partition sends the statistics of all nodes.
Here every row is binned once into a byte per feature, and rows with equal bins and label, which no split can
part, are one row with a count. A bootstrap draw of n such rows is Poisson(n), found from a hash of what the row
holds, so a tree does not depend on blocks or order of tasks; sums are whole numbers and exact.

The rules are those of Spark's classifier: quantile bins, a random choice of features for each node, weighted Gini
gain, a smallest number of drawn rows per leaf, leaves of one decision joined, and the mean of the leaves' shares.

Up to TASK_ROWS binned rows a task grows some of the trees over all blocks. More rows take a job per level and wave
of trees: blocks measure the nodes, the sums meet by tree and are searched there, and the driver gets splits only.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barsmith.operators import boosting
from barsmith.operators.boosting import BLOCK_ROWS, TASK_ROWS, K, Layout, feature_matrix
from barsmith.operators.evaluation import PROBABILITIES
from barsmith.session import materialize

#: Bins of a feature, and how close their cuts are to quantiles (1 / CUT_ACCURACY of the rows).
BINS = 32
CUT_ACCURACY = 1000
#: Counts up to which a draw is looked up in the distribution; larger ones are drawn from the normal one.
TABLE_COUNT = 1000
#: Bytes of sums that a task holds in a job per level.
WAVE_BYTES = 128 << 20


@dataclass(frozen=True)
class ForestParams:
    trees: int = 200
    max_depth: int = 12
    min_leaf_rows: int = 2
    seed: int = 42


# --- blocks -------------------------------------------------------------------------------

_BLOCK = "rows long, bins binary, label binary, count binary, key binary"


def store_blocks(df: DataFrame, features: list[str], layout: Layout, block_rows: int = BLOCK_ROWS) -> tuple[DataFrame, int, int]:
    """Blocks of the distinct binned rows with their counts, the number of these rows and of blocks."""
    width = len(features)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = feature_matrix(batch.columns[:width], features)
            bins = np.array([layout.bins(f, v) for f, v in enumerate(x)], np.uint8).reshape(width, -1).T
            ends = np.arange(batch.num_rows + 1, dtype=np.int32) * width
            code = pa.Array.from_buffers(pa.binary(), batch.num_rows, [
                None, pa.py_buffer(ends.tobytes()), pa.py_buffer(np.ascontiguousarray(bins).tobytes())])
            yield pa.RecordBatch.from_arrays([code, batch.column(width)], names=["code", "label"])

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _of_rows(batches, block_rows):
            bins = b"".join(batch.column("code").to_pylist())
            arrays = [batch.column(c).to_numpy(zero_copy_only=False).astype(t).tobytes()
                      for c, t in (("label", np.int8), ("count", np.int64), ("key", np.int64))]
            yield pa.RecordBatch.from_arrays(
                [pa.array([batch.num_rows]), *(pa.array([a], pa.binary()) for a in (bins, *arrays))],
                names=["rows", "bins", "label", "count", "key"])

    rows = df.select(*[F.col(f"`{c}`").cast("double").alias(f"f{i}") for i, c in enumerate(features)],
                     F.col("label").cast("long").alias("label"))
    equal = rows.mapInArrow(encode, "code binary, label long").groupBy("code", "label").agg(F.count("*").alias("count"))
    blocks = materialize(equal.withColumn("key", F.xxhash64("code", "label")).mapInArrow(pack, _BLOCK), "forest-blocks")
    size = blocks.agg(F.sum("rows").alias("rows"), F.count("*").alias("blocks")).first()
    return blocks, size["rows"] or 0, size["blocks"]


def _of_rows(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of `n`, the last one smaller."""
    held, count = [], 0
    for batch in batches:
        at = 0
        while at < batch.num_rows:
            piece = batch.slice(at, min(n - count, batch.num_rows - at))
            held.append(piece)
            at, count = at + piece.num_rows, count + piece.num_rows
            if count == n:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held, count = [], 0
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def _poisson_table(n: int) -> np.ndarray:
    """Probabilities of at most 0, 1, 2 ... as far as doubles tell them from 1."""
    k = np.arange(n + int(12 * math.sqrt(n)) + 20)
    log_factorial = np.concatenate([[0.0], np.cumsum(np.log(k[1:]))])
    return np.minimum(np.cumsum(np.exp(k * math.log(n) - n - log_factorial)), 1.0)


class Block:
    """Distinct binned rows with their counts."""

    def __init__(self, row: dict):
        n = row["rows"]
        self.bins = np.frombuffer(row["bins"], np.uint8).reshape(n, -1)
        self.flat = self.bins.reshape(-1)
        self.starts = np.arange(n) * self.bins.shape[1]
        self.label = np.frombuffer(row["label"], np.int8).astype(np.int64)
        self.count = np.frombuffer(row["count"], np.int64)
        self.key = np.frombuffer(row["key"], np.int64).view(np.uint64)
        sizes, self.size_of = np.unique(np.minimum(self.count, TABLE_COUNT + 1), return_inverse=True)
        tables = [_poisson_table(int(s)) for s in sizes if s <= TABLE_COUNT]
        self.table = np.concatenate([i + t for i, t in enumerate(tables)]) if tables else np.empty(0)
        self.table_starts = np.cumsum([0, *map(len, tables)])
        self.many = np.flatnonzero(self.count > TABLE_COUNT)

    def drawn(self, seed: int, tree: int) -> np.ndarray:
        """How often a tree sees each row: a Poisson number for every one of the equal rows, added up."""
        salt = boosting._mix(np.array([((seed & 0xFFFFFFFF) << 32) + tree + 1], np.uint64))
        bits = boosting._mix(self.key ^ salt)
        even = (bits >> np.uint64(11)).astype(float) * 2.0**-53
        found = np.searchsorted(self.table, self.size_of + even, "right") - self.table_starts.take(
            np.minimum(self.size_of, len(self.table_starts) - 1))
        if len(self.many):
            n, angle = self.count[self.many], (boosting._mix(bits[self.many]) >> np.uint64(11)).astype(float) * 2.0**-53
            normal = np.sqrt(-2 * np.log(1 - even[self.many])) * np.cos(2 * np.pi * angle)
            found[self.many] = np.maximum(np.rint(n + np.sqrt(n) * normal), 0).astype(np.int64)
        return found


# --- one tree -----------------------------------------------------------------------------

class Tree:
    """Nodes level by level: where a node looks, what it compares with, its left child (the right one follows) and
    its drawn rows per class. A leaf is its own child. `open` are the nodes to be divided next."""

    def __init__(self):
        self.feature, self.split, self.left = np.zeros(1, np.int16), np.full(1, 255, np.uint8), np.zeros(1, np.int32)
        self.counts = np.zeros((1, K), np.int64)
        self.levels = [0]
        self.open = np.zeros(1, np.int64)

    def descend(self, block: Block, rows: np.ndarray, place: np.ndarray) -> np.ndarray:
        """One level down. Leaves stay, as no bin is above their 255."""
        value = block.flat.take(block.starts.take(rows) + self.feature.take(place))
        return self.left.take(place) + (value > self.split.take(place))

    def choice(self, params: ForestParams, number: int, n_features: int) -> np.ndarray:
        """Features that each open node may use, in order."""
        take = math.ceil(math.sqrt(n_features))
        draw = np.random.default_rng([params.seed & 0xFFFFFFFF, number, len(self.levels)]).random((len(self.open), n_features))
        return np.sort(draw.argsort(axis=1, kind="stable")[:, :take], axis=1)

    def grow(self, found: tuple[np.ndarray, ...], params: ForestParams) -> None:
        """Divide the open nodes where a split was found."""
        feature, split, left, whole = found
        if len(self.levels) == 1:
            self.counts[0] = whole[0]
        at = np.flatnonzero(feature >= 0)
        nodes, first, size = self.open[at], len(self.left) + 2 * np.arange(len(at)), len(self.left)
        self.feature[nodes], self.split[nodes], self.left[nodes] = feature[at], split[at], first
        children = np.stack([left[at], whole[at] - left[at]], axis=1).reshape(-1, K)
        self.levels.append(size)
        self.feature = np.concatenate([self.feature, np.zeros(len(children), np.int16)])
        self.split = np.concatenate([self.split, np.full(len(children), 255, np.uint8)])
        self.left = np.concatenate([self.left, size + np.arange(len(children), dtype=np.int32)])
        self.counts = np.concatenate([self.counts, children])
        divisible = (children.sum(axis=1) >= 2 * params.min_leaf_rows) & ((children > 0).sum(axis=1) > 1)
        deepest = len(self.levels) > params.max_depth
        self.open = np.empty(0, np.int64) if deepest else size + np.flatnonzero(divisible)

    def joined(self, weights: np.ndarray) -> None:
        """Leaves of one parent that decide the same become one."""
        decided = (self.counts * weights).argmax(axis=1)
        leaf = self.left == np.arange(len(self.left))
        for a, b in reversed(list(zip(self.levels, [*self.levels[1:], len(self.left)]))):
            inner = a + np.flatnonzero(~leaf[a:b])
            child = self.left[inner]
            same = inner[leaf[child] & leaf[child + 1] & (decided[child] == decided[child + 1])]
            self.feature[same], self.split[same], self.left[same], leaf[same] = 0, 255, same, True


def _cells(choice: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of each choice, where a node's bins begin, and the number of bins of all nodes."""
    own = sizes[choice]
    return np.cumsum(own, axis=0) - own, own.sum(axis=0)


def measure(tree: Tree, number: int, block: Block, rows: np.ndarray, times: np.ndarray, place: np.ndarray,
            layout: Layout, params: ForestParams) -> np.ndarray:
    """Drawn rows per choice, open node, bin and class. `place` is where the drawn `rows` stand."""
    choice = tree.choice(params, number, len(layout.sizes))
    begins, totals = _cells(choice, layout.sizes)
    slots = np.full(len(tree.left), -1)
    slots[tree.open] = np.arange(len(tree.open))
    slot = slots.take(place)
    here = np.flatnonzero(slot >= 0)
    slot, rows, times = slot.take(here), rows.take(here), times.take(here)
    starts, label, out = block.starts.take(rows), block.label.take(rows), []
    for j, total in enumerate(totals.tolist()):
        code = block.flat.take(starts + choice[:, j].take(slot)) + begins[:, j].take(slot)
        out.append(np.bincount(code * K + label, times, total * K))
    return np.concatenate(out)


def search(tree: Tree, number: int, sums: np.ndarray, weights: np.ndarray, layout: Layout,
           params: ForestParams) -> tuple[np.ndarray, ...]:
    """Per open node the best feature (-1: none), the last bin on its left, and the rows per class there and in all."""
    choice = tree.choice(params, number, len(layout.sizes))
    begins, totals = _cells(choice, layout.sizes)
    n, at = len(tree.open), 0
    gains, feature, split = np.zeros(n), np.full(n, -1, np.int16), np.zeros(n, np.uint8)
    left, whole = np.zeros((n, K), np.int64), np.zeros((n, K), np.int64)
    for j, total in enumerate(totals.tolist()):
        cells = np.rint(sums[at : at + total * K]).astype(np.int64).reshape(total, K)
        at += total * K
        begin, own = begins[:, j], layout.sizes[choice[:, j]]
        run = cells.cumsum(axis=0)
        low = run - np.repeat(run[begin] - cells[begin], own, axis=0)
        if j == 0:
            whole = low[begin + own - 1]
        every = np.repeat(whole, own, axis=0)
        high = every - low
        spread = [_unevenness(side, weights) for side in (every, low, high)]
        gain = spread[0] - spread[1] - spread[2]  # times the weight of the node
        valid = (low.sum(axis=1) >= params.min_leaf_rows) & (high.sum(axis=1) >= params.min_leaf_rows)
        gain = np.where(valid & (gain > 1e-9 * np.maximum(spread[0], 1e-300)), gain, 0.0)
        most = np.maximum.reduceat(gain, begin)
        top = np.flatnonzero((gain == np.repeat(most, own)) & (gain > 0))
        node, first = np.unique(np.repeat(np.arange(n), own)[top], return_index=True)
        better = most[node] > gains[node]
        node, top = node[better], top[first[better]]
        gains[node], feature[node] = most[node], choice[node, j]
        split[node], left[node] = top - begin[node], low[top]
    return feature, split, left, whole


def _unevenness(counts: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Gini impurity times the weight of the rows."""
    weighted = counts * weights
    total = weighted.sum(axis=1)
    return total - (weighted**2).sum(axis=1) / np.where(total > 0, total, 1)


# --- all trees ----------------------------------------------------------------------------

def _grown(number: int, blocks: list[Block], weights: np.ndarray, layout: Layout, params: ForestParams) -> Tree:
    """A whole tree over blocks that one task holds."""
    tree, held = Tree(), []
    for block in blocks:
        times = block.drawn(params.seed, number)
        rows = np.flatnonzero(times)
        held.append([block, rows, times.take(rows).astype(float), np.zeros(len(rows), np.int64)])
    while len(tree.open):
        sums = sum(measure(tree, number, *own, layout, params) for own in held)
        tree.grow(search(tree, number, sums, weights, layout, params), params)
        for own in held:
            own[3] = tree.descend(own[0], own[1], own[3])
    return tree


def _in_tasks(blocks: DataFrame, layout: Layout, weights: np.ndarray, params: ForestParams) -> dict[int, Tree]:
    """Few binned rows: each task grows some of the trees."""
    turns = min(params.trees, 2 * blocks.sparkSession.sparkContext.defaultParallelism)

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[Block]] = {}
        for batch in batches:
            for row in batch.to_pylist():
                held.setdefault(row["turn"], []).append(Block(row))
        for turn, own in held.items():
            for number in range(turn, params.trees, turns):
                tree = _grown(number, own, weights, layout, params)
                tree.joined(weights)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([number], pa.int64()), *(pa.array([getattr(tree, f).tobytes()], pa.binary()) for f in _PARTS),
                     pa.array([len(tree.levels)], pa.int64())], names=["number", *_PARTS, "levels"])

    each = blocks.withColumn("turn", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(turns - 1).cast("long")))) \
        .repartitionByRange(turns, "turn")
    rows = each.mapInArrow(train, f"number long, {', '.join(f'{f} binary' for f in _PARTS)}, levels long").collect()
    return {r["number"]: _unpacked(r) for r in rows}  # trees, not rows of data


_PARTS = {"feature": np.int16, "split": np.uint8, "left": np.int32, "counts": np.int64}


def _unpacked(row) -> Tree:
    tree = Tree()
    for f, kind in _PARTS.items():
        setattr(tree, f, np.frombuffer(row[f], kind).reshape((-1, K) if f == "counts" else -1))
    tree.levels, tree.open = [0] * row["levels"], np.empty(0, np.int64)
    return tree


def _waves(trees: dict[int, Tree], layout: Layout, wave_bytes: int) -> Iterator[list[int]]:
    """Unfinished trees whose sums a task can hold together."""
    take, wave, held = math.ceil(math.sqrt(len(layout.sizes))), [], 0
    for number, tree in trees.items():
        size = int(len(tree.open) * take * layout.sizes.mean() * K * 8)
        if wave and held + size > wave_bytes:
            yield wave
            wave, held = [], 0
        if size:
            wave.append(number)
            held += size
    if wave:
        yield wave


def _in_passes(blocks: DataFrame, n_blocks: int, layout: Layout, weights: np.ndarray, params: ForestParams,
               wave_bytes: int) -> dict[int, Tree]:
    """Many binned rows: a job per level and wave of trees."""
    context, trees = blocks.sparkSession.sparkContext, {number: Tree() for number in range(params.trees)}
    parts = max(1, min(params.trees, context.defaultParallelism))
    spread = blocks.repartition(n_blocks).persist()
    try:
        while any(len(tree.open) for tree in trees.values()):
            for wave in list(_waves(trees, layout, wave_bytes)):
                shared = context.broadcast({number: trees[number] for number in wave})

                def divide(row, shared=shared) -> Iterator[tuple[int, np.ndarray]]:
                    block = Block(row.asDict())
                    for number, tree in shared.value.items():
                        times = block.drawn(params.seed, number)
                        rows = np.flatnonzero(times)
                        place = np.zeros(len(rows), np.int64)
                        for _ in tree.levels[1:]:
                            place = tree.descend(block, rows, place)
                        yield number, measure(tree, number, block, rows, times.take(rows).astype(float), place, layout, params)

                def searched(item, shared=shared) -> tuple[int, tuple]:
                    number, sums = item
                    return number, search(shared.value[number], number, sums, weights, layout, params)

                met = spread.rdd.flatMap(divide).reduceByKey(np.add, parts, lambda number: number).map(searched)
                for number, found in met.collect():  # a split per node
                    trees[number].grow(found, params)
                shared.unpersist()
    finally:
        spread.unpersist()
    for tree in trees.values():
        tree.joined(weights)
    return trees


def fit(train: DataFrame, features: list[str], weights: dict[int, float], params: ForestParams = ForestParams(),
        block_rows: int = BLOCK_ROWS, task_rows: int = TASK_ROWS, wave_bytes: int = WAVE_BYTES) -> ForestModel:
    """Fit on the features and `label` (0, 1, 2), each class with its weight. A null or NaN feature is an error.

    More than `task_rows` binned rows are divided among tasks, with jobs per level; the trees are the same.
    """
    layout = boosting.find_layout(train, features, BINS, CUT_ACCURACY)
    blocks, rows, n_blocks = store_blocks(train, features, layout, block_rows)
    if not rows:
        raise ValueError("no rows")
    each = np.array([weights.get(c, 0.0) for c in range(K)])
    if rows <= task_rows:
        trees = _in_tasks(blocks, layout, each, params)
    else:
        trees = _in_passes(blocks, n_blocks, layout, each, params, wave_bytes)
    return ForestModel(tuple(features), layout, tuple(_scorer(trees[number], each) for number in range(params.trees)))


# --- the model ----------------------------------------------------------------------------

@dataclass(frozen=True)
class Scorer:
    """A tree's nodes with the shares of the classes, and its depth."""

    feature: np.ndarray
    split: np.ndarray
    left: np.ndarray
    shares: np.ndarray
    depth: int


def _scorer(tree: Tree, weights: np.ndarray) -> Scorer:
    weighted = tree.counts * weights
    total = weighted.sum(axis=1, keepdims=True)
    return Scorer(tree.feature, tree.split, tree.left, weighted / np.where(total > 0, total, 1), len(tree.levels) - 1)


@dataclass(frozen=True)
class ForestModel:
    """Trees; transforms to three probabilities, the mean of what the trees give."""

    features: tuple[str, ...]
    layout: Layout = field(repr=False)
    trees: tuple[Scorer, ...] = field(repr=False)

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        """Classes by rows, from features by rows."""
        bins = np.array([self.layout.bins(f, v) for f, v in enumerate(x)], np.uint8).reshape(len(x), -1)
        flat, starts, total = np.ascontiguousarray(bins.T).reshape(-1), np.arange(bins.shape[1]) * len(x), np.zeros((bins.shape[1], K))
        for tree in self.trees:
            place = np.zeros(len(starts), np.int64)
            for _ in range(tree.depth):
                place = tree.left.take(place) + (flat.take(starts + tree.feature.take(place)) > tree.split.take(place))
            total += tree.shares.take(place, axis=0)
        return (total / np.maximum(total.sum(axis=1, keepdims=True), 1e-300)).T

    def transform(self, df: DataFrame, prefix: str = "") -> DataFrame:
        """The rows with a probability per class; the model is sent to every executor once."""
        return boosting.scored(self, df, prefix)

    def save(self, path: str) -> str:
        """Trees and cuts as two Parquet tables."""
        spark = SparkSession.getActiveSession()
        cuts = [(i, n, [float(v) for v in c]) for i, (n, c) in enumerate(zip(self.features, self.layout.cuts))]
        trees = [(i, t.depth, *(bytearray(np.asarray(getattr(t, f), kind).tobytes()) for f, kind in _STORED.items()))
                 for i, t in enumerate(self.trees)]
        spark.createDataFrame(cuts, "place int, name string, cuts array<double>").write.mode("overwrite").parquet(f"{path}/cuts")
        spark.createDataFrame(trees, f"number int, depth int, {', '.join(f'{f} binary' for f in _STORED)}") \
            .write.mode("overwrite").parquet(f"{path}/forest")
        return path

    @classmethod
    def load(cls, path: str) -> ForestModel:
        spark = SparkSession.getActiveSession()
        cuts = sorted(spark.read.parquet(f"{path}/cuts").collect())
        rows = sorted(spark.read.parquet(f"{path}/forest").collect(), key=lambda r: r["number"])
        trees = tuple(Scorer(*(np.frombuffer(r[f], kind).reshape((-1, K) if f == "shares" else -1) for f, kind in _STORED.items()),
                             r["depth"]) for r in rows)
        return cls(tuple(r["name"] for r in cuts), Layout(tuple(np.array(r["cuts"], float) for r in cuts)), trees)


_STORED = {"feature": np.int16, "split": np.uint8, "left": np.int32, "shares": np.float64}
