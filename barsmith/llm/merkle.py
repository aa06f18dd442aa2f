"""A Merkle manifest of a dataset with a witness for every row.

Rows are leaves. Per source they stand in order of their ids; every three neighbours become one node
until one is left, the subroot. Subroots stand in order of the sources and give the root likewise. A
row's witness lists its siblings, level by level, so that anybody can fold a leaf up to the root.

Witnesses grow by appending. `Frontier` takes nodes in order and holds the open subtrees, at most two
closed ones a level. A node that arrives completes the partial witness of its older siblings on their
right and starts its own with what stands on its left; all leaves below a subtree share its step, so
nothing is rewritten when a witness gets longer. A source is cut into aligned blocks of 3^7 leaves that
are appended in parallel, each in one stream of bounded size. The blocks' roots are then appended in the
same way as the next leaves, round by round, until every source has one node, and the subroots after them.
So a source of any size is split evenly, and no task holds more than a block.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barsmith import session
from barsmith.llm.native_text import small

ARITY = 3
#: Levels of a block, and its leaves.
LEVELS = 7
BLOCK = ARITY**LEVELS
#: Rows of one range partition in expectation, when positions are given.
PART_ROWS = 500_000

STEPS = "array<struct<left:string,right:string>>"


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


class Node:
    """A closed subtree: its hash, its siblings so far, and the subtree above once that closes."""

    __slots__ = ("hash", "left", "right", "parent")

    def __init__(self, value: str):
        self.hash, self.left, self.right, self.parent = value, "", "", None


class Frontier:
    """Appends nodes in order and keeps the witness of each as a chain of shared steps."""

    def __init__(self) -> None:
        self.open: list[list[Node]] = [[]]
        self.leaves: list[Node] = []

    def append(self, value: str) -> None:
        leaf = Node(value)
        self.leaves.append(leaf)
        self._place(0, leaf)

    def _place(self, level: int, node: Node) -> None:
        if level == len(self.open):
            self.open.append([])
        run = self.open[level]
        node.left = "".join(older.hash for older in run)
        for older in run:
            older.right += node.hash
        run.append(node)
        if len(run) == ARITY:
            self._complete(level)

    def _complete(self, level: int) -> None:
        run, self.open[level] = self.open[level], []
        above = Node(digest("".join(node.hash for node in run)))
        for node in run:
            node.parent = above
        self._place(level + 1, above)

    def close(self, levels: int) -> str:
        """Complete the open runs of so many levels, shorter ones too, and return the node above them."""
        for level in range(levels):
            if level < len(self.open) and self.open[level]:
                self._complete(level)
        return self.open[levels][0].hash

    def witness(self, leaf: Node, levels: int) -> Iterator[Node]:
        """The subtrees around a leaf whose siblings make up its witness."""
        for _ in range(levels):
            yield leaf
            leaf = leaf.parent


def levels_of(total: int) -> int:
    """Levels that lead from so many nodes to one."""
    levels, span = 0, 1
    while span < total:
        levels, span = levels + 1, span * ARITY
    return levels


def _encoded(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(values: list[Column]) -> Column:
    """SHA-256 of the values, each with its length in bytes before it; null is a dash."""
    return F.sha2(F.concat(*map(_encoded, values)), 256)


def numbered(nodes: DataFrame, order: list[str], partitions: int | None = None) -> DataFrame:
    """The rows with `pos`, their place in their `group` by order, and `total`, the rows of the group.

    Rows are sorted into ranges of (group, order), so a large group is spread. A row's place is its place
    in the range plus the rows of its group in the ranges before; only counts per range and group are joined.
    """
    spark = nodes.sparkSession
    parts = partitions or max(nodes.count() // PART_ROWS, int(spark.conf.get("spark.sql.shuffle.partitions")))
    ranged = session.materialize(
        nodes.repartitionByRange(parts, "group", *order).sortWithinPartitions("group", *order).select(
            "*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().alias("at")), "ordered")
    runs = ranged.groupBy("part", "group").agg(F.count("*").alias("rows"), F.min("at").alias("from"))
    group = Window.partitionBy("group")
    earlier = group.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = session.materialize(runs.select(
        "part", "group", F.sum("rows").over(group).alias("total"),
        (F.coalesce(F.sum("rows").over(earlier), F.lit(0)) - F.col("from")).alias("shift")), "starts")
    return ranged.join(small(starts), ["part", "group"]) \
        .withColumn("pos", F.col("at") + F.col("shift")).drop("part", "at", "shift")


def _append(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by (group, block, pos) with their steps; a block's first row carries the block's root."""
    held: pa.Table | None = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        held = pa.concat_tables([held, table]) if held is not None else table
        starts = _block_starts(held)
        if len(starts) > 1:  # the last block may go on in the next batch
            yield from _appended(held.slice(0, starts[-1]), starts[:-1])
            held = held.slice(starts[-1]).combine_chunks()
    if held is not None and held.num_rows:
        yield from _appended(held, _block_starts(held))


def _block_starts(table: pa.Table) -> np.ndarray:
    if not table.num_rows:
        return np.zeros(0, np.int64)
    group = np.array(table.column("group").to_pylist(), dtype=object)
    block = table.column("block").to_numpy()
    changed = (group[1:] != group[:-1]) | (block[1:] != block[:-1])
    return np.concatenate([[0], np.flatnonzero(changed) + 1])


def _appended(table: pa.Table, starts: np.ndarray) -> Iterator[pa.RecordBatch]:
    values, totals = table.column("node").to_pylist(), table.column("total").to_pylist()
    left, right, counts, roots = [], [], [], [None] * table.num_rows
    for low, high in zip(starts, [*starts[1:], table.num_rows]):
        levels = min(LEVELS, levels_of(totals[low]))
        frontier = Frontier()
        for value in values[low:high]:
            frontier.append(value)
        roots[low] = frontier.close(levels)
        for leaf in frontier.leaves:
            for node in frontier.witness(leaf, levels):
                left.append(node.left)
                right.append(node.right)
            counts.append(levels)
    steps = pa.ListArray.from_arrays(
        pa.array(np.concatenate([[0], np.cumsum(counts)]), pa.int32()),
        pa.StructArray.from_arrays([pa.array(left, pa.string()), pa.array(right, pa.string())], ["left", "right"]))
    out = table.append_column("steps", steps).append_column("block_root", pa.array(roots, pa.string()))
    yield from out.combine_chunks().to_batches()


def _round(nodes: DataFrame) -> DataFrame:
    """One round of appending: the rows with their block, their steps in it, and the roots of the blocks."""
    placed = nodes.withColumn("block", F.expr(f"pos div {BLOCK}"))
    schema = ", ".join(f"`{n}` {k}" for n, k in placed.dtypes) + f", steps {STEPS}, block_root string"
    return session.materialize(
        placed.repartition("group", "block").sortWithinPartitions("group", "block", "pos").mapInArrow(_append, schema),
        "appended")


@dataclass(frozen=True)
class Forest:
    """The rounds of appending of some groups: the rows, then roots of blocks, roots of blocks of those and so on."""

    rounds: tuple[DataFrame, ...]

    @property
    def roots(self) -> DataFrame:
        """group and its root."""
        return self.rounds[-1].where("block_root IS NOT NULL").select("group", F.col("block_root").alias("root"))

    def witnesses(self, above: DataFrame | None = None) -> DataFrame:
        """The rows of the first round with their whole witness in `steps`.

        `above` (group, steps, and more) goes on from the groups' roots; its other columns are added.
        """
        if above is not None:
            above = above.withColumn("pos", F.lit(0).cast("long"))
        for nodes in reversed(self.rounds):
            nodes = nodes.drop("block_root", "node", "total") if nodes is not self.rounds[0] else nodes
            if above is not None:
                upper = above.select("group", F.col("pos").alias("block"), F.col("steps").alias("upper"),
                                     *[c for c in above.columns if c not in ("group", "pos", "steps", "block")])
                upper = session.materialize(upper, "upper")
                nodes = nodes.join(small(upper), ["group", "block"]) \
                    .withColumn("steps", F.concat("steps", "upper")).drop("upper")
            above = nodes.drop("block", "block_root", "total") if nodes is not self.rounds[0] else nodes
        return above


def build(nodes: DataFrame) -> Forest:
    """Append the nodes (group, pos, total, node, and more) of every group until each has one root."""
    rounds, current = [], nodes
    while True:
        rounds.append(_round(current))
        current = rounds[-1].where("block_root IS NOT NULL").select(
            "group", F.col("block").alias("pos"), F.expr(f"(total + {BLOCK - 1}) div {BLOCK}").alias("total"),
            F.col("block_root").alias("node"))
        if current.where("total > 1").limit(1).count() == 0:
            return Forest(tuple(rounds))


def fold(leaf: Column, steps: Column) -> Column:
    """The root that a leaf and its witness give."""
    return F.aggregate(steps, leaf, lambda h, s: F.sha2(F.concat(s["left"], h, s["right"]), 256))


def proof_hash(steps: Column) -> Column:
    """SHA-256 of all siblings of a witness, in order."""
    return F.sha2(F.array_join(F.transform(steps, lambda s: F.concat(s["left"], s["right"])), ""), 256)


def manifest(docs: DataFrame, columns: list[str], id_col: str = "doc_id", source_col: str = "source",
             keep: dict[str, Column] | None = None) -> DataFrame:
    """One row per input row: id, source, leaf, steps (its witness), subroot, root, and the columns to keep.

    The leaf covers `columns` in their order. `keep` names further columns of the result, as expressions
    over the input. Leaves of a source ascend by id, null ids first, then by leaf, so repeated rows stand
    side by side and each has its own witness. A null source is a source of its own, before all others;
    the empty source is another. Null and empty values differ in a leaf. A source of one row has the leaf as
    its subroot; a dataset of one row has an empty witness and the leaf as root. Values of any length are
    hashed whole. An empty table gives an empty result. Other columns are not read.
    """
    keep = keep or {}
    # The group's first letter keeps null and empty apart and null first; order is bytewise.
    group = F.coalesce(F.concat(F.lit("="), F.col(source_col).cast("string")), F.lit(""))
    leaves = docs.select(group.alias("group"), F.col(id_col).alias("__id"),
                         leaf_hash([F.col(c) for c in columns]).alias("node"),
                         *[e.alias(f"__{c}") for c, e in keep.items()])
    forest = build(numbered(leaves, ["__id", "node"]))
    sources = forest.roots.select(F.lit("all").alias("group"), F.col("group").alias("source"), F.col("root").alias("node"))
    top = build(numbered(sources, ["source"]))
    above = top.witnesses().join(F.broadcast(top.roots), "group").select(
        F.col("source").alias("group"), F.col("node").alias("subroot"), "root", "steps")
    return forest.witnesses(above).select(
        F.col("__id").alias(id_col), F.when(F.col("group") != "", F.substring("group", 2, 1 << 30)).alias(source_col),
        F.col("node").alias("leaf"), "steps", "subroot", "root", *[F.col(f"__{c}").alias(c) for c in keep])
