"""Gradient-boosted trees with one softmax objective for all classes, on binned histograms.

Every row is binned once into a byte per feature, at quantile cuts, and blocks of rows are written to
the shared folder. A round grows one tree per class. Each level of all its trees is one pass over the
blocks: a block adds up gradients and second-order terms per class, node and bin, the blocks' histograms
are summed and searched in parts, each with some of the features, and the driver gets the parts' best splits.
Leaves are second-order steps with L1 and L2 terms.

Gradients are rounded to integers of a fixed scale, so sums are exact: the model is bit for bit the same
for any number of blocks and any order of tasks. Which rows and columns a tree sees follows from hashes.

Several models grow in step: a pass serves all of them. Margins stay with the blocks; a pass that starts a
round first adds the trees of the round before. A lost executor's blocks are read and updated again. Up to
TASK_ROWS rows a job per pass would take longer than the pass, and the same passes run inside a task per model.

More rows are divided among the tasks of one barrier stage that stay until the end. Each keeps its rows, and for a
pass the tasks exchange their sums through files of the shared folder, so that every one grows the same trees. Where
that cannot be (a store that is no file system, executors that come and go, too many rows), each pass is a job.
"""

from __future__ import annotations

import math
import os
import pickle
import time
import uuid
from collections.abc import Callable, Generator, Iterable, Iterator
from dataclasses import dataclass, field
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import BarrierTaskContext, TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barsmith.operators.evaluation import CLASSES, PROBABILITIES
from barsmith.session import materialize, remove, scratch, shared_dir

#: Rows of a block.
BLOCK_ROWS = 65_536
#: Rows up to which a model's passes run in one task: a job for each pass takes longer than it saves.
TASK_ROWS = 8 * BLOCK_ROWS
#: Rows from which tasks of one stage exchange their sums, the most such tasks (each reads what all wrote), and the
#: bytes of rows that one of them holds.
GROUP_ROWS = TASK_ROWS
GROUP_TASKS = 16
GROUP_BYTES = 768 << 20
#: Seconds until such tasks must see each other's files, and that one waits for another's pass.
SEEN_SECONDS, PASS_SECONDS = 60, 900
#: Bins up to which features are joined, and the most combinations of a joint.
NARROW = 16
JOINT_CODES = 256
#: Nodes of a level up to which rows are compared with each node in turn, and the rows per node that repay it.
SCANNED = 48
SCANNED_ROWS = 256
#: Passes after which the blocks' margins are written to the shared folder.
CHECKPOINT_PASSES = 100
K = len(CLASSES)


@dataclass(frozen=True)
class BoostParams:
    """Fixed values of the published setting, except for the number of bins."""

    max_depth: int = 5
    learning_rate: float = 0.05
    rounds: int = 1000
    min_child_weight: float = 3
    row_share: float = 0.9
    column_share: float = 0.8
    seed: int = 42
    gamma: float = 0.1
    alpha: float = 0.1
    l2: float = 1.0


@dataclass(frozen=True)
class Layout:
    """Cuts of every feature; a value's bin is the number of cuts at or below it."""

    cuts: tuple[np.ndarray, ...]

    @property
    def sizes(self) -> np.ndarray:
        return np.array([len(c) + 1 for c in self.cuts], np.int64)

    @property
    def starts(self) -> np.ndarray:
        return np.cumsum(self.sizes) - self.sizes

    def bins(self, feature: int, values: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.cuts[feature], values, "right").astype(np.uint8)


def find_layout(df: DataFrame, features: list[str], bins: int = 64, accuracy: int = 10_000) -> Layout:
    """Quantile cuts of all features from one aggregation; equal quantiles make fewer bins."""
    if not 2 <= bins <= 256:
        raise ValueError("bins must fit into a byte")
    at = [i / bins for i in range(1, bins)] + [1.0]
    found = df.agg(*[F.percentile_approx(F.col(f"`{c}`").cast("double"), at, accuracy).alias(f"q{i}")
                     for i, c in enumerate(features)],
                   *[F.min(F.col(f"`{c}`").cast("double")).alias(f"m{i}") for i, c in enumerate(features)]).first()
    cuts = []
    for i in range(len(features)):
        values = np.unique(np.array(found[f"q{i}"] or [], float))
        cuts.append(values[values > (found[f"m{i}"] if found[f"m{i}"] is not None else 0)][: bins - 1])
    return Layout(tuple(cuts))


# --- blocks -------------------------------------------------------------------------------

def feature_matrix(columns: Iterable[pa.Array], names: list[str]) -> np.ndarray:
    """Features by rows; a missing value is an error rather than a silent zero."""
    out = []
    for name, column in zip(names, columns, strict=True):
        values = column.to_numpy(zero_copy_only=False).astype(float)
        if column.null_count or np.isnan(values).any():
            raise ValueError(f"null or NaN in {name}")
        out.append(values)
    return np.array(out)


_BLOCK = "part long, rows long, bins binary, label binary, weight binary, key binary, holdout binary"


def store_blocks(df: DataFrame, features: list[str], layout: Layout, weight: str | None,
                 block_rows: int = BLOCK_ROWS, tasks: int = 1) -> tuple[DataFrame, int, float]:
    """Binned blocks of all rows, their number of rows and largest weight. Many blocks are dealt evenly to `tasks`.

    `df` has features, label and _holdout. A row's key for sampling is a hash of what it holds, so equal
    rows are drawn together.
    """
    w = F.coalesce(F.col(weight), F.lit(1.0)) if weight else F.lit(1.0)
    rows = df.select(*[F.col(f"`{c}`").cast("double").alias(f"f{i}") for i, c in enumerate(features)],
                     F.col("label").cast("long").alias("label"), w.cast("double").alias("weight"), "_holdout")
    rows = rows.withColumn("key", F.xxhash64(*rows.columns))
    size = rows.agg(F.count("*").alias("n"), F.max("weight").alias("w")).first()
    parts = max(1, math.ceil(size["n"] / block_rows))
    if parts > tasks:
        parts = tasks * math.ceil(parts / tasks)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def block() -> pa.RecordBatch:
            bins, label, weights, key, holdout = (np.concatenate(a, axis=-1) for a in zip(*held))
            held.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array([TaskContext.get().partitionId()]), pa.array([len(label)]), *(pa.array([a.tobytes()], pa.binary()) for a in (
                    bins, label.astype(np.int8), weights, key, holdout))],
                names=["part", "rows", "bins", "label", "weight", "key", "holdout"])

        count = 0
        for batch in batches:
            at = 0
            while at < batch.num_rows:
                piece = batch.slice(at, min(block_rows - count, batch.num_rows - at))
                x = feature_matrix(piece.columns[: len(features)], features)
                held.append((np.array([layout.bins(f, v) for f, v in enumerate(x)], np.uint8).reshape(len(features), -1),
                             *(piece.column(c).to_numpy(zero_copy_only=False) for c in ("label", "weight", "key", "_holdout"))))
                at, count = at + piece.num_rows, count + piece.num_rows
                if count == block_rows:
                    yield block()
                    count = 0
        if held:
            yield block()

    spread = rows.repartition(parts, "key") if parts > 1 else rows.coalesce(1)
    return materialize(spread.mapInArrow(pack, _BLOCK), "blocks"), size["n"] or 0, size["w"] or 1.0


class Block:
    """Rows of a block with the margins of every model."""

    def __init__(self, row: dict, n_features: int, models: Iterable[int]):
        n = row["rows"]
        self.bins = np.frombuffer(row["bins"], np.uint8).reshape(n_features, n)
        self.label = np.frombuffer(row["label"], np.int8)
        self.weight = np.frombuffer(row["weight"], float)
        self.key = np.frombuffer(row["key"], np.int64).view(np.uint64)
        self.holdout = np.frombuffer(row["holdout"], bool)
        self.margins = {m: np.zeros((K, n)) for m in models}
        self.entries: Columns | None = None
        self.places: dict[int, tuple[int, list[np.ndarray]]] = {}
        self.terms: dict[int, tuple[np.ndarray, ...]] = {}
        self.used: dict[int, np.ndarray] = {}

    def __getstate__(self) -> dict:
        return self.__dict__ | {"places": {}, "terms": {}, "used": {}}

    def columns(self, layout: Layout) -> Columns:
        if self.entries is None:
            joints = [_Joint([f], v.astype(np.int64), np.arange(layout.sizes[f])[:, None])
                      for f, v in enumerate(self.bins) if layout.sizes[f] > NARROW]
            self.entries = _share([*joints, *_joined(self.bins, layout)], len(self.label), layout)
        return self.entries


@dataclass
class _Joint:
    """Features counted together: the code of every row, and each code's bin per feature."""

    features: list[int]
    codes: np.ndarray
    bins: np.ndarray


@dataclass
class Columns:
    """What histograms add up: columns with a code per row; of each the number of codes, the joint codes they stand
    for and, if it has one joint, its features; then the joints' places and the most frequent codes of rare ones."""

    codes: np.ndarray  # rows by columns
    made: list[tuple[int, slice | np.ndarray, list[int] | None]]
    starts: np.ndarray
    usual: np.ndarray
    usual_of: np.ndarray
    to_bins: list[tuple[slice, slice | np.ndarray, np.ndarray | None]]
    width: int


def _joined(bins: np.ndarray, layout: Layout) -> list[_Joint]:
    """Narrow features joined as long as few of their combinations occur, like the flags of one category."""
    found: list[_Joint] = []
    for f in np.flatnonzero(layout.sizes <= NARROW):
        size, values = int(layout.sizes[f]), bins[f].astype(np.int64)
        for joint in found:
            both = joint.codes * size + values
            occurs = np.flatnonzero(np.bincount(both, minlength=len(joint.bins) * size))
            if len(occurs) <= JOINT_CODES:
                place = np.zeros(len(joint.bins) * size, np.int64)
                place[occurs] = np.arange(len(occurs))
                joint.codes = place.take(both)
                joint.bins = np.column_stack([joint.bins[occurs // size], occurs % size])
                joint.features.append(int(f))
                break
        else:
            found.append(_Joint([int(f)], values, np.arange(size)[:, None]))
    return found


def _share(joints: list[_Joint], n: int, layout: Layout) -> Columns:
    """A joint whose codes are spread is a column of its own. Of the others only codes outside the most frequent
    one are kept; as a row has few of them, they share columns, as many as the fullest row needs."""
    columns, made, rows, at, usual, usual_of, codes_of, to_bins = [], [], [], [], [], [], [np.empty(0, np.int64)], []
    sizes = np.array([len(j.bins) for j in joints], np.int64)
    starts, width = np.cumsum(sizes) - sizes, 0
    for i, (joint, start, size) in enumerate(zip(joints, starts.tolist(), sizes.tolist())):
        places = slice(layout.starts[joint.features[0]], layout.starts[joint.features[0]] + size)
        table = None
        if len(joint.features) > 1:  # which bins a code stands for, a one per feature
            places = np.concatenate([np.arange(layout.sizes[f]) + layout.starts[f] for f in joint.features])
            table = np.concatenate([joint.bins[:, k, None] == np.arange(layout.sizes[f])
                                    for k, f in enumerate(joint.features)], axis=1).astype(float)
        to_bins.append((slice(start, start + size), places, table))
        counts = np.bincount(joint.codes, minlength=size)
        most = int(counts.argmax())
        if 2 * counts[most] < n:
            columns.append(joint.codes.astype(np.min_scalar_type(size - 1)))
            made.append((size, slice(start, start + size), joint.features))
            continue
        other = np.flatnonzero(joint.codes != most)
        rows.append(other)
        at.append(width + joint.codes[other])
        usual.append(start + most)
        usual_of.append(i)
        codes_of.append(np.arange(start, start + size))
        width += size
    row = np.concatenate([*rows, np.empty(0, np.int64)])
    code = np.concatenate([*at, np.empty(0, np.int64)])
    order = np.argsort(row, kind="stable")
    row, code = row[order], code[order]
    per_row = np.bincount(row, minlength=n)
    nth = np.arange(len(row)) - (np.cumsum(per_row) - per_row)[row]
    for k in range(int(per_row.max(initial=0))):
        own, column = nth == k, np.full(n, width)  # the last code stands for no value
        column[row[own]] = code[own]
        columns.append(column.astype(np.min_scalar_type(width)))
        made.append((width + 1, np.concatenate(codes_of), None))
    codes = np.stack(columns, axis=1) if columns else np.empty((n, 0), np.uint8)
    return Columns(codes, made, starts, np.array(usual, np.int64), np.array(usual_of, np.int64), to_bins, int(sizes.sum()))


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def drawn(key: np.ndarray, seed: int, number: int, share: float) -> np.ndarray:
    """Which rows a round sees."""
    if share >= 1:
        return np.ones(len(key), bool)
    salt = _mix(np.array([(seed << 32) + number + 1], np.uint64))
    return _mix(key ^ salt) < np.uint64(int(share * 2**64))


def softmax(margins: np.ndarray) -> np.ndarray:
    e = np.exp(margins - margins.max(axis=0))
    return e / e.sum(axis=0)


# --- one pass -----------------------------------------------------------------------------

@dataclass
class Trees:
    """A tree per class; the children of node i are 2i + 1 and 2i + 2, feature -1 is a leaf."""

    feature: np.ndarray
    split: np.ndarray  # values in bins above it go right
    value: np.ndarray

    @classmethod
    def empty(cls, depth: int) -> Trees:
        size = (2 << depth) - 1
        return cls(np.full((K, size), -1, np.int16), np.zeros((K, size), np.int16), np.zeros((K, size)))


@dataclass
class Request:
    """What a model needs from a pass: add the last round's trees, then measure nodes of the new ones."""

    round: int
    level: int
    params: BoostParams
    scale: float
    trees: Trees | None
    slots: np.ndarray | None  # per class and node of the level: where its histogram goes, or -1
    n_slots: int = 0
    add: Trees | None = None
    classes: np.ndarray | None = None  # of each slot
    allowed: np.ndarray | None = None  # per class and feature: whether bins are needed, else only the sum of all


def _start(n: int, trees: Trees) -> np.ndarray:
    """All rows at the root, in the narrowest numbers that hold every node."""
    return np.zeros(n, np.min_scalar_type(trees.feature.shape[1]))


def _descend(place: np.ndarray, level: int, trees: Trees, c: int, bins: np.ndarray) -> np.ndarray:
    """One level down for rows that stand on `level` or on a leaf above. Leaves stay.

    Whole columns of `bins`, a row per feature, are compared for each node: with few nodes and many rows that is
    faster than to look up each row's node and value."""
    first = (1 << level) - 1
    inner = first + np.flatnonzero(trees.feature[c, first : 2 * first + 1] >= 0)
    if len(inner) > min(SCANNED, len(place) // SCANNED_ROWS):
        at = place.astype(np.intp)
        feature, split = trees.feature[c].astype(np.intp).take(at), trees.split[c].take(at)
        value = bins.reshape(-1).take(np.maximum(feature, 0) * len(at) + np.arange(len(at)))
        return np.where(feature >= 0, 2 * place + 1 + (value > split), place)
    down, right = np.zeros(len(place), bool), np.zeros(len(place), bool)
    for i, feature, split in zip(inner.tolist(), trees.feature[c, inner].tolist(), trees.split[c, inner].tolist()):
        here = place == i
        down |= here
        here &= bins[feature] > split
        right |= here
    return np.where(down, 2 * place + 1 + right, place)


def _leaves(bins: np.ndarray, trees: Trees, c: int) -> np.ndarray:
    """The end of every row in the tree of a class; `bins` has a row per feature."""
    place = _start(bins.shape[1], trees)
    for level in range((trees.feature.shape[1] + 1).bit_length() - 2):
        place = _descend(place, level, trees, c, bins)
    return place


def add_trees(block: Block, model: int, trees: Trees) -> None:
    at_end = block.places.get(model)
    for c in range(K):
        if at_end is None:
            leaf = _leaves(block.bins, trees, c)
        else:  # rows stand on the last measured level, and no branch goes deeper than one below it
            leaf = _descend(at_end[1][c], at_end[0], trees, c, block.bins)
        block.margins[model][c] += trees.value[c].take(leaf.astype(np.intp))
    for kept in (block.places, block.terms, block.used):
        kept.pop(model, None)


def loss_of(block: Block, model: int) -> tuple[int, int]:
    """Log loss of the holdout rows in units of 2^-30, and their number."""
    own = block.holdout
    if not own.any():
        return 0, 0
    p = softmax(block.margins[model][:, own])[block.label[own].astype(int), np.arange(own.sum())]
    return int(np.rint(-np.log(np.maximum(p, 1e-15)) * 2**30).astype(np.int64).sum()), int(own.sum())


def measure(block: Block, model: int, request: Request, layout: Layout) -> np.ndarray:
    """Sums of both derivatives per slot and bin, as whole numbers."""
    params, n = request.params, len(block.label)
    if model not in block.terms:
        p = softmax(block.margins[model])
        g = p.copy()
        g[block.label.astype(int), np.arange(n)] -= 1
        h = np.maximum(2 * p * (1 - p), 1e-16)
        both = np.empty((K, n), complex)  # one addition for both
        np.rint(g * block.weight * request.scale, out=both.real)
        np.rint(h * block.weight * request.scale, out=both.imag)
        use = drawn(block.key, params.seed, request.round, params.row_share) & ~block.holdout
        block.terms[model], block.used[model] = (both.real, both.imag, use), both
    use, both = block.terms[model][2], block.used[model]
    level, places = block.places.get(model, (0, None))
    if places is None:
        places = [np.zeros(n, np.min_scalar_type((2 << params.max_depth) - 1))] * K
    for above in range(level, request.level):
        places = [_descend(places[c], above, request.trees, c, block.bins) for c in range(K)]
    block.places[model] = request.level, places
    columns, first = block.columns(layout), (1 << request.level) - 1
    out = np.zeros((2, request.n_slots, int(layout.sizes.sum())))
    for c in range(K):
        own = np.flatnonzero(request.slots[c] >= 0)
        if not len(own):
            continue
        local = np.full(first + len(request.slots[c]), -1)  # of any node down to the level
        local[first + own] = np.arange(len(own))
        if len(own) > SCANNED:
            here = local.take(places[c].astype(np.intp)) >= 0
        else:
            here = np.zeros(n, bool)
            for i in (first + own).tolist():
                here |= places[c] == i
        here &= use
        rows = np.flatnonzero(here)
        slot, term = local.take(places[c].take(rows).astype(np.intp)), both[c].take(rows)
        needed = request.allowed[c] if request.allowed is not None else np.ones(len(layout.sizes), bool)
        out[:, request.slots[c][own]] = _bins_of_slots(columns, rows, slot, term, len(own), layout, needed)
    return out


def _bins_of_slots(columns: Columns, rows: np.ndarray, slot: np.ndarray, term: np.ndarray, n_slots: int,
                   layout: Layout, needed: np.ndarray) -> np.ndarray:
    """Sums of the terms per slot and bin. A feature that is not needed may have all in one bin."""
    sums = np.zeros(n_slots, complex)
    np.add.at(sums, slot, term)
    by_code = np.zeros((n_slots, columns.width), complex)
    firsts: dict[int, np.ndarray] = {}
    drawn_codes = columns.codes.take(rows, axis=0)
    for i, (width, codes, features) in enumerate(columns.made):
        if features is not None and not needed[features].any():
            by_code[:, codes.start] = sums  # any code: each of its features then has all in one bin
            continue
        if width not in firsts:
            firsts[width] = slot * width
        found = np.zeros(n_slots * width, complex)
        np.add.at(found, drawn_codes[:, i] + firsts[width], term)
        if isinstance(codes, slice):
            by_code[:, codes] = found.reshape(-1, width)
        else:
            by_code[:, codes] += found.reshape(-1, width)[:, :-1]
    if len(columns.usual):
        by_code[:, columns.usual] += sums[:, None] - np.add.reduceat(by_code, columns.starts, axis=1)[:, columns.usual_of]
    out = np.zeros((2, n_slots, int(layout.sizes.sum())))
    for codes, places, table in columns.to_bins:
        own = np.array([by_code.real[:, codes], by_code.imag[:, codes]])  # laid out for a fast product
        out[:, :, places] = own if table is None else own @ table
    return out


# --- one model ----------------------------------------------------------------------------

def _shrunk(g: np.ndarray, alpha: float) -> np.ndarray:
    return np.sign(g) * np.maximum(np.abs(g) - alpha, 0)


def _quality(g: np.ndarray, h: np.ndarray, params: BoostParams) -> np.ndarray:
    return _shrunk(g, params.alpha) ** 2 / (h + params.l2)


def best_splits(hist: np.ndarray, allowed: np.ndarray, layout: Layout, scale: float,
                params: BoostParams) -> tuple[np.ndarray, ...]:
    """Per node: the best place (-1: none), both sums left of it, and of the node; the first of equal ones wins.

    Last comes the gain, to compare the bests of several parts of the features."""
    starts, sizes = layout.starts, layout.sizes
    run = hist.cumsum(axis=2)
    before = np.repeat(run[:, :, starts] - hist[:, :, starts], sizes, axis=2)
    left = (run - before) / scale
    whole = hist[:, :, starts[0] : starts[0] + sizes[0]].sum(axis=2)[:, :, None] / scale
    right = whole - left
    gain = _quality(left[0], left[1], params) + _quality(right[0], right[1], params) - _quality(whole[0], whole[1], params)
    last = np.zeros(hist.shape[2], bool)
    last[starts + sizes - 1] = True  # nothing is above a feature's last bin
    valid = (left[1] >= params.min_child_weight) & (right[1] >= params.min_child_weight) & (left[1] > 0) & (right[1] > 0)
    valid &= ~last & np.repeat(allowed, sizes, axis=1) & (gain > 1e-6) & (gain >= params.gamma)
    gain = np.where(valid, gain, -1.0)
    best = gain.argmax(axis=1)
    node = np.arange(len(best))
    return np.where(gain[node, best] > 0, best, -1), left[:, node, best], whole[:, :, 0], gain[node, best]


def _columns(params: BoostParams, number: int, n_features: int) -> np.ndarray:
    """Features that the trees of a round may use, drawn per tree."""
    take = max(1, int(params.column_share * n_features))
    out = np.zeros((K, n_features), bool)
    for c in range(K):
        out[c, np.random.default_rng([params.seed, number, c]).permutation(n_features)[:take]] = True
    return out


Grower = Generator[Request, tuple[np.ndarray | None, tuple[int, int]], list[Trees]]


def grow(params: BoostParams, layout: Layout, scale: float, patience: int | None, searched: bool = False) -> Grower:
    """Rounds of one model. Yields what it needs from the next pass and is sent the sums, or with `searched`
    the best splits. Sums are asked for the lighter child of a pair; its sibling is the parent less that.

    With a patience it ends when so many rounds brought no smaller loss on the holdout rows, and keeps
    the rounds up to the least loss.
    """
    kept: list[Trees] = []
    best, best_at, last = math.inf, 0, None
    feature_of = np.repeat(np.arange(len(layout.sizes)), layout.sizes)

    def worse(loss: tuple[int, int]) -> bool:
        nonlocal best, best_at
        if patience is None or not kept or not loss[1]:
            return False
        if loss[0] / loss[1] < best:
            best, best_at = loss[0] / loss[1], len(kept)
        return len(kept) - best_at >= patience

    for number in range(params.rounds):
        trees, allowed = Trees.empty(params.max_depth), _columns(params, number, len(layout.sizes))
        nodes = np.array([(c, 0) for c in range(K)])  # class and place
        slots = np.arange(K)[:, None]
        hist, loss = yield Request(number, 0, params, scale, None, slots, K, last, nodes[:, 0], allowed)
        if worse(loss):
            break
        for level in range(params.max_depth):
            place, left, whole, _ = hist if searched else best_splits(hist, allowed[nodes[:, 0]], layout, scale, params)
            if level == 0:
                for c in range(K):
                    trees.value[c, 0] = _step(whole[:, c], params)
            split = np.flatnonzero(place >= 0)
            c, at = nodes[split].T
            trees.feature[c, at] = feature_of[place[split]]
            trees.split[c, at] = place[split] - layout.starts[feature_of[place[split]]]
            sides = left[:, split], whole[:, split] - left[:, split]
            for k in range(2):
                trees.value[c, 2 * at + 1 + k] = _step(sides[k], params)
            if level + 1 == params.max_depth:
                break
            # Children that are heavy enough to be divided once more, and the lighter one of each pair.
            heavy = np.array([side[1] >= 2 * params.min_child_weight for side in sides]).reshape(2, -1)
            alive = heavy.any(axis=0)
            split, c, at, heavy = split[alive], c[alive], at[alive], heavy[:, alive]
            if not len(split):
                break
            light = (sides[0][1][alive] > sides[1][1][alive]).astype(int)
            owns = [np.flatnonzero(heavy[k]) for k in range(2)]  # left children, then right ones
            nodes = np.concatenate([np.stack([c[own], 2 * at[own] + 1 + k], axis=1) for k, own in enumerate(owns)])
            slots = np.full((K, 2 << level), -1)
            if searched:
                slots[nodes[:, 0], nodes[:, 1] - ((2 << level) - 1)] = np.arange(len(nodes))
                hist, _ = yield Request(number, level + 1, params, scale, trees, slots, len(nodes), None, nodes[:, 0], allowed)
                continue
            slots[c, 2 * at + 1 + light - ((2 << level) - 1)] = np.arange(len(split))
            measured, _ = yield Request(number, level + 1, params, scale, trees, slots, len(split), allowed=allowed)
            parent = hist[:, split]
            pair = [measured, parent - measured]
            hist = np.concatenate([np.where((light[own] == k)[None, :, None], pair[0][:, own], pair[1][:, own])
                                   for k, own in enumerate(owns)], axis=1)
        kept.append(trees)
        last = trees
    else:
        if patience is not None and kept:
            _, loss = yield Request(params.rounds, 0, params, scale, None, None, 0, last)
            worse(loss)
    return kept[:best_at] if best_at else kept


def _step(sums: np.ndarray, params: BoostParams) -> np.ndarray:
    return -params.learning_rate * _shrunk(sums[0], params.alpha) / (sums[1] + params.l2)


# --- all models ---------------------------------------------------------------------------

def _serve(block: Block, requests: dict[int, Request], layout: Layout) -> dict[int, tuple[np.ndarray | None, tuple[int, int]]]:
    """One block's part of a pass."""
    out = {}
    for model, request in requests.items():
        if request.level == 0 and request.add is not None:
            add_trees(block, model, request.add)
        loss = loss_of(block, model) if request.level == 0 else (0, 0)
        out[model] = measure(block, model, request, layout) if request.slots is not None else None, loss
    return out


def _sum(a: tuple, b: tuple) -> tuple:
    return None if a[0] is None else a[0] + b[0], (a[1][0] + b[1][0], a[1][1] + b[1][1])


def _plus(a: dict, b: dict) -> dict:
    return {m: _sum(a[m], b[m]) for m in a}


def run_growers(growers: dict[int, Grower], one_pass: Callable[[dict[int, Request]], dict]) -> dict[int, list[Trees]]:
    """Advance all models pass by pass until each has ended."""
    done: dict[int, list[Trees]] = {}
    waiting = {m: next(g) for m, g in growers.items()}
    while waiting:
        answers = one_pass(waiting)
        after = {}
        for m in waiting:
            try:
                after[m] = growers[m].send(answers[m])
            except StopIteration as end:
                done[m] = end.value
        waiting = after
    return done


def _in_tasks(blocks: DataFrame, layout: Layout, models: list[BoostParams], scale: float,
              patience: int | None) -> dict[int, list[Trees]]:
    """Few blocks: each model's passes run in a task of its own, the longest model's first."""
    turns = sorted(range(len(models)), key=lambda m: -models[m].rounds * models[m].max_depth)

    def train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[Block]] = {}
        for batch in batches:
            for row in batch.to_pylist():
                m = turns[row["turn"]]
                held.setdefault(m, []).append(Block(row, len(layout.cuts), [m]))
        for m, own in held.items():
            trees = run_growers({m: grow(models[m], layout, scale, patience)},
                                lambda r: reduce(_plus, (_serve(block, r, layout) for block in own)))[m]
            yield pa.RecordBatch.from_arrays(
                [pa.array([m] * len(trees), pa.int64()), pa.array(range(len(trees)), pa.int64()),
                 *(pa.array([getattr(t, f).tobytes() for t in trees], pa.binary()) for f in ("feature", "split", "value"))],
                names=["model", "round", "feature", "split", "value"])

    each = blocks.withColumn("turn", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(len(models) - 1).cast("long")))) \
        .repartitionByRange(len(models), "turn")
    found: dict[int, list[Trees]] = {m: [] for m in range(len(models))}
    rows = each.mapInArrow(train, "model long, round long, feature binary, split binary, value binary").collect()
    for r in sorted(rows, key=lambda r: (r["model"], r["round"])):  # trees, not rows of data
        found[r["model"]].append(Trees(np.frombuffer(r["feature"], np.int16).reshape(K, -1),
                                       np.frombuffer(r["split"], np.int16).reshape(K, -1),
                                       np.frombuffer(r["value"], float).reshape(K, -1)))
    return found


def _group_tasks(spark: SparkSession) -> int:
    """Tasks that run at the same time and see the shared folder as files; 0 if they may not."""
    context = spark.sparkContext
    files = spark._jvm.org.apache.hadoop.fs.Path(shared_dir(spark)).getFileSystem(spark._jsc.hadoopConfiguration())
    if files.getScheme() != "file" or context.getConf().get("spark.dynamicAllocation.enabled", "false").lower() == "true":
        return 0
    jvm = context._jsc.sc()
    slots = jvm.maxNumConcurrentTasks(jvm.resourceProfileManager().defaultResourceProfile())
    return min(slots, GROUP_TASKS) if slots > 1 else 0


def _row_bytes(n_features: int, models: int) -> int:
    """What a row takes in a task: bins twice while they are read, codes, label, weight and key, and of each model
    margins, derivatives, places and what a pass makes of them."""
    return 3 * n_features + 32 + 160 * models


class Exchange:
    """What every task of a stage has to say, turn by turn, in files of a folder they share."""

    def __init__(self, folder: str, place: int, tasks: int):
        self.folder, self.place, self.tasks, self.turn = folder, place, tasks, 0
        os.makedirs(folder, exist_ok=True)

    def _path(self, turn: int, place: int) -> str:
        return os.path.join(self.folder, f"{turn}-{place}")

    def __call__(self, said: object, seconds: float = PASS_SECONDS) -> list:
        own = self._path(self.turn, self.place)
        with open(f"{own}.part", "wb") as f:
            pickle.dump(said, f, protocol=5)
        os.replace(f"{own}.part", own)  # others see it whole or not at all
        until, heard = time.monotonic() + seconds, []
        for place in range(self.tasks):
            path = self._path(self.turn, place)
            while not os.path.exists(path):
                if time.monotonic() > until:
                    raise TimeoutError(f"task {self.place} waited {seconds} s for turn {self.turn} of task {place}")
                time.sleep(0.0005)
            with open(path, "rb") as f:
                heard.append(pickle.load(f))
        if self.turn:  # whoever writes a turn has read the one before
            os.remove(self._path(self.turn - 1, self.place))
        self.turn += 1
        return heard


def _in_group(blocks: DataFrame, layout: Layout, models: list[BoostParams], scale: float, patience: int | None,
              tasks: int) -> dict[int, list[Trees]] | None:
    """Many blocks: tasks of one stage hold some each and exchange sums; all grow the trees and the first returns
    them. None if the tasks do not see each other's files, or Spark makes more of them, which could not all run at
    once. A lost task starts the stage again."""
    numbers, n_features, spark = range(len(models)), len(layout.cuts), blocks.sparkSession
    shared = spark.sparkContext.broadcast(layout)
    target = spark._jvm.org.apache.hadoop.fs.Path(scratch(spark, "exchange"))
    folder = target.toUri().getPath()

    def train(rows: Iterator[dict]) -> Iterator[tuple]:
        context, layout = BarrierTaskContext.get(), shared.value
        attempt = context.allGather(uuid.uuid4().hex)[0]  # what a failed stage left is not read
        place = context.partitionId()
        own = [Block(row, n_features, numbers) for row in rows]
        for block in own:
            block.columns(layout)
        try:
            exchange = Exchange(os.path.join(folder, attempt), place, tasks)
            exchange(None, SEEN_SECONDS)
            seen = "yes"
        except OSError:  # no such folder here, or another one than the others'
            seen = "no"
        if "no" in context.allGather(seen):
            return

        def one_pass(requests: dict[int, Request]) -> dict:
            mine = reduce(_plus, (_serve(block, requests, layout) for block in own)) if own else {
                m: (np.zeros((2, r.n_slots, int(layout.sizes.sum()))) if r.slots is not None else None, (0, 0))
                for m, r in requests.items()}
            return reduce(_plus, exchange(mine))

        found = run_growers({m: grow(models[m], layout, scale, patience) for m in numbers}, one_pass)
        if place == 0:
            yield from found.items()

    try:
        dealt = blocks.rdd.map(lambda row: (row["part"] % tasks, row.asDict())).partitionBy(tasks, lambda place: place)
        if dealt.getNumPartitions() != tasks:
            return None
        trained = dealt.values().barrier().mapPartitions(train)
        # Behind a shuffle, as Spark starts a failed barrier stage again unless it is the last.
        found = dict(trained.partitionBy(1, lambda model: 0).collect())  # trees, not rows of data
    finally:
        remove(spark, target.toString())
        shared.unpersist()
    return found if len(found) == len(models) else None


def _slices(layout: Layout, parts: int) -> list[tuple[int, int]]:
    """Features in order, divided into parts of about as many bins."""
    turn = (layout.starts * parts) // max(int(layout.sizes.sum()), 1)
    edges = [*np.unique(turn, return_index=True)[1], len(layout.sizes)]
    return [(int(a), int(b)) for a, b in zip(edges, edges[1:])]


def _search(hist: np.ndarray, request: Request, layout: Layout, a: int, b: int) -> tuple[np.ndarray, ...]:
    """Best splits among the features from `a` up to `b`, at places of the whole layout."""
    allowed = _columns(request.params, request.round, len(layout.cuts))[request.classes, a:b]
    place, left, whole, gain = best_splits(hist, allowed, Layout(layout.cuts[a:b]), request.scale, request.params)
    return np.where(place >= 0, place + layout.starts[a], -1), left, whole, gain


def _better(first: tuple[np.ndarray, ...], second: tuple[np.ndarray, ...]) -> tuple[np.ndarray, ...]:
    """The better of both per node; the first if they are equal."""
    other = second[3] > first[3]
    return tuple(np.where(other, y, x) for x, y in zip(first, second))


def _in_passes(blocks: DataFrame, layout: Layout, models: list[BoostParams], scale: float,
               patience: int | None) -> dict[int, list[Trees]]:
    """Many blocks: one job per pass, for all models.

    Each block divides its histograms by features. The parts of all blocks meet in tasks that also search them, so
    that the driver gets a split per node and part instead of histograms.
    """
    numbers, n_features, spark = range(len(models)), len(layout.cuts), blocks.sparkSession
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(spark))
    shared = context.broadcast(layout)
    parts = _slices(layout, max(1, min(n_features, context.defaultParallelism) // len(models)))
    ends = np.append(layout.starts, layout.sizes.sum())

    def start(row) -> Block:
        block = Block(row.asDict(), n_features, numbers)
        block.columns(shared.value)
        return block

    state = blocks.rdd.map(start).persist()
    passes, saved = 0, None

    def one_pass(requests: dict[int, Request]) -> dict:
        nonlocal state, passes, saved
        before, outdated = None, None
        added = {m: r.add for m, r in requests.items() if r.add is not None and r.level == 0}
        if added:
            def update(block: Block) -> Block:
                for m, trees in added.items():
                    add_trees(block, m, trees)
                return block

            before, state = state, state.map(update).persist()
            passes += 1
            if passes % CHECKPOINT_PASSES == 0:
                state.checkpoint()
                outdated, saved = saved, state
        bare = {m: Request(**{**r.__dict__, "add": None}) for m, r in requests.items()}

        def divide(block: Block) -> Iterator[tuple]:
            for m, (hist, loss) in _serve(block, bare, shared.value).items():
                for i, (a, b) in enumerate(parts if hist is not None else parts[:1]):
                    yield (m, i), (None if hist is None else hist[:, :, ends[a] : ends[b]], loss)

        def search(item: tuple) -> tuple:
            (m, i), (hist, loss) = item
            return (m, i), None if hist is None else _search(hist, bare[m], shared.value, *parts[i]), loss

        places = {(m, i): m * len(parts) + i for m in numbers for i in range(len(parts))}
        met = state.flatMap(divide).reduceByKey(_sum, len(places), lambda key: places[key]).map(search)
        answer: dict[int, tuple] = {}
        for (m, _), found, loss in sorted(met.collect(), key=lambda r: r[0]):  # a split per node and part
            answer[m] = (found if m not in answer else _better(answer[m][0], found), loss)
        if before is not None:
            before.unpersist()
        if outdated is not None:
            remove(spark, outdated.getCheckpointFile())
        return answer

    try:
        return run_growers({m: grow(models[m], layout, scale, patience, True) for m in numbers}, one_pass)
    finally:
        state.unpersist()
        shared.unpersist()


def fit_models(train: DataFrame, features: list[str], models: list[BoostParams], weight: str | None = None,
               validation: DataFrame | None = None, patience: int | None = 50, bins: int = 64,
               block_rows: int = BLOCK_ROWS, task_rows: int = TASK_ROWS) -> list[BoostedModel]:
    """Fit several models together on one binned table.

    `train` has the features and `label` (0, 1, 2); null weights count as 1. With `validation` a model
    ends after `patience` rounds without a smaller loss there. More than `task_rows` rows are divided
    among tasks, which exchange their sums or run in a job per pass; the trees are the same. A null or NaN feature is an error. Without
    rows every class gets a third.
    """
    data = train.withColumn("_holdout", F.lit(False))
    if validation is not None:
        data = data.unionByName(validation.withColumn("_holdout", F.lit(True)), allowMissingColumns=True)
    layout = find_layout(train, features, bins)
    tasks = _group_tasks(train.sparkSession)
    blocks, rows, largest = store_blocks(data, features, layout, weight, block_rows, max(tasks, 1))
    if not rows:
        return [BoostedModel(tuple(features), layout, ()) for _ in models]
    # Whole numbers so small that sums of all rows stay below 2^52 and are exact in doubles.
    scale = 2.0 ** min(40, 51 - math.ceil(math.log2(max(rows * largest, 1))))
    given = blocks, layout, models, scale, patience if validation is not None else None
    found = None
    if rows <= task_rows:
        found = _in_tasks(*given)
    elif rows > GROUP_ROWS and tasks and rows * _row_bytes(len(features), len(models)) <= tasks * GROUP_BYTES:
        found = _in_group(*given, tasks)
    if found is None:
        found = _in_passes(*given)
    return [BoostedModel(tuple(features), layout, tuple(found[m])) for m in range(len(models))]


# --- the model ----------------------------------------------------------------------------

def scored(model: BoostedModel, df: DataFrame, prefix: str = "") -> DataFrame:
    """The rows with a probability per class, from any model with `features` and `probabilities`."""
    shared = df.sparkSession.sparkContext.broadcast(model)
    names, columns = list(model.features), [prefix + p for p in PROBABILITIES]
    places = [df.columns.index(c) for c in names]
    kept = [c for c in df.columns if c not in columns]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = feature_matrix([batch.column(i) for i in places], names)
            p = shared.value.probabilities(x)
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(batch.schema.get_field_index(c)) for c in kept), *map(pa.array, p)], names=[*kept, *columns])

    schema = ", ".join(f"`{n}` {k}" for n, k in df.select(*[f"`{c}`" for c in kept]).dtypes)
    return df.mapInArrow(run, ", ".join([schema, *(f"`{c}` double" for c in columns)]))


@dataclass(frozen=True)
class BoostedModel:
    """Trees of all rounds; transforms to three probabilities."""

    features: tuple[str, ...]
    layout: Layout = field(repr=False)
    rounds: tuple[Trees, ...] = field(repr=False)

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        """Classes by rows, from features by rows."""
        bins = np.array([self.layout.bins(f, v) for f, v in enumerate(x)], np.uint8).reshape(len(x), -1)
        margins = np.zeros((K, bins.shape[1]))
        for trees in self.rounds:
            for c in range(K):
                margins[c] += trees.value[c].take(_leaves(bins, trees, c).astype(np.intp))
        return softmax(margins)

    def transform(self, df: DataFrame, prefix: str = "") -> DataFrame:
        """The rows with a probability per class; the model is sent to every executor once."""
        return scored(self, df, prefix)

    def save(self, path: str) -> str:
        """Trees and cuts as two Parquet tables."""
        spark = SparkSession.getActiveSession()
        cuts = [(i, n, [float(v) for v in c]) for i, (n, c) in enumerate(zip(self.features, self.layout.cuts))]
        trees = [(r, c, *(getattr(t, f)[c].tolist() for f in ("feature", "split", "value")))
                 for r, t in enumerate(self.rounds) for c in range(K)]
        spark.createDataFrame(cuts, "place int, name string, cuts array<double>").write.mode("overwrite").parquet(f"{path}/cuts")
        spark.createDataFrame(trees, "round int, class int, feature array<int>, split array<int>, value array<double>") \
            .write.mode("overwrite").parquet(f"{path}/trees")
        return path

    @classmethod
    def load(cls, path: str) -> BoostedModel:
        spark = SparkSession.getActiveSession()
        cuts = sorted(spark.read.parquet(f"{path}/cuts").collect())
        rows = sorted(spark.read.parquet(f"{path}/trees").collect(), key=lambda r: (r["round"], r["class"]))
        rounds = []
        for i in range(0, len(rows), K):
            own = rows[i : i + K]
            rounds.append(Trees(*(np.array([r[f] for r in own], kind) for f, kind in (
                ("feature", np.int16), ("split", np.int16), ("value", float)))))
        return cls(tuple(r["name"] for r in cuts), Layout(tuple(np.array(r["cuts"], float) for r in cuts)), tuple(rounds))
