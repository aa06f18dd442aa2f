"""Exact k nearest neighbours inside groups, without forming pairs as rows.

1. Equal vectors collapse to their k+1 smallest ids; no other copy can be a neighbour.
2. A bounded sample of vectors (pivots) divides every group into cells by nearest pivot.
3. Each point is searched in its own cell. Its k-th distance bounds the final answer.
4. The point is sent on only to cells that can hold something nearer. A cell is out of reach
   when one of three lower bounds exceeds that distance: the gap to the cell's outer radius,
   the gap to its inner radius, and the distance to the plane between the two pivots.

Cells are searched in blocks of about ``BLOCK`` x ``BLOCK`` rows, both sides salted by a
hash of the id, so a dense cell spreads over many tasks and a task's memory is bounded.
Ties are broken by id, and the result does not depend on pivots or partitioning.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barsmith.session import materialize

BLOCK = 4096
MAX_PIVOTS = 1024
_SLACK = 1e-9
_STRIP = 256


def _squared(rows: np.ndarray, others: np.ndarray) -> np.ndarray:
    """Squared distances, summed feature by feature in order."""
    total = np.zeros((len(rows), len(others)))
    diff = np.empty_like(total)
    for d in range(rows.shape[1]):
        np.subtract(rows[:, d, None], others[None, :, d], out=diff)
        diff *= diff
        total += diff
    return total


def _block_best(rows: np.ndarray, others: np.ndarray, row_ids: np.ndarray, ids: np.ndarray,
                k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, position and squared distance of the k best others of every row.

    A matrix product gives distances with a known rounding error. What may belong to the best
    within that error is then measured exactly, so the choice and its ties are exact.
    """
    centre = others.mean(axis=0)
    a, b = rows - centre, others - centre
    a2, b2 = (a * a).sum(axis=1), (b * b).sum(axis=1)
    near = a2[:, None] + b2[None, :] - 2.0 * (a @ b.T)
    near[row_ids[:, None] == ids[None, :]] = np.inf
    dims = rows.shape[1]
    spread = np.sqrt(a2.max()) + np.sqrt(b2.max())
    size = max(np.abs(rows).max(), np.abs(others).max())
    error = 8 * dims * np.finfo(float).eps * spread * (spread + size)
    kth = min(k, near.shape[1]) - 1
    limit = np.partition(near, kth, axis=1)[:, kth] + 2 * error
    row, at = np.nonzero((near <= limit[:, None]) & np.isfinite(near))
    distance = np.zeros(len(row))
    for d in range(dims):
        diff = rows[row, d] - others[at, d]
        distance += diff * diff
    order = np.lexsort((ids[at], distance, row))
    row, at, distance = row[order], at[order], distance[order]
    place = np.arange(len(row)) - np.searchsorted(row, row, side="left")
    keep = place < k
    return row[keep], at[keep], distance[keep]


def nearest(points: DataFrame, k: int, group: str = "label", key: str = "bar_id",
            vector: str = "vector", block: int = BLOCK,
            pivots: int | None = None) -> DataFrame:
    """``group, key, nn_rank, nn_id, distance2, nn_vector`` for every point, k rows each."""
    base = materialize(points.select(
        F.col(group).alias("g"), F.col(key).alias("id"), F.col(vector).alias("x")), "points")
    sizes = {r["g"]: r["n"] for r in base.groupBy("g").agg(F.count("id").alias("n")).collect()}
    centres = _pivots(base, sizes, block, pivots)
    placed = materialize(_place(base, centres), "placed")
    copies = Window.partitionBy("g", "x").orderBy("id")
    targets = materialize(
        placed.withColumn("copy", F.row_number().over(copies)).where(F.col("copy") <= k + 1)
        .drop("copy"), "targets")
    cells = targets.groupBy("g", "cell").agg(
        F.count("id").alias("n"), F.min("dist").alias("inner"), F.max("dist").alias("outer"),
    ).collect()
    target_sizes = {(r["g"], r["cell"]): r["n"] for r in cells}
    rings = {(r["g"], r["cell"]): (r["inner"], r["outer"]) for r in cells}

    home = _search(placed.select("g", "id", "x", "cell"), targets, target_sizes, k, block)
    if all(len(c) == 1 for c in centres.values()):
        return _best(home, k, group, key)
    home = materialize(home, "home")
    bound = home.groupBy("g", "id").agg(
        F.count("nn_id").alias("found"), F.max("distance2").alias("worst"))
    bounded = placed.join(bound, ["g", "id"], "left").select(
        "g", "id", "x", "cell",
        F.when(F.col("found") >= k, F.sqrt("worst")).alias("reach"),
    )
    away = materialize(_send(bounded, centres, rings), "sent")
    found = home.unionByName(_search(away, targets, target_sizes, k, block))
    return _best(found, k, group, key)


def _best(found: DataFrame, k: int, group: str, key: str) -> DataFrame:
    """The k nearest of every point among the bests of the blocks it was searched in."""
    ranked = Window.partitionBy("g", "id").orderBy("distance2", "nn_id")
    best = found.withColumn("nn_rank", F.row_number().over(ranked)).where(F.col("nn_rank") <= k)
    return best.select(
        F.col("g").alias(group), F.col("id").alias(key), "nn_rank", "nn_id", "distance2",
        "nn_vector",
    )


def _pivots(base: DataFrame, sizes: dict, block: int, wanted: int | None) -> dict:
    """At most ``MAX_PIVOTS`` sampled vectors per group, by a hash of the id."""
    centres = {}
    space = 1 << 40
    for g, n in sizes.items():
        count = wanted or max(1, min(MAX_PIVOTS, math.ceil(math.sqrt(n / block)) ** 2))
        share = max(1, math.ceil(space * min(1.0, 4 * count / n)))
        rows = (
            base.where(F.col("g") == g)
            .where(F.pmod(F.xxhash64("id"), F.lit(space)) < share)
            .select("x", F.xxhash64("id").alias("h")).orderBy("h").limit(4 * count).collect()
        ) or base.where(F.col("g") == g).select("x").limit(1).collect()
        distinct = list(dict.fromkeys(tuple(r["x"]) for r in rows))[:count]
        centres[g] = np.array(distinct, dtype=float)
    return centres


def _place(base: DataFrame, centres: dict) -> DataFrame:
    """Nearest pivot of every point and the distance to it."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            cell = np.zeros(len(frame), dtype=np.int32)
            dist = np.zeros(len(frame))
            for g, at in frame.groupby("g").indices.items():
                distances = np.sqrt(_squared(np.stack(frame["x"].values[at]), centres[g]))
                cell[at] = distances.argmin(axis=1)
                dist[at] = distances.min(axis=1)
            yield frame.assign(cell=cell, dist=dist)

    kind = dict(base.dtypes)
    schema = f"g {kind['g']}, id {kind['id']}, x array<double>, cell int, dist double"
    return base.mapInPandas(run, schema)


def _lower_bounds(distances: np.ndarray, cell: np.ndarray, between: np.ndarray,
                  inner: np.ndarray, outer: np.ndarray) -> np.ndarray:
    """How near anything in each cell can be, from the distances to all pivots."""
    own = distances[np.arange(len(cell)), cell][:, None]
    with np.errstate(divide="ignore", invalid="ignore"):
        plane = (distances - own) * (distances + own) / (2.0 * between[cell])
    plane = np.nan_to_num(plane, nan=0.0, posinf=0.0, neginf=0.0)
    return np.maximum.reduce([distances - outer, inner - distances, plane])


def _send(bounded: DataFrame, centres: dict, rings: dict) -> DataFrame:
    """One row per foreign cell that may hold a nearer neighbour."""
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        between = {g: np.sqrt(_squared(c, c)) for g, c in centres.items()}
        for frame in frames:
            for g, at in frame.groupby("g").indices.items():
                points = frame.iloc[at].reset_index(drop=True)
                cell = points["cell"].to_numpy()
                ring = np.array([rings.get((g, c), (np.inf, -np.inf)) for c in range(len(centres[g]))])
                distances = np.sqrt(_squared(np.stack(points["x"].values), centres[g]))
                bound = _lower_bounds(distances, cell, between[g], ring[:, 0], ring[:, 1])
                # Bounds are rounded: a little slack keeps ties and the search exact.
                reach = points["reach"].fillna(np.inf).to_numpy()[:, None]
                can_hold = bound <= reach + _SLACK * (1.0 + distances)
                can_hold &= np.isfinite(ring[:, 0])
                can_hold[np.arange(len(points)), cell] = False
                row, target = np.nonzero(can_hold)
                if not len(row):
                    continue
                yield pd.DataFrame({
                    "g": points["g"].to_numpy()[row], "id": points["id"].to_numpy()[row],
                    "x": points["x"].to_numpy()[row], "cell": target.astype(np.int32),
                })

    kind = dict(bounded.dtypes)
    return bounded.mapInPandas(run, f"g {kind['g']}, id {kind['id']}, x array<double>, cell int")


def _search(points: DataFrame, targets: DataFrame, target_sizes: dict, k: int,
            block: int) -> DataFrame:
    """Best k targets of every point in its cell, per block of targets."""
    spark = points.sparkSession
    kind = dict(points.dtypes)
    point_sizes = {
        (r["g"], r["cell"]): r["n"]
        for r in points.groupBy("g", "cell").agg(F.count("id").alias("n")).collect()
    }
    # At most MAX_PIVOTS rows per group: small enough to broadcast whatever the input size.
    blocks = F.broadcast(spark.createDataFrame(
        [(g, c, math.ceil(n / block), math.ceil(target_sizes[g, c] / block))
         for (g, c), n in point_sizes.items() if (g, c) in target_sizes],
        f"g {kind['g']}, cell int, point_blocks int, target_blocks int",
    ))

    def dealt(df: DataFrame, own: str, own_blocks: str, other: str, other_blocks: str) -> DataFrame:
        salt = F.pmod(F.xxhash64("id"), F.col(own_blocks)).cast("int")
        every = F.explode(F.sequence(F.lit(0), F.col(other_blocks) - 1))
        return df.join(blocks, ["g", "cell"]).select(
            "g", "cell", "id", "x", salt.alias(own), every.alias(other))

    left = dealt(points, "pb", "point_blocks", "tb", "target_blocks")
    right = dealt(targets, "tb", "target_blocks", "pb", "point_blocks")

    def best(mine: pd.DataFrame, theirs: pd.DataFrame) -> pd.DataFrame:
        columns = ["g", "id", "nn_id", "distance2", "nn_vector"]
        if mine.empty or theirs.empty:
            return pd.DataFrame(columns=columns, dtype=object)
        ids, vectors = theirs["id"].to_numpy(), np.stack(theirs["x"].values)
        out = []
        for start in range(0, len(mine), _STRIP):
            strip = mine.iloc[start:start + _STRIP]
            row, at, distance = _block_best(
                np.stack(strip["x"].values), vectors, strip["id"].to_numpy(), ids, k)
            if len(row):
                out.append(pd.DataFrame({
                    "g": strip["g"].to_numpy()[row], "id": strip["id"].to_numpy()[row],
                    "nn_id": ids[at], "distance2": distance, "nn_vector": list(vectors[at]),
                }))
        return pd.concat(out, ignore_index=True) if out else pd.DataFrame(
            columns=columns, dtype=object)

    keys = ["g", "cell", "pb", "tb"]
    schema = (
        f"g {kind['g']}, id {kind['id']}, nn_id {kind['id']}, distance2 double, "
        "nn_vector array<double>"
    )
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(best, schema)
