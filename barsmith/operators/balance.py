"""Class weights and oversampling of minority classes by interpolation."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barsmith.operators.neighbours import BLOCK, nearest
from barsmith.operators.ordered import MAX_GROUP_ROWS, ordered_columns, plan_order
from barsmith.session import materialize

CLASS_COUNT = 3
NEIGHBOURS = 3
SEED = 42


def class_sizes(df: DataFrame, label: str = "label") -> dict[int, int]:
    rows = df.groupBy(label).agg(F.count(F.lit(1)).alias("n")).collect()
    return {r[label]: r["n"] for r in rows}


def class_weights(df: DataFrame, label: str = "label") -> dict[int, float]:
    """Rows per class if all classes were equal, over the rows there are."""
    return weights_of(class_sizes(df, label))


def weights_of(sizes: dict[int, int]) -> dict[int, float]:
    total = sum(sizes.values())
    return {c: total / (CLASS_COUNT * n) for c, n in sizes.items()}


def add_weights(df: DataFrame, weights: dict[int, float], label: str = "label") -> DataFrame:
    weight = F.lit(None).cast("double")
    for value, w in weights.items():
        weight = F.when(F.col(label) == value, w).otherwise(weight)
    return df.withColumn("weight", weight)


#: Copies of a row that one array holds.
COPIES_PER_PART = 10_000


@dataclass(frozen=True)
class Balanced:
    rows: DataFrame
    applied: bool


def oversample(df: DataFrame, features: list[str], k: int = NEIGHBOURS, seed: int = SEED,
               label: str = "label", key: str = "bar_id", block: int = BLOCK,
               max_group_rows: int = MAX_GROUP_ROWS) -> Balanced:
    """Raise every class to the size of the largest one.

    A synthetic row lies at a random place between a row and one of its ``k`` nearest rows
    of the class. Choices come from hashes of the row key, so they do not depend on how the
    rows are partitioned. Rows contribute equally: ``need // n`` copies each, and one more
    for the ``need % n`` rows whose hash is lowest. When a minority class has no more than
    ``k`` rows the input comes back unchanged, with ``applied`` false.
    """
    original = df.select(
        F.col(key).alias("bar_id"), F.col(label).alias("label"),
        F.array(*[F.col(c).cast("double") for c in features]).alias("vector"),
    )
    base = materialize(original, "smote-input")
    sizes = class_sizes(base)
    largest = max(sizes.values(), default=0)
    needs = {c: largest - n for c, n in sizes.items() if n < largest}
    if any(sizes[c] <= k for c in needs):
        return Balanced(_unpacked(base, features, F.lit(False)), False)
    if not needs:
        return Balanced(_unpacked(base, features, F.lit(False)), True)

    minority = base.where(F.col("label").isin(*needs))
    near = nearest(minority, k, block=block).select("bar_id", "nn_rank", "nn_vector")
    copies = _copies(minority, sizes, needs, seed, max_group_rows)
    draw = F.xxhash64(F.lit(seed), F.col("bar_id"), F.col("copy"))
    drawn = copies.withColumns({
        "nn_rank": (F.pmod(draw, F.lit(k)) + 1).cast("int"),
        "gap": F.pmod(F.xxhash64(draw), F.lit(1 << 53)).cast("double") / float(1 << 53),
    })
    mixed = drawn.join(near, ["bar_id", "nn_rank"]).withColumn(
        "vector",
        F.zip_with("vector", "nn_vector", lambda x, y: x + F.col("gap") * (y - x)),
    )
    synthetic = _unpacked(mixed, features, F.lit(True))
    return Balanced(
        _unpacked(base, features, F.lit(False)).unionByName(synthetic), True)


def _copies(minority: DataFrame, sizes: dict, needs: dict, seed: int,
            max_group_rows: int) -> DataFrame:
    hashed = minority.withColumn("draw_order", F.xxhash64(F.lit(seed), F.col("bar_id")))
    by = ("draw_order", "bar_id")
    order = plan_order(hashed, ("label",), by, max_group_rows)
    ranked = ordered_columns(hashed, order, {}, position="place")
    every, extra = F.lit(0), F.lit(0)
    for c, need in needs.items():
        every = F.when(F.col("label") == c, need // sizes[c]).otherwise(every)
        extra = F.when(F.col("label") == c, need % sizes[c]).otherwise(extra)
    count = every + F.when(F.col("place") <= extra, 1).otherwise(0)
    first = F.col("part") * COPIES_PER_PART + 1
    last = F.least(F.col("copies"), first + (COPIES_PER_PART - 1))
    # Parts of bounded length are dealt to tasks before they grow into rows.
    return (
        ranked.withColumn("copies", count.cast("long")).where(F.col("copies") > 0)
        .select("bar_id", "label", "vector", "copies", F.explode(F.sequence(
            F.lit(0).cast("long"), F.expr(f"(copies - 1) div {COPIES_PER_PART}"))).alias("part"))
        .repartition("bar_id", "part")
        .select("bar_id", "label", "vector",
                F.explode(F.sequence(first, last)).alias("copy"))
    )


def _unpacked(df: DataFrame, features: list[str], synthetic: Column) -> DataFrame:
    return df.select(
        "bar_id", "label",
        *[F.element_at("vector", i + 1).alias(name) for i, name in enumerate(features)],
        synthetic.alias("is_synthetic"),
    )
