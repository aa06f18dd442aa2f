"""Exit probabilities for open trades: requests joined with snapshots and class maps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barsmith.operators.lookup import join_small

TRADE_KEY = ("TradeType", "TradeDesignation", "BarsSinceTradeEntry")
REQUEST_FIELDS = (
    "json_path", "columns_path", "TradeType", "TradeDesignation", "BarsSinceTradeEntry",
    "model_dir",
)
RED_YELLOW_GREEN = {"red": -1, "yellow": 0, "green": 1}


def parse_requests(lines: DataFrame, column: str = "line") -> DataFrame:
    """Split a request line into its six fields; ``error`` marks lines to quarantine."""
    parts = F.split(F.col(column), " ")
    count = F.size(parts)
    bars = F.get(parts, F.lit(4)).try_cast("int")
    fields = [
        bars.alias(name) if name == "BarsSinceTradeEntry"
        else F.get(parts, F.lit(i)).alias(name)
        for i, name in enumerate(REQUEST_FIELDS)
    ]
    error = (
        F.when(count < len(REQUEST_FIELDS), "too few fields")
        .when(bars.isNull(), "bars since entry is not a number")
    )
    return lines.select("*", *fields, error.alias("error"))


def first_snapshots(snapshots: DataFrame, order: str = "seq",
                    keys: tuple[str, ...] = TRADE_KEY) -> DataFrame:
    """First row per key in source order; collapses on the map side, so hot keys are cheap."""
    others = [c for c in snapshots.columns if c not in keys]
    first = snapshots.groupBy(*keys).agg(F.min_by(F.struct(*others), order).alias("row"))
    return first.select(*keys, "row.*")


def match_requests(requests: DataFrame, snapshots: DataFrame, predictors: list[str],
                   order: str = "seq", keys: tuple[str, ...] = TRADE_KEY) -> DataFrame:
    """Each request with the predictors of its snapshot; ``found`` is false without one."""
    first = first_snapshots(snapshots.select(*keys, order, *predictors), order, keys)
    right = first.drop(order).withColumn("found", F.lit(True))
    return join_small(requests, right, list(keys), "left").withColumn(
        "found", F.coalesce("found", F.lit(False)))


def map_classes(scored: DataFrame, class_map: DataFrame,
                keys: tuple[str, ...] = TRADE_KEY[:2]) -> DataFrame:
    """Class probabilities to a red / yellow / green triple.

    ``scored`` has the array ``probabilities`` (null when nothing could be scored) and
    ``class_map`` one row per model key and class: ``class_index``, ``value`` (-1, 0, 1).
    Missing classes, and rows without snapshot or model, get 0; the reason is in ``error``.
    """
    maps = class_map.groupBy(*keys).agg(
        *[F.max(F.when(_slot(name), F.col("class_index"))).alias(f"{name}_index")
          for name in RED_YELLOW_GREEN],
        F.lit(True).alias("has_model"),
    )
    joined = join_small(scored, maps, list(keys), "left")
    usable = F.col("found") & F.col("has_model") & F.col("probabilities").isNotNull()
    triple = [
        F.coalesce(
            F.when(usable, F.get("probabilities", F.col(f"{name}_index"))), F.lit(0.0)
        ).alias(name)
        for name in RED_YELLOW_GREEN
    ]
    error = (
        F.when(~F.col("found"), "no snapshot")
        .when(F.col("has_model").isNull(), "no model")
        .when(F.col("probabilities").isNull(), "no model")
    )
    return joined.select(*scored.columns, *triple, error.alias("error"))


def _slot(name: str) -> Column:
    """Values other than -1 and 0 all mean green."""
    value = F.col("value")
    return ~value.isin(-1, 0) if name == "green" else value == RED_YELLOW_GREEN[name]
