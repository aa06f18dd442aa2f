"""Time split: test after a cutoff, then the first four fifths of the days for training."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barsmith.operators.lookup import join_small


def validation_starts(df: DataFrame, cutoff: str, train_share: float = 0.8) -> DataFrame:
    """Per symbol the first day of the validation part (null when all days train).

    Distinct days collapse before the shuffle; the window sees one row per calendar day.
    """
    days = (
        df.where(F.col("Date") < F.lit(cutoff).cast("timestamp_ntz"))
        .select("symbol", "trading_day").distinct()
    )
    in_symbol = Window.partitionBy("symbol")
    ranked = days.select(
        "symbol", "trading_day",
        F.row_number().over(in_symbol.orderBy("trading_day")).alias("day_rank"),
        F.floor(F.lit(train_share) * F.count(F.lit(1)).over(in_symbol)).alias("train_days"),
    )
    return ranked.groupBy("symbol").agg(
        F.min(F.when(F.col("day_rank") > F.col("train_days"), F.col("trading_day")))
        .alias("validation_start")
    )


def add_split(df: DataFrame, cutoff: str, train_share: float = 0.8) -> DataFrame:
    """Add ``split``: train, val or test. The lookup has one row per symbol."""
    starts = validation_starts(df, cutoff, train_share)
    split = (
        F.when(F.col("Date") >= F.lit(cutoff).cast("timestamp_ntz"), "test")
        .when(F.col("trading_day") >= F.col("validation_start"), "val")
        .otherwise("train")
    )
    joined = join_small(df, starts, ["symbol"], "left")
    return joined.select(*df.columns, split.alias("split"))


def split_counts(df: DataFrame) -> DataFrame:
    return df.groupBy("split").agg(
        F.count(F.lit(1)).alias("rows"), F.min("Date").alias("first_bar")
    )


def keep_valid(df: DataFrame, valid: DataFrame) -> DataFrame:
    """Rows whose bar has a profit in a separate table, by key rather than by position."""
    return df.join(valid.where("is_valid").select("bar_id"), "bar_id", "left_semi")
