"""Entry signal per arriving bar: stateless cleaning, indicators, scaling and decision."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barsmith.config import BAR_SECONDS, CATEGORICAL, DATE_FORMATS, DOMAINS
from barsmith.functions import dates
from barsmith.operators import evaluation
from barsmith.operators.features import indicator
from barsmith.operators.scaler import ScalerModel


def prepare(stream: DataFrame, scaler: ScalerModel | None = None,
            date_format: str | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """Clean and encode bars row by row.

    A stream has no whole column to choose a date format from: text dates need
    ``date_format``; time columns are used as they are.
    """
    if dict(stream.dtypes)["Date"] == "string":
        stream = stream.withColumn(
            "Date", dates.parse(F.col("Date"), date_format or DATE_FORMATS[0]))
    usable = stream.where(
        F.col("Date").isNotNull() & dates.on_bar_mark(F.col("Date"), BAR_SECONDS))
    scaled = scaler.transform(usable) if scaler else usable
    codes = [indicator(code, k) for code in CATEGORICAL for k in DOMAINS[code]]
    others = [c for c in scaled.columns if c not in CATEGORICAL]
    return scaled.select(
        *others, *[c for c in keep if c not in others], *codes,
        dates.in_window(F.col("Date")).alias("InWindow"),
        dates.trading_day(F.col("Date")).alias("day_of_bar"),
    )


def signals(prepared: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """Action and confidence (the greatest blended probability) of scored bars."""
    decided = evaluation.blend(prepared)
    return decided.select(
        "bar_id", "Date", "InWindow", *keep,
        F.col("predicted").alias("action"),
        F.greatest(*evaluation.PROBABILITIES).alias("confidence"),
    )
