"""Per-day lags and fixed-domain indicators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barsmith.config import (
    BAR_ORDER, CATEGORICAL, CONTINUOUS, DAY_KEYS, DOMAINS, FEATURE_TABLE_WIDTH,
    INPUT_FEATURES, LAGGED_CONTINUOUS, SELECTED_FEATURE_COUNT,
)
from barsmith.operators.ordered import RowOrder, ordered_columns, plan_order


def day_order(df: DataFrame) -> RowOrder:
    """Bars of a symbol and day by time; sliced when a day is too large for one task."""
    return plan_order(df, DAY_KEYS, BAR_ORDER)


def _lag(name: str):
    return lambda window: F.coalesce(F.lag(name, 1).over(window), F.lit(0).cast(_kind(name)))


def _kind(name: str) -> str:
    return "int" if name in DOMAINS else "double"


def add_lags(df: DataFrame, order: RowOrder | None = None) -> DataFrame:
    """Value of the previous bar of the day for all inputs; 0 for none or a missing value.

    Lags share one window, so a day is shuffled and sorted once.
    """
    lags = {f"{c}_lag1": _lag(c) for c in INPUT_FEATURES}
    return ordered_columns(df, order or day_order(df), lags, behind=1)


def indicator(code: str, value: int) -> Column:
    """1.0 where the code has the value; 0.0 for others, unknown codes and nulls."""
    return F.when(F.col(code) == value, 1.0).otherwise(0.0).alias(f"{code}_{value}")


def indicators(codes: list[str] = CATEGORICAL) -> list[Column]:
    return [
        indicator(name, k)
        for code in codes
        for name in (code, f"{code}_lag1")
        for k in DOMAINS[code]
    ]


def feature_table(df: DataFrame, keep: tuple[str, ...] = (),
                  order: RowOrder | None = None) -> DataFrame:
    """The feature contract: date, 16 continuous columns, 316 indicators.

    ``df`` holds the bars to use, in practice those in the trading window: the first of them
    has no previous bar. ``keep`` adds key columns behind the contract's columns.
    """
    lagged = add_lags(df, order)
    return lagged.select(
        "Date", *CONTINUOUS, *LAGGED_CONTINUOUS, *indicators(), *keep
    )


def check_width(df: DataFrame, expected: int = FEATURE_TABLE_WIDTH) -> DataFrame:
    if len(df.columns) != expected:
        raise ValueError(f"Expected {expected} columns, found {len(df.columns)}")
    return df


def select_features(df: DataFrame, names: list[str]) -> tuple[list[str], list[str]]:
    """Listed names that exist, in list order, and the missing ones."""
    present = set(df.columns)
    found = [n for n in names if n in present]
    return found, [n for n in names if n not in present]


def require_features(df: DataFrame, names: list[str],
                     count: int = SELECTED_FEATURE_COUNT) -> list[str]:
    """The listed names; a list of another length, with repeats or with unknown names is an error."""
    found, missing = select_features(df, names)
    if len(found) != count or len(set(found)) != count or missing:
        raise ValueError(f"Expected {count} features, but got {len(found)}; missing: {missing}")
    return found
