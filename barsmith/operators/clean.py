"""Cleaning: duplicates, dates, bar precision, trading window, validation counts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barsmith.config import CONTINUOUS, DATE_FORMATS
from barsmith.functions import dates


def drop_identical(df: DataFrame) -> DataFrame:
    """Keep one of every set of equal rows; copies collapse before the shuffle."""
    return df.dropDuplicates()


def project_continuous(df: DataFrame) -> DataFrame:
    return df.select(*CONTINUOUS)


def count_formats(df: DataFrame, column: str = "Date") -> DataFrame:
    """One row: how many values every known format can parse."""
    return df.agg(*[
        F.count(dates.parse(F.col(column), fmt)).alias(f"n{i}")
        for i, fmt in enumerate(DATE_FORMATS)
    ])


def format_report(df: DataFrame, column: str = "Date") -> DataFrame:
    """One row per format: values it parses, and whether it is the one to use."""
    entries, before = [], F.lit(0)
    for i in range(len(DATE_FORMATS)):
        n = F.col(f"n{i}")
        entries.append(F.struct(
            F.lit(i).alias("format"), n.alias("parsed"), ((before == 0) & (n > 0)).alias("chosen")))
        before = before + n
    return count_formats(df, column).select(F.inline(F.array(*entries)))


def choose_format(df: DataFrame, column: str = "Date") -> str | None:
    """The first format that parses any value; None when no format parses anything."""
    counts = count_formats(df, column).first()
    return next((fmt for i, fmt in enumerate(DATE_FORMATS) if counts[f"n{i}"]), None)


def parse_dates(df: DataFrame, column: str = "Date") -> DataFrame:
    """Parse the whole column by one format; other formats become null.

    Where none of the formats fits any row, every row may use its own format, tried from
    plain ISO forms.
    """
    fmt = choose_format(df, column)
    text = F.col(column)
    if fmt is not None:
        return df.withColumn(column, dates.parse(text, fmt))
    mixed = [dates.parse(text, f) for f in MIXED_FORMATS]
    return df.withColumn(column, F.coalesce(*mixed))


# Forms accepted row by row when no format of the contract fits.
MIXED_FORMATS = [
    "yyyy-MM-dd'T'HH:mm:ss", "yyyy-MM-dd HH:mm", "yyyy-MM-dd", "yyyy/M/d H:mm:ss",
    "M/d/yyyy H:mm:ss", "M/d/yyyy H:mm", "M/d/yyyy",
]


def drop_undated(df: DataFrame, column: str = "Date") -> DataFrame:
    return df.where(F.col(column).isNotNull())


def keep_bar_marks(df: DataFrame, column: str = "Date") -> DataFrame:
    return df.where(dates.on_bar_mark(F.col(column)))


def flag_window(df: DataFrame, column: str = "Date") -> DataFrame:
    return df.withColumn("InWindow", dates.in_window(F.col(column)))


def keep_window(df: DataFrame, column: str = "Date") -> DataFrame:
    return df.where(dates.in_window(F.col(column)))


def add_trading_day(df: DataFrame, column: str = "Date") -> DataFrame:
    return df.withColumn("trading_day", dates.trading_day(F.col(column)))


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN compares as the largest value here, while in the data it means 'missing'."""
    doubles = {name for name, kind in df.dtypes if kind in ("double", "float")}
    return df.select(*[
        F.when(~F.isnan(c), F.col(c)).alias(c) if c in doubles else F.col(c) for c in df.columns
    ])


def clean_bars(df: DataFrame, column: str = "Date") -> DataFrame:
    """Text dates to usable bars: parse, drop undated rows, keep bar marks, flag window."""
    steps = [parse_dates, drop_undated, keep_bar_marks, flag_window, add_trading_day]
    return reduce(lambda d, step: step(d, column), steps, nan_to_null(df))


def clean_report(parsed: DataFrame, column: str = "Date") -> DataFrame:
    """One pass over parsed rows: loaded, dropped per rule, remaining, in the window."""
    ts = F.col(column)
    dated, marked = ts.isNotNull(), dates.on_bar_mark(ts)
    return parsed.agg(
        F.count(F.lit(1)).alias("loaded"),
        F.count_if(ts.isNull()).alias("dropped_undated"),
        F.count_if(dated).alias("dated"),
        F.count_if(dated & ~marked).alias("dropped_off_mark"),
        F.count_if(dated & marked).alias("remaining"),
        F.count_if(dated & marked & dates.in_window(ts)).alias("in_window"),
    )


def count_days(df: DataFrame) -> DataFrame:
    return df.agg(F.count_distinct("trading_day").alias("days"))
