"""Readers and input checks. Schemas are explicit: nothing is inferred from the data."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barsmith.config import (
    CATEGORICAL, CONTINUOUS, FEATURE_TABLE_WIDTH, INPUT_FEATURES, feature_table_columns,
)
from barsmith.operators.clean import nan_to_null
from barsmith.operators.lookup import join_small

_TYPES = {
    "bar_id": T.LongType(), "symbol": T.StringType(), "Date": T.TimestampNTZType(),
    **{c: T.DoubleType() for c in CONTINUOUS}, **{c: T.IntegerType() for c in CATEGORICAL},
}


def read_raw_bars(spark: SparkSession, path: str, fmt: str = "parquet", symbol: str = "ES",
                  text_dates: bool = False) -> DataFrame:
    """Raw bars from csv (with header), json, parquet or orc, in the contract's types.

    Files of a single instrument may lack ``symbol``. Without ``bar_id`` rows are numbered in
    the order of the input splits; write the result once before using it as a key.
    With ``text_dates`` the date stays text, to be parsed by ``clean.parse_dates``.
    """
    types = _TYPES | ({"Date": T.StringType()} if text_dates else {})
    reader = spark.read.format(fmt)
    if fmt == "csv":
        # Only the header line is read here, for the names and their order.
        header = spark.read.option("header", True).csv(path).columns
        reader = reader.option("header", True).option("enforceSchema", False).schema(
            T.StructType([T.StructField(n, types.get(n, T.StringType())) for n in header]))
    elif fmt == "json":
        reader = reader.schema(T.StructType([T.StructField(n, t) for n, t in types.items()]))
    raw = require_columns(reader.load(path), ["Date", *INPUT_FEATURES])
    keys = {"bar_id": F.monotonically_increasing_id(), "symbol": F.lit(symbol)}
    raw = raw.withColumns({n: c for n, c in keys.items() if n not in raw.columns})
    return nan_to_null(raw.select(*[F.col(n).cast(t).alias(n) for n, t in types.items()]))


def read_features(spark: SparkSession, path: str, keep: tuple[T.StructField, ...] = ()) -> DataFrame:
    """Feature table from csv: every column but the date is a double.

    True / False indicators (written by some data-frame libraries) read as 1.0 / 0.0.
    """
    names = feature_table_columns()
    text = T.StructType(
        [T.StructField(n, T.StringType()) for n in names] + list(keep)
    )
    raw = spark.read.schema(text).option("header", True).option("enforceSchema", False).csv(path)
    return nan_to_null(raw.select(
        "Date", *[_number(n).alias(n) for n in names[1:]], *[f.name for f in keep]
    ))


def _number(name: str):
    lowered = F.lower(F.col(name))
    return (
        F.when(lowered == "true", 1.0).when(lowered == "false", 0.0)
        .otherwise(F.col(name).cast("double"))
    )


def require_path(spark: SparkSession, path: str) -> str:
    """Raise when no file matches a path or pattern, on whatever file system it names."""
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    files = hadoop.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not len(files.globStatus(hadoop) or ()):
        raise FileNotFoundError(path)
    return path


def require_columns(df: DataFrame, required: list[str]) -> DataFrame:
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"Missing required columns in input: {missing}")
    return df


def check_header_width(spark: SparkSession, path: str, expected: int = FEATURE_TABLE_WIDTH) -> int:
    """Count the columns of a csv header without reading its data."""
    width = len(spark.read.option("header", True).csv(path).columns)
    if width != expected:
        raise ValueError(f"Expected {expected} columns, found {width}")
    return width


_ASSET_FIELDS = (
    "price_per_point double, minimum_resolution_points double, price_per_tick double, "
    "maximum_drawdown double, points_to_maximum_drawdown double, targer_profit double, "
    "stoploss double"
)


def read_assets(spark: SparkSession, path: str) -> DataFrame:
    """One row per instrument from the nested parameter file.

    The key of the profit target is misspelt in that file format and renamed here.
    """
    schema = f"assets map<string, struct<{_ASSET_FIELDS.replace(' double', ': double')}>>"
    raw = spark.read.schema(schema).json(path, multiLine=True)
    return (
        raw.select(F.explode("assets").alias("symbol", "p")).select("symbol", "p.*")
        .withColumnsRenamed({"targer_profit": "target_profit", "stoploss": "stop_loss"})
    )


def read_selection(spark: SparkSession, path: str) -> list[str]:
    """The ordered list of selected features; a short list, so it lives on the driver."""
    rows = spark.read.schema("selected_features array<string>").json(path, multiLine=True)
    return list(rows.first()["selected_features"])


def read_predictors(spark: SparkSession, path: str) -> list[str]:
    """Predictor names of exit models: a JSON array of strings."""
    return list(json.loads(spark.read.text(path, wholetext=True).first()["value"]))


def join_assets(bars: DataFrame, assets: DataFrame) -> DataFrame:
    """Parameters by symbol; bars of unknown symbols have no rules and drop out."""
    return join_small(bars, assets, ["symbol"])
