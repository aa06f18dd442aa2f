"""Writers for feature tables, scaler inputs, evaluation results and exports."""

from __future__ import annotations

import datetime as dt

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession

from barsmith.operators.forest import ForestModel
from barsmith.operators.scaler import ScalerModel


def write_bars(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "errorifexists") -> str:
    """Write by day, so readers of a date range skip the other days.

    Ranges of the row key make tasks of equal size: a large day becomes several files, and a
    task that holds small days writes one file for each.
    """
    ranged = df.repartitionByRange("trading_day", "Date", "symbol", "bar_id")
    ranged.write.format(fmt).mode(mode).option("header", True).partitionBy("trading_day").save(path)
    return path


def write_table(df: DataFrame, path: str, fmt: str = "csv", mode: str = "errorifexists") -> str:
    writer = df.write.format(fmt).mode(mode)
    if fmt == "csv":
        writer = writer.option("header", True).option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss")
    writer.save(path)
    return path


def result_path(folder: str, model: str, now: dt.datetime | None = None) -> str:
    stamp = (now or dt.datetime.now()).strftime("%Y%m%d_%H%M%S")
    return f"{folder.rstrip('/')}/{model}_evaluation_results_{stamp}"


def write_results(rows: DataFrame, folder: str, model: str, now: dt.datetime | None = None) -> str:
    return write_table(rows, result_path(folder, model, now))


def write_exports(bars: DataFrame, trades: DataFrame, folder: str, symbol: str,
                  suffix: str = "") -> tuple[str, str]:
    base = f"{folder.rstrip('/')}/{symbol}"
    return (
        write_table(bars, f"{base}_raw_ohlc_data{suffix}"),
        write_table(trades, f"{base}_trade_signals{suffix}"),
    )


def save_model(model: PipelineModel | ForestModel, path: str) -> str:
    if isinstance(model, ForestModel):
        return model.save(path)
    model.write().overwrite().save(path)
    return path


def load_model(path: str) -> PipelineModel | ForestModel:
    spark = SparkSession.getActiveSession()
    trees = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/forest")
    if trees.getFileSystem(spark._jsc.hadoopConfiguration()).exists(trees):
        return ForestModel.load(path)
    return PipelineModel.load(path)


def save_scaler(model: ScalerModel, spark: SparkSession, path: str) -> str:
    model.to_frame(spark).coalesce(1).write.mode("overwrite").parquet(path)
    return path


def load_scaler(spark: SparkSession, path: str) -> ScalerModel:
    return ScalerModel.from_frame(spark.read.parquet(path))
