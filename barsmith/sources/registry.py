"""Saved exit models, one folder per key ``<type>_<designation>_<bars>`` below an asset folder."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import SparkSession

from barsmith.operators.forest import ForestModel
from barsmith.sources.writers import load_model, save_model

Key = tuple[str, str, int]


def model_name(key: Key) -> str:
    kind, designation, bars = key
    return f"{kind}_{designation}_{bars}"


def parse_name(name: str) -> Key | None:
    """The key of a model folder; None for other names."""
    parts = name.split("_")
    if len(parts) != 3 or not parts[2].isdigit():
        return None
    return parts[0], parts[1], int(parts[2])


def register_model(model: PipelineModel | ForestModel, folder: str, key: Key) -> str:
    return save_model(model, f"{folder.rstrip('/')}/{model_name(key)}")


def list_models(spark: SparkSession, folder: str) -> dict[Key, str]:
    """Keys and paths of the models of an asset, on whatever file system holds them."""
    root = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    files = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not files.exists(root):
        return {}
    found = {parse_name(s.getPath().getName()): s.getPath().toString()
             for s in files.listStatus(root) if s.isDirectory()}
    return {k: p for k, p in found.items() if k is not None}


def load_models(spark: SparkSession, folder: str) -> dict[Key, PipelineModel | ForestModel]:
    """Every model of an asset, loaded once for all requests."""
    return {k: load_model(p) for k, p in list_models(spark, folder).items()}
