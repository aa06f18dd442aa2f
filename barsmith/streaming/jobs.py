"""Running a streaming plan to the end of the available input."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from barsmith.session import scratch


def open_stream(spark: SparkSession, path: str, schema: T.StructType, fmt: str = "parquet",
                files_per_trigger: int | None = None) -> DataFrame:
    """File source; ``files_per_trigger`` bounds the size of a micro-batch."""
    reader = spark.readStream.format(fmt).schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(path)


def drain(stream: DataFrame, sink: str, checkpoint: str) -> None:
    """Process what has arrived and stop; progress is kept in the checkpoint."""
    query = (
        stream.writeStream.format("parquet").outputMode("append")
        .option("checkpointLocation", checkpoint).trigger(availableNow=True).start(sink)
    )
    query.awaitTermination()


def replay(parts: list[DataFrame], build: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """Let parts of a table arrive one after the other and return what the stream wrote.

    The stream stops after each part and goes on from its checkpoint, as after a restart.
    """
    spark = parts[0].sparkSession
    source, sink, checkpoint = (scratch(spark, n) for n in ("arrivals", "sink", "progress"))
    schema = None
    for part in parts:
        part.write.mode("append").parquet(source)
        out = build(open_stream(spark, source, part.schema))
        schema = out.schema
        drain(out, sink, checkpoint)
    return spark.read.schema(schema).parquet(sink)
