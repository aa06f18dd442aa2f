"""Exact de-duplication by a content sort, with DataFrame functions only.

Rows are range-partitioned by their normalised text: Spark samples the splitters. Each partition is
sorted by external sort, so equal texts are neighbours, every row is compared whole with the one
before it, and a run of equal texts keeps one row. Copies are A-Z insensitive.

The range key is bounded, whatever the texts: their first 64 characters, then a 64-bit hash, so that
long common openings can still be divided. A group of copies larger than a fair share of a partition is
dealt over several chunks of the key; each chunk is sorted and compared alone and sends one row with
its text, and these are merged by whole text. Which groups those are comes from counts per hash, added
up before their shuffle. Nothing is gathered per group, and no row is left out.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from barsmith import session
from barsmith.llm.native_text import ascii_lower, small

#: Bytes of text per partition in expectation.
PART_BYTES = 32 << 20
ROW_BYTES = 48
PREFIX = 64


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep: str = "smallest",
           part_bytes: int = PART_BYTES, partitions: int | None = None) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    A group is all rows whose texts are equal after lower-casing A-Z. It keeps the row with the
    smallest or largest id. A null text counts as empty, and empty texts are a group like any other.
    A null id loses against every other; a group without ids has a null keep_id. Of rows with the
    id to keep and the same text one is kept, whichever comes first, so every group keeps exactly one row.
    Texts of any length are compared whole. An empty table gives an empty result. Other columns are not
    read, whatever their names.
    """
    if keep not in ("smallest", "largest"):
        raise ValueError(f"keep is smallest or largest, not {keep}")
    spark = docs.sparkSession
    text = ascii_lower(F.coalesce(F.col(text_col).cast("string"), F.lit("")))
    rows = docs.select(
        F.col(id_col).alias("doc_id"), text.alias("norm"),
        F.xxhash64(F.col(id_col), F.spark_partition_id()).alias("salt")).withColumn("hash", F.xxhash64("norm"))
    copies = session.materialize(rows.groupBy("hash").agg(
        F.count("*").alias("rows"), F.sum(F.octet_length("norm").cast("long") + ROW_BYTES).alias("bytes")), "copies")
    total = copies.agg(F.sum("rows").alias("rows"), F.sum("bytes").alias("bytes")).first()
    if not total["rows"]:
        return rows.select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(0).cast("long").alias("group_size"),
                           F.lit(False).alias("kept"), F.lit("").alias("text_sha256")).where("false")
    parts = partitions or max(math.ceil(total["bytes"] / part_bytes), int(spark.conf.get("spark.sql.shuffle.partitions")))
    chunks = F.greatest(F.ceil(F.col("rows") * parts / total["rows"]), F.ceil(F.col("bytes") * parts / total["bytes"]))
    crowded = session.materialize(
        copies.select("hash", chunks.alias("chunks")).where("rows > 1 AND chunks > 1"), "crowded")
    range_key = ["prefix", "hash", "chunk"]
    placed = rows.join(small(crowded), "hash", "left").select(
        "doc_id", "norm", "hash", F.substring("norm", 1, PREFIX).alias("prefix"),
        F.pmod("salt", "chunks").alias("chunk")).repartitionByRange(parts, *range_key)

    # The row to keep comes first among its equals.
    by_id = F.col("doc_id").asc_nulls_last() if keep == "smallest" else F.col("doc_id").desc_nulls_last()
    sorted_rows = Window.partitionBy(*range_key).orderBy("norm", by_id)
    so_far = sorted_rows.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    head = ~F.col("norm").eqNullSafe(F.lag("norm").over(sorted_rows))
    runs = placed.withColumn("head", head) \
        .withColumn("run", F.sum(F.col("head").cast("int")).over(so_far)) \
        .withColumn("first", F.last(F.when(F.col("head"), F.struct("doc_id")), ignorenulls=True).over(so_far)) \
        .select("doc_id", "head", "run", F.col("first.doc_id").alias("keep_id"), F.sha2("norm", 256).alias("text_sha256"),
                *range_key, F.when(F.col("head") & F.col("chunk").isNotNull(), F.col("norm")).alias("head_text")) \
        .withColumn("size", F.count("*").over(Window.partitionBy(*range_key, "run")))
    stored = session.materialize(runs.drop("prefix", "run"), "runs")

    merged = _merge_chunks(stored.where("head_text IS NOT NULL"), keep)
    many = F.col("all").isNotNull()
    return stored.join(merged, ["hash", "text_sha256"], "left").select(
        "doc_id", F.when(many, F.col("best.id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.when(many, F.col("all")).otherwise(F.col("size")).alias("group_size"),
        F.when(many, F.col("head") & (F.col("chunk") == F.col("best.chunk"))).otherwise(F.col("head")).alias("kept"),
        "text_sha256")


def _merge_chunks(heads: DataFrame, keep: str) -> DataFrame:
    """(hash, text_sha256, best, all): the row to keep and the size of each group that is in chunks.

    Equal texts are found by whole text; the digest only leads back to the rows.
    """
    if keep == "smallest":
        best = F.min(F.struct(F.col("keep_id").isNull().alias("none"), F.col("keep_id").alias("id"), "chunk"))
    else:
        best = F.max(F.struct(F.col("keep_id").isNotNull().alias("some"), F.col("keep_id").alias("id"),
                              (-F.col("chunk")).alias("before")))
    merged = heads.groupBy("hash", "text_sha256", "head_text").agg(best.alias("best"), F.sum("size").alias("all"))
    chunk: Column = F.col("best.chunk") if keep == "smallest" else -F.col("best.before")
    stored = session.materialize(merged.select(
        "hash", "text_sha256", F.struct(F.col("best.id").alias("id"), chunk.alias("chunk")).alias("best"), "all"), "merged")
    return small(stored)

