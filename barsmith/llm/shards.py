"""Two-pass external shuffle into shards, with DataFrame functions only.

Pass one scatters the records by a seeded hash into buckets that fit in memory. Pass two brings each
bucket into one row, shuffles it (Spark's `shuffle` is a Fisher-Yates permutation), numbers its
records behind those of the buckets before it, and writes them. A record's number gives its shard
and slot, so shards differ by one row at most and a bucket touches one or two of them.

Records of a bucket are put in a fixed order before the permutation. A task that runs again permutes
its own buckets anew and writes them whole, so no record is lost or repeated.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from barsmith import session
from barsmith.llm.native_text import small

#: Bytes of text per bucket in expectation.
BUCKET_BYTES = 16 << 20
ROW_BYTES = 16


def _starts(counts: DataFrame) -> DataFrame:
    """How many records the buckets before each bucket have, summed up in two levels."""
    counts = counts.withColumn("thousand", F.expr("__bucket div 1024"))
    upper = counts.groupBy("thousand").agg(F.sum("rows").alias("all"))
    upper = upper.select("thousand", F.coalesce(F.sum("all").over(_before(Window.partitionBy(F.lit(0)), "thousand")),
                                                F.lit(0)).alias("upper"))
    inner = F.coalesce(F.sum("rows").over(_before(Window.partitionBy("thousand"), "__bucket")), F.lit(0))
    return session.materialize(counts.withColumn("inner", inner).join(upper, "thousand").select(
        "__bucket", (F.col("upper") + F.col("inner")).alias("__before")), "bucket-starts")


def _before(groups: WindowSpec, order: str) -> WindowSpec:
    return groups.orderBy(order).rowsBetween(Window.unboundedPreceding, -1)


def write(docs: DataFrame, path: str, shards: int, id_col: str = "doc_id", text_col: str = "text", seed: int = 0,
          bucket_bytes: int = BUCKET_BYTES) -> DataFrame:
    """Write all records with `shard` and `slot` below path, a folder per shard, and return them read back.

    Slots count from 0 without gaps within a shard. Records may repeat and any column may be null;
    equal records share a bucket. Columns named shard or slot are replaced. An empty table gives an
    empty result and writes no shard.
    """
    spark = docs.sparkSession
    columns = [c for c in docs.columns if c not in ("shard", "slot")]
    sizes = F.coalesce(F.octet_length(F.col(text_col).cast("string")), F.lit(0)) + ROW_BYTES
    size = docs.agg(F.sum(sizes.cast("long")).alias("bytes"), F.count("*").alias("rows")).first()
    total = size["rows"]
    if not total:
        empty = docs.select(*columns, F.lit(0).alias("shard"), F.lit(0).cast("long").alias("slot")).where("false")
        return empty
    n = math.ceil(size["bytes"] / bucket_bytes)
    order = F.xxhash64(F.lit(seed), F.col(id_col), F.col(text_col))
    bucket = F.pmod(F.xxhash64(F.lit(seed + 1), order), F.lit(n))
    counts = docs.select(bucket.alias("__bucket")).groupBy("__bucket").agg(F.count("*").alias("rows"))
    starts = small(_starts(session.materialize(counts, "bucket-rows")))

    record = F.struct(order.alias("__order"), *[F.col(c) for c in columns])
    gathered = docs.select(bucket.alias("__bucket"), record.alias("__record")) \
        .repartition(n, "__bucket") \
        .groupBy("__bucket").agg(F.collect_list("__record").alias("__records"))
    sorted_records = F.array_sort("__records", lambda a, b: F.when(a["__order"] < b["__order"], -1)
                                  .when(a["__order"] > b["__order"], 1).otherwise(0))
    placed = gathered.select("__bucket", F.posexplode(F.shuffle(sorted_records, F.lit(seed))).alias("__at", "__record")) \
        .join(starts, "__bucket")
    number = F.col("__before") + F.col("__at")
    shard = F.expr(f"cast(((__before + __at + 1) * {shards} - 1) div {total} as int)")
    first = F.expr(f"(cast(shard as long) * {total}) div {shards}")
    placed.withColumn("shard", shard).withColumn("slot", number - first) \
        .select(*[F.col(f"__record.{c}").alias(c) for c in columns], "shard", "slot") \
        .sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)
    stored = spark.read.parquet(path)
    return stored.select(*columns, F.col("shard").cast("int").alias("shard"), "slot")
