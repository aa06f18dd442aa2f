"""Context-triggered piecewise hashing: fingerprints that stay alike when a text is edited.

A rolling hash over seven bytes sets chunk boundaries: at block size 2**k wherever its low k bits are
zero, so the boundaries of a block size are among those of the half. The block size of a text is the
smallest that gives at most 64 chunks. Every chunk gives one base64 character; the fingerprint holds
the characters at the block size and at its double. Fingerprints are compared by edit distance
(insertions and deletions) of signatures with the same block size, so sizes may differ by one step;
signatures without a common run of seven characters are unlike.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barsmith.llm import words

WINDOW = 7
MOST_CHUNKS = 64
BLOCK_BYTES = 1 << 19
_ALPHABET = np.frombuffer(b"ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", np.uint8)
_ROLL = words.stream(31, 256).astype(np.uint32)
_STEP = words.stream(32, WINDOW).astype(np.uint32) | np.uint32(1)
_CHUNK = words.stream(33, 256)


def _rolling(buffer: np.ndarray) -> np.ndarray:
    """Hash of the seven bytes that end at each position."""
    values = _ROLL[buffer]
    h = values * _STEP[0]
    for k in range(1, WINDOW):
        h[k:] += values[:-k] * _STEP[k]
    h ^= h >> np.uint32(16)
    h *= np.uint32(0x7FEB352D)
    h ^= h >> np.uint32(15)
    return h


def fingerprints(texts: list[bytes]) -> list[str]:
    """Fingerprints of texts, worked on together; zero bytes before each text fill its first windows."""
    n = len(texts)
    lengths = np.array([len(t) for t in texts], np.int64)
    buffer = np.frombuffer(b"".join(bytes(WINDOW) + t for t in texts) + b"\0", np.uint8)
    start = np.concatenate([[0], np.cumsum(lengths + WINDOW)[:-1]]) + WINDOW
    end = start + lengths
    h = _rolling(buffer)
    power, inverse = words._power_tables(len(buffer))
    sums = _CHUNK[buffer] * power[: len(buffer)]
    np.cumsum(sums, out=sums)

    inside = np.ones(len(buffer), bool)
    inside[-1] = False
    for k in range(WINDOW):
        inside[start - 1 - k] = False
    at = np.flatnonzero(inside)
    size = np.full(n, -1)
    signs: list[list[bytes]] = [[] for _ in texts]
    for k in range(34):
        if k:
            at = at[(h[at] >> np.uint32(k - 1)) & np.uint32(1) == 0] if k <= 32 else at[:0]
        low, high = np.searchsorted(at, start), np.searchsorted(at, end)
        tail = (high == low) | (at[np.maximum(high - 1, 0)] < end - 1) if len(at) else np.ones(n, bool)
        chunks = high - low + (tail & (lengths > 0))
        fresh = (size < 0) & (chunks <= MOST_CHUNKS)
        size[fresh] = k
        for d in np.flatnonzero(fresh | ((size >= 0) & (size == k - 1))):
            stop = at[low[d] : high[d]] + 1
            if tail[d] and lengths[d]:
                stop = np.append(stop, end[d])
            begin = np.concatenate([[start[d]], stop[:-1]])[: len(stop)]
            value = words.mix((sums[stop - 1] - sums[begin - 1]) * inverse[begin])
            signs[d].append(_ALPHABET[(value >> np.uint64(58)).astype(np.int64)].tobytes())
        if (size >= 0).all() and k > size.max():
            break
    return [f"{1 << k}:{a.decode()}:{b.decode()}" for k, (a, b) in zip(size.tolist(), signs)]


def _common_run(a: str, b: str) -> bool:
    n = min(WINDOW, len(a), len(b))
    return n > 0 and not {a[i : i + n] for i in range(len(a) - n + 1)}.isdisjoint(
        b[i : i + n] for i in range(len(b) - n + 1))


def _alike(a: str, b: str) -> float:
    """One minus the edit distance over both lengths, by bit-parallel longest common subsequence."""
    if a == b:
        return 1.0 if a else 0.0
    if not _common_run(a, b):
        return 0.0
    places: dict[str, int] = {}
    for i, c in enumerate(a):
        places[c] = places.get(c, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for c in b:
        hit = row & places.get(c, 0)
        row = ((row + hit) | (row - hit)) & full
    return 2 * (len(a) - row.bit_count()) / (len(a) + len(b))


def likeness(one: str, two: str) -> float:
    """Likeness of two fingerprints in 0 to 1; equal ones have 1, incompatible block sizes 0."""
    if one == two:
        return 1.0
    size_a, a, a2 = one.split(":")
    size_b, b, b2 = two.split(":")
    x, y = int(size_a), int(size_b)
    if x == y:
        return max(_alike(a, b), _alike(a2, b2))
    if x == 2 * y:
        return _alike(a, b2)
    if y == 2 * x:
        return _alike(a2, b)
    return 0.0


_SCHEMA = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
           "near_edited double, near_next double")
_KIND = pa.schema([("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()),
                   ("fingerprint", pa.string()), ("edited_fingerprint", pa.string()),
                   ("near_edited", pa.float64()), ("near_next", pa.float64())])


def _with_next(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple]:
    """(row, next row of its bucket) for the rows of sorted batches; rows are (bucket, extra, id, text)."""
    last = None
    for batch in words.slices(batches):
        for row in zip(*(c.to_pylist() for c in batch.columns)):
            if last is not None and not last[1]:
                yield last, row
            last = row


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    pairs, size = [], 0
    for own, following in _with_next(batches):
        pairs.append((own[2], own[3], following[3]))
        size += len(own[3])
        if size > BLOCK_BYTES:
            yield _digest(pairs)
            pairs, size = [], 0
    if pairs:
        yield _digest(pairs)


def _digest(pairs: list[tuple]) -> pa.RecordBatch:
    """Rows for consecutive documents; each one's next text is the text of the following row."""
    texts = [p[1].encode() for p in pairs] + [pairs[-1][2].encode()]
    chained = all(p[2] == q[1] for p, q in zip(pairs, pairs[1:]))
    following = texts[1:] if chained else [p[2].encode() for p in pairs]
    edited = []
    for _, text, after in pairs:
        cut = len(text) // 4
        edited.append((text[: len(text) - cut] + after[:cut]).encode())
    found = fingerprints(texts + edited + ([] if chained else following))
    n = len(pairs)
    own, changed = found[:n], found[n + 1 : 2 * n + 1]
    after = found[1 : n + 1] if chained else found[2 * n + 1 :]
    return pa.RecordBatch.from_arrays(
        [pa.array([p[0] for p in pairs], pa.int64()), pa.array([len(p[1]) for p in pairs], pa.int64()),
         pa.array([hashlib.sha256(e).hexdigest() for e in edited]), pa.array(own), pa.array(changed),
         pa.array([likeness(a, b) for a, b in zip(own, changed)], pa.float64()),
         pa.array([likeness(a, b) for a, b in zip(own, after)], pa.float64())], schema=_KIND)


def compare_with_next(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      bucket_bytes: int = 16 << 20) -> DataFrame:
    """Per row: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The edited text has its last floor(n_chars / 4) code points replaced by the first as many of the
    next document by ascending id (after the last: the first). A null text counts as empty. Rows of
    one id follow each other by text; rows without id come first. Other columns are not read.

    Ids are cut into ranges of about bucket_bytes of text, each sorted in one task; the first
    document of a range is also sent to the range before. Cuts and firsts are a few numbers per range.
    """
    spark = docs.sparkSession
    least = -(2**63)
    source = docs.select(F.coalesce(F.col(id_col).cast("long"), F.lit(least)).alias("key"),
                         F.col(id_col).cast("long").alias("doc_id"),
                         F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    total = source.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, math.ceil(total / bucket_bytes))
    cuts: list[int] = []
    if n > 1:
        shares = [i / n for i in range(1, n)]
        cuts = sorted(set(source.agg(F.percentile_approx("key", shares, 20 * n)).first()[0]))
    shared = spark.sparkContext.broadcast(np.array(cuts, np.int64))

    @F.pandas_udf("long")
    def bucket(key: pd.Series) -> pd.Series:
        return pd.Series(np.searchsorted(shared.value, key.to_numpy(), "right"))

    placed = source.withColumn("bucket", bucket("key"))
    firsts = sorted((r["bucket"], r["first"]) for r in
                    source.select("key").withColumn("bucket", bucket("key"))
                    .groupBy("bucket").agg(F.min("key").alias("first")).collect())
    rows = [(after[1], own[0]) for own, after in zip(firsts, firsts[1:] + firsts[:1])]
    heads = spark.createDataFrame(pd.DataFrame(rows, columns=["key", "bucket"], dtype="int64"),
                                  "key long, bucket long")
    extra = source.join(F.broadcast(heads), "key").select("bucket", F.lit(True).alias("extra"), "key", "doc_id", "text")
    ranges = placed.select("bucket", F.lit(False).alias("extra"), "key", "doc_id", "text").unionByName(extra)
    return ranges.repartition(n, "bucket").sortWithinPartitions("bucket", "extra", "key", "text") \
        .select("bucket", "extra", "doc_id", "text").mapInArrow(_compare, _SCHEMA)
