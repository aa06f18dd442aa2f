"""Near-duplicate groups by b-bit MinHash.

Every document becomes a set of word shingles. MinHash minima are cut into bands; documents that
agree on a band are candidates. The low bits of the minima, packed into longs, estimate the
similarity of a candidate pair by counting equal lanes, corrected for lanes that agree by chance.
Candidates far below the threshold are left out by that estimate; the rest is confirmed on the
full shingle sets.

* Equal sets form a class with one representative, so copies never become pairs.
* Round one links every member of a band's bucket with the smallest member only. The buckets that
  still hold several components give the pairs across them, each pair once, in the first bucket it
  shares. Round two confirms a member's most similar partner of each other component, round three
  the pairs whose components still differ. Nothing is capped: after the rounds every candidate pair
  is confirmed, refused, or inside one component.
* 32 bands of 5 minima miss a pair at similarity 0.85 with probability 7e-9. The estimate has a
  standard deviation of 0.0167 there, and the margin is 4.5 of them (3e-6 for a pair just at the
  threshold, 3e-8 at 0.87).
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barsmith import session
from barsmith.llm import components, words

LANE_BITS = 2


@dataclass(frozen=True)
class Settings:
    shingle: int = 5
    bands: int = 32
    rows: int = 5
    hashes: int = 640  # minima of the estimate; the bands use the first of them
    percent: int = 85  # links have 100 * intersection >= percent * union
    margin: float = 0.075  # estimates this far below the threshold are still confirmed
    seed: int = 1

    @property
    def longs(self) -> int:
        return -(-self.hashes * LANE_BITS // 64)


def sets_of(column: pa.Array, settings: Settings) -> Iterator[tuple[int, list[np.ndarray]]]:
    """First text number and the sorted distinct shingles of each text, block by block."""
    data, offsets = words.buffers(column)
    for low, high in words.blocks(offsets):
        part = offsets[low : high + 1]
        found = words.hash_words(data[part[0] : part[-1]], part - part[0], words.NOT_BLANK)
        doc, value = words.shingles(found, high - low, settings.shingle)
        cut = np.searchsorted(doc, np.arange(1, high - low))
        yield low, [np.unique(x) for x in np.split(value, cut)]


def _minima(sets: list[np.ndarray], settings: Settings) -> np.ndarray:
    """Minima of `hashes` random bijections of 32-bit values; no set may be empty."""
    lengths = np.array([len(s) for s in sets])
    starts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
    x = (np.concatenate(sets) >> np.uint64(32)).astype(np.uint32)
    a = words.stream(settings.seed, settings.hashes).astype(np.uint32) | np.uint32(1)
    b = words.stream(settings.seed + 1, settings.hashes).astype(np.uint32)
    out, y = np.empty((settings.hashes, len(sets)), np.uint32), np.empty_like(x)
    for i in range(settings.hashes):
        np.multiply(x, a[i], out=y)
        y += b[i]
        y ^= y >> np.uint32(15)
        y *= np.uint32(0x2C1B3C6D)
        out[i] = np.minimum.reduceat(y, starts)
    return out.T


def _band_hashes(minima: np.ndarray, settings: Settings) -> np.ndarray:
    """One 64-bit value per band; the band number is part of it."""
    used = minima[:, : settings.bands * settings.rows]
    parts = used.reshape(len(used), settings.bands, settings.rows).astype(np.uint64)
    factors = words.stream(settings.seed + 2, settings.rows) | np.uint64(1)
    total = (parts * factors).sum(axis=2, dtype=np.uint64)
    return words.mix(total + words.stream(settings.seed + 3, settings.bands)).view(np.int64)


def _lanes(minima: np.ndarray, settings: Settings) -> np.ndarray:
    """The low bits of all minima, packed into longs."""
    per = 64 // LANE_BITS
    low = np.zeros((len(minima), settings.longs * per), np.uint64)
    low[:, : settings.hashes] = minima & np.uint32((1 << LANE_BITS) - 1)
    shift = (np.arange(per) * LANE_BITS).astype(np.uint64)
    return (low.reshape(len(minima), settings.longs, per) << shift).sum(axis=2, dtype=np.uint64).view(np.int64)


def sketches(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             settings: Settings = Settings()) -> DataFrame:
    """doc_id, n_shingles, key_a, key_b (the set), bands, lanes; sets without shingles have no bands."""
    schema = "doc_id long, n_shingles long, key_a long, key_b long, bands array<long>, lanes array<long>"
    kinds = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("key_a", pa.int64()),
                       ("key_b", pa.int64()), ("bands", pa.list_(pa.int64())), ("lanes", pa.list_(pa.int64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            for low, sets in sets_of(batch.column(1), settings):
                full = [i for i, s in enumerate(sets) if len(s)]
                bands: list = [[] for _ in sets]
                lanes: list = [[] for _ in sets]
                if full:
                    minima = _minima([sets[i] for i in full], settings)
                    for i, x, y in zip(full, _band_hashes(minima, settings), _lanes(minima, settings)):
                        bands[i], lanes[i] = x, y
                a = np.array([words.mix(s).sum(dtype=np.uint64) for s in sets], np.uint64).view(np.int64)
                b = np.array([words.mix(s ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64) for s in sets],
                             np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(low, len(sets)), pa.array([len(s) for s in sets], pa.int64()), pa.array(a),
                     pa.array(b), pa.array(bands, pa.list_(pa.int64())), pa.array(lanes, pa.list_(pa.int64()))],
                    schema=kinds)

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")) \
        .mapInArrow(run, schema)


def estimate(a: Column, b: Column, settings: Settings) -> Column:
    """Collision-corrected similarity of two packed signatures."""
    ones = F.lit(int(np.uint64(0x5555555555555555).view(np.int64)))
    differ = F.lit(0)
    for i in range(settings.longs):
        x = a[i].bitwiseXOR(b[i])
        differ = differ + F.bit_count(x.bitwiseOR(F.shiftrightunsigned(x, 1)).bitwiseAND(ones))
    chance = 1 / (1 << LANE_BITS)
    return (1 - differ / settings.hashes - chance) / (1 - chance)


def _shingle_sets(docs: DataFrame, settings: Settings) -> DataFrame:
    """doc_id and its distinct shingles as sorted 64-bit values in binary."""
    kinds = pa.schema([("doc_id", pa.int64()), ("shingles", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, sets in sets_of(batch.column(1), settings):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(low, len(sets)), pa.array([s.tobytes() for s in sets], pa.binary())],
                    schema=kinds)

    return docs.mapInArrow(run, "doc_id long, shingles binary")


def confirm(pairs: DataFrame, sets: DataFrame, settings: Settings) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough."""
    kinds = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column("set_a"), batch.column("set_b")):
                left = np.frombuffer(x.as_buffer(), np.uint64)
                right = np.frombuffer(y.as_buffer(), np.uint64)
                both = len(np.intersect1d(left, right, assume_unique=True))
                keep.append(100 * both >= settings.percent * (len(left) + len(right) - both) > 0)
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [batch.column("a").filter(mask), batch.column("b").filter(mask)], schema=kinds)

    left = sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("set_a"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("set_b"))
    return pairs.join(right, "b").join(left, "a").select("a", "b", "set_a", "set_b") \
        .mapInArrow(run, "a long, b long").distinct()


def _across(shared: DataFrame, labels: DataFrame, floor: float, settings: Settings) -> DataFrame:
    """Pairs a < b of a bucket whose components differ and whose estimated likeness suffices.

    A pair that shares several buckets is made in the first of them only.
    """
    seen = _labelled(shared.select("band", "earlier", "doc_id", "lanes", "n_shingles"), labels, "doc_id", "component")
    mixed = seen.groupBy("band").agg(F.min("component").alias("x"), F.max("component").alias("y")) \
        .where("x < y").select("band")
    rest = session.materialize(seen.join(mixed, "band"), "open")
    left = rest.select("band", F.col("earlier").alias("ea"), F.col("doc_id").alias("a"), F.col("lanes").alias("la"),
                       F.col("component").alias("ca"), F.col("n_shingles").alias("na"))
    right = rest.select("band", F.col("earlier").alias("eb"), F.col("doc_id").alias("b"), F.col("lanes").alias("lb"),
                        F.col("component").alias("cb"), F.col("n_shingles").alias("nb"))
    likeness = estimate(F.col("la"), F.col("lb"), settings)
    near = (F.col("a") < F.col("b")) & (F.col("ca") != F.col("cb")) \
        & (100 * F.least("na", "nb") >= settings.percent * F.greatest("na", "nb")) & (likeness >= floor) \
        & ~F.arrays_overlap("ea", "eb")
    return left.join(right, (left["band"] == right["band"]) & near) \
        .select("a", "b", "ca", "cb", likeness.alias("likeness"))


def _labelled(rows: DataFrame, labels: DataFrame, node: str, name: str) -> DataFrame:
    """The rows with the component of a node; a node without links is its own."""
    return rows.join(labels.select(F.col("node").alias(node), F.col("component").alias(name)), node, "left") \
        .withColumn(name, F.coalesce(name, node))


def _grown(links: DataFrame, more: DataFrame) -> DataFrame:
    grown = session.materialize(links.unionByName(more), "links")
    session.discard(links)
    return grown


def groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           settings: Settings = Settings()) -> DataFrame:
    """One row per input row: doc_id, n_shingles, component_id (smallest linked id), kept.

    A null or wordless text has no shingles and is linked with nothing. Rows that repeat an id are
    one document: it is linked by any of its texts. A row without id takes no part: its
    component_id is null and it is kept. Other columns are not read.
    """
    sketch = session.materialize(sketches(docs, id_col, text_col, settings), "sketches")
    linked = sketch.where("n_shingles > 0 AND doc_id IS NOT NULL")
    keys = ["key_a", "key_b"]
    classes = session.materialize(linked.groupBy(*keys, "n_shingles").agg(
        F.min("doc_id").alias("node"), F.count("*").alias("members")), "classes")
    # (id, representative) for members of classes with more than one row
    copies = linked.select("doc_id", *keys).join(classes.where("members > 1").select(*keys, "node"), keys) \
        .where("doc_id <> node").select("doc_id", "node").distinct()

    nodes = linked.select("doc_id", *keys, "bands", "lanes") \
        .join(classes.select(*keys, "n_shingles", F.col("node").alias("doc_id")), [*keys, "doc_id"]).distinct()
    buckets = session.materialize(
        nodes.select("doc_id", *keys, F.posexplode("bands").alias("at", "band")), "buckets")
    ends = buckets.groupBy("band").agg(F.min("doc_id").alias("a"), F.max("doc_id").alias("last")) \
        .where("a < last").select("band", "a")
    # A row's earlier bands are added to shared buckets only; they are as many as its bands.
    members = buckets.join(ends, "band").join(
        nodes.select("doc_id", *keys, "bands", "n_shingles", "lanes"), ["doc_id", *keys]).select(
        "doc_id", "band", F.slice("bands", F.lit(1), F.col("at")).alias("earlier"), "a", "n_shingles", "lanes")
    shared = session.materialize(members, "shared")
    session.discard(buckets)

    floor = settings.percent / 100 - settings.margin
    centre = shared.where("doc_id = a").select("band", F.col("lanes").alias("centre"))
    star = shared.where("doc_id > a").join(centre.dropDuplicates(["band"]), "band") \
        .where(estimate(F.col("lanes"), F.col("centre"), settings) >= floor) \
        .select("a", F.col("doc_id").alias("b")).distinct()
    crowd = shared.select("doc_id").distinct()
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    sets = session.materialize(_shingle_sets(source.join(crowd, "doc_id", "left_semi"), settings), "sets")
    links = session.materialize(confirm(star, sets, settings), "links")
    labels = components.label(links)
    cross = session.materialize(_across(shared, labels, floor, settings).join(star, ["a", "b"], "left_anti"), "cross")
    one = cross.groupBy("a", "cb").agg(F.max_by("b", "likeness").alias("b")).select("a", "b")
    two = cross.groupBy("b", "ca").agg(F.max_by("a", "likeness").alias("a")).select("a", "b")
    best = session.materialize(one.union(two).distinct(), "best")
    links = _grown(links, confirm(best, sets, settings))
    session.discard(labels)
    labels = components.label(links)
    rest = _labelled(_labelled(cross.select("a", "b"), labels, "a", "ca"), labels, "b", "cb") \
        .where("ca <> cb").join(best, ["a", "b"], "left_anti")
    links = _grown(links, confirm(rest.select("a", "b"), sets, settings))
    for frame in (labels, cross, best):
        session.discard(frame)
    edges = session.materialize(links.union(copies.select("node", "doc_id")).toDF("a", "b"), "edges")
    final = components.label(edges)
    for frame in (shared, sets, links, edges, classes):
        session.discard(frame)
    return sketch.select("doc_id", "n_shingles") \
        .join(final.select(F.col("node").alias("doc_id"), "component"), "doc_id", "left") \
        .select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"),
                F.coalesce(F.col("component").isNull() | (F.col("component") == F.col("doc_id")), F.lit(True))
                .alias("kept"))
