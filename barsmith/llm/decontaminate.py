"""Benchmark decontamination by spaced seeds.

A seed is a window of words of which a fixed mask ignores some positions, so a few substituted
words do not hide a copied passage. The seeds of test items and of documents are joined on their
hashes. A hit fixes a diagonal (word number in the document minus word number in the item); along
it the words are compared one by one and the best run, in which substitutions are allowed, is kept.

Documents drop seeds that cannot be in the test set by a Bloom bitmap of fixed size before the
join. What is left are short regions of a document around surviving seeds; only those are shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barsmith.llm import words

#: Bits of the bitmap: 2 MB, whatever the test set holds.
BITMAP_BITS = 24


@dataclass(frozen=True)
class Settings:
    masks: tuple[str, ...] = ("11111", "1101011", "10110011", "11001000111")
    reach: int = 24      # words around a surviving seed that can belong to an overlap
    least_words: int = 8     # an overlap has this many equal words, or all of a shorter item ...
    least_share: float = 0.5  # ... and this share of the item's words, or
    enough_words: int = 25   # this many equal words whatever the item's length, or
    copied_words: int = 13   # an unbroken run of this many
    identity: float = 0.8    # share of equal words within the overlap

    @property
    def offsets(self) -> list[list[int]]:
        return [[i for i, c in enumerate(m) if c == "1"] for m in self.masks]


def _seeds(hashes: np.ndarray, doc: np.ndarray, offsets: list[int], number: int) -> tuple[np.ndarray, np.ndarray]:
    """First word number and hash of every seed of one mask that lies within one text."""
    n = len(hashes) - offsets[-1]
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    factors = words.stream(100 + number, len(offsets)) | np.uint64(1)
    total = np.full(n, number + 1, np.uint64)
    for f, o in zip(factors, offsets):
        total += hashes[o : o + n] * f
    at = np.flatnonzero(doc[:n] == doc[offsets[-1] :])
    return at, words.mix(total[at])


def _slots(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    low = np.uint64((1 << BITMAP_BITS) - 1)
    return (values & low).astype(np.int64), ((values >> np.uint64(32)) & low).astype(np.int64)


def item_seeds(items: DataFrame, id_col: str, text_col: str, settings: Settings) -> DataFrame:
    """item_id, item_words (binary hashes), and per item the arrays `seeds` of (hash, word number)."""
    schema = "item_id long, item_words binary, seeds array<struct<seed:long,item_at:int>>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            data, offsets = words.buffers(batch.column(1))
            for i, key in enumerate(batch.column(0).to_pylist()):
                part = offsets[i : i + 2]
                h = words.hash_words(data[part[0] : part[1]], part - part[0], words.LETTERS_DIGITS).hash
                doc, seeds = np.zeros(len(h), np.int64), []
                for number, mask in enumerate(settings.offsets):
                    at, value = _seeds(h, doc, mask, number)
                    seeds += [{"seed": int(v), "item_at": int(a)} for a, v in zip(at, value.view(np.int64))]
                out.append({"item_id": key, "item_words": h.tobytes(), "seeds": seeds})
            kind = pa.schema([("item_id", pa.int64()), ("item_words", pa.binary()), ("seeds", pa.list_(
                pa.struct([("seed", pa.int64()), ("item_at", pa.int32())])))])
            yield pa.RecordBatch.from_pylist(out, schema=kind)

    return items.select(F.col(id_col).cast("long").alias("item_id"), F.col(text_col).cast("string").alias("text")) \
        .mapInArrow(run, schema)


def bitmap(seeds: DataFrame) -> np.ndarray:
    """A byte per slot pair, packed: which slots the test seeds use. At most 2**18 words are collected."""
    low = (1 << BITMAP_BITS) - 1
    slots = seeds.select(F.explode(F.array(
        F.col("seed").bitwiseAND(low), F.shiftrightunsigned("seed", 32).bitwiseAND(low))).alias("slot"))
    rows = slots.select(F.shiftright("slot", 6).alias("word"),
                        F.expr("shiftleft(1L, cast(slot & 63 as int))").alias("bit")) \
        .groupBy("word").agg(F.bit_or("bit").alias("bits")).collect()
    packed = np.zeros(1 << (BITMAP_BITS - 6), np.int64)
    for row in rows:
        packed[row["word"]] = row["bits"]
    return packed


def _holds(packed: np.ndarray, slot: np.ndarray) -> np.ndarray:
    return (packed[slot >> 6] >> (slot & 63)) & 1 == 1


def regions(docs: DataFrame, id_col: str, text_col: str, packed: np.ndarray, settings: Settings) -> DataFrame:
    """doc_id, first word number, word hashes and surviving seeds of each region of a document."""
    shared = docs.sparkSession.sparkContext.broadcast(packed)
    spans = [o[-1] + 1 for o in settings.offsets]
    kind = pa.schema([("doc_id", pa.int64()), ("first", pa.int64()), ("region", pa.binary()),
                      ("seeds", pa.list_(pa.struct([("seed", pa.int64()), ("doc_at", pa.int64())])))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = shared.value
        for batch in batches:
            ids = batch.column(0).to_pylist()
            data, offsets = words.buffers(batch.column(1))
            for low, high in words.blocks(offsets):
                part = offsets[low : high + 1]
                w = words.hash_words(data[part[0] : part[-1]], part - part[0], words.LETTERS_DIGITS)
                at, value, span = [], [], []
                for number, mask in enumerate(settings.offsets):
                    a, v = _seeds(w.hash, w.doc, mask, number)
                    one, two = _slots(v)
                    hit = np.flatnonzero(_holds(table, one))
                    hit = hit[_holds(table, two[hit])]
                    at.append(a[hit])
                    value.append(v[hit])
                    span.append(np.full(len(hit), spans[number]))
                at, value, span = map(np.concatenate, (at, value, span))
                if not len(at):
                    continue
                order = np.argsort(at, kind="stable")
                at, value, span = at[order], value[order], span[order]
                until = np.maximum.accumulate(at + span)
                doc = w.doc[at]
                new = np.flatnonzero((doc[1:] != doc[:-1]) | (at[1:] > until[:-1] + settings.reach)) + 1
                starts = np.searchsorted(w.doc, np.arange(high - low + 1))
                rows = []
                for s, e in zip(np.r_[0, new], np.r_[new, len(at)]):
                    d = int(doc[s])
                    a = max(int(starts[d]), int(at[s]) - settings.reach)
                    b = min(int(starts[d + 1]), int(until[e - 1]) + settings.reach)
                    rows.append({"doc_id": ids[low + d], "first": a - int(starts[d]), "region": w.hash[a:b].tobytes(),
                                 "seeds": [{"seed": int(v), "doc_at": int(x - starts[d])}
                                           for v, x in zip(value[s:e].view(np.int64), at[s:e])]})
                yield pa.RecordBatch.from_pylist(rows, schema=kind)

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")) \
        .where("text IS NOT NULL") \
        .mapInArrow(run, "doc_id long, first long, region binary, seeds array<struct<seed:long,doc_at:long>>")


def best_run(equal: np.ndarray, identity: float) -> tuple[int, int]:
    """Start and end of the run with the best balance of equal and different words.

    An equal word counts 1 - identity, a different one -identity, so the best run never has a
    smaller share of equal words than identity; of equally good runs the first is taken.
    """
    if not len(equal):
        return 0, 0
    gain = np.where(equal, 1 - identity, -identity)
    total = np.concatenate([[0.0], np.cumsum(gain)])
    floor = np.minimum.accumulate(total)
    end = int(np.argmax(np.round(total - floor, 9)))
    start = int(np.flatnonzero(total[: end + 1] == floor[end])[-1])
    return start, end


def longest_copy(equal: np.ndarray) -> int:
    """Length of the longest run of equal words."""
    ends = np.flatnonzero(np.concatenate([[True], ~equal, [True]]))
    return int(np.diff(ends).max()) - 1


def overlaps(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             item_col: str = "item_id", item_text: str = "text", settings: Settings = Settings()) -> DataFrame:
    """One row per document and test item that overlap: doc_id, item_id, first_word and end_word in
    the document (words of letters and digits, A-Z as a-z), equal_words, item_words.

    The overlap is the longest of the diagonals' best runs (then the first). A null or empty text on
    either side overlaps with nothing; an item with fewer words than the shortest mask (5) cannot be
    found, one with fewer than `least_words` only if all its words are copied. Otherwise it takes the
    share `identity` of the item's words on one diagonal, wherever the changed ones stand, or a best run with
    half of the item's words and `least_words`, or `enough_words`, or `copied_words` unbroken. Rows that
    repeat a document or an item give the same pair once. A null doc_id is a document of its own kind: its
    rows are compared like others and share the null id. Texts of any length are compared, an empty table
    on either side gives an empty result, and other columns are not read.
    """
    from barsmith import session

    seeds = session.materialize(item_seeds(items, item_col, item_text, settings), "item_seeds")
    flat = seeds.select("item_id", "item_words", F.explode("seeds").alias("s")) \
        .select("item_id", "item_words", "s.seed", "s.item_at")
    found = regions(docs, id_col, text_col, bitmap(flat.select("seed")), settings) \
        .withColumn("part", F.xxhash64("doc_id", "first", "region"))
    found = session.materialize(found, "regions")
    hits = found.select("doc_id", "first", "part", F.explode("seeds").alias("s")) \
        .select("doc_id", "first", "part", "s.seed", "s.doc_at")
    diagonals = hits.join(flat.select("item_id", "seed", "item_at"), "seed") \
        .select("doc_id", "first", "part", "item_id", (F.col("doc_at") - F.col("item_at")).alias("shift")).distinct()
    texts = seeds.select("item_id", "item_words").distinct()
    same = F.col("r.doc_id").eqNullSafe(F.col("d.doc_id")) & (F.col("r.part") == F.col("d.part"))
    pairs = diagonals.alias("d").join(found.select("doc_id", "part", "region").distinct().alias("r"), same) \
        .select("d.doc_id", "d.first", "d.item_id", "d.shift", "r.region") \
        .join(texts, F.col("d.item_id").eqNullSafe(texts["item_id"])) \
        .select("d.doc_id", "d.first", "d.item_id", "d.shift", "region", "item_words")
    schema = "doc_id long, item_id long, first_word long, end_word long, equal_words long, item_words long"
    kind = pa.schema([(c.split()[0], pa.int64()) for c in schema.split(", ")])

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc, first, item, shift, region, text in zip(*(c.to_pylist() for c in batch.columns)):
                a, b = np.frombuffer(region, np.uint64), np.frombuffer(text, np.uint64)
                low, high = max(first, shift), min(first + len(a), shift + len(b))
                equal = a[low - first : high - first] == b[low - shift : high - shift]
                s, e = best_run(equal, settings.identity)
                n = int(equal[s:e].sum())
                need = max(min(settings.least_words, len(b)), settings.least_share * len(b))
                if n >= min(need, settings.enough_words) or longest_copy(equal) >= settings.copied_words:
                    out.append((doc, item, low + s, low + e, n, len(b)))
                elif len(b) >= settings.least_words and equal.sum() >= settings.identity * len(b):
                    own = np.flatnonzero(equal)  # most of the item, wherever the changed words stand
                    out.append((doc, item, low + own[0], low + own[-1] + 1, len(own), len(b)))
            yield pa.RecordBatch.from_pandas(pd.DataFrame(out, columns=kind.names, dtype=object), schema=kind,
                                             preserve_index=False)

    best = pairs.mapInArrow(verify, schema).groupBy("doc_id", "item_id").agg(F.max_by(
        F.struct("first_word", "end_word", "equal_words", "item_words"),
        F.struct("equal_words", -F.col("first_word"))).alias("o"))
    return best.select("doc_id", "item_id", "o.*")
