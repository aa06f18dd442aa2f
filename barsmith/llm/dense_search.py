"""Ranked lexical search by dense blocked matrix multiplication.

The distinct terms of a tile of items are its vocabulary. A document tile becomes a dense matrix of
integer impacts, one row per vocabulary term that occurs in the tile. Item weights times impacts is one
BLAS product in float64 per vocabulary tile. Every entry is an integer, and a vocabulary tile is so narrow
that no partial sum reaches 2^53, so the products are exact in any order of addition; tiles are added as
64-bit integers. Each tile hands its best documents on with all ties, by score, then id, so the k best
of all tiles are the k best documents.

Terms are matched by a 64-bit hash and then byte by byte.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barsmith import session
from barsmith.llm import words

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
#: Largest impact of a term in a document.
IMPACT = 1_000_000
EXACT = 1 << 53


@dataclass(frozen=True)
class Settings:
    k: int = 50
    #: Items and vocabulary terms of one pass over the documents; more items take more passes. One item
    #: with more terms stands alone. An item counts with all its terms.
    items: int = 1024
    terms: int = 65_536
    #: Widest vocabulary tile of one product.
    width: int = 4096
    #: Candidates held before they are cut to the k best of each item.
    held: int = 200_000
    #: First groups in which an item's candidates of all tasks are ranked.
    groups: int = 1024


def terms_of(text: str | None) -> list[str]:
    """The terms of a text in order."""
    return [re.sub("[A-Z]+", lambda m: m.group().lower(), w) for w in TERM.findall(text or "")]


def weight(documents: int, frequency: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * frequency + 1)))


@dataclass
class Vocabulary:
    """Terms sorted by hash, with their bytes."""

    terms: list[str]
    hash: np.ndarray = field(init=False)
    data: np.ndarray = field(init=False)
    start: np.ndarray = field(init=False)
    length: np.ndarray = field(init=False)
    shared: int = field(init=False)  # most terms with one hash

    def __post_init__(self) -> None:
        h = self._hashes(self.terms)
        order = np.argsort(h, kind="stable")
        self.terms = [self.terms[i] for i in order]
        self.hash = h[order]
        raw = [t.encode() for t in self.terms]
        self.length = np.array([len(r) for r in raw], np.int64)
        self.start = np.cumsum(self.length) - self.length
        self.data = np.frombuffer(b"".join(raw), np.uint8)
        self.shared = int(np.unique(h, return_counts=True)[1].max()) if len(h) else 0

    @staticmethod
    def _hashes(terms: list[str]) -> np.ndarray:
        data, offsets = words.buffers(pa.array(terms, pa.string()))
        return words.hash_words(data, offsets, words.LETTERS_DIGITS).hash

    def match(self, found: words.Words, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the words that are terms, and of the terms."""
        if not len(self.hash) or not len(found.hash):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        at = np.searchsorted(self.hash, found.hash)
        words_at, terms_at = [], []
        for ahead in range(self.shared):
            word = np.flatnonzero(at + ahead < len(self.hash))
            term = at[word] + ahead
            equal = self.hash[term] == found.hash[word]
            word, term = word[equal], term[equal]
            same = self.length[term] == found.end[word] - found.start[word]
            word, term = word[same], term[same]
            if not len(word):
                continue
            size = self.length[term]
            begin = np.cumsum(size) - size
            inner = np.arange(size.sum()) - np.repeat(begin, size)
            equal = _LOWER[data[np.repeat(found.start[word], size) + inner]] == \
                self.data[np.repeat(self.start[term], size) + inner]
            whole = np.logical_and.reduceat(equal, begin)
            words_at.append(word[whole])
            terms_at.append(term[whole])
        if not words_at:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate(words_at), np.concatenate(terms_at)

    def counts(self, column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
        """Per block of texts: its range, the terms of each text, and (text, vocabulary term, occurrences)."""
        data, offsets = words.buffers(column)
        for low, high in words.blocks(offsets):
            part = data[offsets[low] : offsets[high]]
            found = words.hash_words(part, offsets[low : high + 1] - offsets[low], words.LETTERS_DIGITS)
            length = np.bincount(found.doc, minlength=high - low).astype(np.int64)
            word, term = self.match(found, part)
            cell, tf = np.unique(found.doc[word] * max(len(self.terms), 1) + term, return_counts=True)
            yield low, high, length, cell // max(len(self.terms), 1), cell % max(len(self.terms), 1), tf.astype(np.int64)


@dataclass
class Tile:
    """Items of one pass: for every pair of item and term their numbers, and the terms' weights."""

    vocabulary: Vocabulary
    item: np.ndarray
    term: np.ndarray
    items: int
    weight: np.ndarray = field(default_factory=lambda: np.zeros(0, np.int64))
    documents: int = 0
    length: int = 0

    @classmethod
    def of(cls, terms: list[list[str]]) -> Tile:
        vocabulary = Vocabulary(sorted({t for ts in terms for t in ts}))
        number = {t: i for i, t in enumerate(vocabulary.terms)}
        pairs = [(i, number[t]) for i, ts in enumerate(terms) for t in sorted(set(ts))]
        item, term = (np.array(c, np.int64) for c in (zip(*pairs) if pairs else ([], [])))
        return cls(vocabulary, item, term, len(terms))

    def width(self, most: int) -> int:
        """Columns of a product that keep every partial sum below 2^53."""
        largest = max(int(self.weight.max(initial=0)), 1) * IMPACT
        return max(1, min(most, (EXACT - 1) // largest))

    def scores(self, length: np.ndarray, doc: np.ndarray, term: np.ndarray, tf: np.ndarray, most: int) -> np.ndarray:
        """Exact scores, items by documents of a tile."""
        total = np.zeros((self.items, len(length)), np.int64)
        if not len(tf):
            return total
        m = 100 - 50 + (50 * length * self.documents) // self.length
        impact = (1_000_000_000 * tf) // (1000 * tf + 20 * m[doc])
        present, row = np.unique(term, return_inverse=True)
        width = self.width(most)
        column = np.full(len(self.vocabulary.terms), -1, np.int64)
        column[present] = np.arange(len(present))
        of_item = column[self.term]
        for low in range(0, len(present), width):
            n = min(width, len(present) - low)
            left = np.zeros((self.items, n))
            own = (of_item >= low) & (of_item < low + n)
            left[self.item[own], of_item[own] - low] = self.weight[self.term[own]]
            right = np.zeros((n, len(length)))
            own = (row >= low) & (row < low + n)
            right[row[own] - low, doc[own]] = impact[own]
            total += (left @ right).astype(np.int64)
        return total


class Best:
    """The k best documents of each item so far, with ties decided by id; null ids come last."""

    def __init__(self, items: int, settings: Settings):
        self.settings = settings
        self.least = np.ones(items, np.int64)
        self.parts: list[tuple[np.ndarray, ...]] = []
        self.size = 0

    def add(self, scores: np.ndarray, ids: np.ndarray, known: np.ndarray) -> None:
        item, doc = np.nonzero(scores >= self.least[:, None])
        self.parts.append((item, scores[item, doc], ids[doc], known[doc]))
        self.size += len(item)
        if self.size > self.settings.held:
            self.cut()

    def cut(self) -> tuple[np.ndarray, ...]:
        """Keep the k best of each item and raise what later documents must reach."""
        if not self.parts:
            return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, bool),)
        item, score, ids, known = map(np.concatenate, zip(*self.parts))
        order = np.lexsort((ids, ~known, -score, item))
        item, score, ids, known = item[order], score[order], ids[order], known[order]
        place = np.arange(len(item)) - np.searchsorted(item, item)
        keep = place < self.settings.k
        last = place == self.settings.k - 1
        self.least[item[last]] = score[last]
        self.parts = [(item[keep], score[keep], ids[keep], known[keep])]
        self.size = int(keep.sum())
        return self.parts[0]


def _tiles(items: DataFrame, settings: Settings) -> Iterator[tuple[list[int | None], list[list[str]]]]:
    """Items of one pass at a time, with their distinct terms; only a tile is on the driver."""
    ids: list[int | None] = []
    terms: list[list[str]] = []
    size = 0

    def distinct(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in words.slices(batches):
            found = [sorted(set(terms_of(t))) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.list_(pa.string()))], ["id", "terms"])

    stored = session.materialize(items.distinct().mapInArrow(distinct, "id long, terms array<string>"), "items")
    for row in stored.orderBy("id", "terms").toLocalIterator():
        if ids and (len(ids) >= settings.items or size + len(row["terms"]) > settings.terms):
            yield ids, terms
            ids, terms, size = [], [], 0
        ids.append(row["id"])
        terms.append(row["terms"])
        size += len(row["terms"])
    if ids:
        yield ids, terms


def search(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", item_text_col: str = "text", settings: Settings = Settings()) -> DataFrame:
    """The k best documents of every item: item_id, rank, doc_id, score.

    Only scores above 0 count; equal scores go by ascending id, a null id last. A null or empty text, or
    one without terms, is never found, and an item without terms finds nothing. Items equal in
    id and text are one item; texts that share an id are ranked apart under that id. Documents that
    repeat are all ranked. Whole texts of any length are read, other columns are not, whatever their
    names. An empty table of documents or items gives an empty result.
    """
    spark = docs.sparkSession
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    wanted = items.select(F.col(item_col).cast("long").alias("id"), F.col(item_text_col).cast("string").alias("text"))
    found = None
    for ids, terms in _tiles(wanted, settings):
        tile = _with_weights(texts, Tile.of(terms))
        if not tile.documents:
            continue
        one = session.materialize(_ranked(texts, tile, ids, settings), "ranked")
        found = one if found is None else found.union(one)
    if found is None:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    return found


def _with_weights(texts: DataFrame, tile: Tile) -> Tile:
    """The tile with corpus counts and weights, from one pass over all documents."""
    shared = texts.sparkSession.sparkContext.broadcast(tile.vocabulary)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary = shared.value
        df = np.zeros(len(vocabulary.terms), np.int64)
        documents = length = 0
        for batch in batches:
            for _, _, n, _, term, _ in vocabulary.counts(batch.column(0)):
                documents += int((n > 0).sum())
                length += int(n.sum())
                df += np.bincount(term, minlength=len(df))
        seen = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate([[-2, -1], seen]), pa.int64()),
             pa.array(np.concatenate([[documents, length], df[seen]]), pa.int64())], ["term", "n"])

    # A row per vocabulary term comes to the driver.
    rows = texts.select("text").mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()
    counts = {r["term"]: r["n"] for r in rows}
    tile.documents, tile.length = counts.get(-2, 0), counts.get(-1, 0)
    tile.weight = np.array([weight(tile.documents, counts.get(i, 0)) for i in range(len(tile.vocabulary.terms))], np.int64)
    return tile


def _ranked(texts: DataFrame, tile: Tile, ids: list[int | None], settings: Settings) -> DataFrame:
    """The k best documents of every item of the tile."""
    spark = texts.sparkSession
    shared = spark.sparkContext.broadcast(tile)

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tile = shared.value
        top = Best(tile.items, settings)
        for batch in batches:
            doc_ids = batch.column(0)
            known = np.asarray(doc_ids.is_valid())
            doc_ids = np.asarray(doc_ids.fill_null(0))
            for low, high, n, doc, term, tf in tile.vocabulary.counts(batch.column(1)):
                top.add(tile.scores(n, doc, term, tf, settings.width), doc_ids[low:high], known[low:high])
        item, score, found, known = top.cut()
        yield pa.RecordBatch.from_arrays(
            [pa.array(item, pa.int64()), pa.array(score, pa.int64()), pa.array(found, pa.int64(), mask=~known)],
            ["item", "score", "doc_id"])

    candidates = texts.mapInArrow(best, "item long, score long, doc_id long") \
        .withColumn("task", F.pmod(F.spark_partition_id(), F.lit(settings.groups)))

    def place(*keys: str) -> Window:
        return F.row_number().over(
            Window.partitionBy(*keys).orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last()))

    # Ranked in two steps, so no item gathers the candidates of all tasks at once.
    few = candidates.withColumn("place", place("item", "task")).where(F.col("place") <= settings.k)
    ranked = few.withColumn("rank", place("item")).where(F.col("rank") <= settings.k)
    names = spark.createDataFrame(list(enumerate(ids)), "item long, item_id long")
    return ranked.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")
