"""Language identification in two steps: a family of languages, then one language of the family.

Both steps are linear support vector machines on hashed byte bigrams and trigrams of letters.
Families are told apart by one machine per pair of families, and the languages within a family by
one machine per pair of its languages (one-versus-one); the most votes win, then the larger sum of
margins. The machines are fitted on a bounded sample of labelled rows; prediction reads whole texts.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barsmith.llm import words

#: Language code to family. A language that is not listed is a family of its own.
FAMILIES = {
    "en": "germanic", "de": "germanic", "nl": "germanic", "sv": "germanic", "da": "germanic", "no": "germanic",
    "fr": "romance", "es": "romance", "it": "romance", "pt": "romance", "ro": "romance", "ca": "romance",
    "ru": "slavic", "pl": "slavic", "cs": "slavic", "uk": "slavic", "bg": "slavic", "sr": "slavic",
}
UNDETERMINED = "und"
#: Texts whose feature vectors are in memory together.
BLOCK_TEXTS = 256


@dataclass(frozen=True)
class Settings:
    dims: int = 2048           # half for bigrams, half for trigrams
    sample_rows: int = 800     # labelled rows per language to fit on, in expectation
    sample_total: int = 51_200  # labelled rows of all languages; with more than 64 they share it ...
    least_rows: int = 20       # ... down to this many rows of each
    cost: float = 1.0
    rounds: int = 30
    families: dict[str, str] = field(default_factory=lambda: dict(FAMILIES))


_LETTER = np.full(256, 32, np.uint8)
_LETTER[128:] = np.arange(128, 256)
_LETTER[97:123] = _LETTER[65:91] = np.arange(97, 123)


def features(data: np.ndarray, offsets: np.ndarray, dims: int) -> tuple[np.ndarray, np.ndarray]:
    """A unit vector of gram counts (square roots) per text, and whether the text has a letter."""
    n, half = len(offsets) - 1, dims // 2
    size = len(data) + 2 * n
    buffer = np.full(size, 32, np.uint32)
    lengths = np.diff(offsets)
    doc = np.repeat(np.arange(n), lengths)
    buffer[np.arange(len(data)) + 2 * doc + 1] = _LETTER[data]
    owner = np.repeat(np.arange(n), lengths + 2)
    pair = buffer[:-1] * np.uint32(256) + buffer[1:]
    two = (pair * np.uint32(0x9E3779B1)) >> np.uint32(16)
    three = ((pair[:-1] * np.uint32(256) + buffer[2:]) * np.uint32(0x85EBCA6B)) >> np.uint32(16)
    blank = np.uint32(32 * 256 + 32)
    counts = np.zeros(n * dims)
    for value, keep, shift in ((two, pair != blank, 0), (three, pair[:-1] != blank, half)):
        at = owner[: len(value)] * dims + shift + (value % np.uint32(half)).astype(np.int64)
        counts += np.bincount(at[keep], minlength=n * dims)
    x = np.sqrt(counts.reshape(n, dims))
    norm = np.linalg.norm(x, axis=1, keepdims=True)
    ascii_letters = np.bincount(doc[(_LETTER[data] != 32) & (data < 128)], minlength=n) > 0
    beyond = np.bincount(doc[data >= 128], minlength=n) > 0
    for i in np.flatnonzero(beyond & ~ascii_letters):
        text = data[offsets[i] : offsets[i + 1]].tobytes().decode("utf-8", "replace")
        ascii_letters[i] = any(c.isalpha() for c in text)
    return x / np.maximum(norm, 1e-12), ascii_letters


def fit_machine(x: np.ndarray, y: np.ndarray, cost: float, rounds: int) -> tuple[np.ndarray, float, float]:
    """Weights (with a bias at the end) by dual coordinate descent on the squared hinge, and the
    slope and shift that turn a margin into a probability."""
    x = np.hstack([x, np.ones((len(x), 1))])
    w, alpha = np.zeros(x.shape[1]), np.zeros(len(x))
    diagonal = 0.5 / cost
    square = (x * x).sum(axis=1) + diagonal
    order = np.random.default_rng(0)
    for _ in range(rounds):
        for i in order.permutation(len(x)):
            gradient = y[i] * (x[i] @ w) - 1 + diagonal * alpha[i]
            new = max(alpha[i] - gradient / square[i], 0.0)
            if new != alpha[i]:
                w += (new - alpha[i]) * y[i] * x[i]
                alpha[i] = new
    margin, target = x @ w, np.where(y > 0, 1 - 1 / (len(y) + 2), 1 / (len(y) + 2))
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * margin + b, -30, 30)))
        g, h = p - target, np.maximum(p * (1 - p), 1e-6)
        ha, hb, hab = (h * margin**2).sum() + 1e-3, h.sum() + 1e-3, (h * margin).sum()
        ga, gb = (g * margin).sum(), g.sum()
        det = ha * hb - hab * hab
        a, b = a - (hb * ga - hab * gb) / det, b - (ha * gb - hab * ga) / det
    return w, float(np.clip(a, 0.1, 50)), float(np.clip(b, -10, 10))


@dataclass
class Duel:
    """One machine per pair of names; the most votes win."""

    names: list[str]
    machines: list[tuple[int, int, np.ndarray, float, float]]

    @classmethod
    def fit(cls, x: np.ndarray, label: np.ndarray, settings: Settings) -> "Duel":
        names, made = sorted(set(label.tolist())), []
        for i, j in combinations(range(len(names)), 2):
            own = (label == names[i]) | (label == names[j])
            y = np.where(label[own] == names[i], 1.0, -1.0)
            made.append((i, j, *fit_machine(x[own], y, settings.cost, settings.rounds)))
        return cls(names, made)

    def predict(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number of the winner of each row and its least probability in its own pairs."""
        n = len(x)
        votes, margins = np.zeros((n, len(self.names))), np.zeros((n, len(self.names)))
        chance = np.ones((n, len(self.names)))
        for i, j, w, a, b in self.machines:
            margin = x @ w[:-1] + w[-1]
            p = 1 / (1 + np.exp(-np.clip(a * margin + b, -30, 30)))
            votes[:, i] += margin >= 0
            votes[:, j] += margin < 0
            margins[:, i] += margin
            margins[:, j] -= margin
            chance[:, i] = np.minimum(chance[:, i], p)
            chance[:, j] = np.minimum(chance[:, j], 1 - p)
        top = votes == votes.max(axis=1, keepdims=True)
        winner = np.where(top, margins, -np.inf).argmax(axis=1)
        return winner, chance[np.arange(n), winner]


@dataclass
class Model:
    dims: int
    families: Duel
    languages: dict[str, Duel]

    def predict(self, data: np.ndarray, offsets: np.ndarray) -> tuple[list[str], list[float]]:
        x, letters = features(data, offsets, self.dims)
        names = np.full(len(x), UNDETERMINED, object)
        score = np.zeros(len(x))
        if self.families.names:
            family, sure = self.families.predict(x)
            for f, name in enumerate(self.families.names):
                rows = np.flatnonzero((family == f) & letters)
                if len(rows):
                    own, chance = self.languages[name].predict(x[rows])
                    names[rows] = np.array(self.languages[name].names, object)[own]
                    score[rows] = sure[rows] * chance
        return names.tolist(), np.round(score, 6).tolist()


def fit(labelled: DataFrame, id_col: str, text_col: str, lang_col: str, settings: Settings = Settings()) -> Model:
    """Fit on about sample_rows rows of each language, chosen by a hash of id and text.

    Every language is learned; the number of machines grows with the square of the languages.
    """
    rows = labelled.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"),
                           F.col(lang_col).cast("string").alias("lang")) \
        .where("text IS NOT NULL AND lang IS NOT NULL")
    counts = {r["lang"]: r["n"] for r in rows.groupBy("lang").agg(F.count("*").alias("n"))
              .orderBy("lang").collect()}
    empty = Duel([], [])
    if not counts:
        return Model(settings.dims, empty, {})
    most = max(settings.least_rows, min(settings.sample_rows, settings.sample_total // len(counts)))
    share = F.create_map(*[F.lit(v) for k, n in counts.items() for v in (k, most / n)])
    chosen = rows.where(
        F.pmod(F.xxhash64("id", "text"), F.lit(1_000_003)) / 1_000_003 < F.element_at(share, F.col("lang")))
    dims = settings.dims

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = words.buffers(batch.column("text"))
            for low, high in words.blocks(offsets, most=BLOCK_TEXTS):
                part = offsets[low : high + 1]
                x, letters = features(data[part[0] : part[-1]], part - part[0], dims)
                yield pa.RecordBatch.from_arrays(
                    [batch.column("lang").slice(low, high - low).filter(pa.array(letters)),
                     pa.array([v.astype(np.float32).tobytes() for v in x[letters]], pa.binary())],
                    names=["lang", "x"])

    sample = sorted((r["lang"], bytes(r["x"])) for r in
                    chosen.select("text", "lang").mapInArrow(run, "lang string, x binary").collect())
    if not sample:
        return Model(dims, empty, {})
    label = np.array([s[0] for s in sample], object)
    x = np.frombuffer(b"".join(s[1] for s in sample), np.float32).reshape(len(sample), dims)
    family = np.array([settings.families.get(v, f"only {v}") for v in label], object)
    return Model(dims, Duel.fit(x, family, settings),
                 {f: Duel.fit(x[family == f], label[family == f], settings) for f in sorted(set(family.tolist()))})


def held_out(id_col: str, folds: int = 3, fold: int = 1) -> Column:
    """Rows that are never learned from; so is a row without id."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string")), F.lit(folds)) == fold, F.lit(True))


def predict_rows(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """The rows with lang_pred and score, in 0 to 1, added. Null texts and texts without a letter are
    `und` with score 0; so is every text if nothing could be learned. Columns of these two names in
    the input are replaced."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kept = docs.drop("lang_pred", "score")
    place = kept.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = words.buffers(batch.column(place))
            names: list[str] = []
            score: list[float] = []
            for low, high in words.blocks(offsets, most=BLOCK_TEXTS):
                part = offsets[low : high + 1]
                found = shared.value.predict(data[part[0] : part[-1]], part - part[0])
                names += found[0]
                score += found[1]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(names, pa.string()), pa.array(score, pa.float64())],
                names=[*batch.schema.names, "lang_pred", "score"])

    schema = T.StructType([*kept.schema.fields, T.StructField("lang_pred", T.StringType()),
                           T.StructField("score", T.DoubleType())])
    return kept.mapInArrow(run, schema)


def predict(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: doc_id, lang_pred, score; only these two columns are read."""
    return predict_rows(docs.select(F.col(id_col).cast("long").alias("doc_id"),
                                    F.col(text_col).cast("string").alias("text")), model) \
        .select("doc_id", "lang_pred", "score")
