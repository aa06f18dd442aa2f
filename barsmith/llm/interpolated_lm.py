"""A bigram language model by deleted interpolation.

The probability of a word is a mixture of its relative frequency after the word before, its relative
frequency, and a uniform share: weights depend on the bucket of the context's frequency and are learned by
expectation-maximisation on the counts of a held-out part of the training documents.

Counts never go to the driver. Documents are dealt into chunks by a hash. A chunk sends its distinct
words and bigrams, sorted, with their counts, to buckets by hash range; a bucket adds the counts of
all chunks and answers every chunk with the totals of just the keys that it sent. So one message counts
and asks, a frequent word has one entry per chunk, and both messages grow with the text. A second
pass over a chunk scores its documents with the answers. The driver gets the numbers of tokens and
words, and for learning a histogram of bounded size.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barsmith import session
from barsmith.llm import words

_END, _BEGIN = (int(v) for v in words.stream(71, 2))
_PAIR = words.stream(72, 2) | np.uint64(1)
#: Context buckets: 0 for unseen, else one more than the whole part of log2 of the count, up to this.
CONTEXTS = 41
_STEPS = 4  # histogram cells per factor of two


@dataclass(frozen=True)
class Settings:
    chunk_bytes: int = 6 << 20
    deleted: int = 10    # one in so many training documents is held out to learn the weights
    rounds: int = 60
    seed: int = 3


@dataclass
class Tokens:
    """Words and end marks of a block of documents: hashes, hashes of the bigrams that end in them,
    contexts, and document numbers."""

    doc: np.ndarray
    word: np.ndarray
    pair: np.ndarray
    context: np.ndarray


def tokens(data: np.ndarray, offsets: np.ndarray) -> Tokens:
    """Tokens of every text, each followed by one end mark; a text without words has the end mark alone."""
    n = len(offsets) - 1
    found = words.hash_words(data, offsets, words.NOT_BLANK)
    counts = np.bincount(found.doc, minlength=n)
    ends = np.cumsum(counts + 1) - 1
    word = np.empty(len(found.hash) + n, np.uint64)
    inner = np.ones(len(word), bool)
    inner[ends] = False
    word[inner] = found.hash
    word[ends] = np.uint64(_END)
    context = np.empty_like(word)
    context[1:] = word[:-1]
    context[np.concatenate([[0], ends[:-1] + 1])[:n]] = np.uint64(_BEGIN)
    return Tokens(np.repeat(np.arange(n), counts + 1), word,
                  words.mix(context * _PAIR[0] + word * _PAIR[1]), context)


def chunk_tokens(column: pa.ChunkedArray) -> Tokens:
    """All tokens of a chunk's texts."""
    data, offsets = words.buffers(column)
    parts = []
    for low, high in words.blocks(offsets):
        part = offsets[low : high + 1]
        t = tokens(data[part[0] : part[-1]], part - part[0])
        t.doc += low
        parts.append(t)
    if not parts:
        empty = np.zeros(0, np.uint64)
        return Tokens(np.zeros(0, np.int64), empty, empty, empty)
    return Tokens(*(np.concatenate([getattr(p, f) for p in parts]) for f in ("doc", "word", "pair", "context")))


def _pack(keys: np.ndarray) -> bytes:
    """Sorted keys as differences, byte by byte over all keys, so high zero bytes lie together."""
    return np.diff(keys, prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8).T.tobytes()


def _unpack(raw: bytes) -> np.ndarray:
    spread = np.frombuffer(raw, np.uint8).reshape(8, -1).T
    return np.cumsum(np.ascontiguousarray(spread).view(np.uint64).ravel(), dtype=np.uint64)


def _cuts(buckets: int) -> np.ndarray:
    """Keys at which the buckets of equal hash ranges begin, without the first."""
    return np.array([(i << 64) // buckets for i in range(1, buckets)], np.uint64)


def _requests(t: Tokens, trained: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Order (1 words, 2 bigrams), sorted distinct keys that a chunk needs, their training counts."""
    learn = trained[t.doc]
    for order, keys in ((1, t.word), (2, t.pair)):
        distinct, place = np.unique(keys, return_inverse=True)
        yield order, distinct, np.bincount(place[learn], minlength=len(distinct))


_MESSAGE = "turn int, bucket int, chunk long, deleted boolean, keys binary, counts binary"
_MESSAGE_KIND = pa.schema([("turn", pa.int32()), ("bucket", pa.int32()), ("chunk", pa.int64()),
                           ("deleted", pa.bool_()), ("keys", pa.binary()), ("counts", pa.binary())])
_ANSWER = "chunk long, deleted boolean, turn int, bucket int, total binary, kept binary, tokens long, types long, kept_tokens long"
_ANSWER_KIND = pa.schema([("chunk", pa.int64()), ("deleted", pa.bool_()), ("turn", pa.int32()), ("bucket", pa.int32()),
                          ("total", pa.binary()), ("kept", pa.binary()), ("tokens", pa.int64()), ("types", pa.int64()),
                          ("kept_tokens", pa.int64())])


def _send(buckets: int):
    cuts = _cuts(buckets)

    def run(table: pa.Table) -> pa.Table:
        chunk, deleted = table["chunk"][0].as_py(), table["deleted"][0].as_py()
        trained = table["trained"].combine_chunks().to_numpy(zero_copy_only=False)
        rows = []
        for order, keys, counts in _requests(chunk_tokens(table["text"]), trained):
            edge = np.concatenate([[0], np.searchsorted(keys, cuts), [len(keys)]])
            for b, (low, high) in enumerate(zip(edge[:-1], edge[1:])):
                if low < high:
                    rows.append((order, b, chunk, deleted, _pack(keys[low:high]),
                                 counts[low:high].astype(np.uint32).view(np.uint8).reshape(-1, 4).T.tobytes()))
        return pa.Table.from_arrays([pa.array(c, k.type) for c, k in zip(zip(*rows), _MESSAGE_KIND)],
                                    schema=_MESSAGE_KIND) if rows else _MESSAGE_KIND.empty_table()

    return run


def _spread(raw: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(4, -1).T).view(np.uint32).ravel()


def _squeeze(counts: np.ndarray) -> bytes:
    """Counts byte by byte over all keys; high bytes are mostly zero and compress away."""
    return counts.astype(np.uint64).view(np.uint8).reshape(-1, 8).T.tobytes()


def _unsqueeze(raw: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(8, -1).T).view(np.uint64).ravel().astype(np.int64)


def _answer(table: pa.Table) -> pa.Table:
    """Totals of a bucket, given back to each chunk for its keys: over all training documents (total)
    and without the held-out part (kept)."""
    keys = [_unpack(k.as_py()) for k in table["keys"]]
    counts = [_spread(c.as_py()).astype(np.float64) for c in table["counts"]]
    deleted = table["deleted"].to_pylist()
    distinct, place = np.unique(np.concatenate(keys), return_inverse=True)
    every = np.concatenate(counts)
    total = np.bincount(place, every, len(distinct)).astype(np.int64)
    own = np.concatenate([c * (not d) for c, d in zip(counts, deleted)])
    kept = np.bincount(place, own, len(distinct)).astype(np.int64)
    edge = np.cumsum([0, *map(len, keys)])
    n, k = len(keys), len(table)
    sizes = [np.zeros(k, np.int64) for _ in range(3)]
    for array, value in zip(sizes, (total.sum(), (total > 0).sum(), kept.sum())):
        array[0] = value
    return pa.Table.from_arrays(
        [table["chunk"].combine_chunks(), table["deleted"].combine_chunks(), table["turn"].combine_chunks(),
         table["bucket"].combine_chunks(),
         pa.array([_squeeze(total[place[a:b]]) for a, b in zip(edge[:n], edge[1:])], pa.binary()),
         pa.array([_squeeze(kept[place[a:b]]) if d else None for a, b, d in zip(edge[:n], edge[1:], deleted)], pa.binary()),
         *map(pa.array, sizes)], schema=_ANSWER_KIND)


class Counts:
    """Counts of a chunk's tokens from the answers: of the word, the bigram, and the context."""

    def __init__(self, t: Tokens, answers: pa.Table, column: str):
        self.word, found_words, word_counts = self._look(t.word, answers, 1, column)
        self.pair, _, _ = self._look(t.pair, answers, 2, column)
        self.context = self._contexts(t.context, found_words, word_counts)

    @staticmethod
    def _look(keys: np.ndarray, answers: pa.Table, order: int, column: str):
        rows = sorted((b, raw) for o, b, raw in zip(answers["turn"].to_pylist(), answers["bucket"].to_pylist(),
                                                    answers[column].to_pylist()) if o == order)
        distinct, place = np.unique(keys, return_inverse=True)
        counts = np.concatenate([_unsqueeze(raw) for _, raw in rows]) if rows else np.zeros(0, np.int64)
        if len(counts) != len(distinct):
            raise ValueError("answers do not belong to this chunk")
        return counts[place], distinct, counts

    def _contexts(self, context: np.ndarray, distinct: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """A word's count as context is its own count; the begin of a text has that of the end mark."""
        key = np.where(context == np.uint64(_BEGIN), np.uint64(_END), context)
        return counts[np.searchsorted(distinct, key)] if len(key) else np.zeros(0, np.int64)


def context_bucket(count: np.ndarray) -> np.ndarray:
    """Bucket of a context frequency."""
    found = np.zeros(len(count), np.int64)
    seen = count > 0
    found[seen] = np.minimum(np.floor(np.log2(count[seen])).astype(np.int64) + 1, CONTEXTS - 1)
    return found


def mixture(weights: np.ndarray, counts: Counts, tokens_: int, types: int) -> np.ndarray:
    """Probability of every token."""
    own = weights[context_bucket(counts.context)]
    pair = np.divide(counts.pair, counts.context, out=np.zeros(len(counts.pair)), where=counts.context > 0)
    return own[:, 0] * pair + own[:, 1] * (counts.word / max(tokens_, 1)) + own[:, 2] / (types + 1)


def _level(p: np.ndarray) -> np.ndarray:
    """Histogram cell of a probability; 0 for none."""
    out = np.zeros(len(p), np.int64)
    some = p > 0
    out[some] = 1 + np.floor(-np.log2(p[some]) * _STEPS).astype(np.int64)
    return out


def learn_weights(cells: pd.DataFrame, uniform: float, rounds: int) -> np.ndarray:
    """Weights (bigram, word, uniform) of every context bucket by expectation-maximisation.

    cells: bucket, n, p2, p1 (means of the cell). Every component starts alike and keeps a pseudo count
    of one, so each word keeps a positive probability. An unseen context has no bigram share.
    """
    weights = np.full((CONTEXTS, 3), 1 / 3)
    bucket = cells["bucket"].to_numpy(np.int64)
    n = cells["n"].to_numpy(float)
    p = np.column_stack([cells["p2"], cells["p1"], np.full(len(cells), uniform)]).astype(float)
    for _ in range(rounds):
        share = weights[bucket] * p
        share *= (n / share.sum(axis=1))[:, None]
        total = np.ones((CONTEXTS, 3))
        np.add.at(total, bucket, share)
        weights = total / total.sum(axis=1, keepdims=True)
    weights[0] = [0, *(weights[0, 1:] / weights[0, 1:].sum())]
    return weights


@dataclass
class Model:
    """What scoring needs besides the counts: numbers of training tokens and types, and the weights."""

    tokens: int
    types: int
    weights: np.ndarray


def unseen(id_col: str, folds: int = 7, fold: int = 2) -> Column:
    """Documents that are never learned from; so is one without id."""
    return F.coalesce(F.pmod(F.crc32(F.col(id_col).cast("string")), F.lit(folds)) == fold, F.lit(True))


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", held_out: Column | None = None,
          settings: Settings = Settings()) -> DataFrame:
    """One row per input row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Learns from the rows that are not held out. base_score is the add-one unigram log10 probability,
    score the model's. A null text counts as empty: it has the end mark only. Repeated rows count as
    often as they stand there; other columns are not read. Without training rows every word is unseen.
    """
    held = unseen(id_col) if held_out is None else held_out
    source = docs.select(F.col(id_col).cast("long").alias("doc_id"), held.alias("held_out"),
                         F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    size = source.agg(F.sum(F.octet_length("text") + 8)).first()[0] or 0
    chunks = max(1, math.ceil(size / settings.chunk_bytes))
    mark = F.xxhash64(F.lit(settings.seed), "doc_id", "text")
    dealt = source.withColumn("trained", ~F.col("held_out")) \
        .withColumn("deleted", F.col("trained") & (F.pmod(mark, F.lit(settings.deleted)) == 0))
    # A tenth of the documents goes to a tenth of the numbers, so held-out chunks are as large as others.
    number = F.pmod(F.shiftright(mark, 8), F.lit(chunks))
    dealt = dealt.withColumn(
        "chunk", F.when(F.col("deleted"), F.floor(number / settings.deleted)).otherwise(number))
    key = ["deleted", "chunk"]
    sent = dealt.select("chunk", "deleted", "trained", "text").groupBy(*key).applyInArrow(_send(chunks), _MESSAGE)
    answers = session.materialize(sent.groupBy("turn", "bucket").applyInArrow(_answer, _ANSWER), "answers")
    sums = answers.where("turn = 1").agg(F.sum("tokens"), F.sum("types"), F.sum("kept_tokens")).first()
    total, types, kept = (v or 0 for v in sums)

    def cells(left: pa.Table, right: pa.Table) -> pa.Table:
        kind = pa.schema([("bucket", pa.int64()), ("a", pa.int64()), ("b", pa.int64()), ("n", pa.int64()),
                          ("p2", pa.float64()), ("p1", pa.float64())])
        if not len(left):
            return kind.empty_table()
        c = Counts(chunk_tokens(left["text"]), right, "kept")
        p2 = np.divide(c.pair, c.context, out=np.zeros(len(c.pair)), where=c.context > 0)
        p1 = c.word / max(kept, 1)
        made = pd.DataFrame({"bucket": context_bucket(c.context), "a": _level(p2), "b": _level(p1), "p2": p2, "p1": p1}) \
            .groupby(["bucket", "a", "b"]).agg(n=("p2", "size"), p2=("p2", "sum"), p1=("p1", "sum")).reset_index()
        return pa.Table.from_pandas(made, schema=kind, preserve_index=False)

    part = dealt.where("deleted").select("chunk", "text").groupBy("chunk").cogroup(
        answers.where("deleted").select("chunk", "turn", "bucket", "kept").groupBy("chunk"))
    histogram = part.applyInArrow(cells, "bucket long, a long, b long, n long, p2 double, p1 double") \
        .groupBy("bucket", "a", "b").agg(F.sum("n").alias("n"), F.sum("p2").alias("p2"), F.sum("p1").alias("p1")) \
        .orderBy("bucket", "a", "b").toPandas()
    histogram["p2"] /= histogram["n"]
    histogram["p1"] /= histogram["n"]
    model = Model(total, types, learn_weights(histogram, 1 / (types + 1), settings.rounds))
    return _score(dealt, answers, model)


def _score(dealt: DataFrame, answers: DataFrame, model: Model) -> DataFrame:
    kind = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("n_tokens", pa.int64()),
                      ("n_known", pa.int64()), ("train_tokens", pa.int64()), ("base_score", pa.float64()),
                      ("score", pa.float64())])

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        if not len(left):
            return kind.empty_table()
        t = chunk_tokens(left["text"])
        c = Counts(t, right, "total")
        n = len(left)
        base = np.log10((c.word + 1) / (model.tokens + model.types + 1))
        full = np.log10(mixture(model.weights, c, model.tokens, model.types))
        return pa.Table.from_arrays(
            [left["doc_id"].combine_chunks(), left["held_out"].combine_chunks(),
             pa.array(np.bincount(t.doc, minlength=n)), pa.array(np.bincount(t.doc[c.word > 0], minlength=n)),
             pa.array(np.full(n, model.tokens, np.int64)), pa.array(np.bincount(t.doc, base, n)),
             pa.array(np.bincount(t.doc, full, n))], schema=kind)

    key = ["deleted", "chunk"]
    return dealt.select(*key, "doc_id", "held_out", "text").groupBy(*key).cogroup(
        answers.select(*key, "turn", "bucket", "total").groupBy(*key)).applyInArrow(
        run, "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, "
             "score double")
