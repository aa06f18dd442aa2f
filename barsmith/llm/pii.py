"""Personal data: fixed patterns, and a skip-chain conditional random field that adds mentions.

The patterns find e-mail addresses, IP addresses, card and phone numbers. The field runs over the
tokens of a document that hold a digit or an @ (all others are outside). Its labels are `outside`
and the four kinds. A token has weights for its shape, neighbouring tokens share a transition
potential, and distant tokens that repeat, or whose digits or local part repeat, share a potential
that favours equal labels. Loopy sum-product message passing then makes labels agree within a
document; tokens inside a pattern's match are fixed, so a match speaks for its other mentions.

The weights come from pseudo-likelihood on a bounded sample of documents, whose labels are the
pattern matches. Repeated tokens are linked in a chain of occurrences, so links grow linearly.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barsmith.llm import words

KINDS = ("email", "ip", "card", "phone")
LABELS = ("outside", *KINDS)
Span = tuple[int, int, int]  # kind number, start, end

_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
_IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_SIGNAL = re.compile(r"[0-9@]")
_TRIM = ".,;:!?()[]{}<>|\"'*#$%&"


def luhn(digits: str) -> bool:
    """The check digit of card numbers."""
    total = 0
    for i, d in enumerate(reversed(digits)):
        v = int(d) * (1 + i % 2)
        total += v - 9 * (v > 9)
    return total % 10 == 0


def _only_digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def base_spans(text: str) -> list[Span]:
    """Matches of the fixed patterns, by start, then kind. Each kind is leftmost and free of overlaps
    with itself; a match that fails its check is dropped and not tried again."""
    out: list[Span] = []
    end, at = 0, text.find("@")
    while at >= 0:
        low = at
        while low > end and text[low - 1] in _LOCAL:
            low -= 1
        found = _DOMAIN.match(text, at + 1) if low < at else None
        if found:
            end = found.end()
            out.append((0, low, end))
        at = text.find("@", max(at + 1, end))
    if _SIGNAL.search(text):
        for m in _IP.finditer(text):
            parts = [p.lstrip("0") for p in m.group().split(".")]
            if all(len(p) <= 3 and int(p or 0) <= 255 for p in parts):
                out.append((1, m.start(), m.end()))
        for m in _CARD.finditer(text):
            if 14 <= m.end() - m.start() <= 37:
                digits = _only_digits(m.group())
                if 14 <= len(digits) <= 19 and luhn(digits):
                    out.append((2, m.start(), m.end()))
        if "+" in text:
            for m in _PHONE.finditer(text):
                if 10 <= len(_only_digits(m.group())) <= 15:
                    out.append((3, m.start(), m.end()))
    return sorted(out, key=lambda s: (s[1], s[0]))


def tokens(text: str) -> list[tuple[int, int]]:
    """Ranges of the blank-separated tokens that hold a digit or an @, without outer punctuation."""
    out, end = [], 0
    for m in _SIGNAL.finditer(text):
        if m.start() < end:
            continue
        low, end = m.start(), m.end()
        while low and not text[low - 1].isspace():
            low -= 1
        while end < len(text) and not text[end].isspace():
            end += 1
        a, b = low, end
        while a < b and text[a] in _TRIM:
            a += 1
        while b > a and text[b - 1] in _TRIM:
            b -= 1
        if a < b:
            out.append((a, b))
    return out


def shape(token: str) -> np.ndarray:
    """Features of a token."""
    digits = _only_digits(token)
    n, letters = len(digits), sum(c.isalpha() for c in token)
    only = n == len(token)
    numeric = n + sum(token.count(c) for c in ".-()+") == len(token)
    parts = token.split(".")
    dotted = len(parts) == 4 and all(p.isascii() and p.isdigit() and len(p) <= 3 for p in parts)
    dotted = dotted and all(int(p) <= 255 for p in parts)
    return np.array([
        1, "@" in token, "@" in token and "." in token.rpartition("@")[2], letters > 0, letters > n, only, numeric, dotted,
        token.startswith("+"), n <= 2, 3 <= n <= 4, 5 <= n <= 9, 10 <= n <= 13, 14 <= n <= 19, n > 19,
        14 <= n <= 19 and numeric and luhn(digits), "-" in token, numeric and "-" in token and 7 <= n <= 13,
    ], float)


def skip_keys(token: str) -> list[tuple[str, str]]:
    """What distant mentions share: the token itself, its last seven digits, or its local part."""
    digits, low = _only_digits(token), token.lower()
    out = [("token", low)]
    if len(digits) >= 7:
        out.append(("digits", digits[-7:]))
    if "@" in low:
        out.append(("local", low.split("@")[0]))
    return out


@dataclass
class Graph:
    """Tokens of a document with features, fixed labels (-1: open), and links of three types."""

    spans: list[tuple[int, int]]
    features: np.ndarray
    fixed: np.ndarray
    links: np.ndarray  # rows (token, token, type): 0 neighbours, 1 repeated, 2 similar

    @classmethod
    def of(cls, text: str, base: list[Span]) -> "Graph":
        spans = tokens(text)
        fixed = np.full(len(spans), -1)
        for kind in range(len(KINDS)):  # spans of a kind do not overlap, so they stand in order of start and end
            own, at = [(s, e) for k, s, e in sorted(base, key=lambda s: s[1]) if k == kind], 0
            for i, (a, b) in enumerate(spans):
                while at < len(own) and own[at][1] <= a:
                    at += 1
                if at < len(own) and own[at][0] < b and fixed[i] < 0:
                    fixed[i] = 1 + kind
        links: dict[tuple[int, int], int] = {}
        last: dict[tuple[str, str], int] = {}
        for i, (a, b) in enumerate(spans):
            if i and a - spans[i - 1][1] <= 2:
                links[i - 1, i] = 0
            for key in skip_keys(text[a:b]):
                if key in last:
                    links.setdefault((last[key], i), 1 if key[0] == "token" else 2)
                last[key] = i
        rows = [(i, j, t) for (i, j), t in links.items()]
        return cls(spans, np.array([shape(text[a:b]) for a, b in spans]).reshape(len(spans), -1), fixed,
                   np.array(rows, int).reshape(-1, 3))


@dataclass(frozen=True)
class Settings:
    sample_documents: int = 2000  # documents with tokens to learn from, in expectation
    steps: int = 300
    penalty: float = 1e-3
    passes: int = 15
    threshold: float = 0.5


@dataclass
class Field:
    """Weights by label of token features, transitions between neighbours, gain of equal labels."""

    shape: np.ndarray
    step: np.ndarray
    same: np.ndarray

    def beliefs(self, graph: Graph, passes: int) -> np.ndarray:
        """Marginals of all tokens by damped loopy sum-product passing."""
        unary = graph.features @ self.shape
        known = graph.fixed >= 0
        unary[known] = -30.0
        unary[known, graph.fixed[known]] = 0.0
        unary -= unary.max(axis=1, keepdims=True)
        if len(graph.links):
            i, j, kind = graph.links.T
            table = np.stack([self.step, *(np.eye(len(LABELS)) * g for g in self.same)])
            source, target = np.concatenate([i, j]), np.concatenate([j, i])
            weight = np.concatenate([table[kind], table[kind].transpose(0, 2, 1)])
            back = np.concatenate([np.arange(len(i)) + len(i), np.arange(len(i))])
            message = np.zeros((len(source), len(LABELS)))
            for _ in range(passes):
                total = unary.copy()
                np.add.at(total, target, message)
                push = (total[source] - message[back])[:, :, None] + weight
                top = push.max(axis=1)
                new = top + np.log(np.exp(push - top[:, None]).sum(axis=1))
                new -= new.max(axis=1, keepdims=True)
                message = 0.5 * message + 0.5 * new
            unary = unary.copy()
            np.add.at(unary, target, message)
        p = np.exp(unary - unary.max(axis=1, keepdims=True))
        return p / p.sum(axis=1, keepdims=True)


def _pseudo_rows(graph: Graph) -> list[tuple]:
    """Per token: features, label, labels of the left and right neighbour, labels over skip links."""
    label = np.maximum(graph.fixed, 0)
    n, m = len(label), len(LABELS)
    side, skip = np.zeros((2, n, m)), np.zeros((2, n, m))
    for i, j, kind in graph.links:
        if kind == 0:
            side[0, j, label[i]] += 1
            side[1, i, label[j]] += 1
        else:
            skip[kind - 1, i, label[j]] += 1
            skip[kind - 1, j, label[i]] += 1
    return list(zip(graph.features, label, side[0], side[1], skip[0], skip[1]))


def fit_field(rows: list[tuple], settings: Settings, copies: list[int] | None = None) -> Field:
    """Weights of greatest penalised pseudo-likelihood, by momentum steps from zero.

    With ``copies`` a row counts as often as it says.
    """
    m, width = len(LABELS), len(shape("0"))
    w, step, same = np.zeros((width, m)), np.zeros((m, m)), np.array([1.0, 1.0])
    if not rows:
        return Field(w, step, same)
    x, y, left, right, one, two = (np.array(c) for c in zip(*rows))
    target = np.eye(m)[y.astype(int)]
    part = np.ones(len(x)) if copies is None else np.array(copies, float)
    part = (part / part.sum())[:, None]
    speed = [np.zeros_like(w), np.zeros_like(step), np.zeros_like(same)]
    for _ in range(settings.steps):
        score = x @ w + left @ step + right @ step.T + same[0] * one + same[1] * two
        p = np.exp(score - score.max(axis=1, keepdims=True))
        error = (target - p / p.sum(axis=1, keepdims=True)) * part
        gradient = [x.T @ error - settings.penalty * w,
                    left.T @ error + error.T @ right - settings.penalty * step,
                    np.array([(one * error).sum(), (two * error).sum()]) - settings.penalty * same]
        for value, v, g in zip((w, step, same), speed, gradient):
            v *= 0.9
            v += g
            value += v
    return Field(w, step, np.maximum(same, 0.0))


def fit(docs: DataFrame, text_col: str = "text", settings: Settings = Settings()) -> Field:
    """Learn from the pattern matches of a bounded sample of documents with digits or @."""
    usable = docs.select(F.col(text_col).cast("string").alias("text")).where(F.col("text").rlike("[0-9@]"))
    n = usable.count()
    if not n:
        return fit_field([], settings)
    share = settings.sample_documents / n
    chosen = usable.where(F.pmod(F.xxhash64("text"), F.lit(1_000_003)) / 1_000_003 < share)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in words.slices(batches):
            rows = []
            for text in batch.column(0).to_pylist():
                for row in _pseudo_rows(Graph.of(text, base_spans(text))):
                    rows.append(np.concatenate([row[0], [row[1]], *row[2:]]).tolist())
            yield pa.RecordBatch.from_arrays([pa.array(rows, pa.list_(pa.float64()))], names=["row"])

    # Equal rows say the same: only the distinct ones are collected, with the number of their copies.
    found = sorted((list(r["row"]), r["copies"]) for r in chosen.mapInArrow(run, "row array<double>")
                   .groupBy("row").agg(F.count("*").alias("copies")).collect())
    width, m = len(shape("0")), len(LABELS)
    cut = np.cumsum([width, 1, m, m, m, m])
    rows = []
    for row, _ in found:
        v = np.array(row)
        a, b, c, d, e, f = np.split(v, cut[:-1])
        rows.append((a, b[0], c, d, e, f))
    return fit_field(rows, settings, [n for _, n in found])


#: Digits that one mention can have; mentions do not join beyond it.
_MOST_DIGITS = (0, 0, 19, 15)
_GAP = re.compile(r"[\x20().-]{1,2}")


def added_spans(text: str, base: list[Span], model: Field, settings: Settings = Settings()) -> list[Span]:
    """Mentions that the field labels as personal data; neighbouring number groups of one label are one."""
    graph = Graph.of(text, base)
    if not len(graph.spans) or (graph.fixed >= 0).all():
        return []
    belief = model.beliefs(graph, settings.passes)
    label = belief.argmax(axis=1)
    out: list[Span] = []
    before = -1
    for i, (a, b) in enumerate(graph.spans):
        if graph.fixed[i] >= 0 or not label[i] or belief[i, label[i]] <= settings.threshold:
            continue
        kind = int(label[i]) - 1
        joins = before == i - 1 and out and out[-1][0] == kind and _GAP.fullmatch(text, out[-1][2], a)
        if joins and len(_only_digits(text[out[-1][1] : b])) <= _MOST_DIGITS[kind]:
            out[-1] = (kind, out[-1][1], b)
        else:
            out.append((kind, a, b))
        before = i
    return out


def spans_of(text: str, model: Field, settings: Settings = Settings()) -> tuple[list[Span], list[Span]]:
    """The base spans and all spans of a text, by start, then kind."""
    if not _SIGNAL.search(text):
        return [], []
    base = base_spans(text)
    return base, sorted(base + added_spans(text, base, model, settings), key=lambda s: (s[1], s[0]))


def _joined(spans: list[Span]) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for k, a, b in spans)


def redact(text: str, spans: list[Span]) -> str:
    """The text with every span replaced by its kind in brackets; overlapping spans count as the first."""
    out, end = [], 0
    for k, a, b in spans:
        if a >= end:
            out += [text[end:a], f"[{KINDS[k].upper()}]"]
        end = max(end, b)
    return "".join([*out, text[end:]])


def redact_rows(docs: DataFrame, model: Field, text_col: str = "text", settings: Settings = Settings()) -> DataFrame:
    """The rows with every span of their texts replaced; null texts stay null."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    place = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in words.slices(batches):
            texts = [t if t is None else redact(t, spans_of(t, shared.value, settings)[1])
                     for t in batch.column(place).to_pylist()]
            yield batch.set_column(place, batch.schema.names[place], pa.array(texts, pa.string()))

    return docs.mapInArrow(run, docs.schema)


def find(docs: DataFrame, model: Field, id_col: str = "doc_id", text_col: str = "text",
         settings: Settings = Settings()) -> DataFrame:
    """One row per input row: doc_id, n_email, n_ip, n_card, n_phone (base), base_sha256, spans.

    Whole texts are read; a null text counts as empty: it has no spans.
    Rows are treated one by one, other columns are not read.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kinds = [("doc_id", pa.int64()), *((f"n_{k}", pa.int64()) for k in KINDS), ("base_sha256", pa.string()),
             ("spans", pa.string())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in words.slices(batches):
            rows = []
            for text in batch.column(1).to_pylist():
                base, spans = spans_of(text or "", shared.value, settings)
                counts = [sum(s[0] == k for s in base) for k in range(len(KINDS))]
                rows.append((*counts, hashlib.sha256(_joined(base).encode()).hexdigest(), _joined(spans)))
            columns = [list(c) for c in zip(*rows)] or [[] for _ in kinds[1:]]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(c, k) for c, (_, k) in zip(columns, kinds[1:]))], schema=pa.schema(kinds))

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")) \
        .mapInArrow(run, "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, "
                         "spans string")
