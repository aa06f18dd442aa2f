"""SentencePiece encoding and decoding for merge-type (BPE) models.

Merging by score is replaced by a search that reaches the same ids: take the longest piece that
starts here (Aho-Corasick over reversed pieces finds it for every position in one pass), accept it
if it is compatible with the piece before, else try its next shorter prefix, else mark the position
in a bitfield of failed positions and go back. Two adjacent pieces are compatible if merging their
joined text by score gives just these two. A sequence whose neighbours are all compatible is the
one that merging produces: the first merge that crosses a border would also happen in the pair.

Merges never cross a point where no piece continues, so texts are cut there (after a word, around
characters such as line ends) and the ids of a word are remembered per worker.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterable, Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barsmith.llm import words

SPACE = "▁"
#: Words and pairs in a worker's store, which is kept twice (new and old), and the longest word.
WORDS_KEPT = 250_000
PAIRS_KEPT = 300_000
LONGEST_KEPT = 48
NORMAL, UNKNOWN, CONTROL, BYTE = 1, 2, 3, 6


class Codec:
    """Encoder and decoder of one model file; every worker builds its own from the path."""

    def __init__(self, path: str):
        from sentencepiece import sentencepiece_model_pb2

        model = sentencepiece_model_pb2.ModelProto()
        with open(path, "rb") as file:
            model.ParseFromString(file.read())
        trained, rules = model.trainer_spec, model.normalizer_spec
        kinds = {p.type for p in model.pieces}
        if trained.model_type != 2 or not trained.byte_fallback or kinds - {NORMAL, UNKNOWN, CONTROL, BYTE}:
            raise ValueError("a merge-type model with byte fallback and without extra symbols is needed")
        if rules.name != "identity" or rules.remove_extra_whitespaces or trained.treat_whitespace_as_suffix:
            raise ValueError("a model with the identity normaliser that keeps blanks is needed")
        self.prefix = SPACE if rules.add_dummy_prefix else ""
        self.pieces = [p.piece for p in model.pieces]
        self.kinds = [p.type for p in model.pieces]
        self.ids = {p.piece: i for i, p in enumerate(model.pieces) if p.type == NORMAL}
        self.scores = {p.piece: p.score for p in model.pieces if p.type == NORMAL}
        self.bytes = {int(p.piece[3:5], 16): i for i, p in enumerate(model.pieces) if p.type == BYTE}
        self.end = trained.eos_id
        self.pairs: dict[tuple[str, str], bool] = {}
        self.own = {p: p for p in self.pieces}  # one string per piece in the store of pairs
        self.known = Memo(lambda word: " ".join(map(str, self.word_ids(word))))
        self.surfaces = {str(i): self._surface(i) for i in range(len(self.pieces))}
        # Only pieces that merging their own text produces can occur.
        live = [p for p in self.ids if len(p) > 1 and self.merge(p) == [p]]
        self.live = set(live)
        self.shorter = {p: next((p[:n] for n in range(len(p) - 1, 1, -1) if p[:n] in self.live), p[0]) for p in live}
        self.matcher = ahocorasick.Automaton(ahocorasick.STORE_LENGTH)
        for p in live:
            self.matcher.add_word(p[::-1])
        self.matcher.make_automaton()
        self.cut = self._cutter(live)

    def _cutter(self, live: list[str]) -> re.Pattern:
        """Cuts where no piece continues: before a space mark after other text, around line ends and tabs."""
        inner = SPACE in "".join(p.lstrip(SPACE) for p in live)
        alone = "".join(c for c in "\n\t" if not any(c in p for p in live))
        self.plain = not inner and "\n" in alone and bool(self.prefix)
        if inner:
            return re.compile(f"[{alone}]|[^{alone}]+" if alone else r"(?s).+")
        rest = f"[^{SPACE}{alone}]"
        return re.compile((f"[{alone}]|" if alone else "") + f"{SPACE}*{rest}+|{SPACE}+")

    def _surface(self, i: int) -> str:
        kind, piece = self.kinds[i], self.pieces[i]
        if kind == BYTE:
            value = int(piece[3:5], 16)
            return chr(value if value < 128 else 0xDC00 + value)
        return {NORMAL: piece.replace(SPACE, " "), UNKNOWN: " ⁇ "}.get(kind, "")

    def merge(self, text: str) -> list[str]:
        """Pieces by repeated merging of the best-scored adjacent pair, the first of equals."""
        parts, score, none = list(text), self.scores.get, float("-inf")
        gains = [score(a + b, none) for a, b in zip(parts, parts[1:])]
        while gains and (best := max(gains)) != none:
            i = gains.index(best)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del gains[i]
            if i < len(gains):
                gains[i] = score(parts[i] + parts[i + 1], none)
            if i:
                gains[i - 1] = score(parts[i - 1] + parts[i], none)
        return parts

    def compatible(self, left: str, right: str) -> bool:
        """Whether merging the joined text gives these two pieces again."""
        known = self.pairs.get((left, right))
        if known is None:
            if len(self.pairs) >= PAIRS_KEPT:
                self.pairs.clear()
            known = self.merge(left + right) == [left, right]
            self.pairs[self.own.get(left, left), self.own.get(right, right)] = known
        return known

    def split(self, text: str) -> list[str]:
        """Pieces of a stretch of text by backtracking; pieces unknown to the model are characters."""
        n = len(text)
        if n < 2:
            return [text] if text else []
        longest = [1] * n
        for end, length in self.matcher.iter(text[::-1]):
            if length > longest[n - 1 - end]:
                longest[n - 1 - end] = length
        failed = bytearray(n // 8 + 1)  # bit i: no division of text[i:] fits what comes before
        known, shorter = self.pairs.get, self.shorter
        out: list[str] = []
        last, at, piece = "", 0, text[: longest[0]]
        while at < n:
            end = at + len(piece)
            fits = not failed[end >> 3] >> (end & 7) & 1
            if fits and out:
                fits = known((last, piece))
                if fits is None:
                    fits = self.compatible(last, piece)
            if fits:
                out.append(piece)
                last, at = piece, end
                if at < n:
                    piece = text[at : at + longest[at]]
                continue
            while len(piece) == 1:
                failed[at >> 3] |= 1 << (at & 7)
                piece = out.pop()
                at -= len(piece)
            piece = shorter[piece]
            last = out[-1] if out else ""
        return out

    def word_ids(self, word: str) -> list[int]:
        """Ids of a stretch; a character without a piece becomes its UTF-8 bytes."""
        get, out = self.ids.get, []
        for piece in self.split(word):
            found = get(piece)
            if found is None:
                out += [self.bytes[b] for b in piece.encode()]
            else:
                out.append(found)
        return out

    def stretches(self, text: str) -> list[str]:
        """The text cut where no piece continues; joined they are the prefixed text."""
        if not text:
            return []
        if self.plain and text[0] != " " and "  " not in text and SPACE not in text:
            # Single blanks and line ends only: one split instead of a match per word.
            spaced = self.prefix + text.replace(" ", " " + SPACE).replace("\n", " \n ")
            if "  " not in spaced and spaced[-1] != " ":
                return spaced.split(" ")
        return self.cut.findall(self.prefix + text.replace(" ", SPACE))

    def encode(self, text: str) -> list[int]:
        """Ids of a whole text, then the end id."""
        return [i for w in self.stretches(text) for i in self.word_ids(w)] + [self.end]

    def decode(self, ids: Iterable[int]) -> str:
        """The text of ids: control pieces are silent, byte pieces join to UTF-8 (bytes that are none
        become U+FFFD), the blank of the added prefix goes."""
        return self.decode_decimals(list(map(str, ids))).decode()

    def decode_decimals(self, ids: list[str]) -> bytes:
        """UTF-8 of the text of decimal ids."""
        text = "".join(map(self.surfaces.__getitem__, ids))
        if self.prefix and text.startswith(" "):
            first = next(i for i in map(int, ids) if self.kinds[i] != CONTROL)
            text = text[self.kinds[first] == NORMAL :]
        try:
            return text.encode()
        except UnicodeEncodeError:  # byte pieces beyond ASCII stand as lone surrogates
            return _repair(text.encode("utf-8", "surrogateescape")).encode()

    def encode_decode(self, text: str) -> tuple[str, int, bytes]:
        """Decimal ids joined by blanks, with the end id, their number, and the UTF-8 they decode to."""
        ids = " ".join([*map(self.known.__getitem__, self.stretches(text)), str(self.end)])
        each = ids.split(" ")
        return ids, len(each), self.decode_decimals(each)


def _repair(raw: bytes) -> str:
    """Text of bytes, with U+FFFD for every byte that begins no valid character."""
    out = []
    while raw:
        try:
            out.append(raw.decode())
            break
        except UnicodeDecodeError as error:
            out.append(raw[: error.start].decode() + "\ufffd")
            raw = raw[error.start + 1 :]
    return "".join(out)


class Memo(dict):
    """What a function gave for short words. A full store becomes the old one, from which words that
    are still in use come back; the old store before it is dropped."""

    def __init__(self, make: Callable[[str], str]):
        super().__init__()
        self.make = make
        self.old: dict[str, str] = {}

    def __missing__(self, word: str) -> str:
        made = self.old.get(word)
        if made is None:
            made = self.make(word)
        if len(word) <= LONGEST_KEPT:
            if len(self) >= WORDS_KEPT:
                self.old = dict(self)
                self.clear()
            self[word] = made
        return made


_codecs: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    """The worker's codec for a model file."""
    if path not in _codecs:
        _codecs[path] = Codec(path)
    return _codecs[path]


def tokens(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text",
           keep_ids: bool = True) -> DataFrame:
    """One row per input row: doc_id, n_tokens, ids (array, if keep_ids), ids_sha256, decoded_sha256.

    Whole texts are encoded with the end id only. A null text counts as empty: it is the end id
    alone. Rows are treated one by one, so repeated rows repeat; other columns are not read.
    """
    fields = [("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()),
              ("decoded_sha256", pa.string())] + [("ids", pa.list_(pa.int32()))] * keep_ids
    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * keep_ids

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(model)
        for batch in words.slices(batches):
            counts, marks, back, ids_of = [], [], [], []
            for text in batch.column(1):
                ids, count, decoded = own.encode_decode(text.as_py() or "")
                counts.append(count)
                marks.append(hashlib.sha256(ids.encode()).hexdigest())
                back.append(hashlib.sha256(decoded).hexdigest())
                if keep_ids:
                    ids_of.append(np.array(ids.split(" "), np.int32))
            columns = [batch.column(0), pa.array(counts, pa.int64()), pa.array(marks), pa.array(back)]
            if keep_ids:
                edge = pa.array(np.cumsum([0, *counts]), pa.int32())
                columns.append(pa.ListArray.from_arrays(edge, pa.array(np.concatenate(ids_of))))
            yield pa.RecordBatch.from_arrays(columns, names=[f for f, _ in fields])

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")) \
        .mapInArrow(run, schema)
