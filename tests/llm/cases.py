"""Documents with every awkward case, and brute-force versions of the operators."""

from __future__ import annotations

import hashlib
import math
import re
import zlib
from collections import Counter

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LICENSE_WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

LONG = " ".join(f"w{i % 977} the" for i in range(30_000))
BASE = " ".join(f"word{i}" for i in range(60))
TEXTS = [
    None, "", " \t\n ", "one", "a b c d", "A B C D", BASE, BASE.upper(), BASE.replace("word30", "other"),
    BASE + " tail", LONG, LONG + " end", "x" * 50_000, "é中文 😀 ñandú " * 20, "\x00\x01 \x7f", "%%% *** 123",
    "mail a.b@c.example.org or x@y.z@w.q and +1 (377) 555-0271 then 377-555-0271, ip 10.0.0.255 10.0.0.256",
    "card 4539 1488 0343 6467 and 4539148803436467 and 4539148803436468", "1.2.3.4.5.6.7.8 00000001.2.3.4",
    "This is under the GNU General Public License, and the MIT License. Apache License CC-BY",
    "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
    "associated documentation files", "same", "same", "same",
]

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, component_id string, spans long, shard int"


def rows() -> list[tuple]:
    """Ids with gaps, one id twice with equal and one with different texts, one row without id."""
    out = [(3 * i, t, "en" if i % 2 else None, f"s{i % 3}", None if t is None else len(t), "x", 1, 9)
           for i, t in enumerate(TEXTS)]
    out.append(out[6])
    out.append((3, "another text for this id", "de", None, 24, None, None, None))
    out.append((None, BASE, None, None, None, None, None, None))
    return out


def lower(text: str | None) -> str:
    return re.sub("[A-Z]", lambda m: m.group().lower(), text or "")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def shingle_set(text: str | None) -> frozenset:
    w = WORD.findall(lower(text))
    return frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()


def components(pairs: list[tuple[int, str | None]]) -> dict[int, int]:
    """Smallest linked id of every id, from all pairs."""
    parent = {i: i for i, _ in pairs}

    def find(x: int) -> int:
        while parent[x] != x:
            x = parent[x]
        return x

    sets = [(i, shingle_set(t)) for i, t in pairs]
    by_set: dict[frozenset, int] = {}
    for i, s in sets:
        if s:
            a, b = sorted((find(by_set.setdefault(s, i)), find(i)))
            parent[b] = a
    unique = list(by_set.items())
    for x, (s, i) in enumerate(unique):
        for t, j in unique[:x]:
            both = len(s & t)
            if both and 100 * both >= 85 * (len(s) + len(t) - both):
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    return {i: find(i) for i in parent}


BASE_PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """The fixed patterns as they are written down."""
    out = []
    for k, (kind, pattern) in enumerate(BASE_PATTERNS.items()):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m.group())
            if kind == "ip" and any(int(p) > 255 for p in m.group().split(".")):
                continue
            if kind == "phone" and not 10 <= len(digits) <= 15:
                continue
            if kind == "card":
                doubled = [int(d) * (1 + i % 2) for i, d in enumerate(reversed(digits))]
                if not 14 <= len(digits) <= 19 or sum(v - 9 * (v > 9) for v in doubled) % 10:
                    continue
            out.append((k, m.start(), m.end()))
    return sorted(out, key=lambda s: (s[1], s[0]))


def crc(value: object) -> int:
    return zlib.crc32(str(value).encode())


def unigram(docs: list[tuple[int, str | None]]) -> dict[int, tuple[int, int, int, float]]:
    """n_tokens, n_known, train_tokens, base_score of every document."""
    tokens = {i: [*WORD.findall(lower(t)), None] for i, t in docs}
    counts = Counter(w for i, ws in tokens.items() if crc(i) % 7 != 2 for w in ws)
    n, v = sum(counts.values()), len(counts)
    return {i: (len(ws), sum(counts[w] > 0 for w in ws), n, sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in ws))
            for i, ws in tokens.items()}


PHRASES = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}


def license_base(text: str | None) -> tuple[int, int, int | None, int | None, str]:
    """n_words, n_base, first and last start, base labels."""
    words = LICENSE_WORD.findall(lower(text))
    places = [(i, label) for phrase, label in PHRASES.items() for i in range(len(words))
              if words[i : i + len(phrase.split())] == phrase.split()]
    starts = [p[0] for p in places]
    return len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({p[1] for p in places}))
