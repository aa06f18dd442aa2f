import random

import pytest
import sentencepiece
from cases import TEXTS, rows, sha

from barsmith.llm import queries, sentencepiece_codec


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=queries.piece_model())


@pytest.fixture(scope="module")
def codec():
    return sentencepiece_codec.codec(queries.piece_model())


def test_ids_and_text_are_the_librarys(codec, library):
    for text in TEXTS:
        ids = library.encode(text or "", add_eos=True)
        assert codec.encode(text or "") == ids
        assert codec.decode(ids) == library.decode(ids)


def test_random_texts(codec, library):
    draw = random.Random(5)
    parts = ["a", "the", "▁", " ", "  ", "\n", "\t", "\r", "é", "中", "😀", "\x00", "22", ";\r", '"', "{", "ing", "    ",
             "　", "ﬁ", "<s>", "</s>", "<0x41>", "\x7f", "त", "ation", ",", "."]
    for _ in range(1500):
        text = "".join(draw.choice(parts) for _ in range(draw.randint(0, 40)))
        ids = library.encode(text, add_eos=True)
        assert codec.encode(text) == ids, text
        assert codec.decode(ids) == library.decode(ids), text


def test_random_ids(codec, library):
    draw = random.Random(6)
    for _ in range(1500):
        ids = [draw.randrange(1, 700) for _ in range(draw.randint(0, 8))]
        assert codec.decode(ids) == library.decode(ids), ids


def test_search_equals_merging(codec):
    draw = random.Random(7)
    for _ in range(500):
        text = "".join(draw.choice("aeinrst▁h") for _ in range(draw.randint(1, 30)))
        assert codec.split(text) == codec.merge(text)


def test_small_stores_change_nothing(monkeypatch, library):
    monkeypatch.setattr(sentencepiece_codec, "WORDS_KEPT", 3)
    monkeypatch.setattr(sentencepiece_codec, "PAIRS_KEPT", 3)
    own = sentencepiece_codec.Codec(queries.piece_model())
    text = "the quick brown fox, the lazy dog and the quick end"
    assert own.encode_decode(text)[0] == " ".join(map(str, library.encode(text, add_eos=True)))


def test_rows(awkward, nothing, library):
    got = sentencepiece_codec.tokens(awkward, queries.piece_model()).collect()
    want = []
    for i, text, *_ in rows():
        ids = library.encode(text or "", add_eos=True)
        want.append((i, len(ids), sha(" ".join(map(str, ids))), sha(library.decode(ids)), ids))
    key = lambda r: (r[0] is None, r[0] or 0, r[2])
    assert sorted(map(tuple, got), key=key) == sorted(want, key=key)
    assert sentencepiece_codec.tokens(nothing, queries.piece_model()).count() == 0


def test_query(run, table, library):
    got = {r["doc_id"]: r for r in run("op1_sentencepiece")}
    docs = table("select doc_id, coalesce(text, '') from '{sf}/documents.parquet'")
    assert len(got) == len(docs)
    for i, text in docs:
        ids = library.encode(text, add_eos=True)
        assert got[i]["n_tokens"] == len(ids) and got[i]["ids_sha256"] == sha(" ".join(map(str, ids)))
        assert got[i]["decoded_sha256"] == sha(library.decode(ids))
