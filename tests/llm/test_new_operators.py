"""Ranked search, content sort and Merkle witnesses against brute force."""

import hashlib
import math
import random
import string
from collections import Counter, defaultdict

import numpy as np
import pytest
from cases import lower, rows, sha
from pyspark.sql import functions as F

from barsmith.llm import content_sort, dense_search, merkle
from barsmith.llm.native_text import ascii_lower


# --- text ---------------------------------------------------------------------------------

def test_only_ascii_letters_are_lowered(spark):
    """Every code point, alone and after a letter, as one text per 4096 of them."""
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    texts = ["".join(map(chr, points[i : i + 4096])) for i in range(0, len(points), 4096)]
    texts += ["Ab" + chr(c) + "Z" for c in points if chr(c).lower() != chr(c) or chr(c).isupper()]
    texts += ["ΑΣ Σ ΟΔΟΣ", "İI", "ÀBC", None, ""]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select("t", ascii_lower(F.col("t")).alias("low")).collect()
    assert all(r.low == (None if r.t is None else lower(r.t)) for r in got)


# --- exact copies -------------------------------------------------------------------------

def copies(docs, keep):
    """Per id and digest: keep_id, size, and how many rows stay."""
    found = defaultdict(list)
    for i, text in docs:
        found[lower(text)].append(i)
    best = {t: (min if keep == "smallest" else max)([i for i in ids if i is not None], default=None)
            for t, ids in found.items()}
    return {(i, sha(t)): (best[t], len(ids)) for t, ids in found.items() for i in ids}


def check_copies(got, docs, keep):
    want = copies(docs, keep)
    assert Counter((r.doc_id, r.text_sha256) for r in got) == Counter((i, sha(lower(t))) for i, t in docs)
    assert all(want[r.doc_id, r.text_sha256] == (r.keep_id, r.group_size) for r in got)
    kept = [r for r in got if r.kept]
    assert sorted(r.text_sha256 for r in kept) == sorted({sha(lower(t)) for _, t in docs})
    assert all(r.doc_id == r.keep_id for r in kept)


@pytest.mark.parametrize("keep", ["smallest", "largest"])
def test_copies_of_awkward_rows(awkward, nothing, keep):
    check_copies(content_sort.groups(awkward, keep=keep).collect(), [r[:2] for r in rows()], keep)
    assert content_sort.groups(nothing, keep=keep).count() == 0


@pytest.mark.parametrize("keep", ["smallest", "largest"])
def test_large_groups_are_dealt_over_chunks(spark, keep):
    """A third of all rows are copies of one text, a third of another with the same long opening."""
    long = "the same opening " * 20
    docs = [(i, long + "A" if i % 3 == 0 else long + "b" if i % 3 == 1 else f"{long}{i // 6}") for i in range(1500)]
    docs += [(None, long + "a")] * 40 + [(7, long + "b")] * 40
    random.Random(1).shuffle(docs)
    table = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    check_copies(content_sort.groups(table, keep=keep, partitions=16).collect(), docs, keep)


def test_copies_stay_in_spark(spark, monkeypatch):
    """No Python in the plans, and texts are sorted by range."""
    seen = []
    real = content_sort.session.materialize
    monkeypatch.setattr(content_sort.session, "materialize", lambda df, name: seen.append(
        df._jdf.queryExecution().executedPlan().toString()) or real(df, name))
    docs = spark.createDataFrame([(i, f"t{i % 4}") for i in range(50)], "doc_id long, text string")
    last = content_sort.groups(docs)._jdf.queryExecution().executedPlan().toString()
    assert not any(word in plan for plan in [*seen, last] for word in ("Python", "Arrow", "Pandas", "CartesianProduct"))
    runs = next(p for p in seen if "Window" in p)
    assert runs.count("rangepartitioning") == 1 and "hashpartitioning" not in runs.split("BroadcastHashJoin")[0]


# --- ranked search ------------------------------------------------------------------------

def brute_search(docs, items, k):
    terms = [dense_search.terms_of(t) for _, t in docs]
    n, total = sum(map(bool, terms)), sum(map(len, terms))
    df = Counter(t for ts in terms for t in set(ts))
    counts = [Counter(ts) for ts in terms]
    out = []
    for item, text in set(items):
        own = set(dense_search.terms_of(text))
        scores = []
        for (i, _), ts, tf in zip(docs, terms, counts):
            if ts:
                m = 100 - 50 + 50 * len(ts) * n // total
                s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1)))
                        * (10**9 * tf[t] // (1000 * tf[t] + 20 * m)) for t in own if tf[t])
                if s > 0:
                    scores.append((-s, i is None, i or 0))
        out += [(item, r, None if none else i, -s) for r, (s, none, i) in enumerate(sorted(scores)[:k], 1)]
    return out


def order(found):
    return sorted(found, key=lambda r: tuple((v is None, v or 0) for v in r))


@pytest.mark.parametrize("settings", [
    dense_search.Settings(), dense_search.Settings(k=2, items=2, width=3, held=4, groups=2)])
def test_search(awkward, nothing, spark, settings):
    items = [(1, "the GNU license, and word30 word31"), (1, "mail one"), (1, "mail one"), (2, None), (None, "SAME same"),
             (4, "ñandú 中文 é 255"), (5, "w5 w6 the end"), (6, "zebra"), (7, " ".join(f"word{i}" for i in range(60)))]
    table = spark.createDataFrame(items, "item_id long, text string")
    got = order(map(tuple, dense_search.search(awkward, table, settings=settings).collect()))
    assert got == order(brute_search([r[:2] for r in rows()], items, settings.k))
    assert dense_search.search(nothing, table).count() == 0
    assert dense_search.search(awkward, table.where("false")).count() == 0


def test_many_ties_at_the_border(spark):
    """Far more equal scores than places: the smallest ids win, whatever the tiles."""
    docs = [(i * 7919 % 3001, "a common text" if i % 3 else "a common text with more words") for i in range(3000)]
    items = [(1, "common"), (2, "more common")]
    got = dense_search.search(
        spark.createDataFrame(docs, "doc_id long, text string").repartition(7),
        spark.createDataFrame(items, "item_id long, text string"), settings=dense_search.Settings(held=100))
    assert order(map(tuple, got.collect())) == order(brute_search(docs, items, 50))


def test_products_stay_exact():
    """Weights so large that only few terms fit below 2^53 are split over several products."""
    tile = dense_search.Tile.of([["a", "b", "c", "d", "e"], ["c"]])
    tile.weight = np.array([(1 << 32) + 3 * i + 1 for i in range(5)])
    tile.documents, tile.length = 10, 100
    assert tile.width(4096) == 2
    tf = np.arange(1, 6, dtype=np.int64)
    got = tile.scores(np.array([10]), np.zeros(5, np.int64), np.arange(5), tf, 4096)
    m = 100 - 50 + 50 * 10 * 10 // 100
    impact = [10**9 * int(t) // (1000 * int(t) + 20 * m) for t in tf]
    assert got[0, 0] == sum(int(w) * i for w, i in zip(tile.weight, impact)) > dense_search.EXACT / 4
    place = tile.vocabulary.terms.index("c")
    assert got[1, 0] == int(tile.weight[place]) * impact[place]


def test_terms_with_one_hash_are_told_apart(monkeypatch):
    """Equal hashes: words are matched by their bytes."""
    import pyarrow as pa

    real = dense_search.words.hash_words

    def crowded(*args):
        found = real(*args)
        found.hash = found.hash % np.uint64(2)
        return found

    monkeypatch.setattr(dense_search.words, "hash_words", crowded)
    vocabulary = dense_search.Vocabulary(list(string.ascii_lowercase[:9]) + ["ab", "abc"])
    text = "A b ab abc abd zz c c"
    (_, _, n, _, term, tf), = vocabulary.counts(pa.array([text]))
    assert n[0] == 8
    assert {vocabulary.terms[t]: c for t, c in zip(term, tf)} == {"a": 1, "b": 1, "ab": 1, "abc": 1, "c": 2}


# --- Merkle witnesses ---------------------------------------------------------------------

def encode(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def plain_tree(nodes):
    """All levels of the tree over the nodes."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        last = levels[-1]
        levels.append([sha("".join(last[i : i + 3])) for i in range(0, len(last), 3)])
    return levels


def plain_witness(levels, at):
    out = []
    for level in levels[:-1]:
        low = at // 3 * 3
        out.append(("".join(level[low:at]), "".join(level[at + 1 : low + 3])))
        at //= 3
    return out


def plain_manifest(docs):
    """Sorted (id, source, leaf, steps, subroot, root)."""
    groups = defaultdict(list)
    for i, source, *values in docs:
        leaf = sha("".join(map(encode, (i, source, *values))))
        groups[source].append((i is not None, i or 0, leaf))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {s: plain_tree([leaf for *_, leaf in sorted(groups[s])]) for s in names}
    top = plain_tree([trees[s][-1][0] for s in names])
    out = []
    for place, s in enumerate(names):
        for at, (known, i, leaf) in enumerate(sorted(groups[s])):
            steps = plain_witness(trees[s], at) + plain_witness(top, place)
            out.append((i if known else None, s, leaf, steps, trees[s][-1][0], top[-1][0]))
    return out


def check_manifest(got, docs):
    key = lambda r: (r[1] is not None, r[1] or "", r[0] is not None, r[0] or 0, r[2], r[3])
    rows_ = [(r.doc_id, r.source, r.leaf, [tuple(s) for s in r.steps], r.subroot, r.root) for r in got]
    assert sorted(rows_, key=key) == sorted(plain_manifest(docs), key=key)


def test_manifest_of_awkward_rows(awkward, nothing):
    columns = ["doc_id", "source", "lang", "n_chars", "text"]
    got = merkle.manifest(awkward, columns).collect()
    check_manifest(got, [(r[0], r[3], r[2], r[4], r[1]) for r in rows()])
    assert merkle.manifest(nothing, columns).count() == 0


def test_sources_of_many_sizes(spark, monkeypatch):
    """Blocks of 9 leaves, so witnesses go through several rounds; one source holds a third of all rows."""
    monkeypatch.setattr(merkle, "LEVELS", 2)
    monkeypatch.setattr(merkle, "BLOCK", 9)
    sizes = [*range(1, 31), 81, 82, 243, 500]
    docs = [(1000 * k + 3 * i, f"s{k}") for k, n in enumerate(sizes) for i in range(n)]
    docs += [(5, None), (6, None), (5, ""), (None, "")] + [(8, "s2")] * 11
    random.Random(2).shuffle(docs)
    table = spark.createDataFrame(docs, "doc_id long, source string").repartition(3)
    check_manifest(_local(table), docs)


def _local(table):
    """The rounds without tasks, where a changed block size would not be seen."""
    def run(nodes):
        placed = nodes.withColumn("block", F.expr(f"pos div {merkle.BLOCK}")).orderBy("group", "block", "pos")
        schema = ", ".join(f"`{n}` {k}" for n, k in placed.dtypes) + f", steps {merkle.STEPS}, block_root string"
        batches = placed.toArrow().to_batches(max_chunksize=7)
        rows_ = [r for b in merkle._append(iter(batches)) for r in b.to_pylist()]
        return merkle.session.materialize(table.sparkSession.createDataFrame(rows_, schema), "appended")

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(merkle, "_round", run)
        return merkle.manifest(table, ["doc_id", "source"]).collect()


def test_one_row_and_folding(spark):
    one = spark.createDataFrame([(1, "a")], "doc_id long, source string")
    r = merkle.manifest(one, ["doc_id"]).first()
    assert r.leaf == r.subroot == r.root == sha("1:1") and r.steps == []
    many = spark.createDataFrame([(i, "ab"[i % 2]) for i in range(40)], "doc_id long, source string")
    shown = merkle.manifest(many, ["doc_id"]).select(
        "root", merkle.fold(F.col("leaf"), F.col("steps")).alias("up"), merkle.proof_hash(F.col("steps")).alias("proof"),
        merkle.fold(F.lit(sha("x")), F.col("steps")).alias("wrong"), "steps").collect()
    assert all(r.up == r.root != r.wrong for r in shown)
    assert all(r.proof == hashlib.sha256("".join(s.left + s.right for s in r.steps).encode()).hexdigest() for r in shown)


def test_frontier_extends_witnesses_of_older_nodes():
    """A partial witness grows when later siblings close; the open run holds at most two nodes a level."""
    frontier = merkle.Frontier()
    values = [sha(str(i)) for i in range(14)]
    for n, value in enumerate(values):
        frontier.append(value)
        assert all(len(run) < merkle.ARITY for run in frontier.open)
        run = n // 3 * 3
        assert frontier.leaves[run].right == "".join(values[run + 1 : n + 1])
    levels = merkle.levels_of(14)
    tree = plain_tree(values)
    assert frontier.close(levels) == tree[-1][0]
    assert [[(s.left, s.right) for s in frontier.witness(leaf, levels)] for leaf in frontier.leaves] \
        == [plain_witness(tree, i) for i in range(14)]


