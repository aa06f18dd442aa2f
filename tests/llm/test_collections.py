"""Groups, overlaps, archives, shards, language model and pipeline against brute force."""

import math
import random
import re
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from cases import BASE, WORD, components, crc, lower, rows, shingle_set, unigram
from conftest import SF
from test_pipeline_rows import near_groups

from barsmith import session
from barsmith.llm import components as graph
from barsmith.llm import decontaminate, interpolated_lm, minhash, shards, warc


def test_groups(awkward, nothing):
    got = minhash.groups(awkward).collect()
    assert len(got) == len(rows())
    want = components([r[:2] for r in rows() if r[0] is not None])
    for r in got:
        if r.doc_id is None:
            assert r.component_id is None and r.kept
        else:
            assert r.component_id == want[r.doc_id] and r.kept == (want[r.doc_id] == r.doc_id)
    sizes = sorted(len(shingle_set(t)) for _, t, *_ in rows())
    assert sorted(r.n_shingles for r in got) == sizes
    assert minhash.groups(nothing).count() == 0


def test_ladder_of_near_copies(spark):
    """Texts with one to twenty changed words, linked in chains around the threshold."""
    draw = random.Random(4)
    start = [f"v{i}" for i in range(160)]
    docs = []
    for i in range(120):
        own = list(start)
        for k in draw.sample(range(160), i % 12):
            own[k] = f"n{i}-{k}"
        docs.append((i, " ".join(own)))
    got = {r.doc_id: r.component_id for r in minhash.groups(spark.createDataFrame(docs, "doc_id long, text string")).collect()}
    assert got == components(docs)


def test_group_query(run, table):
    docs = table("select doc_id, text from '{sf}/documents.parquet'")
    want = components(docs)
    assert {r["doc_id"]: r["component_id"] for r in run("op9_minhash")} == want


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 40) if i != 20] + [(100, 7), (200, 300)]
    got = {r.node: r.component for r in graph.label(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(21)}, **{i: 21 for i in range(21, 41)}, 100: 0, 200: 200, 300: 200}
    assert graph.label(spark.createDataFrame([], "a long, b long")).count() == 0


def test_estimate_is_corrected(spark):
    from pyspark.sql import functions as F

    settings = minhash.Settings()
    draw = np.random.default_rng(0)
    common = draw.integers(0, 2**63, 300).astype(np.uint64)
    one = np.unique(np.r_[common, draw.integers(0, 2**63, 50).astype(np.uint64)])
    two = np.unique(np.r_[common, draw.integers(0, 2**63, 50).astype(np.uint64)])
    lanes = minhash._lanes(minhash._minima([one, two], settings), settings)
    df = spark.createDataFrame([(lanes[0].tolist(), lanes[1].tolist())], "a array<long>, b array<long>")
    got = df.select(minhash.estimate(F.col("a"), F.col("b"), settings)).first()[0]
    assert abs(got - 0.75) < 0.1 and df.select(minhash.estimate(F.col("a"), F.col("a"), settings)).first()[0] == 1


ITEM = [f"q{i}" for i in range(40)]


@pytest.fixture(scope="module")
def items(spark):
    return spark.createDataFrame(
        [(1, " ".join(ITEM)), (2, None), (3, ""), (4, "short one"), (5, BASE), (5, BASE), (None, "z " * 40)],
        "item_id long, text string")


def test_overlaps(spark, items, awkward, nothing):
    noise = [f"u{i}" for i in range(300)]
    changed = [w if i % 6 else "other" for i, w in enumerate(ITEM)]
    docs = {1: noise[:50] + ITEM + noise[50:], 2: noise + changed, 3: noise, 4: ITEM[:12] + noise, 5: ITEM[:24],
            6: [w.upper() + "," for w in ITEM], 7: None, 8: []}
    df = spark.createDataFrame([(i, None if w is None else " ".join(w)) for i, w in docs.items()], "doc_id long, text string")
    got = {r.doc_id: r for r in decontaminate.overlaps(df, items).collect()}
    assert set(got) == {1, 2, 5, 6} and {r.item_id for r in got.values()} == {1}
    assert (got[1].first_word, got[1].end_word, got[1].equal_words) == (50, 90, 40)
    # Three equal words after the last substitution do not outweigh it.
    assert (got[2].first_word, got[2].end_word, got[2].equal_words) == (301, 336, 30)
    pairs = {(r.doc_id, r.item_id) for r in decontaminate.overlaps(awkward, items).collect()}
    assert {(18, 5), (21, 5), (24, 5), (27, 5), (None, 5)} <= pairs and all(p[1] == 5 for p in pairs)
    assert decontaminate.overlaps(nothing, items).count() == 0
    assert decontaminate.overlaps(df, items.where("false")).count() == 0


def test_full_bitmap_only_costs_time(spark, items, monkeypatch):
    docs = spark.createDataFrame([(1, " ".join(["a", *ITEM])), (2, "b " * 100)], "doc_id long, text string")
    want = decontaminate.overlaps(docs, items).collect()
    monkeypatch.setattr(decontaminate, "bitmap", lambda seeds: np.full(1 << 18, -1))
    assert decontaminate.overlaps(docs, items).collect() == want


TERM = re.compile("[0-9a-z\x80-\U0010ffff]+")


def run_of(equal):
    """Equal words of the best run: all runs are tried, the first end and then the shortest run wins ties."""
    best = (0, 0, 0, 0)
    for end in range(len(equal) + 1):
        for start in range(end, -1, -1):
            n = sum(equal[start:end])
            gain = 2 * n - 8 * (end - start - n)  # tenths
            if gain > best[0]:
                best = gain, n, start, end
    return best[1]


def accepted(equal, size):
    """The rule for one diagonal, as it is written down."""
    if size >= 8 and 10 * sum(equal) >= 8 * size:
        return True
    copied = max(map(len, "".join("x" if e else " " for e in equal).split()), default=0)
    return copied >= 13 or run_of(equal) >= min(max(min(8, size), size / 2), 25)


def overlapping(docs, items):
    """Pairs of documents and items of 5 words and more that overlap, from all diagonals."""
    wanted = {i: TERM.findall(lower(t)) for i, t in items.items()}
    found = set()
    for i, text in docs.items():
        own = TERM.findall(lower(text))
        places = {}
        for at, word in enumerate(own):
            places.setdefault(word, []).append(at)
        for item, words in wanted.items():
            if len(words) < 5:
                continue
            shifts = Counter(at - k for k, w in enumerate(words) for at in places.get(w, ()))
            for shift, n in shifts.items():
                low, high = max(0, shift), min(len(own), shift + len(words))
                if n >= 5 and accepted([own[k] == words[k - shift] for k in range(low, high)], len(words)):
                    found.add((i, item))
                    break
    return found


def test_overlap_query(run, table):
    want = overlapping(dict(table("select doc_id, text from '{sf}/documents.parquet'")),
                       dict(table("select * from '{sf}/benchmark.parquet'")))
    assert {(r["doc_id"], r["item_id"]) for r in run("op4_decontamination")} == want


def test_random_substitutions_are_found(spark):
    """Items of which a fifth of the words, rounded down, are changed at random places."""
    draw = random.Random(11)
    sizes = [8, 10, 15, 20, 50]
    items, docs = {}, {}
    for size in sizes:
        for k in range(60):
            key = 1000 * size + k
            items[key] = [f"i{key}w{i}" for i in range(size)]
            own = list(items[key])
            for at in draw.sample(range(size), size // 5):
                own[at] = f"n{key}q{at}"
            docs[key] = [f"u{draw.randrange(500)}" for _ in range(draw.randrange(40))] + own + ["tail"] * draw.randrange(40)

    def frame(table_, key):
        return spark.createDataFrame([(k, " ".join(w)) for k, w in table_.items()], f"{key} long, text string")

    found = {(r.doc_id, r.item_id) for r in decontaminate.overlaps(frame(docs, "doc_id"), frame(items, "item_id")).collect()}
    assert all(d == i for d, i in found)
    for size in sizes:
        assert sum(d // 1000 == size for d, _ in found) >= 0.9 * 60, size


def test_archive(spark, monkeypatch):
    monkeypatch.setattr(warc, "GAP_BYTES", 10)
    data = [(1, "u", "abc"), (2, "v\n w", "abc"), (3, None, None), (4, "", ""), (5, "é", "é" * 1000), (6, "x", "abc"),
            (6, "x", "abc"), (None, "n", "only"), (None, "n", "abc")]
    pages = spark.createDataFrame([(*r, "clash") for r in data], "page_id long, url string, html string, refers_to string")
    index = warc.write(pages, session.scratch(spark, "warc"))
    got = sorted(((r.page_id is not None, r.page_id or 0, r.record_type, r.refers_to, r.payload_bytes, r.payload)
                  for r in warc.read(index).collect()), key=str)
    digests = {r.page_id: r.payload_digest for r in warc.read(index, with_payload=False).collect()}
    assert len({digests[i] for i in (1, 2, 6)}) == 1 and digests[1] == warc.digest(b"abc")
    want = [(True, 1, "revisit", 6, 3, None), (True, 2, "revisit", 6, 3, None), (True, 3, "revisit", 4, 0, None),
            (True, 4, "response", None, 0, b""), (True, 5, "response", None, 2000, ("é" * 1000).encode()),
            (True, 6, "response", None, 3, b"abc"), (True, 6, "response", None, 3, b"abc"),
            (False, 0, "response", None, 4, b"only"), (False, 0, "revisit", 6, 3, None)]
    assert [tuple(None if pd.isna(v) else v for v in g) for g in got] == sorted(want, key=str)
    assert [r.page_id for r in warc.read(index.where("page_id = 5")).collect()] == [5]
    longer = warc.write(pages, session.scratch(spark, "warc"), least_bytes=4)
    assert {r.record_type for r in longer.collect()} == {"response"}
    assert warc.read(warc.write(pages.where("false"), session.scratch(spark, "warc"))).count() == 0


def test_joined_ranges(monkeypatch):
    monkeypatch.setattr(warc, "GAP_BYTES", 5)
    monkeypatch.setattr(warc, "RANGE_BYTES", 100)
    got = list(warc.ranges([(0, 10), (12, 10), (40, 10), (50, 70), (119, 300), (419, 10)]))
    assert got == [(0, 22, [0, 1]), (40, 120, [2, 3]), (119, 419, [4]), (419, 429, [5])]


def test_archive_query(run, table):
    pages = table("select page_id, coalesce(html, '') from '{sf}/pages.parquet'")
    first = {}
    for i, html in pages:
        first[html] = max(i, first.get(html, i))
    got = {r["page_id"]: r for r in run("op5_warc")}
    assert len(got) == len(pages)
    for i, html in pages:
        r = got[i]
        assert (r["payload_bytes"], r["payload_digest"]) == (len(html.encode()), warc.digest(html.encode()))
        assert r["record_type"] == ("response" if first[html] == i else "revisit")
        assert r["refers_to"] == (None if first[html] == i else first[html])


def _check_shards(got, total, n):
    by = Counter(r["shard"] for r in got)
    assert sum(by.values()) == total and max(by.values()) - min(by[s] for s in range(n)) <= 1
    for s in range(n):
        assert sorted(r["slot"] for r in got if r["shard"] == s) == list(range(by[s]))


def test_shards(spark, awkward, nothing):
    for bucket_bytes in (1 << 30, 20_000):
        stored = shards.write(awkward, session.scratch(spark, "shards"), 4, bucket_bytes=bucket_bytes)
        assert stored.columns == [c for c in awkward.columns if c != "shard"] + ["shard", "slot"]
        got = [r.asDict() for r in stored.collect()]
        _check_shards(got, len(rows()), 4)
        assert Counter((r["doc_id"], r["text"]) for r in got) == Counter(r[:2] for r in rows())
    assert shards.write(nothing, session.scratch(spark, "shards"), 4).count() == 0


def test_shard_order_is_shuffled(spark):
    docs = spark.range(4000).selectExpr("id as doc_id", "cast(id as string) as text")
    stored = shards.write(docs, session.scratch(spark, "shards"), 4, bucket_bytes=20_000).orderBy("shard", "slot")
    ids = [r.doc_id for r in stored.collect()]
    assert sorted(ids) == list(range(4000))
    assert abs(np.corrcoef(ids, range(4000))[0, 1]) < 0.1


def test_shard_query(run, table):
    got = run("op8_sharding")
    docs = dict(table("select doc_id, coalesce(text, '') from '{sf}/documents.parquet'"))
    _check_shards(got, len(docs), 40)
    for r in got:
        raw = docs[r["doc_id"]].encode()
        assert (r["size"], r["law"], r["grown_shard"]) == (len(raw) + 16, "rows", None)
        import zlib
        assert r["text_crc32"] == zlib.crc32(raw)


def test_language_model_query(run, table):
    docs = table("select doc_id, text from '{sf}/documents.parquet'")
    want = unigram(docs)
    for r in run("op7_language_model"):
        n, known, total, base = want[r["doc_id"]]
        assert (r["n_tokens"], r["n_known"], r["train_tokens"]) == (n, known, total)
        assert r["held_out"] == (crc(r["doc_id"]) % 7 == 2) and math.isclose(r["base_score"], base, rel_tol=1e-9)
        assert math.isfinite(r["score"]) and r["score"] < 0


def test_language_model_scores(spark, awkward, nothing):
    """Counts and mixture against a plain computation with the weights that were learned."""
    learned = {}
    plain = interpolated_lm.learn_weights

    def keep(cells, uniform, rounds):
        learned["weights"] = plain(cells, uniform, rounds)
        return learned["weights"]

    interpolated_lm.learn_weights = keep
    try:
        docs = [(i, " ".join(random.Random(i).choices(["a", "b", "c", "dd", "e"], [9, 5, 3, 1, 1], k=i % 30))) for i in range(300)]
        df = spark.createDataFrame(docs, "doc_id long, text string")
        got = {r.doc_id: r.score for r in interpolated_lm.score(
            df, settings=interpolated_lm.Settings(chunk_bytes=1500)).collect()}
        whole = {r.doc_id: r.score for r in interpolated_lm.score(df).collect()}
    finally:
        interpolated_lm.learn_weights = plain
    train = {i: [None, *WORD.findall(t), "</s>"] for i, t in docs if crc(i) % 7 != 2}
    word = Counter(w for ws in train.values() for w in ws[1:])
    pair = Counter(p for ws in train.values() for p in zip(ws, ws[1:]))
    context = Counter(w for ws in train.values() for w in ws[:-1])
    n, v = sum(word.values()), len(word)
    for i, t in docs:
        ws = [None, *WORD.findall(t), "</s>"]
        total = 0.0
        for a, b in zip(ws, ws[1:]):
            w = learned["weights"][interpolated_lm.context_bucket(np.array([context[a]]))[0]]
            total += math.log10(w[0] * (pair[a, b] / context[a] if context[a] else 0) + w[1] * word[b] / n + w[2] / (v + 1))
        assert math.isclose(whole[i], total, rel_tol=1e-9) and math.isclose(got[i], total, rel_tol=0.2)
    assert len(interpolated_lm.score(awkward).collect()) == len(rows())
    assert interpolated_lm.score(nothing).count() == 0


def test_weights_follow_the_counts():
    cells = pd.DataFrame({"bucket": [5, 5, 1, 0], "n": [900, 100, 100, 10], "p2": [0.9, 0.0, 0.0, 0.0],
                          "p1": [0.01, 0.01, 0.01, 0.0]})
    w = interpolated_lm.learn_weights(cells, 1e-4, 60)
    assert np.allclose(w.sum(axis=1), 1) and w[5, 0] > 0.8 and w[1, 1] > 0.8 and w[0, 0] == 0 and (w[:, 2] > 0).all()


def test_pipeline(spark, table):
    import corpus_pipeline as pipe

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    texts = dict(table("select doc_id, text from '{sf}/documents.parquet'"))
    kept = docs
    seen = []
    for name, stage in pipe.STAGES:
        kept = session.materialize(stage(spark, kept, SF), name)
        seen.append({r.doc_id for r in kept.collect()})
        if name != "tokens":
            assert kept.columns == docs.columns
    assert seen[0] == {i for i, t in texts.items() if any(c.isalpha() for c in t or "")}
    groups = near_groups([(i, texts[i]) for i in seen[0]])  # from 0.8 on
    assert seen[1] == {i for i in seen[0] if groups[i] == i}
    leaks = overlapping({i: texts[i] for i in seen[1]}, dict(table("select * from '{sf}/benchmark.parquet'")))
    assert seen[2] == seen[1] - {i for i, _ in leaks} and seen[3] == seen[2] == seen[4]
    assert len(pipe.run(spark, SF).collect()) == len(seen[4])


def test_archives_are_read_by_many_tasks(spark, monkeypatch):
    monkeypatch.setattr(warc, "TASK_BYTES", 2000)
    pages = spark.createDataFrame([(i, f"u{i}", f"{i} " * 2000) for i in range(60)], "page_id long, url string, html string")
    index = warc.write(pages.repartition(3), session.scratch(spark, "warc"))
    size = index.agg({"length": "sum"}).first()[0]
    got = warc.read(index)
    assert size > 4000 and got.rdd.getNumPartitions() >= size / 2000
    assert sorted(r.page_id for r in got.collect()) == list(range(60))
    assert warc.address("s3a://bucket/a.warc.gz") == "s3://bucket/a.warc.gz"
    assert warc.address("hdfs://host/a") == "hdfs://host/a" and warc.address("/tmp/a") == "/tmp/a"


def test_bucket_starts_are_a_table(spark):
    """Sums over two levels, and a plan that does not grow with the buckets."""
    sizes = {}
    for n in (200, 20_000):
        counts = spark.range(n).selectExpr("id as __bucket", "id % 7 as rows")
        got = sorted(map(tuple, shards._starts(counts).collect()))
        assert got == [(i, sum(k % 7 for k in range(i))) for i in range(200)] if n == 200 else len(got) == n
        docs = spark.createDataFrame([(i, f"text {i}") for i in range(300)], "doc_id long, text string")
        stored = shards.write(docs, session.scratch(spark, "shards"), 4, bucket_bytes=8000 // n + 1)
        assert stored.count() == 300
        sizes[n] = len(shards._starts(counts)._jdf.queryExecution().optimizedPlan().toString())
    assert abs(sizes[200] - sizes[20_000]) < 100


def test_pipeline_stages_take_awkward_rows(spark, awkward, nothing):
    import corpus_pipeline as pipe

    for docs in (awkward.drop("component_id", "spans", "shard"), nothing.drop("component_id", "spans", "shard")):
        for _, stage in pipe.STAGES:
            stage(spark, docs, SF).collect()
