"""The forest for large tables against a plain version and Spark's, for any number of blocks."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from barsmith.operators import boosting, evaluation, forest, training
from barsmith.operators.forest import ForestParams
from barsmith.sources import registry, writers

WEIGHTS = {0: 1.5, 1: 0.8, 2: 1.0}


def table(spark, n=500, features=2, seed=5):
    """Rows that repeat, some of them often."""
    rng, rows = random.Random(seed), []
    for i in range(n):
        values = [float(rng.randrange(6 if k % 2 else 25)) for k in range(features)]
        label = rng.randrange(3) if rng.random() < .2 else 0 if values[0] > 15 else 1 if values[1] > 2 else 2
        rows += [(label, *values)] * rng.choice([1, 1, 2, 5])
    return spark.createDataFrame(rows, ", ".join(["label int", *(f"f{k} double" for k in range(features))]))


def names(df):
    return [c for c in df.columns if c.startswith("f")]


def plain_tree(x, y, times, weights, params):
    """The class shares of every row, divided row by row. With two features each node may use both."""
    w = np.array([weights[c] for c in range(3)])
    out = np.zeros((len(y), 3))

    def counts(rows):
        return np.bincount(y[rows], times[rows], 3)

    def uneven(c):
        return (c * w).sum() - ((c * w) ** 2).sum() / (c * w).sum()

    def build(every, depth):
        whole, best = counts(every), None
        if depth < params.max_depth:
            for f in range(x.shape[1]):
                for cut in sorted(set(x[:, f]))[1:]:
                    low, high = every[x[every, f] < cut], every[x[every, f] >= cut]
                    if min(times[low].sum(), times[high].sum()) < params.min_leaf_rows:
                        continue
                    gain = uneven(whole) - uneven(counts(low)) - uneven(counts(high))
                    if gain > 1e-9 * uneven(whole) and (best is None or gain > best[0] + 1e-9):
                        best = gain, low, high
        share, decided = whole * w / (whole * w).sum(), int((whole * w).argmax())
        if best:
            sides = [build(side, depth + 1) for side in best[1:]]
            if not all(leaf and d == sides[0][1] for leaf, d in sides):
                return False, decided
        out[every] = share
        return True, decided

    build(np.arange(len(y)), 0)
    return out


@pytest.mark.parametrize("params", [ForestParams(4, 5), ForestParams(3, 9, 1, 7), ForestParams(3, 3, 20, -1)])
def test_equals_the_plain_version(spark, monkeypatch, params):
    df = table(spark)
    model = forest._in_tasks
    seen = {}

    def kept(blocks, layout, weights, given):
        seen["blocks"] = [forest.Block(r.asDict()) for r in blocks.collect()]
        return model(blocks, layout, weights, given)

    monkeypatch.setattr(forest, "_in_tasks", kept)
    got = forest.fit(df, names(df), WEIGHTS, params)
    (block,) = seen["blocks"]
    assert block.count.sum() == df.count() and block.count.max() > 8
    values = [np.concatenate([c - .5, c[-1:] + .5]) for c in got.layout.cuts]  # one of each bin
    x = np.stack([values[f].take(block.bins[:, f]) for f in range(2)], axis=1)
    want = sum(plain_tree(x, block.label, block.drawn(params.seed, t), WEIGHTS, params) for t in range(params.trees))
    assert np.allclose(got.probabilities(x.T), want.T / params.trees)


def same(a, b):
    return len(a.trees) == len(b.trees) and all(
        s.depth == t.depth and all(np.array_equal(getattr(s, f), getattr(t, f)) for f in ("feature", "split", "left", "shares"))
        for s, t in zip(a.trees, b.trees))


def test_blocks_tasks_and_waves_do_not_matter(spark):
    df, params = table(spark, 700, 12), ForestParams(7, 8)
    whole = forest.fit(df, names(df), WEIGHTS, params)
    assert same(whole, forest.fit(df.repartition(5), names(df), WEIGHTS, params, block_rows=90))
    passes = forest.fit(df, names(df), WEIGHTS, params, block_rows=90, task_rows=0, wave_bytes=200_000)
    assert same(whole, passes) and max(t.depth for t in whole.trees) == 8


def test_draws_are_poisson():
    """A row that stands for n equal ones is drawn like n rows: mean and variance are n."""
    n = 40_000
    for count in (1, 3, 60, 1000, 1001):
        rng = np.random.default_rng(count)
        block = forest.Block({"rows": n, "bins": bytes(n), "label": bytes(n), "count": np.full(n, count).tobytes(),
                              "key": rng.integers(-2**63, 2**63 - 1, n).tobytes()})
        found = block.drawn(42, 0)
        assert abs(found.mean() - count) < 5 * math.sqrt(count / n) and abs(found.var() / count - 1) < 0.05
        if count == 1:
            assert abs((found == 0).mean() - math.exp(-1)) < 0.01
        assert not np.array_equal(found, block.drawn(42, 1))


def test_large_tables_do_not_keep_numbers_per_row_and_tree(spark, monkeypatch, tmp_path):
    """Above a block of rows the forest is the one on binned rows; it agrees with Spark's, also when loaded."""
    df = spark.range(66_000).select(
        (F.abs(F.hash("id")) % 3).cast("int").alias("noise"), (F.abs(F.xxhash64("id")) % 1000 / 100).alias("f0"),
        (F.abs(F.hash("id", "id")) % 7).cast("double").alias("f1"), "id").selectExpr(
        "id", "f0", "f1", "if(id % 5 = 0, noise, if(f0 > 6, 0, if(f1 > 3, 1, 2))) as label")
    params = ForestParams(trees=12, max_depth=5)
    theirs = training.fit_forest(df, ["f0", "f1"], params, spark_rows=10**9)

    def refused(**_):
        raise AssertionError("Spark's forest")

    monkeypatch.setattr(training, "RandomForestClassifier", refused)
    ours = training.fit_forest(df, ["f0", "f1"], params)
    writers.save_model(theirs, path := f"{tmp_path}/Long_PV1_2")
    writers.save_model(ours, path)  # in the place of Spark's
    loaded = registry.load_models(spark, str(tmp_path))["Long", "PV1", 2]
    assert same(ours, loaded)
    test = df.where("id < 3000")
    scored = [{r.id: (r.p_long, r.p_short, r.p_none) for r in training.forest_probabilities(m, test).collect()}
              for m in (theirs, loaded)]
    a, b = (np.array([s[i] for i in range(3000)]) for s in scored)
    assert np.abs(b.sum(axis=1) - 1).max() < 1e-9
    assert np.abs(a - b).mean() < 0.03 and (a.argmax(axis=1) == b.argmax(axis=1)).mean() > 0.97
    decided = evaluation.threshold_rule(training.forest_probabilities(ours, test))
    assert evaluation.balanced_accuracy(decided).first()["balanced_accuracy"] > 0.8


def test_gaps_constants_and_no_rows(spark):
    df = table(spark, 60)
    with pytest.raises(Exception, match="null or NaN in f0"):
        forest.fit(df.selectExpr("label", "if(f1 = 3, null, f0) as f0"), ["f0"], WEIGHTS, ForestParams(2, 3))
    with pytest.raises(ValueError, match="no rows"):
        forest.fit(df.where("false"), names(df), WEIGHTS, ForestParams(2, 3))
    flat = forest.fit(df.selectExpr("label", "1.5D as a"), ["a"], WEIGHTS, ForestParams(2, 3))
    assert all(t.depth <= 1 and len(t.left) == 1 for t in flat.trees)
    assert boosting.find_layout(df, ["f0"], 2).sizes.tolist() == [2]
