"""The boosted model against a plain version, for any number of blocks, and its early end."""

import random

import numpy as np
import pytest

from barsmith.operators import boosting, training
from barsmith.operators.boosting import BoostParams

NAMES = ["a", "b", "c", "flag"]


def table(spark, n=400, seed=5):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        a, b, c = rng.gauss(0, 1), rng.gauss(0, 1), rng.choice([0.0, 1.0, 2.5])
        label = 0 if a + b > 0.7 else 1 if a * c < -0.5 else 2
        rows.append((i, rng.randrange(3) if rng.random() < .15 else label, a, b, c, float(rng.random() < .1),
                     rng.choice([0.5, 1.0, 2.0])))
    return spark.createDataFrame(rows, "bar_id long, label int, a double, b double, c double, flag double, weight double")


def plain_fit(x, y, w, key, layout, params):
    """The same rules row by row: no bins added up beforehand, no siblings by subtraction, sums in floats."""
    f, n = x.shape
    margins = np.zeros((3, n))
    for r in range(params.rounds):
        e = np.exp(margins)
        p = e / e.sum(axis=0)
        use = boosting.drawn(key, params.seed, r, params.row_share)
        allowed = boosting._columns(params, r, f)
        steps = np.zeros((3, n))
        for c in range(3):
            g, h = w * (p[c] - (y == c)), w * 2 * p[c] * (1 - p[c])

            def quality(rows):
                return max(abs(g[rows].sum()) - params.alpha, 0) ** 2 / (h[rows].sum() + params.l2)

            def divide(every, depth):
                own = every[use[every]]
                best = None
                if depth < params.max_depth:
                    for k in range(f):
                        for cut in layout.cuts[k] if allowed[c, k] else ():
                            low, high = own[x[k, own] < cut], own[x[k, own] >= cut]
                            if min(h[low].sum(), h[high].sum()) < max(params.min_child_weight, 1e-9):
                                continue
                            gain = quality(low) + quality(high) - quality(own)
                            if gain >= params.gamma and (best is None or gain > best[0] + 1e-9):
                                best = gain, k, cut
                if best is None:
                    total = g[own].sum()
                    steps[c, every] = -params.learning_rate * np.sign(total) * max(abs(total) - params.alpha, 0) \
                        / (h[own].sum() + params.l2)
                else:
                    divide(every[x[best[1], every] < best[2]], depth + 1)
                    divide(every[x[best[1], every] >= best[2]], depth + 1)

            divide(np.arange(n), 0)
        margins += steps
    e = np.exp(margins)
    return e / e.sum(axis=0)


@pytest.mark.parametrize("params", [
    BoostParams(max_depth=3, rounds=6, learning_rate=0.3, row_share=1, column_share=1),
    BoostParams(max_depth=4, rounds=5, learning_rate=0.5, row_share=0.7, column_share=0.6, min_child_weight=1, seed=3),
    BoostParams(max_depth=1, rounds=4, min_child_weight=9)])
def test_equals_the_plain_version(spark, params):
    df = table(spark)
    (model,) = boosting.fit_models(df, NAMES, [params], "weight", bins=12)
    rows = df.selectExpr("*", "xxhash64(a, b, c, flag, cast(label as long), weight, false) as key").collect()
    x = np.array([[r[c] for r in rows] for c in NAMES])
    y, w = np.array([r.label for r in rows]), np.array([r.weight for r in rows])
    key = np.array([r.key for r in rows]).view(np.uint64)
    want = plain_fit(x, y, w, key, model.layout, params)
    assert np.allclose(model.probabilities(x), want, atol=1e-6)
    got = {r.bar_id: (r.p_long, r.p_short, r.p_none) for r in model.transform(df).collect()}
    assert np.allclose([got[r.bar_id] for r in rows], want.T, atol=1e-6)


def same(a, b):
    return len(a.rounds) == len(b.rounds) and all(
        np.array_equal(getattr(s, f), getattr(t, f)) for s, t in zip(a.rounds, b.rounds) for f in ("feature", "split", "value"))


def test_blocks_and_order_do_not_matter(spark, monkeypatch):
    """One block in tasks, many blocks in passes: the same trees bit for bit, several models at once."""
    monkeypatch.setattr(boosting, "CHECKPOINT_PASSES", 5)
    df, val = table(spark), table(spark, 120, 8)
    models = [BoostParams(max_depth=3, rounds=4, learning_rate=0.3), BoostParams(max_depth=1, rounds=9),
              BoostParams(max_depth=2, rounds=6, row_share=0.5, seed=1)]
    whole = boosting.fit_models(df, NAMES, models, "weight", val, patience=2, bins=16)
    cut = boosting.fit_models(df.repartition(5), NAMES, models, "weight", val, patience=2, bins=16, block_rows=90)
    assert all(map(same, whole, cut))
    for params, model in zip(models, whole):  # and the same as alone
        assert same(model, boosting.fit_models(df, NAMES, [params], "weight", val, patience=2, bins=16)[0])


def requests_of(losses, rounds, patience):
    """Rounds fitted and kept when the holdout loss goes like this."""
    layout = boosting.Layout((np.array([1.0]),))
    grower = boosting.grow(BoostParams(max_depth=1, rounds=rounds), layout, 1.0, patience)
    asked, answer = 0, None
    try:
        request = next(grower)
        while True:
            asked += request.slots is not None
            before = request.round
            loss = losses[before - 1] if before else 9.0
            hist = None if request.slots is None else np.ones((2, request.n_slots, 2))
            request = grower.send((hist, (int(loss * 1000), 1)))
    except StopIteration as end:
        answer = end.value
    return asked, len(answer)


def test_training_ends_with_the_patience():
    slow = [1 - i / 1000 for i in range(200)]  # no round gains 1 %
    assert requests_of(slow, 200, 50) == (200, 200)
    assert requests_of([1.0, 0.9] + [0.95] * 49 + [0.8] + [0.9] * 100, 120, 50) == (103, 52)
    asked, kept = requests_of([1.0, 0.9] + [0.95] * 150, 150, 50)
    assert kept == 2 and asked == kept + 50 + 1  # the pass that shows the last loss begins a round
    assert requests_of([1.0] * 30, 30, None) == (30, 30)


def test_small_gains_do_not_end_training(spark, tmp_path):
    """A learning rate whose rounds gain less than 1 % each: all rounds are kept, as they help."""
    rng = random.Random(3)
    rows = [(i, i % 3, rng.gauss(4 * (i % 3), .7), rng.gauss(0, 1)) for i in range(240)]
    df = spark.createDataFrame(rows, "bar_id long, label int, a double, b double")
    train, val = df.where("bar_id % 4 <> 0"), df.where("bar_id % 4 = 0")
    model = training.fit_weighted(train, val, ["a", "b"], BoostParams(
        max_depth=2, rounds=8, learning_rate=0.002, column_share=1))
    assert len(model.rounds) == 8
    again = boosting.BoostedModel.load(model.save(str(tmp_path / "m")))
    assert same(model, again) and again.features == ("a", "b")


def test_gaps_constants_and_no_rows(spark):
    df = table(spark, 60)
    with pytest.raises(Exception, match="null or NaN in a"):
        boosting.fit_models(df.selectExpr("label", "if(bar_id = 7, null, a) as a"), ["a"], [BoostParams(rounds=1)])
    params = BoostParams(rounds=2)
    flat = df.selectExpr("bar_id", "label", "1.5D as a")
    (model,) = boosting.fit_models(flat, ["a"], [params])
    assert all((t.feature == -1).all() for t in model.rounds)
    (model,) = boosting.fit_models(df.where("false"), NAMES, [params])
    assert {(r.p_long, r.p_none) for r in model.transform(df).collect()} == {(1 / 3, 1 / 3)}


WAYS = [BoostParams(max_depth=3, rounds=4, learning_rate=0.3), BoostParams(max_depth=1, rounds=9, row_share=0.6),
        BoostParams(max_depth=5, rounds=12, row_share=0.5, column_share=0.6, min_child_weight=1, seed=1)]


def test_more_rows_than_a_block_need_no_job_per_pass(spark, monkeypatch):
    """Several blocks in a task per model: the same trees as one block."""
    def many_jobs(*_):
        raise AssertionError("a job per pass")

    monkeypatch.setattr(boosting, "_in_passes", many_jobs)
    df, val = table(spark), table(spark, 120, 8)
    whole = boosting.fit_models(df, NAMES, WAYS, "weight", val, patience=2, bins=16)
    cut = boosting.fit_models(df, NAMES, WAYS, "weight", val, patience=2, bins=16, block_rows=90)
    assert all(map(same, whole, cut))


def test_passes_send_splits_to_the_driver(spark, monkeypatch):
    """A job per pass: the driver gets a split per node, no histograms, and grows the same trees."""
    monkeypatch.setattr(boosting, "CHECKPOINT_PASSES", 2)
    df, val, sent = table(spark), table(spark, 120, 8), []
    run = boosting.run_growers

    def watched(growers, one_pass):
        def keep(requests):
            answer = one_pass(requests)
            sent.extend((found, requests[m].n_slots) for m, (found, _) in answer.items() if found is not None)
            return answer

        return run(growers, keep)

    whole = boosting.fit_models(df, NAMES, WAYS, "weight", val, patience=2, bins=16)
    monkeypatch.setattr(boosting, "run_growers", watched)
    cut = boosting.fit_models(df, NAMES, WAYS, "weight", val, patience=2, bins=16, block_rows=90, task_rows=0)
    assert all(map(same, whole, cut)) and sent
    assert all(sum(np.size(part) for part in found) == 6 * nodes for found, nodes in sent)


def test_shared_columns_add_up_to_every_bin():
    """Rare values share columns; with the most frequent bins refilled no value is lost."""
    rng = np.random.default_rng(4)
    bins = np.array([rng.integers(0, 9, 300), rng.random(300) < .1, rng.random(300) < .2, np.zeros(300),
                     np.where(rng.random(300) < .8, 2, rng.integers(0, 4, 300))], np.uint8)
    layout = boosting.Layout(tuple(np.arange(n, dtype=float) for n in (8, 1, 1, 0, 3)))
    row = {"rows": 300, "bins": bins.tobytes(), "label": rng.integers(0, 3, 300).astype(np.int8).tobytes(),
           "weight": np.ones(300).tobytes(), "key": np.arange(300).tobytes(), "holdout": np.zeros(300, bool).tobytes()}
    block, scale = boosting.Block(row, 5, [0]), 2.0**40
    request = boosting.Request(0, 0, BoostParams(row_share=1), scale, None, np.arange(3)[:, None], 3)
    got = boosting.measure(block, 0, request, layout)
    g, h, _ = block.terms[0]
    for k, term in enumerate((g, h)):
        for c in range(3):
            want = np.concatenate([np.bincount(bins[f], term[c], n) for f, n in enumerate(layout.sizes)])
            assert np.array_equal(got[k, c], want)


def test_flags_of_one_category_are_one_column():
    """Narrow features are counted by the combinations that occur; what no split may use needs no column."""
    rng = np.random.default_rng(5)
    kind, n = rng.integers(0, 40, 400), 42
    bins = np.array([*(kind == k for k in range(40)), rng.integers(0, 3, 400), rng.integers(0, 30, 400)], np.uint8)
    layout = boosting.Layout(tuple(np.arange(k, dtype=float) for k in (*[1] * 40, 2, 29)))
    row = {"rows": 400, "bins": bins.tobytes(), "label": rng.integers(0, 3, 400).astype(np.int8).tobytes(),
           "weight": np.ones(400).tobytes(), "key": np.arange(400).tobytes(), "holdout": np.zeros(400, bool).tobytes()}
    block = boosting.Block(row, n, [0])
    assert block.columns(layout).codes.shape == (400, 2)
    allowed = np.ones((3, n), bool)
    allowed[1, 41] = False
    request = boosting.Request(0, 0, BoostParams(row_share=1), 2.0**40, None, np.arange(3)[:, None], 3, allowed=allowed)
    got = boosting.measure(block, 0, request, layout)
    for k, term in enumerate(block.terms[0][:2]):
        for c in range(3):
            want = [np.bincount(bins[f], term[c], size) for f, size in enumerate(layout.sizes)]
            if c == 1:  # the sum of all rows is still there
                want[41] = np.eye(30)[0] * term[c].sum()
            assert np.array_equal(got[k, c], np.concatenate(want))
