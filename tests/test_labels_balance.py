import datetime as dt
import random

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from barsmith.config import DEFAULT_LABELS, LabelRule
from barsmith.operators import balance, labels, neighbours

SCHEMA = (
    "bar_id long, symbol string, split string, Date timestamp_ntz, long_profit double, "
    "short_profit double"
)


def profits(spark, pairs, split="train"):
    start = dt.datetime(2025, 7, 1, 9)
    return spark.createDataFrame([
        (i, "ES", split, start + dt.timedelta(seconds=5 * i), float(a), float(b))
        for i, (a, b) in enumerate(pairs)], SCHEMA)


def label_of(df, rule=DEFAULT_LABELS, **options):
    scored = labels.add_candidates(labels.add_rewards(df), rule)
    out = labels.select_labels(scored, rule, **options)
    return [r["label"] for r in out.orderBy("bar_id").collect()]


def test_earlier_bar_wins_a_tie_at_the_cut(spark):
    assert label_of(profits(spark, [(100, -50)] * 4)) == [0, 0, 0, 2]


def test_share_is_cut_down(spark):
    assert label_of(profits(spark, [(-50, 100), (0, 0)])) == [2, 2]  # int(0.5 * 1) = 0
    assert label_of(profits(spark, [(-50, 100), (-50, 90), (0, 0)])) == [1, 2, 2]


def test_candidates_need_profit_reward_and_the_better_side(spark):
    rule = LabelRule(long_fraction=1.0, short_fraction=1.0)
    assert label_of(profits(spark, [(30, 0), (31, 0), (40, 50), (60, 60)]), rule) == [2, 0, 1, 2]


def test_ranking_of_cut_groups_equals_whole_groups(spark):
    rng = random.Random(5)
    pairs = [(rng.choice([40, 60, 100]), rng.choice([-50, 0, 80])) for _ in range(300)]
    df = profits(spark, pairs)
    assert label_of(df, max_group_rows=5) == label_of(df)


def test_stats_of_a_split_without_candidates(spark):
    scored = labels.add_candidates(labels.add_rewards(profits(spark, [(0, 0)] * 3)))
    row = labels.candidate_stats(scored).first()
    assert (row["n_long"], row["n_short"], row["total_trade_ratio"]) == (0, 0, 0.0)


def squared(x, y):
    """Plain left-to-right sum; the built-in sum compensates rounding."""
    total = 0.0
    for a, b in zip(x, y):
        total += (a - b) * (a - b)
    return total


def brute(points, k):
    out = {}
    for g, i, x in points:
        near = sorted(
            (squared(x, y), j)
            for h, j, y in points if h == g and j != i)
        out[g, i] = [j for _, j in near[:k]]
    return out


def found(spark, points, k, **options):
    df = spark.createDataFrame(points, "label int, bar_id long, vector array<double>")
    out: dict = {}
    for r in neighbours.nearest(df, k, **options).orderBy("nn_rank").collect():
        out.setdefault((r["label"], r["bar_id"]), []).append(r["nn_id"])
    return out


@pytest.mark.parametrize("block, pivots", [(4096, None), (16, 7), (5, 20), (8, 1)])
def test_neighbours_equal_brute_force(spark, block, pivots):
    rng = np.random.default_rng(1)
    points = [(g, 1000 * g + i, rng.normal(size=3).round(1).tolist()) for g in (0, 2) for i in range(90)]
    # A third of a class are copies of one vector.
    points += [(0, 500 + i, [0.5, 0.5, 0.5]) for i in range(45)]
    assert found(spark, points, 3, block=block, pivots=pivots) == brute(points, 3)


@settings(max_examples=2, derandomize=True, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 4), st.integers(0, 4)), min_size=4, max_size=30),
       st.integers(1, 6))
def test_neighbours_on_a_grid_with_ties(spark, cells, pivots):
    points = [(0, i, [float(a), float(b)]) for i, (a, b) in enumerate(cells)]
    assert found(spark, points, 3, block=6, pivots=pivots) == brute(points, 3)


def classes(spark, sizes, seed=0):
    rng = random.Random(seed)
    rows = [(c, rng.gauss(c, 1), rng.gauss(-c, 1)) for c, n in sizes.items() for _ in range(n)]
    return spark.createDataFrame(
        [(i, *r) for i, r in enumerate(rows)], "bar_id long, label int, a double, b double")


def test_oversampling_fills_classes_on_segments(spark):
    df = classes(spark, {0: 40, 1: 11, 2: 23})
    result = balance.oversample(df, ["a", "b"])
    rows = result.rows.collect()
    assert result.applied
    assert balance.class_sizes(result.rows) == {0: 40, 1: 40, 2: 40}
    base = {r["bar_id"]: r for r in df.collect()}
    kept = sorted((r["bar_id"], r["label"], r["a"], r["b"]) for r in rows if not r["is_synthetic"])
    assert kept == sorted(tuple(r) for r in base.values())
    points = [(r["label"], r["bar_id"], [r["a"], r["b"]]) for r in base.values()]
    near = brute(points, 3)
    for r in (r for r in rows if r["is_synthetic"]):
        x = np.array([base[r["bar_id"]][c] for c in "ab"])
        got = np.array([r["a"], r["b"]])
        on = []
        for j in near[r["label"], r["bar_id"]]:
            step = np.array([base[j][c] for c in "ab"]) - x
            gap = (got - x) @ step / max(step @ step, 1e-300)
            on.append(-1e-9 <= gap <= 1 + 1e-9 and np.allclose(x + gap * step, got))
        assert any(on)


def test_oversampling_does_not_depend_on_partitioning(spark):
    df = classes(spark, {0: 30, 1: 9})
    a, b = (
        sorted(map(tuple, balance.oversample(d, ["a", "b"], block=bl, max_group_rows=m).rows.collect()))
        for d, bl, m in ((df.repartition(1), 4096, 10**6), (df.repartition(7), 4, 3)))
    assert a == b


def test_small_class_leaves_the_input_alone(spark):
    df = classes(spark, {0: 10, 1: 3})
    result = balance.oversample(df, ["a", "b"])
    assert not result.applied and result.rows.count() == 13


def test_class_weights(spark):
    df = classes(spark, {0: 6, 1: 3, 2: 1})
    weights = balance.class_weights(df)
    assert weights == {0: 10 / 18, 1: 10 / 9, 2: 10 / 3}
    total = balance.add_weights(df, weights).agg(F.sum("weight")).first()[0]
    assert total == pytest.approx(10)
