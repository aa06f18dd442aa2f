"""Boosting whose tasks keep their rows in one stage and exchange sums; rows that go down a tree."""

import os
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pytest
from pyspark import RDD
from test_boosting import NAMES, WAYS, same, table

from barsmith.operators import boosting
from barsmith.operators.boosting import BoostParams


def many_jobs(*_):
    raise AssertionError("a job per pass")


def test_many_rows_need_no_job_per_pass(spark, monkeypatch):
    """More rows than a task takes: the trees of one block, several models, weights and an early end."""
    monkeypatch.setattr(boosting, "GROUP_ROWS", 0, raising=False)
    df, val = table(spark), table(spark, 120, 8)
    whole = boosting.fit_models(df, NAMES, WAYS, "weight", val, patience=2, bins=16)
    monkeypatch.setattr(boosting, "_in_passes", many_jobs)
    monkeypatch.setattr(boosting, "_in_tasks", many_jobs)
    cut = boosting.fit_models(df, NAMES, WAYS, "weight", val, patience=2, bins=16, block_rows=90, task_rows=0)
    assert all(map(same, whole, cut))
    few = boosting.fit_models(df, NAMES, WAYS, "weight", val, patience=2, bins=16, block_rows=300, task_rows=0)
    assert all(map(same, whole, few))  # tasks without rows take part


def test_files_of_a_stage_are_removed(spark, monkeypatch, tmp_path):
    monkeypatch.setattr(boosting, "GROUP_ROWS", 0)
    monkeypatch.setattr(boosting, "scratch", lambda spark, name: f"{tmp_path}/{name}")
    boosting.fit_models(table(spark), NAMES, [BoostParams(rounds=2)], block_rows=90, task_rows=0)
    assert os.listdir(tmp_path) == []


@pytest.mark.parametrize("name, value", [("_group_tasks", lambda spark: 0), ("_in_group", lambda *_: None)])
def test_else_a_pass_is_a_job(spark, monkeypatch, name, value):
    """Executors that come and go, or tasks that do not see each other's files."""
    monkeypatch.setattr(boosting, "GROUP_ROWS", 0)
    whole = boosting.fit_models(table(spark), NAMES, WAYS[:1], bins=16)
    monkeypatch.setattr(boosting, name, value)
    cut = boosting.fit_models(table(spark), NAMES, WAYS[:1], bins=16, block_rows=90, task_rows=0)
    assert all(map(same, whole, cut))


def test_more_tasks_than_can_run_take_passes(spark, monkeypatch):
    """A session that deals keys to more partitions than asked for: no barrier stage that waits for ever."""
    monkeypatch.setattr(boosting, "GROUP_ROWS", 0)
    whole = boosting.fit_models(table(spark), NAMES, WAYS[:1], bins=16)
    deal = RDD.partitionBy
    monkeypatch.setattr(RDD, "partitionBy", lambda self, n, *more: deal(self, max(n, 31), *more))
    cut = boosting.fit_models(table(spark), NAMES, WAYS[:1], bins=16, block_rows=90, task_rows=0)
    assert all(map(same, whole, cut))


def test_too_many_rows_for_the_tasks_take_passes(spark, monkeypatch):
    monkeypatch.setattr(boosting, "GROUP_ROWS", 0)
    monkeypatch.setattr(boosting, "GROUP_BYTES", 1)
    monkeypatch.setattr(boosting, "_in_group", many_jobs)
    boosting.fit_models(table(spark, 100), NAMES, [BoostParams(rounds=1)], task_rows=0)


def test_an_exchange_keeps_turns_apart(tmp_path):
    """Every task hears all others in order, and only the last turn's files stay."""
    def talk(place):
        exchange = boosting.Exchange(str(tmp_path), place, 3)
        return [exchange((place, turn)) for turn in range(40)]

    with ThreadPoolExecutor(3) as pool:
        heard = list(pool.map(talk, range(3)))
    assert heard == [[[(p, turn) for p in range(3)] for turn in range(40)]] * 3
    assert sorted(os.listdir(tmp_path)) == ["39-0", "39-1", "39-2"]
    with pytest.raises(TimeoutError):
        boosting.Exchange(str(tmp_path / "other"), 0, 2)(None, seconds=0.05)


@pytest.mark.parametrize("depth", [1, 4, 8])
def test_both_ways_down_a_tree(monkeypatch, depth):
    """Comparing columns node by node and looking up each row's node end on the same leaves."""
    rng, trees, n = np.random.default_rng(depth), boosting.Trees.empty(depth), 3000
    inner = (1 << depth) - 1
    trees.feature[:, :inner] = rng.integers(-1, 5, (3, inner))
    trees.split[:, :inner] = rng.integers(0, 12, (3, inner))
    bins = rng.integers(0, 14, (5, n)).astype(np.uint8)
    for c in range(3):
        want = []
        for row in bins.T:
            i = 0
            while trees.feature[c, i] >= 0:
                i = 2 * i + 1 + (row[trees.feature[c, i]] > trees.split[c, i])
            want.append(i)
        for nodes, rows in ((0, 1), (1000, 1), (48, 256)):
            monkeypatch.setattr(boosting, "SCANNED", nodes)
            monkeypatch.setattr(boosting, "SCANNED_ROWS", rows)
            assert np.array_equal(boosting._leaves(bins, trees, c), want)
