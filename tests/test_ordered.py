"""Sliced and whole groups must give the same neighbours and positions."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from barsmith.operators.ordered import MAX_GROUP_ROWS, RowOrder, ordered_columns, plan_order
from barsmith.plans import views
from conftest import SF

KEYS, BY = ("symbol", "day"), ("at", "id")


def table(spark, sizes, ties=1, seed=0):
    """Groups of the given sizes; ``ties`` consecutive rows share a time."""
    rng = random.Random(seed)
    rows, start = [], dt.datetime(2024, 1, 1)
    for g, size in enumerate(sizes):
        for i in range(size):
            at = start + dt.timedelta(seconds=i // ties)
            rows.append((f"s{g % 2}'x", dt.date(2024, 1, 1 + g % 28), at, len(rows), rng.random()))
    rng.shuffle(rows)
    return spark.createDataFrame(
        rows, "symbol string, day date, at timestamp_ntz, id long, v double").repartition(5)


def answers(df, order):
    columns = {
        "before": lambda w: F.lag("v", 1).over(w),
        "after1": lambda w: F.lead("v", 1).over(w),
        "after6": lambda w: F.lead("id", 6).over(w),
    }
    out = ordered_columns(df, order, columns, ahead=6, behind=1, position="pos", total="n")
    return sorted((tuple(r) for r in out.collect()), key=lambda r: [str(v) for v in r])


@pytest.mark.parametrize("sizes, ties, slices", [
    ([200], 1, 12),            # one group holds everything
    ([90, 2, 1, 60, 30], 1, 9),
    ([120, 5], 1000, 8),       # all rows of a group at one time
    ([3] * 25, 1, 10),         # many groups smaller than a slice
    ([40], 1, 39),             # slices shorter than the horizon
])
def test_sliced_equals_whole(spark, sizes, ties, slices):
    df = table(spark, sizes, ties)
    whole = RowOrder(KEYS, BY)
    sliced = plan_order(df, KEYS, BY, max_group_rows=0, slices=slices)
    assert sliced.sliced
    assert answers(df, sliced) == answers(df, whole)


@pytest.mark.parametrize("column", ["symbol", "day", "at"])
def test_nulls_stay_in_both_plans(spark, column):
    df = table(spark, [90, 40, 3], ties=2).withColumn(
        column, F.expr(f"if(id % 3 = 0, null, {column})"))
    sliced = plan_order(df, KEYS, BY, max_group_rows=10, slices=12)
    assert sliced.sliced
    got = answers(df, sliced)
    key = lambda r: [str(v) for v in r]
    assert sorted(got, key=key) == sorted(answers(df, RowOrder(KEYS, BY)), key=key) and len(got) == 133


def test_a_null_group_is_split(spark):
    df = table(spark, [100]).withColumn("symbol", F.lit(None).cast("string"))
    order = plan_order(df, KEYS, BY, max_group_rows=10, slices=5)
    assert order.sliced and df.select(order.slice_column().alias("s")).distinct().count() >= 4


def test_group_size_decides(spark):
    df = table(spark, [30, 10])
    assert not plan_order(df, KEYS, BY, max_group_rows=30).sliced
    assert plan_order(df, KEYS, BY, max_group_rows=29, slices=4).sliced
    assert MAX_GROUP_ROWS > 17_280  # a full day of five-second bars stays whole


def test_slices_are_balanced_under_skew(spark):
    df = table(spark, [600] + [10] * 20, ties=600)
    order = plan_order(df, KEYS, BY, max_group_rows=100, slices=8)
    parts = df.groupBy(*KEYS, order.slice_column().alias("s")).count().collect()
    hot = [r["count"] for r in parts if r["day"] == dt.date(2024, 1, 1) and r["count"] > 10]
    assert len(hot) >= 7 and max(hot) < 3 * 600 / 8
    assert {c[1] for c in order.cuts} == {dt.date(2024, 1, 1)}  # only the large group is cut


def test_cut_points_are_literals_without_python(spark):
    df = table(spark, [100])
    order = plan_order(df, KEYS, BY, max_group_rows=10, slices=4)
    out = ordered_columns(df, order, {"x": lambda w: F.lead("v", 1).over(w)}, ahead=1)
    text = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in text and "WindowGroupLimit" in text


def test_derived_bars_do_not_depend_on_slicing(spark):
    """The fixture itself is numbered the same way when days are cut."""
    whole, cut = (views.bars(spark, SF, max_group_rows=m) for m in (10**9, 5))
    assert sorted(map(tuple, cut.collect())) == sorted(map(tuple, whole.collect()))
