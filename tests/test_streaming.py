import datetime as dt

import pytest
from pyspark.sql import functions as F

from barsmith.config import INPUT_FEATURES, LONG, SHORT
from barsmith.operators import clean, exits, features, trades
from barsmith.plans import views
from barsmith.streaming import jobs, stateful
from conftest import SF
from helpers import full_bars, price_bars


def cut(df, *moments):
    """Parts of a table arriving one after the other."""
    ends = [None, *moments, None]
    parts = []
    for lo, hi in zip(ends, ends[1:]):
        part = df
        if lo:
            part = part.where(F.col("Date") >= F.lit(lo).cast("timestamp_ntz"))
        if hi:
            part = part.where(F.col("Date") < F.lit(hi).cast("timestamp_ntz"))
        parts.append(part)
    return parts


def test_lag_over_three_arrivals_equals_batch(spark):
    bars = clean.keep_window(views.bars(spark, SF))
    parts = cut(bars, "2024-01-10 08:35:30", "2024-01-10 08:36:00")
    names = ["bar_id", *[f"{c}_lag1" for c in INPUT_FEATURES]]
    got = jobs.replay(parts, stateful.lag_stream)
    assert got.where("late").count() == 0
    want = features.add_lags(bars).select(*names)
    assert sorted(map(tuple, got.select(*names).collect())) == sorted(map(tuple, want.collect()))


def test_late_bar_is_reported_and_changes_nothing(spark):
    rows = [{"Date": f"2025-07-01 09:00:{s:02}", "Open": float(s)} for s in (0, 5, 10, 15)]
    bars = full_bars(spark, rows)
    arrivals = [bars.where("bar_id in (0, 2)"), bars.where("bar_id in (1, 3)")]
    got = {r["bar_id"]: r for r in jobs.replay(arrivals, stateful.lag_stream).collect()}
    assert [got[i]["late"] for i in range(4)] == [False, True, False, False]
    assert got[1]["Open_lag1"] is None and got[3]["Open_lag1"] == 10.0


def decisions(spark):
    # Strong moves, so that stops, targets and hard exits occur.
    prices = [(100 + (i * 7 % 5) / 2, 102.5 + i % 3, 97.5 - i % 2, 100 + (i * 3 % 7) / 2) for i in range(20)]
    bars = price_bars(spark, prices, in_window=[i < 16 for i in range(20)])
    return bars.withColumn("predicted", (F.col("bar_id") % 3).cast("int"))


@pytest.mark.parametrize("cuts", [[], [9], [3, 4, 11]])
def test_exit_stream_equals_the_trade_list(spark, cuts):
    df = decisions(spark)
    first = dt.datetime(2025, 7, 20, 9, 12, 40)
    parts = cut(df, *[str(first + dt.timedelta(seconds=5 * c)) for c in cuts])
    want = trades.trade_list(exits.simulate(df))
    got = jobs.replay(parts, stateful.exit_stream)
    assert got.where("late").count() == 0
    assert sorted(map(tuple, got.select(*want.columns).collect())) == sorted(
        map(tuple, want.collect()))
    assert {r["ExitReason"] for r in want.collect()} >= {"STOP_LOSS", "NO_TRADE"}


def test_early_reports_come_with_the_hit_and_once(spark):
    df = decisions(spark)
    parts = cut(df, "2025-07-20 09:13:00")
    early = jobs.replay(parts, lambda s: stateful.exit_stream(s, wait_for_horizon=False))
    rows = {r["bar_id"]: r for r in early.collect()}
    assert len(rows) == early.count()
    confirmed = {r["bar_id"]: r for r in trades.trade_list(exits.simulate(df)).collect()}
    assert set(confirmed) <= set(rows)
    for i, want in confirmed.items():
        assert (rows[i]["ExitBar"], rows[i]["ExitReason"]) == (want["ExitBar"], want["ExitReason"])


def test_day_change_cancels_open_trades(spark):
    bars = price_bars(spark, [(100, 100.1, 99.9, 100)] * 10, start="2025-07-20 23:59:40",
                      in_window=[True] * 10)
    df = bars.withColumn("predicted", F.when(F.col("bar_id") % 2 == 0, LONG).otherwise(SHORT))
    assert jobs.replay([df], stateful.exit_stream).count() == 0
