import math

import pytest
from pyspark.sql import functions as F

from barsmith.config import LONG, NO_TRADE, SHORT, Asset
from barsmith.functions import money
from barsmith.operators import exits, trades
from barsmith.operators.ordered import RowOrder
from helpers import price_bars

FLAT = (100, 100.5, 99.5, 100)
BASE = 6021.25
OFFSETS = [
    (0, .5, -.25, .25), (0, .75, -.1, .5), (.5, 1.5, .4, 1), (1, 2.5, .9, 2),
    (2, 2.1, 1.9, 2.05), (2.05, 2.2, 2, 2.1), (2.1, 2.3, 2, 2.2),
] + [(2.2, 2.4, 2.1, 2.3)] * 3
CASES = {
    "rise": [tuple(BASE + x for x in row) for row in OFFSETS],
    "stop_first": [(100,) * 4, (100, 100.5, 96.5, 99)] + [(99, 99.5, 98.5, 99)] * 5,
    "stop_and_target": [(100,) * 4, FLAT, (100, 102.5, 96, 102.25)]
    + [(102, 102.5, 101.5, 102)] * 4,
    "nothing": [(100,) * 4] + [FLAT] * 5 + [(100, 101, 99.5, 100.75)],
    "exact_drawdown": [(100,) * 4, (100, 100.25, 97, 100)] + [(100, 100.25, 99.75, 100)] * 5,
    "last_bar": [(100,) * 4] + [FLAT] * 5 + [(100, 102.5, 99.5, 102)],
}
# long exit, short exit, long, short, clamped long/short, best long/short, last-hit bars
EXPECTED = {
    "rise": (3, 6, 100, -110, 100, -110, 125, 5, 6, 6),
    "stop_first": (1, 6, -50, 50, -150, 50, 25, 175, 1, 1),
    "stop_and_target": (2, 6, 112.5, -100, -150, -100, 125, 200, 6, 2),
    "nothing": (6, 6, 37.5, -37.5, 37.5, -37.5, 50, 25, 6, 6),
    "exact_drawdown": (1, 6, 0, 0, -150, 0, 12.5, 150, 1, 1),
    "last_bar": (6, 6, 100, -100, 100, -100, 125, 25, 6, 6),
}


@pytest.mark.parametrize("case", CASES)
def test_golden_exits(spark, case):
    bars = price_bars(spark, CASES[case])
    out = exits.max_excursion(exits.clamp(exits.simulate(bars)))
    last = exits.simulate(bars, last_hit=True).select(
        "bar_id", F.col("long_exit_bar").alias("ll"), F.col("short_exit_bar").alias("ls"))
    row = out.join(last, "bar_id").where("bar_id = 0").first()
    got = [row[c] for c in (
        "long_exit_bar", "short_exit_bar", "long_profit", "short_profit", "long_clamped",
        "short_clamped", "max_long_profit", "max_short_profit", "ll", "ls")]
    assert got == pytest.approx(EXPECTED[case], abs=1e-6)


def test_variants_fill_the_profit_columns(spark):
    bars = price_bars(spark, CASES["stop_and_target"])
    got = {
        v: [exits.profits(bars, variant=v).where("bar_id = 0").first()[c]
            for c in ("long_profit", "short_profit")]
        for v in exits.VARIANTS
    }
    assert got == {"base": [112.5, -100.0], "clamped": [-150.0, -100.0], "last_hit": [100.0, -112.5]}
    with pytest.raises(ValueError, match="Unknown variant"):
        exits.profits(bars, variant="other")


def test_only_window_bars_with_full_horizon_count(spark):
    prices = [FLAT] * 9
    out = exits.simulate(price_bars(spark, prices, in_window=[True] * 9))
    assert [r["bar_id"] for r in out.where("is_valid").collect()] == [0, 1, 2]
    assert out.where("not is_valid and (long_profit <> 0 or short_profit <> 0)").count() == 0


def test_day_change_ends_the_horizon(spark):
    bars = price_bars(spark, [FLAT] * 8, start="2025-07-20 23:59:40", in_window=[True] * 8)
    assert exits.simulate(bars).where("is_valid").count() == 0


def test_missing_high_is_no_stop(spark):
    prices = [FLAT] * 7
    bars = price_bars(spark, prices).withColumn(
        "High", F.when(F.col("bar_id") != 3, F.col("High")))
    row = exits.simulate(bars).where("bar_id = 0").first()
    assert row["short_exit_bar"] == 6 and row["short_profit"] == 0


@pytest.mark.parametrize("case, action, reason, at", [
    ("stop_and_target", LONG, "STOP_LOSS", 2), ("rise", LONG, "TARGET_PROFIT", 3),
    ("last_bar", LONG, "TARGET_PROFIT", 6), ("nothing", LONG, "HARD_EXIT", 6),
    ("nothing", NO_TRADE, "NO_TRADE", 6), ("stop_first", SHORT, "HARD_EXIT", 6),
])
def test_trade_reasons(spark, case, action, reason, at):
    scored = exits.simulate(price_bars(spark, CASES[case])).withColumn("predicted", F.lit(action))
    row = trades.trade_list(scored).first()
    assert (row["ExitReason"], row["ExitBar"]) == (reason, at)
    if action == NO_TRADE:
        assert row["BaseProfit"] == 0
    assert trades.signal_bars(scored).count() == 1


def test_rewards(spark):
    values = [30.01, 30, 20, 10.01, 10, 0, -50]
    want = [30.01, -2.747346, -20.300292, -149.7003, -150, -150, -150]
    df = spark.createDataFrame([(float(v),) for v in values], "p double")
    got = [r[0] for r in df.select(money.reward(F.col("p"), F.lit(150.0), 0.2)).collect()]
    assert got == pytest.approx(want, abs=1e-5)


def test_zero_other_side_gives_own_profit(spark):
    df = spark.createDataFrame([(40.0, 0.0), (40.0, -20.0)], "a double, b double")
    got = [r[0] for r in df.select(money.profit_ratio(F.col("a"), F.col("b"))).collect()]
    assert got == [40.0, 2.0]


def test_decision_ties(spark):
    rows = [(0.4, 0.4, 0.2), (0.4, 0.2, 0.4), (0.5, 0.3, 0.2), (0.2, 0.5, 0.3), (0.3, 0.29, 0.28)]
    df = spark.createDataFrame(rows, "l double, s double, n double")
    cols = [F.col(c) for c in "lsn"]
    got = df.select(money.blended_action(*cols), money.threshold_action(*cols)).collect()
    assert [tuple(r) for r in got] == [
        (SHORT, NO_TRADE), (NO_TRADE, NO_TRADE), (LONG, LONG), (SHORT, SHORT), (LONG, NO_TRADE)]


def test_asset_parameters_change_the_value(spark):
    bars = price_bars(spark, CASES["rise"])
    asset = Asset(price_per_point=5.0)
    row = exits.simulate(bars, money.Rules.of(asset)).where("bar_id = 0").first()
    assert row["long_exit_bar"] == 6
    assert math.isclose(row["long_profit"], 2.2 * 5, abs_tol=1e-6)


def test_one_exchange_for_the_whole_simulation(spark):
    """Leads of six bars and both sides need one shuffle, no join and no Python."""
    bars = price_bars(spark, CASES["rise"])
    order = RowOrder(("symbol", "trading_day"), ("Date", "bar_id"))
    plan = exits.max_excursion(exits.clamp(exits.simulate(bars, order=order)))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange") == 1 and "Join" not in text and "Python" not in text
