"""Trade list and signal bars of scored bars."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barsmith.config import HORIZON, LONG, SHORT, TRADE_NAMES, Asset
from barsmith.functions import money
from barsmith.functions.money import Rules
from barsmith.operators.exits import STEPS, bar, entry_price, stop_hit, target_hit


def signal_bars(scored: DataFrame) -> DataFrame:
    """Prices of every signal bar that six later bars follow."""
    return scored.where(F.col("is_valid")).select(
        "bar_id", F.col("Date").alias("Datetime"), "Open", "High", "Low", "Close"
    )


def _outcome(rules: Rules, long: bool) -> Column:
    """Exit bar and reason; in one bar the stop counts before the target."""
    steps = []
    for j in STEPS:
        for hit, reason in ((stop_hit, "STOP_LOSS"), (target_hit, "TARGET_PROFIT")):
            steps.append(F.when(hit(rules, long, j), _end(j, reason)))
    return F.coalesce(*steps, _end(HORIZON, "HARD_EXIT"))


def _end(j: int, reason: str) -> Column:
    end = bar(j, "Date"), bar(j, "Close")
    return F.struct(
        F.lit(j).alias("bar"), F.lit(reason).alias("reason"),
        end[0].alias("at"), end[1].alias("price"),
    )


def trade_list(scored: DataFrame, rules: Rules | None = None) -> DataFrame:
    """One row per signal bar: entry at the next open, exit, reason and base profit.

    ``scored`` comes from ``exits.simulate`` (horizon bars) with a ``predicted`` column.
    """
    rules = rules or Rules.of(Asset())
    action = F.col("predicted")
    end = (
        F.when(action == LONG, _outcome(rules, True))
        .when(action == SHORT, _outcome(rules, False))
        .otherwise(_end(HORIZON, "NO_TRADE"))
    )
    ended = scored.where(F.col("is_valid")).withColumn("end", end)
    exit_price, entry = F.col("end.price"), entry_price()
    profit = (
        F.when(action == LONG, (exit_price - entry) * rules.per_point)
        .when(action == SHORT, (entry - exit_price) * rules.per_point)
        .otherwise(F.lit(0.0))
    )
    return ended.select(
        "bar_id",
        money.name_of(action, TRADE_NAMES, "NO_TRADE").alias("Trade_Signal"),
        bar(1, "Date").alias("EntryDateTime"),
        entry.alias("EntryPrice"),
        F.col("end.at").alias("ExitDateTime"),
        exit_price.alias("ExitPrice"),
        profit.alias("BaseProfit"),
        F.col("end.bar").alias("ExitBar"),
        F.col("end.reason").alias("ExitReason"),
    )


def trade_distribution(trades: DataFrame) -> DataFrame:
    return trades.groupBy("Trade_Signal").agg(F.count(F.lit(1)).alias("trades"))


def export_totals(bars: DataFrame, trades: DataFrame) -> DataFrame:
    """Rows of both exports, one row per export."""
    totals = [
        df.agg(F.count(F.lit(1)).alias("records")).select(F.lit(name).alias("export"), "records")
        for name, df in (("ohlc", bars), ("trades", trades))
    ]
    return totals[0].unionByName(totals[1])
