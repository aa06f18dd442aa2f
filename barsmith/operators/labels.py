"""Rewards, candidates, scores and the selection of the best share per side."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barsmith.config import DEFAULT_LABELS, LONG, NO_TRADE, SHORT, Asset, LabelRule
from barsmith.functions import money
from barsmith.operators.ordered import MAX_GROUP_ROWS, ordered_columns, plan_order
from barsmith.session import materialize

GROUP = ("symbol", "split", "side")


def add_rewards(df: DataFrame, penalty: float = Asset.maximum_drawdown,
                decay: float = DEFAULT_LABELS.decay) -> DataFrame:
    lp, sp, pen = F.col("long_profit"), F.col("short_profit"), F.lit(penalty)
    return df.withColumns({
        "long_reward": money.reward(lp, pen, decay),
        "short_reward": money.reward(sp, pen, decay),
        "long_ratio": money.profit_ratio(lp, sp),
        "short_ratio": money.profit_ratio(sp, lp),
    })


def add_candidates(df: DataFrame, rule: LabelRule = DEFAULT_LABELS) -> DataFrame:
    """Add ``side`` (0, 1 or null) and ``score``; a bar is a candidate of one side at most."""
    def qualifies(own: str, other: str):
        return (
            (F.col(f"{own}_profit") > rule.min_profit)
            & (F.col(f"{own}_reward") > 0)
            & (F.col(f"{own}_profit") > F.col(f"{other}_profit"))
        )

    def score(own: str):
        by_profit, by_reward, by_ratio = rule.weights
        return (
            F.col(f"{own}_profit") * by_profit
            + F.col(f"{own}_reward") * by_reward
            + F.col(f"{own}_ratio") * by_ratio
        )

    is_long, is_short = qualifies("long", "short"), qualifies("short", "long")
    return df.withColumns({
        "side": F.when(is_long, LONG).when(is_short, SHORT),
        "score": F.when(is_long, score("long")).when(is_short, score("short")),
    })


def candidate_stats(candidates: DataFrame) -> DataFrame:
    """Counts per split and their share of all bars; one aggregation."""
    counted = candidates.groupBy("split").agg(
        F.count(F.lit(1)).alias("bars"),
        F.count_if(F.col("side") == LONG).alias("n_long"),
        F.count_if(F.col("side") == SHORT).alias("n_short"),
    )
    share = {
        "long_ratio_data": F.col("n_long") / F.col("bars"),
        "short_ratio_data": F.col("n_short") / F.col("bars"),
        "total_trade_ratio": (F.col("n_long") + F.col("n_short")) / F.col("bars"),
    }
    return counted.withColumns(share)


def select_labels(candidates: DataFrame, rule: LabelRule = DEFAULT_LABELS,
                  max_group_rows: int = MAX_GROUP_ROWS) -> DataFrame:
    """Label the best share of each side per symbol and split; every other bar is No-Trade.

    Ranks are exact. A side of a split can hold most of the table, so ranking goes through
    ``ordered_columns``, which cuts large groups by score. The scored bars are written to the
    shared folder first: sizing, cutting and ranking read them instead of the simulation.
    """
    keyed = materialize(candidates.withColumn("worst_first", -F.col("score")), "candidates")
    traded = keyed.where(F.col("side").isNotNull())
    order = plan_order(traded, GROUP, ("worst_first", "Date", "bar_id"), max_group_rows)
    ranked = ordered_columns(traded, order, {}, position="rank", total="available")
    fraction = F.when(F.col("side") == LONG, rule.long_fraction).otherwise(rule.short_fraction)
    label = F.when(
        F.col("rank") <= F.floor(fraction * F.col("available")), F.col("side")
    ).otherwise(NO_TRADE)
    rest = keyed.where(F.col("side").isNull()).withColumns({
        "rank": F.lit(None).cast("long"), "label": F.lit(NO_TRADE),
    })
    return (
        ranked.withColumn("label", label).drop("available")
        .unionByName(rest).drop("worst_first")
    )


def label_counts(labels: DataFrame) -> DataFrame:
    return labels.groupBy("split", "label").agg(F.count(F.lit(1)).alias("bars"))
