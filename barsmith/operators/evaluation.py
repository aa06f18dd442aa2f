"""Ensemble scores, decisions, classification metrics and trading metrics.

Every report is one conditional aggregation with a fixed number of result rows, so empty
classes and sides appear with zeros and nothing is joined.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barsmith.config import LONG, NO_TRADE, SHORT, SIGNAL_NAMES, Asset
from barsmith.functions import money

CLASSES = (LONG, SHORT, NO_TRADE)
BOOST_WEIGHT, FOREST_WEIGHT = 0.7, 0.3
PROBABILITIES = ("p_long", "p_short", "p_none")


def blend(df: DataFrame, first: str = "boost", second: str = "forest") -> DataFrame:
    """Weighted mean of two models' probabilities and the decision it leads to."""
    mixed = df.withColumns({
        p: F.lit(BOOST_WEIGHT) * F.col(f"{first}_{p}") + F.lit(FOREST_WEIGHT) * F.col(f"{second}_{p}")
        for p in PROBABILITIES
    })
    return mixed.withColumn("predicted", money.blended_action(*map(F.col, PROBABILITIES)))


def threshold_rule(df: DataFrame, floor: float = 0.3) -> DataFrame:
    return df.withColumn("predicted", money.threshold_action(*map(F.col, PROBABILITIES), floor))


def result_rows(labelled: DataFrame, scores: DataFrame, model: str = "Model",
                features: tuple[str, ...] = (), penalty: float = Asset.maximum_drawdown,
                decay: float = 0.2) -> DataFrame:
    """Per scored bar: names, probabilities, profits, reward of the true side, hit flag."""
    joined = labelled.join(scores.select("bar_id", *PROBABILITIES, "predicted"), "bar_id")
    label, lp, sp = F.col("label"), F.col("long_profit"), F.col("short_profit")
    return joined.select(
        "Date",
        "bar_id",
        money.name_of(label, SIGNAL_NAMES, "Unknown").alias("Actual_Signal"),
        money.name_of(F.col("predicted"), SIGNAL_NAMES, "Unknown").alias("Predicted_Signal"),
        F.col("p_long").alias("Long_Probability"),
        F.col("p_short").alias("Short_Probability"),
        F.col("p_none").alias("NoTrade_Probability"),
        lp.alias("Long_Profit"),
        sp.alias("Short_Profit"),
        F.when(label == LONG, lp).when(label == SHORT, sp).otherwise(F.lit(0.0))
        .alias("Actual_Profit"),
        money.reward_of(label, lp, sp, F.lit(penalty), decay).alias("Actual_Reward"),
        (label == F.col("predicted")).alias("Correct_Prediction"),
        F.lit(model).alias("Model_Name"),
        *features,
    )


def signal_distribution(rows: DataFrame) -> DataFrame:
    """Count per signal name, as labelled and as predicted, and the share of hits."""
    counted = rows.groupBy("Actual_Signal", "Predicted_Signal").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("Correct_Prediction").alias("hits"))
    sides = F.array(
        F.struct(F.lit("actual").alias("kind"), F.col("Actual_Signal").alias("signal")),
        F.struct(F.lit("predicted").alias("kind"), F.col("Predicted_Signal").alias("signal")),
    )
    return (
        counted.select(F.inline(sides), "n", "hits")
        .groupBy("kind", "signal")
        .agg(F.sum("n").alias("bars"), F.sum("hits").alias("correct"))
    )


def _cell(actual: int, predicted: int) -> str:
    return f"c{actual}{predicted}"


def _cells(df: DataFrame) -> DataFrame:
    return df.agg(*[
        F.count_if((F.col("label") == a) & (F.col("predicted") == p)).alias(_cell(a, p))
        for a in CLASSES for p in CLASSES
    ])


def _rows(wide: DataFrame, heads: list[str], rows: list[list[Column]]) -> DataFrame:
    """A one-row table spread over a fixed list of rows."""
    structs = [F.struct(*[c.alias(h) for h, c in zip(heads, row)]) for row in rows]
    return wide.select(F.inline(F.array(*structs)))


def confusion(df: DataFrame) -> DataFrame:
    rows = [[F.lit(a), *[F.col(_cell(a, p)) for p in CLASSES]] for a in CLASSES]
    return _rows(_cells(df), ["actual", "pred_long", "pred_short", "pred_none"], rows)


def _sum(columns: list[Column]) -> Column:
    total = columns[0]
    for c in columns[1:]:
        total = total + c
    return total


def _share(part: Column, whole: Column) -> Column:
    return F.when(whole > 0, part / whole).otherwise(F.lit(0.0))


def class_detail(df: DataFrame) -> DataFrame:
    """Per class: cases, hits, misses by predicted class, and the overall counts."""
    cells = _cells(df)
    all_cells = _sum([F.col(_cell(a, p)) for a in CLASSES for p in CLASSES])
    all_hits = _sum([F.col(_cell(a, a)) for a in CLASSES])
    rows = []
    for a in CLASSES:
        total = _sum([F.col(_cell(a, p)) for p in CLASSES])
        hits = F.col(_cell(a, a))
        missed = [
            F.lit(0) if p == a else F.col(_cell(a, p)) for p in CLASSES
        ]
        rows.append([
            F.lit(a), total, hits, _share(hits, total) * 100.0,
            *[m.cast("long") for m in missed],
            *[_share(m, total) * 100.0 for m in missed],
            all_cells, all_hits, all_cells - all_hits, _share(all_hits, all_cells),
        ])
    heads = [
        "actual", "total", "correct", "correct_pct",
        "as_long", "as_short", "as_none", "as_long_pct", "as_short_pct", "as_none_pct",
        "all_cases", "all_correct", "all_missed", "overall_accuracy",
    ]
    return _rows(cells, heads, rows)


def precision_recall(df: DataFrame) -> DataFrame:
    """Precision, recall and F1 per class, 0 where undefined."""
    rows = []
    for c in CLASSES:
        hit = F.col(_cell(c, c))
        precision = _share(hit, _sum([F.col(_cell(a, c)) for a in CLASSES]))
        recall = _share(hit, _sum([F.col(_cell(c, p)) for p in CLASSES]))
        f1 = F.when(
            precision + recall > 0, F.lit(2.0) * (precision * recall) / (precision + recall)
        ).otherwise(F.lit(0.0))
        rows.append([F.lit(c), precision, recall, f1])
    return _rows(_cells(df), ["class", "precision", "recall", "f1"], rows)


def balanced_accuracy(df: DataFrame) -> DataFrame:
    """Accuracy, and the mean recall over the classes that occur."""
    recalls = [
        F.when(_total(c) > 0, F.col(_cell(c, c)) / _total(c)) for c in CLASSES
    ]
    present = _sum([F.when(_total(c) > 0, 1).otherwise(0) for c in CLASSES])
    sum_recall = _sum([F.coalesce(r, F.lit(0.0)) for r in recalls])
    hits = _sum([F.col(_cell(c, c)) for c in CLASSES])
    return _cells(df).select(
        _share(hits, _sum([_total(c) for c in CLASSES])).alias("accuracy"),
        _share(sum_recall, present).alias("balanced_accuracy"),
    )


def _total(label: int) -> Column:
    return _sum([F.col(_cell(label, p)) for p in CLASSES])


_SIDES = ((LONG, "long"), (SHORT, "short"))


def _trading(df: DataFrame, penalty: float, decay: float) -> DataFrame:
    aggregates = [
        F.count(F.lit(1)).alias("bars"),
        F.count_if(F.col("label") == F.col("predicted")).alias("hits"),
        F.count_if(F.col("predicted") == NO_TRADE).alias("n_none"),
    ]
    for code, side in _SIDES:
        taken = F.col("predicted") == code
        profit = F.col(f"{side}_profit")
        paid = F.when(taken, profit)
        rewarded = F.when(taken, money.reward(profit, F.lit(penalty), decay))
        aggregates += [
            F.count_if(taken & F.col("InWindow")).alias(f"trades_{side}"),
            F.count_if(taken).alias(f"n_{side}"),
            F.coalesce(F.sum(paid), F.lit(0.0)).alias(f"profit_{side}"),
            F.coalesce(F.avg(paid), F.lit(0.0)).alias(f"avg_profit_{side}"),
            F.coalesce(F.sum(rewarded), F.lit(0.0)).alias(f"reward_{side}"),
            F.coalesce(F.avg(rewarded), F.lit(0.0)).alias(f"avg_reward_{side}"),
            F.count_if(taken & (profit > 0)).alias(f"won_{side}"),
        ]
    return df.agg(*aggregates)


def _rate(side: str) -> Column:
    """Winning trades per trade in percent; the count is at least one to avoid 0 / 0."""
    return F.col(f"won_{side}") / F.greatest(F.col(f"trades_{side}"), F.lit(1)) * 100.0


def trading_performance(df: DataFrame, penalty: float = Asset.maximum_drawdown,
                        decay: float = 0.2) -> DataFrame:
    """Per predicted side: trades, profit, reward, winning share, share of bars."""
    heads = [
        "side", "trades", "total_profit", "avg_profit", "total_reward", "avg_reward",
        "profitable", "profitable_rate", "pct_of_bars", "action_pct", "none_pct", "all_profit",
        "accuracy",
    ]
    rows = [[
        F.lit(side.upper()), F.col(f"trades_{side}"),
        F.col(f"profit_{side}"), F.col(f"avg_profit_{side}"),
        F.col(f"reward_{side}"), F.col(f"avg_reward_{side}"),
        F.col(f"won_{side}"), _rate(side),
        _share(F.col(f"trades_{side}"), F.col("bars")) * 100.0,
        _share(F.col(f"n_{side}"), F.col("bars")) * 100.0,
        _share(F.col("n_none"), F.col("bars")) * 100.0,
        F.col("profit_long") + F.col("profit_short"),
        _share(F.col("hits"), F.col("bars")),
    ] for _, side in _SIDES]
    return _rows(_trading(df, penalty, decay), heads, rows)


def summary(df: DataFrame, model: str = "Model", penalty: float = Asset.maximum_drawdown,
            decay: float = 0.2) -> DataFrame:
    """One row with the figures used to compare models."""
    return _trading(df, penalty, decay).select(
        F.lit(model).alias("model_name"),
        _share(F.col("hits"), F.col("bars")).alias("overall_accuracy"),
        (F.col("profit_long") + F.col("profit_short")).alias("total_profit"),
        F.col("trades_long").alias("long_trades"),
        F.col("trades_short").alias("short_trades"),
        F.col("avg_profit_long").alias("avg_long_profit"),
        F.col("avg_profit_short").alias("avg_short_profit"),
        _rate("long").alias("profitable_long_rate"),
        _rate("short").alias("profitable_short_rate"),
    )
