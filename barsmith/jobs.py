"""The whole jobs: feature table, scaler, training with evaluation, and exit scoring."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barsmith.config import DEFAULT_LABELS, Asset, LabelRule
from barsmith.functions.money import Rules
from barsmith.operators import (
    balance, clean, evaluation, exit_scores, exits, features, labels, scaler, splits, trades,
    training,
)
from barsmith.operators.scaler import ScalerModel
from barsmith.session import configure, materialize
from barsmith.sources import readers, registry, writers


def prepare_bars(spark: SparkSession, path: str, fmt: str = "csv", symbol: str = "ES") -> DataFrame:
    """Raw bars, read and cleaned. Keys made for files without them hold for the same files."""
    text = fmt in ("csv", "json")
    raw = readers.read_raw_bars(configure(spark), readers.require_path(spark, path), fmt, symbol, text)
    if text:
        return clean.clean_bars(raw)
    dated = clean.keep_bar_marks(clean.drop_undated(raw))
    return clean.add_trading_day(clean.flag_window(dated))


def build_features(spark: SparkSession, bars: DataFrame, output: str, fmt: str = "csv") -> str:
    """The 333-column feature table of the bars in the trading window."""
    order = features.day_order(bars)
    table = features.feature_table(clean.keep_window(bars), order=order)
    return writers.write_table(features.check_width(table), output, fmt)


def build_scaler(spark: SparkSession, bars: DataFrame, output: str) -> ScalerModel:
    """Fit on de-duplicated, padded bars of all hours, and save."""
    distinct = clean.drop_identical(bars.drop("bar_id"))
    model = scaler.fit(scaler.pad_extremes(distinct))
    writers.save_scaler(model, spark, output)
    return model


@dataclass(frozen=True)
class TrainingResult:
    boosted: training.BoostedModel
    forest: PipelineModel | training.ForestModel
    rows: DataFrame
    summary: DataFrame
    trades: DataFrame
    signal_bars: DataFrame
    balanced: bool


def train(spark: SparkSession, bars: DataFrame, fitted: ScalerModel, cutoff: str,
          selection: list[str], asset: Asset = Asset(), rule: LabelRule = DEFAULT_LABELS,
          variant: str = "base",
          boost: training.BoostParams = training.BoostParams(),
          forest: training.ForestParams = training.ForestParams()) -> TrainingResult:
    """Exits, labels, balancing, two models, evaluation and trades of the test part.

    Only bars in the trading window take part, also as horizon of other bars. ``selection`` lists
    the features of the models, ``variant`` chooses the profits that labels and evaluation use.
    """
    configure(spark)
    window = materialize(clean.keep_window(bars), "window-bars")
    order = features.day_order(window)
    rules = Rules.of(asset)
    split = splits.add_split(window, cutoff)
    valid = exits.profits(split, rules, order, variant).where("is_valid").select(
        "bar_id", "symbol", "Date", "InWindow", "split", "long_profit", "short_profit")
    rewarded = labels.add_rewards(valid, asset.maximum_drawdown, rule.decay)
    truth = labels.select_labels(labels.add_candidates(rewarded, rule), rule)

    table = features.feature_table(window, keep=("bar_id",), order=order)
    names = features.require_features(table, selection)
    scaled = fitted.transform(table.select("bar_id", *names))
    ready = materialize(scaled.join(truth, "bar_id"), "model-table")
    parts = {s: ready.where(F.col("split") == s) for s in ("train", "val", "test")}

    result = balance.oversample(parts["train"], names)
    balanced = materialize(result.rows, "balanced")
    boosted = training.fit_boosted(balanced, names, boost)
    forest_model = training.fit_forest(balanced, names, forest)
    scored = materialize(training.score_ensemble(parts["test"], boosted, forest_model), "scored")

    # Days from the cutoff on are whole, so their trades need no earlier day.
    tested = window.where(F.col("trading_day") >= F.lit(cutoff).cast("timestamp_ntz").cast("date"))
    decided = exits.simulate(tested, rules, order).join(
        scored.select("bar_id", "predicted"), "bar_id")
    rows = evaluation.result_rows(
        scored.drop(*evaluation.PROBABILITIES, "predicted"), scored, features=tuple(names),
        penalty=asset.maximum_drawdown, decay=rule.decay)
    return TrainingResult(
        boosted, forest_model, rows,
        evaluation.summary(scored, penalty=asset.maximum_drawdown, decay=rule.decay),
        trades.trade_list(decided, rules), trades.signal_bars(decided), result.applied)


def save(result: TrainingResult, folder: str, symbol: str = "ES") -> dict[str, str]:
    """Models, evaluation rows and both exports below one folder."""
    base = folder.rstrip("/")
    ohlc, listed = writers.write_exports(result.signal_bars, result.trades, base, symbol)
    return {
        "boosted": result.boosted.save(f"{base}/{symbol}_boosted"),
        "forest": writers.save_model(result.forest, f"{base}/{symbol}_forest"),
        "results": writers.write_results(result.rows, base, "Model"),
        "ohlc": ohlc,
        "trades": listed,
    }


def score_exits(requests: DataFrame, snapshots: DataFrame, class_map: DataFrame, model_folder: str,
                predictors: list[str]) -> DataFrame:
    """Red / yellow / green of every request, by the model saved for its key.

    A request without snapshot or model gets zeros and the reason.
    """
    models = registry.load_models(requests.sparkSession, model_folder)

    def scorer(model: PipelineModel | training.ForestModel):
        def score(df: DataFrame) -> DataFrame:
            p = evaluation.PROBABILITIES
            return training.forest_probabilities(model, df).withColumn(
                "probabilities", F.array(*p)).drop(*p)
        return score

    matched = exit_scores.match_requests(requests, snapshots, predictors)
    routed = training.route(
        matched, {k: scorer(m) for k, m in models.items()}, exit_scores.TRADE_KEY)
    return exit_scores.map_classes(routed, class_map)
