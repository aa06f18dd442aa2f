"""Every registered query: a function of the session and the folder of the given tables."""

from __future__ import annotations

import math
from collections.abc import Callable
from functools import reduce
from operator import and_

from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barsmith.config import (
    CATEGORICAL, CONTINUOUS, DEFAULT_LABELS, DOMAINS, INPUT_FEATURES, KEEP_ALL_LABELS, SCALED,
    TOP_TENTH_LABELS, LabelRule, feature_table_columns,
)
from barsmith.functions import dates, money
from barsmith.functions.money import Rules
from barsmith.operators import (
    balance, clean, evaluation, exit_scores, exits, features, labels, neighbours, scaler,
    splits, trades, training,
)
from barsmith.plans import views
from barsmith.session import materialize, scratch
from barsmith.sources import readers, writers
from barsmith.streaming import entry, jobs, stateful

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ARRIVAL_ROWS = 5_000_000


def register(query: Query) -> Query:
    """Register under the function's name; a closing underscore only avoids a module's name."""
    QUERIES[query.__name__.rstrip("_")] = query
    return query


def rounded(df: DataFrame, names: list[str], digits: int = 6) -> DataFrame:
    """Sums and exponentials differ in the last bits between engines; -0.0 becomes 0.0."""
    return df.withColumns({c: F.round(c, digits) + F.lit(0.0) for c in names})


def clock(name: str) -> Column:
    return F.date_format(name, "yyyy-MM-dd HH:mm:ss").alias(name)


# --- cleaning -----------------------------------------------------------------------------

@register
def clean_report(spark, folder):
    return clean.clean_report(clean.parse_dates(views.dated_text(spark, folder)))


@register
def date_format_choice(spark, folder):
    return clean.format_report(views.dated_text(spark, folder))


@register
def clean_bars(spark, folder):
    """The kept rows themselves, from text dates."""
    out = clean.clean_bars(views.dated_text(spark, folder))
    return out.select("event_id", clock("Date"), "InWindow",
                      dates.day_text(F.col("trading_day")).alias("trading_day"))


def _with_copies(spark, folder):
    bars = views.bars(spark, folder)
    return bars.unionAll(bars.where(F.col("bar_id") % 10 == 0))


@register
def dedup(spark, folder):
    out = clean.drop_identical(_with_copies(spark, folder))
    return out.select("bar_id", "symbol", *INPUT_FEATURES)


@register
def window_flag(spark, folder):
    bars = clean.add_trading_day(clean.flag_window(views.bars(spark, folder)))
    return bars.select(
        "bar_id", clock("Date"), dates.day_text(F.col("trading_day")).alias("trading_day"),
        "InWindow")


@register
def day_count(spark, folder):
    return clean.count_days(clean.keep_window(views.bars(spark, folder)))


@register
def project_continuous(spark, folder):
    return clean.project_continuous(views.bars(spark, folder))


# --- features and scaling -----------------------------------------------------------------

def _window_bars(spark, folder):
    return clean.keep_window(views.bars(spark, folder))


def _lagged(spark, folder) -> DataFrame:
    bars, order = views.ordered_bars(spark, folder)
    return features.add_lags(clean.keep_window(bars), order)


def _feature_table(spark, folder) -> DataFrame:
    bars, order = views.ordered_bars(spark, folder)
    return features.feature_table(clean.keep_window(bars), keep=("bar_id",), order=order)


@register
def lag_features(spark, folder):
    return _lagged(spark, folder).select("bar_id", *[f"{c}_lag1" for c in INPUT_FEATURES])


@register
def onehot(spark, folder):
    return _feature_table(spark, folder).withColumn("Date", clock("Date"))


@register
def minmax_profile(spark, folder):
    return scaler.profile(clean.project_continuous(clean.drop_identical(_with_copies(spark, folder))))


@register
def pad_extremes(spark, folder):
    return scaler.pad_extremes(views.bars(spark, folder))


@register
def scaler_fit(spark, folder):
    padded = scaler.pad_extremes(clean.drop_identical(_with_copies(spark, folder)))
    return rounded(scaler.fit(padded).to_frame(spark), ["mean", "std"])


def _fitted(bars):
    return scaler.fit(scaler.pad_extremes(bars))


@register
def scaler_apply(spark, folder):
    lagged = _lagged(spark, folder).select("bar_id", *SCALED)
    return rounded(_fitted(views.bars(spark, folder)).transform(lagged), SCALED, 4)


@register
def scaler_verify(spark, folder):
    bars = views.bars(spark, folder)
    report = scaler.verify(bars, _fitted(bars).transform(bars))
    return rounded(report, ["mean", "std_samp"], 5)


# --- exits and rewards --------------------------------------------------------------------

def _simulated(spark, folder, last_hit: bool = False):
    bars, order = views.ordered_bars(spark, folder)
    return exits.simulate(bars, order=order, last_hit=last_hit)


_EXITS = ("bar_id", "long_exit_bar", "short_exit_bar", "long_profit", "short_profit")


@register
def exit_profit(spark, folder):
    """Every bar; without a full horizon the exit bars are 0."""
    bars = {c: F.when(F.col("is_valid"), F.col(c)).otherwise(0) for c in _EXITS[1:3]}
    return _simulated(spark, folder).withColumns(bars).select(*_EXITS, "is_valid")


@register
def exit_profit_clamped(spark, folder):
    return exits.clamp(_simulated(spark, folder)).select("bar_id", "long_clamped", "short_clamped")


@register
def max_excursion(spark, folder):
    out = exits.max_excursion(exits.clamp(_simulated(spark, folder)))
    return out.select("bar_id", "max_long_profit", "max_short_profit")


@register
def exit_last_hit(spark, folder):
    return _simulated(spark, folder, last_hit=True).where("is_valid").select(*_EXITS)


@register
def reward(spark, folder):
    out = labels.add_rewards(_simulated(spark, folder).where("is_valid"))
    lp, sp = F.col("long_profit"), F.col("short_profit")
    none = money.reward_of(F.lit(2), lp, sp, F.lit(150.0), 0.2)
    return rounded(
        out.select("bar_id", "long_reward", "short_reward", none.alias("no_trade_reward")),
        ["long_reward", "short_reward"])


@register
def asset_join(spark, folder):
    """Five instruments, each with its own money value per point and tick size."""
    bars, order = views.ordered_bars_multi(spark, folder)
    priced = readers.join_assets(bars, views.assets(spark))
    out = exits.simulate(priced, Rules.joined(), order)
    return out.where("is_valid").select("symbol", *_EXITS)


# --- splits and labels --------------------------------------------------------------------

@register
def split_days(spark, folder):
    out = splits.split_counts(splits.add_split(_window_bars(spark, folder), views.CUTOFF))
    return out.select("split", "rows", clock("first_bar"))


@register
def valid_semi(spark, folder):
    bars = splits.add_split(_window_bars(spark, folder), views.CUTOFF)
    profits = _simulated(spark, folder).select("bar_id", "is_valid")
    return splits.keep_valid(bars, profits).select("bar_id", "split")


_LABEL_INPUT = (
    "bar_id", "symbol", "trading_day", "Date", "InWindow", "split", "long_profit", "short_profit",
)


def _candidates(spark, folder, rule: LabelRule = DEFAULT_LABELS):
    """Days are divided before the simulation, so finding them does not run it."""
    bars, order = views.ordered_bars(spark, folder)
    split = splits.add_split(bars, views.CUTOFF)
    valid = exits.simulate(split, order=order).where("is_valid").select(*_LABEL_INPUT)
    return labels.add_candidates(labels.add_rewards(valid, decay=rule.decay), rule)


def labelled(spark, folder, rule: LabelRule = DEFAULT_LABELS):
    return labels.select_labels(_candidates(spark, folder, rule), rule)


@register
def label_candidates(spark, folder):
    return _candidates(spark, folder).where("side is not null").select(
        "bar_id", "split", "side", "long_ratio", "short_ratio", "score")


@register
def label_stats(spark, folder):
    return labels.candidate_stats(_candidates(spark, folder))


@register
def labels_(spark, folder):
    return labelled(spark, folder).select(
        "bar_id", "split", "label", F.coalesce("rank", F.lit(0)).alias("rank"))


@register
def labels_all(spark, folder):
    return labelled(spark, folder, KEEP_ALL_LABELS).select("bar_id", "split", "label")


@register
def labels_top10(spark, folder):
    return labelled(spark, folder, TOP_TENTH_LABELS).select("bar_id", "split", "label")


@register
def label_counts(spark, folder):
    return labels.label_counts(labelled(spark, folder))


# --- balancing ----------------------------------------------------------------------------

def _train_rows(spark, folder, columns: list[str]) -> DataFrame:
    """Labelled training bars with the given bar columns, written once for several passes."""
    picked = labelled(spark, folder).where("split = 'train'").select("bar_id", "label")
    joined = views.bars(spark, folder).select("bar_id", *columns).join(picked, "bar_id")
    return materialize(joined, "train")


@register
def class_weights(spark, folder):
    train = materialize(
        labelled(spark, folder).where("split = 'train'").select("bar_id", "label"), "train")
    return balance.add_weights(train, balance.class_weights(train))


@register
def smote_neighbors(spark, folder):
    train = _train_rows(spark, folder, CONTINUOUS)
    sizes = balance.class_sizes(train)
    minority = [c for c, n in sizes.items() if n < max(sizes.values())]
    points = train.where(F.col("label").isin(minority)).select(
        "label", "bar_id", F.array(*CONTINUOUS).alias("vector"))
    return neighbours.nearest(points, balance.NEIGHBOURS).drop("nn_vector")


def _balanced(spark, folder) -> DataFrame:
    return balance.oversample(_train_rows(spark, folder, CONTINUOUS), CONTINUOUS).rows


@register
def smote_counts(spark, folder):
    return _balanced(spark, folder).groupBy("label").agg(
        F.count(F.lit(1)).alias("bars"), F.count_if("is_synthetic").alias("synthetic"))


@register
def smote_rows(spark, folder):
    return _balanced(spark, folder)


# --- evaluation ---------------------------------------------------------------------------

def _scores(spark, folder, df: DataFrame) -> DataFrame:
    return evaluation.blend(views.with_scores(df, views.event_count(spark, folder)))


def _evaluated(spark, folder):
    return _scores(spark, folder, labelled(spark, folder))


@register
def threshold_rule(spark, folder):
    scored = _scores(spark, folder, views.table(spark, folder, "events").select(
        F.col("event_id").alias("bar_id")))
    return evaluation.threshold_rule(scored).select("bar_id", "predicted")


@register
def ensemble_actions(spark, folder):
    scored = _scores(spark, folder, views.bars(spark, folder))
    return scored.select("bar_id", "p_long", "p_short", "p_none", "predicted")


@register
def balanced_accuracy(spark, folder):
    decided = evaluation.threshold_rule(_evaluated(spark, folder))
    return rounded(
        evaluation.balanced_accuracy(decided), ["accuracy", "balanced_accuracy"], 9)


def _result_rows(spark, folder):
    truth = labelled(spark, folder)
    scores = _scores(spark, folder, views.bars(spark, folder))
    return evaluation.result_rows(truth, scores)


@register
def eval_rows(spark, folder):
    out = _result_rows(spark, folder)
    return rounded(out.withColumn("Date", clock("Date")), ["Actual_Reward"])


@register
def signal_dist(spark, folder):
    return evaluation.signal_distribution(_result_rows(spark, folder))


@register
def confusion(spark, folder):
    return evaluation.confusion(_evaluated(spark, folder))


@register
def class_detail(spark, folder):
    return evaluation.class_detail(_evaluated(spark, folder))


@register
def prf1(spark, folder):
    return evaluation.precision_recall(_evaluated(spark, folder))


@register
def trading_perf(spark, folder):
    return rounded(
        evaluation.trading_performance(_evaluated(spark, folder)),
        ["total_profit", "avg_profit", "total_reward", "avg_reward", "all_profit"], 5)


@register
def eval_summary(spark, folder):
    return rounded(
        evaluation.summary(_evaluated(spark, folder)),
        ["total_profit", "avg_long_profit", "avg_short_profit"], 5)


# --- trades -------------------------------------------------------------------------------

def _decided(spark, folder):
    return _scores(spark, folder, _simulated(spark, folder))


@register
def signal_ohlc(spark, folder):
    return trades.signal_bars(_decided(spark, folder)).withColumn("Datetime", clock("Datetime"))


def _trade_text(df: DataFrame) -> DataFrame:
    return df.withColumns({c: clock(c) for c in ("EntryDateTime", "ExitDateTime")})


@register
def trade_list(spark, folder):
    return _trade_text(trades.trade_list(_decided(spark, folder)))


@register
def trade_dist(spark, folder):
    return trades.trade_distribution(trades.trade_list(_decided(spark, folder)))


@register
def export_totals(spark, folder):
    decided = _decided(spark, folder)
    return trades.export_totals(trades.signal_bars(decided), trades.trade_list(decided))


# --- exit requests ------------------------------------------------------------------------

@register
def exit_scores_(spark, folder):
    matched = exit_scores.match_requests(
        views.requests(spark, folder), views.snapshots(spark, folder), ["RSI", "probabilities"])
    out = exit_scores.map_classes(matched, views.class_map(spark))
    return out.select("request_id", "RSI", "red", "yellow", "green", "error")


@register
def parse_requests(spark, folder):
    """Fields of every line; lines to quarantine have an error and no bar count (-1)."""
    parsed = exit_scores.parse_requests(views.request_lines(spark, folder)).drop("line")
    return parsed.withColumn("BarsSinceTradeEntry", F.coalesce("BarsSinceTradeEntry", F.lit(-1)))


# --- streams ------------------------------------------------------------------------------

def _arrivals(df: DataFrame) -> list[DataFrame]:
    """The whole table as parts that arrive in order of time, each of a bounded size.

    A key's bars of one arrival are sorted in one task, so a larger table has more arrivals.
    """
    df = materialize(df, "replayed")
    micros = F.unix_micros(F.col("Date").cast("timestamp_ltz"))
    n = max(2, math.ceil(df.count() / ARRIVAL_ROWS))
    cuts = df.agg(F.percentile_approx(micros, [i / n for i in range(1, n)], 100_000)).first()[0]
    ends = [None, *sorted(set(cuts)), None]
    return [
        df.where((F.lit(lo is None) | (micros >= F.lit(lo or 0)))
                 & (F.lit(hi is None) | (micros < F.lit(hi or 0))))
        for lo, hi in zip(ends, ends[1:])
    ]


@register
def stream_entry(spark, folder):
    bars = views.bars(spark, folder)
    scored = views.with_scores(bars, views.event_count(spark, folder))
    fitted = _fitted(bars)

    def build(stream):
        prepared = entry.prepare(stream, fitted)
        codes = [f"{c}_{k}" for c in CATEGORICAL for k in DOMAINS[c]]
        return entry.signals(prepared, keep=(*CONTINUOUS, *codes))

    out = jobs.replay(_arrivals(scored), build)
    return rounded(out.drop("Date"), CONTINUOUS, 4)


@register
def stream_lag(spark, folder):
    out = jobs.replay(_arrivals(_window_bars(spark, folder)), stateful.lag_stream)
    return out.select("bar_id", *[f"{c}_lag1" for c in INPUT_FEATURES], "late")


@register
def stream_exits(spark, folder):
    decided = _scores(spark, folder, clean.flag_window(views.bars(spark, folder)))
    out = jobs.replay(_arrivals(decided), stateful.exit_stream)
    return _trade_text(out.drop("symbol", "trading_day"))


# --- files --------------------------------------------------------------------------------

@register
def csv_roundtrip(spark, folder):
    """Feature table to csv and back through the typed reader."""
    table = _feature_table(spark, folder).drop("bar_id")
    path = writers.write_table(table, scratch(spark, "features"))
    back = features.check_width(readers.read_features(spark, path))
    dated = clean.parse_dates(back)
    return dated.select(clock("Date"), *feature_table_columns()[1:])


@register
def raw_roundtrip(spark, folder):
    """Raw bars to a day-partitioned table and to csv, and back."""
    day_table = writers.write_bars(views.bars(spark, folder), scratch(spark, "days"))
    by_day = readers.read_raw_bars(spark, day_table)
    text = writers.write_table(by_day, scratch(spark, "raw"))
    return readers.read_raw_bars(spark, text, "csv").withColumn("Date", clock("Date"))


@register
def export_roundtrip(spark, folder):
    """Signal bars and trades to csv and back."""
    decided = _decided(spark, folder)
    bars, listed = trades.signal_bars(decided), trades.trade_list(decided)
    _, path = writers.write_exports(bars, listed, scratch(spark, "exports"), "ES")
    back = spark.read.schema(listed.schema).option("header", True).csv(path)
    return _trade_text(back)


@register
def results_roundtrip(spark, folder):
    """Evaluation rows to csv under a name with model and time, and back."""
    rows = _result_rows(spark, folder)
    path = writers.write_results(rows, scratch(spark, "results"), "Model")
    back = spark.read.schema(rows.schema).option("header", True).csv(path)
    return rounded(back.withColumn("Date", clock("Date")), ["Actual_Reward"])


# --- models -------------------------------------------------------------------------------

def _model_table(spark, folder) -> tuple[DataFrame, list[str]]:
    """Scaled feature table with labels, and the names of the selected features."""
    table = _feature_table(spark, folder)
    names = features.require_features(table, views.selection())
    scaled = _fitted(views.bars(spark, folder)).transform(table.select("bar_id", *names))
    truth = labelled(spark, folder).select(
        "bar_id", "split", "label", "InWindow", "long_profit", "short_profit")
    return materialize(scaled.join(truth, "bar_id"), "model-table"), names


def _parts(table: DataFrame) -> list[DataFrame]:
    return [table.where(F.col("split") == s) for s in ("train", "val", "test")]


def _sums_to_one() -> Column:
    return F.abs(sum(map(F.col, evaluation.PROBABILITIES)) - 1) < 1e-9


def _probability_list() -> tuple[Column, Column]:
    every = F.array(*evaluation.PROBABILITIES)
    return every, F.array_max(every)


def _threshold_rule() -> Column:
    """Whether a decision is the threshold rule's, found from the largest value."""
    every, top = _probability_list()
    alone = F.size(F.filter(every, lambda p: p == top)) == 1
    place = F.array_position(every, top) - 1
    return F.col("predicted") == F.when(alone & (top > 0.3), place).otherwise(2)


def _decisions(scored: DataFrame) -> DataFrame:
    """What the model says: label, probabilities and decision of every row."""
    return scored.select("bar_id", "label", *evaluation.PROBABILITIES, "predicted")


def _checked(decided: DataFrame, follows: Column, *more: str) -> DataFrame:
    """Every row with whether its probabilities and decision fit together, and whether the whole model is
    better than a constant one, whose balanced accuracy is a third."""
    decided = materialize(decided, "decided")
    better = evaluation.balanced_accuracy(decided).select((F.col("balanced_accuracy") > 0.4).alias("beats_constant"))
    (known,) = better.collect()
    return decided.select("bar_id", "label", _sums_to_one().alias("sums_to_one"), follows.alias("follows_rule"),
                          F.lit(known["beats_constant"]).alias("beats_constant"), *more)


def _blended() -> Column:
    """Whether a decision is the blend's: No-Trade at the top wins ties, then Short."""
    _, top = _probability_list()
    expected = F.when(F.col("p_none") == top, 2).when(F.col("p_short") == top, 1).otherwise(0)
    return F.col("predicted") == expected


@register
def feature_vector(spark, folder):
    table = _feature_table(spark, folder)
    names = features.require_features(table, views.selection())
    values = vector_to_array("features")
    total = F.aggregate(values, F.lit(0.0), lambda a, x: a + x)
    return rounded(training.feature_vector(table, names).select(
        "bar_id", F.size(values).alias("width"), total.alias("total")), ["total"])


def _by_forest(spark, folder) -> DataFrame:
    table, names = _model_table(spark, folder)
    train, _, test = _parts(table)
    return evaluation.threshold_rule(training.forest_probabilities(training.fit_forest(train, names), test))


def _by_boosting(spark, folder) -> DataFrame:
    table, names = _model_table(spark, folder)
    train, _, test = _parts(table)
    return evaluation.threshold_rule(training.fit_boosted(train, names).transform(test))


def _by_weighted(spark, folder) -> DataFrame:
    """Balanced weights, and rounds that stop on the validation part."""
    table, names = _model_table(spark, folder)
    train, val, test = _parts(table)
    return evaluation.threshold_rule(training.fit_weighted(train, val, names).transform(test))


@register
def train_forest(spark, folder):
    return _decisions(_by_forest(spark, folder))


@register
def train_forest_check(spark, folder):
    return _checked(_by_forest(spark, folder), _threshold_rule())


@register
def train_boost(spark, folder):
    return _decisions(_by_boosting(spark, folder))


@register
def train_boost_check(spark, folder):
    return _checked(_by_boosting(spark, folder), _threshold_rule())


@register
def train_weighted(spark, folder):
    return _decisions(_by_weighted(spark, folder))


@register
def train_weighted_check(spark, folder):
    return _checked(_by_weighted(spark, folder), _threshold_rule())


def _both(train: DataFrame, names: list[str]) -> tuple[training.BoostedModel, training.PipelineModel | training.ForestModel]:
    """Both models at the same time: few tasks grow the boosted trees, the forest takes the other cores."""
    boosted, forest = training.run_together(
        [lambda: training.fit_boosted(train, names), lambda: training.fit_forest(train, names)])
    return boosted, forest


@register
def train_ensemble(spark, folder):
    """Balance the training part, fit both models, evaluate the blend on the test part."""
    table, names = _model_table(spark, folder)
    train, _, test = _parts(table)
    balanced = materialize(balance.oversample(train, names).rows, "balanced")
    boosted, forest = _both(balanced, names)
    return evaluation.summary(training.score_ensemble(test, boosted, forest))


@register
def tune(spark, folder):
    table, names = _model_table(spark, folder)
    train, val, _ = _parts(table)
    return spark.createDataFrame(training.tune(train, val, names))


def _by_stored(spark, folder) -> DataFrame:
    """The blend of both models after saving and loading, and whether the fitted ones gave the same."""
    table, names = _model_table(spark, folder)
    train, _, test = _parts(table)
    boosted, forest = _both(train, names)
    path = writers.save_model(forest, scratch(spark, "forest"))
    loaded = training.BoostedModel.load(boosted.save(scratch(spark, "boosted")))
    own = F.struct(*evaluation.PROBABILITIES, "predicted")
    fitted = training.score_ensemble(test, boosted, forest).select(*test.columns, own.alias("fitted"))
    stored = training.score_ensemble(fitted, loaded, writers.load_model(path))
    return stored.withColumn("same_as_fitted", F.col("fitted") == own).select(
        "bar_id", "label", *evaluation.PROBABILITIES, "predicted", "same_as_fitted")


@register
def model_roundtrip(spark, folder):
    return _by_stored(spark, folder)


@register
def model_roundtrip_check(spark, folder):
    return _checked(_by_stored(spark, folder), _blended(), "same_as_fitted")


_PREDICTORS = ["RSI", "MACD", "HABodyRangeRatio", "MyWAZLTTrend"]


def _routed(spark, folder) -> DataFrame:
    """Requests scored by the model of their type, designation and bars; PV3 has none."""
    snaps = materialize(views.snapshots(spark, folder), "snapshots")
    best = F.array_position("probabilities", F.array_max("probabilities")).cast("int") - 1
    history = snaps.withColumn("label", best)

    def fit(*values):
        own = history.where(reduce(and_, [F.col(k) == v for k, v in zip(exit_scores.TRADE_KEY, values)]))
        return training.fit_forest(own, _PREDICTORS)

    known = snaps.where("TradeDesignation <> 'PV3'").select(*exit_scores.TRADE_KEY).distinct()
    keys = sorted(map(tuple, known.collect()))  # one per model, not per row
    models = training.run_together([lambda k=k: fit(*k) for k in keys])

    def scorer(model):
        return lambda df: training.forest_probabilities(model, df).withColumn(
            "probabilities", F.array(*evaluation.PROBABILITIES)).drop(*evaluation.PROBABILITIES)

    matched = exit_scores.match_requests(views.requests(spark, folder), snaps, _PREDICTORS)
    routed = training.route(
        matched, {k: scorer(m) for k, m in zip(keys, models, strict=True)}, exit_scores.TRADE_KEY)
    out = exit_scores.map_classes(routed, views.class_map(spark))
    return out.select("request_id", *exit_scores.TRADE_KEY, "red", "yellow", "green", "error")


@register
def routed_scores(spark, folder):
    return _routed(spark, folder)


@register
def routed_scores_check(spark, folder):
    """``consistent``: zeros where there is a reason, else probabilities over the known classes."""
    total = F.col("red") + F.col("yellow") + F.col("green")
    consistent = (
        F.when(F.col("error").isNotNull(), F.greatest(*(F.abs(c) for c in ("red", "yellow", "green"))) == 0)
        .when(F.col("TradeType") == "Long", F.abs(total - 1) < 1e-9)
        .otherwise((F.col("yellow") == 0) & total.between(0, 1 + 1e-9))
    )
    return _routed(spark, folder).select("request_id", *exit_scores.TRADE_KEY, "error", consistent.alias("consistent"))
