import random

import pytest
from pyspark.sql import functions as F

from barsmith.operators import evaluation, training
from barsmith.sources import writers

NAMES = ["a", "b"]


@pytest.fixture(scope="module")
def separable(spark):
    rng = random.Random(3)
    centres = {0: (0, 0), 1: (4, 0), 2: (0, 4)}
    rows = [
        (i, c, rng.gauss(centres[c][0], .7), rng.gauss(centres[c][1], .7))
        for i, c in enumerate([0, 1, 2, 2, 2] * 60)]
    df = spark.createDataFrame(rows, "bar_id long, label int, a double, b double").persist()
    return df.where("bar_id % 4 <> 0"), df.where("bar_id % 4 = 0")


def accuracy(scored):
    decided = evaluation.threshold_rule(scored)
    return evaluation.balanced_accuracy(decided).first()["balanced_accuracy"]


def test_boosted_model_learns_and_probabilities_sum_to_one(separable, tmp_path):
    train, test = separable
    model = training.fit_boosted(train, NAMES, training.BoostParams(max_depth=2, rounds=5, learning_rate=0.3))
    scored = model.transform(test)
    assert accuracy(scored) > 0.9
    total = F.col("p_long") + F.col("p_short") + F.col("p_none")
    assert scored.where(F.abs(total - 1) > 1e-9).count() == 0
    again = training.BoostedModel.load(model.save(str(tmp_path / "m"))).transform(test)
    assert sorted(map(tuple, again.collect())) == sorted(map(tuple, scored.collect()))


def test_early_stopping_needs_fewer_rounds(separable):
    train, test = separable
    params = training.BoostParams(max_depth=2, rounds=300, learning_rate=0.5)
    model = training.fit_weighted(train, test, NAMES, params, patience=5)
    assert len(model.rounds) < 300
    assert accuracy(model.transform(test)) > 0.9


def test_forest_and_blend(separable, tmp_path):
    train, test = separable
    forest = training.fit_forest(train, NAMES, training.ForestParams(trees=5, max_depth=4))
    loaded = writers.load_model(writers.save_model(forest, str(tmp_path / "f")))
    assert accuracy(training.forest_probabilities(loaded, test)) > 0.9
    boosted = training.fit_boosted(train, NAMES, training.BoostParams(max_depth=2, rounds=2))
    scored = training.score_ensemble(test, boosted, loaded)
    assert evaluation.balanced_accuracy(scored).first()["balanced_accuracy"] > 0.9


def test_tuning_marks_the_first_best(separable):
    train, test = separable
    same = training.BoostParams(max_depth=2, rounds=2, learning_rate=0.3)
    results = training.tune(train, test, NAMES, [same, same])
    assert [r["is_best"] for r in results] == [True, False]
    assert results[0]["balanced_accuracy"] == results[1]["balanced_accuracy"]


def test_missing_feature_values_are_an_error(spark):
    df = spark.createDataFrame([(1.0, None)], "a double, b double")
    with pytest.raises(Exception, match="(?i)null|NaN"):
        training.feature_vector(df, NAMES).collect()


def test_published_settings():
    boost, forest = training.BoostParams(), training.ForestParams()
    assert (boost.max_depth, boost.learning_rate, boost.rounds, boost.min_child_weight) == (5, 0.05, 1000, 3)
    assert (boost.gamma, boost.alpha, boost.l2) == (0.1, 0.1, 1.0)
    assert (forest.trees, forest.max_depth, forest.min_leaf_rows) == (200, 12, 2)
    assert len(training.TUNING_COMBINATIONS) == 10


def test_routing_scores_only_known_keys(spark):
    rows = [("Long", "PV1", True), ("Long", "PV2", True), ("Long", "PV1", False), (None, "PV1", True)]
    df = spark.createDataFrame(rows, "TradeType string, TradeDesignation string, found boolean")
    registry = {("Long", "PV1"): lambda d: d.withColumn("probabilities", F.array(F.lit(1.0)))}
    out = training.route(df, registry, ("TradeType", "TradeDesignation"))
    assert out.count() == 4
    assert out.where("probabilities is not null").count() == 1
