"""The model queries train with the published settings."""

import threading

import numpy as np
import pytest

import __spark_entry__ as contract
import check
from barsmith.operators import boosting, training
from barsmith.plans import catalog
from conftest import SF

TUNED = [800, 500, 1000, 1000, 800, 1500, 500, 800, 150, 1000]


class Parts:
    rows = None


class Seen(Exception):
    pass


@pytest.mark.parametrize("name, rounds", [
    ("train_boost", [1000]), ("train_weighted", [1000]), ("train_ensemble", [1000]), ("model_roundtrip", [1000]),
    ("tune", TUNED)])
def test_published_rounds(spark, monkeypatch, name, rounds):
    seen = []

    def fit(train, features, models, *rest, **more):
        seen.extend(m.rounds for m in models)
        raise Seen

    monkeypatch.setattr(catalog, "_model_table", lambda *_: (spark.createDataFrame(
        [(1, "train", 0), (2, "train", 1), (3, "train", 2), (4, "val", 0)], "bar_id long, split string, label int"), []))
    monkeypatch.setattr(catalog, "materialize", lambda df, _: df)
    monkeypatch.setattr(catalog.balance, "oversample", lambda *_: Parts)
    monkeypatch.setattr(training.boosting, "fit_models", fit)
    monkeypatch.setattr(training, "fit_forest", lambda *_: None)
    monkeypatch.setattr(training.BoostedModel, "transform", lambda self, df: df)
    monkeypatch.setattr(catalog.writers, "save_model", lambda *_: "")
    monkeypatch.setattr(training.evaluation, "threshold_rule", lambda df: df)
    monkeypatch.setattr(training.evaluation, "balanced_accuracy", lambda df: spark.createDataFrame(
        [(0.5, 0.5)], "balanced_accuracy double, accuracy double"))
    with pytest.raises(Seen):
        contract.queries()[name](spark, "")
    assert seen == rounds


def test_a_constant_model_fails_the_check(spark, monkeypatch):
    """A third for every class follows all rules but is no model."""
    def constant(train, features, *rest, **more):
        return training.BoostedModel(tuple(features), boosting.Layout(tuple(np.zeros(1) for _ in features)), ())

    monkeypatch.setattr(training, "fit_boosted", constant)
    got = contract.queries()["train_boost_check"](spark, SF).toPandas()
    assert got["sums_to_one"].all() and got["follows_rule"].all() and not got["beats_constant"].any()
    want = check.connect(SF).execute(contract.oracle_sql()["train_boost_check"]).df()
    assert len(got) == len(want) and check.difference(got, want) is not None


def test_both_models_are_fitted_at_the_same_time(monkeypatch):
    met = threading.Barrier(2)

    def fit(name):
        return lambda *_: met.wait(20) is not None and name

    monkeypatch.setattr(training, "fit_boosted", fit("boosted"))
    monkeypatch.setattr(training, "fit_forest", fit("forest"))
    assert catalog._both(None, []) == ("boosted", "forest")


def test_tuned_models_are_scored_at_the_same_time(monkeypatch):
    met, scores = threading.Barrier(2), [0.4, 0.6]

    class Model:
        def __init__(self, place):
            self.place = place

        def transform(self, _):
            return self

        def first(self):
            met.wait(20)
            return {"balanced_accuracy": scores[self.place], "accuracy": 0.5}

    monkeypatch.setattr(training.balance, "class_weights", lambda _: {})
    monkeypatch.setattr(training.balance, "add_weights", lambda df, _: df)
    monkeypatch.setattr(training.boosting, "fit_models", lambda *_: [Model(0), Model(1)])
    monkeypatch.setattr(training.evaluation, "threshold_rule", lambda m: m)
    monkeypatch.setattr(training.evaluation, "balanced_accuracy", lambda m: m)
    assert [r["is_best"] for r in training.tune(None, None, [])] == [False, True]
