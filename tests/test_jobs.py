"""The jobs from files to models, and scoring with saved models."""

from pyspark.sql import functions as F

from barsmith import jobs
from barsmith.operators import training
from barsmith.plans import views
from barsmith.sources import readers, registry, writers
from conftest import SF


def test_files_to_models(spark, tmp_path):
    raw = views.bars(spark, SF).drop("trading_day", "bar_id", "symbol")
    text = raw.withColumn("Date", F.date_format("Date", "MM/dd/yyyy hh:mm:ss a"))
    path = writers.write_table(text, str(tmp_path / "raw"))
    bars = jobs.prepare_bars(spark, path)
    table = jobs.build_features(spark, bars, str(tmp_path / "features"))
    assert readers.check_header_width(spark, table) == 333
    fitted = jobs.build_scaler(spark, bars, str(tmp_path / "scaler"))
    assert writers.load_scaler(spark, str(tmp_path / "scaler")) == fitted

    result = jobs.train(
        spark, bars, fitted, views.CUTOFF, views.selection(),
        boost=training.BoostParams(max_depth=2, rounds=2, learning_rate=0.3),
        forest=training.ForestParams(trees=3, max_depth=3))
    summary = result.summary.first()
    n = result.rows.count()
    assert result.balanced and 0 < summary["overall_accuracy"] <= 1
    assert n == result.trades.count() == result.signal_bars.count() > 0
    assert len(result.rows.columns) == 13 + 76
    paths = jobs.save(result, str(tmp_path / "out"))
    assert spark.read.option("header", True).csv(paths["results"]).count() == n
    assert len(training.BoostedModel.load(paths["boosted"]).features) == 76


def test_saved_models_score_requests(spark, tmp_path):
    history = spark.createDataFrame(
        [(float(i % 10), 0.0, i % 10 // 4) for i in range(60)], "RSI double, MACD double, label int")
    model = training.fit_forest(
        history, ["RSI", "MACD"], training.ForestParams(trees=2, max_depth=3))
    folder = str(tmp_path / "es")
    registry.register_model(model, folder, ("Long", "PV1", 2))
    assert set(registry.list_models(spark, folder)) == {("Long", "PV1", 2)}
    assert registry.parse_name("notes") is None
    assert registry.load_models(spark, str(tmp_path / "absent")) == {}

    keys = "TradeType string, TradeDesignation string, BarsSinceTradeEntry int"
    snapshots = spark.createDataFrame(
        [(0, "Long", "PV1", 2, 1.0, 0.0), (1, "Long", "PV1", 3, 1.0, 0.0)],
        f"seq long, {keys}, RSI double, MACD double")
    requests = spark.createDataFrame(
        [(1, "Long", "PV1", 2), (2, "Long", "PV1", 3), (3, "Long", "PV1", 4)],
        f"request_id int, {keys}")
    class_map = spark.createDataFrame(
        [("Long", "PV1", 0, -1), ("Long", "PV1", 1, 0), ("Long", "PV1", 2, 1)],
        "TradeType string, TradeDesignation string, class_index int, value int")
    out = jobs.score_exits(requests, snapshots, class_map, folder, ["RSI", "MACD"])
    rows = {r["request_id"]: r for r in out.collect()}
    assert rows[1]["error"] is None and rows[1]["red"] > 0.5
    assert abs(rows[1]["red"] + rows[1]["yellow"] + rows[1]["green"] - 1) < 1e-9
    assert (rows[2]["red"], rows[2]["error"]) == (0.0, "no model")
    assert rows[3]["error"] == "no snapshot"
