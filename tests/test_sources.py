import datetime as dt
import json

import pytest

from barsmith.config import CATEGORICAL, CONTINUOUS, Asset, feature_table_columns
from barsmith.operators import clean, features, scaler
from barsmith.plans import views
from barsmith.sources import readers, writers
from conftest import SF


def test_missing_input_raises(spark, tmp_path):
    with pytest.raises(FileNotFoundError):
        readers.require_path(spark, str(tmp_path / "none.csv"))
    assert readers.require_path(spark, str(tmp_path)) == str(tmp_path)


def test_missing_columns_are_named(spark, tmp_path):
    views.bars(spark, SF).drop("RSI", "HAColor").write.parquet(str(tmp_path / "p"))
    with pytest.raises(ValueError, match="'RSI', 'HAColor'"):
        readers.read_raw_bars(spark, str(tmp_path / "p"))


@pytest.mark.parametrize("fmt", ["parquet", "csv", "orc", "json"])
def test_raw_formats(spark, tmp_path, fmt):
    bars = views.bars(spark, SF).drop("trading_day")
    path = writers.write_table(bars, str(tmp_path / fmt), fmt)
    back = readers.read_raw_bars(spark, path, fmt)
    assert dict(back.dtypes) == dict(bars.select(back.columns).dtypes)
    assert back.exceptAll(bars.select(back.columns)).count() == 0


def test_plain_file_of_one_instrument(spark, tmp_path):
    file = tmp_path / "raw.csv"
    names = ["Date", *CONTINUOUS, *CATEGORICAL]
    file.write_text(",".join(names) + "\n" + "\n".join(
        f"07/01/2025 09:00:{s:02} AM," + ",".join(["NaN"] + ["1"] * 19) for s in (0, 5)) + "\n")
    raw = readers.read_raw_bars(spark, str(file), "csv", text_dates=True)
    bars = clean.clean_bars(raw).orderBy("Date").collect()
    assert [r["symbol"] for r in bars] == ["ES", "ES"]
    assert bars[1]["Date"] == dt.datetime(2025, 7, 1, 9, 0, 5) and bars[0]["Open"] is None


def test_feature_file_accepts_booleans_and_wrong_width_raises(spark, tmp_path):
    names = feature_table_columns()
    values = ["2025-07-01 09:00:00"] + ["1.5"] * 16 + ["True"] + ["False"] * 315
    (tmp_path / "f.csv").write_text(",".join(names) + "\n" + ",".join(values) + "\n")
    row = readers.read_features(spark, str(tmp_path / "f.csv")).first()
    assert row["Open"] == 1.5 and row["MACDState_1"] == 1.0 and row["MACDState_2"] == 0.0
    assert readers.check_header_width(spark, str(tmp_path / "f.csv")) == 333
    (tmp_path / "g.csv").write_text("Date,Open\n2025-07-01 09:00:00,1\n")
    with pytest.raises(ValueError, match="found 2"):
        readers.check_header_width(spark, str(tmp_path / "g.csv"))


def test_parameter_and_selection_files(spark, tmp_path):
    values = {"price_per_point": 50.0, "minimum_resolution_points": 0.25, "price_per_tick": 12.5,
              "maximum_drawdown": 150.0, "points_to_maximum_drawdown": 3.0, "targer_profit": 100.0,
              "stoploss": 150.0}
    (tmp_path / "a.json").write_text(json.dumps({"assets": {"ES": values, "NQ": values}}, indent=1))
    rows = readers.read_assets(spark, str(tmp_path / "a.json")).collect()
    assert {r["symbol"] for r in rows} == {"ES", "NQ"}
    assert Asset(**rows[0].asDict()) == Asset(rows[0]["symbol"])
    (tmp_path / "s.json").write_text(json.dumps({"selected_features": ["RSI", "Open"]}, indent=1))
    assert readers.read_selection(spark, str(tmp_path / "s.json")) == ["RSI", "Open"]
    (tmp_path / "c.json").write_text(json.dumps(["RSI", "MACD"]))
    assert readers.read_predictors(spark, str(tmp_path / "c.json")) == ["RSI", "MACD"]


def test_scaler_survives_saving(spark, tmp_path):
    model = scaler.fit(views.bars(spark, SF))
    writers.save_scaler(model, spark, str(tmp_path / "s"))
    assert writers.load_scaler(spark, str(tmp_path / "s")) == model


def test_day_table_prunes_days(spark, tmp_path):
    path = writers.write_bars(views.bars(spark, SF), str(tmp_path / "days"))
    one = spark.read.parquet(path).where("trading_day = date'2024-01-03'").select("Open")
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(trading_day" in plan and "ReadSchema: struct<Open:double>" in plan


def test_result_name_has_model_and_time():
    at = dt.datetime(2025, 7, 1, 9, 5, 7)
    assert writers.result_path("out/", "Model", at) == "out/Model_evaluation_results_20250701_090507"


def test_features_round_trip_width(spark, tmp_path):
    table = features.feature_table(clean.keep_window(views.bars(spark, SF)))
    path = writers.write_table(table, str(tmp_path / "t"))
    assert len(features.check_width(readers.read_features(spark, path)).columns) == 333
