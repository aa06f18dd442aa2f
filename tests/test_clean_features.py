import datetime as dt

import pytest
from pyspark.sql import functions as F

from barsmith.config import FEATURE_TABLE_WIDTH, feature_table_columns
from barsmith.operators import clean, features, scaler, splits
from barsmith.plans import views
from conftest import SF
from helpers import full_bars


def texts(spark, values):
    return spark.createDataFrame([(v,) for v in values], "Date string")


def test_contract_has_333_columns():
    names = feature_table_columns()
    assert len(names) == len(set(names)) == FEATURE_TABLE_WIDTH
    assert names[17:20] == ["MACDState_1", "MACDState_2", "MACDState_3"]
    assert names[33] == "MACDState_lag1_1"


def test_first_format_present_wins_for_the_whole_column(spark):
    df = texts(spark, ["07/01/2025 09:00:00 AM", "7/1/2025 9:00:05 PM", "2025-07-01 09:00:00", None])
    got = [r[0] for r in clean.parse_dates(df).collect()]
    assert got == [None, None, dt.datetime(2025, 7, 1, 9), None]
    only_us = [r[0] for r in clean.parse_dates(df.limit(2)).collect()]
    assert only_us == [dt.datetime(2025, 7, 1, 9), dt.datetime(2025, 7, 1, 21, 0, 5)]


def test_two_digit_years(spark):
    df = texts(spark, ["07/01/25 09:00:00 AM"])
    assert clean.choose_format(df) == "M/d/yy h:mm:ss a"
    assert clean.parse_dates(df).first()[0] == dt.datetime(2025, 7, 1, 9)


def test_mixed_fallback_when_no_format_fits(spark):
    df = texts(spark, ["2025-07-01T09:00:00", "2025-07-02", "nonsense"])
    got = [r[0] for r in clean.parse_dates(df).collect()]
    assert got == [dt.datetime(2025, 7, 1, 9), dt.datetime(2025, 7, 2), None]


def test_window_ends_are_inclusive(spark):
    times = ["08:34:55", "08:35:00", "10:25:00", "10:25:00.5"]
    df = spark.createDataFrame(
        [(dt.datetime.fromisoformat(f"2025-07-01 {t}"),) for t in times], "Date timestamp_ntz")
    assert [r["InWindow"] for r in clean.flag_window(df).collect()] == [False, True, True, False]


def test_fraction_of_a_second_is_ignored(spark):
    times = ["09:00:05.5", "09:00:06", "09:00:10"]
    df = spark.createDataFrame(
        [(dt.datetime.fromisoformat(f"2025-07-01 {t}"),) for t in times], "Date timestamp_ntz")
    assert clean.keep_bar_marks(df).count() == 2


def test_nan_becomes_null(spark):
    df = spark.createDataFrame([(float("nan"), 1), (2.0, 2)], "x double, k int")
    assert [tuple(r) for r in clean.nan_to_null(df).collect()] == [(None, 1), (2.0, 2)]


def test_first_bar_of_a_day_and_codes_outside_the_domain(spark):
    bars = full_bars(spark, [
        {"Date": "2025-07-01 09:00:00", "Open": 5.0, "MACDState": 99, "HAGreenConsec": 7},
        {"Date": "2025-07-01 09:00:05", "Open": None, "MACDState": None},
        {"Date": "2025-07-01 09:00:10"},
        {"Date": "2025-07-02 09:00:00", "Open": 8.0},
    ])
    table = features.feature_table(bars, keep=("bar_id",))
    features.check_width(table.drop("bar_id"))
    rows = {r["bar_id"]: r.asDict() for r in table.collect()}
    states = [f"MACDState_{k}" for k in range(1, 17)]
    lagged = [f"MACDState_lag1_{k}" for k in range(1, 17)]
    assert rows[0]["Open_lag1"] == rows[3]["Open_lag1"] == 0.0
    assert rows[0]["HAGreenConsec_lag1_0"] == rows[3]["HAGreenConsec_lag1_0"] == 1.0
    assert sum(rows[0][c] for c in lagged) == 0.0
    assert sum(rows[0][c] for c in states) == sum(rows[1][c] for c in states) == 0.0
    assert rows[1]["Open_lag1"] == 5.0 and rows[1]["HAGreenConsec_lag1_7"] == 1.0
    assert rows[2]["Open_lag1"] == 0.0  # the value before is missing
    assert rows[2]["HAGreenConsec_lag1_1"] == 1.0


def test_feature_table_needs_one_shuffle(spark):
    bars = clean.keep_window(views.bars(spark, SF))
    order = features.day_order(bars)
    text = features.feature_table(bars, order=order)._jdf.queryExecution().executedPlan().toString()
    # Numbering the events into bars and the lags share the shuffle by day.
    assert text.count("Exchange") == 1 and "Python" not in text


def test_selection_reports_missing_names(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, c int")
    assert features.select_features(df, ["c", "x", "a"]) == (["c", "a"], ["x"])
    assert features.require_features(df, ["c", "a"], 2) == ["c", "a"]
    with pytest.raises(ValueError, match="missing: .'x'."):
        features.require_features(df, ["c", "x"], 2)
    for wrong in (["c"], ["a", "b", "c"], ["a", "a"], ["a", "b", "x"]):
        with pytest.raises(ValueError, match="Expected 2 features"):
            features.require_features(df, wrong, 2)
    with pytest.raises(ValueError, match="Expected 333 columns, found 3"):
        features.check_width(df)
    assert len(views.selection()) == 76


def test_constant_column_scales_to_zero(spark):
    bars = full_bars(spark, [{"Date": f"2025-07-01 09:00:{s:02}", "Open": float(s)} for s in (0, 5, 10)])
    model = scaler.fit(bars.select(*scaler.CONTINUOUS))
    out = model.transform(bars)
    assert [r["MACD"] for r in out.collect()] == [0.0] * 3
    opens = sorted(r["Open"] for r in out.collect())
    assert opens == pytest.approx([-1.224744871, 0, 1.224744871])  # population deviation
    assert model.stats["Open_lag1"] == model.stats["Open"]


def test_padding_rows(spark):
    bars = full_bars(spark, [{"Date": "2025-07-01 09:00:00", "Open": 10.0, "RSI": 40.0, "MACD": -1.0}])
    rows = scaler.pad_extremes(bars).orderBy("RSI").collect()
    assert [(r["Open"], r["RSI"], r["MACD"]) for r in rows] == [
        (8.0, 0.0, -1.0), (10.0, 40.0, -1.0), (12.0, 100.0, -1.0)]


def test_split_by_cutoff_and_days(spark):
    days = [f"2025-07-0{d} 09:00:00" for d in range(1, 7)]
    bars = full_bars(spark, [{"Date": d} for d in days])
    out = splits.add_split(bars, "2025-07-06 08:30:00")
    got = [r["split"] for r in out.orderBy("Date").collect()]
    assert got == ["train"] * 4 + ["val", "test"]
    counts = {r["split"]: r["rows"] for r in splits.split_counts(out).collect()}
    assert counts == {"train": 4, "val": 1, "test": 1}


def test_dedup_keeps_one_of_each(spark):
    df = spark.createDataFrame([(1, 2.0), (1, 2.0), (1, 3.0)], "a int, b double")
    assert clean.drop_identical(df).count() == 2


def test_order_of_lags_survives_cut_days(spark):
    bars = clean.keep_window(views.bars(spark, SF))
    cut = features.plan_order(bars, features.DAY_KEYS, features.BAR_ORDER, max_group_rows=3, slices=30)
    assert cut.sliced
    names = ["bar_id", "Open_lag1", "MACDState_lag1"]
    got, want = (
        sorted(map(tuple, features.add_lags(bars, o).select(*names).collect()))
        for o in (cut, None))
    assert got == want
    assert bars.agg(F.count_distinct("trading_day")).first()[0] > 1
