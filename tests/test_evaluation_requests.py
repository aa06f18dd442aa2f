import pytest

from barsmith.operators import evaluation, exit_scores

COLUMNS = (
    "bar_id long, label int, predicted int, long_profit double, short_profit double, "
    "InWindow boolean"
)


def decided(spark, pairs):
    return spark.createDataFrame(
        [(i, a, p, 50.0, -20.0, True) for i, (a, p) in enumerate(pairs)], COLUMNS)


def test_no_long_prediction_gives_zeros(spark):
    rows = {r["side"]: r for r in evaluation.trading_performance(
        decided(spark, [(0, 1), (2, 2), (1, 1)])).collect()}
    long, short = rows["LONG"], rows["SHORT"]
    assert (long["trades"], long["total_profit"], long["profitable_rate"]) == (0, 0.0, 0.0)
    assert (short["trades"], short["total_profit"], short["profitable"]) == (2, -40.0, 0)
    assert long["all_profit"] == -40.0 and short["total_reward"] == -300.0


def test_matrix_keeps_empty_cells(spark):
    rows = evaluation.confusion(decided(spark, [(0, 0), (0, 2)])).orderBy("actual").collect()
    assert [tuple(r) for r in rows] == [(0, 1, 0, 1), (1, 0, 0, 0), (2, 0, 0, 0)]


def test_absent_class_is_skipped_or_zero(spark):
    df = decided(spark, [(0, 0), (0, 2), (2, 2)])
    row = evaluation.balanced_accuracy(df).first()
    assert row["accuracy"] == pytest.approx(2 / 3)
    assert row["balanced_accuracy"] == pytest.approx((0.5 + 1.0) / 2)
    short = evaluation.precision_recall(df).where("class = 1").first()
    assert (short["precision"], short["recall"], short["f1"]) == (0.0, 0.0, 0.0)


def test_reports_on_no_rows(spark):
    empty = decided(spark, [(0, 0)]).where("false")
    assert evaluation.summary(empty).first()["overall_accuracy"] == 0.0
    assert evaluation.balanced_accuracy(empty).first()["balanced_accuracy"] == 0.0


def snapshots(spark):
    rows = [
        (1, "Long", "PV1", 2, [0.2, 0.3, 0.5]), (0, "Long", "PV1", 2, [0.1, 0.2, 0.7]),
        (2, "Short", "PV1", 1, [0.4, 0.6, 0.0]), (3, "Long", "PV9", 1, [0.4, 0.3, 0.3]),
    ]
    return spark.createDataFrame(
        rows, "seq long, TradeType string, TradeDesignation string, BarsSinceTradeEntry int, "
              "probabilities array<double>")


def test_first_match_class_map_and_errors(spark):
    maps = spark.createDataFrame(
        [("Long", "PV1", 0, -1), ("Long", "PV1", 1, 0), ("Long", "PV1", 2, 1),
         ("Short", "PV1", 0, -1), ("Short", "PV1", 1, 1)],
        "TradeType string, TradeDesignation string, class_index int, value int")
    asked = spark.createDataFrame(
        [(1, "Long", "PV1", 2), (2, "Short", "PV1", 1), (3, "Long", "PV1", 7), (4, "Long", "PV9", 1)],
        "request_id int, TradeType string, TradeDesignation string, BarsSinceTradeEntry int")
    matched = exit_scores.match_requests(asked, snapshots(spark), ["probabilities"])
    rows = {r["request_id"]: r for r in exit_scores.map_classes(matched, maps).collect()}
    triple = {i: (r["red"], r["yellow"], r["green"], r["error"]) for i, r in rows.items()}
    assert triple == {
        1: (0.1, 0.2, 0.7, None), 2: (0.4, 0.0, 0.6, None),
        3: (0.0, 0.0, 0.0, "no snapshot"), 4: (0.0, 0.0, 0.0, "no model"),
    }


def test_bad_request_lines_are_marked(spark):
    lines = ["a.json c.json Short PV1 2 models/ym", "a.json c.json Short PV1",
             "a.json c.json Short PV1 x models/ym", ""]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(lines)], "id int, line string")
    rows = exit_scores.parse_requests(df).orderBy("id").collect()
    assert rows[0]["BarsSinceTradeEntry"] == 2 and rows[0]["model_dir"] == "models/ym"
    assert [r["error"] for r in rows] == [
        None, "too few fields", "bars since entry is not a number", "too few fields"]
