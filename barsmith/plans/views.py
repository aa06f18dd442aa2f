"""Input views over the given tables: events re-clocked to five-second bars."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barsmith.config import (
    BAR_ORDER, CATEGORICAL, DAY_KEYS, SELECTED_FEATURE_COUNT, feature_table_columns,
)
from barsmith.operators.ordered import (
    MAX_GROUP_ROWS, RowOrder, ordered_columns, plan_order,
)
from barsmith.session import configure

CUTOFF = "2024-01-25 08:30:00"
FIRST_SECOND = 30840
_HA_FACTORS = dict(zip(CATEGORICAL[6:], (1, 2, 4, 5, 7, 8)))


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{folder}/{name}.parquet")


def _events(spark: SparkSession, folder: str, symbol: Column) -> DataFrame:
    return table(spark, folder, "events").select(
        "event_id", "ts", "user_id", "value",
        symbol.alias("symbol"), F.to_date("ts").alias("trading_day"),
    )


def _clocked(events: DataFrame, order: RowOrder) -> DataFrame:
    """Events numbered by time within symbol and day, with the next value of that group."""
    following = {"next_value": lambda w: F.coalesce(F.lead("value", 1).over(w), F.col("value"))}
    return ordered_columns(events, order, following, ahead=1, position="rn")


def _bars(clocked: DataFrame) -> DataFrame:
    eid, uid, value, nxt = (F.col(c) for c in ("event_id", "user_id", "value", "next_value"))
    date = F.expr(
        "cast(trading_day as timestamp_ntz) + "
        f"make_dt_interval(0, 0, 0, cast({FIRST_SECOND} + 5 * rn as decimal(18,6)))"
    )
    cents = F.lit(0.01)
    codes = {
        "MACDState": eid % 17,
        "HAColor": uid % 3 + 1,
        "HALongWick": (eid + uid) % 3 + 1,
        "HAGreenConsec": eid % 53,
        "HARedConsec": uid % 51,
        "EMAState": uid % 16 + 1,
        **{name: (eid * k) % 3 + 1 for name, k in _HA_FACTORS.items()},
    }
    return clocked.select(
        eid.alias("bar_id"), "symbol", "trading_day", date.alias("Date"),
        (F.lit(6000) + value / 25).alias("Open"),
        (F.lit(6000) + F.greatest(value, nxt) / 25 + cents * (eid % 40)).alias("High"),
        (F.lit(6000) + F.least(value, nxt) / 25 - cents * (uid % 40)).alias("Low"),
        (F.lit(6000) + nxt / 25).alias("Close"),
        (eid * 37 % 101).cast("double").alias("RSI"),
        ((value - nxt) / 10).alias("MACD"),
        ((eid % 21).cast("double") / 20).alias("HABodyRangeRatio"),
        ((uid % 5).cast("double") - 2).alias("MyWAZLTTrend"),
        *[code.cast("int").alias(name) for name, code in codes.items()],
    )


def _ordered(events: DataFrame, max_group_rows: int) -> tuple[DataFrame, RowOrder]:
    """Bars and their order. At scale a day of events is too large for one task, hence slices.

    Bars have the groups of their events, so groups that are small enough are counted once.
    """
    order = plan_order(events, DAY_KEYS, ("ts", "event_id"), max_group_rows)
    made = _bars(_clocked(events, order))
    if order.sliced:
        return made, plan_order(made, DAY_KEYS, BAR_ORDER, max_group_rows)
    return made, RowOrder(DAY_KEYS, BAR_ORDER)


def ordered_bars(spark: SparkSession, folder: str,
                 max_group_rows: int = MAX_GROUP_ROWS) -> tuple[DataFrame, RowOrder]:
    """One instrument: every event is a bar."""
    return _ordered(_events(spark, folder, F.lit("ES")), max_group_rows)


def ordered_bars_multi(spark: SparkSession, folder: str,
                       max_group_rows: int = MAX_GROUP_ROWS) -> tuple[DataFrame, RowOrder]:
    """One instrument per event type."""
    return _ordered(_events(spark, folder, F.upper("event_type")), max_group_rows)


def bars(spark: SparkSession, folder: str, max_group_rows: int = MAX_GROUP_ROWS) -> DataFrame:
    events = _events(spark, folder, F.lit("ES"))
    return _bars(_clocked(events, plan_order(
        events, DAY_KEYS, ("ts", "event_id"), max_group_rows)))


def selection() -> list[str]:
    """A selection list for queries and tests; jobs take theirs from a file."""
    return feature_table_columns()[1:SELECTED_FEATURE_COUNT + 1]


# Trading parameters of the five derived instruments.
ASSET_ROWS = [
    ("VIEW", 50.0, 0.25, 12.5, 150.0, 3.0, 100.0, 150.0),
    ("CLICK", 20.0, 0.25, 5.0, 150.0, 7.5, 100.0, 150.0),
    ("ERROR", 10.0, 0.5, 5.0, 150.0, 15.0, 100.0, 150.0),
    ("SIGNUP", 5.0, 1.0, 5.0, 150.0, 30.0, 100.0, 150.0),
    ("PURCHASE", 100.0, 0.25, 25.0, 150.0, 1.5, 100.0, 150.0),
]
ASSET_SCHEMA = (
    "symbol string, price_per_point double, minimum_resolution_points double, "
    "price_per_tick double, maximum_drawdown double, points_to_maximum_drawdown double, "
    "target_profit double, stop_loss double"
)


def assets(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(ASSET_ROWS, ASSET_SCHEMA)


def dated_text(spark: SparkSession, folder: str) -> DataFrame:
    """Event times as text in three formats and one unusable form."""
    kind = F.col("event_id") % 4
    text = (
        F.when(kind == 0, F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
        .when(kind == 1, F.date_format("ts", "MM/dd/yyyy hh:mm:ss a"))
        .when(kind == 2, F.date_format("ts", "MM/dd/yy hh:mm:ss a"))
        .otherwise(F.lit("bad"))
    )
    return table(spark, folder, "events").select("event_id", text.alias("Date"))


def with_scores(df: DataFrame, total: int, key: str = "bar_id") -> DataFrame:
    """Two deterministic models' class probabilities from the key alone."""
    names = ("p_long", "p_short", "p_none")
    out = {}
    for model, shifted in (("boost", F.col(key)), ("forest", (F.col(key) + 1) % total)):
        parts = [
            (shifted * factor % modulus + 1).cast("double")
            for factor, modulus in ((7919, 11), (104729, 13), (1299709, 17))
        ]
        whole = parts[0] + parts[1] + parts[2]
        out |= {f"{model}_{n}": p / whole for n, p in zip(names, parts)}
    return df.withColumns(out)


def event_count(spark: SparkSession, folder: str) -> int:
    return table(spark, folder, "events").count()


def snapshots(spark: SparkSession, folder: str) -> DataFrame:
    """Open-trade snapshots keyed by trade type, designation and bars since entry."""
    scored = with_scores(bars(spark, folder), event_count(spark, folder))
    return scored.select(
        F.when(F.col("bar_id") % 2 == 0, "Long").otherwise("Short").alias("TradeType"),
        F.concat(F.lit("PV"), (F.col("bar_id") % 3 + 1).cast("string")).alias("TradeDesignation"),
        (F.col("bar_id") % 6 + 1).cast("int").alias("BarsSinceTradeEntry"),
        F.col("bar_id").alias("seq"),
        "RSI", "MACD", "HABodyRangeRatio", "MyWAZLTTrend",
        F.array("boost_p_long", "boost_p_short", "boost_p_none").alias("probabilities"),
    )


def requests(spark: SparkSession, folder: str) -> DataFrame:
    """Purchases ask for exits; a bar count of 7 never has a snapshot."""
    events = table(spark, folder, "events").where(F.col("event_type") == "purchase")
    return events.select(
        F.col("event_id").alias("request_id"),
        F.when(F.col("user_id") % 2 == 0, "Long").otherwise("Short").alias("TradeType"),
        F.concat(F.lit("PV"), (F.col("user_id") % 3 + 1).cast("string")).alias("TradeDesignation"),
        (F.col("user_id") % 7 + 1).cast("int").alias("BarsSinceTradeEntry"),
    )


# Class index to signal value; short models know two classes only.
CLASS_MAP_ROWS = [
    (kind, f"PV{n}", index, value)
    for n in (1, 2, 3)
    for kind, pairs in (("Long", ((0, -1), (1, 0), (2, 1))), ("Short", ((0, -1), (1, 1))))
    for index, value in pairs
]


def class_map(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(
        CLASS_MAP_ROWS, "TradeType string, TradeDesignation string, class_index int, value int")


def request_lines(spark: SparkSession, folder: str) -> DataFrame:
    """Requests as text lines; every twentieth is cut short."""
    full = F.concat_ws(
        " ", F.lit("a.json"), F.lit("c.json"), "TradeType", "TradeDesignation",
        F.col("BarsSinceTradeEntry").cast("string"), F.lit("models/es"))
    short = F.concat_ws(" ", F.lit("a.json"), F.lit("c.json"), "TradeType", "TradeDesignation")
    line = F.when(F.col("request_id") % 20 == 0, short).otherwise(full)
    return requests(spark, folder).select("request_id", line.alias("line"))
