"""Small tables for tests."""

import datetime as dt

from barsmith.config import CATEGORICAL, CONTINUOUS

BAR = (
    "bar_id long, symbol string, trading_day date, Date timestamp_ntz, Open double, High double, "
    "Low double, Close double, InWindow boolean"
)


def price_bars(spark, prices, start="2025-07-20 09:12:40", step=5, in_window=None, symbol="ES"):
    """Bars from (open, high, low, close) rows; by default only the first is in the window."""
    first = dt.datetime.fromisoformat(start)
    rows = []
    for i, p in enumerate(prices):
        at = first + dt.timedelta(seconds=step * i)
        inside = i == 0 if in_window is None else in_window[i]
        rows.append((i, symbol, at.date(), at, *map(float, p), inside))
    return spark.createDataFrame(rows, BAR)


def full_bars(spark, rows):
    """Bars with all inputs from dicts; what a dict leaves out is 1."""
    kinds = {c: "double" for c in CONTINUOUS} | {c: "int" for c in CATEGORICAL}
    schema = "bar_id long, symbol string, trading_day date, Date timestamp_ntz, " + ", ".join(
        f"{c} {k}" for c, k in kinds.items())
    out = []
    for i, row in enumerate(rows):
        at = dt.datetime.fromisoformat(row["Date"])
        values = [row.get(c, 1.0 if k == "double" else 1) for c, k in kinds.items()]
        out.append((row.get("bar_id", i), row.get("symbol", "ES"), at.date(), at, *values))
    return spark.createDataFrame(out, schema)
