"""Previous bar and trade exits on a stream, keyed by symbol and day.

Bars of a key are taken in order of time. A bar older than the newest one already taken is
late: it is reported with ``late`` set and does not touch the state. Bars older than the
watermark do not reach the operator; the query's progress counts them. State is dropped once
the watermark is an hour past the key's newest bar. State holds one bar or six. A call sorts
the bars of its key in one micro-batch: at most 17 280 for a day of five-second bars, and
never more than the micro-batch, whose size the source bounds (``files_per_trigger``).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from barsmith.config import (
    CATEGORICAL, CONTINUOUS, DAY_KEYS, HORIZON, INPUT_FEATURES, LONG, NO_TRADE, SHORT,
    TRADE_NAMES, Asset,
)

DELAY = "10 minutes"
_IDLE_MS = 3_600_000


def _timed(stream: DataFrame, delay: str) -> DataFrame:
    """Watermarks need a zoned time; the session zone is UTC, so the clock stays as it is."""
    return stream.withColumn("Date", F.col("Date").cast("timestamp_ltz")).withWatermark("Date", delay)


def _sorted(frames: Iterator[pd.DataFrame]) -> pd.DataFrame:
    bars = pd.concat(list(frames), ignore_index=True)
    return bars.sort_values(["Date", "bar_id"], kind="stable", ignore_index=True)


def _micros(times: pd.Series) -> np.ndarray:
    return times.astype("datetime64[us]").astype("int64").to_numpy()


def _split_late(bars: pd.DataFrame, newest: tuple[int, int] | None):
    if newest is None:
        return bars.iloc[:0], bars
    at = _micros(bars["Date"])
    late = (at < newest[0]) | ((at == newest[0]) & (bars["bar_id"].to_numpy() <= newest[1]))
    return bars[late], bars[~late]


def _keep_until(state: GroupState, newest_micros: int) -> None:
    """Drop the state an hour of event time after the newest bar."""
    wanted = newest_micros // 1000 + _IDLE_MS
    state.setTimeoutTimestamp(max(wanted, state.getCurrentWatermarkMs() + 1))


def lag_stream(stream: DataFrame, delay: str = DELAY) -> DataFrame:
    """Lag-1 of all inputs within symbol and day; 0 for the first bar or a missing value."""
    lag_types = {c: "double" for c in CONTINUOUS} | {c: "int" for c in CATEGORICAL}
    outputs = ", ".join(f"{c}_lag1 {t}" for c, t in lag_types.items())
    remembered = ", ".join(f"{c} double" for c in INPUT_FEATURES)

    def step(key, frames, state: GroupState):
        if state.hasTimedOut:
            state.remove()
            return
        bars = _sorted(frames)
        last = state.get if state.exists else None
        late, fresh = _split_late(bars, last[:2] if last else None)
        values = fresh[INPUT_FEATURES].astype(float)
        if len(fresh):
            before = values.shift(1)
            if last:
                before.iloc[0] = list(last[2:])
            out = before.fillna(0.0).astype({c: "int32" for c in CATEGORICAL})
            out.columns = [f"{c}_lag1" for c in INPUT_FEATURES]
            ids = fresh[["bar_id", *DAY_KEYS, "Date"]]
            yield pd.concat([ids, out, pd.Series(False, index=out.index, name="late")], axis=1)
            newest = int(_micros(fresh["Date"])[-1])
            state.update((newest, int(fresh["bar_id"].iloc[-1]),
                          *[float(v) for v in values.iloc[-1]]))
            _keep_until(state, newest)
        if len(late):
            lost = late[["bar_id", *DAY_KEYS, "Date"]].assign(
                **{f"{c}_lag1": None for c in INPUT_FEATURES}, late=True)
            yield lost

    timed = _timed(stream.select("bar_id", *DAY_KEYS, "Date", *INPUT_FEATURES), delay)
    return timed.groupBy(*DAY_KEYS).applyInPandasWithState(
        step,
        f"bar_id long, symbol string, trading_day date, Date timestamp_ltz, {outputs}, late boolean",
        f"newest long, newest_id long, {remembered}",
        "append",
        GroupStateTimeout.EventTimeTimeout,
    ).withColumn("Date", F.col("Date").cast("timestamp_ntz"))


_HELD = {
    "bar_id": "long", "Date": "long", "Open": "double", "High": "double", "Low": "double",
    "Close": "double", "InWindow": "boolean", "predicted": "int", "reported": "boolean",
}


def exit_stream(stream: DataFrame, asset: Asset = Asset(), wait_for_horizon: bool = True,
                delay: str = DELAY) -> DataFrame:
    """Trade per in-window bar of a stream with decisions (``predicted``, ``InWindow``).

    With ``wait_for_horizon`` a trade is reported when its sixth bar has arrived, so the rows
    equal the batch list; without it, as soon as stop or target is hit. Trades whose day ends
    before they are decided are never reported. The state holds the last six bars.
    """
    def step(key, frames, state: GroupState):
        if state.hasTimedOut:
            state.remove()
            return
        bars = _sorted(frames).assign(reported=False)
        held = _restore(state.get) if state.exists else None
        newest = None
        if held is not None and len(held):
            newest = (int(_micros(held["Date"])[-1]), int(held["bar_id"].iloc[-1]))
        late, fresh = _split_late(bars, newest)
        known = fresh[list(_HELD)] if held is None else pd.concat(
            [held, fresh[list(_HELD)]], ignore_index=True)
        if len(known):
            trades, known = _decide(known.reset_index(drop=True), asset, wait_for_horizon)
            if len(trades):
                yield trades.assign(symbol=key[0], trading_day=key[1], late=False)[_TRADE_COLUMNS]
            tail = known.tail(HORIZON)
            state.update(_store(tail))
            _keep_until(state, int(_micros(tail["Date"])[-1]))
        if len(late):
            blank = {c: None for c in _TRADE_COLUMNS}
            yield pd.DataFrame([
                {**blank, "bar_id": i, "symbol": key[0], "trading_day": key[1], "late": True}
                for i in late["bar_id"]
            ])[_TRADE_COLUMNS]

    columns = ["bar_id", *DAY_KEYS, *[c for c in _HELD if c not in ("bar_id", "reported")]]
    timed = _timed(stream.select(*columns), delay)
    arrays = ", ".join(f"{c} array<{t}>" for c, t in _HELD.items())
    out = timed.groupBy(*DAY_KEYS).applyInPandasWithState(
        step, _TRADE_SCHEMA, arrays, "append", GroupStateTimeout.EventTimeTimeout)
    return out.withColumns({
        c: F.col(c).cast("timestamp_ntz") for c in ("EntryDateTime", "ExitDateTime")})


_TRADE_SCHEMA = (
    "bar_id long, symbol string, trading_day date, Trade_Signal string, "
    "EntryDateTime timestamp_ltz, EntryPrice double, ExitDateTime timestamp_ltz, ExitPrice double, "
    "BaseProfit double, ExitBar int, ExitReason string, late boolean"
)
_TRADE_COLUMNS = [part.split()[0] for part in _TRADE_SCHEMA.split(", ")]


def _store(bars: pd.DataFrame) -> tuple:
    plain = bars.assign(Date=_micros(bars["Date"]))
    return tuple(plain[c].tolist() for c in _HELD)


def _restore(stored: tuple) -> pd.DataFrame:
    bars = pd.DataFrame(dict(zip(_HELD, map(list, stored), strict=True)))
    return bars.assign(Date=pd.to_datetime(bars["Date"], unit="us"))


def _decide(bars: pd.DataFrame, asset: Asset, wait: bool) -> tuple[pd.DataFrame, pd.DataFrame]:
    """Trades that can be reported now, and the bars with those marked as reported."""
    n = len(bars)
    later = n - 1 - np.arange(n)
    action = bars["predicted"].to_numpy()
    entry = bars["Open"].shift(-1).to_numpy()
    end = np.zeros(n, dtype=int)
    reason = np.full(n, None, dtype=object)
    per_tick = asset.price_per_point * asset.minimum_resolution_points

    def value(move):
        return (move / asset.minimum_resolution_points) * per_tick

    for j in range(1, HORIZON + 1):
        low, high, close = (bars[c].shift(-j).to_numpy() for c in ("Low", "High", "Close"))
        long, short = action == LONG, action == SHORT
        stopped = (long & (value(entry - low) >= asset.stop_loss)) | (
            short & (value(high - entry) >= asset.stop_loss))
        gained = (long & (value(close - entry) >= asset.target_profit)) | (
            short & (value(entry - close) >= asset.target_profit))
        for hit, name in ((stopped, "STOP_LOSS"), (gained, "TARGET_PROFIT")):
            now = hit & (end == 0)
            end[now], reason[now] = j, name
    undecided = (end == 0) & (later >= HORIZON)
    end[undecided] = HORIZON
    reason[undecided] = np.where(action[undecided] == NO_TRADE, "NO_TRADE", "HARD_EXIT")
    ready = (end > 0) & ((later >= HORIZON) if wait else True)
    ready &= bars["InWindow"].to_numpy(dtype=bool) & ~bars["reported"].to_numpy(dtype=bool)

    row = np.nonzero(ready)[0]
    out, nxt = row + end[row], row + 1
    price, first = bars["Close"].to_numpy()[out], entry[row]
    direction = np.select([action[row] == LONG, action[row] == SHORT], [1.0, -1.0], 0.0)
    move = np.where(direction < 0, first - price, price - first)
    trades = pd.DataFrame({
        "bar_id": bars["bar_id"].to_numpy()[row],
        "Trade_Signal": [TRADE_NAMES.get(a, "NO_TRADE") for a in action[row]],
        "EntryDateTime": bars["Date"].to_numpy()[nxt], "EntryPrice": first,
        "ExitDateTime": bars["Date"].to_numpy()[out], "ExitPrice": price,
        "BaseProfit": np.where(direction == 0, 0.0, move * asset.price_per_point),
        "ExitBar": end[row].astype("int32"), "ExitReason": reason[row],
    })
    return trades, bars.assign(reported=bars["reported"].to_numpy(dtype=bool) | ready)
