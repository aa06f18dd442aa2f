"""Column contract, categorical domains and trading parameters."""

from __future__ import annotations

from dataclasses import dataclass, field

# The column names and code domains of the input contract.
CONTINUOUS = [
    "Open", "High", "Low", "Close", "RSI", "MACD", "HABodyRangeRatio", "MyWAZLTTrend",
]
DOMAINS = {
    "MACDState": range(1, 17),
    "HAColor": range(1, 4),
    "HALongWick": range(1, 4),
    "HAGreenConsec": range(0, 51),
    "HARedConsec": range(0, 51),
    "EMAState": range(1, 17),
    "HAHighToEMALong": range(1, 4),
    "HACloseToEMALong": range(1, 4),
    "HALowToEMALong": range(1, 4),
    "HAHighToEMAShort": range(1, 4),
    "HACloseToEMAShort": range(1, 4),
    "HALowToEMAShort": range(1, 4),
}
DATE_FORMATS = ["yyyy-MM-dd HH:mm:ss", "M/d/yyyy h:mm:ss a", "M/d/yy h:mm:ss a"]
FEATURE_TABLE_WIDTH = 333
SELECTED_FEATURE_COUNT = 76
WINDOW_START, WINDOW_END = "08:35:00", "10:25:00"
BAR_SECONDS = 5
HORIZON = 6
LONG, SHORT, NO_TRADE = 0, 1, 2
SIGNAL_NAMES = {LONG: "Long", SHORT: "Short", NO_TRADE: "No Trade"}
TRADE_NAMES = {LONG: "LONG", SHORT: "SHORT", NO_TRADE: "NO_TRADE"}

CATEGORICAL = list(DOMAINS)
INPUT_FEATURES = CONTINUOUS + CATEGORICAL
LAGGED_CONTINUOUS = [f"{c}_lag1" for c in CONTINUOUS]
SCALED = CONTINUOUS + LAGGED_CONTINUOUS

# Row key of a bar. Bars of one symbol and day are ordered by time; bar_id breaks ties.
DAY_KEYS = ("symbol", "trading_day")
BAR_ORDER = ("Date", "bar_id")


def onehot_names(lagged: bool | None = None) -> list[str]:
    """Indicator names; per code the plain block comes before the lagged block."""
    names: list[str] = []
    for code, domain in DOMAINS.items():
        if lagged is not True:
            names += [f"{code}_{k}" for k in domain]
        if lagged is not False:
            names += [f"{code}_lag1_{k}" for k in domain]
    return names


def feature_table_columns() -> list[str]:
    return ["Date"] + CONTINUOUS + LAGGED_CONTINUOUS + onehot_names()


@dataclass(frozen=True)
class Asset:
    """Trading parameters of one instrument, in money per contract."""

    symbol: str = "ES"
    price_per_point: float = 50.0
    minimum_resolution_points: float = 0.25
    price_per_tick: float = 12.5
    maximum_drawdown: float = 150.0
    points_to_maximum_drawdown: float = 3.0
    target_profit: float = 100.0
    stop_loss: float = 150.0


@dataclass(frozen=True)
class LabelRule:
    """How candidate bars become labels."""

    min_profit: float = 30.0
    long_fraction: float = 0.75
    short_fraction: float = 0.50
    decay: float = 0.2
    weights: tuple[float, float, float] = field(default=(0.4, 0.3, 0.3))


DEFAULT_LABELS = LabelRule()
KEEP_ALL_LABELS = LabelRule(min_profit=40.0, long_fraction=1.0, short_fraction=1.0)
TOP_TENTH_LABELS = LabelRule(long_fraction=0.1, short_fraction=0.1)
