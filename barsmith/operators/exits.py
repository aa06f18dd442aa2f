"""Six-bar exit simulation: entry at the next open, first stop or target ends the trade."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barsmith.config import HORIZON, Asset
from barsmith.functions import dates
from barsmith.functions.money import Rules
from barsmith.operators.features import day_order
from barsmith.operators.ordered import RowOrder, ordered_columns

STEPS = range(1, HORIZON + 1)
BAR_FIELDS = ("Date", "Open", "High", "Low", "Close")


def add_horizon(df: DataFrame, order: RowOrder | None = None) -> DataFrame:
    """Add ``bar1`` .. ``bar6``: the next bars of the day, null beyond its end."""
    bar = F.struct(*BAR_FIELDS)
    nexts = {f"bar{j}": (lambda window, j=j: F.lead(bar, j).over(window)) for j in STEPS}
    return ordered_columns(df, order or day_order(df), nexts, ahead=HORIZON)


def bar(j: int, name: str) -> Column:
    return F.col(f"bar{j}").getField(name)


def is_valid() -> Column:
    """The signal bar is in the window and six bars of its day follow."""
    return F.col("InWindow") & F.col(f"bar{HORIZON}").isNotNull()


def entry_price() -> Column:
    return bar(1, "Open")


def stop_hit(rules: Rules, long: bool, j: int) -> Column:
    against = entry_price() - bar(j, "Low") if long else bar(j, "High") - entry_price()
    return rules.value(against) >= rules.stop


def gain(rules: Rules, long: bool, price: Column) -> Column:
    return rules.value(price - entry_price() if long else entry_price() - price)


def target_hit(rules: Rules, long: bool, j: int, intrabar: bool = False) -> Column:
    price = bar(j, ("High" if long else "Low") if intrabar else "Close")
    return gain(rules, long, price) >= rules.target


def exit_bar(rules: Rules, long: bool) -> Column:
    """First bar that hits stop or target, else the last."""
    hits = [F.when(stop_hit(rules, long, j) | target_hit(rules, long, j), j) for j in STEPS]
    return F.coalesce(*hits, F.lit(HORIZON))


def last_hit_bar(rules: Rules, long: bool) -> Column:
    """Variant: target tested inside the bar, and the last hit counts."""
    hits = [
        F.when(stop_hit(rules, long, j) | target_hit(rules, long, j, intrabar=True), j)
        for j in reversed(STEPS)
    ]
    return F.coalesce(*hits, F.lit(HORIZON))


def at_exit(field: str, exit_column: str) -> Column:
    """A field of the bar the trade ends at."""
    values = F.array(*[bar(j, field) for j in STEPS])
    return F.element_at(values, F.col(exit_column))


def _zero_unless_valid(value: Column) -> Column:
    return F.when(is_valid(), value).otherwise(F.lit(0.0))


def simulate(df: DataFrame, rules: Rules | None = None, order: RowOrder | None = None,
             last_hit: bool = False) -> DataFrame:
    """Exit bars and base profits of both sides; profits are 0 without a full horizon.

    Columns of ``df`` are kept, and so are the horizon bars for operators downstream.
    """
    rules = rules or Rules.of(Asset())
    find = last_hit_bar if last_hit else exit_bar
    flagged = df if "InWindow" in df.columns else df.withColumn(
        "InWindow", dates.in_window(F.col("Date")))
    bars = add_horizon(flagged, order)
    exits = bars.select(
        "*",
        is_valid().alias("is_valid"),
        find(rules, True).alias("long_exit_bar"),
        find(rules, False).alias("short_exit_bar"),
    )
    profits = {
        f"{side}_profit": _zero_unless_valid(
            gain(rules, side == "long", at_exit("Close", f"{side}_exit_bar"))
        )
        for side in ("long", "short")
    }
    return exits.withColumns(profits)


def _path(field: str, upto: Column) -> Column:
    """Values of a field over the bars 1 .. ``upto``."""
    return F.slice(F.array(*[bar(j, field) for j in STEPS]), F.lit(1), upto)


def clamp(simulated: DataFrame, rules: Rules | None = None) -> DataFrame:
    """Variant: the full stop is lost when the drawdown up to the exit reached it; gains end
    at the target."""
    rules = rules or Rules.of(Asset())
    worst = {
        "long_drawdown": rules.value(
            entry_price() - F.array_min(_path("Low", F.col("long_exit_bar")))),
        "short_drawdown": rules.value(
            F.array_max(_path("High", F.col("short_exit_bar"))) - entry_price()),
    }
    clamped = {
        f"{side}_clamped": _zero_unless_valid(
            F.when(F.col(f"{side}_drawdown") >= rules.stop, -rules.stop)
            .otherwise(F.least(F.col(f"{side}_profit"), rules.target))
        )
        for side in ("long", "short")
    }
    return simulated.withColumns(worst).withColumns(clamped)


VARIANTS = ("base", "clamped", "last_hit")


def profits(df: DataFrame, rules: Rules | None = None, order: RowOrder | None = None,
            variant: str = "base") -> DataFrame:
    """``simulate`` with the profits of a variant in the profit columns."""
    if variant not in VARIANTS:
        raise ValueError(f"Unknown variant {variant}; known: {VARIANTS}")
    out = simulate(df, rules, order, last_hit=variant == "last_hit")
    if variant != "clamped":
        return out
    limited = clamp(out, rules)
    return limited.select(*[
        F.col(c.replace("_profit", "_clamped")).alias(c)
        if c in ("long_profit", "short_profit") else F.col(c)
        for c in out.columns
    ])


def max_excursion(clamped: DataFrame, rules: Rules | None = None) -> DataFrame:
    """Best price reached in six bars, or up to the worst bar when the stop was hit."""
    rules = rules or Rules.of(Asset())
    lows, highs = F.col("long_exit_bar"), F.col("short_exit_bar")
    low_path, high_path = _path("Low", lows), _path("High", highs)
    long_until = F.when(
        F.col("long_drawdown") >= rules.stop,
        F.array_position(low_path, F.array_min(low_path)).cast("int"),
    ).otherwise(F.lit(HORIZON))
    short_until = F.when(
        F.col("short_drawdown") >= rules.stop,
        F.array_position(high_path, F.array_max(high_path)).cast("int"),
    ).otherwise(F.lit(HORIZON))
    return clamped.withColumns({
        "max_long_profit": _zero_unless_valid(
            gain(rules, True, F.array_max(_path("High", long_until)))),
        "max_short_profit": _zero_unless_valid(
            gain(rules, False, F.array_min(_path("Low", short_until)))),
    })
