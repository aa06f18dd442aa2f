"""Money value of price moves, rewards, ratios and decision rules."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column
from pyspark.sql import functions as F

from barsmith.config import LONG, NO_TRADE, SHORT, Asset


@dataclass(frozen=True)
class Rules:
    """Exit parameters as columns, so one plan serves one asset or a joined asset table."""

    per_point: Column
    resolution: Column
    target: Column
    stop: Column

    @cached_property
    def per_tick(self) -> Column:
        return self.per_point * self.resolution

    @classmethod
    def of(cls, asset: Asset) -> Rules:
        return cls(
            F.lit(asset.price_per_point),
            F.lit(asset.minimum_resolution_points),
            F.lit(asset.target_profit),
            F.lit(asset.stop_loss),
        )

    @classmethod
    def joined(cls) -> Rules:
        return cls(
            F.col("price_per_point"),
            F.col("minimum_resolution_points"),
            F.col("target_profit"),
            F.col("stop_loss"),
        )

    def value(self, move: Column) -> Column:
        """Ticks first, then money: the order decides the last bits of the double."""
        return (move / self.resolution) * self.per_tick


def reward(profit: Column, penalty: Column, decay: float) -> Column:
    """Reward of taking a side that made ``profit``; full profit only above 30."""
    shortfall = -penalty * F.exp(F.lit(-decay) * (profit - F.lit(10.0)))
    return (
        F.when(profit > 30, profit)
        .when(profit > 10, shortfall)
        .otherwise(-penalty)
    )


def reward_of(action: Column, long_profit: Column, short_profit: Column, penalty: Column,
              decay: float) -> Column:
    return (
        F.when(action == LONG, reward(long_profit, penalty, decay))
        .when(action == SHORT, reward(short_profit, penalty, decay))
        .otherwise(F.lit(0.0))
    )


def profit_ratio(own: Column, other: Column) -> Column:
    """Own profit per unit of the other side; the own profit where the other is zero."""
    return F.when(other != 0, own / F.abs(other)).otherwise(own)


def blended_action(p_long: Column, p_short: Column, p_none: Column) -> Column:
    """Evaluation rule: the side beats No-Trade strictly; Short wins a tie with Long."""
    return (
        F.when((p_long > p_short) & (p_long > p_none), LONG)
        .when((p_short >= p_long) & (p_short > p_none), SHORT)
        .otherwise(NO_TRADE)
    )


def threshold_action(p_long: Column, p_short: Column, p_none: Column,
                     floor: float = 0.3) -> Column:
    """Tuning rule: a side needs more than the floor and must be strictly largest."""
    return (
        F.when((p_long > floor) & (p_long > p_short) & (p_long > p_none), LONG)
        .when((p_short > floor) & (p_short > p_long) & (p_short > p_none), SHORT)
        .otherwise(NO_TRADE)
    )


def name_of(code: Column, names: dict[int, str], default: str) -> Column:
    named = F.when(F.lit(False), F.lit(default))
    for value, text in names.items():
        named = named.when(code == value, F.lit(text))
    return named.otherwise(F.lit(default))
