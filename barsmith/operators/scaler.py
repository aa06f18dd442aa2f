"""Standard scaling with population deviation, fitted on padded base columns."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barsmith.config import CONTINUOUS, SCALED

PRICES = CONTINUOUS[:4]


def _long(row: DataFrame, names: list[str], measures: list[str]) -> DataFrame:
    """One wide row ``<measure>_<name>`` to one row per name."""
    entries = ", ".join(
        f"'{n}', " + ", ".join(f"`{m}_{n}`" for m in measures) for n in names
    )
    heads = ", ".join(["column", *measures])
    return row.selectExpr(f"stack({len(names)}, {entries}) as ({heads})")


def profile(df: DataFrame, columns: list[str] = CONTINUOUS) -> DataFrame:
    """Smallest and largest value per column, one pass."""
    wide = df.agg(*[
        f(c).alias(f"{m}_{c}") for c in columns for m, f in (("min", F.min), ("max", F.max))
    ])
    return _long(wide, columns, ["min", "max"])


def _extreme(name: str, aggregate, factor: float, rsi: float) -> Column:
    if name in PRICES:
        return (aggregate(name) * F.lit(factor)).alias(name)
    return (F.lit(rsi) if name == "RSI" else aggregate(name)).alias(name)


def pad_extremes(df: DataFrame) -> DataFrame:
    """Add a low row (prices -20 %, RSI 0) and a high row (prices +20 %, RSI 100)."""
    base = df.select(*CONTINUOUS)
    ends = [
        F.struct(*[_extreme(c, aggregate, factor, rsi) for c in CONTINUOUS])
        for aggregate, factor, rsi in ((F.min, 0.8, 0.0), (F.max, 1.2, 100.0))
    ]
    both = base.agg(F.array(*ends).alias("ends")).select(F.inline("ends"))
    return base.unionByName(both)


def describe(df: DataFrame, columns: list[str] = CONTINUOUS) -> DataFrame:
    """Mean, population and sample deviation per column."""
    wide = df.agg(*[
        f(c).alias(f"{m}_{c}")
        for c in columns
        for m, f in (("mean", F.avg), ("std_pop", F.stddev_pop), ("std_samp", F.stddev_samp))
    ])
    return _long(wide, columns, ["mean", "std_pop", "std_samp"])


@dataclass(frozen=True)
class ScalerModel:
    """Fitted means and deviations; 16 numbers each, so they live in the plan as literals."""

    stats: dict[str, tuple[float, float]]

    def transform(self, df: DataFrame) -> DataFrame:
        """Scale the fitted columns that are present; others pass through."""
        return df.select(*[
            ((F.col(c) - self.stats[c][0]) / self.stats[c][1]).alias(c)
            if c in self.stats else F.col(c)
            for c in df.columns
        ])

    def to_frame(self, spark) -> DataFrame:
        rows = [(c, m, s) for c, (m, s) in self.stats.items()]
        return spark.createDataFrame(rows, "column string, mean double, std double")

    @classmethod
    def from_frame(cls, df: DataFrame) -> ScalerModel:
        return cls({r["column"]: (r["mean"], r["std"]) for r in df.collect()})


def fit(padded: DataFrame) -> ScalerModel:
    """Lagged columns share the statistics of their base column; deviation 0 divides by 1."""
    stats = {
        r["column"]: (r["mean"], r["std_pop"] or 1.0)
        for r in describe(padded, CONTINUOUS).collect()
    }
    return ScalerModel({c: stats[c.removesuffix("_lag1")] for c in SCALED})


def verify(before: DataFrame, after: DataFrame, columns: list[str] = CONTINUOUS) -> DataFrame:
    """Mean and sample deviation of every column before and after scaling."""
    stages = [
        describe(df, columns).select("column", F.lit(stage).alias("stage"), "mean", "std_samp")
        for stage, df in (("before", before), ("after", after))
    ]
    return stages[0].unionByName(stages[1])
