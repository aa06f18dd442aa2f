"""Command line: features, scaler and training from files of raw bars."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from barsmith import jobs
from barsmith.config import Asset
from barsmith.operators import exits
from barsmith.session import configure
from barsmith.sources import readers, writers


def _asset(spark: SparkSession, path: str | None, symbol: str) -> Asset:
    if path is None:
        return Asset(symbol)
    row = readers.read_assets(spark, path).where(F.col("symbol") == symbol).first()
    if row is None:
        raise ValueError(f"No parameters for symbol {symbol} in {path}")
    return Asset(**row.asDict())


def main() -> None:
    parser = argparse.ArgumentParser(prog="barsmith")
    parser.add_argument("job", choices=["features", "scaler", "train"])
    parser.add_argument("--bars", required=True)
    parser.add_argument("--format", default="csv")
    parser.add_argument("--output", required=True)
    parser.add_argument("--symbol", default="ES")
    parser.add_argument("--assets")
    parser.add_argument("--scaler")
    parser.add_argument("--selection")
    parser.add_argument("--profits", default="base", choices=exits.VARIANTS)
    parser.add_argument("--cutoff", default="2025-07-07 08:30:00")
    args = parser.parse_args()
    missing = [n for n in ("scaler", "selection") if args.job == "train" and not getattr(args, n)]
    if missing:
        parser.error("train needs " + ", ".join(f"--{n}" for n in missing))

    spark = configure(SparkSession.builder.appName("barsmith").getOrCreate())
    bars = jobs.prepare_bars(spark, args.bars, args.format, args.symbol)
    if args.job == "features":
        jobs.build_features(spark, bars, args.output)
    elif args.job == "scaler":
        jobs.build_scaler(spark, bars, args.output)
    else:
        result = jobs.train(
            spark, bars, writers.load_scaler(spark, args.scaler), args.cutoff,
            readers.read_selection(spark, args.selection),
            _asset(spark, args.assets, args.symbol), variant=args.profits)
        jobs.save(result, args.output, args.symbol)
        result.summary.show(truncate=False)


if __name__ == "__main__":
    main()
