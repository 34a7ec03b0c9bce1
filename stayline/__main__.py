"""Command line of the jobs; see ``stayline.workflow``."""

from __future__ import annotations

import argparse
import datetime as dt

from pyspark.sql import SparkSession

from stayline import workflow
from stayline.plans import modeling
from stayline.sources.schemas import REGIONS


def main() -> None:
    parser = argparse.ArgumentParser(prog="stayline")
    parser.add_argument("job", choices=["build", "train", "act", "describe"])
    parser.add_argument("--raw", help="folder of the raw tables")
    parser.add_argument("--out", required=True, help="folder of the results")
    parser.add_argument("--snapshot", type=dt.date.fromisoformat, default=dt.date(2025, 3, 31))
    parser.add_argument("--format", choices=["csv", "parquet"], default="csv")
    parser.add_argument("--regions", nargs="+", default=list(REGIONS))
    parser.add_argument("--model", default=workflow.BOOSTED)
    parser.add_argument("--exclude-churned", action="store_true")
    parser.add_argument("--quarters", nargs="+", help="quarters to describe, in order; all by default")
    parser.add_argument("--fit-on", choices=["train", "all"], default="train")
    parser.add_argument("--folds", type=int, default=modeling.FOLDS)
    parser.add_argument("--parallelism", type=int, default=4, help="fits submitted side by side")
    args = parser.parse_args()
    spark = SparkSession.builder.appName(f"stayline {args.job}").getOrCreate()
    if args.job == "build":
        workflow.build(spark, args.raw, args.out, args.snapshot, args.format, args.regions)
    elif args.job == "train":
        comparison = workflow.train(
            spark, args.out, args.regions, folds=args.folds, fit_on=args.fit_on, parallelism=args.parallelism
        )
        comparison.show(truncate=False)
        workflow.winner(comparison).show(truncate=False)
    elif args.job == "act":
        tables = workflow.act(
            spark, args.raw, args.out, args.model, args.format, args.regions, args.exclude_churned
        )
        tables["portfolio_summary"].show(truncate=False)
    else:
        workflow.describe(spark, args.raw, args.out, args.format, args.quarters)


if __name__ == "__main__":
    main()
