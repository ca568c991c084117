"""Command line: ``spark-submit`` or ``python -m txnstar`` with a job's name.

The master, credentials and connectors come from the Spark configuration.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from txnstar.plans.jobs import PipelineConfig, run_load, run_pipeline, run_transform
from txnstar.sources.warehouse import create_warehouse
from txnstar.streaming.ingest import ingest_landing


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="txnstar")
    jobs = parser.add_subparsers(dest="job", required=True)

    def job(name: str, *required: str) -> argparse.ArgumentParser:
        sub = jobs.add_parser(name)
        for option in required:
            sub.add_argument(f"--{option}", required=True)
        return sub

    def sink(sub: argparse.ArgumentParser) -> None:
        sub.add_argument("--format", default="table", help="table, or a connector such as jdbc")
        sub.add_argument("--option", action="append", default=[], metavar="NAME=VALUE")

    def source(sub: argparse.ArgumentParser) -> None:
        sub.add_argument("--archive")
        sub.add_argument("--date", help="ingest date, today by default")
        sub.add_argument("--batch-bytes", type=int, help="most bytes of drops in one batch")

    source(job("ingest", "landing", "raw", "checkpoint"))
    transform = job("transform", "raw", "staged")
    transform.add_argument("--raw-format", choices=["csv", "parquet"], default="parquet")
    transform.add_argument("--infer-schema", action="store_true", help="type CSV values as read")
    sink(job("load", "staged", "target"))
    create = job("create-warehouse", "target")
    create.add_argument("--location")
    run = job("run", "landing", "raw", "checkpoint", "staged", "target")
    source(run)
    sink(run)
    return parser


def main(argv: list[str] | None = None) -> None:
    args = _parser().parse_args(argv)
    builder = SparkSession.builder.appName(f"txnstar-{args.job}")
    spark = builder.getOrCreate()
    if args.job == "ingest":
        ingest_landing(
            spark,
            args.landing,
            args.raw,
            args.checkpoint,
            args.archive,
            args.date,
            args.batch_bytes,
        )
    elif args.job == "transform":
        audit = run_transform(spark, args.raw, args.staged, args.raw_format, args.infer_schema)
        audit.show(truncate=False)
    elif args.job == "load":
        loaded = run_load(spark, args.staged, args.target, args.format, _options(args.option))
        loaded.show(truncate=False)
    elif args.job == "create-warehouse":
        create_warehouse(spark, args.target, args.location)
    else:
        cfg = PipelineConfig(
            landing=args.landing,
            raw_root=args.raw,
            checkpoint=args.checkpoint,
            staged_root=args.staged,
            target=args.target,
            archive=args.archive,
            fmt=args.format,
            options=_options(args.option),
            ingest_date=args.date,
            max_bytes_per_trigger=args.batch_bytes,
        )
        run_pipeline(spark, cfg).show(truncate=False)


def _options(pairs: list[str]) -> dict[str, str]:
    return dict(pair.split("=", 1) for pair in pairs)


if __name__ == "__main__":
    main()
