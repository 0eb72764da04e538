"""Jobs: explore, train, score, stream.

    python -m wayfare explore --trips trips.csv --clean clean/ --reports reports/
    python -m wayfare train --clean clean/ --model model/ --metrics metrics/
    python -m wayfare score --requests requests.csv --model model/ --out scored/ --rejected rejected/
    python -m wayfare stream --requests incoming/ --model model/ --out scored/ --rejected rejected/ --checkpoint log/
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from wayfare.operators import metrics, stats, tuning
from wayfare.plans import explore, serve, train
from wayfare.schema import REQUEST_SCHEMA
from wayfare.sources import models, scratch, sinks
from wayfare.sources.trips import read_trips_csv, read_trips_parquet, stream_requests
from wayfare.streaming.score import start_serving


def _model(args: argparse.Namespace):
    """The model that was asked for; without one at the path the rule scores only if ``--fall-back`` says so."""
    if not args.model:
        return None
    model = models.load_model(args.model)
    if model is None and not args.fall_back:
        raise SystemExit(f"no model at {args.model}; --fall-back scores by rule")
    return model


def run_explore(spark: SparkSession, args: argparse.Namespace) -> None:
    with scratch.scope(spark):
        funnel = None
        if args.format == "csv":
            trips, rejected, funnel = explore.ingest_csv(spark, args.trips, args.table or scratch.run_dir(spark, "trips"))
            if args.reports:
                sinks.export_csv(rejected, f"{args.reports}/malformed")
        else:
            trips = read_trips_parquet(spark, args.trips)
        explore.explore(spark, trips, args.clean, args.reports, rebalance=args.rebalance, funnel=funnel)


def run_train(spark: SparkSession, args: argparse.Namespace) -> None:
    read = sinks.read_clean_csv if args.format == "csv" else sinks.read_clean
    clean = read(spark, args.clean)
    _, table, comparison = train.train_and_save(clean, args.model)
    sinks.export_csv(table, args.metrics)
    if args.residuals:
        name = metrics.best_model(table).first()["model"]
        column = next(v.prediction for v in train.COMPARED if v.name == name)
        left = metrics.residuals(comparison.predictions, column)
        sinks.export_csv(stats.group_profile(left, "pickup_hour", "residual_sec"), args.residuals)
    if args.grid:
        sinks.export_csv(tuning.score_table(clean, comparison.tuned), args.grid)


def run_score(spark: SparkSession, args: argparse.Namespace) -> None:
    if args.format == "csv":
        requests = read_trips_csv(spark, args.requests, schema=REQUEST_SCHEMA)
    else:
        requests = read_trips_parquet(spark, args.requests)
    serve.write_scored(requests, args.out, args.rejected, _model(args))


def run_stream(spark: SparkSession, args: argparse.Namespace) -> None:
    requests = stream_requests(spark, args.requests)
    start_serving(requests, args.out, args.rejected, args.checkpoint, _model(args), once=args.once).awaitTermination()


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="wayfare")
    jobs = top.add_subparsers(dest="job", required=True)

    def job(name: str, run, required: tuple[str, ...], optional: tuple[str, ...] = ()) -> argparse.ArgumentParser:
        sub = jobs.add_parser(name)
        for option in required:
            sub.add_argument(f"--{option}", required=True)
        for option in optional:
            sub.add_argument(f"--{option}")
        sub.set_defaults(run=run)
        return sub

    exploring = job("explore", run_explore, ("trips", "clean"), ("reports", "table"))
    exploring.add_argument("--rebalance", action=argparse.BooleanOptionalAction, default=True)
    training = job("train", run_train, ("clean", "model", "metrics"), ("residuals", "grid"))
    scoring = job("score", run_score, ("requests", "out", "rejected"), ("model",))
    stream = job("stream", run_stream, ("requests", "out", "rejected", "checkpoint"), ("model",))
    for sub, usual in ((exploring, "csv"), (training, "parquet"), (scoring, "csv")):
        sub.add_argument("--format", choices=("csv", "parquet"), default=usual, help="of the input")
    for sub in (scoring, stream):
        sub.add_argument("--fall-back", action="store_true", help="score by rule if there is no model at the path")
    stream.add_argument("--once", action="store_true", help="drain what is there, then stop")
    return top


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    args.run(SparkSession.builder.appName(f"wayfare {args.job}").getOrCreate(), args)


if __name__ == "__main__":
    main()
