"""Command line: ``python -m review_pulse <job> ...`` or through spark-submit."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from review_pulse.operators.models import FAMILIES
from review_pulse.plans import jobs
from review_pulse.sources import messages, tables
from review_pulse.streaming import refresh, scoring, versions


def _options(pairs: list[str]) -> dict[str, str]:
    return dict(pair.split("=", 1) for pair in pairs)


def _trigger(args: argparse.Namespace) -> dict | None:
    if args.available_now:
        return {"availableNow": True}
    return {"processingTime": args.every} if args.every else None


def _add_trigger(parser: argparse.ArgumentParser) -> None:
    parser.add_argument("--every", metavar="INTERVAL", help="micro-batch interval, such as '1 minute'")
    parser.add_argument("--available-now", action="store_true", help="process what is there, then stop")


def build_parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="review_pulse")
    sub = parser.add_subparsers(dest="job", required=True)

    curate = sub.add_parser("curate", help="raw JSON lines to the curated table")
    curate.add_argument("source")
    curate.add_argument("target")
    curate.add_argument("--csv", help="also write the columns as CSV")

    train = sub.add_parser("train", help="fit, evaluate and save a model")
    train.add_argument("source")
    train.add_argument("model_path")
    train.add_argument("--family", choices=FAMILIES, default="svm")
    train.add_argument("--order", choices=("split_first", "legacy"), default="split_first")
    train.add_argument("--test-export")

    publish = sub.add_parser("publish", help="send curated rows as messages")
    publish.add_argument("source")
    publish.add_argument("--format", default="text")
    publish.add_argument("--option", action="append", default=[], metavar="KEY=VALUE")

    score = sub.add_parser("score", help="score a message stream")
    score.add_argument("models_base")
    score.add_argument("target")
    score.add_argument("marts")
    score.add_argument("checkpoint")
    score.add_argument("--model")
    score.add_argument("--quarantine")
    score.add_argument("--lemmatize", action="store_true", help="normalise texts as in training")
    score.add_argument("--format", default="text")
    score.add_argument("--option", action="append", default=[], metavar="KEY=VALUE")
    score.add_argument("--merge-every", type=int, metavar="BATCHES", help="merge the folders of so many batches")
    _add_trigger(score)

    preview = sub.add_parser("preview", help="print decoded messages as they come")
    preview.add_argument("checkpoint")
    preview.add_argument("--format", default="text")
    preview.add_argument("--option", action="append", default=[], metavar="KEY=VALUE")
    _add_trigger(preview)

    trend = sub.add_parser("trend", help="keep the daily trend of a predictions table, corrected by late rows")
    trend.add_argument("predictions")
    trend.add_argument("target")
    trend.add_argument("checkpoint")
    trend.add_argument("--lateness-hours", type=float, default=24)
    trend.add_argument("--horizon-days", type=float, default=30)
    trend.add_argument("--merge-every", type=int, metavar="BATCHES")
    _add_trigger(trend)

    use = sub.add_parser("use", help="put a stored model into use for the later batches of scoring streams")
    use.add_argument("models_base")
    use.add_argument("model")

    merge = sub.add_parser("merge", help="merge the folders of stored batches and of their partial results")
    merge.add_argument("predictions")
    merge.add_argument("marts")
    merge.add_argument("--everything", action="store_true", help="into one folder, however few there are")
    merge.add_argument("--vacuum", action="store_true", help="delete folders that no reader needs any more")

    show = sub.add_parser("dashboard", help="print every dashboard panel")
    show.add_argument("predictions")
    show.add_argument("--marts", help="read the partial results a scoring stream keeps")
    show.add_argument("--days", type=int, default=7)
    show.add_argument("--limit", type=int, default=10)
    show.add_argument("--asin")
    return parser


def main(argv: list[str] | None = None) -> None:
    args = build_parser().parse_args(argv)
    spark = (
        SparkSession.builder.appName(f"review_pulse {args.job}")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    if args.job == "curate":
        jobs.run_curate(spark, args.source, args.target, args.csv)
    elif args.job == "train":
        jobs.run_train(spark, args.source, args.model_path, args.family, args.order, args.test_export)
    elif args.job == "publish":
        messages.publish(tables.read_curated(spark, args.source), args.format, **_options(args.option))
    elif args.job == "score":
        query = jobs.run_score(
            spark, args.models_base, args.target, args.marts, args.checkpoint,
            source_format=args.format, model_name=args.model, quarantine=args.quarantine,
            lemmatize=args.lemmatize, merge_every=args.merge_every,
            trigger=_trigger(args), **_options(args.option),
        )
        scoring.await_all([query])
    elif args.job == "preview":
        stream = messages.read_stream(spark, args.format, **_options(args.option))
        scoring.await_all([scoring.console_preview(stream, args.checkpoint, _trigger(args))])
    elif args.job == "trend":
        jobs.run_trend(
            spark, args.predictions, args.target, args.checkpoint, args.lateness_hours, args.horizon_days,
            args.merge_every, _trigger(args))
    elif args.job == "use":
        print(f"entry {versions.put_into_use(spark, args.models_base, args.model)}: {args.model}")
    elif args.job == "merge":
        jobs.run_merge(spark, args.predictions, args.marts, args.everything, args.vacuum)
    else:
        predictions = tables.read_predictions(spark, args.predictions)
        options = {"days_back": args.days, "limit": args.limit, "asin": args.asin}
        panels = (
            refresh.panels(spark, predictions, args.marts, **options)
            if args.marts else jobs.dashboard(predictions, **options)
        )
        for name, panel in panels.items():
            print(name)
            panel.show(truncate=False)


if __name__ == "__main__":
    main()
