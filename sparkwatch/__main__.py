"""Command line for spark-submit: ``batch``, ``feed``, ``alerts`` and ``compact``."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from .functions.matching import Lexicon
from .operators.alerts import EntityRules
from .operators.rollups import build_rollup
from .plans import starter
from .plans.batch import Layout, run_batch
from .plans.live import ROLLUP_DIMS, run_alerts
from .session import build_session
from .sinks.snapshots import read_snapshot, write_snapshot
from .sources.events import EventSource
from .sources.feed import stream_article_feed
from .sources.lexicons import load_lexicon, load_patterns
from .streaming.alerts import compact_alerts
from .streaming.feed import start_feed


def _table(spark: SparkSession, path: str):
    """A lexicon table: CSV with a header, or Parquet."""
    if path.endswith(".csv"):
        return spark.read.option("header", True).schema("term string, priority int, canonical string, label string").csv(path)
    return spark.read.parquet(path)


def _rules(spark: SparkSession, default: EntityRules, terms: str | None, patterns: str | None, match: str) -> EntityRules:
    if terms is None:
        return default
    return EntityRules.of_table(
        _table(spark, terms),
        patterns=load_patterns(_table(spark, patterns)) if patterns else (),
        label=default.label,
        mapping=default.mapping,
        members=default.members,
        member_value=default.member_value,
        match=match,
    )


def _terms(spark: SparkSession, path: str | None, default) -> Lexicon | tuple[str, ...]:
    return default if path is None else load_lexicon(_table(spark, path))


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="sparkwatch", description=__doc__)
    jobs = parser.add_subparsers(dest="job", required=True)

    batch = jobs.add_parser("batch", help="files to bronze, silver and gold")
    batch.add_argument("--raw", nargs="+", required=True, help="CSV paths or globs")
    batch.add_argument("--root", required=True, help="warehouse folder")
    batch.add_argument("--as-of", help="timestamp the run stands for")
    batch.add_argument("--scd-mode", choices=("always", "on_change"), default="on_change")
    batch.add_argument("--run-id", default="manual")

    feed = jobs.add_parser("feed", help="landed article payloads to events")
    feed.add_argument("--feed", required=True, help="folder of payload files")
    feed.add_argument("--out", required=True, help="folder of event files")
    feed.add_argument("--exclude", help="lexicon table of excluded terms")
    feed.add_argument("--multi-line", action="store_true", help="a payload per file, over many lines")
    feed.add_argument("--all-of", nargs="+", help="lexicon tables, one term of each must occur")

    alerts = jobs.add_parser("alerts", help="events to alerts")
    alerts.add_argument("--root", required=True, help="warehouse folder")
    alerts.add_argument("--format", default="kafka", choices=("kafka", "json", "text"))
    alerts.add_argument("--path", help="folder of event files")
    alerts.add_argument("--servers", help="Kafka bootstrap servers")
    alerts.add_argument("--topic", help="Kafka topic")
    alerts.add_argument("--starting-offsets", default="latest")
    for kind in ("disease", "country"):
        alerts.add_argument(f"--{kind}-terms", help="lexicon table")
        alerts.add_argument(f"--{kind}-patterns", help="pattern table (term, label)")

    for job in (feed, alerts):
        job.add_argument("--checkpoint", required=True)
        job.add_argument("--trigger", help="processing-time interval; without it the job takes what is there and stops")
        job.add_argument("--match", choices=("word", "substring"), default="word")

    compact = jobs.add_parser("compact", help="latest alert per key, and the rollup of all alerts")
    compact.add_argument("--root", required=True, help="warehouse folder")
    compact.add_argument("--retire", action="store_true", help="remove batches that the snapshot before holds already")

    args = parser.parse_args(argv)
    spark = build_session(f"sparkwatch-{args.job}")
    if args.job == "batch":
        run_batch(spark, args.raw, args.root, as_of=args.as_of, scd_mode=args.scd_mode, run_id=args.run_id)
    elif args.job == "feed":
        groups = starter.RELEVANT if args.all_of is None else [load_lexicon(_table(spark, p)) for p in args.all_of]
        exclude = _terms(spark, args.exclude, starter.IRRELEVANT)
        articles = stream_article_feed(spark, args.feed, args.multi_line)
        start_feed(
            articles, exclude, groups, args.checkpoint, args.out, match=args.match, trigger=args.trigger
        ).awaitTermination()
    elif args.job == "alerts":
        source = EventSource(args.format, args.servers, args.topic, args.path, args.starting_offsets)
        diseases = _rules(spark, starter.DISEASES, args.disease_terms, args.disease_patterns, args.match)
        countries = _rules(spark, starter.COUNTRIES, args.country_terms, args.country_patterns, args.match)
        run_alerts(
            spark, source, Layout(args.root), args.checkpoint, diseases, countries, args.trigger
        ).awaitTermination()
    else:
        out = Layout(args.root)
        compact_alerts(spark, out.alerts, out.alerts_latest, retire=args.retire, rollup=out.alert_rollup)


if __name__ == "__main__":
    main()
