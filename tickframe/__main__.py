"""Command line for the jobs: ``spark-submit ... -m tickframe`` or ``python -m tickframe <job> ...``."""

from __future__ import annotations

import argparse
import sys

from tickframe.functions.times import SEOUL, collection_open
from tickframe.operators.enrich import METRIC_KEYS, PROFILE_NUMBER_KEYS, PROFILE_TEXT_KEYS, QUOTE_KEYS
from tickframe.operators.quality import newest_rows, profile, time_columns
from tickframe.operators.serving import kpi_texts
from tickframe.operators.universe import DEFAULT_SYMBOLS, choose_universe
from tickframe.plans.analyze import run_analyze, run_analyze_lake, run_daily
from tickframe.plans.collect import run_collect
from tickframe.plans.ingest import run_ingest
from tickframe.plans.serve import run_kpis
from tickframe.plans.upkeep import run_cleanup, run_monitor, run_quality
from tickframe.schemas import ANALYZED_SCHEMA, RAW_SCHEMA
from tickframe.session import build_session
from tickframe.sources.messages import kafka_options, read_documents, read_messages, stream_messages
from tickframe.sources.tables import preview, read_table
from tickframe.streaming.ingest import run_ingest_lake, start_lake_ingest


def _arguments(argv: list[str] | None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="tickframe")
    jobs = parser.add_subparsers(dest="job", required=True)
    collect = jobs.add_parser("collect", help="polled documents to messages")
    for name in ("quotes", "profiles", "metrics"):
        collect.add_argument(f"--{name}", required=True, help="JSON documents with a symbol")
    collect.add_argument("--symbols", default="manual", help="manual, trending or large_cap")
    collect.add_argument("--symbol-list", default=DEFAULT_SYMBOLS)
    collect.add_argument("--servers", help="brokers of a topic")
    collect.add_argument("--topic")
    collect.add_argument("--path", help="files to write instead of a topic")
    collect.add_argument("--format", default="kafka")
    collect.add_argument("--quarantine", help="folder for quotes that cannot be used, with the reason")
    collect.add_argument("--industry-key", default=PROFILE_TEXT_KEYS["industry"], help="key of the industry in profile documents")
    ingest = jobs.add_parser("ingest", help="messages to RAW")
    ingest.add_argument("--lake", help="folder of RAW, quarantine and offsets: only messages that came since the last run")
    ingest.add_argument("--raw", help="without a lake: all retained messages are appended here")
    ingest.add_argument("--quarantine", help="without a lake: rejected messages")
    ingest.add_argument("--every", help="keep running, a batch per interval such as '15 minutes'; needs a lake")
    ingest.add_argument("--servers", help="brokers of a topic")
    ingest.add_argument("--topic")
    ingest.add_argument("--path", help="files with a value column, instead of a topic")
    ingest.add_argument("--format", default="kafka")
    analyze = jobs.add_parser("analyze", help="RAW to ANALYZED")
    analyze.add_argument("--lake", help="folder that ingest fills: only batches that came since the last run")
    analyze.add_argument("--raw", help="without a lake: the RAW table")
    analyze.add_argument("--analyzed", required=True)
    analyze.add_argument("--exact", help="type in which averages are summed, such as decimal(18,2)")
    analyze.add_argument("--mode", choices=["append", "repair"], default="append")
    analyze.add_argument("--frame", choices=["rows", "range"], default="rows")
    analyze.add_argument("--since", help="first batch date to read")
    daily = jobs.add_parser("daily", help="RAW to DAILY")
    daily.add_argument("--raw", required=True)
    daily.add_argument("--daily", required=True)
    cleanup = jobs.add_parser("cleanup", help="remove duplicates from ANALYZED")
    cleanup.add_argument("--analyzed", required=True)
    quality = jobs.add_parser("quality", help="exit code 0 when both tables pass")
    quality.add_argument("--raw", required=True)
    quality.add_argument("--analyzed", required=True)
    quality.add_argument("--keys", help="columns that tell rows apart, joined by commas; without them whole rows count")
    quality.add_argument("--max-duplicates", type=float, default=0.05, help="share of rows")
    quality.add_argument("--max-nulls", type=float, default=0.10, help="missing values against rows; negative for no limit")
    quality.add_argument("--max-column-nulls", help="share for every column, or column=share pairs joined by commas")
    serve = jobs.add_parser("serve", help="headline figures of the stored table")
    serve.add_argument("--analyzed", required=True)
    monitor = jobs.add_parser("monitor", help="exit code 0 when data keeps arriving")
    monitor.add_argument("--analyzed", required=True)
    monitor.add_argument("--servers", help="brokers of a topic")
    monitor.add_argument("--topic")
    monitor.add_argument("--max-lag", type=int, default=3 * 3600, help="seconds since the newest analysed tick")
    inspect = jobs.add_parser("inspect", help="columns, newest rows and a sample of any table")
    inspect.add_argument("path")
    for job in (ingest, analyze):
        job.add_argument("--in-session-only", action="store_true", help="do nothing outside the collection hours")
    args = parser.parse_args(argv)
    if args.job == "ingest" and not args.lake and (args.every or not (args.raw and args.quarantine)):
        parser.error("ingest needs --lake, or --raw and --quarantine without --every")
    if args.job == "analyze" and bool(args.lake) == bool(args.raw):
        parser.error("analyze needs either --lake or --raw")
    if args.job == "analyze" and args.lake and (args.mode != "append" or args.since):
        parser.error("--mode and --since belong to --raw")
    return args


def _shares(text: str | None) -> float | dict[str, float] | None:
    """``0.1``, or ``a=0.1,b=0.5``."""
    if not text or "=" not in text:
        return float(text) if text else None
    return {name.strip(): float(share) for name, share in (pair.split("=") for pair in text.split(","))}


def main(argv: list[str] | None = None) -> int:
    args = _arguments(argv)
    spark = build_session(f"tickframe-{args.job}")
    if getattr(args, "in_session_only", False) and not collection_open(spark, zone=SEOUL):
        return 0
    if args.job == "collect":
        topic = {"kafka.bootstrap.servers": args.servers, "topic": args.topic} if args.format == "kafka" else {}
        profile_keys = {**PROFILE_TEXT_KEYS, "industry": args.industry_key}
        run_collect(
            read_documents(spark, args.quotes, [*QUOTE_KEYS.values(), "t", "polled_at"]),
            read_documents(spark, args.profiles, [*profile_keys.values(), *PROFILE_NUMBER_KEYS.values()]),
            read_documents(spark, args.metrics, METRIC_KEYS.values()),
            args.format,
            args.path,
            choose_universe(spark, args.symbols, args.symbol_list),
            topic,
            args.quarantine,
            profile_text_keys=profile_keys,
        )
    elif args.job == "ingest":
        options = kafka_options(args.servers, args.topic) if args.format == "kafka" else {}
        schema = None if args.format == "kafka" else "value string"
        if not args.lake:
            print(run_ingest(read_messages(spark, args.format, args.path, **options), args.raw, args.quarantine))
        elif args.every:
            source = stream_messages(spark, args.format, args.path, schema, **options)
            start_lake_ingest(source, args.lake, args.every).awaitTermination()
        else:
            print(run_ingest_lake(stream_messages(spark, args.format, args.path, schema, **options), args.lake))
    elif args.job == "analyze":
        if args.lake:
            print(run_analyze_lake(spark, args.lake, args.analyzed, frame=args.frame, exact=args.exact))
        else:
            print(run_analyze(spark, args.raw, args.analyzed, args.mode, args.since, frame=args.frame, exact=args.exact))
    elif args.job == "daily":
        print(run_daily(spark, args.raw, args.daily))
    elif args.job == "cleanup":
        print(run_cleanup(spark, args.analyzed))
    elif args.job == "serve":
        kpi_texts(run_kpis(spark, args.analyzed)).orderBy("symbol").show(1000, truncate=False)
    elif args.job == "quality":
        own = {"keys": args.keys.split(",")} if args.keys else {}
        verdicts = run_quality(
            spark,
            {
                "raw": {"path": args.raw, "schema": RAW_SCHEMA, "price": "current_price"},
                "analyzed": {"path": args.analyzed, "schema": ANALYZED_SCHEMA, "price": "average_price", **own},
            },
            max_duplicates=args.max_duplicates,
            max_nulls=None if args.max_nulls < 0 else args.max_nulls,
            max_column_nulls=_shares(args.max_column_nulls),
        )
        verdicts.show(truncate=False)
        return 0 if verdicts.filter("NOT passed").isEmpty() else 1
    elif args.job == "monitor":
        messages = read_messages(spark, **kafka_options(args.servers, args.topic)) if args.servers else None
        checks = run_monitor(spark, args.analyzed, messages, max_lag_seconds=args.max_lag)
        checks.show(truncate=False)
        return 0 if checks.filter("NOT fresh").isEmpty() else 1
    elif args.job == "inspect":
        table = read_table(spark, args.path)
        profile(table).show(1000, truncate=False)
        preview(time_columns(table), 10).show(truncate=False)
        if "collection_time" in table.columns:
            newest_rows(table).show(truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
