"""Command-line entry for the four jobs, for ``spark-submit`` or ``python -m``.

    spark-submit linecraft/__main__.py word-count IN OUT
    python -m linecraft log-analysis IN OUT [--fmt json] [--rejects PATH]
    python -m linecraft log-tagging IN OUT
    python -m linecraft word-count-report IN OUT REPORT
    python -m linecraft app-events LOG_DIR OUT

``--master`` is only for runs outside ``spark-submit``. Object-store keys
are read from the environment variables named by ``--access-key-env``,
``--secret-key-env`` and ``--session-token-env`` (never from the command
line); they serve the job's reads and writes.
"""

from __future__ import annotations

import argparse
import json
import os
import sys


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="linecraft")
    p.add_argument("--master", default=None, help="Spark master when not run by spark-submit")
    p.add_argument("--mode", default="errorifexists", help="save mode of the outputs")
    p.add_argument("--access-key-env", default=None)
    p.add_argument("--secret-key-env", default=None)
    p.add_argument("--session-token-env", default=None)
    sub = p.add_subparsers(dest="job", required=True)
    wc = sub.add_parser("word-count", help="count words, save (word,count) lines")
    wc.add_argument("input")
    wc.add_argument("output")
    wc.add_argument("--shuffle-partitions", type=int, default=None)
    la = sub.add_parser("log-analysis", help="parse access logs, save records, print counts")
    la.add_argument("input")
    la.add_argument("output")
    la.add_argument("--fmt", choices=["parquet", "json"], default="parquet")
    la.add_argument("--rejects", default=None)
    la.add_argument("--on-error", choices=["reject", "fail"], default="reject")
    lt = sub.add_parser("log-tagging", help="parse access logs once, save all lines partitioned by parsed")
    lt.add_argument("input")
    lt.add_argument("output")
    lt.add_argument("--on-error", choices=["reject", "fail"], default="reject")
    wr = sub.add_parser("word-count-report", help="word count plus one report per input partition")
    wr.add_argument("input")
    wr.add_argument("output")
    wr.add_argument("report")
    ae = sub.add_parser("app-events", help="application start/end messages from event logs")
    ae.add_argument("logs")
    ae.add_argument("output")
    return p


def _options(args) -> dict[str, str] | None:
    given = [bool(x) for x in (args.access_key_env, args.secret_key_env)]
    if not any(given) and not args.session_token_env:
        return None
    if not all(given):
        raise SystemExit("--access-key-env and --secret-key-env go together")
    from linecraft.sources import object_store_options

    token = os.environ.get(args.session_token_env) if args.session_token_env else None
    return object_store_options(
        os.environ[args.access_key_env], os.environ[args.secret_key_env], token, fresh_file_system=True
    )


def main(argv: list[str] | None = None) -> int:
    args = _parser().parse_args(argv)
    opts = _options(args)
    from pyspark.sql import SparkSession

    from linecraft.plans import jobs

    builder = SparkSession.builder.appName(f"linecraft-{args.job}")
    if args.master:
        builder = builder.master(args.master)
    spark = builder.getOrCreate()
    try:
        if args.job == "word-count":
            jobs.word_count_job(
                spark, args.input, args.output, options=opts,
                shuffle_partitions=args.shuffle_partitions, mode=args.mode,
            )
        elif args.job == "log-analysis":
            counts = jobs.log_analysis_job(
                spark, args.input, args.output, fmt=args.fmt, options=opts,
                on_error=args.on_error, rejects_path=args.rejects, mode=args.mode,
            )
            print(json.dumps(counts))
        elif args.job == "log-tagging":
            counts = jobs.log_tagging_job(
                spark, args.input, args.output, options=opts, on_error=args.on_error, mode=args.mode
            )
            print(json.dumps(counts))
        elif args.job == "word-count-report":
            jobs.word_count_with_report_job(spark, args.input, args.output, args.report, options=opts, mode=args.mode)
        else:
            jobs.application_events_job(spark, args.logs, args.output, options=opts, mode=args.mode)
    finally:
        spark.stop()
    return 0


if __name__ == "__main__":
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    sys.exit(main())
