"""Command-line entry points (``python -m freshet <command> ...``).

    seed      create the status table from a location -> key table
    listing   write the status table listing (ordinal, location, data, ...)
    refresh   apply a batch of landed responses to the status table
    stream    keep refreshing the status table from a landing directory
    ingest    parse a response log into a typed conditions table
    renewal   run the renewal job and publish its snapshots

Table arguments are parquet paths, or ``table:<name>`` for a catalog table
(e.g. one stored bucketed with ``sources.tables.save_bucketed``); versioned
tables (status, renewal outputs) are roots holding ``v=<id>`` versions and a
``_published`` pointer.
"""

from __future__ import annotations

import argparse
import datetime as dt
import sys

from pyspark.sql import functions as F


def _session(args):
    from freshet.session import build_session

    extra = {}
    if args.shuffle_partitions:
        extra["spark.sql.shuffle.partitions"] = str(args.shuffle_partitions)
    return build_session(master=args.master, extra=extra)


def _read(spark, ref: str):
    if ref.startswith("table:"):
        return spark.table(ref[len("table:"):])
    return spark.read.parquet(ref)


def cmd_seed(spark, args) -> int:
    from freshet.operators.snapshot import publish, write_version
    from freshet.plans import weather

    status = weather.seed_status(_read(spark, args.locations))
    publish(spark, args.status_root, write_version(status, args.status_root))
    return 0


def cmd_listing(spark, args) -> int:
    from freshet.operators.snapshot import read_current
    from freshet.plans import weather

    status = read_current(spark, args.status_root)
    if status is None:
        print(f"no published status table under {args.status_root}", file=sys.stderr)
        return 1
    listing = weather.status_listing(status)
    if args.out:
        listing.write.mode("errorifexists").parquet(args.out)
    if args.rows:  # a look at the first rows, only if asked for
        listing.show(args.rows, truncate=False)
    return 0


def cmd_refresh(spark, args) -> int:
    from freshet import jobs
    from freshet.sources.landing import read_landed

    res = jobs.run_status_refresh(
        spark, args.status_root, read_landed(spark, args.responses, fmt=args.format),
        _read(spark, args.locations), args.log, args.audit, run_id=args.run_id,
    )
    print({"published": res.published, **res.versions})
    return 0 if res.published else 2


def cmd_stream(spark, args) -> int:
    from freshet.sources.landing import read_landed_stream
    from freshet.streaming.status_stream import run_status_refresh

    q = run_status_refresh(
        spark, read_landed_stream(spark, args.landing, fmt=args.format),
        _read(spark, args.locations), args.status_root, args.log, args.audit,
        args.checkpoint, available_now=not args.continuous, interval=args.interval,
    )
    q.awaitTermination()
    return 0


def cmd_ingest(spark, args) -> int:
    from freshet.plans import weather

    conditions = weather.ingest_log(spark, args.log)
    if args.latest:
        conditions = weather.latest_reading(conditions)
    conditions.write.mode("errorifexists").parquet(args.out)
    return 0


def cmd_renewal(spark, args) -> int:
    from freshet import jobs

    def read(ref):
        return _read(spark, ref)

    res = jobs.run_renewal(
        spark, args.out,
        read(args.tariff), read(args.tariff_domain), read(args.tariff_data),
        read(args.constants), read(args.apply_result), read(args.approve_result),
        ldate=F.lit(dt.date.fromisoformat(args.ldate)),
        commit_interval=args.commit_interval, reject=args.reject,
    )
    print({"published": res.published, **res.counts})
    return 0 if res.published else 2


def main(argv=None) -> int:
    p = argparse.ArgumentParser(prog="freshet", description=__doc__,
                                formatter_class=argparse.RawDescriptionHelpFormatter)
    p.add_argument("--master", default=None)
    p.add_argument("--shuffle-partitions", type=int, default=None)
    sub = p.add_subparsers(dest="cmd", required=True)

    s = sub.add_parser("seed")
    s.add_argument("--status-root", required=True)
    s.add_argument("--locations", required=True)

    s = sub.add_parser("listing")
    s.add_argument("--status-root", required=True)
    s.add_argument("--out", help="folder for the whole listing (parquet)")
    s.add_argument("--rows", type=int, help="print so many rows")

    for name in ("refresh", "stream"):
        s = sub.add_parser(name)
        s.add_argument("--status-root", required=True)
        s.add_argument("--locations", required=True)
        s.add_argument("--log", required=True)
        s.add_argument("--audit", required=True)
        s.add_argument("--format", default="json")
        if name == "refresh":
            s.add_argument("--responses", required=True)
            s.add_argument("--run-id", help="a run repeated under its id replaces its log and audit")
        else:
            s.add_argument("--landing", required=True)
            s.add_argument("--checkpoint", required=True)
            s.add_argument("--continuous", action="store_true")
            s.add_argument("--interval", default="1 minute", help="between batches, with --continuous")

    s = sub.add_parser("ingest")
    s.add_argument("--log", required=True)
    s.add_argument("--out", required=True)
    s.add_argument("--latest", action="store_true")

    s = sub.add_parser("renewal")
    for a in ("tariff", "tariff-domain", "tariff-data", "constants", "apply-result",
              "approve-result", "out", "ldate"):
        s.add_argument(f"--{a}", required=True)
    s.add_argument("--commit-interval", type=int, default=5)
    s.add_argument("--reject", action="store_true")

    args = p.parse_args(argv)
    spark = _session(args)
    handler = {"seed": cmd_seed, "listing": cmd_listing, "refresh": cmd_refresh,
               "stream": cmd_stream, "ingest": cmd_ingest, "renewal": cmd_renewal}[args.cmd]
    return handler(spark, args)


if __name__ == "__main__":
    sys.exit(main())
