"""Command line for the two applications.

    python -m clickpulse offline  --sf-dir DIR | --database DB  [--condition FILE]
                                  [--out-database DB | --jdbc-url URL ...] [--task-id ID]
    python -m clickpulse realtime --text-dir DIR | --kafka-servers S --topic T
                                  --base-dir DIR [--threshold N] [--available-now]
"""

from __future__ import annotations

import argparse
import uuid

from clickpulse.plans.condition import Condition
from clickpulse.plans.offline import run_offline
from clickpulse.session import STREAM_PARTITIONS, get_session, scratch_dir
from clickpulse.sources import jdbc
from clickpulse.sources.catalog import CatalogTables, save_table
from clickpulse.sources.fixtures import MallTables
from clickpulse.sources.streams import kafka_lines, text_lines
from clickpulse.streaming.app import start_realtime


def _condition(path: str | None) -> Condition:
    if not path:
        return Condition()
    with open(path, encoding="utf-8") as fh:
        text = fh.read()
    return Condition.from_properties(text) if "=" in text.split("{", 1)[0] else Condition.from_json(text)


def _session(args, partitions: int | None):
    extra = {"spark.sql.session.timeZone": args.time_zone} if args.time_zone else None
    return get_session(args.master, partitions, cluster=args.cluster, extra=extra)


def _offline(args) -> None:
    spark = _session(args, args.shuffle_partitions)
    tables = MallTables(spark, args.sf_dir) if args.sf_dir else CatalogTables(spark, args.database)
    if args.jdbc_url:
        target = jdbc.JdbcTarget(args.jdbc_url, args.jdbc_user, args.jdbc_password, args.jdbc_driver)
        sink = lambda df, name, mode: jdbc.WRITERS[mode](df, target, name)
    else:
        prefix = f"{args.out_database}." if args.out_database else ""
        sink = lambda df, name, mode: save_table(
            df, prefix + name, mode="append" if mode == "append" else "overwrite")
    run_offline(tables, _condition(args.condition), args.task_id or str(uuid.uuid4()), sink)


def _realtime(args) -> None:
    spark = _session(args, args.shuffle_partitions or (STREAM_PARTITIONS if args.cluster else None))
    if args.kafka_servers:
        lines = kafka_lines(spark, args.kafka_servers, args.topic, group_id=args.group_id,
                            max_offsets_per_trigger=args.max_offsets_per_trigger)
    else:
        lines = text_lines(spark, args.text_dir, args.max_files_per_trigger)
    base = args.base_dir or scratch_dir(spark, "realtime")
    rt = start_realtime(spark, lines, base, args.threshold, args.available_now, slot_ms=args.slot_ms,
                        trend_by=args.trend_by, slots_by=args.slots_by, compact_every=args.compact_every,
                        max_ahead_ms=args.max_ahead_ms)
    rt.await_all()


def main(argv=None) -> None:
    p = argparse.ArgumentParser(prog="clickpulse")
    p.add_argument("--master")
    p.add_argument("--shuffle-partitions", type=int)
    p.add_argument("--time-zone", help="session time zone of days and minutes (default UTC)")
    p.add_argument("--cluster", action="store_true", help="large-cluster sizing (CLUSTER_CONF)")
    sub = p.add_subparsers(dest="cmd", required=True)

    o = sub.add_parser("offline", help="R1-R4 batch jobs")
    src = o.add_mutually_exclusive_group(required=True)
    src.add_argument("--sf-dir", help="folder of the driver's parquet tables")
    src.add_argument("--database", help="catalog database with the four mall tables")
    o.add_argument("--condition", help="JSON or properties file with the filter parameters")
    o.add_argument("--task-id")
    o.add_argument("--out-database")
    o.add_argument("--jdbc-url")
    o.add_argument("--jdbc-user")
    o.add_argument("--jdbc-password")
    o.add_argument("--jdbc-driver")
    o.set_defaults(fn=_offline)

    r = sub.add_parser("realtime", help="R5-R8 stream jobs")
    rs = r.add_mutually_exclusive_group(required=True)
    rs.add_argument("--text-dir", help="folder watched for new ad-log text files")
    rs.add_argument("--kafka-servers")
    r.add_argument("--topic", default="ads_log")
    r.add_argument("--group-id")
    r.add_argument("--max-offsets-per-trigger", type=int)
    r.add_argument("--base-dir", help="shared folder for state, sinks and checkpoints")
    r.add_argument("--threshold", type=int, default=100_000)
    r.add_argument("--slot-ms", type=int, default=5_000)
    r.add_argument("--max-files-per-trigger", type=int)
    r.add_argument("--available-now", action="store_true")
    r.add_argument("--max-ahead-ms", type=int, default=86_400_000,
                   help="lines dated further ahead of the clock are rejected")
    r.add_argument("--trend-by", choices=["event", "arrival"], default="event",
                   help="window the last-hour trend by event time or by arrival")
    r.add_argument("--compact-every", type=int, default=10, help="table versions merged at once")
    r.add_argument("--slots-by", choices=["event", "arrival"], default="event",
                   help="blacklist slots: event-time slices of --slot-ms, or the micro-batches")
    r.set_defaults(fn=_realtime)

    args = p.parse_args(argv)
    args.fn(args)


if __name__ == "__main__":
    main()
