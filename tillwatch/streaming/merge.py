"""Merge the closed hours of the enriched sink: ``merge.py --output ROOT [--before 'yyyy-MM-dd HH'] [--remove]``."""

from __future__ import annotations

import argparse
from collections.abc import Sequence
from datetime import datetime, timezone

from tillwatch.contract import ENRICHED_SCHEMA
from tillwatch.session import build_session
from tillwatch.sinks.ledger import MAIN
from tillwatch.streaming.jobs import StreamConfig


def parser() -> argparse.ArgumentParser:
    args = argparse.ArgumentParser(description="Merge the batches of closed hours to files of a good size.")
    args.add_argument("--output", required=True, help="root folder of all results")
    args.add_argument("--format", choices=("csv", "parquet"), default="csv")
    args.add_argument("--lineage", default=MAIN)
    args.add_argument("--before", help="hours before this one, as yyyy-MM-dd HH in UTC; the current hour if left out")
    args.add_argument("--remove", action="store_true", help="first delete the folders of batches that an earlier run has merged")
    return args


def main(argv: Sequence[str] | None = None) -> int:
    """Number of batches merged. With ``--remove``, readers that began before the earlier run must be through."""
    args = parser().parse_args(argv)
    spark = build_session("tillwatch-merge")
    folders = StreamConfig(args.output, "", format=args.format, lineage=args.lineage).enriched
    if args.remove:
        folders.remove_merged(spark)
    before = args.before or datetime.now(timezone.utc).strftime("%Y-%m-%d %H")
    return folders.merge_closed_hours(spark, ENRICHED_SCHEMA, before)


if __name__ == "__main__":
    main()
