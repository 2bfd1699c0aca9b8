"""Run the batch job: python -m tickseries --input-root data --output-root out [--feeds feeds.json] [--parity | --append]"""

from __future__ import annotations

import argparse
from pathlib import Path

from tickseries.feeds import BTC, ETH, feeds_from_json
from tickseries.operators.quality import assert_quality
from tickseries.plans.daily import COMBINED, check, run_feeds, run_increment
from tickseries.session import build_session


def main() -> None:
    parser = argparse.ArgumentParser(prog="tickseries")
    parser.add_argument("--input-root", required=True, help="folder or URI that holds the feed folders")
    parser.add_argument("--output-root", required=True, help="folder or URI for the tables")
    parser.add_argument("--feeds", help="JSON file with the feeds: folders, fields, table names; default: btc and eth")
    parser.add_argument("--combined", default=COMBINED, help="name of the combined table")
    parser.add_argument("--parity", action="store_true", help="write the plain tables without close and partitions")
    parser.add_argument("--append", action="store_true", help="add a new drop of raw files to existing tables")
    parser.add_argument("--drop", help="name of the drop; default: made of the files' paths, sizes and times")
    parser.add_argument("--replace", action="store_true", help="with --append: the drop is loaded already and is to be replaced")
    parser.add_argument("--rollups", action="store_true", help="with --append: keep up hour and day bars of every feed")
    args = parser.parse_args()
    if args.append and args.parity:
        parser.error("--append works on the tables of the default mode")
    feeds = feeds_from_json(Path(args.feeds).read_text()) if args.feeds else [BTC, ETH]
    spark = build_session()
    if args.append:
        tables = run_increment(spark, feeds, args.input_root, args.output_root, args.drop, args.combined, args.replace, args.rollups)
    else:
        tables = run_feeds(spark, feeds, args.input_root, args.output_root, args.parity, args.combined, args.drop)
    for found in check(spark, feeds, tables, args.output_root, args.parity, args.combined, increment=args.append):
        found.show(truncate=False)
        assert_quality(found)


if __name__ == "__main__":
    main()
