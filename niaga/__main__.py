"""Command line: load a mart from CSV folders or files, and run its reports.

    python -m niaga load --root ROOT --input FOLDER
    python -m niaga report a1_monthly_kpi --root ROOT [--csv FOLDER] [--where kota=Medan] [--first DAY --last DAY]

On a cluster: ``spark-submit --py-files niaga.zip niaga/__main__.py load ...``. ``load`` exits with 1 when a quality
check failed.
"""

from __future__ import annotations

import argparse
import datetime as dt
import logging
import sys

from pyspark.sql import DataFrame, SparkSession

from niaga.plans import pages, reports
from niaga.plans.catalog import REPORTS
from niaga.plans.incremental import run_incremental
from niaga.plans.pipeline import SNAPSHOT_DATE, Mart, run_load
from niaga.plans.placement import placed_folder, store_placed
from niaga.plans.rollups import folder_of, open_rolled_up, store_rollups
from niaga.schemas import SOURCES
from niaga.sources import export_csv, read_all

log = logging.getLogger("niaga")


def _arguments(argv: list[str] | None) -> argparse.Namespace:
    day = dt.date.fromisoformat
    parser = argparse.ArgumentParser(prog="niaga")
    commands = parser.add_subparsers(dest="command", required=True)
    load = commands.add_parser("load", help="build and publish a mart from CSV sources")
    load.add_argument("--root", required=True)
    load.add_argument("--input", required=True, help="folder with <source>.csv files or folders")
    load.add_argument("--snapshot", type=day, default=SNAPSHOT_DATE)
    load.add_argument("--allow-failed-checks", action="store_true", help="publish, but still exit 1")
    load.add_argument("--incremental", action="store_true", help="keep the keys of the last run and write changed months only")
    load.add_argument("--placed", action="store_true", help="store the facts once more, placed by the columns that pages filter by")
    load.add_argument("--rollups", action="store_true", help="store roll-ups of the facts, from which reports are answered")
    load.add_argument("--skip-unreadable-rows", action="store_true")
    load.add_argument(
        "--multi-line", action="store_true", help="each file is read whole by one task, for files whose lines end otherwise than with a line feed"
    )
    report = commands.add_parser("report", help="run one report on the published mart")
    report.add_argument("name", choices=sorted([*REPORTS, *PAGES, "e1_daily_summary"]))
    report.add_argument("--root", required=True)
    report.add_argument("--csv", help="write the result there instead of printing it")
    report.add_argument("--where", action="append", default=[], metavar="COLUMN=VALUE", help="a filter; may be repeated")
    report.add_argument("--first", type=day, help="first day (default: the first day with an order)")
    report.add_argument("--last", type=day, help="last day (default: the last day with an order)")
    args = parser.parse_args(argv)
    if args.command == "report" and not all("=" in chosen for chosen in args.where):
        parser.error("--where takes COLUMN=VALUE")
    return args


PAGES = {
    f.__name__: f
    for f in (
        pages.sales_detail,
        pages.customer_detail,
        pages.web_detail,
        pages.inventory_detail,
        pages.daily_sales,
        pages.signup_trend,
        pages.warehouse_volume,
        pages.category_scatter,
    )
}


def _report(args: argparse.Namespace, mart: Mart) -> DataFrame:
    """The report under the chosen filters and days."""
    days = None
    if args.first or args.last or args.name == "e1_daily_summary":
        span = pages.order_date_span(mart).first()
        days = (args.first or span.min_d or dt.date.min, args.last or span.max_d or dt.date.max)
    choices: dict[str, list[str]] = {}
    for column, value in (chosen.split("=", 1) for chosen in args.where):
        choices.setdefault(column, []).append(value)
    if choices or days:
        mart = pages.apply_filters(mart, choices, days)
    if args.name == "e1_daily_summary":
        return reports.e1_daily_summary(mart, *days)
    return (REPORTS.get(args.name) or PAGES[args.name])(mart)


def _print(result: DataFrame) -> None:
    """All rows, a partition at a time."""
    print("\t".join(result.columns))
    for row in result.toLocalIterator():
        print("\t".join("" if value is None else str(value) for value in row))


def main(argv: list[str] | None = None) -> int:
    args = _arguments(argv)
    spark = SparkSession.builder.appName("niaga").getOrCreate()
    if args.command == "report":
        mart = open_rolled_up(spark, args.root)
        result = _report(args, mart)
        if args.csv:
            export_csv(result, args.csv)
        else:
            _print(result)
        return 0

    paths = {name: f"{args.input.rstrip('/')}/{name}.csv" for name in SOURCES}
    loaded = (run_incremental if args.incremental else run_load)(
        spark,
        read_all(spark, paths, multi_line=args.multi_line),
        args.root,
        snapshot=args.snapshot,
        strict_sources=not args.skip_unreadable_rows,
        publish_failed_checks=args.allow_failed_checks,
    )
    if args.placed:
        store_placed(spark, loaded.mart, placed_folder(args.root, loaded.run_id))
    if args.rollups:
        store_rollups(spark, loaded.mart, folder_of(args.root, loaded.run_id))
    for name, metrics in loaded.metrics.items():
        log.info("%s: %s", name, metrics)
    for check in loaded.failed_checks:
        log.warning("check failed: %s", check)
    return 1 if loaded.failed_checks else 0


if __name__ == "__main__":
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(message)s")
    sys.exit(main())
