"""Command line: python -m tallyhouse <command> --warehouse DIR …

    dims    build dim_date and dim_time
    ingest  convert the complete days of a dump folder, up to month sets
    stream  the same with a file stream that remembers what it has seen
    hours   write hourly sets, a folder for each dump, from what was ingested
    load    load new month sets into the fact table
    append  append months to a database over JDBC that were not appended yet
    audit   verdict for every dump file of a folder
    rejects malformed lines by dump, and how often each occurs
    report  views by any attributes of fact and dimensions
    sweep   delete what reloads have replaced and stopped runs have left

audit, rejects and report print all their rows, tab-separated, or write them with
--out; --limit prints only so many.
"""

import argparse

from pyspark.sql import DataFrame, SparkSession, functions as F

from tallyhouse.plans import (
    RunAudit, Warehouse, append_months, build_dimensions, ingest_folder, ingest_stream,
    load_months, report, sweep_warehouse, write_hours,
)
from tallyhouse.schemas import COMPANY_PAGES, DIM_DATE_END, DIM_DATE_START
from tallyhouse.session import local_session
from tallyhouse.sources import audit_dumps, read_rejects
from tallyhouse.streaming import stream_dumps


def arguments() -> argparse.Namespace:
    parser = argparse.ArgumentParser(
        prog="tallyhouse", description=__doc__, formatter_class=argparse.RawDescriptionHelpFormatter
    )
    parser.add_argument("command", choices=[
        "dims", "ingest", "stream", "hours", "load", "append", "audit", "rejects", "report", "sweep",
    ])
    parser.add_argument("--warehouse", required=True, help="folder of the warehouse tables")
    parser.add_argument("--dumps", help="folder of pageviews-….gz files")
    parser.add_argument("--pages", nargs="+", default=COMPANY_PAGES)
    parser.add_argument("--start", help="first date (ISO)")
    parser.add_argument("--end", help="last date (ISO)")
    parser.add_argument("--check", action="store_true", help="find damaged dumps first")
    parser.add_argument("--quarantine", action="store_true", help="set bad rows aside")
    parser.add_argument("--months", nargs="*", default=[], help="months to load again or to append")
    parser.add_argument("--by", nargs="+", default=["day_name"])
    parser.add_argument("--url", help="JDBC URL")
    parser.add_argument("--table", default="fact_pageviews")
    parser.add_argument("--out", help="folder to write a result to, as tab-separated text")
    parser.add_argument("--limit", type=int, help="print only so many rows")
    parser.add_argument("--hours", type=float, default=24.0, help="sweep only what is older")
    parser.add_argument("--local", action="store_true", help="run on this machine")
    return parser.parse_args()


def show(rows: DataFrame, out: str | None, limit: int | None) -> None:
    """All rows, in order: to a folder, or printed as they come."""
    if out:
        rows.write.mode("overwrite").option("header", True).option("sep", "\t").csv(out)
        return
    print("\t".join(rows.columns))
    for row in (rows if limit is None else rows.limit(limit)).toLocalIterator():
        print("\t".join("" if value is None else str(value) for value in row))


def run(spark: SparkSession, args: argparse.Namespace) -> None:
    house = Warehouse(args.warehouse)
    audit = RunAudit(spark, house.audit)
    if args.command == "dims":
        build_dimensions(spark, house, args.start or DIM_DATE_START, args.end or DIM_DATE_END)
    elif args.command == "ingest":
        count = ingest_folder(
            spark, args.dumps, house, audit.run_id, args.pages, args.start, args.end,
            args.check, audit,
        )
        print(f"{count} dumps converted")
    elif args.command == "stream":
        ingest_stream(spark, stream_dumps(spark, args.dumps), house, audit.run_id, args.pages, audit)
    elif args.command == "hours":
        write_hours(spark, house, args.start, args.end)
    elif args.command == "load":
        load_months(spark, house, audit.run_id, args.months, args.quarantine, audit)
    elif args.command == "append":
        months = append_months(spark, house, audit.run_id, args.url, args.table, args.months, audit)
        print(f"{len(months)} months appended")
    elif args.command == "audit":
        show(audit_dumps(spark, args.dumps, deep=args.check).orderBy("file_name", "path"), args.out, args.limit)
    elif args.command == "sweep":
        print("\n".join(f"{name}: {count} versions deleted" for name, count in sweep_warehouse(spark, house, args.hours).items()))
    elif args.command == "rejects":
        found = read_rejects(spark, house.rejects, house.tally).groupBy("file_name", "reason", "line").agg(F.sum("lines").alias("lines"))
        show(found.orderBy("file_name", "reason", "line"), args.out, args.limit)
    else:
        found = report(spark, house, *args.by)
        show(found.orderBy(*args.by), args.out, args.limit)


def main() -> None:
    args = arguments()
    session = local_session() if args.local else SparkSession.builder.getOrCreate()
    try:
        run(session, args)
    finally:
        session.stop()


if __name__ == "__main__":
    main()
