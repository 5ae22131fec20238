"""Run a job (``dump``, ``process``) or a SQL text over the table (``sql``)."""

import argparse
import logging

from pyspark.sql import SparkSession

from tripmill.functions.names import quote_table
from tripmill.operators import table
from tripmill.plans import jobs
from tripmill.schema import INDEX_EXCLUDES, INDEX_TEMPLATE, TRIP_TABLE
from tripmill.session import use_zone


def main(arguments: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="tripmill", description="Batch jobs over trip records.")
    parser.add_argument("--hive", action="store_true", help="use the Hive catalog the cluster configures")
    parser.add_argument("--zone", help="session time zone, UTC by default")
    parser.add_argument("--table", default=TRIP_TABLE)
    parser.add_argument("--location", help="where the table's files are, if not in the warehouse")
    parser.add_argument(
        "--cluster",
        action=argparse.BooleanOptionalAction,
        help="shuffle before writing; by default done where the input is not laid out as the output",
    )
    commands = parser.add_subparsers(dest="command", required=True)

    dump = commands.add_parser("dump", help="CSV into the date-partitioned table")
    dump.add_argument("csv", nargs="+")
    dump.add_argument("--rejects", help="write rows with bad cells here")
    dump.add_argument("--check-header", action="store_true")
    dump.add_argument("--all-or-none", action="store_true", help="replace all days together, or none if the load fails")
    dump.add_argument("--rows-per-task", type=int, help="cut up what a file that does not split holds for a day")

    process = commands.add_parser("process", help="the table into per-day documents")
    process.add_argument("root")
    process.add_argument("--template", default=INDEX_TEMPLATE)
    process.add_argument("--exclude", nargs="*", default=list(INDEX_EXCLUDES))
    process.add_argument("--mode", choices=["append", "replace"], default="append")
    process.add_argument("--dates", nargs="+", help="only these days")
    process.add_argument("--since", help="only from this day on")
    process.add_argument("--until", help="only up to this day")
    process.add_argument("--null-index", help="index for rows the template has a null for; they fail the job otherwise")

    process.add_argument("--changed", action="store_true", help="only days loaded since the last such run")

    recover = commands.add_parser("recover", help="take back a load --all-or-none whose driver was lost")
    recover.add_argument("--force", action="store_true", help="also that of another application, which must be gone")

    sql = commands.add_parser("sql", help="show the result of a SQL text")
    sql.add_argument("text")
    sql.add_argument("--rows", type=int, default=100, help="show at most this many")
    sql.add_argument("--to", help="write the whole result to this path instead of showing it")
    sql.add_argument("--format", default="json", help="of what is written: json, csv, parquet, orc")

    args = parser.parse_args(arguments)
    logging.basicConfig(level=logging.INFO)
    builder = SparkSession.builder.appName(f"tripmill {args.command}")
    spark = (builder.enableHiveSupport() if args.hive else builder).getOrCreate()
    if args.command == "sql":
        use_zone(spark, args.zone)
        if args.location is not None and not spark.catalog.tableExists(quote_table(args.table)):
            table.attach(spark, args.table, args.location)
        result = spark.sql(args.text)
        if args.to is None:
            result.show(args.rows, truncate=False)
        else:
            result.write.format(args.format).option("header", True).save(args.to)
        return
    if args.command == "recover":
        if args.location is not None and not spark.catalog.tableExists(quote_table(args.table)):
            table.attach(spark, args.table, args.location)
        print("taken back" if table.recover(spark, args.table, force=args.force) else "nothing to take back")
        return
    common = {"location": args.location, "zone": args.zone}
    if args.command == "dump":
        result = jobs.dump(
            spark,
            args.csv,
            args.table,
            rejects_path=args.rejects,
            check_header=args.check_header,
            cluster=args.cluster is not False,
            all_or_none=args.all_or_none,
            rows_per_task=args.rows_per_task,
            **common,
        )
    else:
        result = jobs.process(
            spark,
            args.root,
            args.table,
            template=args.template,
            exclude=args.exclude,
            mode=args.mode,
            null_index=args.null_index,
            cluster=args.cluster,
            dates=args.dates,
            since=args.since,
            until=args.until,
            changed=args.changed,
            **common,
        )
    print(result)


if __name__ == "__main__":
    main()
