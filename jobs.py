"""Command line of the lake, for spark-submit.

    spark-submit jobs.py days     --root s3a://bucket --date 2025-03-01
    spark-submit jobs.py days     --root s3a://bucket --first 2025-03-01 --end 2025-04-01
    spark-submit jobs.py optimize --root s3a://bucket --date 2025-03-01 --platform naver
    spark-submit jobs.py curate   --root s3a://bucket --date 2025-03-01 --platform naver
    spark-submit jobs.py history  --root s3a://bucket --date 2025-02-27
    spark-submit jobs.py direct   --root s3a://bucket --date 2025-02-27 --folders 1 2 3
    spark-submit jobs.py read     --root s3a://bucket --date 2025-03-01 --platform kakao

Credentials and the file system are the business of the Spark configuration.
"""

import argparse
from datetime import date

from pyspark.sql import SparkSession

from quirelake.conventions import JOB_PREVIEW_ROWS, PLATFORMS, READER_PREVIEW_ROWS
from quirelake.plans import runs
from quirelake.sources import preview

COMMANDS = ("days", "optimize", "curate", "history", "direct", "read")


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description="Jobs of the catalogue lake")
    parser.add_argument("command", choices=COMMANDS)
    parser.add_argument("--root", required=True, help="folder or bucket of the lake")
    parser.add_argument("--date", type=date.fromisoformat, help="one date, default today")
    parser.add_argument("--first", type=date.fromisoformat, help="first date of a range")
    parser.add_argument("--end", type=date.fromisoformat, help="date after the range")
    parser.add_argument("--platform", choices=PLATFORMS, help="default: all platforms")
    parser.add_argument("--folders", nargs="*", help="title folders of a direct run")
    parser.add_argument("--mode", choices=("overwrite", "append"), default="overwrite")
    parser.add_argument("--backup", action="store_true", help="keep a direct run's views")
    parser.add_argument("--keep-empty", action="store_true", help="keep titles without keywords")
    parser.add_argument("--join", choices=("chained", "star"), default="chained",
                        help="how comments are reached")
    parser.add_argument("--as-of", type=date.fromisoformat, help="one date for all of the history")
    parser.add_argument("--lines", action="store_true", help="landed files hold a document per line")
    parser.add_argument("--quarantine", action="store_true", help="write what was not taken whole")
    parser.add_argument("--show", action="store_true", help="show what a run wrote")
    parser.add_argument("--all-dates", action="store_true", help="read every date")
    return parser.parse_args(argv)


def dates_of(args: argparse.Namespace) -> list[date]:
    if args.first:
        return runs.days(args.first, args.end or date.today())
    return [args.date or date.today()]


def session() -> SparkSession:
    return (
        SparkSession.builder.appName("catalogue lake")
        .config("spark.sql.session.timeZone", "UTC")
        # landed files are a few kilobytes: put more of them into one task
        .config("spark.sql.files.openCostInBytes", str(512 * 1024))
        .getOrCreate()
    )


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    args = arguments(argv)
    spark = spark or session()
    dates = dates_of(args)
    platforms = [args.platform] if args.platform else list(PLATFORMS)
    landed = {"multiline": not args.lines}
    choices = {"keep_empty": args.keep_empty, "join": args.join}
    flags = {"quarantine": args.quarantine}
    if args.command == "days":
        runs.run_days(
            spark, args.root, dates, platforms, args.mode, **landed, **choices, **flags
        )
    elif args.command == "optimize":
        runs.optimize_days(spark, args.root, dates, platforms, mode=args.mode, **landed, **flags)
    elif args.command == "curate":
        runs.curate_days(spark, args.root, dates, platforms, args.mode, **choices)
    elif args.command == "history":
        runs.run_history(
            spark, args.root, dates, platforms, args.as_of, args.mode, **landed, **choices, **flags
        )
    elif args.command == "direct":
        if args.backup:
            read = runs.direct_source(spark, args.root, dates, args.folders, **landed)
            runs.backup_direct(read, args.root, platforms)
        runs.run_direct(
            spark, args.root, dates, platforms, folders=args.folders, mode=args.mode, **landed, **choices
        )
    if args.command == "read" or args.show:
        on = None if args.all_dates else dates
        shown = READER_PREVIEW_ROWS if args.command == "read" else JOB_PREVIEW_ROWS
        for table, frame in runs.read_scope(spark, args.root, on, args.platform).items():
            print(table)
            preview(frame, shown).show(shown, truncate=False)


if __name__ == "__main__":
    main()
