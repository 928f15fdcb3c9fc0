"""Run a job: ``python -m tidemark land ...`` or ``python -m tidemark run ...``."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from tidemark import files
from tidemark.plans import bronze_text_bytes, land, run
from tidemark.plans.jobs import ALBUM_PAGE_LIMIT, TRACK_PAGE_LIMIT
from tidemark.session import SHUFFLE_PARTITIONS, build_session, settings_for
from tidemark.sources import read_pages, snapshot_id
from tidemark.sources.files import FORMATS


def _fit(spark: SparkSession, input_bytes: int, file_bytes: int | None) -> None:
    """Fit the session, which is this command's own, to its input and the files it should write."""
    for key, value in settings_for(input_bytes, int(spark.conf.get(SHUFFLE_PARTITIONS)), file_bytes=file_bytes).items():
        spark.conf.set(key, value)


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="tidemark")
    jobs = parser.add_subparsers(dest="job", required=True)
    landing = jobs.add_parser("land", help="merge pages into raw snapshots")
    landing.add_argument("--album-pages", required=True)
    landing.add_argument("--track-pages", required=True)
    landing.add_argument("--pages-format", choices=FORMATS, default="json")
    landing.add_argument("--album-limit", type=int, default=ALBUM_PAGE_LIMIT)
    landing.add_argument("--track-limit", type=int, default=TRACK_PAGE_LIMIT)
    landing.add_argument("--any-offsets", action="store_true", help="do not look for missing pages")
    cleaning = jobs.add_parser("run", help="clean the latest raw snapshots")
    cleaning.add_argument("--strict", action="store_true", help="refuse a field no record has")
    cleaning.add_argument("--date-format", action="append", default=[], help="a further format of release dates")
    for job in (landing, cleaning):
        job.add_argument("--base", required=True, help="folder or URI of the bronze and silver layers")
        job.add_argument("--file-bytes", type=int, help="write files of about this size")
        job.add_argument("--snapshot-ts", help="stamp of this run; the current UTC time if not given")
    args = parser.parse_args(argv)

    spark = build_session()
    stamp = args.snapshot_ts or snapshot_id()
    if args.job == "land":
        _fit(spark, sum(files.total_size(spark, p) for p in (args.album_pages, args.track_pages)), args.file_bytes)
        rows = land(
            read_pages(spark, args.album_pages, fmt=args.pages_format),
            read_pages(spark, args.track_pages, fmt=args.pages_format),
            args.base,
            stamp,
            args.album_limit,
            args.track_limit,
            whole=not args.any_offsets,
            sized=bool(args.file_bytes),
        )
    else:
        _fit(spark, bronze_text_bytes(spark, args.base), args.file_bytes)
        rows = run(spark, args.base, stamp, args.strict, args.date_format, bool(args.file_bytes))
    for name, n in rows.items():
        print(f"{name}: {n} rows in snapshot {stamp}")


if __name__ == "__main__":
    main()
