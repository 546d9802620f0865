"""Command line of the job: `spark-submit … -m starmart` or `python -m starmart`."""

from __future__ import annotations

import argparse
import logging
from collections.abc import Sequence

from starmart import session
from starmart.operators import dims
from starmart.plans import etl
from starmart.sources import sinks

log = logging.getLogger("starmart")


def parser() -> argparse.ArgumentParser:
    args = argparse.ArgumentParser(prog="starmart", description=__doc__)
    args.add_argument("--input-path", required=True, help="folder of raw arrivals (parquet)")
    args.add_argument("--staging-path", required=True, help="folder of lookup CSV files")
    args.add_argument("--output-path", required=True, help="folder for the star tables")
    args.add_argument("--rejected-path", required=True, help="folder for rejected rows and their summary")
    args.add_argument("--s3-bucket", default=None, help="bucket name, for the log only")
    args.add_argument("--s3-prefix", default="immigration", help="folder within the bucket, for the log only")
    args.add_argument("--format", choices=sinks.FORMATS, default="parquet", help="format of the star tables")
    args.add_argument("--drop-columns", nargs="*", default=[], help="raw columns to leave out of the scan, and so of the quarantine")
    args.add_argument("--by-month", action="store_true", help="lay the fact table out by arrival month")
    args.add_argument("--skip-corrupt", action="store_true", help="pass over unreadable input files")
    args.add_argument("--flat-quarantine", action="store_true", help="rejected rows as flat, repaired columns")
    args.add_argument("--visa-full-grain", action="store_true", help="visa table by post and class, not one row per type")
    args.add_argument("--date-start", default=dims.DATE_START, help="first day of the date table, if no fact is earlier")
    args.add_argument("--date-end", default=dims.DATE_END, help="last day of the date table, if no fact is later")
    return args


def main(argv: Sequence[str] | None = None) -> int:
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(message)s")
    args = parser().parse_args(argv)
    log.info("bucket %s, prefix %s", args.s3_bucket, args.s3_prefix)
    result = etl.run(
        session.build(),
        args.input_path,
        args.staging_path,
        args.output_path,
        args.rejected_path,
        fmt=args.format,
        drop_columns=args.drop_columns,
        by_month=args.by_month,
        skip_corrupt=args.skip_corrupt,
        flat_quarantine=args.flat_quarantine,
        visa_full_grain=args.visa_full_grain,
        date_start=args.date_start,
        date_end=args.date_end,
    )
    for name, rows in result.rows.items():
        log.info("%s: %d rows", name, rows)
    for name in result.skipped_rules:
        log.warning("rule %s skipped: column or lookup missing", name)
    for name in result.skipped_tables:
        log.warning("table %s skipped: column or lookup missing", name)
    for name in result.skipped_files:
        log.warning("file %s could not be read, or only in part", name)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
