"""Writes the lookups of a value-format catalog as CSV: `python -m starmart.catalog CATALOG STAGING`."""

from __future__ import annotations

import argparse
import logging
from collections.abc import Sequence

from starmart import session
from starmart.sources import lookups

log = logging.getLogger("starmart.catalog")


def main(argv: Sequence[str] | None = None) -> int:
    args = argparse.ArgumentParser(prog="starmart.catalog", description=__doc__)
    args.add_argument("catalog", help="file of value formats")
    args.add_argument("staging", help="folder for the lookup CSV files that the job reads")
    args.add_argument("--partial", action="store_true", help="don't insist on the lookups that the job requires")
    given = args.parse_args(argv)
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(message)s")
    spark = session.build()
    found = lookups.from_format_catalog(spark, given.catalog)
    present = lookups.names(found)
    if not given.partial:
        lookups.require(present)
    lookups.write_csv(found, given.staging)
    log.info("lookups written: %s", ", ".join(present))
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
