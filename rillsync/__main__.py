"""python -m rillsync CONFIG [--once]: run the synchroniser of a configuration file until it is stopped."""

from __future__ import annotations

import argparse
import logging
import sys

from pyspark.sql import SparkSession

from rillsync.sources.config import load_config
from rillsync.streaming.program import Program


def main(argv: list[str] | None = None) -> int:
    args = argparse.ArgumentParser(prog="rillsync", description="Synchronise tables by their change events.")
    args.add_argument("config", help="properties file; the sources' table maps lie beside it")
    args.add_argument("--once", action="store_true", help="take what there is and end")
    given = args.parse_args(argv)
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(levelname)s %(message)s")
    config = load_config(given.config)
    spark = SparkSession.builder.appName("rillsync").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    program = Program(spark, config, given.once)
    program.stop_on_signals()
    return program.run()


if __name__ == "__main__":
    sys.exit(main())
