"""Command line: ``python -m millrace <command> ...``, or the same under spark-submit.

    ingest  DROPS TABLES DATE   land the drops that are new
    stream  DROPS TABLES DATE   the same with a stream checkpoint below TABLES
    refresh TABLES              take what landed through bronze, silver and gold

A failure ends with an error code and leaves the batch pending.
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import SparkSession

from millrace.plans.refine import Layers, ingest
from millrace.session import tune
from millrace.streaming.drops import land_available


def main(arguments: Sequence[str] | None = None, spark: SparkSession | None = None) -> None:
    parser = argparse.ArgumentParser(prog="millrace")
    commands = parser.add_subparsers(dest="command", required=True)
    for name in ("ingest", "stream"):
        command = commands.add_parser(name)
        command.add_argument("drops")
        command.add_argument("tables")
        command.add_argument("date", help="batch date, as YYYY-MM-DD")
        command.add_argument("--min-rows", type=int, default=1)
        command.add_argument(
            "--by-position", action="store_true", help="do not compare header names with the schema"
        )
        if name == "stream":
            command.add_argument("--max-files", type=int, help="files a micro-batch takes at most")
    commands.add_parser("refresh").add_argument("tables")
    given = parser.parse_args(arguments)

    spark = tune(spark or SparkSession.builder.appName("millrace").getOrCreate())
    layers = Layers(spark, given.tables)
    if given.command == "refresh":
        layers.refresh_pending()
    elif given.command == "ingest":
        ingest(
            spark, given.drops, layers.landing, given.date,
            min_rows=given.min_rows, check_header=not given.by_position,
        )
    else:
        checkpoint = f"{given.tables.rstrip('/')}/_checkpoints/landing"
        land_available(
            spark, given.drops, layers.landing, given.date, checkpoint,
            min_rows=given.min_rows, max_files=given.max_files, check_header=not given.by_position,
        )


if __name__ == "__main__":
    main()
