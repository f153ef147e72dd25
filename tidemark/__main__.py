"""python -m tidemark ARGUMENTS TABLES SETTINGS: run the scan job. Each is the path of a JSON file that Spark can read: the
run's arguments, the names of the view and the output tables, and the deployment's roots."""

from __future__ import annotations

import sys

from pyspark.sql import SparkSession

from tidemark.plans import job
from tidemark.sources.paths import RuntimeArgs, Settings, TableConfig, read_text


def main(argv: list[str], spark: SparkSession | None = None) -> int:
    if len(argv) != 3:
        print(__doc__, file=sys.stderr)
        return 2
    own = spark is None
    spark = spark or SparkSession.builder.appName("tidemark").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    try:
        args, config, settings = (kind.parse(read_text(spark, path)) for kind, path in zip((RuntimeArgs, TableConfig, Settings), argv, strict=True))
        job.run_files(spark, args, config, settings)
    finally:
        if own:
            spark.stop()
    return 0


if __name__ == "__main__":
    sys.exit(main(sys.argv[1:]))
