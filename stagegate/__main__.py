"""Command line: validate one dataset from the two JSON config files.

    python -m stagegate --file-config datasets.json --schema-config schemas.json \\
        --dataset orders_data --mode both [--output results_path]

Prints the result rows and the summary; with ``--output`` the result rows are
also written as Parquet.  The session comes from
``SparkSession.builder.getOrCreate()``, so master and resources are whatever
``spark-defaults.conf`` / ``PYSPARK_SUBMIT_ARGS`` configure.
Exit status: 0 when every check passed, 1 otherwise.
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from .plans.suites import summarize
from .sources.config import validate_dataset


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="stagegate", description=__doc__.splitlines()[0])
    ap.add_argument("--file-config", required=True, help="JSON file with each dataset's layer paths, key, SCD type, ...")
    ap.add_argument("--schema-config", help="JSON file with the expected staging/target schema of each dataset")
    ap.add_argument("--dataset", required=True, help="name of the dataset entry to validate")
    ap.add_argument(
        "--mode", default="both", choices=["source_to_staging", "staging_to_target", "both"], help="stages to check"
    )
    ap.add_argument("--output", help="write the result rows here (Parquet, appended)")
    ap.add_argument("--parallelism", type=int, default=4, help="checks submitted to Spark at once")
    ap.add_argument("--cache", action="store_true", help="cache the loaded layers while the checks run")
    args = ap.parse_args(argv)

    spark = SparkSession.builder.appName("stagegate").getOrCreate()
    results = validate_dataset(
        spark, args.dataset, args.file_config, args.schema_config, args.mode, persist=args.cache, parallelism=args.parallelism
    ).cache()
    shown = results.select("stage", "seq", "check", "status", "violation_count", "details").orderBy("stage", "seq")
    shown.show(results.count(), truncate=False)  # a row per check
    summary = summarize(results)
    summary.orderBy("dataset", "stage").show(truncate=False)
    if args.output:
        results.write.mode("append").parquet(args.output)
    total = summary.where("dataset IS NULL").first()
    results.unpersist()
    return 0 if total is not None and total["failed"] == 0 else 1


if __name__ == "__main__":
    sys.exit(main())
