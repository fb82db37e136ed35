"""python -m weftlink: link the record files of a folder."""

from __future__ import annotations

import argparse
import os
import sys

from pyspark.sql import SparkSession

from .operators.blocking import TOP_K
from .plans import job

#: Where record files are looked for, in this order.
FOLDERS = ("dataset/test", "student_resource/dataset/test")


def default_folder() -> str:
    """The first of FOLDERS that is there, else the first."""
    return next((x for x in FOLDERS if os.path.isdir(x)), FOLDERS[0])


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="weftlink", description=__doc__)
    p.add_argument("--test-dir", default=default_folder(), help="folder of test_source1.tsv, test_source2.tsv and test_source3.tsv")
    p.add_argument("--model-path", default="models/final_entity_matcher", help="folder of a saved model")
    p.add_argument("--meta-path", default="models/model_metadata.json", help="thresholds and validation figures")
    p.add_argument("--output-dir", default="output", help="folder of the results")
    p.add_argument("--batch-size", type=int, default=10_000, help="rows that are handed to a model at once")
    p.add_argument("--top-k", type=int, default=TOP_K, help="candidates per reference record")
    p.add_argument("--validate", action=argparse.BooleanOptionalAction, default=True, help="check the written results")
    p.add_argument("--merge", action=argparse.BooleanOptionalAction, default=True, help="one file for each result, rather than a folder of ordered parts")
    return p


def main(argv: list[str] | None = None) -> int:
    args = parser().parse_args(argv)
    spark = (
        SparkSession.builder.appName("weftlink").config("spark.sql.execution.arrow.maxRecordsPerBatch", args.batch_size)
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true").getOrCreate()
    )
    paths = job.Paths(args.test_dir, args.model_path, args.meta_path, args.output_dir)
    sections = job.run(spark, paths, args.top_k, args.merge)
    for k, v in sections["Test Inference Results"].items():
        print(f"{k:<30}: {v}")
    if not args.validate:
        return 0
    broken = job.violations(spark, paths, args.top_k).collect()
    for r in broken:
        print(f"{r['check']}: broken by {r['n']}")
    print("VALIDATION STATUS:", "FAIL" if broken else "PASS")
    return 1 if broken else 0


if __name__ == "__main__":
    sys.exit(main())
