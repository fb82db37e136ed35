"""Run metadata and reports: small texts that the driver reads and writes by Spark's file systems."""

from __future__ import annotations

import json

from pyspark.sql import SparkSession

#: The head of a report, and the labels of metadata keys.
TITLE = "BUSINESS ENTITY RESOLUTION"
RULE = "=" * 60
VALIDATION = {
    "validation_f05": "Validation Macro F0.5", "validation_precision": "Validation Precision", "validation_recall": "Validation Recall", "validation_f1": "Validation Macro F1",
    "candidate_recall": "Candidate Recall", "singleton_accuracy": "Singleton Accuracy", "false_positives": "False Positives", "false_negatives": "False Negatives",
}


def read_metadata(spark: SparkSession, path: str) -> dict:
    """The metadata of a model. A missing threshold is 0.70 for S2 and 0.75 for S3, any other missing value N/A."""
    found = json.loads(spark.read.text(path, wholetext=True).first()[0])
    return {"optimal_s2_threshold": 0.70, "optimal_s3_threshold": 0.75} | dict.fromkeys(VALIDATION, "N/A") | found


def write_text(spark: SparkSession, path: str, text: str) -> None:
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    out = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).create(where, True)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()


def final_report(sections: dict) -> str:
    """A section per key: of a dict its pairs, of a list its items, else the value."""
    out = [RULE, TITLE, "FINAL PIPELINE REPORT", RULE, ""]
    for name, content in sections.items():
        out.append(f"[{name}]")
        if isinstance(content, dict):
            out += [f"  {k:<30}: {v}" for k, v in content.items()]
        elif isinstance(content, list):
            out += [f"  - {x}" for x in content]
        else:
            out.append(f"  {content}")
        out.append("")
    return "\n".join(out) + "\n"


def metrics_report(sections: dict[str, dict]) -> str:
    """A section per key, of pairs or of named groups of pairs."""
    out = [RULE, TITLE, "COMPLETE METRICS REPORT (TRAIN, VALIDATION & TEST)", RULE, ""]
    for name, pairs in sections.items():
        out.append(f"[{name}]")
        for k, v in pairs.items():
            if isinstance(v, dict):
                out.append(f"  {k}:")
                out += [f"    {a:<25}: {b}" for a, b in v.items()]
            else:
                out.append(f"  {k:<30}: {v}")
        out.append("")
    return "\n".join(out) + "\n"
