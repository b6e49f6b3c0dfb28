"""What a run writes besides its tables: the fixed columns of its summary table, and reports."""

from __future__ import annotations

import json

from pyspark.sql import SparkSession

from ..plans.hard_cases import SHOWN

# Columns of the summary table, in this order.
SUMMARY_FIELDS = [
    "filename", "path", "status", "method", "doi", "confidence", "doi_decision", "doi_source", "metadata_source", "title", "authors", "year", "journal", "publisher", "abstract",
    "grobid_doi", "grobid_title", "grobid_authors", "ocr_title", "ocr_authors", "ocr_error", "title_source", "authors_source", "doi_validation_source", "doi_validation_score",
    "original_status", "original_method", "original_doi", "original_confidence", "review_stage", "postprocess_decision", "postprocess_confidence", "postprocess_reason",
    "authority_doi", "authority_title", "authority_authors", "authority_container", "authority_publisher", "authority_type", "authority_year", "authority_title_score", "authority_author_score",
    "authority_error", "corrected_doi", "tried_dois", *SHOWN, "doi_candidates", "error",
]


def _file(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    p, system = _file(spark, path)
    return system.exists(p)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file, by whatever file system the path has."""
    p, system = _file(spark, path)
    out = system.create(p, True)
    out.write(text.encode())
    out.close()


def write_report(spark: SparkSession, path: str, report: dict) -> None:
    write_text(spark, path, json.dumps(report, ensure_ascii=False, indent=2))
