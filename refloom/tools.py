"""Command line of the later passes over a manifest (tab-separated): hard-cases, round2, ocr, layout, panel.

Answers and searches are kept tables; text is read from PDFs under BASE/files/<folder>/<filename>.
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .functions.text import clean, parse_authors
from .plans import follow_up as U
from .plans import hard_cases as H
from .plans import review_queue as Q
from .sources import connectors, files
from .sources.sinks import write_report, write_text

PREFIX = {"hard-cases": "hardcase", "round2": "round2", "ocr": "ocr", "layout": "llm_md"}


def options(argv: list[str] | None = None) -> argparse.Namespace:
    p = argparse.ArgumentParser(description=__doc__)
    p.add_argument("tool", choices=[*PREFIX, "panel"])
    p.add_argument("input_tsv")
    p.add_argument("--output-dir", required=True)
    p.add_argument("--local-base")
    p.add_argument("--authority-table", help="kept answers (Parquet)")
    p.add_argument("--search-table", help="kept title searches (Parquet)")
    p.add_argument("--model-table", help="a model's answers (Parquet: path, value)")
    p.add_argument("--markdown-results", help="results of layout, for the panel")
    p.add_argument("--ocr-results", help="results of ocr, for the panel")
    p.add_argument("--filter-decision", default="")
    p.add_argument("--all", action="store_true")
    p.add_argument("--max-existing-text-chars", type=int, default=U.LOW_TEXT)
    p.add_argument("--pdf-pages", type=int, default=6)
    p.add_argument("--max-chars", type=int, default=12_000)
    p.add_argument("--ocr-pages", type=int, default=2)
    p.add_argument("--ocr-dpi", type=int, default=300)
    p.add_argument("--ocr-language", default="eng+chi_sim+jpn+deu+fra+por+rus")
    p.add_argument("--thumb-dpi", type=int, default=110)
    return p.parse_args(argv)


def stored(spark: SparkSession, base: str | None) -> DataFrame | None:
    """folder, filename, content and the rest of the PDFs under a base."""
    if not base:
        return None
    found = files.inventory(spark, f"{base.rstrip('/')}/files", recursive=True)
    return found.withColumn("folder", F.regexp_extract("path", r"/files/(.*)/[^/]*$", 1)).withColumnRenamed("path", "stored_path")


def run(spark: SparkSession, o: argparse.Namespace, reader: connectors.Reader | None = None) -> dict:
    manifest = files.manifest(spark, o.input_tsv)
    rows = manifest.withColumns({c: F.coalesce(F.col(c) if c in manifest.columns else F.lit(""), F.lit("")) for c in ("folder", "filename", "doi", "title", "authors")})
    pdfs = stored(spark, o.local_base)
    rows = rows.withColumn("_n", F.monotonically_increasing_id())
    where = rows.join(pdfs.select("folder", "filename", "stored_path"), ["folder", "filename"], "left") if pdfs is not None else rows.withColumn("stored_path", F.lit(None).cast("string"))
    rows = where.withColumn("pdf_path", Q.pdf_path(manifest.columns, F.col("stored_path"))).withColumn("path",
        F.concat_ws("\t", "folder", "filename", F.col("_n").cast("string"))).drop("_n", "stored_path")
    rows.write.mode("overwrite").parquet(f"{o.output_dir}/rows.parquet")
    rows = spark.read.parquet(f"{o.output_dir}/rows.parquet")
    if o.tool == "panel":
        return panel(spark, o, rows)
    answers = spark.read.parquet(o.authority_table)
    searches = spark.read.parquet(o.search_table) if o.search_table else spark.createDataFrame([], "query_key string, source string, rank int, doi string, title string, authors array<string>")
    targets = U.ocr_targets(rows, o.all, o.max_existing_text_chars) if o.tool == "ocr" else U.layout_targets(rows, o.filter_decision)
    content = targets.select("path", "folder", "filename").join(pdfs.select("folder", "filename", "content"), ["folder", "filename"]) if pdfs is not None else None
    none = spark.createDataFrame([], "path string, text string")
    pages = lambda: content.select("path", F.array_join(files.pdf_text(F.col("content"), o.pdf_pages)["pages"], "\n").alias("text")) if content is not None else none
    listed = targets.withColumn("authors", parse_authors(F.col("authors")))
    if o.tool == "ocr":
        empty = spark.createDataFrame([], "path string, read string, error string")
        read = connectors.read_files(content, reader or connectors.LibraryOcr(o.ocr_pages, o.ocr_dpi, o.ocr_language)) if content is not None else empty
        result = U.ocr(targets, read, answers)
    elif o.tool == "layout":
        said = spark.read.parquet(o.model_table) if o.model_table else None
        result = U.layout(targets, pages().withColumn("text", F.substring("text", 1, o.max_chars)), answers, searches, said)
    else:
        whole = listed.join(pages(), "path", "left").withColumn("text", F.coalesce("text", F.lit("")))
        result = U.round2(whole, answers, searches) if o.tool == "round2" else H.hard_cases(whole.withColumn("status", F.lit("review")), answers, searches)
    prefix = PREFIX[o.tool]
    U.beside(targets, result, prefix).drop("path").write.mode("overwrite").parquet(f"{o.output_dir}/{prefix}.parquet")
    table = spark.read.parquet(f"{o.output_dir}/{prefix}.parquet").orderBy("folder", "filename")
    for name, df in U.parts(table, prefix).items():
        files.write_table(df, f"{o.output_dir}/{prefix}_{name}.tsv")
    told = U.report(table, prefix, rows.count())
    write_report(spark, f"{o.output_dir}/{prefix}_summary.json", told)
    return told


def panel(spark: SparkSession, o: argparse.Namespace, rows: DataFrame) -> dict:
    """The review queue, a template for decisions and a page to read them on."""
    keyed = lambda path, column: files.keyed(files.manifest(spark, path).withColumn("_n",
        F.monotonically_increasing_id()).select(*[clean(F.col(c)).alias(c) for c in Q.KEY], F.col(column).alias("candidate_doi"), "_n"),
        Q.KEY, "_n")
    none = spark.createDataFrame([], "folder string, filename string, candidate_doi string")
    queue = Q.review_queue(rows, keyed(o.markdown_results, "llm_md_candidate_doi") if o.markdown_results else none, keyed(o.ocr_results, "ocr_candidate_doi") if o.ocr_results else none)
    queue.write.mode("overwrite").parquet(f"{o.output_dir}/queue.parquet")
    queue = spark.read.parquet(f"{o.output_dir}/queue.parquet")
    files.write_table(Q.queue_table(rows, queue), f"{o.output_dir}/review_queue.tsv")
    files.write_table(Q.decision_template(queue), f"{o.output_dir}/review_decisions_template.tsv")
    errors = {}
    if (pdfs := stored(spark, o.local_base)) is not None:
        drawn = connectors.read_files(pdfs.join(queue.select(*Q.KEY), Q.KEY, "left_semi").withColumn("path", F.concat_ws("/", *Q.KEY)), connectors.Thumbnail(o.thumb_dpi))
        drawn.write.mode("overwrite").parquet(f"{o.output_dir}/thumbs.parquet")
        errors = {r["path"]: r["error"] for r in spark.read.parquet(f"{o.output_dir}/thumbs.parquet").filter("error is not null").limit(5000).collect()}
    told = {"rows": queue.count(), "by_action": {r["action"]: r["count"] for r in Q.action_counts(queue).collect()}, "thumb_errors": errors}
    write_report(spark, f"{o.output_dir}/manual_review_summary.json", told)
    write_text(spark, f"{o.output_dir}/index.html", Q.review_page(queue))
    return told


def main(argv: list[str] | None = None) -> None:
    print(json.dumps(run(SparkSession.builder.appName("refloom").getOrCreate(), options(argv)), ensure_ascii=False))


if __name__ == "__main__":
    main()
