"""Command line: identify the PDFs of a folder, review what is not certain, and write records, tables and summaries."""

from __future__ import annotations

import argparse
import json
import os
import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators import authority as A
from .plans import hard_cases as H
from .plans import main_pass as M
from .plans import records as P
from .plans import review as R
from .sources import connectors, files
from .sources.sinks import SUMMARY_FIELDS, exists, write_report

#: Seconds between calls to a source, all tasks together.
PAUSE = {"crossref": 0.2, "crossref_title": 0.2}
PLAIN_PAUSE = 0.03
ANSWER_COLUMNS = "doi_key string, source string, resolved boolean, doi string, title string, authors array<string>, container string, publisher string, year string, type string, error string"


def options(argv: list[str] | None = None) -> argparse.Namespace:
    p = argparse.ArgumentParser(description=__doc__)
    add, flag = p.add_argument, lambda *names, **k: p.add_argument(*names, action="store_true", **k)
    add("input_dir")
    add("--output-dir", required=True)
    flag("--recursive")
    flag("--fast", help="read the head of large files only")
    add("--grobid-metadata", "--side-table", dest="side_table", help="tab-separated or JSON-lines metadata by file name")
    add("--grobid-endpoint", default="", help="address of a service that reads PDF headers")
    flag("--grobid-on-missing", help="ask it where title or authors are missing")
    add("--grobid-timeout", type=float, default=180.0)
    add("--markdown-dir")
    add("--filename-doi-policy", choices=["candidate", "trusted"], default="candidate")
    flag("--validate", help="look unsure identifiers up")
    flag("--validate-all")
    add("--crossref-mailto", default=os.environ.get("CROSSREF_MAILTO", ""), help="contact that is told to the source")
    flag("--fallback-allow-ocr")
    flag("--ocr-metadata-on-grobid-fail", "--ocr-metadata-on-missing", dest="ocr_metadata")
    add("--ocr-pages", type=int, default=3)
    add("--ocr-language", default="eng+chi_sim")
    flag("--llm", help="ask a model for candidates where there is none good")
    add("--llm-base-url", default=os.environ.get("OPENAI_BASE_URL", ""))
    add("--llm-model", default=os.environ.get("OPENAI_MODEL", ""))
    add("--llm-api-key", default=os.environ.get("OPENAI_API_KEY", ""))
    add("--llm-timeout", type=float, default=120.0)
    flag("--no-review-postprocess", "--no-review", dest="no_review")
    flag("--no-review-authority", help="review by stored scores alone")
    add("--authority-workers", type=int, default=8)
    add("--authority-timeout", type=float, default=20.0)
    flag("--no-hardcase-postprocess", "--no-hard-cases", dest="no_hard_cases")
    flag("--no-hardcase-title-search")
    add("--hardcase-workers", type=int, default=6)
    add("--hardcase-timeout", type=float, default=15.0)
    add("--hardcase-pdf-pages", type=int, default=4)
    add("--workers", type=int, default=0, help="tasks that read files; as many as there are cores if 0")
    add("--authority-table", help="kept answers (Parquet: doi_key, source, resolved, doi, title, authors, error)")
    add("--search-table", help="kept title searches (Parquet: query_key, source, rank, doi, title, authors)")
    flag("--offline", help="ask no live source: kept answers and caches only")
    return p.parse_args(argv)


def live_sources(o: argparse.Namespace) -> dict[str, object]:
    """Connectors by name. None where everything is offline."""
    if o.offline:
        return {}
    http = lambda name, timeout: connectors.HttpSource(name, timeout, o.crossref_mailto)
    out: dict[str, object] = {"ocr": connectors.LibraryOcr(o.ocr_pages, language=o.ocr_language), "review": http("doi.org", o.authority_timeout)}
    out |= {name: http(name, 20.0) for name in ("crossref", "crossref_title")}
    out |= {f"hard_{name}": http(name, o.hardcase_timeout) for name in ("doi.org", "crossref", "datacite", "osti", "crossref_title", "datacite_title")}
    if o.grobid_endpoint:
        out["header"] = connectors.HeaderService(o.grobid_endpoint, o.grobid_timeout)
    if o.llm_base_url and o.llm_model and o.llm_api_key:
        out["llm"] = connectors.ChatSource(o.llm_base_url, o.llm_model, o.llm_api_key, o.llm_timeout)
    return out


class Run:
    """One run: its tables in the output folder, its caches and its sources."""

    def __init__(self, spark: SparkSession, o: argparse.Namespace, sources: dict[str, object]):
        self.spark, self.o, self.sources, self.out, self.report = spark, o, sources, o.output_dir, {}

    def kept(self, df: DataFrame, name: str) -> DataFrame:
        """Written and read again: extraction and look-ups run once, whatever reads them."""
        df.write.mode("overwrite").parquet(f"{self.out}/{name}.parquet")
        return self.spark.read.parquet(f"{self.out}/{name}.parquet")

    def cached(self, name: str, wanted: DataFrame, cache: str, keep_errors: bool = True, workers: int = 8, again: DataFrame | None = None) -> DataFrame:
        """key, source, value, error of the wanted keys, from the cache or, where that lacks them, from the source.

        again: keys that are asked for once more if what is kept of them is an error.
        """
        path, source = f"{self.out}/{cache}", self.sources.get(name)
        schema = "key string, value string, error string, time double"
        old = A.cache_lines(self.spark, path).drop("line") if exists(self.spark, path) else self.spark.createDataFrame([], schema)
        old = A.latest(old if keep_errors else A.usable(old), ["key"], "time")
        if source is not None:
            missing = A.misses(wanted, old, "key")
            if again is not None:
                missing = missing.unionByName(again.select("key").join(old.filter("error is not null"), "key", "left_semi")).distinct()
            new = self.kept(A.fetched(missing, source, max(1, workers), PAUSE.get(name.removeprefix("hard_"), PLAIN_PAUSE)), f"asked_{name}_{cache.split('.')[0]}").drop("source")
            A.append_cache(new, path, keep_errors)
            old = A.latest(old.select(new.columns).unionByName(new), ["key"], "time")
        return old.join(wanted.select("key").distinct(), "key", "left_semi")

    def identified(self) -> DataFrame:
        o = self.o
        found = files.inventory(self.spark, o.input_dir, o.recursive, o.fast)
        if o.workers:
            found = found.repartition(o.workers)
        none = F.array().cast("array<string>")
        hits = self.kept(files.file_hits(found, text_pages=o.hardcase_pdf_pages), "hits")
        records = hits.withColumn("authors", F.when(F.col("author").isNotNull(), F.array("author")).otherwise(none)).drop("author")
        records = records.withColumns({c: F.lit("") for c in ("year", "journal", "publisher", "abstract", "error")}).withColumn("name_key", F.lower("filename"))
        side = files.side_table(self.spark, o.side_table) if o.side_table else self.spark.createDataFrame([], ", ".join(f"{c} string" for c in ("name_key", *files.SIDE)))
        records = records.join(side.select("name_key", *[F.col(c).alias(f"s_{c}") for c in files.SIDE]), "name_key", "left")
        if o.grobid_on_missing and "header" in self.sources:
            want = records.filter(M.needs_header(F.col("s_title"), F.col("s_authors"))).select("path")
            headers = self.kept(connectors.read_files(found.join(want, "path", "left_semi"), self.sources["header"]), "headers")
            records = M.with_header(records, headers)
        else:
            records = records.withColumn("header_error", F.lit(None).cast("string"))
        mine = records.select("path", *[F.col(f"s_{c}").alias(c) for c in files.SIDE]).withColumnRenamed("path", "name_key")
        shown = {f"grobid_{c}": F.coalesce(F.col(f"s_{c}"), F.lit("")) for c in ("title", "authors")} | {"grobid_doi": M.candidate(F.col("s_doi"))}
        records = M.with_hits(records, records.select("path", M.one_hit(F.col("s_doi"), "grobid_doi", "GROBID header metadata").alias("more"))).withColumns(shown)
        records = P.with_side_metadata(records.drop(*[f"s_{c}" for c in files.SIDE]).withColumn("name_key", F.col("path")), mine).drop("name_key")
        records = records.withColumn("metadata_source", F.when(F.col("metadata_source") != "", F.concat(F.lit("pdf+"), F.col("metadata_source"))).otherwise("pdf"))
        if o.fallback_allow_ocr and o.ocr_metadata and "ocr" in self.sources:
            records = self.with_ocr(records, M.needs_ocr_metadata(F.col("title"), F.col("authors"), F.col("header_error")), "ocr_metadata", True)
        if o.markdown_dir:
            named = found.select("path", "filename", "stem")
            texts = files.with_side_text(named, files.side_texts(self.spark, o.markdown_dir)).select("path", files.section_hits(F.coalesce("side_text", F.lit(""))).alias("more"))
            records = M.with_hits(records, texts)
        return self.decided(records, found)

    def with_ocr(self, records: DataFrame, gate, name: str, metadata: bool) -> DataFrame:
        """Rows behind the gate that have not been read yet."""
        want = self.kept(records.filter(gate).select("path"), f"{name}_wanted")
        found = files.inventory(self.spark, self.o.input_dir, self.o.recursive).join(want, "path", "left_semi")
        return self.kept(M.with_ocr(records, self.kept(connectors.read_files(found, self.sources["ocr"]), f"{name}_read"), metadata), name)

    def decided(self, records: DataFrame, found: DataFrame) -> DataFrame:
        o, check = self.o, self.o.validate or self.o.validate_all
        choose = lambda df: M.chosen(df, o.filename_doi_policy)
        records = self.kept(choose(records), "chosen")
        more = M.needs_more(F.col("doi"), F.col("confidence"))
        if check:
            want = records.filter(M.needs_title_search(F.col("doi"), F.col("title"))).select("path", "title")
            cache = self.cached("crossref_title", want.select(F.trim("title").alias("key")), "title_search_cache.jsonl", keep_errors=False)
            records = self.kept(choose(M.with_hits(records, M.title_hits(want, cache))), "searched")
            records = self.looked_up(records, M.needs_look_up(F.col("doi"), F.col("confidence"), o.validate_all), "title_author_verified", "verified")
        if o.fallback_allow_ocr and "ocr" in self.sources:
            unread = F.col("ocr_error").isNull() & F.col("ocr_title").isNull() if "ocr_title" in records.columns else F.lit(True)
            open_ = self.kept(records.filter(more).select("path"), "ocr_open")
            records = self.again(self.with_ocr(records, more & unread, "ocr", False), open_, "ocr_candidate_title_author_verified", "ocr_chosen",
                M.needs_look_up(F.col("doi"), F.col("confidence"), o.validate_all))
        if o.llm and "llm" in self.sources:
            asked = self.kept(records.filter(more).select("path", M.model_prompt(F.col("title"), F.col("authors"), F.col("page_text")).alias("key")), "asked")
            answers = self.cached("llm", asked.select("key"), "llm_cache.jsonl")
            records = self.again(M.with_hits(records, M.model_hits(asked, answers)), asked.select("path"), "llm_candidate_title_author_verified", "llm_chosen", F.col("doi") != "")
        records = records.withColumn("method", F.col("doi_decision"))
        return self.kept(records.withColumns({c: F.lit("") for c in ("doi_validation_source", "doi_validation_score") if c not in records.columns}), "identified")

    def again(self, records: DataFrame, open_: DataFrame, decision: str, name: str, gate) -> DataFrame:
        """Chooses again for rows that were open, and looks those up."""
        part = self.kept(M.chosen(records.join(open_, "path", "left_semi"), self.o.filename_doi_policy), f"{name}_open")
        if self.o.validate or self.o.validate_all:
            part = self.looked_up(part, gate, decision, f"{name}_verified")
        rest = records.join(open_, "path", "left_anti")
        return self.kept(rest.unionByName(part, allowMissingColumns=True), name)

    def looked_up(self, records: DataFrame, gate, decision: str, name: str) -> DataFrame:
        wanted = records.filter(gate).select(F.lower(M.normalize(F.col("doi"))).alias("key"))
        cache = self.cached("crossref", wanted, "metadata_validation_cache.jsonl", keep_errors=False)
        return self.kept(M.verified(records, M.works(cache), gate, decision), name)

    def answers(self, records: DataFrame, keys: DataFrame, names: tuple[str, ...], cache: str, workers: int, again: DataFrame | None = None) -> DataFrame:
        """Kept answers and those of live sources, as one table."""
        parts = [self.spark.read.parquet(self.o.authority_table)] if self.o.authority_table else [self.spark.createDataFrame([], ANSWER_COLUMNS)]
        for name in names:
            source = name.removeprefix("hard_").replace("review", "doi.org")
            if name in self.sources or exists(self.spark, f"{self.out}/{cache.format(source)}"):
                got = self.cached(name, keys, cache.format(source), workers=workers, again=again)
                bad = F.col("error").isNotNull() | F.col("value").isNull()
                a = F.when(~bad, A.parsed(source, F.col("value")))
                parts.append(got.select(F.col("key").alias("doi_key"), F.lit(source).alias("source"), (~bad).alias("resolved"), a.alias("a"),
                    "error").selectExpr("doi_key", "source", "resolved", "coalesce(nullif(a.authority_doi, ''), doi_key) AS doi", "a.title", "a.authors", "a.container",
                    "a.publisher", "a.year", "a.type", "error"))
        out = parts[0]
        for part in parts[1:]:
            out = out.unionByName(part, allowMissingColumns=True)
        return out

    def reviewed(self, records: DataFrame) -> DataFrame:
        o = self.o
        sources = F.concat(F.array(F.coalesce("doi_source", F.lit(""))),
            F.transform(F.filter(F.coalesce("doi_candidates", F.array().cast(dict(records.dtypes)["doi_candidates"])), lambda c: F.lower(c["doi"]) == F.lower(F.col("doi"))), lambda c: c["source"]))
        t, a = R.stored_scores(F.col("doi_validation_score"))
        asked = records.withColumns({"sources": sources, "old_t": t, "old_a": a})
        if o.no_review_authority or not (o.authority_table or "review" in self.sources or exists(self.spark, f"{self.out}/doi_authority_cache.jsonl")):
            decided = R.review(asked, None)
        else:
            targets = records.filter(F.col("status") != "ok")
            keys = targets.select(F.lower(M.normalize(F.col("doi"))).alias("key")).filter("key <> ''")
            first = self.kept(self.answers(targets, keys, ("review",), "doi_authority_cache.jsonl", o.authority_workers), "answers")
            errors = keys.join(A.one_answer(first).select(F.col("doi_key").alias("key"), "error"), "key", "left").withColumn("job", F.explode(A.retry_jobs(F.col("key"), F.col("error"))))
            jobs = errors.select(F.lower("job.doi").alias("key"), "job.force").distinct()
            second = self.kept(self.answers(targets, keys.unionByName(jobs.select("key")), ("review",), "doi_authority_cache.jsonl", o.authority_workers, jobs.filter("force")), "answers_again")
            decided = R.review(asked, first, retried=second)
        decided = self.kept(decided, "review")
        done = decided.agg(F.count("*").alias("target_rows"), F.count_if("accepted").alias("accepted_rows")).first()
        counts = P.summary(decided, ["decision", "stage"]).collect()
        self.report["review_postprocess"] = {"enabled": True, "target_rows": done[0], "accepted_rows": done[1], "remaining_target_rows": done[0] - done[1],
            **{k: {r["value"]: r["n"] for r in counts if r["metric"] == k} for k in ("decision", "stage")}}
        write_report(self.spark, f"{self.out}/review_postprocess_summary.json", self.report["review_postprocess"])
        return self.kept(R.applied(records, decided), "reviewed")

    def hard(self, records: DataFrame) -> DataFrame:
        o, targets = self.o, records.filter(F.coalesce("status", F.lit("")) != "ok")
        keys = H.candidates(targets).select(F.lower("doi").alias("key"))
        answers = self.answers(targets, keys, ("hard_osti", "hard_doi.org", "hard_crossref", "hard_datacite"), "hardcase_{}_cache.jsonl", o.hardcase_workers)
        searches = None
        if not o.no_hardcase_title_search:
            searches = self.spark.read.parquet(o.search_table) if o.search_table else self.searches(targets)
        result = self.kept(H.hard_cases(records, answers, searches), "hard_cases")
        done = result.agg(F.count("*").alias("n"), F.count_if("accepted").alias("ok")).first()
        if done[0]:
            by = {c: {r["value"]: r["n"] for r in P.summary(df, [c]).collect() if r["metric"] == c} for df,
                c in ((result.filter("accepted"), "confidence"), (result.filter("accepted"), "source"), (result, "decision"))}
            self.report["hardcase_postprocess"] = {"enabled": True, "target_rows": done[0], "accepted_rows": done[1], "remaining_target_rows": done[0] - done[1],
                "accepted_by_confidence": by["confidence"], "accepted_by_source": by["source"], "result_reason": by["decision"]}
            write_report(self.spark, f"{self.out}/hardcase_postprocess_summary.json", self.report["hardcase_postprocess"])
        else:
            self.report["hardcase_postprocess"] = {"enabled": True, "target_rows": 0, "accepted_rows": 0, "remaining_target_rows": 0}
        return H.applied(records, result)

    def searches(self, targets: DataFrame) -> DataFrame | None:
        """Live title searches of records that may need one."""
        if "hard_crossref_title" not in self.sources:
            return None
        keys = targets.select(F.trim("title").alias("key")).filter(H.searchable_title(F.col("key")))
        found = [self.cached(f"hard_{s}_title", keys, f"hardcase_{s}_title_cache.jsonl", workers=self.o.hardcase_workers).select("key",
            F.lit(f"{s}_title_search").alias("source"), A.search_results(s, F.col("value")).alias("items")) for s in ("crossref", "datacite")]
        rows = found[0].unionByName(found[1]).select("key", "source", F.posexplode("items").alias("rank", "a"))
        return rows.select(H.norm_text(F.col("key")).alias("query_key"), "source", "rank", F.col("a.authority_doi").alias("doi"), "a.title", "a.authors", "a.container",
            "a.publisher", "a.year", "a.type")


def run(spark: SparkSession, o: argparse.Namespace, sources: dict[str, object] | None = None, told: Callable[[str], None] | None = None) -> dict:
    """sources: connectors in place of the live ones."""
    began, r = time.time(), Run(spark, o, live_sources(o) if sources is None else sources)
    tell = told or (lambda _: None)
    records = r.identified()
    tell("identified")
    if not o.no_review:
        records = r.reviewed(records)
        tell("reviewed")
    if not o.no_hard_cases:
        records = r.hard(records)
        tell("hard cases")
    records = r.kept(records.drop("hits", "page_text", "text", "header_error"), "records")
    files.write_json(records, f"{r.out}/metadata.jsonl")
    files.write_table(records.orderBy("path"), f"{r.out}/metadata.tsv", SUMMARY_FIELDS)
    counts = {x["status"]: x["count"] for x in records.groupBy("status").count().collect()}
    return {"rows": sum(counts.values()), "status": counts, "elapsed_seconds": round(time.time() - began, 3), "jsonl": f"{r.out}/metadata.jsonl", "tsv": f"{r.out}/metadata.tsv", **r.report}


def main(argv: list[str] | None = None) -> None:
    print(json.dumps(run(SparkSession.builder.appName("refloom").getOrCreate(), options(argv)), ensure_ascii=False))


if __name__ == "__main__":
    main()
