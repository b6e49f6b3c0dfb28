"""The first pass over files: which rows need a header service, OCR, a title search, a look-up or a model, and what these add.

A record keeps its hits as an array in the order in which they were found; more hits go to its end, and the identifier is
chosen again. What is expensive runs on the rows that a gate lets through, and on no others.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.identifiers import candidate, normalize
from ..functions.text import append_message, clean, is_bad_title
from ..operators import authority as A
from ..operators.generated import answered, generated_candidates
from ..sources import files, front_page
from .records import identify

HITS = "array<struct<doi:string,source:string,context:string>>"
UNSURE = ("review", "low", "medium")
SNIPPET = 5000  # characters of page text that a model reads


def no_people(authors: Column) -> Column:
    return F.size(F.coalesce(authors, F.array().cast("array<string>"))) <= 0


def needs_header(side_title: Column, side_authors: Column) -> Column:
    """Whether a header service is asked: the side table has no title or no authors."""
    return (clean(side_title) == "") | (clean(side_authors) == "")


def needs_ocr_metadata(title: Column, authors: Column, header_error: Column) -> Column:
    return (clean(header_error) != "") | is_bad_title(title) | no_people(authors)


def needs_title_search(doi: Column, title: Column) -> Column:
    return (clean(doi) == "") & (F.length(clean(title)) >= 18)


def needs_look_up(doi: Column, confidence: Column, all_rows: bool) -> Column:
    return (clean(doi) != "") & (F.lit(all_rows) | confidence.isin(*UNSURE))


def needs_more(doi: Column, confidence: Column) -> Column:
    """Whether OCR or a model should look for further candidates."""
    return (clean(doi) == "") | (confidence == "review")


def one_hit(doi: Column, source: str, context: str) -> Column:
    """An array of the plausible identifier, or an empty one."""
    hit = F.struct(candidate(doi).alias("doi"), F.lit(source).alias("source"), F.lit(context).alias("context"))
    return F.filter(F.array(hit), lambda h: h["doi"] != "").cast(HITS)


def with_hits(records: DataFrame, more: DataFrame) -> DataFrame:
    """records with further hits (path, more) behind their own."""
    none = F.array().cast(HITS)
    return records.join(more.select("path", F.col("more").cast(HITS).alias("more")), "path", "left").withColumn("hits", F.concat("hits", F.coalesce("more", none))).drop("more")


def chosen(records: DataFrame, policy: str) -> DataFrame:
    """records (path, hits, ...) with the identifier chosen from their hits."""
    found = identify(records.select("path", "hits"), F.col("hits"), policy=policy)
    mine = [c for c in found.columns if c != "path"]
    return records.drop(*mine).join(found, "path")


def with_header(records: DataFrame, headers: DataFrame) -> DataFrame:
    """records with s_title, s_authors ... of the side table, filled from what a service read: headers (path, read, error)."""
    fields = [c for c in files.SIDE if f"s_{c}" in records.columns]
    parsed = headers.select("path", files.tei_header(F.col("read")).alias("h"), F.col("error").alias("header_failure"))
    j = records.join(parsed, "path", "left")
    says = F.coalesce((F.col("h.title") != "") | (F.col("h.authors") != "") | (F.col("h.doi") != ""), F.lit(False))
    fill = {f"s_{c}": F.when(says & (F.col(f"h.{c}") != ""), F.col(f"h.{c}")).otherwise(F.col(f"s_{c}")) for c in fields}
    told = F.when(F.col("header_failure").isNotNull(), F.concat(F.lit("grobid unavailable: "), F.col("header_failure")))
    return j.withColumns(fill).withColumn("header_error", told).drop("h", "header_failure").withColumn("error", append_message(F.col("error"), F.col("header_error")))


def with_ocr(records: DataFrame, pages: DataFrame, metadata: bool) -> DataFrame:
    """records with OCR text of some rows (path, read, error): its title and authors where there are none good, and its hits."""
    read = pages.select("path", front_page.title_authors(F.col("read")).alias("o"), files.section_hits(F.coalesce("read", F.lit("")), "ocr").alias("more"), F.col("error").alias("ocr_failure"))
    j = with_hits(records.drop("ocr_title", "ocr_authors", "ocr_error"), read).join(read.drop("more"), "path", "left")
    new_title = F.lit(metadata) & (F.coalesce(F.col("o.title"), F.lit("")) != "") & is_bad_title(F.col("title"))
    new_people = F.lit(metadata) & (F.size(F.coalesce("o.authors", F.array().cast("array<string>"))) > 0) & no_people(F.col("authors"))
    source = F.when(new_title | new_people, F.concat_ws("+", F.nullif(clean(F.col("metadata_source")), F.lit("")), F.lit("ocr"))).otherwise(F.col("metadata_source"))
    return j.withColumns({
        "ocr_title": F.col("o.title"), "ocr_authors": F.col("o.authors"), "ocr_error": F.col("ocr_failure"), "error": append_message(F.col("error"), F.col("ocr_failure")),
        "title_source": F.when(new_title, "ocr").otherwise(F.col("title_source")), "authors_source": F.when(new_people, "ocr").otherwise(F.col("authors_source")), "metadata_source": source,
        "title": F.when(new_title, F.col("o.title")).otherwise(F.col("title")), "authors": F.when(new_people, F.col("o.authors")).otherwise(F.col("authors")),
    }).drop("o", "ocr_failure")


def works(cache: DataFrame) -> DataFrame:
    """cache (key: an identifier in lower case, value) -> doi_key, work_title, work_authors of answers that are all right."""
    good = cache.filter((F.get_json_object("value", "$.status") == "ok") & F.get_json_object("value", "$.message").startswith("{"))
    a = A.parsed("crossref", F.col("value"))
    return good.select(F.col("key").alias("doi_key"), a.alias("a")).select("doi_key", F.col("a.title").alias("work_title"), F.col("a.authors").alias("work_authors"))


def title_hits(records: DataFrame, cache: DataFrame, k: int = 5) -> DataFrame:
    """path, more: identifiers of the works that a title search found. cache (key: the clean title, value)."""
    items = F.from_json(F.get_json_object("value", "$.message.items"), "array<struct<DOI:string>>")
    hit = lambda i: F.struct(normalize(i["DOI"]).alias("doi"), F.lit("crossref_title_search").alias("source"), F.lit("title search").alias("context"))
    found = cache.select("key", F.slice(F.transform(F.filter(items, lambda i: F.coalesce(i["DOI"], F.lit("")) != ""), hit), 1, k).alias("more"))
    return records.select("path", clean(F.col("title")).alias("key")).join(found, "key").select("path", "more")


def model_prompt(title: Column, authors: Column, text: Column) -> Column:
    """What a model is asked: a JSON text that names the task and holds the record's title, authors and the head of its text."""
    task = "Return strict JSON {\"candidates\":[\"10.xxxx/...\"]}. Only DOI candidates for the main article."
    return F.to_json(F.struct(title.alias("title"), authors.alias("authors"), F.substring(F.coalesce(text, F.lit("")), 1, SNIPPET).alias("text"), F.lit(task).alias("instruction")))


def model_hits(asked: DataFrame, cache: DataFrame) -> DataFrame:
    """asked (path, key), cache (key, value: what the model answered) -> path, more."""
    plain = F.from_json(F.get_json_object("value", "$.candidates"), "array<string>")
    listed = F.filter(F.transform(F.coalesce(plain, F.array().cast("array<string>")), lambda d: F.struct(candidate(d).alias("doi"), F.lit("llm_candidate").alias("source"))), lambda h: h["doi"] != "")
    either = F.when(F.size(listed) > 0, listed).otherwise(generated_candidates(answered(F.col("value"))))
    hits = F.transform(either, lambda h: F.struct(h["doi"].alias("doi"), h["source"].alias("source"), F.lit("LLM candidate").alias("context")))
    return asked.select("path", "key").join(cache.select("key", "value"), "key").select("path", hits.alias("more"))


def verified(records: DataFrame, found: DataFrame, gate: Column, decision: str, exact: bool = True) -> DataFrame:
    """records against the works found (doi_key, work_title, work_authors): rows that pass are sure, and keep their scores."""
    people = F.coalesce("authors", F.array().cast("array<string>"))
    asked = records.select("path", F.when(gate, F.col("doi")).alias("doi"), F.coalesce("title", F.lit("")).alias("title"), people.alias("authors")).filter("doi is not null")
    got = A.verify(asked, found, exact).select("path", "verified", "reason", normalize(F.col("doi")).alias("_doi"), F.col("title_score").alias("_t"), F.col("author_score").alias("_a"))
    j = records.join(got, "path", "left")
    ok, seen = F.coalesce("verified", F.lit(False)), F.col("verified").isNotNull()
    scores = F.when(F.col("reason") != "crossref_not_found", F.to_json(F.struct(F.col("_t").alias("title_score"), F.col("_a").alias("author_score")))).otherwise("{}")
    had = lambda c: F.col(c) if c in records.columns else F.lit("").cast("string")
    return j.withColumns({
        "doi_validation_score": F.when(seen, scores).otherwise(had("doi_validation_score")),
        "doi_validation_source": F.when(ok, "crossref").when(seen, "").otherwise(had("doi_validation_source")),
        "doi": F.when(ok, F.col("_doi")).otherwise(F.col("doi")), "confidence": F.when(ok, "high").otherwise(F.col("confidence")),
        "doi_decision": F.when(ok, decision).otherwise(F.col("doi_decision")), "status": F.when(ok, "ok").otherwise(F.col("status")),
    }).drop("verified", "reason", "_doi", "_t", "_a")
