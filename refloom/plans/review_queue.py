"""What people look at: open records with the results of later passes, the next action, and a page to read them on."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import clean, escape_html, first_file, has_cjk, number
from ..operators.decisions import action

KEY = ["folder", "filename"]
COLUMNS = ["folder", "filename", "title", "authors", "final_decision", "candidate_doi", "candidate_source", "text_chars", "action", "path", "links"]
# Columns of the written queue and of the template for decisions, and where a title or an identifier is searched.
QUEUE = ["review_action", "folder", "filename", "review_pdf_path", "final_decision", "strict_reason", "doi", "round2_candidate_doi", "round2_authority_title", "title", "authors", "round2_reason"]
TEMPLATE = ["folder", "filename", "decision", "final_doi", "note"]
LINKS = (("Google Scholar", "https://scholar.google.com/scholar?q="), ("Baidu Scholar", "https://xueshu.baidu.com/s?wd="), ("Crossref", "https://search.crossref.org/?q="))
PATHS = ("content_pdf_path", "round2_pdf_path", "still_target_path", "target_path", "path")


def search_links(title: Column, doi: Column) -> Column:
    """array<struct<label, url>>: searches by the title, and the identifier's own address."""
    q = F.replace(F.url_encode(title), F.lit("+"), F.lit("%20"))
    by_title = F.array(*[F.struct(F.lit(label).alias("label"), F.concat(F.lit(base), q).alias("url")) for label, base in LINKS])
    by_doi = F.array(F.struct(F.lit("DOI").alias("label"), F.concat(F.lit("https://doi.org/"), F.replace(F.url_encode(doi), F.lit("%2F"), F.lit("/"))).alias("url")))
    none = F.array().cast("array<struct<label:string,url:string>>")
    return F.concat(F.when(title != "", by_title).otherwise(none), F.when(doi != "", by_doi).otherwise(none))


def pdf_path(columns: list[str], stored: Column | None = None) -> Column:
    """Where a row's file is: the stored one if there is one, else the first path that the row has."""
    own = [F.col(c) for c in PATHS if c in columns]
    return F.coalesce(*([stored] if stored is not None else []), *([first_file(*own)] if own else []), F.lit(""))


def review_queue(records: DataFrame, layout: DataFrame, ocr: DataFrame) -> DataFrame:
    """records (folder, filename, ...) with at most one row each of layout and ocr (folder, filename, candidate_doi)."""
    j = records.join(layout.select(*KEY, F.col("candidate_doi").alias("_m")), KEY, "left").join(ocr.select(*KEY, F.col("candidate_doi").alias("_o")), KEY, "left")
    col = lambda c: F.col(c) if c in records.columns else F.lit(None).cast("string")
    seen = first_file(F.col("_m"), F.col("_o"))
    visible = F.concat_ws(" ", clean(F.col("filename")), clean(col("title")), clean(col("round2_title")))
    found = {
        "candidate_doi": F.coalesce(seen, F.lit("")), "candidate_source": F.when(clean(F.col("_m")) != "", "layout").when(clean(F.col("_o")) != "", "ocr").otherwise(""),
        "has_candidate": seen.isNotNull(),
        "text": F.lower(visible), "cjk": has_cjk(visible), "text_chars": F.greatest(*[number(col(c)) for c in ("text_chars", "pdf_text_chars", "round2_pdf_text_chars", "hardcase_pdf_text_chars")]),
        **{c: clean(col(c)) for c in ("title", "authors", "final_decision", "doi")}, "path": pdf_path(records.columns),
    }
    j = j.withColumns(found).withColumn("action", action())
    return j.withColumn("links", search_links(F.col("title"), F.coalesce(F.nullif("candidate_doi", F.lit("")), F.col("doi")))).select(*COLUMNS)


def decision_template(queue: DataFrame) -> DataFrame:
    """A blank table to write decisions into."""
    return queue.select(*KEY, *[F.lit("").alias(c) for c in TEMPLATE if c not in KEY])


def queue_table(records: DataFrame, queue: DataFrame) -> DataFrame:
    """The queue as it is written: the action and the path beside the record's own columns."""
    mine = queue.select(*KEY, F.col("action").alias("review_action"), F.col("path").alias("review_pdf_path"))
    j = records.drop("review_action", "review_pdf_path").join(mine, KEY)
    return j.select(*[F.col(c) if c in j.columns else F.lit("").alias(c) for c in QUEUE])


def action_counts(queue: DataFrame) -> DataFrame:
    return queue.groupBy("action").count().orderBy(F.desc("count"), "action")


def review_page(queue: DataFrame, limit: int = 5000) -> str:
    """One page of cards, the commonest action first: the report is for people, so it holds ``limit`` rows at most."""
    counts = {r["action"]: r["count"] for r in action_counts(queue).collect()}
    link = F.transform("links", lambda x: F.concat(F.lit('<a target="_blank" href="'), escape_html(x["url"]), F.lit('">'), x["label"], F.lit("</a>")))
    plain = [escape_html(F.col(c).cast("string")).alias(c) for c in COLUMNS if c != "links"]
    rows = queue.select(*plain, F.array_join(link, " ").alias("links")).orderBy("action", *KEY).limit(limit).collect()
    menu = "".join(f'<option value="{a}">{a} ({n})</option>' for a, n in counts.items())
    cards = "".join(f'<article data-action="{r["action"]}"><h2>{r["title"] or r["filename"]}</h2><p>{r["authors"]}</p><p>{r["action"]} {r["candidate_doi"]}</p><p>{r["links"]}</p></article>' for r in rows)
    script = "document.querySelector('select').onchange=e=>document.querySelectorAll('article').forEach(a=>a.hidden=e.target.value&&a.dataset.action!==e.target.value)"
    return f'<!doctype html><meta charset="utf-8"><title>Review</title><select><option value="">all ({sum(counts.values())})</option>{menu}</select>{cards}<script>{script}</script>'
