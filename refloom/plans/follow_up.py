"""Later passes over a table of rows that are still open: more spellings and searches, OCR text, and layout text with a model.

Each takes rows (path and whatever else they have), tries candidates against kept answers, and gives the best result beside
the row's own columns. All share the rules' facts and the choice of the best with the hard cases.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.identifiers import candidate, find, first_of_each, prefix_variants
from ..functions.similarity import with_title_score
from ..functions.text import clean, let, norm_text, number, parse_authors, title_is_bad, useful_title
from ..operators import authority as A
from ..operators.generated import answered, search_requests, title_queries
from ..sources import front_page
from .hard_cases import ANSWER, SEARCHED, best_results, candidates
from .records import summary

#: Title searches in the order in which their results count.
ROUND2_SEARCHES = ("crossref_title_search", "datacite_title_search", "crossref_bibliographic_search", "openalex_title_search", "semantic_scholar_title_search")
REGEX_CHARS = 16_000  # of a layout text that is searched for identifiers
LOW_TEXT = 500


def text_chars(columns: list[str]) -> Column:
    """Characters of text that earlier passes found; 0 where they found none or wrote no number."""
    known = [number(F.col(c)) for c in ("round2_pdf_text_chars", "hardcase_pdf_text_chars") if c in columns]
    return F.greatest(F.lit(0).cast("long"), *known, F.lit(0).cast("long"))


def ocr_targets(rows: DataFrame, every: bool = False, most: int = LOW_TEXT) -> DataFrame:
    """Rows with little text, or all."""
    return rows if every else rows.filter(text_chars(rows.columns) < most)


def layout_targets(rows: DataFrame, decision: str = "") -> DataFrame:
    """Rows with a final decision, or all."""
    return rows.filter(clean(F.col("final_decision")) == decision) if decision else rows


def _answers(answers: DataFrame) -> DataFrame:
    none = {"authors": F.array().cast("array<string>")}
    return answers.withColumns({c: none.get(c, F.lit(None).cast("string")) for c in ANSWER if c not in answers.columns})


def _resolved(tried: DataFrame, answers: DataFrame) -> DataFrame:
    """tried (path, ord, doi, source, reason) with the answer as ``x``."""
    x = F.struct(F.coalesce("authority_resolved", F.lit(False)).alias("resolved"), *[F.col(f"authority_{c}").alias(c) for c in ANSWER])
    return A.resolve(tried, _answers(answers), "path").select("path", "ord", F.col("doi").alias("try_doi"), "source", "reason", x.alias("x"))


def _searched(asked: DataFrame, searches: DataFrame, order: tuple[str, ...], prefix: str, reason: str) -> DataFrame:
    """asked (path, query, place) with the works that the searches for its queries found, as tries."""
    place = F.array_position(F.array(*map(F.lit, order)), F.col("source")).cast("int")
    hits = _answers(searches).withColumn("hit", F.struct(F.lit(True).alias("resolved"), *ANSWER)).filter(F.col("source").isin(*order)).withColumn("at", place)
    j = asked.withColumn("query_key", norm_text(F.col("query"))).join(hits.select("query_key", "source", "hit", "at", "rank"), "query_key")
    doi = F.coalesce(F.nullif(candidate(F.col("hit.doi")), F.lit("")), F.col("hit.doi"))
    number_ = (F.lit(SEARCHED) + F.col("place") * 10_000 + F.col("at") * 1000 + F.col("rank")).cast("int")
    return j.select("path", number_.alias("ord"), doi.alias("try_doi"), F.concat(F.lit(prefix), "source").alias("source"), F.lit(reason).alias("reason"), F.col("hit").alias("x"), "query")


def more_spellings(rows: DataFrame) -> DataFrame:
    """path, ord, doi, source, reason: a row's candidates and, behind them, publishers' other spellings; first of each."""
    given = [c for c in ("doi", "hardcase_candidate_doi", "filename") if c in rows.columns]
    made = F.flatten(F.array(*[prefix_variants(clean(F.col(c))) for c in given]))
    other = rows.select("path", F.posexplode(made).alias("n", "v")).select("path", (F.col("n") + 1000).alias("ord"), "v.doi", F.lit("prefix_variant").alias("source"),
        F.col("v.reason").alias("reason"))
    both = candidates(rows).unionByName(other)
    first = both.groupBy("path", F.lower("doi").alias("_k")).agg(F.min_by(F.struct("ord", "doi", "source", "reason"), "ord").alias("c"))
    return first.select("path", "c.*")


def round2(rows: DataFrame, answers: DataFrame, searches: DataFrame, exact: bool = True) -> DataFrame:
    """rows (path, filename, doi, title, authors array, text, ...) -> the best result each.

    A title that was searched for stands for the row's own where that says nothing or is another one.
    """
    none = F.lit("")
    titles = [F.col(c) for c in ("title", "hardcase_pdf_guessed_title") if c in rows.columns]
    asked = rows.select("path", "title", F.posexplode(title_queries(titles, F.col("filename"), F.coalesce("text", none))).alias("place", "query"))
    asked = with_title_score(asked, "like", F.col("title"), F.col("query"), exact)
    asked = asked.withColumn("own_title", F.when(title_is_bad(F.col("title")) | (F.col("like") < 0.6), F.col("query")))
    found = _searched(asked.select("path", "query", "place"), searches, ROUND2_SEARCHES, "", "extended title search")
    found = found.join(asked.select("path", "query", "own_title"), ["path", "query"])
    plain = _resolved(more_spellings(rows), answers).withColumns({"query": none, "own_title": F.lit(None).cast("string")})
    return best_results(rows, plain.unionByName(found), "round2", exact)


def longest_first(text: Column, source: str) -> Column:
    """array<struct<doi, source, context>>: identifiers of a text, the longest first, none that is the beginning of a longer one."""
    found = find(text, F.lit(source), spaced=True)

    def whole(hits: Column) -> Column:
        low = lambda h: F.lower(h["doi"])
        part = lambda h: F.exists(hits, lambda o: low(o).startswith(F.concat(low(h), F.lit("."))) | low(o).startswith(F.concat(low(h), F.lit("/"))))
        ordered = F.array_sort(F.transform(hits, lambda h, i: F.struct((-F.length(h["doi"])).alias("n"), i.alias("i"), h.alias("h"))))
        return F.transform(F.filter(ordered, lambda x: ~part(x["h"])), lambda x: x["h"])

    return let(let(found, whole), lambda hits: first_of_each(hits, lambda h: F.lower(h["doi"])))


def ocr(rows: DataFrame, pages: DataFrame, answers: DataFrame, exact: bool = True) -> DataFrame:
    """rows (path, ...), pages (path, read, error): OCR text of those that were read -> the best result each, and what was read."""
    read = pages.select("path", F.coalesce("read", F.lit("")).alias("text"), front_page.title_authors(F.coalesce("read", F.lit(""))).alias("f"), "error")
    own = rows.select("path").join(read, "path", "left").select("path", F.coalesce("text", F.lit("")).alias("text"), F.coalesce("f.title", F.lit("")).alias("title"),
        F.col("f.authors").alias("authors"), F.coalesce("error", F.when(F.col("text").isNull(), "missing PDF")).alias("error"))
    tried = own.select("path", F.posexplode(longest_first(F.col("text"), "ocr_regex")).alias("ord", "h")).select("path", "ord", "h.doi", "h.source", F.col("h.context").alias("reason"))
    out = best_results(own, _resolved(tried, answers), "ocr", exact)
    said = own.select("path", F.col("title").alias("extracted_title"), F.col("authors").alias("extracted_authors"), F.coalesce("error", F.lit("")).alias("error"))
    return out.join(said, "path")


def layout(rows: DataFrame, texts: DataFrame, answers: DataFrame, searches: DataFrame, said: DataFrame | None = None, exact: bool = True) -> DataFrame:
    """rows (path, title, authors, ...), texts (path, text), said (path, value: a model's answer) -> the best result each.

    Title and authors are the model's or, without one, the text's own, else the row's. Identifiers come from the text and the
    model; titles that say enough are searched for, with and without the first author's last name.
    """
    has = lambda c: F.col(c) if c in rows.columns else F.lit("")
    base = rows.select("path", clean(has("title")).alias("row_title"),
        parse_authors(has("authors").cast("string") if "authors" not in rows.columns or dict(rows.dtypes)["authors"] == "string" else F.array_join("authors", "; ")).alias("row_authors"))
    base = base.join(texts.select("path", "text"), "path", "left").withColumn("text", F.coalesce("text", F.lit("")))
    if said is not None:
        own = base.join(said.select("path", answered(F.col("value")).alias("m"), F.col("value").alias("response")), "path", "left")
        own = own.select("path", "text", F.coalesce("m.title", F.lit("")).alias("title"), F.coalesce("m.authors", F.array().cast("array<string>")).alias("authors"), "m")
        stated = F.filter(F.coalesce(F.col("m.doi_candidates"), F.array().cast(MODEL_DOIS)), lambda c: F.coalesce(c["is_main_article"], F.lit(True)) & (F.lower(clean(c["confidence"])) != "low"))
        more = F.filter(F.transform(stated, lambda c: F.struct(candidate(c["doi"]).alias("doi"), F.lit("llm_markdown_doi").alias("source"), clean(c["evidence"]).alias("context"))),
            lambda h: h["doi"] != "")
    else:
        own = base.withColumn("f", front_page.title_authors(F.col("text")))
        title = F.when(F.col("text") == "", "").otherwise(F.coalesce(F.nullif(F.col("f.title"), F.lit("")), F.col("row_title")))
        people = F.when(F.size("f.authors") > 0, F.col("f.authors")).otherwise(F.col("row_authors"))
        own = own.select("path", "text", title.alias("title"), people.alias("authors"))
        more = F.array().cast("array<struct<doi:string,source:string,context:string>>")
    hits = first_of_each(F.concat(longest_first(F.substring("text", 1, REGEX_CHARS), "markdown_regex"), more), lambda h: F.lower(h["doi"]))
    tried = own.select("path", F.posexplode(hits).alias("ord", "h")).select("path", "ord", "h.doi", "h.source", F.col("h.context").alias("reason"))
    asked = own.filter(useful_title(F.col("title"))).select("path", F.posexplode(search_requests(F.col("title"), F.col("authors"))).alias("place", "query"))
    found = _searched(asked, searches, ROUND2_SEARCHES, "llm_", "LLM title search").drop("query")
    first = found.groupBy("path", F.lower("try_doi").alias("_k")).agg(F.min_by(F.struct("ord", "try_doi", "source", "reason", "x"), "ord").alias("c")).select("path", "c.*")
    out = best_results(own.select("path", "text", "title", "authors"), _resolved(tried, answers).unionByName(first), "layout", exact)
    return out.join(own.select("path", F.col("title").alias("extracted_title"), F.col("authors").alias("extracted_authors")), "path")


MODEL_DOIS = "array<struct<doi:string,is_main_article:boolean,confidence:string,evidence:string>>"
#: What the passes call their columns, and what of a result these show.
COLUMNS = {
    "accept": "accepted", "confidence": "confidence", "reason": "decision", "final_doi": "final_doi", "candidate_doi": "doi", "candidate_source": "source",
    "candidate_reason": "reason", "title_score": "t", "author_score": "a",
    "pdf_title_coverage": "c", "title": "extracted_title", "authors": "extracted_authors", "authority_source": "answer_source", "authority_doi": "answer_doi",
    "authority_title": "answer_title", "authority_authors": "answer_authors",
    "authority_container": "answer_container", "authority_year": "answer_year", "authority_type": "answer_type", "authority_error": "answer_error",
    "tried_dois": "tried_dois", "pdf_text_chars": "text_chars",
    "candidates_checked": "checked", "error": "error",
}


def beside(rows: DataFrame, results: DataFrame, prefix: str) -> DataFrame:
    """New columns first, then the row's own; a new one takes the place of an old one of its name."""
    shown = {f"{prefix}_{k}": c for k, c in COLUMNS.items() if c in results.columns}
    mine = results.select("path", *[F.col(c).alias(k) for k, c in shown.items()])
    old = rows.drop(*shown)
    return old.join(mine, "path").select(*shown, *old.columns)


def parts(table: DataFrame, prefix: str) -> dict[str, DataFrame]:
    """The table by what became of its rows."""
    ok, has = F.col(f"{prefix}_accept"), F.col(f"{prefix}_candidate_doi") != ""
    return {"resolution": table, "accepted": table.filter(ok), "still": table.filter(~ok), "candidate_rejected": table.filter(~ok & has), "no_candidate": table.filter(~ok & ~has)}


def report(table: DataFrame, prefix: str, inputs: int) -> dict:
    """Counts of the parts, and by confidence, source and reason."""
    ok, has = F.col(f"{prefix}_accept"), F.col(f"{prefix}_candidate_doi") != ""
    n = table.agg(F.count("*"), F.count_if(ok), F.count_if(~ok & has), F.count_if(~ok & ~has)).first()
    by = {f"{name}_by_{c}": {r["value"]: r["n"] for r in summary(df, [f"{prefix}_{col}"]).collect() if r["metric"] != "total"} for name, df, c,
        col in (("accepted", table.filter(ok), "confidence", "confidence"), ("accepted", table.filter(ok), "source", "candidate_source"), ("still", table.filter(~ok), "reason", "reason"))}
    return {"input_rows": inputs, "targets": n[0], "accepted": n[1], "still": n[0] - n[1], "candidate_rejected": n[2], "no_candidate": n[3], **by}
