"""Rows that are still not certain, against the authorities of all their spellings, or of titles like theirs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.identifiers import FILENAME_SOURCES, REFERENCE_CONTEXT, REFERENCE_CONTEXT_OCR, candidate, first_of_each, name_tokens, suspicious, token_variants
from ..functions.similarity import author_score, coverage_of_normal, with_title_score
from ..functions.text import add_source, clean, norm_text, searchable_title, title_is_bad, useful_title
from ..operators import authority as A
from ..operators import decisions as D
from ..operators.generated import best_title
from .review import keep_originals, merged_scores

GIVEN = (("doi", "existing_doi"), ("final_doi", "final_doi"), ("authority_doi", "previous_authority_doi"), ("authority_doi_new", "previous_authority_doi"))
SEARCHES = ("crossref_title_search", "datacite_title_search")
ANSWER = ("source", "doi", "title", "authors", "container", "publisher", "year", "type", "error")
#: Of the results of a record, a title search comes after all candidates.
SEARCHED = 1_000_000


def candidates(records: DataFrame) -> DataFrame:
    """path, ord, doi, source, reason: identifiers of earlier columns, then spellings from the file name; first of each."""
    given = [F.struct(candidate(F.col(c)).alias("doi"), F.lit(s).alias("source"), F.lit(c).alias("reason")) for c, s in GIVEN if c in records.columns]
    stem = F.regexp_replace(clean(F.col("filename")), r"\.[^.]*$", "")
    made = F.flatten(F.transform(name_tokens(stem), token_variants))
    both = F.filter(F.concat(F.array(*given), made), lambda c: c["doi"] != "")
    return records.select("path", F.posexplode(first_of_each(both, lambda c: F.lower(c["doi"]))).alias("ord", "c")).select("path", "ord", "c.*")


def _columns(answers: DataFrame) -> DataFrame:
    """Answers with all columns that a result shows."""
    none = {"authors": F.array().cast("array<string>")}
    return answers.withColumns({c: none.get(c, F.lit(None).cast("string")) for c in ANSWER if c not in answers.columns})


def tries(targets: DataFrame, answers: DataFrame, searches: DataFrame | None) -> DataFrame:
    """path, ord, try_doi, source, reason and ``x``, the answer: earlier answers, candidates, and for rows without either title searches.

    targets has ``search_title``, which is null where none is to be searched.
    """
    row = {c: F.col(c) for c in targets.columns}
    shape = lambda df, doi, x: df.select("path", F.col("ord").cast("int").alias("ord"), doi.alias("try_doi"), "source", "reason", x.alias("x"))
    fields = lambda get: F.struct(F.coalesce(get("resolved"), F.lit(False)).alias("resolved"), *[get(c).alias(c) for c in ANSWER])
    tried = shape(A.resolve(candidates(targets), _columns(answers), "path"), F.col("doi"), fields(lambda c: F.col(f"authority_{c}")))
    if "authority_title" in targets.columns:
        told = F.nullif(clean(F.col("doi_source")), F.lit("")) if "doi_source" in targets.columns else F.lit(None).cast("string")
        before = targets.withColumn("_x", A.input_authority(row)).filter("_x is not null")
        own = F.coalesce(F.nullif(candidate(F.col("doi")), F.lit("")), F.col("_x.doi"))
        before = before.select("path", F.lit(-1).alias("ord"), own.alias("own"), F.coalesce(told, F.lit("previous_candidate")).alias("source"),
            F.lit("previous resolved authority").alias("reason"), "_x")
        tried = shape(before, F.col("own"), fields(lambda c: F.col(f"_x.{c}"))).unionByName(tried)
    if searches is None:
        return tried
    place = F.when(F.col("source") == SEARCHES[0], 0).otherwise(1)
    hits = _columns(searches).filter(F.col("source").isin(*SEARCHES)).withColumn("hit", F.struct(F.lit(True).alias("resolved"), *ANSWER)).withColumn("place", SEARCHED + place * 1000 + F.col("rank"))
    asked = targets.filter("search_title is not null").select("path", norm_text(F.col("search_title")).alias("query_key")).join(tried.select("path").distinct(), "path", "left_anti")
    found = asked.join(hits.select("query_key", "source", "hit", F.col("place").alias("ord")), "query_key").withColumn("reason", F.lit("title search"))
    return tried.unionByName(shape(found, F.coalesce(F.nullif(candidate(F.col("hit.doi")), F.lit("")), F.col("hit.doi")), F.col("hit")))


def facts(df: DataFrame, table: str) -> DataFrame:
    """df (title, authors, source, reason, try_doi, x: the answer) with all that the rules of a table ask about."""
    answer_doi = F.coalesce(F.nullif(F.col("x.doi"), F.lit("")), F.col("try_doi"))
    layout = table == "layout"
    search = F.col("source").startswith("llm_") & F.col("source").contains("title_search") if layout else F.col("source").isin(*SEARCHES)
    return df.withColumns({
        "res": F.coalesce("x.resolved", F.lit(False)),
        "no_authors": F.size(F.coalesce("authors", F.array().cast("array<string>"))) <= 0,
        "bad_title": title_is_bad(F.col("title")),
        "title_words": D.title_words(F.col("x.title")),
        "ff": F.col("source").isin(*FILENAME_SOURCES),
        "search": search,
        "prefix_variant": F.col("source") == "prefix_variant",
        "visible": F.col("source").isin("markdown_regex", "llm_markdown_doi"),
        "useful": useful_title(F.col("title"), domain=layout) if table in ("layout", "ocr") else F.lit(True),
        "suspicious": suspicious(answer_doi, F.col("x.title"), F.col("x.type")) if layout else suspicious(answer_doi),
        "references": F.coalesce("reason", F.lit("")).rlike(REFERENCE_CONTEXT if layout else REFERENCE_CONTEXT_OCR),
    })


def best_results(targets: DataFrame, tried: DataFrame, table: str, exact: bool = True) -> DataFrame:
    """targets (path, title, authors, text), tried (path, ord, try_doi, source, reason, x, and own_title if there is one) -> a row each.

    What is tried is scored first, as small rows. A record's text is normalised once, beside the array of its tries, and
    goes no further; then the rules decide, and the best result stays.
    """
    small = tried.join(targets.select("path", "title", "authors"), "path")
    if "own_title" in tried.columns:
        small = small.withColumn("title", F.coalesce("own_title", "title"))
    scored = with_title_score(small, "t", F.col("title"), F.col("x.title"), exact).withColumn("a", author_score(F.col("authors"), F.col("x.authors")))
    each = scored.groupBy("path").agg(F.collect_list(F.struct("ord", "try_doi", "source", "reason", "x", "t", "a", F.col("title").alias("by"))).alias("tries"))  # a record's own
    whole = targets.select("path", "authors", F.col("title").alias("own"), norm_text(F.col("text")).alias("_normal"),
        F.length(F.coalesce("text", F.lit(""))).alias("text_chars")).join(each, "path", "left")
    covered = F.transform("tries", lambda c: F.struct(c.alias("c"), coverage_of_normal(c["x"]["title"], F.col("_normal")).alias("cover")))
    rows = whole.select("path", "authors", "own", "text_chars", F.explode_outer(covered).alias("r"))
    open_ = rows.select("path", "authors", "text_chars", "r.c.*", F.col("r.cover").alias("c"), "own").withColumn("title", F.coalesce("by", "own"))
    decided = facts(open_, table).withColumn("doi_length", F.length("try_doi")).withColumn("d", D.decide(table))
    kept = decided.select("path", "ord", "bad_title", "text_chars", "try_doi", "source", "reason", "x", "t", "a", "c", "doi_length", "d.*", "by")
    best = F.max_by(F.struct("try_doi", "source", "reason", "x", "accepted", "confidence", "decision", "t", "a", "c", "bad_title", "by"), F.when(F.col("ord").isNotNull(), D.best_by(table)))
    dois = F.array_distinct(F.transform(F.array_sort(F.collect_list(F.when(F.col("ord").between(0, SEARCHED - 1), F.struct("ord", "try_doi")))), lambda x: x["try_doi"]))
    out = kept.groupBy("path").agg(best.alias("b"), dois.alias("tried_dois"), F.any_value("bad_title").alias("bad_title"), F.any_value("text_chars").alias("text_chars"),
        F.count("ord").alias("checked"))
    get = lambda c, d: F.coalesce(F.col(f"b.{c}"), F.lit(d)).alias(c)
    final = F.when(F.col("b.accepted"), F.coalesce(F.nullif(F.col("b.x.doi"), F.lit("")), F.col("b.try_doi"))).otherwise("")
    none = {"resolved": F.lit(False), "authors": F.array().cast("array<string>"), "error": F.when(F.col("b").isNull(), "no candidate").otherwise("")}
    answer = [F.coalesce(F.col(f"b.x.{c}"), none.get(c, F.lit(""))).alias(f"answer_{c}") for c in ("resolved", *ANSWER)]
    return out.select(
        "path", get("try_doi", "").alias("doi"), get("source", ""), get("reason", ""), get("accepted", False), get("confidence", "none"),
        get("decision", "no DOI candidate and no usable title search"),
        final.alias("final_doi"), *[F.round(get(x, 0.0), 4).alias(x) for x in ("t", "a", "c")], F.coalesce("b.bad_title", "bad_title").alias("bad_title"),
        get("by", "").alias("by_title"), "tried_dois", "text_chars", "checked", *answer,
    )


def hard_cases(records: DataFrame, answers: DataFrame, searches: DataFrame | None = None, exact: bool = True) -> DataFrame:
    """Every row that is not ok: the best result of all tries, or none.

    records (path, filename, status, doi, title, authors array, text, and earlier answers if there are any), answers (doi_key,
    source, resolved, doi, title, authors, ...), searches (query_key: the normal form of the title asked for, source, rank, doi,
    title, authors, ...). A title that says nothing is replaced by the text's best line where there is no candidate.
    """
    targets = records.filter(F.coalesce(F.col("status"), F.lit("")) != "ok")
    small = targets.drop("text")
    guessed = candidates(targets).select("path").distinct()
    bare = targets.join(guessed, "path", "left_anti").filter(title_is_bad(F.col("title")) & (clean(F.col("text")) != "")).select("path", best_title(F.col("text")).alias("guess"))
    if searches is not None:
        title = F.when(F.coalesce("guess", F.lit("")) != "", F.col("guess")).otherwise(clean(F.col("title")))
        small = small.join(bare, "path", "left").withColumn("search_title", F.when(searchable_title(title), title))
    out = best_results(targets, tries(small, answers, searches), "hard_case", exact).drop("by_title", "checked")
    return out.join(bare, "path", "left").withColumn("guess", F.coalesce("guess", F.lit("")))


#: Columns of a record that show the result, and what of the result they show.
SHOWN = {
    "hardcase_accept": "accepted", "hardcase_confidence": "confidence", "hardcase_reason": "decision", "hardcase_final_doi": "final_doi", "hardcase_candidate_doi": "doi",
    "hardcase_candidate_source": "source",
    "hardcase_candidate_reason": "reason", "hardcase_title_score": "t", "hardcase_author_score": "a", "hardcase_pdf_title_coverage": "c",
    "hardcase_local_title_bad": "bad_title", "hardcase_pdf_guessed_title": "guess",
    "hardcase_tried_dois": "tried_dois", "hardcase_pdf_text_chars": "text_chars", "authority_resolved": "answer_resolved", "authority_source": "answer_source",
    "authority_doi_new": "answer_doi", "authority_title_new": "answer_title",
    "authority_authors_new": "answer_authors", "authority_container_new": "answer_container", "authority_publisher_new": "answer_publisher",
    "authority_year_new": "answer_year", "authority_type_new": "answer_type", "authority_error_new": "answer_error",
}


def _text(kind: str, x: Column) -> Column:
    return {"boolean": F.when(x, "1").otherwise("0"), "double": F.format_string("%.4f", x), "array<string>": F.array_join(x, "; ")}.get(kind, x.cast("string"))


def applied(records: DataFrame, results: DataFrame) -> DataFrame:
    """records with their results: accepted ones in place, and what was bad or missing filled from the answer."""
    kinds = dict(results.dtypes)
    shown = results.select("path", F.struct(*[_text(kinds[c], F.col(c)).alias(k) for k, c in SHOWN.items()]).alias("_r"), F.col("answer_authors").alias("_people"))
    j = records.drop(*SHOWN).join(shown, "path", "left")
    r, seen, columns = (lambda c: F.col(f"_r.{c}")), F.col("_r").isNotNull(), records.columns
    had = lambda c: F.col(c) if c in columns else F.lit(None).cast("string")
    doi = candidate(F.coalesce(F.nullif(r("hardcase_final_doi"), F.lit("")), r("hardcase_candidate_doi")))
    ok = F.coalesce((r("hardcase_accept") == "1") & (doi != ""), F.lit(False))
    filled = lambda c, d: F.coalesce(F.nullif(r(c), F.lit("")), d)
    source = filled("authority_source", F.lit("authority"))
    people = F.coalesce("authors", F.array().cast("array<string>"))
    theirs = F.filter(F.coalesce("_people", F.array().cast("array<string>")), lambda n: clean(n) != "")
    new_title = ok & (clean(r("authority_title_new")) != "") & title_is_bad(F.col("title"))
    new_people = ok & (F.size(theirs) > 0) & (F.size(people) <= 0)
    out = {k: F.when(seen, v).otherwise(had(k)) for k, v in keep_originals(columns).items()}
    out |= {c: r(c) for c in SHOWN}
    scores = {c: r(c) for c in ("hardcase_title_score", "hardcase_author_score", "hardcase_pdf_title_coverage", "hardcase_candidate_source")}
    out |= {
        "doi_validation_score": F.when(seen, merged_scores(had("doi_validation_score"), scores)).otherwise(had("doi_validation_score")),
        "status": F.when(ok, "ok").otherwise(F.col("status")),
        "method": F.when(ok, F.concat(F.lit("hardcase_"), filled("hardcase_candidate_source", F.lit("authority")))).otherwise(had("method")),
        "doi": F.when(ok, doi).otherwise(F.col("doi")),
        "confidence": F.when(ok, filled("hardcase_confidence", F.lit("medium"))).otherwise(F.col("confidence")),
        "doi_decision": F.when(ok, "hardcase_accept").otherwise(had("doi_decision")),
        "doi_source": F.when(ok, filled("hardcase_candidate_source", F.coalesce(F.nullif(had("doi_source"), F.lit("")), F.lit("hardcase")))).otherwise(had("doi_source")),
        "doi_validation_source": F.when(ok, filled("authority_source", F.lit("hardcase_authority"))).otherwise(had("doi_validation_source")),
        "title": F.when(new_title, clean(r("authority_title_new"))).otherwise(F.col("title")),
        "title_source": F.when(new_title, source).otherwise(had("title_source")),
        "authors": F.when(new_people, theirs).otherwise(F.col("authors")),
        "authors_source": F.when(new_people, source).otherwise(had("authors_source")),
        "metadata_source": F.when(new_title | new_people, add_source(had("metadata_source"), F.lit("authority"))).otherwise(had("metadata_source")),
    }
    for c, theirs_ in (("year", "authority_year_new"), ("journal", "authority_container_new"), ("publisher", "authority_publisher_new")):
        out[c] = F.when(ok & (clean(had(c)) == "") & (r(theirs_) != ""), r(theirs_)).otherwise(had(c))
    return j.withColumns(out).drop("_r", "_people")


__all__ = ["SEARCHES", "SHOWN", "applied", "best_results", "candidates", "facts", "hard_cases", "tries"]
