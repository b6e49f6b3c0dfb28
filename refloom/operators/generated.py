"""Candidates from text that a model or a search has produced, and titles to search by."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.identifiers import candidate, find, first_of_each, normalize
from ..functions.text import clean, collapse, let, norm_text, searchable_title, title_from_name
from .candidates import longest_only

ANSWER = "struct<title:string,authors:array<string>,candidates:array<struct<doi:string,is_main_article:boolean,confidence:string,reason:string>>,doi_candidates:array<struct<doi:string,is_main_article:boolean,confidence:string,evidence:string>>,year:string,document_type:string,notes:string>"
# Words of lines that are no title.
NO_TITLE_LINE = r"(?i)copyright|downloaded|journal|volume|issue|abstract|keywords|contents|references|doi:|www\."


def json_object(text: Column) -> Column:
    """The JSON object in an answer: without code fences, from the first brace to the last."""
    bare = F.regexp_replace(F.coalesce(text, F.lit("")), r"(?m)^\s*```\w*\s*$", "")
    return F.nullif(F.regexp_extract(bare, r"(?s)(\{.*\})", 1), F.lit(""))


def answer_key(model: Column, prompt: Column) -> Column:
    """Under what an answer is kept."""
    return F.sha2(F.concat(model, F.lit("\n"), prompt), 256)


def answered(text: Column) -> Column:
    """The answer as a structure; null where there is none."""
    return F.from_json(json_object(text), ANSWER)


def generated_candidates(answer: Column) -> Column:
    """array<struct<doi, source>> of an answer: none that it says is not the main article or has low confidence."""
    kept = F.filter(answer["candidates"], lambda c: F.coalesce(c["is_main_article"], F.lit(True)) & (F.lower(F.coalesce(c["confidence"], F.lit(""))) != "low"))
    out = F.transform(kept, lambda c: F.struct(candidate(c["doi"]).alias("doi"), F.lit("llm_candidate").alias("source")))
    return first_of_each(F.filter(F.coalesce(out, F.array().cast("array<struct<doi:string,source:string>>")), lambda c: c["doi"] != ""), lambda c: F.lower(c["doi"]))


def text_candidates(df: DataFrame, key: str, text: Column) -> DataFrame:
    """key, doi: plausible identifiers of a text, spaced ones among them, each in its longest form."""
    hits = F.transform(find(text, F.lit("text"), spaced=True), lambda h: h["doi"])
    first = let(hits, lambda xs: first_of_each(xs, F.lower))
    return longest_only(df.select(key, F.explode(first).alias("doi")), key)


def best_title(text: Column) -> Column:
    """The line among the first eighty that is most like a title: five words or more, then the longest, then the first."""
    lines = F.slice(F.transform(F.split(F.coalesce(text, F.lit("")), r"\r?\n"), collapse), 1, 80)
    ok = F.filter(lines, lambda s: (F.length(norm_text(s)) >= 8) & (F.length(s) <= 240) & ~s.rlike(NO_TITLE_LINE) & (F.length(F.regexp_replace(s, r"[^\p{L}]", "")) >= 8))
    ranked = F.transform(ok, lambda s, i: F.struct((F.size(F.split(norm_text(s), " ")) >= 5).alias("wide"), F.length(s).alias("n"), (-i).alias("i"), s.alias("s")))
    return F.coalesce(F.array_max(ranked)["s"], F.lit(""))


def title_queries(titles: list[Column], filename: Column, text: Column) -> Column:
    """array<string>: a record's titles, one from its text and one from its file name, if they may be searched; no two with one normal form."""
    tries = F.array(*[clean(t) for t in titles], best_title(text), title_from_name(filename))
    return let(F.filter(tries, searchable_title), lambda ts: first_of_each(ts, norm_text))


def search_requests(title: Column, authors: Column) -> Column:
    """array<string>: the title, and the title with the first author's last name."""
    name = F.element_at(F.split(norm_text(F.get(authors, F.lit(0))), " "), -1)
    return F.when(F.coalesce(name, F.lit("")) != "", F.array(clean(title), F.concat_ws(" ", clean(title), name))).otherwise(F.array(clean(title)))


__all__ = ["answer_key", "answered", "best_title", "generated_candidates", "json_object", "normalize", "search_requests", "text_candidates", "title_queries"]
