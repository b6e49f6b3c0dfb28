"""Bibliographic authorities: answers read from JSON, kept in an append-only table, looked up by joins.

Live sources sit behind ``Connector``: they are asked only for keys that the table lacks, after those are made
distinct. With the table alone everything runs offline.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import Protocol

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.identifiers import candidate, ecs_variant, normalize
from ..functions.similarity import author_score, with_title_score
from ..functions.text import author_names, clean, parse_authors

AUTHORITY = "authority_doi string, title string, authors array<string>, container string, publisher string, year string, type string"
RETRYABLE = r"(?i)429|timeout|timed out|temporar|too many requests"
PRIORITY = {"osti": 0, "doi.org": 1, "crossref": 2, "datacite": 3}


class Connector(Protocol):
    """Asks a source for one key: the answer's JSON, or raises."""

    source: str

    def fetch(self, key: str) -> str: ...


def fetched(missing: DataFrame, connector: Connector, partitions: int, interval: float = 0.2) -> DataFrame:
    """missing (key) -> key, source, value, error, time. All tasks together keep to one call each ``interval`` seconds."""
    import time

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            rows = []
            for key in b["key"]:
                time.sleep(interval * partitions)
                try:
                    rows.append((key, connector.source, connector.fetch(key), None, time.time()))
                except Exception as e:  # noqa: BLE001  a failed call is an answer that is asked for again
                    rows.append((key, connector.source, None, str(e), time.time()))
            yield pd.DataFrame(rows, columns=["key", "source", "value", "error", "time"])

    return missing.select("key").distinct().repartition(partitions).mapInPandas(run, "key string, source string, value string, error string, time double")


def latest(cache: DataFrame, keys: list[str], time: str) -> DataFrame:
    """The last row written for each key; combined before the shuffle."""
    rest = [c for c in cache.columns if c not in keys]
    return cache.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*[F.col(time)] + [F.col(c) for c in rest if c != time])).alias("r")).select(*keys, "r.*")


def cache_lines(spark: SparkSession, path: str) -> DataFrame:
    """key, value (JSON text), error, time, line of a cache of JSON lines {key, value, time}; lines that are no such object are left out.

    A resolver's lines, which are the answer itself with its ``doi``, read as key and value, too. ``line`` tells later
    lines of a file from earlier ones.
    """
    at = lambda field: F.get_json_object("value", f"$.{field}")
    lines = spark.read.text(path).withColumn("line", F.monotonically_increasing_id()).filter(F.trim("value") != "")
    keyed = lines.select(
        F.coalesce(F.nullif(clean(at("key")), F.lit("")), F.nullif(F.lower(clean(at("doi"))), F.lit(""))).alias("key"),
        F.when(at("key").isNotNull(), at("value")).otherwise(F.col("value")).alias("value"),
        at("time").try_cast("double").alias("time"),
        "line",
    )
    error = F.when(F.col("value").startswith("{"), F.get_json_object("value", "$.error"))
    return keyed.filter("key is not null").withColumn("error", F.nullif(error, F.lit("")))


def append_cache(answers: DataFrame, path: str, keep_errors: bool) -> None:
    """Adds answers (key, value, error, time) as JSON lines; a source whose failures are transient keeps none of them."""
    rows = answers if keep_errors else usable(answers)
    failed = F.struct(F.col("error").alias("error"))
    value = F.coalesce(F.col("value"), F.to_json(failed))
    line = F.concat(F.lit('{"key":'), F.to_json(F.struct("key")).substr(F.lit(8), F.length(F.to_json(F.struct("key"))) - 8), F.lit(',"value":'), value, F.lit(',"time":'),
        F.col("time").cast("string"), F.lit("}"))
    rows.select(line.alias("value")).write.mode("append").text(path)


def usable(cache: DataFrame) -> DataFrame:
    """Without answers that are errors: those are asked for again."""
    return cache.filter(F.coalesce(F.col("error"), F.lit("")) == "")


def misses(wanted: DataFrame, cache: DataFrame, key: str) -> DataFrame:
    return wanted.select(key).distinct().join(cache.select(key).distinct(), key, "left_anti")


def jobs(requests: DataFrame) -> DataFrame:
    """requests (doi, ord, force) -> one a key: first spelling, forced if any asks so."""
    return requests.groupBy(F.lower("doi").alias("doi_key")).agg(F.min_by("doi", "ord").alias("doi"), F.bool_or("force").alias("force"))


def retryable(error: Column) -> Column:
    return clean(error).rlike(RETRYABLE)


def retry_jobs(doi: Column, error: Column) -> Column:
    """array<struct<doi, force>>: the same again if the error looks transient, then another spelling."""
    again = F.when(retryable(error), normalize(doi)).otherwise("")
    jobs = F.array(F.struct(again.alias("doi"), F.lit(True).alias("force")), F.struct(ecs_variant(doi).alias("doi"), F.lit(False).alias("force")))
    return F.filter(jobs, lambda j: j["doi"] != "")


def search_results(source: str, value: Column, k: int = 5) -> Column:
    """array of AUTHORITY's fields: the works that a title search found, those with an identifier."""
    path, wrap = {
        "crossref": ("$.message.items", lambda i: F.concat(F.lit('{"message":'), i, F.lit("}"))),
        "datacite": ("$.data", lambda i: F.concat(F.lit('{"data":'), i, F.lit("}"))),
        "openalex": ("$.results", lambda i: i),
        "semantic_scholar": ("$.data", lambda i: i),
    }[source]
    items = F.from_json(F.get_json_object(value, path), "array<string>")
    made = F.transform(F.slice(F.coalesce(items, F.array().cast("array<string>")), 1, k), lambda i: parsed(source, wrap(i)))
    return F.filter(made, lambda a: a["authority_doi"] != "")


def source_rank(source: Column) -> Column:
    out = F.lit(len(PRIORITY))
    for name, n in PRIORITY.items():
        out = F.when(source == name, n).otherwise(out)
    return out


def one_answer(answers: DataFrame) -> DataFrame:
    """One row a key: the first source in order that resolved with a title, else that resolved, else the first that answered."""
    named = F.coalesce("title", F.lit("")) != ""
    yes = F.coalesce("resolved", F.lit(False))
    place = F.struct(F.when(yes & named, 0).when(yes, 1).otherwise(2), source_rank(F.col("source")), F.col("source"), F.to_json(F.struct("*")))
    rest = [c for c in answers.columns if c != "doi_key"]
    ok = answers.filter((F.col("source") != "osti") | F.col("doi_key").startswith("10.2172/"))
    return ok.groupBy("doi_key").agg(F.min_by(F.struct(*rest), place).alias("r")).select("doi_key", "r.*")


def input_authority(row: dict[str, Column]) -> Column:
    """The answer that earlier columns of a record hold: a struct, null without a title or a plausible identifier."""
    first = lambda *names: F.coalesce(*[F.nullif(clean(row[n]), F.lit("")) for n in names if n in row], F.lit(""))
    doi = candidate(first("authority_doi", "authority_doi_new", "doi"))
    title = first("authority_title", "authority_title_new")
    none = F.array().cast("array<string>")
    authors = F.coalesce(row["authority_authors"], none) if "authority_authors" in row else none
    fields = [F.concat_ws("", first(f"authority_{c}", f"authority_{c}_new")).alias(c) for c in ("container", "publisher", "year", "type")]
    made = F.struct(F.lit("previous_authority").alias("source"), F.lit(True).alias("resolved"), doi.alias("doi"), title.alias("title"), authors.alias("authors"), *fields,
        F.lit(None).cast("string").alias("error"))
    return F.when((doi != "") & (title != ""), made)


def _first_text(x: Column) -> Column:
    """First non-empty text of a JSON string that is a text or a list."""
    items = F.filter(F.from_json(F.when(x.startswith("["), x), "array<string>"), lambda s: clean(s) != "")
    return clean(F.coalesce(F.get(items, F.lit(0)), F.when(x.startswith("["), F.lit("")).otherwise(x)))


def _csl(message: Column, literal: bool) -> list[Column]:
    at = lambda path: F.get_json_object(message, path)
    people = F.from_json(at("$.author"), "array<struct<literal:string,given:string,family:string>>")
    name = lambda p: F.array_join(F.filter(F.array(clean(p["given"]), clean(p["family"])), lambda s: s != ""), " ")
    names = F.transform(people, lambda p: F.when(clean(p["literal"]) != "", clean(p["literal"])).otherwise(name(p)) if literal else name(p))
    names = F.coalesce(F.filter(names, lambda n: n != ""), F.array().cast("array<string>"))
    return [candidate(at("$.DOI")), _first_text(at("$.title")), names, _first_text(at("$.container-title")), _first_text(at("$.publisher")),
        clean(at("$.issued.date-parts[0][0]")), _first_text(at("$.type"))]


def _names(json: Column, *fields: str) -> Column:
    people = F.from_json(json, "array<struct<" + ",".join(f"{f}:string" for f in fields) + ">>")
    return F.coalesce(author_names(F.transform(people, lambda p: F.coalesce(*[F.nullif(clean(p[f]), F.lit("")) for f in fields]))), F.array().cast("array<string>"))


def parsed(source: str, value: Column) -> Column:
    """struct of AUTHORITY's fields from a source's JSON text."""
    at = lambda path: F.get_json_object(value, path)
    if source == "doi.org":
        fields = _csl(value, literal=True)
    elif source == "crossref":
        fields = _csl(at("$.message"), literal=False)
    elif source == "datacite":
        titles = F.filter(F.transform(F.from_json(at("$.data.attributes.titles"), "array<struct<title:string>>"), lambda t: clean(t["title"])), lambda t: t != "")
        fields = [candidate(at("$.data.attributes.doi")), F.coalesce(F.get(titles, F.lit(0)), F.lit("")), _names(at("$.data.attributes.creators"), "name"), F.lit(""),
            clean(at("$.data.attributes.publisher")), clean(at("$.data.attributes.publicationYear")), clean(at("$.data.attributes.types.resourceTypeGeneral"))]
    elif source == "osti":
        item = F.when(value.startswith("["), at("$[0]")).otherwise(value)
        of = lambda path: F.get_json_object(item, path)
        raw = F.coalesce(of("$.authors"), of("$.author"))
        people = F.when(raw.rlike(r"^\[\s*\{"), _names(raw, "full_name", "name")).when(raw.startswith("["), author_names(F.from_json(raw, "array<string>"))).otherwise(parse_authors(raw))
        fields = [candidate(of("$.doi")), clean(of("$.title")), people, clean(of("$.journal_name")), F.lit("OSTI"),
            F.substring(clean(F.coalesce(of("$.publication_date"), of("$.publication_year"))), 1, 4), clean(of("$.resource_type"))]
    elif source == "openalex":
        people = F.transform(F.from_json(at("$.authorships"), "array<struct<author:struct<display_name:string>>>"), lambda p: p["author"]["display_name"])
        fields = [candidate(at("$.doi")), clean(F.coalesce(at("$.title"), at("$.display_name"))), F.coalesce(author_names(people), F.array().cast("array<string>")),
            clean(at("$.primary_location.source.display_name")), F.lit("OpenAlex"), clean(at("$.publication_year")), clean(at("$.type"))]
    elif source == "semantic_scholar":
        kinds = F.array_join(F.from_json(at("$.publicationTypes"), "array<string>"), "; ")
        fields = [candidate(at("$.externalIds.DOI")), clean(at("$.title")), _names(at("$.authors"), "name"), clean(at("$.venue")), F.lit("Semantic Scholar"),
            clean(at("$.year")), F.coalesce(kinds, F.lit(""))]
    else:
        raise ValueError(f"unknown source {source}")
    names = [f.split(" ")[0] for f in AUTHORITY.split(", ")]
    return F.struct(*[c.alias(n) for c, n in zip(fields, names, strict=True)])


def resolve(requests: DataFrame, answers: DataFrame, key: str) -> DataFrame:
    """The first source in order that resolved with a title; OSTI is asked only for its own prefix.

    requests (key, doi), answers (doi_key, source, resolved, title, ...) -> requests with the answer's columns, nulls where
    there is none. ``tried`` counts the sources that answered. Of two answers of one source the first by all fields counts.
    """
    r = requests.withColumn("doi_key", F.lower("doi"))
    ok = answers.filter((F.col("source") != "osti") | F.col("doi_key").startswith("10.2172/"))
    rest = [c for c in answers.columns if c != "doi_key"]
    good = F.col("resolved") & (F.col("title") != "")
    place = F.struct(source_rank(F.col("source")), F.to_json(F.struct(*sorted(rest))))
    best = ok.groupBy("doi_key").agg(F.min_by(F.when(good, F.struct(*rest)), F.when(good, place)).alias("b"), F.count("*").alias("tried"))
    found = r.join(best, "doi_key", "left")
    return found.select(*[c for c in r.columns if c != "doi_key"], F.coalesce("tried", F.lit(0)).alias("tried"), *[F.col(f"b.{c}").alias(f"authority_{c}") for c in rest])


def verify(records: DataFrame, works: DataFrame, exact: bool = True) -> DataFrame:
    """records (doi, title, authors array) against works (doi_key, work_title, work_authors): scores and the verdict."""
    j = records.withColumn("doi_key", F.lower(normalize(F.col("doi")))).join(works, "doi_key", "left")
    a, found = author_score(F.col("authors"), F.col("work_authors")), F.col("work_title").isNotNull()
    j = with_title_score(j, "t", F.col("title"), F.col("work_title"), exact).withColumn("a", F.when(found, a).otherwise(0.0))
    ok = found & (F.col("t") >= 0.94) & ((F.col("a") >= 0.15) | (F.col("t") >= 0.985) & (F.size("authors") == 0))
    return j.withColumn("verified", ok).withColumn("reason",
        F.when(~found, "crossref_not_found").when(ok, "verified").otherwise("score_below_threshold")).withColumn("title_score",
        F.round("t", 4)).withColumn("author_score", F.round("a", 4)).drop("t", "a", "doi_key")
