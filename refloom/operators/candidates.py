"""From hits to the chosen identifier of each document: dedup, weights, grouping, top-1."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.identifiers import candidate_weight, is_plausible, source_group, weight_rank


def explode_hits(df: DataFrame, key: str, hits: Column) -> DataFrame:
    """key, ord (place in the array), doi, source, context."""
    return df.select(key, F.posexplode(hits).alias("ord", "h")).select(key, "ord", "h.*")


def unique_hits(hits: DataFrame, key: str) -> DataFrame:
    """The first hit for each identifier (whatever its case) and source of a document."""
    first = hits.groupBy(key, F.lower("doi").alias("doi_key"), "source").agg(F.min("ord").alias("ord"),
        F.min_by(F.struct(*[c for c in hits.columns if c not in (key, "ord", "source")]), "ord").alias("h"))
    return first.select(key, "ord", "source", "h.*")


def to_candidates(hits: DataFrame, key: str) -> DataFrame:
    return unique_hits(hits, key).withColumn("source_group", source_group(F.col("source"))).withColumn("raw_confidence", candidate_weight(F.col("source")))


def choose(candidates: DataFrame, key: str, policy: str = "candidate") -> DataFrame:
    """candidates (key, ord, doi, source, source_group, raw_confidence) -> key, doi, confidence, doi_decision, doi_source.

    Spellings that differ by case are one identifier. It wins by the number of independent sources (file names do not
    count), then its greatest weight, then how often it was found, then by who came first. Documents without a
    plausible candidate have no row. One aggregation by document and identifier and one by document, both combined
    before their shuffle: no window over all candidates.
    """
    c = candidates.filter(is_plausible(F.col("doi"))).withColumn("w", weight_rank(F.col("raw_confidence")))
    by_doi = c.groupBy(key, F.lower("doi").alias("doi_key")).agg(
        F.countDistinct(F.when(F.col("source_group") != "filename", F.col("source_group"))).alias("groups"),
        F.max("w").alias("w"),
        F.count("*").alias("n"),
        F.min("ord").alias("ord"),
        F.min_by("doi", "ord").alias("doi"),
        F.min_by("source", "ord").alias("source"),
        F.max_by("raw_confidence", F.struct("w", -F.col("ord"))).alias("confidence"),
    )
    best = by_doi.groupBy(key).agg(F.max_by(F.struct("doi", "groups", "confidence", "source"), F.struct("groups", "w", "n", -F.col("ord"))).alias("b"))
    only_names, several = F.col("b.groups") == 0, F.col("b.groups") >= 2
    if policy != "candidate":
        only_names = F.lit(False)
    return best.select(
        key,
        F.col("b.doi").alias("doi"),
        F.when(only_names, "review").when(several, "high").otherwise(F.col("b.confidence")).alias("confidence"),
        F.when(only_names, "filename_only_candidate_requires_validation").when(several, "multiple_independent_sources").otherwise("selected_by_source_weight").alias("doi_decision"),
        F.col("b.source").alias("doi_source"),
    )


def status(doi: Column, confidence: Column) -> Column:
    return F.when(doi.isNull() | (doi == ""), "no_doi").when(confidence == "review", "review").otherwise("ok")


def chosen_for_all(documents: DataFrame, candidates: DataFrame, key: str, policy: str = "candidate") -> DataFrame:
    """One row for each document, also without candidates."""
    out = documents.select(key).join(choose(candidates, key, policy), key, "left")
    out = out.withColumn("confidence", F.coalesce("confidence", F.lit("none"))).withColumn("doi_decision", F.coalesce("doi_decision", F.lit("no_candidate")))
    return out.withColumn("status", status(F.col("doi"), F.col("confidence")))


def longest_only(dois: DataFrame, key: str) -> DataFrame:
    """Drops an identifier that is a beginning, before a dot or a slash, of another of its document.

    Each identifier is expanded to its own such beginnings, which an anti-join removes: no comparison of all pairs.
    """
    beginnings = dois.select(key, F.explode(beginnings_of(F.lower("doi"))).alias("begin")).distinct()
    return dois.join(beginnings, (dois[key] == beginnings[key]) & (F.lower(dois.doi) == beginnings.begin), "left_anti")


def beginnings_of(doi: Column) -> Column:
    """Every part of the text before one of its dots or slashes."""
    places = F.filter(F.sequence(F.lit(1), F.length(doi)), lambda i: F.substring(doi, i, F.lit(1)).isin(".", "/"))
    return F.transform(places, lambda i: F.substring(doi, F.lit(1), i - 1))


def top(df: DataFrame, partition: list[str], *order: Column) -> DataFrame:
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*partition).orderBy(*order))).filter("_n = 1").drop("_n")
