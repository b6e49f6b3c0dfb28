"""Identification of documents, metadata from side tables, summaries, and search of titles.

Each pass is one plan of joins and CASE expressions. Expensive evaluation (OCR, live look-ups) runs on the filtered
rest only, because the engine would call a Python function inside CASE for every row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import is_bad_title, norm_text, parse_authors
from ..operators import candidates as C

CANDIDATE = ("doi", "source", "source_group", "raw_confidence", "context")


def identify(documents: DataFrame, hits: Column, key: str = "path", policy: str = "candidate") -> DataFrame:
    """documents with an array of hits -> one row each: doi, confidence, doi_decision, doi_source, status, doi_candidates."""
    found = C.to_candidates(C.explode_hits(documents, key, hits), key)
    listed = F.array_sort(F.collect_list(F.struct("ord", *CANDIDATE)))  # a document's own
    nested = found.groupBy(key).agg(F.transform(listed, lambda c: F.struct(*[c[x].alias(x) for x in CANDIDATE])).alias("doi_candidates"))
    return C.chosen_for_all(documents, found, key, policy).join(nested, key, "left")


def with_side_metadata(records: DataFrame, side: DataFrame) -> DataFrame:
    """records (name_key, title, authors, ...) filled from the side table (name_key, title, authors text, ...).

    A title is replaced only if the record's own says nothing; authors, year, journal, publisher and abstract only where
    there are none. Where each came from is kept.
    """
    fields = ("year", "journal", "publisher", "abstract")
    theirs = side.select("name_key", *[F.col(c).alias(f"s_{c}") for c in ("title", "authors", *fields)])
    j = records.join(theirs, "name_key", "left")
    has = lambda c: F.coalesce(F.col(c), F.lit("")) != ""
    people = parse_authors(F.col("s_authors"))
    own = F.size(F.coalesce("authors", F.array().cast("array<string>"))) > 0
    new_title, new_authors = has("s_title") & is_bad_title(F.col("title")), (F.size(people) > 0) & ~own
    filled = {c: ~has(c) & has(f"s_{c}") for c in fields if c in records.columns}
    any_new = new_title | new_authors
    for cond in filled.values():
        any_new = any_new | cond
    out = {
        "title_source": F.when(new_title, "grobid").when(has("title"), "pdf").otherwise(""),
        "authors_source": F.when(new_authors, "grobid").when(own, "pdf").otherwise(""),
        "metadata_source": F.when(any_new, "grobid").otherwise(""),
        "title": F.when(new_title, F.col("s_title")).otherwise(F.col("title")),
        "authors": F.when(new_authors, people).otherwise(F.col("authors")),
        **{c: F.when(cond, F.col(f"s_{c}")).otherwise(F.col(c)) for c, cond in filled.items()},
    }
    return j.withColumns(out).drop(*[f"s_{c}" for c in ("title", "authors", *fields)])


def summary(decisions: DataFrame, by: list[str]) -> DataFrame:
    """metric, value, n: how many rows in all and by each column; one shuffle."""
    which = F.lit("total")
    for c in by:
        which = F.when(F.grouping(c) == 0, c).otherwise(which)
    df = decisions.groupingSets([[F.col(c)] for c in by] + [[]], *[F.col(c) for c in by])
    value = F.coalesce(*[F.col(c).cast("string") for c in by], F.lit(""))
    return df.agg(which.alias("metric"), value.alias("value"), F.count("*").alias("n")).select("metric", "value", "n")


def title_search(queries: DataFrame, index: DataFrame, k: int = 5, common: int = 1000) -> DataFrame:
    """queries (query_id, title), index (doc_key, title) -> query_id, doc_key, rank, overlap: the k likest titles, exactly.

    The overlap is the share of the query's words that the title has; of equal ones the smaller doc_key comes first. Words of
    at most ``common`` titles lead from a query to titles, which are scored. A title that shares none of these has only
    common words of the query. These are put in one order, the rarest first, and a set of them is cut before each of its
    words. A query and a title meet at the rarest word that they share, and what follows it in both decides how many they
    share. Few words are more frequent than a frequent one, so few such ends differ: each is met once, whatever number of
    sets, titles and queries has it. Of all titles with the same end the first k by doc_key can be among the best.
    """
    words = lambda df, key: df.select(key, F.array_distinct(F.filter(F.split(norm_text(F.col("title")), " "), lambda w: w != "")).alias("ws"))
    q, x = words(queries, "query_id"), words(index, "doc_key")
    each = x.select("doc_key", F.explode("ws").alias("w"))
    asked = q.select("query_id", F.explode("ws").alias("w"))
    spread = each.groupBy("w").count().join(asked.select("w").distinct(), "w", "left_semi")
    rare = spread.filter(F.col("count") <= common).select("w")
    pairs = asked.join(each.join(rare, "w"), "w").select("query_id", "doc_key").distinct()
    met = pairs.join(q, "query_id").join(x.withColumnRenamed("ws", "xs"), "doc_key").select("query_id", "doc_key", F.size(F.array_intersect("ws", "xs")).alias("shared"))

    often = spread.filter(F.col("count") > common)
    sets = lambda df, key: df.join(often, "w").groupBy(key).agg(F.array_sort(F.collect_set(F.struct("count", "w")))["w"].alias("set"))
    ends = lambda df, name: df.withColumn("i", F.explode(F.sequence(F.lit(1), F.size("set")))).withColumn(name, F.slice("set", F.col("i"), F.size("set")))
    begin = lambda df, name: df.withColumn("w", F.element_at(name, 1))
    by_query = begin(sets(asked, "query_id"), "set")
    wanted = begin(ends(by_query.select("set").distinct(), "end").select("set", "end"), "end")
    first = ends(best_rows(sets(each, "doc_key"), ["set"], [F.col("doc_key")], k), "other")
    first = best_rows(first.select("other", "doc_key"), ["other"], [F.col("doc_key")], k)
    theirs = begin(first.groupBy("other").agg(F.collect_list("doc_key").alias("keys")), "other")  # k at most
    both = wanted.select("w", "end").distinct().join(theirs, "w")
    both = both.select("w", "end", F.explode("keys").alias("doc_key"), F.size(F.array_intersect("end", "other")).alias("shared"))
    # joined by the first word as well, for an exchange of their own: many sets have the same end, many queries the same set
    both = wanted.join(best_rows(both, ["end"], [F.desc("shared"), F.col("doc_key")], k).drop("rank"), ["w", "end"])
    both = both.groupBy("set", "doc_key").agg(F.max("shared").alias("shared"))
    both = begin(best_rows(both, ["set"], [F.desc("shared"), F.col("doc_key")], k), "set")
    plain = by_query.join(both, ["w", "set"]).select("query_id", "doc_key", "shared")

    found = met.unionByName(plain).groupBy("query_id", "doc_key").agg(F.max("shared").alias("shared"))
    best = best_rows(found, ["query_id"], [F.desc("shared"), F.col("doc_key")], k)
    sizes = q.select("query_id", F.size("ws").alias("n"))
    return best.join(sizes, "query_id").select("query_id", "doc_key", "rank", F.round(F.col("shared") / F.col("n"), 4).alias("overlap"))


def best_rows(df: DataFrame, by: list[str], order: list[Column], k: int) -> DataFrame:
    """The first k rows of each group with their rank; all but k go before the shuffle, too."""
    return df.withColumn("rank", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).filter(F.col("rank") <= k)


__all__ = ["best_rows", "identify", "summary", "title_search", "with_side_metadata"]
