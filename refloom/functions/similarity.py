"""Likeness of titles and authors. All native but the sequence ratio, which only pairs that need it reach."""

from __future__ import annotations

import difflib

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import COVERAGE_STOP_WORDS, is_bad_title, let, norm_text


def _words(normal: Column) -> Column:
    return F.array_distinct(F.filter(F.split(normal, " "), lambda w: w != ""))


def token_overlap(left: Column, right: Column) -> Column:
    """Share of the left title's words that the right one has."""
    share = lambda a: F.size(F.array_intersect(a, _words(norm_text(right)))) / F.greatest(F.size(a), F.lit(1))
    return let(_words(norm_text(left)), share)


def containment(left: Column, right: Column) -> Column:
    ratio = lambda a, b: F.when((a != "") & (b != "") & (a.contains(b) | b.contains(a)), F.least(F.length(a), F.length(b)) / F.greatest(F.length(a), F.length(b))).otherwise(0.0)
    return let(norm_text(left), lambda a: let(norm_text(right), lambda b: ratio(a, b)))


def _ratios(left: pd.Series, right: pd.Series) -> pd.Series:
    """The ratio of matching blocks, which is none of the edit distances that SQL has. Null where either is null."""
    known: dict[tuple[str, str], float] = {}

    def ratio(a: str, b: str) -> float | None:
        if a is None or b is None:
            return None
        if (a, b) not in known:
            known[a, b] = difflib.SequenceMatcher(None, a, b).ratio()
        return known[a, b]

    return pd.Series([ratio(a, b) for a, b in zip(left, right, strict=True)], dtype="float64")


def sequence_ratio(left: Column, right: Column) -> Column:
    """Marked so that the optimizer neither repeats it nor moves it into a filter or another expression."""
    return F.pandas_udf(_ratios, "double").asNondeterministic()(left, right)


def with_title_score(df: DataFrame, name: str, left: Column, right: Column, exact: bool = True) -> DataFrame:
    """Adds the score of two titles, 0 to 1 and not symmetric.

    Without ``exact`` the sequence ratio is left out, which bounds the score from below. With it, the Python function gets
    nulls for pairs that the native parts decide. Columns of their own keep it apart from the rest of the expression.
    """
    df = df.withColumns({"_a": norm_text(left), "_b": norm_text(right), "_bad": is_bad_title(left) | is_bad_title(right)})
    none = F.col("_bad") | (F.col("_a") == "") | (F.col("_b") == "")
    parts = [token_overlap(left, right) * 0.94, containment(left, right)]
    if exact:
        undecided = ~none & (F.col("_a") != F.col("_b"))
        df = df.withColumn("_ratio", sequence_ratio(F.when(undecided, F.col("_a")), F.when(undecided, F.col("_b"))))
        parts.append(F.coalesce("_ratio", F.lit(0.0)))
    score = F.when(none, 0.0).when(F.col("_a") == F.col("_b"), 1.0).otherwise(F.greatest(*parts))
    return df.withColumn(name, score).drop("_a", "_b", "_bad", "_ratio")


def _keys(author: Column) -> Column:
    words = F.filter(F.split(norm_text(author), " "), lambda w: F.length(w) >= 2)
    return let(words, lambda ws: F.when(F.size(ws) > 0, F.array(F.array_join(ws, ""), F.element_at(ws, -1))).otherwise(F.array().cast("array<string>")))


def author_score(query: Column, work: Column) -> Column:
    """Share of the query's authors of whom the joined words or the last one equal, hold or lie in one of the work's."""
    known = F.flatten(F.transform(F.coalesce(work, F.array().cast("array<string>")), _keys))
    asked = F.transform(F.coalesce(query, F.array().cast("array<string>")), _keys)

    def share(q: Column, ws: Column) -> Column:
        met = F.filter(q, lambda keys: F.exists(keys, lambda k: F.exists(ws, lambda w: w.contains(k) | k.contains(w))))
        return F.when((F.size(q) > 0) & (F.size(ws) > 0), F.size(met) / F.size(q)).otherwise(0.0)

    return let(asked, lambda q: let(known, lambda ws: share(q, ws)))


def title_coverage(title: Column, text: Column) -> Column:
    """1 if the text holds the title, else the share of its telling words that are anywhere in the text."""
    return let(norm_text(text), lambda x: coverage_of_normal(title, x))


def coverage_of_normal(title: Column, normal_text: Column) -> Column:
    """The same for a text in its normal form, which many titles may share."""

    def share(t: Column) -> Column:
        words = F.filter(F.split(t, " "), lambda w: (F.length(w) >= 4) & ~w.isin(*COVERAGE_STOP_WORDS))
        part = let(words, lambda ws: F.when(F.size(ws) > 0, F.size(F.filter(ws, lambda w: normal_text.contains(w))) / F.size(ws)).otherwise(0.0))
        return F.when((t == "") | (normal_text == ""), 0.0).when(normal_text.contains(t), 1.0).otherwise(part)

    return let(norm_text(title), share)
