"""Benchmark passages in documents, found by spaced seeds: DataFrame functions only.

Words are runs of letters and digits in lower case. A seed is the hash of the words at a mask's positions, so words at
the other positions may differ. Seeds of the documents meet seeds of the benchmark; each meeting fixes an alignment, and
the overlap around it is verified word by word: some ``WINDOW`` aligned words that include the seed must agree in at
least ``SHARE`` of their positions.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ROW, Scratch, id_text, row_numbers, table, text_names

MASKS = ((0, 1, 3, 6, 8, 9), (0, 2, 3, 5, 8, 9), (0, 1, 4, 5, 7, 9))
SPAN = 10
WINDOW, SHARE = 13, 0.8
#: Items of fewer words name no passage: clean texts hold such words by chance.
LEAST = 5
#: A benchmark of at most so many words is sent to every task; a larger one is joined by a shuffle.
BROADCAST_WORDS = 500_000
#: A benchmark of at most so many words has a table of the ends of its seeds, of eight to sixteen cells a word.
TABLE_WORDS = 32_768
SPLIT = r"[^\p{L}\p{N}]+"


def masks_of(length: int) -> tuple[tuple[int, ...], ...]:
    """The masks for items of so many words. Any window of WINDOW words that agrees in SHARE of them holds a seed of MASKS.

    A shorter item is aligned as a whole. With e words that may differ its positions fall into e + 1 interleaved masks, of
    which the differing words leave one untouched.
    """
    if length >= WINDOW:
        return MASKS
    e = length - math.ceil(length * SHARE)
    return tuple(tuple(range(r, length, e + 1)) for r in range(e + 1))


def word_hashes(text: Column) -> Column:
    words = F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), SPLIT), lambda w: w != "")
    return F.transform(words, lambda w: F.xxhash64(w))


def seeds(words: Column, length: int, first_only: bool = False, hopeful=None) -> Column:
    """array<struct<place, seed>> of the masks for items of so many words, at all places (or the first, or hopeful ones)."""
    masks = masks_of(length)
    span = SPAN if length >= WINDOW else length
    last = F.lit(0) if first_only else F.size(words) - span
    places = F.when(F.size(words) >= span, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
    if hopeful is not None:
        places = F.filter(places, lambda i: hopeful(words, i))
    seed = lambda i, k, mask: F.struct(i.alias("place"), F.xxhash64(F.lit(length), F.lit(k), *[F.get(words, i + d) for d in mask]).alias("seed"))
    return F.flatten(F.transform(places, lambda i: F.array(*[seed(i, k, mask) for k, mask in enumerate(masks)])))


def seed_rows(df: DataFrame, key: str, words: Column, made) -> DataFrame:
    """key, place, seed; the words stay behind, so that a row is a few bytes."""
    once = F.get(F.transform(F.array(words), made), F.lit(0))  # the words are made once, not at every place
    return df.select(key, F.explode(once).alias("s")).select(key, "s.place", "s.seed")


def ends(words: Column, i: Column, cells: int) -> Column:
    """Place in a table of so many cells of the words at both ends of all MASKS at place i."""
    first, last = MASKS[0][0], MASKS[0][-1]
    return F.get(words, i + first).bitwiseXOR(F.shiftleft(F.get(words, i + last), 1)).bitwiseAND(cells - 1).cast("int")


def end_table(items: DataFrame, cells: int) -> Column:
    """array<tinyint>, a constant: 1 where some seed of the benchmark has its ends."""
    places = F.when(F.size("item") >= SPAN, F.sequence(F.lit(0), F.size("item") - SPAN)).otherwise(F.array().cast("array<int>"))
    found = {r[0] for r in items.select(F.explode(F.transform(places, lambda i: ends(F.col("item"), i, cells)))).distinct().collect()}  # a row a cell at most
    return F.from_json(F.lit(str([int(c in found) for c in range(cells)])), "array<tinyint>")


def overlaps(scratch: Scratch, rows: DataFrame, benchmark: DataFrame) -> DataFrame:
    """rows (key, text), benchmark (item_id, text) -> key, item_id, shift, matched, aligned: each alignment with a verified window.

    First all rows' seeds meet the benchmark's; only places that do are looked at again, with the words around them. Where
    the benchmark is small, a table first says of each place whether any seed has the words at its two ends.
    """
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), word_hashes(F.col("text").cast("string")).alias("item")).filter(F.size("item") >= LEAST)
    items = row_numbers(scratch, items).withColumnRenamed(ROW, "number")
    total, lengths = items.agg(F.coalesce(F.sum(F.size("item")), F.lit(0)), F.collect_set(F.least(F.size("item"), F.lit(WINDOW)))).first()  # nine lengths at most
    lengths = sorted(lengths) or [WINDOW]
    own = lambda words: F.concat(*[F.when(F.least(F.size(words), F.lit(WINDOW)) == n, seeds(words, n, n < WINDOW)).otherwise(F.array().cast("array<struct<place:int,seed:bigint>>")) for n in lengths])
    known = seed_rows(items, "number", F.col("item"), own).withColumnRenamed("place", "item_place")
    sent = F.broadcast if total <= BROADCAST_WORDS else (lambda df: df)
    hopeful = None
    if total <= TABLE_WORDS:
        cells = 1 << max(10, (8 * total).bit_length())
        known_ends = end_table(items, cells)
        hopeful = lambda words, i: F.get(known_ends, ends(words, i, cells)) == 1
    every = lambda words: F.concat(*[seeds(words, n, hopeful=hopeful if n == WINDOW else None) for n in lengths])
    met = seed_rows(rows, "key", word_hashes(F.col("text")), every).join(sent(known.select("seed").distinct()), "seed", "left_semi")
    met = met.groupBy(F.col("key").alias("met_key")).agg(F.collect_set(F.struct("place", "seed")).alias("places"))  # at most a row's own places
    hashed = rows.join(met.hint("shuffle_hash"), F.col("key").eqNullSafe(F.col("met_key"))).select("key", "places", "text")
    # WINDOW - LEAST words before a place and WINDOW from it on hold every window with the seed
    low = lambda p: F.greatest(F.lit(0), p["place"] - (WINDOW - 1))
    around = lambda words: F.transform("places", lambda p: F.struct(p["place"].alias("place"), p["seed"].alias("seed"), (p["place"] - low(p)).alias("before"), F.slice(words, low(p) + 1, p["place"] - low(p) + WINDOW).alias("x")))
    near = F.get(F.transform(F.array(word_hashes(F.col("text"))), around), F.lit(0))
    near = hashed.select("key", F.explode(near).alias("p")).select("key", "p.*").distinct()
    pairs = near.join(sent(known), "seed").drop("seed").distinct().join(sent(items), "number")
    wide = F.least(F.lit(WINDOW), F.size("item"))
    most = F.when(F.size("item") >= WINDOW, WINDOW - SPAN).otherwise(0)  # words before the seed in a window that holds it
    back = F.least(F.col("before"), F.col("item_place"), most)
    x, y = F.slice("x", F.col("before") - back + 1, F.lit(2 * WINDOW)), F.slice("item", F.col("item_place") - back + 1, F.lit(2 * WINDOW))
    length = F.least(F.size("x") - F.col("before"), F.size("item") - F.col("item_place"), F.lit(WINDOW)) + back
    same = F.transform(F.sequence(F.lit(0), length - 1), lambda i: (F.get("_x", i) == F.get("_y", i)).cast("int"))
    pairs = pairs.withColumns({"_x": x, "_y": y, "aligned": wide, "_n": length}).withColumn("same", same)
    starts = F.sequence(F.lit(0), F.greatest(F.lit(0), F.col("_n") - F.col("aligned")))
    best = F.array_max(F.transform(starts, lambda s: F.aggregate(F.slice("same", s + 1, F.col("aligned")), F.lit(0), lambda total, v: total + v)))
    found = pairs.withColumn("matched", best).filter((F.col("_n") >= F.col("aligned")) & (F.col("matched") >= F.ceil(F.col("aligned") * F.lit(SHARE))))
    return found.groupBy("key", "item_id", (F.col("place") - F.col("item_place")).alias("shift")).agg(F.max("matched").alias("matched"), F.max("aligned").alias("aligned"))


def contaminated(spark: SparkSession, documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """documents (doc_id, text), benchmark (item_id, text) -> doc_id, item_id, n_hits, matched, aligned.

    One row for each document and item with a verified overlap: how many alignments of the two were verified, and of the
    best window how many words agree and how many are aligned. Items of fewer than five words name no passage and
    match nothing; windows are the whole item where it has fewer than thirteen words. Null and empty texts match
    nothing; a very long one is read whole; rows with one id count as one document, rows with a null id as well, and an
    item with a null id is an item. Empty tables give no rows. Other columns are not read, whatever their names.
    """
    found = overlaps(Scratch(spark, "decontamination"), id_text(documents).withColumnRenamed("doc_id", "key"), benchmark)
    return found.groupBy(F.col("key").alias("doc_id"), "item_id").agg(F.countDistinct("shift").alias("n_hits"), F.max("matched").cast("long").alias("matched"), F.max("aligned").cast("long").alias("aligned"))


def clean(spark: SparkSession, documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The documents, all columns, without the rows that hold a benchmark passage, whatever their ids: a text decides, by its 128-bit name."""
    scratch = Scratch(spark, "decontamination")
    named = documents.select("*", *text_names())
    rows = named.filter(F.col("text").isNotNull()).select(F.struct("__h", "__i").alias("key"), F.col("text").cast("string").alias("text"))
    bad = scratch.save(overlaps(scratch, rows, benchmark).select("key.*").distinct())
    scratch.keep_only(bad)
    return named.join(bad, ["__h", "__i"], "left_anti").select(*documents.columns)


def op4_spaced_seeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return contaminated(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


#: All alignments of all documents and items by their equal words, without any seed.
OP4_SQL = r"""
WITH d AS (SELECT doc_id, list_filter(string_split_regex(lower(coalesce(text, '')), '[^\pL\pN]+'), lambda x: x <> '') AS words FROM documents),
b AS (SELECT item_id, list_filter(string_split_regex(lower(coalesce(text, '')), '[^\pL\pN]+'), lambda x: x <> '') AS item FROM benchmark),
dw AS (SELECT doc_id, len(words) AS size, unnest(words) AS w, unnest(range(0, len(words))) AS pos FROM d),
bw AS (SELECT item_id, len(item) AS wide, unnest(item) AS w, unnest(range(0, len(item))) AS place FROM b WHERE len(item) >= 5),
e AS (SELECT doc_id, item_id, size, wide, pos - place AS shift, place FROM dw JOIN bw ON dw.w = bw.w),
a AS (SELECT doc_id, item_id, shift, least(13, wide) AS aligned, size, wide, list(place) AS places FROM e GROUP BY doc_id, item_id, shift, size, wide HAVING count(*) >= ceil(least(13, wide) * 0.8)),
s AS (SELECT *, unnest(range(greatest(0, -shift), least(wide, size - shift) - aligned + 1)) AS start FROM a),
v AS (SELECT doc_id, item_id, shift, aligned, len(list_filter(places, lambda p: p >= start AND p < start + aligned)) AS matched FROM s)
SELECT doc_id, item_id, count(DISTINCT shift)::BIGINT AS n_hits, max(matched)::BIGINT AS matched, max(aligned)::BIGINT AS aligned
FROM v WHERE matched >= ceil(aligned * 0.8) GROUP BY doc_id, item_id
"""
