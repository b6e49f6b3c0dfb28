"""Near-duplicate documents by circulant MinHash, with links confirmed on full shingle sets.

A first permutation (a hash) scatters the shingles over 2**32 places; a second permutation, shifted circularly by
0, 1, 2 ... places, gives every signature coordinate. Signatures are banded. Texts of equal words are one class, named
by a digest of them, so copies cost one row each. In a bucket, every class is compared with one centre; only classes
that are still apart after that are compared with the rest of their bucket, in blocks, and only where the triangle
inequality of the Jaccard distance leaves a link possible. Joins by bucket are salted: one bucket may hold very many.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import ROW, Scratch, batch, row_numbers, salted_join, table, text_names
from .components import components
from .words import LOWER, U, Words, chunks, content, mix, prefix_sums

WIDTH = 5


def shingles(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle names of each row, end to end, and where each row's begin."""
    n, first = words.counts, words.first
    per_row = np.where(n >= WIDTH, n - WIDTH + 1, (n > 0).astype(n.dtype))
    bounds = np.zeros(len(n) + 1, np.int64)
    np.cumsum(per_row, out=bounds[1:])
    start = np.arange(bounds[-1]) - np.repeat(bounds[:-1], per_row) + np.repeat(first[:-1], per_row)
    end = np.minimum(start + WIDTH, np.repeat(first[1:], per_row))
    names = content(prefix_sums(words.names), start, end)
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        names[a:b].sort()
    new = np.ones(len(names), bool)
    new[1:] = names[1:] != names[:-1]
    new[bounds[:-1][per_row > 0]] = True
    at = np.zeros(len(new) + 1, np.int64)
    np.cumsum(new, out=at[1:])
    return names[new], at[bounds]


LOWERED = LOWER.tobytes()


def digest(text: str | None) -> bytes | None:
    """Names the sequence of a text's words; null without words."""
    words = (text or "").encode("utf-8", "replace").translate(LOWERED).split()
    return hashlib.blake2b(b" ".join(words), digest_size=16).digest() if words else None


def signatures(names: np.ndarray, bounds: np.ndarray, size: int) -> np.ndarray:
    """size rows of minima: coordinate k is the least image, under the second permutation, of the places shifted by k."""
    place = (mix(names) >> U(32)).astype(np.uint32)
    out = np.empty((size, len(bounds) - 1), np.uint32)
    x, y = np.empty_like(place), np.empty_like(place)
    for k in range(size):
        np.add(place, np.uint32(k), out=x)
        for shift, factor in ((16, 0x7FEB352D), (15, 0x846CA68B)):
            np.right_shift(x, np.uint32(shift), out=y)
            np.bitwise_xor(x, y, out=x)
            np.multiply(x, np.uint32(factor), out=x)
        np.right_shift(x, np.uint32(16), out=y)
        np.bitwise_xor(x, y, out=x)
        out[k] = np.minimum.reduceat(x, bounds[:-1])
    return out


def bands(signature: np.ndarray, rows: int) -> np.ndarray:
    out = []
    for i in range(0, len(signature), rows):
        h = np.full(signature.shape[1], i + 1, U)
        for s in signature[i : i + rows]:
            h = mix(h * U(0x9E3779B97F4A7C15) ^ s)
        out.append(h)
    return np.array(out)


SKETCH = pa.schema([("h", pa.int64()), ("i", pa.int64()), ("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("name", pa.binary()), ("bands", pa.list_(pa.int64()))])


def sketch(documents: DataFrame, rows: int, n_bands: int) -> DataFrame:
    """h, i (the text's name), doc_id, n_shingles, name (the words' digest; null without words) and bands."""

    def run(batches):
        for whole in batches:
            for b in chunks(whole):
                names, bounds = shingles(Words(b.column("text"), lower=True))
                n = np.diff(bounds)
                full = n > 0
                lists = np.zeros((len(n), n_bands), np.int64)
                if full.any():
                    found = bands(signatures(names, np.r_[bounds[:-1][full], bounds[-1]], rows * n_bands), rows).T
                    lists[full] = np.ascontiguousarray(found).view(np.int64)
                named = [digest(t) for t in b.column("text").to_pylist()]
                yield batch(SKETCH, b.column("__h"), b.column("__i"), b.column("doc_id"), n, named, pa.FixedSizeListArray.from_arrays(pa.array(lists.ravel()), n_bands).cast(SKETCH.field("bands").type))

    picked = documents.select(*text_names(), F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return picked.mapInArrow(run, "h long, i long, doc_id long, n_shingles long, name binary, bands array<long>")


SETS = pa.schema([("k", pa.int64()), ("shingles", pa.binary())])


def sets(documents: DataFrame, wanted: DataFrame) -> DataFrame:
    """k and the full shingle set of each wanted class (k, name, rep: a doc_id that has it)."""

    def run(batches):
        for whole in batches:
            for b in chunks(whole):
                same = [digest(t) == n for t, n in zip(b.column("text").to_pylist(), b.column("name").to_pylist(), strict=True)]
                b = b.filter(pa.array(same))  # another text may have the doc_id
                if b.num_rows:
                    names, bounds = shingles(Words(b.column("text"), lower=True))
                    yield batch(SETS, b.column("k"), [names[x:y].tobytes() for x, y in zip(bounds[:-1], bounds[1:], strict=True)])

    picked = documents.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    joined = picked.join(wanted.hint("shuffle_hash"), F.col("doc_id").eqNullSafe(F.col("rep"))).select("k", "name", "text")
    return joined.mapInArrow(run, "k long, shingles binary")


def overlap(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection of two sorted sets."""
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    return int((b[at] == a).sum())


def measured(pairs: DataFrame, full: DataFrame) -> DataFrame:
    """pairs (u, v) -> u, v, shared, total: sizes of the intersection and the union of the full sets."""
    out = pa.schema([("u", pa.int64()), ("v", pa.int64()), ("shared", pa.int64()), ("total", pa.int64())])

    def run(batches):
        for b in batches:
            rows = []
            for u, v, x, y in zip(b.column("u").to_pylist(), b.column("v").to_pylist(), b.column("x"), b.column("y"), strict=True):
                x, y = np.frombuffer(x.as_buffer(), U), np.frombuffer(y.as_buffer(), U)
                s = overlap(x, y)
                rows.append((u, v, s, len(x) + len(y) - s))
            if rows:
                yield batch(out, *(list(c) for c in zip(*rows, strict=True)))

    both = pairs.join(full.select(F.col("k").alias("u"), F.col("shingles").alias("x")), "u").join(full.select(F.col("k").alias("v"), F.col("shingles").alias("y")), "v")
    return both.select("u", "v", "x", "y").mapInArrow(run, "u long, v long, shared long, total long")


LEFT, RIGHT = 64, 256


def compared(spark: SparkSession, apart: DataFrame, rest: DataFrame, full: DataFrame, percent: int) -> DataFrame:
    """Links (u, v) between classes that are apart and all others of their bucket, in blocks of bounded size.

    apart, rest: (b, k, root, d, lefts, rights); lefts and rights are the numbers of blocks of the bucket.
    """
    schema = pa.schema([("u", pa.int64()), ("v", pa.int64())])

    def block(t: pa.Table) -> pa.Table:
        k, root, d = (t.column(c).to_numpy() for c in ("k", "root", "d"))
        side = np.array(t.column("side").to_pylist())
        s = [np.frombuffer(x.as_buffer(), U) for x in t.column("shingles")]
        n = np.array([len(x) for x in s])
        links = []
        for i in np.flatnonzero(side == 0):
            # Jaccard distance is a metric: rows whose distances to the centre differ by more cannot be linked
            near = (side == 1) & (root != root[i]) & (100 * np.minimum(n, n[i]) >= percent * np.maximum(n, n[i])) & (np.abs(d - d[i]) <= 1 - percent / 100 + 1e-9)
            for j in np.flatnonzero(near):
                shared = overlap(s[i], s[j])
                if 100 * shared >= percent * (n[i] + n[j] - shared):
                    links.append((k[i], k[j]))
        return pa.table([pa.array([x[c] for x in links], pa.int64()) for c in (0, 1)], schema=schema)

    pick = lambda n: F.pmod(F.xxhash64("k", F.lit(7)), n).cast("int")
    left = apart.withColumn("l", pick(F.col("lefts"))).withColumn("r", F.explode(F.sequence(F.lit(0), F.col("rights") - 1))).withColumn("side", F.lit(0))
    right = rest.withColumn("r", pick(F.col("rights"))).withColumn("l", F.explode(F.sequence(F.lit(0), F.col("lefts") - 1))).withColumn("side", F.lit(1))
    rows = left.unionByName(right).select("b", F.col("l").cast("int"), F.col("r").cast("int"), "side", "k", "root", "d").join(full, "k")
    return rows.groupBy("b", "l", "r").applyInArrow(block, "u long, v long")


def placed(spark: SparkSession, documents: DataFrame, sketched: DataFrame, percent: int, scratch: Scratch) -> DataFrame:
    """name, root, component: each class, what names its group, and the smallest doc_id in that."""
    classes = sketched.filter("name is not null").groupBy("name").agg(F.min("doc_id").alias("rep"), F.first("bands").alias("bands"))
    classes = row_numbers(scratch, classes).withColumnRenamed(ROW, "k")
    entries = classes.select("k", "rep", F.explode("bands").alias("b"))
    buckets = entries.groupBy("b").agg(F.min(F.struct("rep", "k")).alias("c"), F.count("*").alias("n")).filter("n > 1").select("b", F.col("c.k").alias("center"))
    members = scratch.save(salted_join(entries.select("k", "b"), buckets, "b", "k").select("b", "center", "k"))
    full = scratch.save(sets(documents, classes.join(members.select("k").distinct(), "k").select("k", "name", "rep")))
    if full.count() > full.select("k").distinct().count():  # repeated rows
        full = scratch.save(full.dropDuplicates(["k"]))
    star = members.filter("k <> center").select(F.col("center").alias("u"), F.col("k").alias("v")).distinct()
    star = scratch.save(measured(star, full))
    scratch.release()
    linked = star.filter(F.col("shared") * 100 >= F.col("total") * percent).select("u", "v")
    roots = components(spark, linked, scratch)

    # Buckets that still hold several components: compare the classes outside the centre's with what may be near.
    seen = members.join(roots, members.k == roots.node, "left").select("b", "center", "k", F.coalesce("root", "k").alias("root"))
    seen = seen.join(star.select(F.col("u").alias("center"), F.col("v").alias("k"), (1 - F.col("shared") / F.col("total")).alias("d")), ["center", "k"], "left").withColumn("d", F.coalesce("d", F.lit(0.0)))
    seen = scratch.save(seen)
    mixed = seen.groupBy("b").agg(F.min("root").alias("low"), F.max("root").alias("high"), F.min_by("root", F.struct("d", "k")).alias("main"), F.count("*").alias("n"), F.sum(F.xxhash64("k").cast("decimal(38,0)")).alias("sum")).filter("low <> high")
    mixed = mixed.groupBy("n", "sum").agg(F.min_by(F.struct("b", "main"), "b").alias("x")).select("x.b", "x.main")  # the same classes in another band are compared once
    parts = salted_join(seen, mixed, "b", "k").withColumn("apart", F.col("root") != F.col("main"))
    reach = parts.filter("apart").groupBy("b").agg(F.min("d").alias("least"), F.count("*").alias("lefts"))
    parts = salted_join(parts, reach, "b", "k").filter((F.col("apart")) | (F.col("d") >= F.col("least") - (1 - percent / 100) - 1e-9))
    sizes = parts.groupBy("b").agg(F.ceil(F.count("*") / RIGHT).alias("rights"))
    parts = scratch.save(salted_join(parts.withColumn("lefts", F.ceil(F.col("lefts") / LEFT)), sizes, "b", "k").select("b", "k", "root", "d", "apart", "lefts", "rights"))
    if parts.limit(1).count():
        more = compared(spark, parts.filter("apart").drop("apart"), parts.drop("apart"), full, percent)
        roots = components(spark, linked.unionByName(more), scratch)

    found = classes.select("k", "name", "rep").join(roots.withColumnRenamed("node", "k"), "k", "left").withColumn("root", F.coalesce("root", "k"))
    least = found.groupBy("root").agg(F.min("rep").alias("component"))
    return scratch.save(found.join(least, "root").select("name", "root", "component"))


def near_duplicates(spark: SparkSession, documents: DataFrame, percent: int = 85, rows: int = 6, n_bands: int = 16) -> DataFrame:
    """documents (doc_id, text) -> doc_id, n_shingles, component_id, kept; one row a document.

    Two documents are linked if 100 * |intersection| >= percent * |union| of their shingle sets. A pair at the
    threshold of 0.85 shares a band with probability 0.9995 (0.99999 at 0.9). Rows without words are linked with
    nothing and kept. Rows with one text, repeated rows among them, are one class; very long texts are compared whole. A
    null doc_id stays: its component is the smallest doc_id of its group, null if it has none, and then it is kept. An
    empty table gives no rows. Other columns are not read, whatever their names.
    """
    scratch = Scratch(spark, "minhash")
    sketched = scratch.save(sketch(documents, rows, n_bands))
    out = sketched.select("doc_id", "n_shingles", "name").join(placed(spark, documents, sketched, percent, scratch), "name", "left")
    out = out.withColumn("component_id", F.when(F.col("name").isNull(), F.col("doc_id")).otherwise(F.col("component")))
    return out.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def deduplicated(spark: SparkSession, documents: DataFrame, percent: int = 80, rows: int = 5, n_bands: int = 20) -> DataFrame:
    """The documents, all columns, of each group the one row with the smallest doc_id (of equal ones, or without any, the least by a digest of the words).

    Rows count, not ids: null and repeated doc_ids are rows like others, and another text that shares a doc_id stays.
    Rows without words all stay. A pair at 0.8 shares a band with probability 0.9996. A row is known by its doc_id and the
    128-bit name of its text; rows that share both are told apart only where they are the ones that stay.
    """
    scratch = Scratch(spark, "minhash")
    sketched = scratch.save(sketch(documents, rows, n_bands))
    groups = sketched.select("h", "i", "doc_id", "name").join(placed(spark, documents, sketched, percent, scratch).select("name", "root"), "name")
    first = groups.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "name", "h", "i")).alias("f"))
    first = scratch.save(first.select("f.*"))
    same = (F.col("a.h") == F.col("b.h")) & (F.col("a.i") == F.col("b.i")) & F.col("a.doc_id").eqNullSafe(F.col("b.doc_id"))
    again = sketched.alias("a").join(first.alias("b"), same, "left_semi").groupBy("h", "i", "doc_id").count().filter("count > 1").drop("count")
    again = scratch.save(again)
    scratch.keep_only(first, again)
    named = documents.select("*", *text_names(), F.col("doc_id").cast("long").alias("__d"))
    theirs = lambda df: df.select(*[F.col(c).alias(f"__{c}_") for c in ("h", "i")], F.col("doc_id").alias("__d_"))
    match = (F.col("__h") == F.col("__h_")) & (F.col("__i") == F.col("__i_")) & F.col("__d").eqNullSafe(F.col("__d_"))
    wordless = ~F.coalesce(F.col("text").cast("string"), F.lit("")).rlike(r"[^\x20\x09-\x0D]")
    kept = named.filter(~wordless).join(theirs(first), match, "left_semi")
    if again.limit(1).count():
        repeated = kept.join(theirs(again), match, "left_semi").dropDuplicates(["__h", "__i", "__d"])
        kept = kept.join(theirs(again), match, "left_anti").unionByName(repeated)
    return kept.unionByName(named.filter(wordless)).select(*documents.columns)


def op7_circulant_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(spark, table(spark, sf_dir, "documents"))


OP7_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[ \t\n\x0B\f\r]+'), lambda x: x <> '') AS a
  FROM documents),
s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(a) >= 5 THEN list_transform(range(1, len(a) - 3), lambda i: array_to_string(a[i:i + 4], ' ')) WHEN len(a) > 0 THEN [array_to_string(a, ' ')] ELSE [] END) AS g
  FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (
  SELECT x.doc_id AS u, y.doc_id AS v, count(*) AS c FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY 1, 2),
l AS (
  SELECT u, v FROM p JOIN n a ON a.doc_id = u JOIN n b ON b.doc_id = v WHERE 100 * c >= 85 * (a.n + b.n - c)),
r(doc_id, reach) AS (
  SELECT doc_id, doc_id FROM documents
  UNION
  SELECT r.doc_id, l.v FROM r JOIN l ON l.u = r.reach)
SELECT d.doc_id, coalesce(any_value(n.n), 0)::BIGINT AS n_shingles, min(r.reach)::BIGINT AS component_id, d.doc_id = min(r.reach) AS kept
FROM documents d JOIN r ON r.doc_id = d.doc_id LEFT JOIN n ON n.doc_id = d.doc_id GROUP BY d.doc_id
"""
