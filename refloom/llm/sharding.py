"""Contiguous shards of equal bytes from global prefix sums."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import Scratch, partitions, table

HEADER = 8


def prefix_sums(spark: SparkSession, rows: DataFrame, order: list[str], sizes: list[str], scratch: Scratch) -> DataFrame:
    """Adds to rows, for each of ``sizes``, the sum over all rows before it in ``order`` (``<size>_before``) and over all (``<size>_all``).

    Rows are range-sorted and written once, with the number of their range; each range's totals (one row a range)
    give its offset, and a window inside the range gives the rest. No task holds more than one range.
    """
    ranged = rows.repartitionByRange(partitions(spark), *order).withColumn("_range", F.spark_partition_id())
    ranged = scratch.save(ranged)
    totals = ranged.groupBy("_range").agg(*[F.sum(s).alias(f"{s}_range") for s in sizes])
    over = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select("_range", *[F.coalesce(F.sum(f"{s}_range").over(over), F.lit(0)).alias(f"{s}_offset") for s in sizes], *[F.sum(f"{s}_range").over(Window.partitionBy()).alias(f"{s}_all") for s in sizes])
    inside = Window.partitionBy("_range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    # one row a range: at most the number of shuffle partitions
    out = ranged.withColumns({f"{s}_inside": F.coalesce(F.sum(s).over(inside), F.lit(0)) for s in sizes}).join(F.broadcast(offsets), "_range")
    return out.withColumns({f"{s}_before": F.col(f"{s}_offset") + F.col(f"{s}_inside") for s in sizes}).drop("_range", *[f"{s}_{x}" for s in sizes for x in ("offset", "inside")])


def shard(spark: SparkSession, documents: DataFrame, n: int = 24) -> DataFrame:
    """documents (doc_id, text) -> doc_id, size, text_crc32, law, shard, slot, grown_shard.

    Documents are laid end to end by doc_id; shard k has those whose middle byte lies in the k-th of n equal
    parts of all bytes, so that shards are contiguous and differ from the target by about one document.
    A null text counts no byte besides the header and has the checksum of an empty text. Rows with a null doc_id
    come first; rows with equal ids are ordered by checksum and size, and equal rows take neighbouring slots. A very
    long text is one document: its shard may exceed the target by its size. An empty table gives no rows. Other
    columns are not read, whatever their names.
    """
    scratch = Scratch(spark, "shard")
    text = F.col("text").cast("string")
    rows = documents.select(F.col("doc_id").cast("long").alias("doc_id"), (F.coalesce(F.octet_length(text), F.lit(0)) + HEADER).cast("long").alias("size"), F.crc32(F.coalesce(text, F.lit("")).cast("binary")).alias("text_crc32"), F.lit(1).cast("long").alias("row"))
    placed = prefix_sums(spark, rows, ["doc_id", "text_crc32", "size"], ["size", "row"], scratch)
    middle = F.col("size_before") * 2 + F.col("size")
    placed = placed.withColumn("shard", F.least(F.lit(n - 1), F.floor((middle * n).cast("decimal(38,0)") / (F.col("size_all") * 2))).cast("int"))
    placed = scratch.save(placed.drop("size_all", "row_all", "size_before", "row"))
    first = placed.groupBy("shard").agg(F.min("row_before").alias("first"))
    return placed.join(F.broadcast(first), "shard").select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("row_before") - F.col("first")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


def op10_prefix_sum_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard(spark, table(spark, sf_dir, "documents"))


# The checksum by its rule: a table of eight steps of a shift and the reversed polynomial for each byte.
_CRC = "list_transform(range(256), lambda b: list_reduce(range(8), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, b))"
_BYTES = "list_transform(regexp_extract_all(hex(encode(x)), '..'), lambda p: ('0x' || p)::BIGINT)"
OP10_SQL = f"""
WITH t AS MATERIALIZED (SELECT {_CRC} AS crc),
d AS (SELECT doc_id, coalesce(text, '') AS x FROM documents),
s AS (
  SELECT doc_id, octet_length(encode(x)) + 8 AS size,
         xor(list_reduce({_BYTES}, lambda c, b: xor(c >> 8, crc[(xor(c, b) & 255) + 1]), 4294967295), 4294967295)::BIGINT AS text_crc32
  FROM d, t),
o AS (
  SELECT *, sum(size) OVER (ORDER BY doc_id NULLS FIRST, text_crc32, size ROWS UNBOUNDED PRECEDING) - size AS before, sum(size) OVER () AS total FROM s),
p AS (SELECT *, least(23, ((2 * before + size) * 24) // (2 * total))::INT AS shard FROM o)
SELECT doc_id, size::BIGINT AS size, text_crc32, 'bytes' AS law, shard,
       row_number() OVER (PARTITION BY shard ORDER BY doc_id NULLS FIRST, text_crc32, size) - 1 AS slot, NULL::INT AS grown_shard
FROM p
"""
