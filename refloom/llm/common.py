"""Scratch tables and small helpers shared by the operators."""

from __future__ import annotations

import atexit
import gc
import tempfile
import time
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_OWN_DIR: list[str] = []


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``. Where all run in one process a temporary one serves, too."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.split("[")[0] == "local":
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    if not _OWN_DIR:
        _OWN_DIR.append("file://" + tempfile.mkdtemp(prefix="refloom-checkpoint-"))
    return _OWN_DIR[0]


def _delete(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    if jvm is None:
        return
    p = jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)


class Scratch:
    """Tables written to the shared folder: they cut lineage and outlive executors.

    ``drop`` removes one that no later step reads; what a returned DataFrame still needs goes when the
    driver's Python ends.
    """

    def __init__(self, spark: SparkSession, name: str):
        self.spark, self.root, self.n = spark, f"{shared_dir(spark)}/refloom-{name}-{uuid.uuid4().hex[:12]}", 0
        atexit.register(self._close)

    def save(self, df: DataFrame) -> DataFrame:
        self.n += 1
        path = f"{self.root}/{self.n}"
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        out._scratch_path = path
        return out

    def drop(self, *dfs: DataFrame) -> None:
        for df in dfs:
            _delete(self.spark, df._scratch_path)

    def keep_only(self, *dfs: DataFrame) -> None:
        """Deletes all tables but these: nothing else is read any more."""
        kept = {df._scratch_path for df in dfs}
        for n in range(1, self.n + 1):
            if f"{self.root}/{n}" not in kept:
                _delete(self.spark, f"{self.root}/{n}")
        self.release()

    def release(self) -> None:
        """Let Spark remove the shuffle files of finished steps, which it does when their plans are collected. For after large steps."""
        for _ in range(2):
            gc.collect()
            self.spark.sparkContext._jvm.System.gc()
            time.sleep(0.3)

    def _close(self) -> None:
        try:
            if self.spark.sparkContext._jsc is not None:
                _delete(self.spark, self.root)
        except Exception:  # noqa: BLE001  the session has ended: its folder is the cluster's to clear
            pass


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def id_text(schema_df: DataFrame, doc: str = "doc_id", text: str = "text") -> DataFrame:
    """Just the id and the text, under fixed names, whatever other columns there are."""
    return schema_df.select(F.col(f"`{doc}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))


#: Name of the column that numbers rows.
ROW = "__row"


def row_numbers(scratch: Scratch, df: DataFrame) -> DataFrame:
    """All columns and ROW, a number of its own for each row: ids may be null or repeat. Written, so that it stays the same."""
    return scratch.save(df.withColumn(ROW, F.monotonically_increasing_id()))


def text_names(text: str = "text") -> list[Column]:
    """Two 64-bit hashes that name a text together; null where it is null."""
    return [F.when(F.col(text).isNotNull(), F.xxhash64(F.col(text), F.lit(seed))).alias(f"__{name}") for name, seed in (("h", 17), ("i", 29))]


def salted_join(left: DataFrame, right: DataFrame, key: str, by: str, salts: int = 8) -> DataFrame:
    """left joined with right (one row a key), each key dealt over several tasks by ``by``: a key may have very many rows on the left."""
    dealt = left.withColumn("__salt", F.pmod(F.xxhash64(by), F.lit(salts)).cast("int"))
    each = right.withColumn("__salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return dealt.join(each, [key, "__salt"]).drop("__salt")


def batch(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


def held_out(column: str, modulus: int, remainder: int) -> Column:
    """Whether a row is kept from training; one with a null id is not."""
    return F.coalesce(F.crc32(F.col(column).cast("string")) % modulus == remainder, F.lit(False))
