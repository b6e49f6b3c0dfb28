"""Files as they arrive: the identification plan over a stream of the folder, one append for each micro-batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..plans.records import identify
from ..sources.files import file_hits, inventory


def ingest(spark: SparkSession, folder: str, out: str, checkpoint: str, recursive: bool = False, once: bool = True) -> StreamingQuery:
    """Identifies new PDFs of a folder and adds their rows, by batch, to a Parquet table.

    A batch that is run again after a failure replaces its own folder, so each file has its rows once.
    """
    files = inventory(spark, folder, recursive, stream=True)

    def batch(df: DataFrame, number: int) -> None:
        hits = file_hits(df)
        identify(hits, F.col("hits")).join(hits.select("path", "filename", "title"), "path").write.mode("overwrite").parquet(f"{out}/batch={number}")

    query = files.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint)
    return (query.trigger(availableNow=True) if once else query).start()
