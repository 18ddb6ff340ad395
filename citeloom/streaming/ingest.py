"""Incremental extraction: new document files are read as a stream, their mentions appended.

Extraction and classification look at one document at a time, so they run on the
stream as they do on a table. Counts are not kept in stream state: group identity may
change when later documents come, so each batch appends its mentions and the counts
are made from the whole table when asked for. A batch that is replayed after a failure
overwrites its own partition, so no mention is counted twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from citeloom.operators.extract import extract
from citeloom.operators.shapes import ShapeSet

SCHEMA = "court string, corpus_row_index long, citation string, year int, text string"


def read_documents(spark: SparkSession, path: str, files_per_batch: int = 100) -> DataFrame:
    """Parquet files of documents as they arrive under ``path``."""
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", files_per_batch).parquet(path)


def append_mentions(docs: DataFrame, out: str, checkpoint: str, shapes: ShapeSet | None = None) -> StreamingQuery:
    """Write each batch's candidates to ``out/batch=n``; runs until what is there has been read."""

    def write(batch: DataFrame, n: int) -> None:
        extract(batch, shapes).write.mode("overwrite").parquet(f"{out}/batch={n}")

    return docs.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def counts_by_court_and_year(docs: DataFrame, late: str = "365 days") -> DataFrame:
    """Documents per court and year of a stream with event time, late ones admitted up to ``late``."""
    dated = docs.withColumn("at", F.make_date("year", F.lit(1), F.lit(1)).cast("timestamp")).withWatermark("at", late)
    return dated.groupBy(F.window("at", "366 days"), "court").agg(F.count(F.lit(1)).alias("documents"))
