"""Raw counts as a stream of files, upserted into daily counts (an extension).

Late rows are the rule here, so nothing is dropped by a watermark: facts are
kept by release and day, and a batch replaces the facts that it brings anew.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.schemas import RAW_COUNTS

KEY = ["channel", "artifact", "release", "day"]


def facts_of(batch: DataFrame) -> DataFrame:
    """Counts of a batch by release and day; several countries of a day are added."""
    return batch.where("day is not null and n is not null").groupBy(*KEY).agg(F.sum("n").cast("long").alias("n"))


def start(spark: SparkSession, source: str, facts: str, checkpoint: str) -> StreamingQuery:
    """Read Parquet files of raw counts from ``source``; keep every batch's facts under ``facts/batch=<id>``.

    A batch that is run again overwrites its own folder, so facts are not doubled.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        facts_of(batch).write.mode("overwrite").parquet(f"{facts}/batch={batch_id}")

    stream = spark.readStream.schema(RAW_COUNTS).parquet(source)
    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def current(spark: SparkSession, facts: str) -> DataFrame:
    """The latest batch's count of every release and day."""
    rows = spark.read.parquet(facts)
    newest = Window.partitionBy(*KEY).orderBy(F.desc("batch"))
    return rows.withColumn("_at", F.row_number().over(newest)).where("_at = 1").select(*KEY, "n")
