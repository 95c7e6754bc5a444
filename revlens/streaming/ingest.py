"""Incremental review ingestion: a file stream of review rows upserted into an append-only table.

Late and changed rows are upserted, never dropped, so no watermark is set. Each micro-batch appends the rows that are new
or changed under its own batch id; a replayed batch overwrites its own folder. The current view is the latest row per key.
Of the history, a micro-batch only takes the rows of its own keys (a semi-join, with the keys broadcast where they are few);
nothing else of it is shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.state import change_kind, latest

KEYS = ["appid", "recommendationid"]
SCHEMA = "appid long, recommendationid string, language string, voted_up boolean, votes_up long, review_text string, timestamp_created long, timestamp_updated long, source_hash string"


def history(spark: SparkSession, table: str) -> DataFrame:
    return spark.read.schema(SCHEMA + ", kind string, first_seen_at long, batch long").parquet(table)


def current(spark: SparkSession, table: str) -> DataFrame:
    return latest(history(spark, table), KEYS, F.desc("timestamp_updated"), F.desc("batch"))


def upsert_batch(table: str):
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows = latest(batch, KEYS, F.desc("timestamp_updated"), F.desc("source_hash"))
        try:
            known = history(spark, table).filter(F.col("batch") != batch_id).join(batch.select(*KEYS).distinct(), KEYS, "left_semi")
            stored = latest(known, KEYS, F.desc("timestamp_updated"), F.desc("batch")).select(*KEYS, F.col("source_hash").alias("_stored"), "first_seen_at")
            rows = rows.join(stored, KEYS, "left")
        except Exception as e:  # noqa: BLE001  the table does not exist before the first batch
            if "PATH_NOT_FOUND" not in str(e):
                raise
            rows = rows.withColumn("_stored", F.lit(None).cast("string")).withColumn("first_seen_at", F.lit(None).cast("long"))
        rows = rows.withColumn("kind", change_kind(F.col("_stored"), F.col("source_hash"))).filter("kind <> 'unchanged'")
        rows = rows.withColumn("first_seen_at", F.coalesce("first_seen_at", "timestamp_updated"))
        rows.drop("_stored").write.mode("overwrite").parquet(f"{table}/batch={batch_id}")

    return write


def ingest(spark: SparkSession, source: str, table: str, checkpoint: str):
    """Process all files there are, then stop; run again to resume behind the last checkpoint."""
    rows = spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", 1).json(source)
    return rows.writeStream.foreachBatch(upsert_batch(table)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
