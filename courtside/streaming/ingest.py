"""Stints from a folder of possession statistics by Structured Streaming.

The checkpoint is the set of processed files. Each micro-batch runs the batch transform and appends to a table partitioned
by season and season type; a batch that is run again after a failure replaces what it wrote, by its id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from courtside.operators.possessions import matchup_sums, sound_and_failed
from courtside.schema import STAT_ROWS

SCOPE = ["season", "season_type"]
SCOPED = T.StructType([*STAT_ROWS.fields, *[T.StructField(c, T.StringType()) for c in SCOPE]])


def ingest_stream(spark: SparkSession, source: str, target: str, checkpoint: str, files_per_batch: int = 1000) -> StreamingQuery:
    """Run over all files that are new in source (Parquet, SCOPED), then stop. Whole games must arrive in one file."""
    stats = spark.readStream.schema(SCOPED).option("maxFilesPerTrigger", files_per_batch).parquet(source)

    def write(batch: DataFrame, batch_id: int) -> None:
        # the files are read once: only the sums of matchups, few beside the rows, are stored for the two tables
        sums = matchup_sums(batch, SCOPE).persist()
        stints, failed = sound_and_failed(sums)
        own = batch.sparkSession.conf
        own.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
        stints.withColumn("batch", F.lit(batch_id)).write.mode("overwrite").partitionBy(*SCOPE, "batch").parquet(f"{target}/stints")
        failed.withColumn("batch", F.lit(batch_id)).write.mode("overwrite").partitionBy("batch").parquet(f"{target}/failed")
        sums.unpersist()

    return stats.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
