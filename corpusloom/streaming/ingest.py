"""Runs as a stream: files that arrive are appended, counted by window, and merged batch by batch."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType


def read_files(spark: SparkSession, folder: str, schema: StructType, files_at_once: int = 50) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_at_once).parquet(folder)


def counts_by_window(stream: DataFrame, time: str, window: str = "7 days", late: str = "30 days", by: str = "source") -> DataFrame:
    """(start, by, n): records per window; those later than the watermark are dropped."""
    timed = stream.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, late)
    return timed.groupBy(F.window(time, window).alias("w"), by).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("start"), by, "n")


def append_new(stream: DataFrame, key: str, table: str, checkpoint: str) -> StreamingQuery:
    """Appends records whose key the table does not have; a batch that is run again changes nothing."""

    def merge(batch: DataFrame, number: int) -> None:
        from pyspark.errors import AnalysisException

        spark = batch.sparkSession
        fresh = batch.dropDuplicates([key])
        try:
            fresh = fresh.join(spark.read.parquet(table).where(F.col("_batch") != number).select(key), key, "left_anti")
        except AnalysisException:
            pass  # the first batch
        fresh.withColumn("_batch", F.lit(number)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("_batch").parquet(table)

    return stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
