"""The same checks and counts on streams: windowed counts with late rows, first deliveries, audits per micro-batch.

The reference has no streams; these let a release be audited as its rows arrive. Operators of the package are DataFrame functions, so a
micro-batch goes through them unchanged.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.sources.workspace import Workspace


def files(spark: SparkSession, path: str, schema: StructType, most_files: int = 100) -> DataFrame:
    """A stream of the Parquet files that arrive at ``path``, so many a trigger."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", most_files).parquet(path)


def windowed_counts(stream: DataFrame, time: str, width: str, *by: str, late: str = "1 hour") -> DataFrame:
    """(window_start, by..., n, total) per tumbling window; state older than ``late`` behind the newest row is dropped."""
    return stream.withWatermark(time, late).groupBy(F.window(time, width).alias("w"), *by).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("window_start"), *by, "n")


def first_deliveries(stream: DataFrame, key: str, time: str, late: str = "1 hour") -> DataFrame:
    """Each key once within ``late``: repeated deliveries are dropped with bounded state."""
    return stream.withWatermark(time, late).dropDuplicatesWithinWatermark([key])


def audited(stream: DataFrame, checks: Callable[[DataFrame], DataFrame], target: str, checkpoint: str):
    """Run ``checks`` over every micro-batch and append their rows with the batch number; exactly once by batch folder."""

    def one(batch: DataFrame, number: int) -> None:
        checks(batch).withColumn("batch", F.lit(number)).write.mode("overwrite").parquet(f"{target}/batch={number}")

    return stream.writeStream.foreachBatch(one).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def completed(counts: DataFrame, spark: SparkSession) -> DataFrame:
    """Run an aggregating stream over what is there and return its final result as a table in the shared folder."""
    work = Workspace(spark)
    path = f"{work.root}/stream"

    def one(batch: DataFrame, _: int) -> None:
        batch.write.mode("overwrite").parquet(path)

    counts.writeStream.outputMode("complete").foreachBatch(one).option("checkpointLocation", f"{work.root}/progress").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(counts.schema).parquet(path)
