"""Queries that run as streams over what is there."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.sources.tables import table
from tidemark.streaming import audit


def _windows(spark, folder):
    events = table(spark, folder, "events")
    # a pattern: a plain path would have to be a folder
    stream = audit.files(spark, f"{folder}/events.parque[t]", events.schema).withColumn("ts", F.col("ts").cast("timestamp"))
    counts = audit.windowed_counts(stream, "ts", "1 day", "event_type")
    return audit.completed(counts, spark).select(F.date_format("window_start", "yyyy-MM-dd").alias("day"), "event_type", "n")


QUERIES = {"st_event_windows": _windows}
SQL = {"st_event_windows": "select strftime(ts, '%Y-%m-%d') as day, event_type, count(*) as n from events group by all"}
