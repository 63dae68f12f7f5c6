"""Incremental weekly counts over a stream of events, with late data bounded by a watermark."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from hemicycle.sources.sinks import save


def weekly_counts(events: DataFrame, late: str = "2 days") -> DataFrame:
    """(week_start, event_type, events): tumbling weeks from Monday."""
    ts = F.col("ts").cast("timestamp")
    return (
        events.select(ts.alias("ts"), "event_type")
        .withWatermark("ts", late)
        .groupBy(F.window("ts", "7 days", startTime="4 days").alias("w"), "event_type")
        .agg(F.count("*").alias("events"))
        .select(F.col("w.start").alias("week_start"), "event_type", "events")
    )


def upsert_stream(counts: DataFrame, path: str, checkpoint: str):
    """Keep the table at ``path`` up to date; a replayed batch gives the same rows."""

    def batch(df: DataFrame, _: int) -> None:
        save(df.withColumn("key", F.concat_ws("|", F.col("week_start").cast("string"), "event_type")), path, "key")

    return counts.writeStream.outputMode("update").option("checkpointLocation", checkpoint).foreachBatch(batch).trigger(availableNow=True).start()
