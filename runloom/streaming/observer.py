"""Structured Streaming over append-only event logs."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

from runloom.functions import text as T
from runloom.session import shared_dir
from runloom.sources.traces import _observer

#: Bounds on payloads at ingest: characters of a text.
MAX_TEXT = 20_000
CUT_MARK = "...[truncated]"


def event_stream(spark: SparkSession, path: str, schema) -> DataFrame:
    """Parquet files of a folder as a stream."""
    return spark.readStream.schema(schema).parquet(path)


def observer_stream(spark: SparkSession, path: str) -> DataFrame:
    """Observer lines of a growing folder as redacted events with their time; one row an event."""
    raw = spark.readStream.text(path).select(F.try_parse_json("value").alias("v")).filter("v is not null")
    e = raw.select(F.try_variant_get("v", "$.captured_at", "timestamp").alias("ts"), F.explode(_observer(F.col("v"))).alias("e")).select("ts", "e.*")
    # The whole text is redacted first: a secret that straddles the cut would no longer match.
    e = e.withColumn("text", T.redacted(F.col("text")))
    return e.withColumn("text", F.when(F.length("text") > MAX_TEXT, F.concat(F.substring("text", 1, MAX_TEXT), F.lit(CUT_MARK))).otherwise(F.col("text")))


def windowed_counts(events: DataFrame, at: str, kind: str, window: str = "1 day", late: str = "2 days", slide: str | None = None) -> DataFrame:
    """Counts by window and kind; rows later than the watermark are left out."""
    w = F.window(at, window, slide) if slide else F.window(at, window)
    return events.withWatermark(at, late).groupBy(w, kind).agg(F.count("*").alias("n")).select(F.col("window.start").alias("start"), kind, "n")


def session_counts(events: DataFrame, at: str, key: str, gap: str, late: str = "2 days") -> DataFrame:
    """Sessions of a key that end after a gap without events."""
    grouped = events.withWatermark(at, late).groupBy(F.session_window(at, gap), key).agg(F.count("*").alias("n"))
    return grouped.select(F.col("session_window.start").alias("start"), F.col("session_window.end").alias("end"), key, "n")


def pending_calls(events: DataFrame, key: str) -> DataFrame:
    """Ordered state of each session: calls less results so far, one row a session and batch.

    The state is one number a session, so it is bounded by the number of sessions.
    """

    def run(name: tuple, batches: Iterator[pd.DataFrame], state) -> Iterator[pd.DataFrame]:
        open_ = state.get[0] if state.exists else 0
        for pdf in batches:
            open_ += int((pdf.event_type == "click").sum() - (pdf.event_type == "purchase").sum())
        state.update((open_,))
        yield pd.DataFrame({key: [name[0]], "pending": [open_]})

    return events.select(key, "event_type").groupBy(key).applyInPandasWithState(run, f"{key} long, pending long", "pending long", "update", "NoTimeout")


def drain(stream: DataFrame, mode: str = "append") -> DataFrame:
    """Run a stream over all that is there and return what it wrote, for checks and queries."""
    spark = stream.sparkSession
    base = f"{shared_dir(spark).rstrip('/')}/stream-{uuid.uuid4().hex}"
    out = f"{base}/out"

    def sink(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/batch={number}")

    writer = stream.writeStream.outputMode(mode).option("checkpointLocation", f"{base}/state").trigger(availableNow=True)
    writer.foreachBatch(sink).start().awaitTermination()
    return spark.read.schema(stream.schema.add("batch", "long")).option("basePath", out).parquet(out)
