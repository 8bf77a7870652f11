"""Queries that run streams over the events table until it is drained."""

from __future__ import annotations

from pyspark.sql import functions as F

from runloom.plans.registry import query
from runloom.session import load
from runloom.streaming import observer as O


def _events(spark, sf_dir):
    schema = load(spark, sf_dir, "events").schema
    return O.event_stream(spark, f"{sf_dir}/events.parquet*", schema).withColumn("ts", F.col("ts").cast("timestamp"))


@query("select date_trunc('day', ts)::timestamp as start, event_type, count(*)::bigint as n from events group by all")
def stream_daily_counts(spark, sf_dir):
    """Daily counts of each type, as the complete state of the stream."""
    rows = O.drain(O.windowed_counts(_events(spark, sf_dir), "ts", "event_type"), "complete")
    last = rows.agg(F.max("batch").alias("m"))
    return rows.join(F.broadcast(last), F.col("batch") == F.col("m")).select(F.col("start").cast("timestamp_ntz").alias("start"), "event_type", "n")  # one row


@query("select event_type, count(*)::bigint as n, min(event_id) as first_id from events where value > 10 group by event_type")
def stream_filtered_events(spark, sf_dir):
    """Events that pass a filter, appended by a stream and counted in batch."""
    rows = O.drain(_events(spark, sf_dir).filter("value > 10").select("event_id", "event_type"))
    return rows.groupBy("event_type").agg(F.count("*").alias("n"), F.min("event_id").alias("first_id"))


@query("select user_id, (count(*) filter (where event_type = 'click') - count(*) filter (where event_type = 'purchase'))::bigint as pending from events group by user_id")
def stream_pending_calls(spark, sf_dir):
    """Open calls of each user, from state kept by the stream."""
    rows = O.drain(O.pending_calls(_events(spark, sf_dir), "user_id"), "update")
    return rows.groupBy("user_id").agg(F.max_by("pending", "batch").alias("pending"))
