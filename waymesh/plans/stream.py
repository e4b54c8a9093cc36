"""Structured Streaming queries over the events table, run over what is there."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..streaming import votes
from .registry import query


@query("stream_window_counts", "SELECT date_trunc('hour', ts) AS window_start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2")
def stream_window_counts(spark, d):
    out = votes.run_to_table(votes.windowed_counts(votes.events(spark, d), "1 hour"))
    return out.select(F.col("window_start").cast("timestamp_ntz").alias("window_start"), "event_type", "n", F.round("total", 4).alias("total"))


@query("stream_latest_ballots", "SELECT event_id % 400 AS group_id, user_id % 5 AS seat, arg_max(event_type, (ts, event_id)) AS choice FROM events GROUP BY 1, 2")
def stream_latest_ballots(spark, d):
    return votes.run_to_table(votes.latest_ballots(votes.events(spark, d)))
