"""Streams of votes and label events: latest ballot per seat, windowed counts with late data."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import matching


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as a stream."""
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir).withColumn("ts", F.col("ts").cast("timestamp"))


def windowed_counts(stream: DataFrame, late: str = "1 hour", size: str = "1 hour") -> DataFrame:
    """window_start, event_type, n, total; rows later than the watermark are dropped, as a stream must."""
    w = F.window("ts", size)
    return stream.withWatermark("ts", late).groupBy(w.alias("w"), "event_type").agg(F.count("*").alias("n"), F.sum("value").alias("total")).select(F.col("w.start").alias("window_start"), "event_type", "n", "total")


def latest_ballots(stream: DataFrame) -> DataFrame:
    """seat, group_id and the newest vote, in complete mode."""
    v = stream.select((F.col("event_id") % 400).alias("group_id"), (F.col("user_id") % 5).alias("seat"), F.struct("ts", "event_id", "event_type").alias("m"))
    return v.groupBy("group_id", "seat").agg(F.max("m").alias("m")).select("group_id", "seat", F.col("m.event_type").alias("choice"))


def run_to_table(df: DataFrame, mode: str = "complete") -> DataFrame:
    """Run a stream over what is there; its result as Parquet tables in the shared folder, one a batch.

    In complete mode the last batch holds everything, in append mode all batches do. Nothing goes to the driver.
    """
    at: list[DataFrame] = []

    def keep(batch: DataFrame, number: int) -> None:
        if mode == "complete":
            at.clear()
        at.append(matching.scratch(batch))

    df.writeStream.outputMode(mode).foreachBatch(keep).trigger(availableNow=True).start().awaitTermination()
    if not at:
        return df.sparkSession.createDataFrame([], df.schema)
    return reduce(DataFrame.unionByName, at)
