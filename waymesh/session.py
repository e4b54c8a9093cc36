"""Session settings shared by the benchmark, the tests and local runs."""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(app: str = "waymesh", cpus: int | str = 8, **extra: str) -> SparkSession:
    """A local session; on a cluster the caller brings a session of its own."""
    conf = {
        "spark.sql.shuffle.partitions": str(cpus),
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.driver.memory": "12g",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
    } | extra
    spark = SparkSession.builder.master(f"local[{cpus}]").appName(app).config(map=conf).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
