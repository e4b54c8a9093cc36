"""Scans and sinks of label stores, group documents and segment files. Schemas are explicit; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

LABELS = "gers_id string, target_id string, label string, labeler string, labeled_at timestamp, session_id string"
EDGES = "array<struct<ref_id:string,target_id:string>>"
GROUPS = f"groups array<struct<group_id:string,edges:{EDGES}>>"


def labels_csv(spark: SparkSession, root: str) -> DataFrame:
    """CSV partitions `dataset=*/data.csv`, with the partition column; filters on dataset prune folders."""
    return spark.read.schema(LABELS + ", dataset string").option("header", True).option("basePath", root).csv(root)


def write_labels_csv(labels: DataFrame, root: str) -> None:
    """Overwrites the partitions that are in labels, and no others."""
    labels.write.partitionBy("dataset").mode("overwrite").option("partitionOverwriteMode", "dynamic").option("header", True).csv(root)


def partitions(spark: SparkSession, root: str) -> DataFrame:
    """All `dataset=` Parquet partitions, in canonical order within."""
    return spark.read.option("basePath", root).parquet(root)


def stitch_labels(rows: DataFrame) -> DataFrame:
    """selected_edges parsed from JSON; malformed text gives no edges."""
    return rows.withColumn("edges", F.coalesce(F.from_json("selected_edges", EDGES), F.array().cast(EDGES)))


def groups_json(spark: SparkSession, path: str) -> DataFrame:
    """One row per group of a nested groups document."""
    return spark.read.schema(GROUPS).option("multiLine", True).json(path).select(F.inline("groups"))


def write_groups_json(groups: DataFrame, path: str) -> None:
    groups.write.mode("overwrite").json(path)


def tsv_geojson(spark: SparkSession, path: str, country: str) -> DataFrame:
    """id, xy from tab-separated country, id and a GeoJSON LineString; other types go."""
    raw = spark.read.schema("country string, id string, geometry string").option("sep", "\t").option("quote", "").csv(path)
    shape = F.from_json("geometry", "type string, coordinates array<array<double>>")
    kept = raw.filter(F.col("country") == country).withColumn("g", shape).filter("g.type = 'LineString' AND size(g.coordinates) > 1")
    return kept.select("id", F.transform("g.coordinates", lambda c: F.struct(F.get(c, F.lit(0)).alias("x"), F.get(c, F.lit(1)).alias("y"))).alias("xy"))


def wkb_lines(rows: DataFrame, column: str = "geometry") -> DataFrame:
    """rows with xy decoded from little-endian WKB LineStrings, in SQL; null and other types go."""
    h = F.hex(column)

    def number(at: Column) -> Column:
        # eight bytes, least first, as an IEEE double
        bits = [F.conv(F.substr(h, at + 2 * i, F.lit(2)), 16, 10).cast("long") for i in range(8)]
        high = bits[7] * 16 + F.floor(bits[6] / 16)
        exponent = high % 2048
        fraction = F.lit(0.0)
        for i, b in enumerate((bits[6] % 16, *bits[5::-1])):
            fraction = fraction + b / F.lit(2.0 ** (4 + 8 * i))
        value = F.when(exponent == 0, fraction * F.lit(2.0**-1022)).otherwise((1 + fraction) * F.pow(F.lit(2.0), (exponent - 1023).cast("double")))
        return F.when(high >= 2048, -value).otherwise(value)

    n = F.conv(F.concat(*[F.substr(h, F.lit(17 - 2 * i), F.lit(2)) for i in range(4)]), 16, 10).cast("int")
    xy = F.transform(F.sequence(F.lit(0), n - 1), lambda i: F.struct(number(F.lit(19) + 32 * i).alias("x"), number(F.lit(35) + 32 * i).alias("y")))
    return rows.filter(F.substring(h, 1, 10) == "0102000000").withColumn("xy", xy)


def scored_cache(df: DataFrame | None, spark: SparkSession, path: str) -> DataFrame:
    """Write scored pairs if given, and read them: assignment can run again without scoring."""
    if df is not None:
        df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def bridge_sink(rows: DataFrame, path: str, floor: float = 0.0) -> None:
    """The fixed bridge schema as Parquet; an empty result still writes it."""
    fixed = [
        ("local_id", "string"), ("gers_id", "string"), ("confidence", "double"), ("match_type", "string"), ("match_method", "string"), ("match_decision", "string"),
        ("gers_start_frac", "double"), ("gers_end_frac", "double"), ("local_start_frac", "double"), ("local_end_frac", "double"),
    ]
    kept = rows.filter((F.col("match_decision") != "no_match") & (F.col("confidence") >= floor))
    kept.select(*[F.col(c).cast(t) for c, t in fixed]).write.mode("overwrite").parquet(path)


def resolve_column(df: DataFrame, name: str | None) -> str | None:
    """The column of df that a configured name means: the same, else the only one that differs in case; None if there is none."""
    if name is None or name in df.columns:
        return name
    alike = [c for c in df.columns if c.lower() == name.lower()]
    return alike[0] if len(alike) == 1 else None


def connectors(points: DataFrame, box: tuple[float, float, float, float]) -> DataFrame:
    """Connector rows (id, x, y, ...) in a box (x0, y0, x1, y1), by plain comparisons that reach the scan."""
    x0, y0, x1, y1 = box
    return points.filter(F.col("x").between(x0, x1) & F.col("y").between(y0, y1))


def lines_only(rows: DataFrame, kind: str = "kind", parts: str = "parts") -> DataFrame:
    """rows with xy: lines and multi-part lines as one line each; other kinds, nulls and lines of a point go."""
    from ..functions import geometry as g

    wanted = rows.filter(F.col(kind).isin("LineString", "MultiLineString"))
    return wanted.withColumn("xy", g.merged_parts(F.col(parts))).filter(F.size("xy") > 1).drop(parts)


def local_lines(spark: SparkSession, path: str, columns: dict[str, str | None], defaults: dict[str, str] | None = None) -> DataFrame:
    """A Parquet, JSON or CSV file under the common names: columns maps id, name, class and the like to a column, in any case.

    Columns that the file lacks are null, or the default given; keys are read as text.
    """
    suffix = path.rstrip("/").rsplit(".", 1)[-1].lower()
    reader = {"parquet": spark.read.parquet, "json": spark.read.json, "csv": spark.read.option("header", True).csv}.get(suffix)
    if reader is None:
        raise ValueError(f"no reader for .{suffix}")
    df = reader(path)
    out = []
    for name, source in columns.items():
        c = resolve_column(df, source)
        value = F.col(f"`{c}`").cast("string") if c in df.columns else F.lit(None).cast("string")
        out.append(F.coalesce(value, F.lit((defaults or {}).get(name))).alias(name))
    return df.select(*out, *[F.col(c) for c in ("xy",) if c in df.columns])


def write_integration(result: dict[str, DataFrame], folder: str) -> DataFrame:
    """Each layer as Parquet under its name, and `stats` (layer, n) as JSON; returns stats."""
    stats = None
    for name, layer in result.items():
        layer.write.mode("overwrite").parquet(f"{folder}/{name}.parquet")
        one = layer.sparkSession.read.parquet(f"{folder}/{name}.parquet").agg(F.lit(name).alias("layer"), F.count("*").alias("n"))
        stats = one if stats is None else stats.unionByName(one)
    stats.write.mode("overwrite").json(f"{folder}/stats.json")
    return stats
