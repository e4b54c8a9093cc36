"""Deterministic segments derived from table keys, for tables that hold no geometry.

Coordinates are integer-derived, so that every engine gets equal doubles. Tiles of 1500 keys keep
the density constant at any scale. Joins of segments are merged (the hint holds for what is derived
from them up to a join): Spark judges them by the size of the compressed keys that they are made from,
and would send whole tables of lines to the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import geometry as g

CLASSES = ("motorway", "primary", "secondary", "tertiary", "residential", "service", "footway", "cycleway")
SUFFIXES = ("St", "Street", "Ave", "Rd")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _base(k: Column) -> dict[str, Column]:
    tile = F.floor(k / 1500)
    x0 = (tile % 32) * 2000 + (k * 7919 % 20000) / 10.0
    y0 = F.floor(tile / 32) * 2000 + (k * 104729 % 20000) / 10.0
    dx, dy = (k * 37) % 41 - 20, (k * 53) % 41 - 20
    dx = F.when((dx == 0) & (dy == 0), 7).otherwise(dx)
    n = k % 5 + 1
    return {"x0": x0, "y0": y0, "x1": x0 + dx * n, "y1": y0 + dy * n}


def _line(k: Column, sx: Column, sy: Column) -> Column:
    b = _base(k)
    ends = [g.point(b["x0"] + sx, b["y0"] + sy), g.point(b["x1"] + sx, b["y1"] + sy)]
    mid = g.point((b["x0"] + b["x1"]) / 2 + sx + k % 5, (b["y0"] + b["y1"]) / 2 + sy - k % 3)
    return F.when(k % 4 == 0, F.array(ends[0], mid, ends[1])).otherwise(F.array(*ends))


def _pick(values: tuple[str, ...], i: Column) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), (i + 1).cast("int"))


def reference(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id, k, name, class, level, oneway, speed, xy: one segment per customer."""
    k = F.col("c_custkey")
    name = F.when(k % 7 == 0, None).when(k % 7 == 1, F.lit("")).otherwise(F.concat_ws(" ", F.initcap("c_mktsegment"), _pick(SUFFIXES, k % 4)))
    return table(spark, sf_dir, "customer").select(
        F.concat(F.lit("r"), k).alias("id"), k.alias("k"), name.alias("name"), _pick(CLASSES, k % 8).alias("class"),
        F.when(k % 11 == 0, 1).otherwise(0).alias("level"), _pick(("yes", "no", "-1", "F"), k % 4).alias("oneway"),
        F.when(k % 6 == 0, F.concat(F.lit(20 + 0), F.lit(" mph"))).when(k % 6 == 1, F.lit("none")).otherwise((k % 9 * 10 + 10).cast("string")).alias("speed"),
        _line(k, F.lit(0.0), F.lit(0.0)).alias("xy"),
    ).hint("merge")


def target(spark: SparkSession, sf_dir: str) -> DataFrame:
    """id, k, part, name, class, xy: every third customer shifted by a few metres, every fifteenth in two halves."""
    k = F.col("c_custkey")
    whole = _line(k, (k % 7 - 3).cast("double"), (k % 5 - 2).cast("double"))
    name = F.when(k % 9 == 0, None).when(k % 9 == 3, F.lit("Harbour Road")).otherwise(F.concat_ws(" ", F.initcap("c_mktsegment"), F.when(k % 2 == 0, "Street").otherwise(_pick(SUFFIXES, k % 4))))
    rows = table(spark, sf_dir, "customer").filter(k % 3 == 0).select(k.alias("k"), name.alias("name"), _pick(CLASSES, (k + F.when(k % 10 == 0, 1).otherwise(0)) % 8).alias("class"), whole.alias("whole"))
    a, b = g.first(F.col("whole")), g.last(F.col("whole"))
    mid = g.point((a["x"] + b["x"]) / 2, (a["y"] + b["y"]) / 2)
    split = F.col("k") % 15 == 0
    parts = F.when(split, F.array(F.struct(F.lit("a").alias("part"), F.array(a, mid).alias("xy")), F.struct(F.lit("b").alias("part"), F.array(mid, b).alias("xy")))).otherwise(
        F.array(F.struct(F.lit("").alias("part"), F.col("whole").alias("xy")))
    )
    return rows.select("k", "name", "class", F.inline(parts)).select(F.concat(F.lit("t"), "k", "part").alias("id"), "k", "part", "name", "class", "xy").hint("merge")


#: The same two tables as DuckDB CTEs.
SQL = """
base AS (SELECT c_custkey AS k, c_mktsegment AS seg,
  (c_custkey // 1500 % 32) * 2000 + (c_custkey * 7919 % 20000) / 10.0 AS x0,
  (c_custkey // 1500 // 32) * 2000 + (c_custkey * 104729 % 20000) / 10.0 AS y0,
  CASE WHEN (c_custkey * 37) % 41 = 20 AND (c_custkey * 53) % 41 = 20 THEN 7 ELSE (c_custkey * 37) % 41 - 20 END * (c_custkey % 5 + 1) AS dx,
  ((c_custkey * 53) % 41 - 20) * (c_custkey % 5 + 1) AS dy FROM customer),
titled AS (SELECT *, upper(seg[1]) || lower(seg[2:]) AS title, ['St', 'Street', 'Ave', 'Rd'] AS suf,
  ['motorway', 'primary', 'secondary', 'tertiary', 'residential', 'service', 'footway', 'cycleway'] AS cls,
  CASE WHEN k % 4 = 0 THEN [{'x': x0::DOUBLE, 'y': y0::DOUBLE}, {'x': ((x0 + (x0 + dx)) / 2 + k % 5)::DOUBLE, 'y': ((y0 + (y0 + dy)) / 2 - k % 3)::DOUBLE}, {'x': (x0 + dx)::DOUBLE, 'y': (y0 + dy)::DOUBLE}]
  ELSE [{'x': x0::DOUBLE, 'y': y0::DOUBLE}, {'x': (x0 + dx)::DOUBLE, 'y': (y0 + dy)::DOUBLE}] END AS xy FROM base),
ref AS (SELECT 'r' || k AS id, k, CASE WHEN k % 7 = 0 THEN NULL WHEN k % 7 = 1 THEN '' ELSE title || ' ' || suf[k % 4 + 1] END AS name, cls[k % 8 + 1] AS class,
  CASE WHEN k % 11 = 0 THEN 1 ELSE 0 END AS level, ['yes', 'no', '-1', 'F'][k % 4 + 1] AS oneway,
  CASE WHEN k % 6 = 0 THEN '20 mph' WHEN k % 6 = 1 THEN 'none' ELSE (k % 9 * 10 + 10)::VARCHAR END AS speed, xy FROM titled),
moved AS (SELECT k, CASE WHEN k % 9 = 0 THEN NULL WHEN k % 9 = 3 THEN 'Harbour Road' ELSE title || ' ' || CASE WHEN k % 2 = 0 THEN 'Street' ELSE suf[k % 4 + 1] END END AS name,
  cls[(k + CASE WHEN k % 10 = 0 THEN 1 ELSE 0 END) % 8 + 1] AS class,
  list_transform(xy, lambda p: {'x': p.x + (k % 7 - 3), 'y': p.y + (k % 5 - 2)}) AS w FROM titled WHERE k % 3 = 0),
halves AS (SELECT *, {'x': (w[1].x + w[-1].x) / 2, 'y': (w[1].y + w[-1].y) / 2} AS m FROM moved),
tgt AS (SELECT 't' || k AS id, k, '' AS part, name, class, w AS xy FROM halves WHERE k % 15 <> 0
  UNION ALL SELECT 't' || k || 'a', k, 'a', name, class, [w[1], m] FROM halves WHERE k % 15 = 0
  UNION ALL SELECT 't' || k || 'b', k, 'b', name, class, [m, w[-1]] FROM halves WHERE k % 15 = 0)"""


def bridge(spark: SparkSession, sf_dir: str) -> DataFrame:
    """local_id, gers_id, confidence, decision, start_frac, end_frac, k: closed-form confidences."""
    k, part = F.col("k"), F.col("part")
    conf = F.round(((k * 37 + F.when(part == "b", 11).otherwise(0)) % 101) / 100.0, 2)
    out = target(spark, sf_dir).select(
        F.col("id").alias("local_id"), F.concat(F.lit("r"), k).alias("gers_id"), conf.alias("confidence"),
        F.when(part == "b", 0.5).otherwise(0.0).alias("start_frac"), F.when(part == "a", 0.5).otherwise(1.0).alias("end_frac"), "k",
    )
    return out.withColumn("decision", F.when(F.col("confidence") >= 0.5, "match").when(F.col("confidence") >= 0.1, "review").otherwise("no_match"))


def truth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """gers_id, local_id, label of every second key."""
    k = F.col("k")
    label = F.when(k % 7 == 0, "no_match").when(k % 11 == 0, "unsure").otherwise("match")
    return bridge(spark, sf_dir).filter(k % 2 == 0).select("gers_id", "local_id", label.alias("label"))


def votes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """vote_id, group_id, seat, choice, conf, ts from the events table."""
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("vote_id"), (F.col("event_id") % 400).alias("group_id"), (F.col("user_id") % 5).alias("seat"), F.col("event_type").alias("choice"), F.col("value").alias("conf"), "ts"
    )
