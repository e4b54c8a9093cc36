"""Normalisation, names, classes, ranges and other scalar expressions."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import ranges
from ..functions import text as tx
from ..operators import matching
from ..sources import synthetic as s
from . import sqltext as q
from .registry import query

W = lambda body, *more: q.with_tables(body, q.BRIDGE, *more)
R, T = s.reference, s.target
NAMES = "n AS (SELECT b.local_id, r.name AS ref_name, t.name AS target_name, r.class AS ref_class, t.class AS target_class FROM bridge b JOIN ref r ON r.id = b.gers_id JOIN tgt t ON t.id = b.local_id)"


def names(spark, d):
    from ..operators import bridges

    return bridges.with_sides(s.bridge(spark, d), R(spark, d), T(spark, d))


@query("q048_value_mapping", "SELECT o_orderkey, CASE lower(trim(o_orderstatus)) WHEN 'f' THEN 'filled' WHEN 'o' THEN 'open' ELSE 'other' END AS status FROM orders")
def value_mapping(spark, d):
    m = F.create_map(F.lit("f"), F.lit("filled"), F.lit("o"), F.lit("open"))
    return s.table(spark, d, "orders").select("o_orderkey", F.coalesce(m[F.lower(F.trim("o_orderstatus"))], F.lit("other")).alias("status"))


@query("q049_default_class", q.with_tables("SELECT id, CASE WHEN class = 'footway' THEN 'sidewalk' WHEN class = 'cycleway' THEN 'bike' WHEN class = 'service' THEN 'trail' ELSE 'road' END AS layer FROM ref"))
def default_class(spark, d):
    c = F.col("class")
    return R(spark, d).select("id", F.when(c == "footway", "sidewalk").when(c == "cycleway", "bike").when(c == "service", "trail").otherwise("road").alias("layer"))


@query("q050_oneway_normalise", q.with_tables("SELECT id, CASE WHEN lower(trim(oneway)) IN ('yes', 'true', '1', 'f', 'ft') THEN 'forward' WHEN lower(trim(oneway)) IN ('-1', 'tf', 't', 'reverse') THEN 'backward' ELSE 'both' END AS direction FROM ref"))
def oneway_normalise(spark, d):
    v = F.lower(F.trim("oneway"))
    return R(spark, d).select("id", F.when(v.isin("yes", "true", "1", "f", "ft"), "forward").when(v.isin("-1", "tf", "t", "reverse"), "backward").otherwise("both").alias("direction"))


@query("q051_speed_normalise", q.with_tables("SELECT id, round(TRY_CAST(nullif(regexp_extract(speed, '(\\d+)', 1), '') AS DOUBLE) * CASE WHEN speed LIKE '%mph%' THEN 1.60934 ELSE 1.0 END, 4) AS kph FROM ref"))
def speed_normalise(spark, d):
    n = F.regexp_extract("speed", r"(\d+)", 1).try_cast("double")
    return R(spark, d).select("id", F.round(n * F.when(F.col("speed").contains("mph"), 1.60934).otherwise(1.0), 4).alias("kph"))


@query("q052_truthy", q.with_tables("SELECT id, lower(trim(oneway)) IN ('yes', 'true', '1', 't', 'y') AS truthy FROM ref"))
def truthy(spark, d):
    return R(spark, d).select("id", F.lower(F.trim("oneway")).isin("yes", "true", "1", "t", "y").alias("truthy"))


@query("q053_names_struct", "SELECT c_custkey, c_mktsegment AS display, CASE WHEN c_custkey % 2 = 0 THEN 2 ELSE 1 END AS n_common FROM customer")
def names_struct(spark, d):
    pairs = F.filter(F.array(F.struct(F.lit("en").alias("k"), F.col("c_mktsegment").alias("v")), F.struct(F.lit("xx").alias("k"), F.when(F.col("c_custkey") % 2 == 0, F.col("c_name")).alias("v"))), lambda p: p["v"].isNotNull())
    n = F.struct(F.col("c_name").alias("primary"), F.map_from_entries(pairs).alias("common"))
    return s.table(spark, d, "customer").withColumn("names", n).select("c_custkey", F.coalesce(F.col("names.common")["en"], F.col("names.primary")).alias("display"), F.size("names.common").alias("n_common"))


@query("q054_class_rules", "SELECT p_partkey, CASE WHEN p_size >= 40 THEN 'major' WHEN p_retailprice < 950 THEN 'minor' WHEN p_brand = 'Brand#1' THEN 'local' ELSE 'other' END AS class FROM part")
def class_rules(spark, d):
    rules = [("p_size", ">=", "40", "major"), ("p_retailprice", "<", "950", "minor"), ("p_brand", "==", "Brand#1", "local")]
    from ..operators.labels import class_by_rules

    return s.table(spark, d, "part").select("p_partkey", class_by_rules(rules, "other").alias("class"))


@query("q062_flag_rules", q.with_tables("SELECT id, level = 1 AS is_bridge, level AS level_value FROM ref"))
def flag_rules(spark, d):
    rules = F.filter(F.array(F.when(F.col("level") == 1, F.struct(F.array(F.lit("is_bridge")).alias("values"), F.col("level").alias("value")))), lambda r: r.isNotNull())
    return R(spark, d).withColumn("rules", rules).select("id", F.exists("rules", lambda r: F.array_contains(r["values"], "is_bridge")).alias("is_bridge"), F.coalesce(F.get("rules", F.lit(0))["value"], F.lit(0)).alias("level_value"))


SIM = {"motorway": (0, 1), "primary": (1, 3), "secondary": (1, 4), "tertiary": (2, 5), "residential": (2, 6), "service": (3, 7), "footway": (4, 9), "cycleway": (4, 10)}
RANK = "CASE {} " + " ".join(f"WHEN '{c}' THEN {r}" for c, (_, r) in SIM.items()) + " END"


@query("q181_class_similarity", W(f"SELECT local_id, CASE WHEN ref_class = target_class THEN 1.0 ELSE greatest(0.0, round(1 - 0.2 * abs({RANK.format('ref_class')} - {RANK.format('target_class')}), 6)) END::DOUBLE AS similarity, abs({RANK.format('ref_class')} - {RANK.format('target_class')}) <= 2 AS lenient FROM n", NAMES))
def class_similarity(spark, d):
    step = F.abs(F.expr(RANK.format("ref_class")) - F.expr(RANK.format("target_class")))
    return names(spark, d).select("local_id", F.when(F.col("ref_class") == F.col("target_class"), 1.0).otherwise(F.greatest(F.lit(0.0), F.round(1 - 0.2 * step, 6))).alias("similarity"), (step <= 2).alias("lenient"))


NORM = "trim(regexp_replace({}, '\\s+', ' ', 'g'))"


def norm_sql(c: str) -> str:
    e = f"regexp_replace(regexp_replace(regexp_replace(lower(trim({c})), '[.,]', '', 'g'), '-', ' ', 'g'), '^st ', 'saint ')"
    for word, short in tx.ABBREVIATIONS:
        e = f"regexp_replace({e}, '\\b{word}\\b', '{short}', 'g')"
    return NORM.format(e)


@query("q197_name_normalise", q.with_tables(f"SELECT id, {norm_sql('name')} AS name FROM ref"))
def name_normalise(spark, d):
    return R(spark, d).select("id", tx.normalise(F.col("name")).alias("name"))


def compared(spark, d):
    n = names(spark, d).filter((tx.present(F.col("ref_name")) == 1) & (tx.present(F.col("target_name")) == 1))
    return n.select("local_id", tx.normalise(F.col("ref_name")).alias("a"), tx.normalise(F.col("target_name")).alias("b"))


@query("q198_indel_ratio")
def indel_ratio(spark, d):
    return compared(spark, d).select("local_id", F.round(tx.indel_ratio("a", "b"), 6).alias("ratio"))


@query("q199_jaro_winkler", W(f"SELECT local_id, round(jaro_winkler_similarity({norm_sql('ref_name')}, {norm_sql('target_name')}), 6) AS similarity FROM n WHERE trim(coalesce(ref_name, '')) <> '' AND trim(coalesce(target_name, '')) <> ''", NAMES))
def jaro_winkler(spark, d):
    return compared(spark, d).select("local_id", F.round(tx.jaro_winkler_similarity("a", "b"), 6).alias("similarity"))


@query("q200_token_ratios")
def token_ratios(spark, d):
    return compared(spark, d).select("local_id", F.round(tx.token_sort_ratio("a", "b"), 6).alias("token_sort"), F.round(tx.token_set_ratio("a", "b"), 6).alias("token_set"), F.round(tx.partial_ratio("a", "b"), 6).alias("partial"))


@query("q202_phonetic_match")
def phonetic_match(spark, d):
    c = compared(spark, d)
    return c.select("local_id", (F.soundex(tx.longest_word(F.col("a"))) == F.soundex(tx.longest_word(F.col("b")))).alias("soundex_match"), F.round(tx.indel_ratio(tx.metaphone("a"), tx.metaphone("b")), 6).alias("metaphone_similarity"))


@query("q204_generic_name", q.with_tables(f"SELECT id, CASE WHEN regexp_matches(lower(trim(coalesce(name, ''))), '{tx.GENERIC}') THEN 1.0 ELSE 0.0 END::DOUBLE AS generic FROM ref"))
def generic_name(spark, d):
    return R(spark, d).select("id", tx.generic(F.col("name")).alias("generic"))


@query("q205_presence_flags", W("SELECT local_id, CASE WHEN trim(coalesce(ref_name, '')) <> '' THEN 1.0 ELSE 0.0 END::DOUBLE AS ref_present, CASE WHEN trim(coalesce(target_name, '')) <> '' THEN 1.0 ELSE 0.0 END::DOUBLE AS target_present FROM n", NAMES))
def presence_flags(spark, d):
    return names(spark, d).select("local_id", tx.present(F.col("ref_name")).alias("ref_present"), tx.present(F.col("target_name")).alias("target_present"))


@query("q206_cross_script")
def cross_script(spark, d):
    odd = F.when(F.col("k") % 10 == 0, "Ленина").otherwise(F.col("name"))
    return T(spark, d).withColumn("other", odd).select("id", tx.cross_script(F.col("name"), F.col("other")).alias("cross"))


@query("q207_numeric_suffix")
def numeric_suffix(spark, d):
    return s.table(spark, d, "customer").select("c_custkey", tx.numeric_suffix(F.col("c_name")).alias("suffix"))


ROUTE = "CASE WHEN c_custkey % 3 = 0 THEN 'I-' || (c_custkey % 99) WHEN c_custkey % 3 = 1 THEN 'US Highway ' || (c_custkey % 50) ELSE c_name END"


@query("q208_route_canonical", f"SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 'interstate ' || (c_custkey % 99) WHEN c_custkey % 3 = 1 THEN 'us ' || (c_custkey % 50) END AS route FROM customer WHERE length({ROUTE}) > 0")
def route_canonical(spark, d):
    k = F.col("c_custkey")
    name = F.when(k % 3 == 0, F.concat(F.lit("I-"), k % 99)).when(k % 3 == 1, F.concat(F.lit("US Highway "), k % 50)).otherwise(F.col("c_name"))
    return s.table(spark, d, "customer").select("c_custkey", tx.route_of(name).alias("route"))


@query("q215_logit", W("SELECT local_id, round(ln(p / (1 - p)), 6) AS logit, round(1 / (1 + exp(-ln(p / (1 - p)))), 6) AS back FROM (SELECT local_id, greatest(0.001, least(0.999, confidence)) AS p FROM bridge)"))
def logit(spark, d):
    p = F.greatest(F.lit(0.001), F.least(F.lit(0.999), F.col("confidence")))
    x = F.log(p / (1 - p))
    return s.bridge(spark, d).select("local_id", F.round(x, 6).alias("logit"), F.round(1 / (1 + F.exp(-x)), 6).alias("back"))


KNOTS = ((0.0, 0.02), (0.3, 0.2), (0.6, 0.7), (1.0, 0.98))


@query("q217_calibration", W("SELECT local_id, round(CASE WHEN confidence < 0.3 THEN 0.02 + confidence / 0.3 * 0.18 WHEN confidence < 0.6 THEN 0.2 + (confidence - 0.3) / 0.3 * 0.5 ELSE 0.7 + (confidence - 0.6) / 0.4 * 0.28 END, 6) AS calibrated FROM bridge"))
def calibration(spark, d):
    from ..operators.labels import interpolated

    return s.bridge(spark, d).select("local_id", F.round(interpolated(F.col("confidence"), KNOTS), 6).alias("calibrated"))


@query("q218_group_hash", W("SELECT k % 20 AS g, substr(sha256(string_agg(DISTINCT gers_id, '|' ORDER BY gers_id) || '||' || string_agg(DISTINCT local_id, '|' ORDER BY local_id)), 1, 8) AS group_id FROM bridge GROUP BY 1"))
def group_hash(spark, d):
    b = s.bridge(spark, d).groupBy((F.col("k") % 20).alias("g")).agg(F.collect_set("gers_id").alias("r"), F.collect_set("local_id").alias("t"))
    return b.select("g", matching.group_hash(F.col("r"), F.col("t")).alias("group_id"))


@query("q219_edge_hash", W("SELECT k % 20 AS g, substr(sha256(string_agg(gers_id || '>' || local_id, ',' ORDER BY gers_id, local_id)), 1, 12) AS h FROM bridge GROUP BY 1"))
def edge_hash(spark, d):
    b = s.bridge(spark, d).groupBy((F.col("k") % 20).alias("g")).agg(F.array_sort(F.collect_list(F.struct("gers_id", "local_id"))).alias("e"))
    return b.select("g", F.substring(F.sha2(F.array_join(F.transform("e", lambda e: F.concat(e["gers_id"], F.lit(">"), e["local_id"])), ","), 256), 1, 12).alias("h"))


RULES = "array(struct(0.0D AS start, 0.6D AS end, 'paved' AS value, 2 AS priority), struct(CAST(k % 5 / 10.0 AS DOUBLE) AS start, 0.8D AS end, 'gravel' AS value, 1 AS priority))"
CUT = "(k % 5 / 10.0)"


@query("q222_range_normalise", W(f"SELECT id, 1 + CASE WHEN {CUT} > 0 THEN 1 ELSE 0 END + 1 AS n_ranges, round(0.8 - {CUT}, 6)::DOUBLE AS gravel FROM tgt"))
def range_normalise(spark, d):
    out = ranges.normalise(F.expr(RULES), F.lit("unknown"))
    gravel = F.aggregate(F.filter("lr", lambda r: r["value"] == "gravel"), F.lit(0.0), lambda a, r: a + r["end"] - r["start"])
    return T(spark, d).withColumn("lr", out).select("id", F.size("lr").alias("n_ranges"), F.round(gravel, 6).alias("gravel"))


@query("q223_range_majority", W(f"SELECT id, CASE WHEN {CUT} >= 0.4 THEN 'paved' ELSE 'gravel' END AS surface FROM tgt"))
def range_majority(spark, d):
    lr = ranges.normalise(F.expr(RULES), F.lit("unknown"))
    return T(spark, d).select("id", ranges.majority(lr, F.lit(0.0), F.lit(0.8)).alias("surface"))


@query("q224_range_lookup", W(f"SELECT id, CASE WHEN {CUT} <= 0.25 THEN 'gravel' ELSE 'paved' END AS surface FROM tgt"))
def range_lookup(spark, d):
    return T(spark, d).select("id", ranges.value_at(ranges.normalise(F.expr(RULES), F.lit("unknown")), F.lit(0.25)).alias("surface"))


@query("q226_range_clip", W(f"SELECT id, 'gravel:' || CASE WHEN {CUT} > 0.3 THEN '0.4' ELSE '0.3' END || '-0.5' AS summary FROM tgt WHERE {CUT} <= 0.3"))
def range_clip(spark, d):
    lr = ranges.clip(ranges.normalise(F.expr(RULES), F.lit("unknown")), F.lit(0.3), F.lit(0.5))
    text = F.array_join(F.transform(lr, lambda r: F.concat(r["value"], F.lit(":"), r["start"].cast("string"), F.lit("-"), r["end"].cast("string"))), ";")
    return T(spark, d).filter("k % 5 <= 3").select("id", text.alias("summary"))


@query("q227_json", "SELECT event_id, TRY_CAST(json_extract_string(props, '$.k') AS VARCHAR) AS k FROM events")
def json_fields(spark, d):
    return s.table(spark, d, "events").select("event_id", F.get_json_object("props", "$.k").alias("k"))


@query("q231_travel_mode", q.with_tables("SELECT id, CASE class WHEN 'footway' THEN 'pedestrian' WHEN 'cycleway' THEN 'bicycle' ELSE 'vehicle' END AS mode FROM ref"))
def travel_mode(spark, d):
    m = F.create_map(F.lit("footway"), F.lit("pedestrian"), F.lit("cycleway"), F.lit("bicycle"))
    return R(spark, d).select("id", F.coalesce(m[F.col("class")], F.lit("vehicle")).alias("mode"))


@query("q230_dates", "SELECT event_id, strftime(ts, '%Y-%m-%dT%H:%M:%S') AS iso FROM events")
def dates(spark, d):
    return s.table(spark, d, "events").select("event_id", F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("iso"))


@query("q248_z_level", q.with_tables("SELECT id, CASE WHEN level <> 0 THEN level WHEN class = 'motorway' THEN 1 WHEN class = 'footway' THEN -1 ELSE 0 END AS z FROM ref"))
def z_level(spark, d):
    return R(spark, d).select("id", F.when(F.col("level") != 0, F.col("level")).when(F.col("class") == "motorway", 1).when(F.col("class") == "footway", -1).otherwise(0).alias("z"))


@query("q310_subsegment_flag", W("SELECT local_id, NOT (start_frac <= 0.01 AND end_frac >= 0.99) AS is_subsegment FROM bridge"))
def subsegment_flag(spark, d):
    return s.bridge(spark, d).select("local_id", (~((F.col("start_frac") <= 0.01) & (F.col("end_frac") >= 0.99))).alias("is_subsegment"))
