"""Fraction ranges: gaps and islands over rows, and linear-referenced arrays."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def merge(rows: DataFrame, key: str, start: str = "start", end: str = "end", tolerance: float = 0.01) -> DataFrame:
    """key, start, end of merged ranges; ranges closer than the tolerance join."""
    w = Window.partitionBy(key).orderBy(start, end)
    reach = F.max(end).over(w.rowsBetween(Window.unboundedPreceding, -1))
    fresh = F.when(F.col(start) <= reach + tolerance, 0).otherwise(1)
    island = F.sum("__new").over(w.rowsBetween(Window.unboundedPreceding, 0))
    marked = rows.select(key, start, end).filter(F.col(end) > F.col(start)).withColumn("__new", fresh).withColumn("__island", island)
    return marked.groupBy(key, "__island").agg(F.min(start).alias("start"), F.max(end).alias("end")).drop("__island")


def complement(islands: DataFrame, key: str) -> DataFrame:
    """key, start, end of the gaps of [0, 1] that merged ranges leave."""
    w = Window.partitionBy(key).orderBy("start")
    inner = islands.select(key, F.col("end").alias("s"), F.lead("start").over(w).alias("e"), F.lag("end").over(w).alias("before"), "start")
    first = inner.filter("before IS NULL").select(key, F.lit(0.0).alias("start"), F.col("start").alias("end"))
    rest = inner.select(key, F.col("s").alias("start"), F.coalesce("e", F.lit(1.0)).alias("end"))
    return first.unionAll(rest).filter("end > start + 1e-9")


def covered(islands: DataFrame, key: str) -> DataFrame:
    """key, covered: measure of the union."""
    return islands.groupBy(key).agg(F.sum(F.col("end") - F.col("start")).alias("covered"))


def clip(ranges: Column, lo: Column, hi: Column) -> Column:
    """Ranges ARRAY<STRUCT<start, end, value>> cut to a span; empty ones go."""
    cut = F.transform(ranges, lambda r: F.struct(F.greatest(r["start"], lo).alias("start"), F.least(r["end"], hi).alias("end"), r["value"].alias("value")))
    return F.filter(cut, lambda r: r["end"] > r["start"])


def value_at(ranges: Column, place: Column) -> Column:
    """The value of the first range that holds a place."""
    return F.get(F.filter(ranges, lambda r: (r["start"] <= place) & (place <= r["end"])), F.lit(0))["value"]


def majority(ranges: Column, lo: Column, hi: Column) -> Column:
    """The value that covers most of a span; the first in order wins ties."""
    parts = clip(ranges, lo, hi)
    values = F.array_distinct(F.transform(parts, lambda r: r["value"]))
    scored = F.transform(values, lambda v, i: F.struct(
        F.round(F.aggregate(F.filter(parts, lambda r: r["value"] == v), F.lit(0.0), lambda s, r: s + r["end"] - r["start"]), 9).alias("n"), (-i).alias("i"), v.alias("v")))
    return F.array_max(scored)["v"]


def normalise(rules: Column, default: Column) -> Column:
    """Rules ARRAY<STRUCT<start, end, value, priority>> as disjoint ranges of [0, 1]: least priority number wins, equal neighbours merge."""
    cuts = F.array_sort(F.array_distinct(F.concat(F.array(F.lit(0.0), F.lit(1.0)), F.flatten(F.transform(rules, lambda r: F.array(r["start"], r["end"]))))))
    n = F.size(cuts)
    spans = F.zip_with(F.slice(cuts, 1, n - 1), F.slice(cuts, 2, n - 1), lambda a, b: F.struct(a.alias("a"), b.alias("b")))

    def winner(s: Column) -> Column:
        live = F.filter(rules, lambda r: (r["start"] <= s["a"]) & (r["end"] >= s["b"]))
        best = F.array_min(F.transform(live, lambda r, i: F.struct(r["priority"].alias("p"), i.alias("i"), r["value"].alias("v"))))
        return F.struct(s["a"].alias("start"), s["b"].alias("end"), F.coalesce(best["v"], default).alias("value"))

    def join(done: Column, r: Column) -> Column:
        tail = F.get(done, F.size(done) - 1)
        same = (F.size(done) > 0) & tail["value"].eqNullSafe(r["value"])
        longer = F.concat(F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))), F.array(F.struct(tail["start"].alias("start"), r["end"].alias("end"), r["value"].alias("value"))))
        return F.when(same, longer).otherwise(F.concat(done, F.array(r)))

    empty = F.array().cast("array<struct<start:double,end:double,value:string>>")
    return F.aggregate(F.transform(spans, winner), empty, lambda d, r: F.when(F.size(d) == 0, F.array(r)).otherwise(join(d, r)))


RULE = "array<struct<start:double,end:double,value:string,priority:int>>"


def _scope(rule: Column) -> tuple[Column, Column]:
    """A rule's start and end; the whole segment where `between` is null or not of two numbers."""
    whole = ~F.coalesce(F.size(rule["between"]) == 2, F.lit(False))
    return F.when(whole, 0.0).otherwise(F.get(rule["between"], F.lit(0))), F.when(whole, 1.0).otherwise(F.get(rule["between"], F.lit(1)))


def parsed(rules: Column, value, rank, default: Column) -> Column:
    """Nested rules (with between ARRAY<DOUBLE>) as disjoint ranges; value and rank are functions of a rule and its place. Rules without a value go."""

    def one(r: Column, i: Column) -> Column:
        lo, hi = _scope(r)
        return F.struct(lo.alias("start"), hi.alias("end"), value(r).cast("string").alias("value"), rank(r, i).cast("int").alias("priority"))

    known = F.filter(F.transform(rules, one), lambda r: r["value"].isNotNull() & (r["end"] > r["start"]))
    return normalise(F.coalesce(known, F.array().cast(RULE)), default.cast("string"))


# Order of name variants; all others come last.
VARIANTS = {"common": 0, "official": 1, "alternate": 2, "alt": 2, "short": 3, "colloquial": 4, "historical": 5}


def names(primary: Column, rules: Column) -> Column:
    """Names by place: better variants first, then names without a language, then the first in order; the primary name elsewhere."""
    ranks = F.create_map(*[F.lit(x) for p in VARIANTS.items() for x in p])
    kind = lambda r: F.coalesce(F.element_at(ranks, F.lower(F.coalesce(r["variant"], F.lit("common")))), F.lit(10))
    return parsed(rules, lambda r: r["value"], lambda r, i: kind(r) * 10 + F.when(r["language"].isNull(), 0).otherwise(1), primary)


def speeds(rules: Column) -> Column:
    """Whole km/h by place, as text; the first rule wins."""
    kph = lambda r: F.when(F.lower(r["unit"]) == "mph", F.round(r["value"] * 1.609344)).otherwise(r["value"]).cast("int")
    return parsed(rules, kph, lambda r, i: i, F.lit(None))


def valued(rules: Column, default: Column | None = None) -> Column:
    """Subclasses, levels, flags and one-way values by place; the first rule wins."""
    return parsed(rules, lambda r: r["value"], lambda r, i: i, F.lit(None) if default is None else default)


# Modes of access, and classes open to motor vehicles.
MODES = ("motor_vehicle", "bicycle", "foot")
DRIVEABLE = ("motorway", "trunk", "primary", "secondary", "tertiary", "unclassified", "residential", "living_street", "service")


def access(rules: Column, road_class: Column) -> Column:
    """ARRAY<STRUCT<start, end, value>>: a map of mode to `<value>/<tagged or class_default>` by place; unknown modes are not in it.

    rules hold access_type, modes (null: all), scoped and between. What is said without a scope comes
    first, and of that what allows most; a plain denial that has a scoped exception is restricted, as is
    what is only said with a scope, and any other access type. Classes fill modes that no rule names.
    """
    empty = F.array().cast("array<struct<start:double,end:double,kind:string,scoped:boolean,modes:array<string>>>")
    seen = F.transform(rules, lambda r: F.struct(_scope(r)[0].alias("start"), _scope(r)[1].alias("end"), r["access_type"].alias("kind"), (F.coalesce(r["scoped"], F.lit(False)) | ~r["access_type"].isin("allowed", "designated", "denied")).alias("scoped"), r["modes"].alias("modes")))
    seen = F.coalesce(F.filter(seen, lambda r: r["kind"].isNotNull() & (r["end"] > r["start"])), empty)
    cuts = F.array_sort(F.array_distinct(F.concat(F.array(F.lit(0.0), F.lit(1.0)), F.flatten(F.transform(seen, lambda r: F.array(r["start"], r["end"]))))))
    n = F.size(cuts)
    cls = F.lower(F.trim(road_class))
    by_class = {
        "motor_vehicle": F.when(cls.isin(*DRIVEABLE), "allowed"), "bicycle": F.when(cls == "motorway", "denied").when(cls == "cycleway", "designated"),
        "foot": F.when(cls == "motorway", "denied").when(cls.isin("footway", "sidewalk"), "designated"),
    }

    def at(a: Column, b: Column) -> Column:
        live = F.filter(seen, lambda r: (r["start"] <= a) & (r["end"] >= b))

        def told(mode: str) -> Column:
            own = F.filter(live, lambda r: F.coalesce(F.array_contains(r["modes"], mode), F.lit(True)))
            says = lambda kind, scoped: F.exists(own, lambda r: (r["scoped"] == scoped) & r["kind"].isin(*kind))
            return (
                F.when(says(("allowed",), False), "allowed").when(says(("designated",), False), "designated")
                .when(says(("denied",), False), F.when(says(("allowed", "designated"), True), "restricted").otherwise("denied")).when(F.size(own) > 0, "restricted")
            )

        pairs = [F.struct(F.lit(m).alias("key"), F.coalesce(F.concat(told(m), F.lit("/tagged")), F.concat(by_class[m], F.lit("/class_default"))).alias("value")) for m in MODES]
        return F.struct(a.alias("start"), b.alias("end"), F.map_from_entries(F.filter(F.array(*pairs), lambda p: p["value"].isNotNull())).alias("value"))

    return F.zip_with(F.slice(cuts, 1, n - 1), F.slice(cuts, 2, n - 1), at)
