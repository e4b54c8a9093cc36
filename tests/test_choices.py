"""Alternatives, additions to matches, orphan triage, names and sources on small fixtures."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from waymesh.functions import geometry as g
from waymesh.functions import ranges
from waymesh.functions import text as tx
from waymesh.operators import choices, integration, learned
from waymesh.sources import files

XY = "array<struct<x:double,y:double>>"


def line(*points):
    return [tuple(map(float, p)) for p in points]


@pytest.mark.parametrize("k", [1, 4, 9])
def test_best_alternatives_equal_the_whole_product(spark, k):
    rng = random.Random(k)
    edges = [(1, r, t, rng.randint(1, 3) / 10) for t in range(4) for r in range(4) if rng.random() < 0.7] + [(2, 0, 0, 0.5)]
    touching = [(1, 0, 1), (1, 1, 2), (1, 0, 2)]  # a triangle: one set of three, not three
    e = spark.createDataFrame(edges, "group_id int, ref_id int, target_id int, confidence double")
    options = choices.target_options(e, spark.createDataFrame(touching, "group_id int, a int, b int"))
    got = [(r.group_id, r["rank"], list(r.picks), r.total) for r in choices.alternatives(options, k).orderBy("group_id", "rank").collect()]
    conf = {(t, r): c for grp, r, t, c in edges if grp == 1}
    per = []
    for t in range(4):
        refs = [r for r in range(4) if (t, r) in conf]
        sets = [(r,) for r in refs] + [p for p in itertools.combinations(refs, 2) if p in {(0, 1), (1, 2), (0, 2)}] + ([(0, 1, 2)] if {0, 1, 2} <= set(refs) else [])
        if refs:
            per.append([("-", 0.0)] + [(f"{t}:" + "+".join(map(str, x)), sum(conf[t, r] for r in x)) for x in sets])
    every = sorted((-round(sum(c for _, c in p), 6), [n for n, _ in p]) for p in itertools.product(*per) if any(n != "-" for n, _ in p))
    want = [(1, i + 1, picks, -cost) for i, (cost, picks) in enumerate(every[:k])] + [(2, 1, ["0:0"], 0.5)]
    assert got == want


def test_menu_lists_the_proposal_first_and_once(spark):
    alts = spark.createDataFrame([(1, 1, ["a"], 2.0), (1, 2, ["b"], 1.0), (2, 1, ["c"], 1.0)], "group_id int, rank int, picks array<string>, total double")
    proposed = spark.createDataFrame([(1, ["b"], 1.0)], "group_id int, picks array<string>, total double")
    got = {(r.group_id, r.letter): (r.picks[0], r.is_proposed) for r in choices.menu(alts, proposed).collect()}
    assert got == {(1, "A"): ("b", True), (1, "B"): ("a", False), (2, "A"): ("c", False)}


def test_expansion_adds_only_what_touches(spark):
    refs = spark.createDataFrame([("r", line((0, 0), (300, 0)))], f"id string, xy {XY}")
    targets = spark.createDataFrame([("a", line((0, 1), (100, 1))), ("b", line((101, 1), (200, 1))), ("c", line((201, 1), (250, 1))), ("d", line((280, 1), (300, 1)))], f"id string, xy {XY}")
    pairs = "ref_id string, target_id string, confidence double"
    cands = spark.createDataFrame([("r", "a", 0.9), ("r", "b", 0.8), ("r", "c", 0.4), ("r", "d", 0.9)], pairs)
    got = {r.target_id: (r.added, r.decision) for r in choices.expanded(spark.createDataFrame([("r", "a", 0.9)], pairs), cands, refs, targets).collect()}
    assert got == {"a": (False, "match"), "b": (True, "match"), "c": (True, "review")}


def test_rescue_joins_fragments_of_one_name(spark):
    groups = spark.createDataFrame([("g1", "a", "r", 0.0, 50.0), ("g2", "b", "r", 60.0, 90.0), ("g3", "c", "r", 120.0, 150.0), ("g4", "d", "r", 91.0, 119.0)], "group_id string, id string, ref_id string, from_m double, to_m double")
    lines = [("a", "Main St", line((0, 0), (50, 0))), ("b", "main st", line((60, 0), (90, 0))), ("c", "Main St", line((200, 0), (250, 0))), ("d", None, line((91, 0), (119, 0)))]
    got = {r.group_id: r.merged_id for r in choices.rescued(groups, spark.createDataFrame(lines, f"id string, name string, xy {XY}")).collect()}
    assert got == {"g1": "g1", "g2": "g1", "g3": "g3", "g4": "g4"}


def test_promotion_needs_two_components(spark):
    rows = f"id string, xy {XY}"
    refs = spark.createDataFrame([("p", line((0, 0), (40, 0))), ("q", line((60, 0), (100, 0))), ("u", line((0, 500), (50, 500))), ("v", line((50, 500), (100, 500)))], rows)
    cands = spark.createDataFrame([("joins", line((0, 1), (100, 1))), ("same", line((0, 501), (100, 501))), ("short", line((37, 2), (63, 2)))], rows)
    assert [r.id for r in integration.promoted(cands, refs).collect()] == ["joins"]


def test_orphans_have_components_and_priorities(spark):
    rows = f"id string, xy {XY}"
    lost = spark.createDataFrame([("a", line((0, 100), (60, 100))), ("b", line((60, 100), (80, 100))), ("c", line((9000, 0), (9005, 0)))], rows)
    got = {r.id: (r.component, r.n, r.nearest_m, r.priority) for r in integration.orphan_components(lost, spark.createDataFrame([("m", line((0, 0), (100, 0)))], rows)).collect()}
    assert got == {"a": ("a", 2, 100.0, "high"), "b": ("a", 2, 100.0, "medium"), "c": ("c", 1, None, "low")}


def test_name_bundle_nulls(spark):
    rows = [("Main Street", "Main St"), ("Main Street", " "), ("Main St", "Ленина"), ("...", "Main St"), ("Ленина", "Ленина"), ("Ramp", "Main St")]
    df = spark.createDataFrame(rows, "a string, b string")
    got = df.select("a", "b", *[c.alias(n) for n, c in tx.name_bundle(F.col("a"), F.col("b")).items()]).collect()
    assert got[0].indel == got[0].token_set == got[0].soundex == got[0].metaphone == 1.0 and not got[0].names_missing
    assert got[1].indel is None and got[1].names_missing and got[1].has_name_target == 0.0
    assert got[2].indel is None and not got[2].names_missing
    assert got[3].indel is None and got[3].names_missing
    assert got[4].indel == 1.0 and got[4].soundex is None and got[4].metaphone is None
    assert got[5].name_is_generic == 1.0 and got[0].name_is_generic == 0.0


def test_best_variants_take_the_first_of_equals(spark):
    rows = [(1, ["Rue Longue", "Long St"], ["long street", "Long St"]), (2, [], ["x"]), (3, None, None)]
    got = {r.k: (r.ref_name, r.target_name, r.ratio) for r in tx.best_variants(spark.createDataFrame(rows, "k int, a array<string>, b array<string>"), "k", "a", "b").collect()}
    assert got == {1: ("Long St", "long street", 1.0), 2: (None, "x", None), 3: (None, None, None)}
    v = spark.createDataFrame([("Main", {"en": "main", "fr": "Grand"}, [("Grande",), (None,)])], "p string, c map<string,string>, r array<struct<value:string>>").select(tx.variants(F.col("p"), F.col("c"), F.col("r")).alias("v")).first().v
    assert v == ["Main", "Grand", "Grande"]


@pytest.mark.parametrize(
    ("parts", "want"),
    [
        ([line((0, 0), (1, 0)), line((1, 0), (2, 0))], line((0, 0), (1, 0), (2, 0))),
        ([line((1, 0), (2, 0)), line((1, 0), (0, 0))], line((0, 0), (1, 0), (2, 0))),
        ([line((0, 0), (1, 0)), line((9, 9), (9, 5)), line((2, 0), (1, 0))], line((9, 9), (9, 5))),
        ([line((5, 0), (6, 0)), line((0, 0), (1, 0)), line((1, 0), (3, 0))], line((0, 0), (1, 0), (3, 0))),
    ],
)
def test_merged_parts(spark, parts, want):
    df = spark.createDataFrame([(parts,)], f"parts array<{XY}>").select(g.merged_parts(F.col("parts")).alias("xy"))
    got = [tuple(p) for p in df.first().xy]
    assert got == want or got == want[::-1]


def test_lines_only_drops_other_kinds(spark):
    rows = [(1, "MultiLineString", []), (2, "Point", [line((0, 0))]), (3, "LineString", [line((0, 0))]), (4, "LineString", [line((0, 0), (1, 1))]), (5, None, None)]
    assert [r.id for r in files.lines_only(spark.createDataFrame(rows, f"id int, kind string, parts array<{XY}>")).collect()] == [4]


def test_assembly_defaults(spark):
    rows = spark.createDataFrame([(1, 2.0, None), (2, float("nan"), None)], "k int, a double, b double")
    got = [tuple(r) for r in learned.assembled(rows, ["k"], [("a", F.col("a"), -1.0), ("b", F.col("b"), 9.0)]).orderBy("k").collect()]
    assert got == [(1, 2.0, 9.0, False), (2, -1.0, 9.0, True)]


def test_leave_one_out_holds_each_kind_out(spark):
    rows = spark.createDataFrame([(k, float(i % 2), float(i % 2) * 10 + i % 3) for k in ("x", "y") for i in range(40)] + [(None, 1.0, 10.0)], "kind string, y double, f double")
    got = {r.kind: (r.n, r.f1) for r in learned.leave_one_out(rows, "kind", ["f"], trees=2, depth=2).collect()}
    assert got == {"x": (40, 1.0), "y": (40, 1.0)}


def test_local_lines_and_layers(spark, tmp_path):
    spark.createDataFrame([(7, "Main")], "OBJECTID int, Street string").write.parquet(f"{tmp_path}/a.parquet")
    got = files.local_lines(spark, f"{tmp_path}/a.parquet", {"id": "objectid", "name": "street", "class": "kind"}, {"class": "road"}).first()
    assert (got.id, got.name, got["class"]) == ("7", "Main", "road")
    with pytest.raises(ValueError, match="no reader"):
        files.local_lines(spark, "x.gpkg", {"id": "id"})
    stats = files.write_integration({"edges": spark.range(3).toDF("id"), "nodes": spark.range(2).toDF("id")}, str(tmp_path / "out"))
    assert {r.layer: r.n for r in stats.collect()} == {"edges": 3, "nodes": 2}
    assert spark.read.json(f"{tmp_path}/out/stats.json").count() == 2


def test_names_by_place(spark):
    rules = "array<struct<value:string,variant:string,language:string,between:array<double>>>"
    rows = [(1, "Main", [("Kurz", "short", None, None), ("Haupt", "common", "de", [0.0, 0.5]), ("Main", "common", None, [0.25, 0.5]), (None, "common", None, None)]), (2, "Main", None), (3, None, [])]
    got = {r.k: [tuple(x) for x in r.v] for r in spark.createDataFrame(rows, f"k int, p string, r {rules}").select("k", ranges.names(F.col("p"), F.col("r")).alias("v")).collect()}
    assert got == {1: [(0.0, 0.25, "Haupt"), (0.25, 0.5, "Main"), (0.5, 1.0, "Kurz")], 2: [(0.0, 1.0, "Main")], 3: [(0.0, 1.0, None)]}


def test_access_by_place(spark):
    rules = "array<struct<access_type:string,modes:array<string>,scoped:boolean,between:array<double>>>"
    rows = [
        (1, "motorway", [("denied", ["foot"], None, None), ("allowed", ["foot"], True, [0.0, 0.5])]),
        (2, "service", [("denied", None, False, None), ("designated", ["bicycle"], False, None)]),
        (3, "path", [("permit", ["foot"], False, None)]),
        (4, None, None),
    ]
    df = spark.createDataFrame(rows, f"k int, c string, r {rules}").select("k", ranges.access(F.col("r"), F.col("c")).alias("v"))
    got = {r.k: [(x.start, x.end, x.value) for x in r.v] for r in df.collect()}
    motor, bike = {"motor_vehicle": "allowed/class_default"}, {"bicycle": "denied/class_default"}
    assert got[1] == [(0.0, 0.5, motor | bike | {"foot": "restricted/tagged"}), (0.5, 1.0, motor | bike | {"foot": "denied/tagged"})]
    assert got[2] == [(0.0, 1.0, {"motor_vehicle": "denied/tagged", "bicycle": "designated/tagged", "foot": "denied/tagged"})]
    assert got[3] == [(0.0, 1.0, {"foot": "restricted/tagged"})]
    assert got[4] == [(0.0, 1.0, {})]
