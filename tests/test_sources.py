"""File scans and sinks: what is written is read back."""

import struct

import pytest
from pyspark.sql import functions as F

from waymesh.sources import files


def wkb(points):
    return bytearray(struct.pack("<BII", 1, 2, len(points)) + b"".join(struct.pack("<dd", *p) for p in points))


def test_wkb(spark):
    line = [(0.0, -0.5), (1e-3, 123456.789), (-7.25, 2.0**40)]
    rows = spark.createDataFrame([("a", wkb(line)), ("p", bytearray(struct.pack("<BIdd", 1, 1, 0, 0))), ("n", None)], "id string, geometry binary")
    got = files.wkb_lines(rows).collect()
    assert [r.id for r in got] == ["a"]
    for p, q in zip(got[0].xy, line, strict=True):
        assert tuple(p) == pytest.approx(q, rel=1e-12, abs=0)


def test_label_partitions(spark, tmp_path):
    rows = spark.createDataFrame([("g1", "t1", "match", "x", "d1"), ("g2", "t2", None, "y", "d2")], "gers_id string, target_id string, label string, labeler string, dataset string")
    rows = rows.select("gers_id", "target_id", "label", "labeler", F.lit(None).cast("timestamp").alias("labeled_at"), F.lit(None).cast("string").alias("session_id"), "dataset")
    files.write_labels_csv(rows, str(tmp_path / "labels"))
    files.write_labels_csv(rows.filter("dataset = 'd2'").withColumn("label", F.lit("no_match")), str(tmp_path / "labels"))
    got = {(r.dataset, r.gers_id): r.label for r in files.labels_csv(spark, str(tmp_path / "labels")).collect()}
    assert got == {("d1", "g1"): "match", ("d2", "g2"): "no_match"}


def test_groups_and_edges(spark, tmp_path):
    (tmp_path / "g.json").write_text('{"groups": [{"group_id": "a", "edges": [{"ref_id": "r", "target_id": "t"}]}, {"group_id": "b", "edges": []}]}')
    assert {r.group_id: len(r.edges) for r in files.groups_json(spark, str(tmp_path / "g.json")).collect()} == {"a": 1, "b": 0}
    rows = spark.createDataFrame([('[{"ref_id": "r", "target_id": "t"}]',), ("{broken",), (None,)], "selected_edges string")
    assert [len(r.edges) for r in files.stitch_labels(rows).collect()] == [1, 0, 0]


def test_tsv_lines(spark, tmp_path):
    (tmp_path / "x.tsv").write_text('US\ta\t{"type": "LineString", "coordinates": [[1, 2], [3.5, 4]]}\nDE\tb\t{"type": "LineString", "coordinates": [[1, 2], [3, 4]]}\nUS\tc\t{"type": "Point", "coordinates": [[1, 2]]}\n')
    got = files.tsv_geojson(spark, str(tmp_path / "x.tsv"), "US").collect()
    assert [(r.id, [tuple(p) for p in r.xy]) for r in got] == [("a", [(1.0, 2.0), (3.5, 4.0)])]


def test_bridge_sink_keeps_its_schema(spark, tmp_path):
    cols = "local_id string, gers_id string, confidence float, match_type string, match_method string, match_decision string, gers_start_frac double, gers_end_frac double, local_start_frac double, local_end_frac double"
    rows = spark.createDataFrame([("t", "r", 0.9, "1:1", "rule", "match", 0.0, 1.0, 0.0, 1.0), ("u", "r", 0.9, "1:1", "rule", "no_match", 0.0, 1.0, 0.0, 1.0)], cols)
    files.bridge_sink(rows, str(tmp_path / "b"))
    files.bridge_sink(rows.limit(0), str(tmp_path / "e"))
    assert spark.read.parquet(str(tmp_path / "b")).count() == 1
    assert dict(spark.read.parquet(str(tmp_path / "e")).dtypes)["confidence"] == "double"
