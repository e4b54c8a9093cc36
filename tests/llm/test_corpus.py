"""Operators on Spark: odd inputs, SQL counterparts, brute force."""

import re
import tracemalloc
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from waymesh.llm import ann, dedup, html, language, learning, licenses, media, mixing, packing, quality, queries, toxicity
from waymesh.llm.common import text_bytes

ROWS = [
    (1, "The cat sat on the mat, the dog did not. " * 3, "en", "src1"),
    (2, None, "en", "src1"),
    (3, "", None, "src2"),
    (4, "Der Hund und die Katze saßen auf der Matte. " * 3, "de", None),
    (4, "Der Hund und die Katze saßen auf der Matte. " * 3, "de", None),
    (None, "Released under the MIT License. Apache license", "en", "src1"),
    (6, "... 123 !!!", "en", "src1"),
    (7, "word " * 40_000, "en", "src1"),
    (8, "THE cat sat on the mat, the dog did not. " * 3, "en", "src3"),
]
SCHEMA = "doc_id long, text string, lang string, source string"


@pytest.fixture(scope="module")
def docs(spark):
    # extra columns, some with the names that operators add
    return spark.createDataFrame(ROWS, SCHEMA).withColumns({"toxicity": F.lit("x"), "labels": F.lit(1), "odd.name": F.lit(2), "n_words": F.lit(None).cast("int"), "epoch": F.lit("e")}).repartition(3)


@pytest.fixture(scope="module")
def none(docs):
    return docs.limit(0)


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(1, 1, 0), (4, 0, 1), (4, 1, None), (8, 1, 0), (None, 0, 1)], "doc_id long, quality int, toxic int")


OPERATORS = {
    "media": lambda d, la: media.media_column(d),
    "language": lambda d, la: language.language_id(d),
    "quality": lambda d, la: quality.quality(d, quality.graded(la)),
    "toxicity": lambda d, la: toxicity.toxicity(d, la, spans=True),
    "licenses": lambda d, la: licenses.scan(d),
    "dedup": lambda d, la: dedup.near_duplicates(d, k=3, percent=85),
    "packing": lambda d, la: packing.pack(d, queries.word_bpe()),
    "mixing": lambda d, la: mixing.mix(d),
}


@pytest.mark.parametrize("name", OPERATORS)
def test_odd_rows_and_empty_tables(name, docs, none, labels):
    rows = OPERATORS[name](docs, labels).collect()
    if name == "mixing":
        assert 0 < len(rows) <= 2 * len(ROWS)
    elif name == "packing":
        assert {r.doc_id for r in rows} == {r[0] for r in ROWS} and sum(r.piece == 0 for r in rows) == len(ROWS)
    else:
        assert sorted((r.doc_id is None, r.doc_id or 0) for r in rows) == sorted((r[0] is None, r[0] or 0) for r in ROWS)
    assert OPERATORS[name](none, labels).collect() == []


def test_undetermined_language(docs):
    got = {r.doc_id: r for r in language.language_id(docs).collect()}
    assert got[2].lang_pred == got[3].lang_pred == got[6].lang_pred == "und" and got[1].lang_pred != "und"
    assert got[6].lang_rejected and got[2].lang_score == 0


def test_components_and_repeated_rows(docs):
    got = {r.doc_id: r for r in dedup.near_duplicates(docs, k=3, percent=85).collect()}
    assert got[8].component_id == 1 and not got[8].kept and got[1].kept
    assert got[2].n_shingles == got[3].n_shingles == 0 and got[2].kept and got[None].kept
    assert sorted(r.doc_id or 0 for r in dedup.deduplicated(docs, k=3, percent=85).collect()) == [0, 1, 2, 3, 4, 6, 7]


def test_language_model_keeps_rare_languages(spark, docs, monkeypatch):
    n = 8_000_100  # a large language with as many 4-grams as fitted before, and one with a hundred
    counts = spark.range(n).select(F.when(F.col("id") < 100, "zz").otherwise("aa").alias("lang"), (F.col("id") * 65_599 + 1).alias("key"), F.when(F.col("id") < 100, 1).otherwise(2).cast("long").alias("n"))
    monkeypatch.setattr(language, "count_grams", lambda *_: counts)
    m = language.train(docs)
    assert m.langs == ["aa", "zz"] and [len(o[-1][0]) for o in m.orders] == [n - 100, 100]


def brute_components(texts, k, percent):
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    sets = {}
    for i, t in texts:
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").translate(lower))
        sets[i] = {tuple(w[j : j + k]) for j in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())
    up = {i: i for i in sets}

    def find(i):
        while up[i] != i:
            i = up[i]
        return i

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                    x, y = find(a), find(b)
                    up[max(x, y)] = min(x, y)
    return {i: find(i) for i in ids}


def test_dense_group_is_cut_into_blocks(spark):
    rng = np.random.default_rng(4)
    base = [f"w{i}" for i in rng.integers(0, 500, 120)]
    texts = []
    for i in range(150):
        w = list(base) if i < 120 else [f"x{j}" for j in rng.integers(0, 500, 120)]
        for _ in range(2):
            w[int(rng.integers(0, 120))] = f"y{i}"
        texts.append((i, " ".join(w)))
    frame = spark.createDataFrame(texts, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in dedup.near_duplicates(frame, k=3, percent=85, limit=16, group=20, depth=3).collect()}
    assert got == brute_components(texts, 3, 85)


def pairs_around_a_passage(n):
    """n pairs of similarity 0.85 and more that share a passage with all others (similarity below 0.7)."""
    rng = np.random.default_rng(8)
    texts = []
    for i in range(n):
        w = [f"p{j}" for j in range(100)] + [f"t{i}x{j}" for j in range(20)]
        texts.append((2 * i, " ".join(w)))
        for j in rng.choice(np.arange(2, 98, 4), 3, replace=False):
            w[j] = f"y{i}x{j}"
        texts.append((2 * i + 1, " ".join(w)))
    return texts


def test_pairs_within_an_oversized_node(spark):
    texts = pairs_around_a_passage(150)
    want = brute_components(texts, 3, 85)
    assert want == {i: i - i % 2 for i, _ in texts}
    frame = spark.createDataFrame(texts, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in dedup.near_duplicates(frame, k=3, percent=85, limit=16, group=30, depth=1).collect()}
    assert got == want


def test_pairs_within_a_branched_coarse_group(spark):
    texts = pairs_around_a_passage(250)
    frame = spark.createDataFrame(texts, "doc_id long, text string")
    got = {r.doc_id: r.component_id for r in dedup.near_duplicates(frame, k=3, percent=85, limit=16, group=60, depth=4).collect()}
    assert got == brute_components(texts, 3, 85)


def test_texts_are_not_sent_for_few_dropped_ids(spark, monkeypatch):
    words = " ".join(f"w{i}" for i in range(40))
    frame = spark.createDataFrame([(i, words if i < 3 else f"{words} {i} " * i) for i in range(9)] + [(None, words), (4, None), (1, words)], "doc_id long, text string")
    plan = lambda d: d._jdf.queryExecution().executedPlan().toString()
    was = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        out = dedup.deduplicated(frame.filter("doc_id <> 4 AND doc_id <> 1 OR doc_id IS NULL"))
        assert "SortMergeJoin" not in plan(out) and "LeftAnti" in plan(out)
        few = dedup.deduplicated(frame).collect()
        monkeypatch.setattr(dedup, "MOST_BROADCAST", -1)
        assert "SortMergeJoin" in plan(dedup.deduplicated(frame))
        assert sorted(map(str, dedup.deduplicated(frame).collect())) == sorted(map(str, few))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", was)
    ids = [r.doc_id for r in few]
    assert None in ids and 0 in ids and not {1, 2} & set(ids) and len(ids) == len(set(ids))


def test_branching_joins_sketches_once(spark):
    class Counted:
        calls = 0

        def __init__(self, rows):
            self.rows = rows

        def select(self, *cols):
            Counted.calls += 1
            return self.rows.select(*cols)

    live = spark.range(20).selectExpr("id", "0 AS tree", "1L AS path", "id AS part", "20L AS n")
    sketch = Counted(spark.range(20).selectExpr("id", "array_repeat(7, 64) AS sketch"))
    ends = dedup.branched(live, sketch, limit=4, depth=4).collect()
    assert Counted.calls == 1 and sorted(r.id for r in ends) == list(range(20)) and len({r.path for r in ends}) == 1


def test_near_duplicates_equal_brute_force(spark, sf_dir):
    texts = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text").collect()]
    got = {r.doc_id: r.component_id for r in queries.op3_near_duplicates(spark, sf_dir).collect()}
    assert got == brute_components(texts, 3, 85)


@pytest.fixture(scope="module")
def con(sf_dir):
    c = duckdb.connect()
    for t in ("documents", "embeddings", "pages", "labels", "benchmark"):
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(name, spark, sf_dir, con):
    got = queries.QUERIES[name](spark, sf_dir)
    cols = sorted(got.columns)
    rel = con.execute(queries.ORACLES[name])
    names = [x[0] for x in rel.description]
    assert sorted(names) == cols
    show = lambda v: f"{v:.9g}" if isinstance(v, float) else repr(v)
    want = sorted([show(r[names.index(c)]) for c in cols] for r in rel.fetchall())
    assert sorted([show(r[c]) for c in cols] for r in got.collect()) == want


def test_license_spans(spark):
    rows = [(1, "we say: licensed under the Apache License, version 2.0 here"), (2, "mit license mit license"), (3, "general public licenses"), (4, "Permission is hereby granted, at no charge, to any person obtaining a copy of this software and associated documentation files")]
    got = {r.doc_id: r for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert (got[1].labels, got[1].n_base, got[1].first_word) == ("apache", 1, 5)
    assert (got[2].n_base, got[2].first_word, got[2].last_word, got[2].base_labels) == (2, 0, 2, "mit")
    assert (got[3].n_base, got[3].first_word, got[3].labels) == (0, None, "")
    assert got[4].labels == "mit" and 0.5 <= got[4].license_score < 1 and got[4].base_labels == ""


def test_licenses_cut_texts_once_and_exchange_nothing(spark):
    notice = licenses.TEMPLATES[1][1]
    rows = [(1, "word " * 50_000 + notice + " x" * 5), (2, notice.replace("free of charge", "at no charge") + " | " + notice), (2, notice), (2, notice), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = licenses.scan(docs)
    plan = out._jdf.queryExecution().executedPlan().toString()
    # a scan of rows by themselves: words are not cut again for the spans, nor copied with each of their places
    assert plan.count("regexp_extract_all") == 1 and not re.search("Generate|Join|Exchange", plan)
    got = sorted(((r.doc_id or 0, r.n_words, r.n_base, r.labels, r.license_score) for r in out.collect()))
    n = len(re.findall(licenses.WORD, notice))
    assert got == [(0, 0, 0, "", 0.0), (1, 50_000 + n + 5, 0, "mit", 1.0)] + sorted([(2, n, 0, "mit", 1.0)] * 2 + [(2, 2 * n, 0, "mit", 1.0)])
    spans = sorted((r.id, r.label, r.first_word, r.last_word, round(r.share, 3)) for r in licenses.spans(docs).collect())
    # equal rows name their span once; two changed words take four of the notice's 3-grams
    assert spans == sorted([(1, "mit", 50_000, 50_000 + n - 1, 1.0), (2, "mit", 0, n - 1, 1.0), (2, "mit", 0, n - 1, round((n - 6) / (n - 2), 3)), (2, "mit", n, 2 * n - 1, 1.0)])


def test_license_words_are_all_but_other_ascii(spark):
    ends = [0x80, 0xFF, 0x130, 0x2028, 0xD7FF, 0xE000, 0xFFFF, 0x10000, 0x1F600, 0x10FFFF]
    every = "".join(map(chr, [*range(128), *ends, *(c for e in ends for c in (0x20, e))]))
    want = re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", re.sub("[A-Z]+", lambda m: m[0].lower(), every))
    got = spark.createDataFrame([(every,)], "text string").select(licenses.words_of(F.col("text")).alias("words")).first().words
    assert got == want


def test_nearest_equal_brute_force(spark):
    rng = np.random.default_rng(0)
    x = rng.standard_normal((600, 16))
    x[10:40] = x[9]
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(1000, None), (1050, [0.0] * 16), (1100, [float("nan")] + [1.0] * 15), (1150, [None] + [1.0] * 15), (1200, [1.0, 2.0]), (1250, [])]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = defaultdict(list)
    for r in ann.nearest(frame, frame.filter(F.col("vec_id") % 50 == 0), block_bytes=2000).orderBy("query_id", "rank").collect():
        got[r.query_id].append((r.vec_id, r.score))
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    hit = 0
    for q in range(0, 600, 50):
        s = u @ u[q]
        s[q] = -9
        best = np.lexsort((np.arange(600), -np.round(s, 12)))[:5]
        hit += len(set(best.tolist()) & {i for i, _ in got[q]})
    assert hit >= 0.9 * 60 and set(got) == set(range(0, 600, 50))
    assert ann.nearest(frame.limit(0), frame.limit(0)).collect() == []


def test_repeated_ids_take_one_place(spark):
    rng = np.random.default_rng(3)
    x = rng.standard_normal((47, 16))
    x[1:9] = x[0] + rng.standard_normal((8, 16)) * 0.01
    ids = [0] + [1] * 8 + list(range(100, 138))
    frame = spark.createDataFrame([(i, v.tolist(), 1) for i, v in zip(ids, x, strict=True)], "vec_id long, embedding array<double>, score int")
    got = ann.nearest(frame, frame.filter("vec_id = 0")).orderBy("rank").collect()
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    best = {}
    for i, s in zip(ids[1:], u[1:] @ u[0], strict=True):
        best[i] = max(best.get(i, -9), s)
    want = sorted(best, key=lambda i: (-best[i], i))[:5]
    assert [r.vec_id for r in got] == want and [r.rank for r in got] == [1, 2, 3, 4, 5]
    assert [r.score for r in got] == pytest.approx([best[i] for i in want], abs=1e-12)


def test_pages(spark):
    page = "<html><body><div class='lead'>same every time</div><div class='body'>{}</div></body></html>"
    rows = [(i, f"http://a.example/{i}", page.format(f"text number {i}")) for i in range(8)] + [(90, None, None), (91, "http://b.example/", "<p>x"), (None, "http://b.example/", "")]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("main_text", F.lit("old"))
    for most in (100_000, 0):  # broadcast and salted join
        got = {r.page_id: r for r in html.extract(frame, most_broadcast=most).collect()}
        assert len(got) == len(rows) and got[3].main_text == "text number 3" and got[3].n_chars == 13
        assert got[90].main_text == "" and got[91].main_text == "x" and got[None].n_chars == 0
    assert html.extract(frame.limit(0)).collect() == []


def test_wrappers_without_text_keep_what_is_under_them(spark):
    page = "<html><body class='site'><div class='wrap'><div class='lead'><div class='logo'>same logo</div></div><div class='post'><h2>Same line</h2><div class='words'><p>text number {}</p></div></div></div></body></html>"
    frame = spark.createDataFrame([(i, f"http://a.example/{i}", page.format(i)) for i in range(6)], "page_id long, url string, html string")
    assert {r.page_id: r.main_text for r in html.extract(frame).collect()} == {i: f"text number {i}" for i in range(6)}
    low = {r.importance < 0.2 for r in html.style_tree(frame.select(F.lit(1).cast("long").alias("host_key"), "html")).filter("own < 0.2").collect()}
    assert low == {True, False}


def test_tree_without_names(spark):
    # menus and notices without any telling name; texts of a wrapped body differ from page to page
    page = "<html><body><div class='x1'><a href='/'>Home</a><a href='/b'>About</a></div><div class='x2'><div class='x3'><p>text {0}</p><p>more {0}</p></div></div><div class='x4'>All rights reserved</div></body></html>"
    rows = [(i, f"http://a.example/{i}", page.format(i)) for i in range(12)]
    frame = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("host_key", F.lit("clash"))
    got = html.extract(frame, names=False)
    assert {(r.main_text, r.host_key) for r in got.collect()} == {(f"text {i}\n\nmore {i}", "clash") for i in range(12)}
    wrapped = [(i, f"http://b.example/{i}", f"<div class='wrap'><section class='s0'><p>unique text {i}</p></section></div>") for i in range(12)]
    got = html.extract(spark.createDataFrame(wrapped, "page_id long, url string, html string")).collect()
    assert {r.main_text for r in got} == {f"unique text {i}" for i in range(12)}


def test_tree_tells_pools_shared_by_hosts(spark):
    # one page a host: only all hosts together show that menus and closing sentences come from a pool
    page = "<html><body><div class='x1'>entry {1}</div><div class='x2'><p>text {0}. more {0}.</p></div><div class='x3'>(c) h{0}.example · said {1}. Closing.</div></body></html>"
    rows = [(i, f"http://h{i}.example/", page.format(i, i % 4)) for i in range(60)] + [(i, f"http://copy{i}.example/", "<div class='y'>a copied article</div>") for i in (90, 91, 92)]
    want = {i: f"text {i}. more {i}." if i < 60 else "a copied article" for i, _, _ in rows}
    frame = spark.createDataFrame(rows, "page_id long, url string, html string")
    for names in (True, False):
        assert {r.page_id: r.main_text for r in html.extract(frame, names=names).collect()} == want


def test_tree_alone_equals_tree_and_names(spark):
    pages = spark.read.parquet("/root/testdata/sf0.1/pages.parquet")
    both, alone = ({r.page_id: r.main_text for r in html.extract(pages, names=x).collect()} for x in (True, False))
    assert len(both) == 2500 and both == alone


def test_deep_pages_keep_importance_of_all_ancestors(spark):
    deep = "".join(f"<div class='d{j}'>" for j in range(60))
    rows = [(1, f"{deep}<i>words {i}</i>") for i in range(6)]
    tree = html.style_tree(spark.createDataFrame(rows, "host_key long, html string")).collect()
    assert len(tree) == 62 and sum(r.importance == 1 for r in tree) == 60


def test_rows_through_keeps_names(spark):
    from waymesh.llm.common import rows_through

    frame = spark.createDataFrame([(1, "the cat", "x", 5), (2, None, "y", 6)], "doc_id long, text string, `odd.name` string, quality_rejected int")
    got = rows_through(frame, lambda d, at: quality.quality(d, spark.createDataFrame([], f"{at['doc_id']} long, grade int"), id_col=at["doc_id"], text_col=at["text"]))
    assert got.columns == frame.columns and sorted(got.collect()) == sorted(frame.collect())


def test_shards_are_merged(spark):
    frame = spark.createDataFrame([(i % 3, "word " * (i % 50 + 5)) for i in range(400)], "doc_id long, text string")
    got = packing.pack(frame, queries.word_bpe(), cap=128, shard=30).collect()
    lengths = np.array([r.length for r in got])
    by = defaultdict(list)
    for r in got:
        by[r.sequence_id].append((r.offset, r.length))
    for own in by.values():
        own.sort()
        assert [o for o, _ in own] == np.concatenate([[0], np.cumsum([n for _, n in own])[:-1]]).tolist() and sum(n for _, n in own) <= 128
    assert len(got) == 400 and len(by) <= -(-lengths.sum() // 128) + 4


def test_budget_is_met_and_shortages_move_to_siblings(spark):
    leaves = spark.createDataFrame([("d0", "en", "a", 100), ("d0", "en", "b", 10_000), ("d0", "de", "c", 5000), ("d1", "en", "d", 50), ("d2", "en", "e", 9000)], "domain string, language string, source string, tokens long")
    got = {r.source: r for r in mixing.leaf_budgets(leaves, 0.5, 2).collect()}
    total = 24_150 // 2
    assert abs(sum(r.budget for r in got.values()) - total) <= 5
    assert got["a"].budget == 200 and got["d"].budget == 100
    assert all(r.budget <= r.capacity for r in got.values())
    # what a can't take goes to b, its sibling, and leaves the share of German alone
    english, german = got["a"].budget + got["b"].budget, got["c"].budget
    assert english / german == pytest.approx(5 / 2, rel=0.01)


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang")
    got = queries.op6_language_id(spark, sf).filter("held_out").join(docs, "doc_id")
    assert got.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("double"))).first()[0] > 0.97
    truth = spark.read.parquet(f"{sf}/labels.parquet")
    q = {r.quality: r.k for r in queries.op8_quality(spark, sf).join(truth, "doc_id").groupBy("quality").agg(F.avg(F.col("kept").cast("double")).alias("k")).collect()}
    assert q[1] > 0.95 and q[0] < 0.5
    t = {r.toxic: r.p for r in queries.op9_toxicity(spark, sf).join(truth, "doc_id").groupBy("toxic").agg(F.avg("predicted").alias("p")).collect()}
    assert t[1] > 0.6 and t[0] < 0.05


def test_pipeline(spark, sf_dir):
    import corpus_pipeline

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    before = docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf_dir)
        assert out.columns == docs.columns
        rows = out.count()
        assert 0 < rows <= before * (2 if "mixing" in name else 1)
        docs, before = out, rows
    packed = corpus_pipeline.packing_stage(spark, docs, sf_dir)
    assert packed.filter("piece = 0").count() == before
    assert packed.groupBy("sequence_id").agg(F.sum("length").alias("n")).filter("n > 4096").count() == 0


@pytest.fixture
def kernels(docs, labels, monkeypatch):
    """The functions over Arrow batches that quality, language ID (counts, then scores) and near-dedup give to Spark."""
    held = {}

    def frame(name):
        return lambda self, run, schema: held.update({name: run}) or self.sparkSession.createDataFrame([], schema)

    def column(name):
        # as in appended(): batches of one text column
        return lambda docs, fields, kernel, *cols: held.update({name: lambda batches: (kernel(b.column(b.num_columns - 1)) for b in batches)})

    monkeypatch.setattr(quality, "appended", column("quality"))
    quality.quality(docs, quality.graded(labels))
    monkeypatch.setattr(language, "appended", column("language"))
    language.language_id(docs)
    monkeypatch.setattr(type(docs), "mapInArrow", frame("counts"))
    language.count_grams(docs, "text", "lang")
    monkeypatch.setattr(type(docs), "mapInArrow", frame("near-dedup"))
    dedup.described(docs, 5, "doc_id", "text")
    return held


def made_up(n):
    rng = np.random.default_rng(5)
    words = ["".join(rng.choice(list("abcdefghijklmnopqrstuvwxyzäé"), 5)) for _ in range(3000)]
    return [" ".join(rng.choice(words, 1700)) for _ in range(n)]


def test_stages_hold_little_beside_a_batch(kernels):
    texts = made_up(800)
    for name, run in kernels.items():
        first = pa.array(range(800)) if name == "near-dedup" else pa.array(["en", "de"] * 400)
        batch = pa.RecordBatch.from_arrays([first, pa.array(texts)], names=["first", "text"])
        list(run(iter([batch.slice(0, 20)])))  # tables that are made once
        tracemalloc.start()
        for _ in run(iter([batch])):
            pass
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert peak < 50e6, (name, peak)


def test_counts_of_many_blocks_add_up(kernels, monkeypatch):
    monkeypatch.setattr(language, "BLOCK", 3000)
    texts = [None, "", "É é", *(t[:1000].upper() for t in made_up(60)), "x" * 9000]
    langs = ["en", "de", "de", *["en", "de", "fr"] * 20, "en"]
    got = Counter()
    for out in kernels["counts"](iter([pa.RecordBatch.from_arrays([pa.array(langs), pa.array(texts)], names=["lang", "text"])])):
        for lang, key, n in zip(*(c.to_pylist() for c in out.columns), strict=True):
            assert (lang, key) not in got
            got[lang, key] = n
    want = Counter()
    for lang, text in zip(langs, texts, strict=True):
        u, inv, _ = language.grams(*text_bytes(pa.array([(text or "").lower()])))
        want.update((lang, int(u[i].view(np.int64))) for i in inv)
    assert got == want


def test_labelled_ids_start_no_python_workers(spark):
    docs, grades = spark.range(60).selectExpr("id doc_id", "concat('text ', id) text"), spark.range(60).selectExpr("id doc_id", "cast(id % 3 as string) grade")
    sample = learning.labelled_sample(docs, grades, {"0": 5, "1": 7})
    assert Counter((r.grade, r.text == f"text {r.doc_id}", r.doc_id % 3 == int(r.grade)) for r in sample.collect()) == {("0", True, True): 5, ("1", True, True): 7}
    assert "ExistingRDD" not in sample._jdf.queryExecution().executedPlan().toString()
    assert learning.labelled_sample(docs, grades.limit(0), {"0": 5, "1": 7}).count() == 0
