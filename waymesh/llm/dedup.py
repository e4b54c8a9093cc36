"""MinHash near-dedup by a chosen-path set similarity join.

A document's set is its distinct word k-shingles (64-bit hashes). Documents with equal sets form a
class with one representative; from there on only representatives take part. A representative's
sketch holds `SKETCH` minwise tokens.

Search: in each of `trees` independent trees, documents are branched recursively. At depth d a tree
has a coordinate, and the documents that stand together at a node and have the same minwise token
there go on to the same child. Nodes with at most `limit` documents are compared exhaustively and
leave the tree; larger ones are branched again. Two documents of similarity s share a child with
probability s, so a pair is lost by one tree with probability 1 - s, and by all of them with
(1 - s)^trees at depth 1 (0.85: 10^-9 for 12 trees).

Before a large node is branched, its documents are compared in blocks of about `limit` that share a
few leaders. That joins a group of copies to one part at once, and a node of one part ends there:
only nodes that hold documents of several parts go down. Where branching ends, because a node is
small enough or `depth` is reached, all pairs of documents of different parts are compared, in tasks
of two blocks of at most about `group` documents each; no pair is left out for a node's size. For
unrelated documents that stay together down to `depth` that grows with the square of the node. A pair
that has to go down to depth d is lost with (1 - s^d)^trees (0.85, depth 4, 12 trees: 2 in 10,000).

A comparison walks from document to linked document, always against those not yet reached, and
returns a spanning forest: a node never emits more edges than documents, and copies cost one
comparison each. It runs twice: first on sketches with a lower bar, which gives coarse groups that
hold all similar pairs (but for the trees' chance above and one below 10^-5 for a pair), then on the
full sets within each coarse group, which confirms links exactly. A document's text is sent once for
the second step. A coarse group over its limit is cut into blocks with leaders first; if these leave
several parts, it is branched by all trees again, for which a text is sent twice a tree at most while
its node fits.

Defined cases: a text with fewer than k words is one shingle of all its words; null texts and texts
without words have an empty set and are linked with nothing; rows of equal id count as one document
that has the links of all its rows (n_shingles is each row's own); rows with a null id are linked with nothing and kept; an empty
table gives an empty result; extra columns are ignored by near_duplicates() and passed by
deduplicated().
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BLOCK, LOWER, U64, blocks, mix, text_bytes, word_hashes, written
from .components import components

SKETCH = 64
#: Rows times columns (ids and numbers) that are broadcast at most; more are joined by a shuffle of both sides. Results are the same.
MOST_BROADCAST = 3_000_000
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True
_RNG = np.random.default_rng(77)
_TIMES = _RNG.integers(1, 1 << 63, 64, dtype=np.uint64) * U64(2) + U64(1)
_PLUS = _RNG.integers(1, 1 << 63, SKETCH, dtype=np.uint64)


def shingles(data: np.ndarray, offsets: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(distinct shingle hashes, sorted within each row; first of each row) of UTF-8 rows."""
    h, first = word_hashes(LOWER[data], offsets, _SPACE)
    n = np.diff(first)
    full = np.zeros(max(len(h) - k + 1, 0), np.uint64)
    for j in range(k):
        full += h[j : len(h) - k + 1 + j] * _TIMES[j] if len(full) else full
    full = mix(full)
    out, sizes = [], np.zeros(len(n), np.int64)
    for i in np.flatnonzero(n):
        a, b = first[i], first[i + 1]
        if b - a >= k:
            own = np.unique(full[a : b - k + 1])
        else:
            own = mix((h[a:b] * _TIMES[: b - a]).sum(keepdims=True, dtype=np.uint64) + U64(b - a))
        out.append(own)
        sizes[i] = len(own)
    return (np.concatenate(out) if out else np.zeros(0, np.uint64)), np.concatenate([[0], np.cumsum(sizes)])


def sketches(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """SKETCH minwise tokens (31 bits) of each row; zeros for empty rows."""
    some = np.flatnonzero(np.diff(first))
    out = np.zeros((len(first) - 1, SKETCH), np.int32)
    for j in range(SKETCH if len(some) else 0):
        token = ((values ^ _PLUS[j]) * _TIMES[j % 64]) >> U64(33)
        out[some, j] = np.minimum.reduceat(token, first[some]).astype(np.int32)
    return out


def described(docs: DataFrame, k: int, id_col: str, text_col: str) -> DataFrame:
    """id, n_shingles, sig_a, sig_b (a 128-bit fingerprint of the set), sketch."""
    src = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column(1))
            for a, b in blocks(offsets, BLOCK):
                values, first = shingles(data[offsets[a] : offsets[b]], offsets[a : b + 1] - offsets[a], k)
                sums = [np.concatenate([[U64(0)], np.cumsum(mix(values ^ U64(seed)), dtype=np.uint64)]) for seed in (0x51ED27, 0xA0761D)]
                sig = [(s[first[1:]] - s[first[:-1]]).view(np.int64) for s in sums]
                sketch = pa.FixedSizeListArray.from_arrays(pa.array(sketches(values, first).ravel()), SKETCH).cast(pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(a, b - a), pa.array(np.diff(first)), pa.array(sig[0]), pa.array(sig[1]), sketch], names=["id", "n_shingles", "sig_a", "sig_b", "sketch"])

    return src.mapInArrow(run, "id long, n_shingles long, sig_a long, sig_b long, sketch array<int>")


def narrow(rows: DataFrame) -> DataFrame:
    """rows of ids and numbers, marked to be broadcast to a join with texts or sketches while they are few, so that these stay where they are."""
    return F.broadcast(rows) if rows.count() * len(rows.columns) <= MOST_BROADCAST else rows


def token(level: int) -> Column:
    """The minwise token of a document (tree, sketch) at the tree's coordinate of a level."""
    coordinate = F.pmod(F.xxhash64(F.lit(level * 7919 + 13), "tree"), F.lit(SKETCH)).cast("int") + 1
    return F.element_at("sketch", coordinate)


def planted(rows: DataFrame, trees: int, *more: str) -> DataFrame:
    """id, tree, path, `more`: the nodes of the first level of every tree, within the scopes of rows (id, scope, sketch, `more`)."""
    live = rows.select("id", "sketch", *more, F.explode(F.sequence(F.lit(0), F.lit(trees - 1))).alias("tree"), F.xxhash64("scope").alias("path"))
    return live.select("id", "tree", F.xxhash64("path", "tree", token(0)).alias("path"), *more)  # a child: by path, tree and token


def counted(live: DataFrame) -> DataFrame:
    """live with n, the documents of a row's node; nodes of one document, or of one part where live has parts, are left out."""
    parted = "part" in live.columns
    sizes = live.groupBy("path").agg(F.count("*").alias("n"), *([F.min("part").alias("lo"), F.max("part").alias("hi")] if parted else []))
    sizes = sizes.filter("lo < hi").select("path", "n") if parted else sizes.filter("n > 1")
    return live.join(sizes, "path")


def branched(live: DataFrame, sketch: DataFrame, limit: int, depth: int, level: int = 1) -> DataFrame:
    """path, id, part: the nodes in which branching of live (id, tree, path, part, n) ends.

    Nodes of at most `limit` documents end where they stand; the documents of the others go on to
    children, until `depth`. A node whose documents are all of one part ends with nothing to do. The
    tokens of all levels are fetched by one join, so that sketches are not sent level by level.
    """
    small = lambda rows: rows.filter(F.col("n") <= limit).select("path", "id", "part")
    ends, left = [small(live)], live.filter(F.col("n") > limit).select("id", "tree", "path", "part")
    while level < depth and not left.isEmpty():
        if "tokens" not in left.columns:
            tokens = F.array(*[token(i) for i in range(level, depth)])
            left = narrow(left).join(sketch.select("id", "sketch"), "id").select("id", "tree", "path", "part", tokens.alias("tokens"))
        down = left.select("id", "tree", F.xxhash64("path", "tree", F.element_at("tokens", 1)).alias("path"), "part", F.slice("tokens", 2, depth).alias("tokens"))
        live = written(counted(down))
        ends.append(small(live))
        left = live.filter(F.col("n") > limit).drop("n")
        level += 1
    out = left.select("path", "id", "part")
    for x in ends:
        out = out.unionByName(x)
    return out


def parted(rows: DataFrame, joined: DataFrame) -> DataFrame:
    """rows (id, ...) with part: the component of their id in joined (node, component), or the id itself."""
    return rows.join(joined.withColumnRenamed("node", "id"), "id", "left").withColumn("part", F.coalesce("component", "id")).drop("component")


def led_blocks(large: DataFrame, limit: int, leaders: int = 8) -> DataFrame:
    """node, id: large nodes (path, id, n) in blocks of about `limit` documents that share a few leaders."""
    heads = [F.min(F.struct(F.xxhash64(F.lit(j), "id", "path").alias("h"), "id")).getField("id") for j in range(leaders)]
    n_blocks = F.ceil(F.col("n") / limit).cast("int")
    led = large.groupBy("path").agg(F.first("n").alias("n"), F.array_distinct(F.array(*heads)).alias("heads"))
    led = led.select("path", "n", F.explode("heads").alias("id")).select("path", "id", F.explode(F.sequence(F.lit(0), n_blocks - 1)).alias("block"))
    own = large.select("path", "id", F.pmod(F.xxhash64("id", "path"), n_blocks).cast("int").alias("block"))
    return own.unionByName(led).distinct().select(F.xxhash64("path", "block").alias("node"), "id")


def crossings(placed: DataFrame, block: int) -> DataFrame:
    """node, id, part, first, second: tasks that hold every pair of documents of a node (path, id, part) that are of different parts.

    A task compares `first` documents with `second` ones. Of a node, the documents of its largest part
    are only `second`: with each other they are connected. The others, and they with the largest part,
    meet block by block.
    """
    placed = written(placed)
    parts = placed.groupBy("path", "part").agg(F.count("*").alias("n")).groupBy("path").agg(F.max(F.struct("n", "part")).alias("top"), F.sum("n").alias("n"))
    parts = parts.select("path", F.col("top.part").alias("top"), F.ceil((F.col("n") - F.col("top.n")) / block).cast("int").alias("rest"), F.ceil(F.col("top.n") / block).cast("int").alias("most"))
    dealt = placed.join(parts.filter("rest > 0"), "path").withColumn("is_top", F.col("part") == F.col("top"))
    at = F.pmod(F.xxhash64("id", "path"), F.when(F.col("is_top"), F.col("most")).otherwise(F.col("rest"))).cast("int")
    dealt = dealt.withColumn("at", at + F.when(F.col("is_top"), F.col("rest")).otherwise(0))
    every = F.sequence(F.lit(0), F.when(F.col("is_top"), F.col("rest")).otherwise(F.col("rest") + F.col("most")) - 1)
    dealt = dealt.select("path", "id", "part", "at", F.explode(every).alias("other"))
    i, j = F.least("at", "other"), F.greatest("at", "other")
    return dealt.select(F.xxhash64("path", i, j).alias("node"), "id", "part", (F.col("at") == i).alias("first"), (F.col("at") == j).alias("second"))


def forest(n: int, linked) -> Iterator[tuple[int, int]]:
    """Spanning edges (place, root) of n documents; linked(i, rest) tells which of `rest` are linked with i."""
    rest = np.arange(n)
    while len(rest) > 1:
        root, rest = rest[0], rest[1:]
        front = [root]
        while front and len(rest):
            hit = linked(front.pop(), rest)
            front.extend(rest[hit].tolist())
            for i in rest[hit]:
                yield int(i), int(root)
            rest = rest[~hit]


def bridged(part: np.ndarray, first: np.ndarray, second: np.ndarray, linked) -> Iterator[tuple[int, int]]:
    """Edges (place, place) that connect all parts of which a `first` document is linked with a `second` one."""
    part = np.unique(part, return_inverse=True)[1]
    places = np.arange(len(part))
    for i in np.flatnonzero(first):
        # of two documents that are both, one has been compared with the other
        rest = np.flatnonzero(second & (part != part[i]) & ~(first & second[i] & (places < i)))
        if not len(rest):
            continue
        hit = rest[linked(i, rest)]
        met, at = np.unique(part[hit], return_index=True)
        for k in hit[at]:
            yield int(i), int(k)
        part[np.isin(part, met)] = part[i]


def compared(rows: DataFrame, payload: str, make_linked, crossing: bool = False) -> DataFrame:
    """u, v: spanning edges of every node of rows (node, id, payload), node by node in sorted partitions.

    crossing: rows have part, first and second as made by crossings(), and only edges between parts are looked for.
    """
    more = ["part", "first", "second"] if crossing else []
    sorted_rows = rows.select("node", "id", payload, *more).repartition("node").sortWithinPartitions("node", "id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: pa.Table | None = None

        def work(t: pa.Table) -> pa.RecordBatch:
            node, ids = t["node"].to_numpy(), t["id"].to_numpy()
            cuts = np.flatnonzero(np.concatenate([[True], node[1:] != node[:-1], [True]]))
            u, v = [], []
            column, sides = t[payload].combine_chunks(), [t[c].to_numpy() for c in more]
            for a, b in zip(cuts[:-1], cuts[1:], strict=True):
                if b - a > 1:
                    linked = make_linked(column.slice(a, b - a))
                    for i, root in bridged(*(x[a:b] for x in sides), linked) if crossing else forest(b - a, linked):
                        u.append(ids[a + i])
                        v.append(ids[a + root])
            return pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])

        for batch in batches:
            if not batch.num_rows:
                continue
            t = pa.Table.from_batches([batch])
            t = pa.concat_tables([kept, t]).combine_chunks() if kept is not None else t
            node = t["node"].to_numpy()
            last = int(np.searchsorted(node, node[-1]))
            if last:
                yield work(t.slice(0, last))
            kept = t.slice(last)
        if kept is not None:
            yield work(kept)

    return sorted_rows.mapInArrow(run, "u long, v long")


def near_duplicates(
    docs: DataFrame, k: int = 5, percent: int = 80, trees: int = 12, limit: int = 64, group: int = 1000, depth: int = 4, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """id_col, n_shingles, component_id (least id reachable by links of `percent` or more), kept, for every row."""
    meta = written(described(docs, k, id_col, text_col))
    full = meta.filter(F.col("id").isNotNull() & (F.col("n_shingles") > 0))
    sig = ["sig_a", "sig_b", "n_shingles"]
    reps = written(full.groupBy(*sig).agg(F.min(F.struct("id", "sketch")).alias("least")).select(*sig, "least.*"))
    # an id with several different texts may stand for several classes; such an id links them
    twice = full.select("id", *sig).distinct().groupBy("id").agg(F.count("*").alias("n")).filter("n > 1")
    through = full.join(twice.select("id"), "id", "left_semi").join(reps.select(*sig, F.col("id").alias("rep")), sig).select(F.col("id").alias("u"), F.col("rep").alias("v"))
    lead = reps.select("id", "sketch")
    scoped = lead.withColumn("scope", F.lit(0))

    bar = percent / 100 - 4.5 * np.sqrt(percent / 100 * (1 - percent / 100) / SKETCH)
    least = int(np.floor(max(bar, 0.05) * SKETCH))

    def by_sketch(column: pa.Array):
        s = np.asarray(column.flatten()).reshape(len(column), SKETCH)
        return lambda i, rest: (s[rest] == s[i]).sum(1) >= least

    met = written(counted(planted(scoped, trees)))
    near = met.filter(F.col("n") <= limit).select(F.col("path").alias("node"), "id")
    large = met.filter(F.col("n") > limit)
    if large.isEmpty():
        coarse = components(compared(near.join(lead, "id"), "sketch", by_sketch))
    else:  # what shared leaders connect needs no further comparison; nodes with several parts are branched
        edges = written(compared(near.unionByName(led_blocks(large.select("path", "id", "n"), limit)).join(lead, "id"), "sketch", by_sketch))
        live = written(counted(parted(large.select("id", "tree", "path"), components(edges))))
        across = narrow(written(crossings(branched(live, lead, limit, depth), group)))
        coarse = components(edges.unionByName(compared(across.join(lead, "id"), "sketch", by_sketch, True)))

    def by_set(column: pa.Array):
        data, offsets = text_bytes(column)
        values, at = shingles(data, offsets, k)
        own = [values[at[i] : at[i + 1]] for i in range(len(column))]
        sizes = np.diff(at)

        def linked(i: int, rest: np.ndarray) -> np.ndarray:
            # one binary search of all members' shingles in document i's
            some = np.concatenate([own[j] for j in rest]) if len(rest) else values[:0]
            place = np.minimum(np.searchsorted(own[i], some), len(own[i]) - 1)
            hits = np.concatenate([[0], np.cumsum(own[i][place] == some)])
            ends = np.concatenate([[0], np.cumsum(sizes[rest])])
            both = hits[ends[1:]] - hits[ends[:-1]]
            return 100 * both >= percent * (sizes[i] + sizes[rest] - both)

        return linked

    sizes = coarse.groupBy("component").agg(F.count("*").alias("n"))
    placed = written(coarse.join(sizes, "component").withColumnRenamed("node", "id"))
    small = placed.filter(F.col("n") <= group).select(F.xxhash64("component").alias("node"), "id")
    big = placed.filter(F.col("n") > group)
    cut = not big.isEmpty()
    if cut:
        small = written(small.unionByName(led_blocks(big.select(F.col("component").alias("path"), "id", "n"), group)))
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    confirmed = compared(texts.join(narrow(small), "id"), "text", by_set)
    if cut:
        confirmed = written(confirmed)
        rows = parted(big.select("id", F.col("component").alias("scope")), components(confirmed.unionByName(through)))
        several = rows.groupBy("scope").agg(F.min("part").alias("lo"), F.max("part").alias("hi")).filter("lo < hi").select("scope")
        live = written(counted(planted(rows.join(several, "scope", "left_semi").join(lead, "id"), trees, "part")))
        across = narrow(written(crossings(branched(live, lead, group, depth), group)))
        confirmed = confirmed.unionByName(compared(texts.join(across, "id"), "text", by_set, True))
    if cut or not twice.isEmpty():
        linked = components(confirmed.unionByName(through))
    else:  # every group was compared as a whole, so that its edges are stars around least ids already
        linked = confirmed.select(F.col("u").alias("node"), F.col("v").alias("component")).filter("node <> component").distinct()
    final = reps.join(linked.withColumnRenamed("node", "id"), "id", "left").select(*sig, F.coalesce("component", "id").alias("component_id"))
    out = meta.select("id", *sig).join(final, sig, "left")
    component = F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id"))
    return out.select(F.col("id").alias(id_col), "n_shingles", component.alias("component_id"), F.coalesce(F.col("id") == component, F.lit(True)).alias("kept"))


def deduplicated(docs: DataFrame, id_col: str = "doc_id", **options) -> DataFrame:
    """docs with one document of each group left: that of the smallest id; of rows that repeat an id, one."""
    found = near_duplicates(docs, id_col=id_col, **options)
    # an id with a kept row is kept; those without are the fewer, and null ids are never among them
    gone = written(found.groupBy(F.col(id_col).alias("__wm_id")).agg(F.max("kept").alias("kept")).filter("NOT kept").select("__wm_id"))
    out = docs.join(narrow(gone), F.col(f"`{id_col}`") == F.col("__wm_id"), "left_anti")
    repeated = written(docs.groupBy(id_col).count().filter(F.col("count") > 1).select(F.col(id_col).alias("__wm_id")).filter("__wm_id is not null"))
    if repeated.isEmpty():
        return out
    repeated, again = narrow(repeated), F.col(f"`{id_col}`") == F.col("__wm_id")
    return out.join(repeated, again, "left_anti").unionByName(out.join(repeated, again, "left_semi").dropDuplicates([id_col]))
