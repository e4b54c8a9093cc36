"""Approximate nearest neighbours by randomly rotated one-bit codes.

A vector is scaled to unit length and turned by a random rotation (seeded, one per dimension). Its
code is the packed signs of the turned vector; two scalars go with it: the inner product c of the
turned vector with its code's unit vector, and the vector's length. For a unit query q (turned
likewise), <code, q> / c estimates the cosine without bias, and with high probability the error is
at most eps * sqrt((1 - c^2) / c^2) / sqrt(D - 1). A query keeps every vector whose upper bound
reaches the k-th best lower bound of its batch and the k-th best score so far; those are reranked by
the cosine of the original vectors in double precision. Estimates come from the packed bits by table
look-ups: a table per query and code byte holds the inner product of each of 256 byte values.

Every row is indexed. The stated query set is searched against all rows in blocks: queries are cut
into hash blocks of at most `block_bytes`, each of which is small enough to be sent to all
executors, and each block is searched in one pass over the index and its result written, so that only
one block is held at a time. A task keeps at most k rows a query, and those are merged by query.

Defined cases: vectors that are null, empty, zero or hold null or non-finite components take no
part; vectors of another dimension than the query's are no candidates; ties go to the smaller id;
a repeated id counts once as a query (its least vector) and no row of that id is its candidate; as
a candidate a repeated id counts once, with its best row, and takes one of the k places; rows
with a null id take no part; an empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

EPS = 3.0


@cache
def rotation(dim: int, seed: int = 5) -> np.ndarray:
    """A random orthogonal matrix."""
    q, r = np.linalg.qr(np.random.default_rng([seed, dim]).standard_normal((dim, dim)))
    return (q * np.sign(np.diag(r))).astype(np.float32)


def unit(x: np.ndarray) -> np.ndarray:
    """Rows over their largest component (so that no square overflows) and then over their length."""
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt((x * x).sum(1, keepdims=True))


def encode(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(packed sign bits, inner product of each turned unit vector with its code) of double rows."""
    turned = unit(x).astype(np.float32) @ rotation(x.shape[1]).T
    return np.packbits(turned > 0, axis=1), np.abs(turned).sum(1) / np.sqrt(np.float32(x.shape[1]))


#: For each byte of a code, its eight signs.
_SIGNS = (np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1).astype(np.float32) * 2 - 1).T.copy()


def query_tables(turned: np.ndarray) -> np.ndarray:
    """For each byte position and byte value, the inner product of that part of a turned query (rows) with the code's eight signs."""
    n, dim = turned.shape
    padded = np.zeros((n, -(-dim // 8) * 8), np.float32)
    padded[:, :dim] = turned
    # (byte position, byte value, query): one row of additions for a code byte
    return np.ascontiguousarray(np.einsum("qbj,jv->bvq", padded.reshape(n, -1, 8), _SIGNS)) / np.sqrt(np.float32(dim))


def estimated(codes: np.ndarray, cs: np.ndarray, tables: np.ndarray) -> np.ndarray:
    """Estimated cosines of packed codes (rows) with queries (columns), by table look-ups per byte; codes are never unpacked."""
    out = tables[0, codes[:, 0]]
    for b in range(1, codes.shape[1]):
        out += tables[b, codes[:, b]]
    return out / cs[:, None]


def exact_cosine(x: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Cosines of rows of x and of q, in double precision, each sum taken component by component."""
    s = lambda a: np.add.accumulate(a, axis=1)[:, -1]
    return s(x * q) / (np.sqrt(s(x * x)) * np.sqrt(s(q * q)))


def usable(rows: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """id and vec (double array) of the rows that take part."""
    v: Column = F.col(vec_col).cast("array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))) & F.exists(v, lambda x: x != 0)
    return rows.select(F.col(id_col).cast("long").alias("id"), v.alias("vec")).filter(F.col("id").isNotNull() & (F.size("vec") > 0) & fine)


def index(rows: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """id, dim, vec, code, c of every usable row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vec = batch.column(1)
            dims = np.diff(np.asarray(vec.offsets))
            codes, cs = [b""] * len(dims), np.zeros(len(dims), np.float32)
            flat, starts = np.asarray(vec.values), np.asarray(vec.offsets)[:-1]
            for d in np.unique(dims):
                at = np.flatnonzero(dims == d)
                packed, c = encode(flat[starts[at, None] + np.arange(d)])
                cs[at] = c
                for i, p in zip(at, packed, strict=True):
                    codes[i] = p.tobytes()
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(dims, pa.int32()), vec, pa.array(codes, pa.binary()), pa.array(cs)], names=["id", "dim", "vec", "code", "c"])

    return usable(rows, id_col, vec_col).mapInArrow(run, "id long, dim int, vec array<double>, code binary, c float")


def top(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the k best distinct ids: largest score, then smallest id; of an id's rows the best."""
    order = np.lexsort((ids, -scores))
    if len(order) > k:  # the first row of each id, in order
        _, at = np.unique(ids[order], return_index=True)
        order = order[np.sort(at)]
    return order[:k]


def norms(x: np.ndarray) -> np.ndarray:
    return np.sqrt(np.add.accumulate(x * x, axis=1)[:, -1])


class Best:
    """The k best distinct ids of each of n queries so far, best first."""

    def __init__(self, n: int, k: int):
        self.k, self.ids, self.scores = k, [np.zeros(0, np.int64)] * n, [np.zeros(0)] * n
        self.bar = np.full(n, -np.inf)

    def add(self, j: int, ids: np.ndarray, scores: np.ndarray) -> None:
        ids, scores = np.concatenate([self.ids[j], ids]), np.concatenate([self.scores[j], scores])
        keep = top(ids, scores, self.k)
        self.ids[j], self.scores[j] = ids[keep], scores[keep]
        if len(keep) == self.k:
            self.bar[j] = scores[keep[-1]]


def search_batch(ids, vecs, codes, cs, q_ids, q_vecs, q_turned, best: Best, first: int) -> None:
    """Adds to `best`, from query `first` on, what a batch of one dimension and of distinct ids holds.

    A row is reranked if its upper bound reaches both the k-th best lower bound of the batch and the
    k-th best exact score so far: k other ids are better than any row that is left out.
    """
    dim, k = vecs.shape[1], best.k
    estimate = estimated(codes, cs, query_tables(q_turned))
    slack = (EPS * np.sqrt(np.maximum(1 - cs * cs, 0)) / cs / np.sqrt(max(dim - 1, 1)) + 1e-5)[:, None]
    estimate[ids[:, None] == q_ids[None, :]] = -np.inf
    bar = best.bar[first : first + len(q_ids)]
    if len(ids) > k:
        bar = np.maximum(bar, np.partition(estimate - slack, len(ids) - k, axis=0)[len(ids) - k])
    estimate += slack
    query, row = np.nonzero(((estimate >= bar) & (estimate > -np.inf)).T)
    long, q_long = norms(vecs), norms(q_vecs)
    for lo in range(0, len(row), 8192):
        r, j = row[lo : lo + 8192], query[lo : lo + 8192]
        scores = np.add.accumulate(vecs[r] * q_vecs[j], axis=1)[:, -1] / (long[r] * q_long[j])
        cuts = np.flatnonzero(np.concatenate([[True], j[1:] != j[:-1], [True]]))
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            best.add(first + int(j[a]), ids[r[a:b]], scores[a:b])


def layers(ids: np.ndarray) -> list[np.ndarray]:
    """Places of a batch in groups of distinct ids: the first row of each id, the second, and so on."""
    order = np.argsort(ids, kind="stable")
    start = np.flatnonzero(np.concatenate([[True], ids[order][1:] != ids[order][:-1]])) if len(ids) else np.zeros(0, int)
    nth = np.arange(len(ids)) - np.repeat(start, np.diff(np.append(start, len(ids))))
    return [np.sort(order[nth == i]) for i in range(int(nth.max()) + 1)] if len(ids) else []


def nearest(
    rows: DataFrame, queries: DataFrame, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding", block_bytes: int = 32 << 20
) -> DataFrame:
    """query_id, rank, vec_id, score: each query's k nearest rows found, its own id left out."""
    spark = rows.sparkSession
    indexed = written(index(rows, id_col, vec_col))
    asked = usable(queries, id_col, vec_col)
    asked = written(asked.groupBy("id").agg(F.min("vec").alias("vec")))
    size = asked.agg(F.count("*"), F.max(F.size("vec"))).first()
    n_blocks = max(1, -(-int(size[0]) * int(size[1] or 1) * 12 * 5 // (4 * block_bytes)))
    found = None
    for block in range(n_blocks):
        part = asked.filter(F.pmod(F.xxhash64("id"), F.lit(n_blocks)) == block).toArrow()
        q_ids = part["id"].to_numpy()
        by_dim: dict[int, tuple] = {}
        lengths = pc.list_value_length(part["vec"]).to_numpy()
        for d in np.unique(lengths):
            at = np.flatnonzero(lengths == d)
            x = np.asarray(pc.list_flatten(part["vec"].take(pa.array(at))).combine_chunks()).reshape(len(at), d)
            by_dim[int(d)] = (q_ids[at], x, unit(x).astype(np.float32) @ rotation(int(d)).T)
        shared = spark.sparkContext.broadcast(by_dim)
        del part, by_dim

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            best = {d: Best(len(x[0]), k) for d, x in shared.value.items()}
            for batch in batches:
                dims = np.asarray(batch.column(1))
                flat, starts = np.asarray(batch.column(2).values), np.asarray(batch.column(2).offsets)[:-1]
                for d in np.unique(dims):
                    if int(d) not in best:
                        continue
                    qi, qv, qt = shared.value[int(d)]
                    mine = np.flatnonzero(dims == d)
                    for r in range(0, len(mine), 4096):
                        for layer in layers(np.asarray(batch.column(0))[mine[r : r + 4096]]):
                            at = mine[r : r + 4096][layer]
                            ids, vecs = np.asarray(batch.column(0))[at], flat[starts[at, None] + np.arange(d)]
                            codes = np.frombuffer(b"".join(batch.column(3).take(pa.array(at)).to_pylist()), np.uint8).reshape(len(at), -1)
                            cs = np.asarray(batch.column(4))[at]
                            for q in range(0, len(qi), 256):
                                search_batch(ids, vecs, codes, cs, qi[q : q + 256], qv[q : q + 256], qt[q : q + 256], best[int(d)], q)
            for d, b in best.items():
                sizes = [len(x) for x in b.ids]
                if sum(sizes):
                    yield pa.RecordBatch.from_arrays([pa.array(np.repeat(shared.value[d][0], sizes)), pa.array(np.concatenate(b.ids)), pa.array(np.concatenate(b.scores))], names=["query_id", "vec_id", "score"])

        out = indexed.select("id", "dim", "vec", "code", "c").mapInArrow(run, "query_id long, vec_id long, score double")
        # an id's best row stands for it; a query is in one block only, so a block's ranks are final
        out = out.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
        by = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        out = written(out.withColumn("rank", F.row_number().over(by)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score"))
        shared.destroy()
        found = out if found is None else found.unionByName(out)
    return found
