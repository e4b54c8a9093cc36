"""Quality classifier: cumulative-link (proportional odds) regression on graded ratings.

P(grade > k) = sigmoid(s - threshold_k), with one shared score s for all grades: the summed weights
of a text's byte-trigram buckets and of one bucket for words that repeat the word before, over the
text's length plus PRIOR (so that a few odd words of a short text weigh little). Thresholds are ordered by construction (a first one and positive
gaps). A text's expected grade and its tail probability P(grade >= accept) are returned; texts
with a tail below `keep` are rejected.

The fit uses a bounded sample of labelled rows, `per_grade` of each grade; scoring covers all rows
and whole texts.

Defined cases: a null or empty text scores its bias alone (s = 0) and is kept or rejected by that;
with no labelled row nothing is rejected (tail 1, the expected grade null); a label of an unknown
grade is ignored; of several labels of an id the lowest grade holds; extra columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BLOCK, appended, blocks, text_bytes, word_hashes
from .learning import Adam, labelled_sample, sigmoid, trigram_buckets

BITS, SCALE, PRIOR = 16, 100.0, 200
REPEAT = 1 << BITS  # the bucket of repeated words
_SPACE = np.zeros(256, bool)
_SPACE[[32, *range(9, 14)]] = True


def repeats(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """For each row, the words that equal the word before them."""
    h, first = word_hashes(data, offsets, _SPACE)
    same = np.concatenate([[False], h[1:] == h[:-1]]) if len(h) else np.zeros(0, bool)
    same[first[:-1][first[:-1] < len(h)]] = False
    total = np.concatenate([[0], np.cumsum(same)])
    return total[first[1:]] - total[first[:-1]]


def bags(sample: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(buckets, frequencies, first bucket of each row, grades) of a labelled sample."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column(0))
            for i in range(batch.num_rows):
                text = data[offsets[i] : offsets[i + 1]]
                u, n = np.unique(trigram_buckets(text, BITS), return_counts=True) if len(text) > 2 else (np.zeros(0, int), np.zeros(0))
                u, n = np.append(u, REPEAT), np.append(n, repeats(text, np.array([0, len(text)])))
                yield pa.RecordBatch.from_pydict({"grade": batch.column(1).slice(i, 1), "u": pa.array([u.astype(np.int32)], pa.list_(pa.int32())), "f": pa.array([(n / (PRIOR + len(text))).astype(np.float32)], pa.list_(pa.float32()))})

    got = sample.select("text", F.col("grade").cast("int")).mapInArrow(run, "grade int, u array<int>, f array<float>").toArrow()
    grade = got["grade"].to_numpy()
    first = np.concatenate([[0], np.cumsum(pc.list_value_length(got["u"]).to_numpy())])
    u, f = (np.asarray(pc.list_flatten(got[c].combine_chunks() if got.num_rows else got[c])) for c in ("u", "f"))
    return u, f, first, grade


def fit(u: np.ndarray, f: np.ndarray, first: np.ndarray, grade: np.ndarray, grades: int, rounds: int = 80, rate: float = 0.08, l2: float = 1e-6, step: int = 256) -> tuple[np.ndarray, np.ndarray]:
    """(weights, ordered thresholds) by full-batch Adam on the cumulative-link likelihood, rows weighted alike; `step` rows at a time are held unpacked."""
    w, t = np.zeros(REPEAT + 1), np.concatenate([[-1.0], np.zeros(grades - 2)])
    share = 1 / len(grade)
    a, b = Adam(len(w), rate), Adam(len(t), rate)
    for _ in range(rounds):
        th = np.cumsum(np.concatenate([t[:1], np.exp(t[1:])]))
        g, g_th = l2 * w, np.zeros(grades - 1)
        for lo in range(0, len(grade), step):
            at, y = first[lo : lo + step + 1], grade[lo : lo + step]
            places, values = u[at[0] : at[-1]], f[at[0] : at[-1]] * SCALE
            # every row has a bucket at least, that of repeated words
            s = np.add.reduceat(values * w[places], at[:-1] - at[0])
            tail = np.column_stack([np.ones(len(s)), sigmoid(s[:, None] - th), np.zeros(len(s))])
            i = np.arange(len(s))
            hi, lo_tail = tail[i, y], tail[i, y + 1]
            p = np.maximum(hi - lo_tail, 1e-12)
            d_hi, d_lo = share * hi * (1 - hi) / p, share * lo_tail * (1 - lo_tail) / p
            g += np.bincount(places, values * np.repeat(d_lo - d_hi, np.diff(at)), len(w))
            g_th += np.bincount(y, d_hi, grades)[1:] - np.bincount(y, d_lo, grades)[:-1]
        g_t = np.cumsum(g_th[::-1])[::-1]
        g_t[1:] *= np.exp(t[1:])
        a.step(w, g)
        b.step(t, g_t)
    return w.astype(np.float32) * np.float32(SCALE), np.cumsum(np.concatenate([t[:1], np.exp(t[1:])]))


def quality(
    docs: DataFrame, labels: DataFrame, grades: int = 3, accept: int = 1, keep: float = 0.2, per_grade: int = 2000, text_col: str = "text", id_col: str = "doc_id"
) -> DataFrame:
    """docs with quality_grade (expected), quality_tail and quality_rejected added. labels: id and an integer grade from 0."""
    known = labels.filter(F.col("grade").between(0, grades - 1)).groupBy(id_col).agg(F.min("grade").cast("string").alias("grade"))
    u, f, first, grade = bags(labelled_sample(docs, known, {str(g): per_grade for g in range(grades)}, text_col, id_col))
    model = fit(u, f, first, grade, grades) if len(grade) else None
    del u, f, first, grade
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def kernel(texts: pa.Array) -> list[pa.Array]:
        got = shared.value
        n = len(texts)
        grade, tail = np.full(n, np.nan), np.ones(n)
        if got:
            w, th = got
            data, offsets = text_bytes(texts)
            s = np.zeros(n)
            for a, b in blocks(offsets, BLOCK):
                x = data[offsets[a] : offsets[b]]
                sums = np.zeros(len(x) + 1)
                if len(x) > 2:
                    np.cumsum(w[trigram_buckets(x, BITS)], dtype=float, out=sums[1:-2])
                lo = offsets[a:b] - offsets[a]
                hi = np.maximum(offsets[a + 1 : b + 1] - offsets[a] - 2, lo)
                s[a:b] = (sums[hi] - sums[lo] + w[REPEAT] * repeats(x, offsets[a : b + 1] - offsets[a])) / (PRIOR + np.diff(offsets[a : b + 1]))
            tails = sigmoid(s[:, None] - th)
            grade, tail = tails.sum(1), tails[:, accept - 1]
        return [pa.array(grade, from_pandas=True), pa.array(tail), pa.array(tail < keep)]

    fields = [("quality_grade", "double"), ("quality_tail", "double"), ("quality_rejected", "boolean")]
    return appended(docs, fields, kernel, text_col)


def graded(labels: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Grades of the labels table: 0 poor; 1 good but toxic; 2 good. A row without a quality mark has no grade (null); without a toxicity mark a good row is not toxic."""
    good, toxic = F.col("quality") > 0, F.coalesce(F.col("toxic"), F.lit(0)) > 0
    return labels.select(id_col, F.when(~good, 0).when(good & toxic, 1).when(good, 2).alias("grade"))
