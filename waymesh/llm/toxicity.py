"""Toxicity: multiple-instance learning over sentences.

A document is a bag of sentences. A sentence's probability is logistic in the weights of its hashed
words and of the byte 5-grams within words; the document's is the noisy-or of its sentences',
1 - prod(1 - p). Weights are trained from document labels alone through that noisy-or, so that the
trained model also says which sentences offend.

The fit uses a bounded sample of labelled rows, `positives` and `negatives` of them at most; scoring
covers all rows and whole texts. Only buckets whose share of toxic documents differs from that of
others by `least_z` standard errors carry weight, which keeps noise out of the sum and the
training set small.

Defined cases: a null or empty text has no sentence and scores 0; with no positive label everything
scores 0; of several labels of an id the highest holds; ties and repeated rows score alike; extra
columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER, U64, appended, blocks, mix, text_bytes, word_hashes
from .learning import Adam, labelled_sample, sigmoid

BITS, GRAM = 18, 5
_WORD = np.zeros(256, bool)  # separators of words: ASCII that is neither letter nor digit
_WORD[:128] = True
_WORD[[*range(48, 58), *range(65, 91), *range(97, 123)]] = False
_STOP = np.zeros(256, bool)
_STOP[[ord(c) for c in ".!?\n\r"]] = True


def sentences(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, first sentence of each row, feature buckets, first feature of each sentence) of lower-cased bytes."""
    n = len(data)
    cut = np.zeros(n + 1, bool)
    cut[offsets] = True
    cut[1:] |= _STOP[data]
    start = np.flatnonzero(cut[:-1])
    end = np.concatenate([start[1:], [n]]) if len(start) else start
    words = ~_WORD[data]
    has = np.concatenate([[0], np.cumsum(words)])
    ok = has[end] > has[start]
    start, end = start[ok], end[ok]
    h, first = word_hashes(data, np.concatenate([start, [n]]) if len(start) else np.array([0, 0]), _WORD)
    at = np.zeros(len(h), np.int64)
    begin = np.flatnonzero(words & np.concatenate([[True], ~words[:-1] | cut[1:-1]])) if n else at
    at[:] = begin[: len(h)]
    word = (h >> U64(64 - BITS)).astype(np.int32)
    if n >= GRAM:
        x = data.astype(np.uint64)
        g = sum(x[k : n - GRAM + 1 + k] << U64(8 * k) for k in range(GRAM))
        run = np.concatenate([[0], np.cumsum(words)])
        inside = np.flatnonzero(run[GRAM:] - run[:-GRAM] == GRAM)
        gram = (mix(g[inside]) >> U64(64 - BITS)).astype(np.int32)
    else:
        inside, gram = np.zeros(0, np.int64), np.zeros(0, np.int32)
    place = np.concatenate([at, inside])
    order = np.argsort(place, kind="stable")
    return start, end, np.searchsorted(start, offsets), np.concatenate([word, gram])[order], np.searchsorted(place[order], np.concatenate([start, [n]]))


def _sums(w: np.ndarray, feature: np.ndarray, first: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0.0], np.cumsum(w[feature], dtype=float)])
    return total[first[1:]] - total[first[:-1]]


def telling(sample: DataFrame, least_z: float) -> np.ndarray:
    """Buckets whose document frequency tells toxic documents from others, from counts summed by Spark."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, 1 << BITS), np.int64)
        docs = np.zeros(2, np.int64)
        for batch in batches:
            data, offsets = text_bytes(batch.column(0))
            grades = batch.column(1).to_numpy()
            for i in range(batch.num_rows):
                part = LOWER[data[offsets[i] : offsets[i + 1]]]
                total[grades[i], np.unique(sentences(part, np.array([0, len(part)]))[3])] += 1
                docs[grades[i]] += 1
        some = np.flatnonzero(total.sum(0))
        yield pa.RecordBatch.from_arrays([pa.array(np.append(some, -1)), pa.array(np.append(total[0][some], docs[0])), pa.array(np.append(total[1][some], docs[1]))], names=["bucket", "clean", "toxic"])

    got = sample.select("text", F.col("grade").cast("int")).mapInArrow(run, "bucket long, clean long, toxic long")
    got = got.groupBy("bucket").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")).toArrow().to_pandas()
    whole = got[got.bucket < 0]
    n0, n1 = float(whole.clean.sum()), float(whole.toxic.sum())
    if not n0 or not n1:
        return np.zeros(0, np.int64)
    p = (got.clean + got.toxic) / (n0 + n1)
    z = (got.toxic / n1 - got.clean / n0) / np.sqrt(np.maximum(p * (1 - p), 1e-12) * (1 / n0 + 1 / n1))
    return got.bucket[(got.bucket >= 0) & (z.abs() >= least_z)].to_numpy()


def bags(sample: DataFrame, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(features, first feature of each sentence, document of each sentence, document labels), chosen buckets only."""
    use = np.zeros(1 << BITS, bool)
    use[chosen] = True

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = text_bytes(batch.column(0))
            features, sizes = [], []
            for i in range(batch.num_rows):
                part = LOWER[data[offsets[i] : offsets[i + 1]]]
                _, _, _, feature, first = sentences(part, np.array([0, len(part)]))
                kept = np.concatenate([[0], np.cumsum(use[feature])])[first]
                features.append(feature[use[feature]])
                sizes.append(np.diff(kept).astype(np.int32))
            yield pa.RecordBatch.from_arrays([batch.column(1), pa.array(features, pa.list_(pa.int32())), pa.array(sizes, pa.list_(pa.int32()))], names=["grade", "feature", "size"])

    got = sample.select("text", F.col("grade").cast("int")).mapInArrow(run, "grade int, feature array<int>, size array<int>").toArrow()
    y = got["grade"].to_numpy()
    flat = lambda name: np.concatenate([np.zeros(0, np.int32), *(np.asarray(c.flatten(), np.int32) for c in got[name].chunks)])
    size = flat("size")
    doc = np.repeat(np.arange(len(y)), [len(x) for x in got["size"]])
    return flat("feature"), np.concatenate([[0], np.cumsum(size)]), doc, y


def fit(feature: np.ndarray, first: np.ndarray, doc: np.ndarray, y: np.ndarray, rounds: int = 150, rate: float = 0.1, l2: float = 1e-6) -> tuple[np.ndarray, float]:
    """(weights, bias) by full-batch Adam through the noisy-or, both labels weighted alike."""
    w, bias = np.zeros(1 << BITS), np.full(1, -5.0)
    sentence = np.repeat(np.arange(len(doc), dtype=np.int32), np.diff(first))
    share = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y == 0).sum()))
    a, b = Adam(len(w), rate), Adam(1, rate)
    for _ in range(rounds):
        p = sigmoid(_sums(w, feature, first) + bias)
        total = -np.expm1(np.bincount(doc, np.log1p(-np.minimum(p, 1 - 1e-12)), len(y)))
        total = np.clip(total, 1e-9, 1 - 1e-9)
        g = (share * np.where(y > 0, -(1 - total) / total, 1.0))[doc] * p
        a.step(w, np.bincount(feature, g[sentence], len(w)) + l2 * w)
        b.step(bias, g.sum(keepdims=True))
    return w.astype(np.float32), float(bias[0])


def toxicity(
    docs: DataFrame, labels: DataFrame, positives: int = 4000, negatives: int = 6000, least_z: float = 4.0, text_col: str = "text", id_col: str = "doc_id", label_col: str = "toxic", spans: bool = False, offending: float = 0.5
) -> DataFrame:
    """docs with toxicity added; with spans also toxic_spans, the UTF-8 byte ranges of sentences of probability `offending` or more."""
    known = labels.filter(F.col(label_col).isNotNull()).groupBy(id_col).agg(F.max((F.col(label_col) > 0).cast("int")).cast("string").alias("grade"))
    sample = labelled_sample(docs, known, {"1": positives, "0": negatives}, text_col, id_col)
    feature, first, doc, y = bags(sample, telling(sample, least_z))
    model = fit(feature, first, doc, y) if len(y) and y.any() else None
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def kernel(texts: pa.Array) -> list[pa.Array]:
        got = shared.value
        score, found = np.zeros(len(texts)), [[] for _ in range(len(texts))]
        data, offsets = text_bytes(texts)
        for a, b in blocks(offsets) if got else ():
            part = LOWER[data[offsets[a] : offsets[b]]]
            start, end, of, buckets, at_feature = sentences(part, offsets[a : b + 1] - offsets[a])
            p = sigmoid(_sums(got[0], buckets, at_feature) + got[1])
            total = np.concatenate([[0.0], np.cumsum(np.log1p(-np.minimum(p, 1 - 1e-12)))])
            score[a:b] = -np.expm1(total[of[1:]] - total[of[:-1]])
            if spans:
                row = np.searchsorted(of, np.arange(len(p)), "right") - 1
                for k in np.flatnonzero(p >= offending):
                    base = offsets[a + row[k]] - offsets[a]
                    found[a + row[k]].append({"start": int(start[k] - base), "end": int(end[k] - base), "p": float(p[k])})
        cols = [pa.array(np.clip(score, 0, 1) + 0.0)]
        if spans:
            cols.append(pa.array(found, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("p", pa.float64())]))))
        return cols

    fields = [("toxicity", "double"), ("toxic_spans", "array<struct<start:bigint,end:bigint,p:double>>")]
    return appended(docs, fields[: 1 + spans], kernel, text_col)
