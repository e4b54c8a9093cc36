"""Language ID: an interpolated Kneser-Ney character model per language.

Texts are lower-cased; letters keep their code point (16 bits; higher planes fold into the private
area), everything else is a blank and runs of blanks count once. The counts of all 4-grams of all
training rows are summed by Spark; lower orders use continuation counts. A language's orders are
sorted arrays of packed n-gram codes (the hashes) with log-probabilities and back-off weights,
found by binary search. The language of least cross-entropy per character wins.

Calibrated rejection: from all training counts, each language has its mean and variance of
-log2 p. A text is rejected if its best cross-entropy exceeds mean + z * sqrt(variance / n) + slack,
or if no letter is in it.

Every count is kept, whatever the size of the corpus: no n-gram of a rare language makes way for one of
a frequent language, and discounts, lower orders and calibration see all of them. The model is built
on the driver and broadcast, so its memory grows with the distinct 4-grams of the corpus.

Defined cases: null text, or one without a letter: `und`, score 0, rejected; rows with null language
or id train nothing; with no training row at all everything is `und`; ties go to the
alphabetically first language; repeated rows count as often as they stand.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BLOCK, U64, appended, blocks, dropped, text_bytes, written

ORDER, BLANK, UND = 4, 32, "und"


def held_out(id_col: str = "doc_id") -> Column:
    """True for the third of rows that learning never sees."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


@cache
def _letters() -> np.ndarray:
    """For each 16-bit code: itself if it is a letter, else a blank."""
    return np.array([c if chr(c).isalpha() else BLANK for c in range(1 << 16)], np.uint64)


def _codes(points: np.ndarray) -> np.ndarray:
    high = np.flatnonzero(points > 0xFFFF)
    out = _letters()[np.minimum(points, 0xFFFF)]
    for i in high:
        out[i] = 0xE000 + int(points[i]) % 6400 if chr(points[i]).isalpha() else BLANK
    return out


DENSE = 1 << 23
PARTS = 8  # blocks whose counts are held apart before they are summed


def grams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(distinct packed 4-grams, place of each 4-gram among them, first 4-gram of each row) of rows of lower-cased UTF-8.

    A block's alphabet is small as a rule: then a 4-gram is a number in base alphabet and a direct
    table finds the distinct ones; otherwise they are sorted.
    """
    points = np.frombuffer(data.tobytes().decode("utf-8", "replace").encode("utf-32-le"), np.uint32)
    at = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])[offsets]
    c = _codes(points)
    used = np.flatnonzero(np.bincount(c.astype(np.intp), minlength=1 << 16)) if len(c) else np.array([BLANK])
    if BLANK not in used:
        used = np.sort(np.append(used, BLANK))
    base = len(used)
    small = base**ORDER <= DENSE
    if small:
        rank = np.zeros(1 << 16, np.int32)
        rank[used] = np.arange(base)
        c, blank, times = rank[c.astype(np.intp)], rank[BLANK], [np.int32(base**k) for k in range(ORDER)]
    else:
        blank, times = U64(BLANK), [U64(1 << (16 * k)) for k in range(ORDER)]
    key, sizes = c.copy(), np.diff(at)
    for back in range(1, ORDER):
        before = np.full(len(c), blank, c.dtype)
        before[back:] = c[:-back]
        for k in range(back):  # the first characters of a row follow blanks
            before[at[:-1][sizes > k] + k] = blank
        key += before * times[back]
        if back == 1:
            keep = (c != blank) | (before != blank)
    kept = np.concatenate([[0], np.cumsum(keep)])[at]
    key = key[keep]
    if not small:
        u, inv = np.unique(key, return_inverse=True)
        return u, inv, kept
    seen = np.zeros(base**ORDER, bool)
    seen[key] = True
    found = np.flatnonzero(seen)
    place = np.zeros(len(seen), np.int32)
    place[found] = np.arange(len(found))
    u = np.zeros(len(found), np.uint64)
    for k in range(ORDER):
        u |= used[found // base**k % base].astype(np.uint64) << U64(16 * k)
    return u, place[key], kept


def _summed(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """(distinct 4-grams, counts) of several such pairs."""
    u, inv = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
    return u, np.bincount(inv, np.concatenate([p[1] for p in parts]), len(u)).astype(np.int64)


class Model:
    """Sorted arrays of every language and order, from summed 4-gram counts."""

    def __init__(self, lang: np.ndarray, key: np.ndarray, n: np.ndarray):
        self.langs = sorted(set(lang.tolist()))
        self.orders, self.facts = [], []
        for name in self.langs:
            own = lang == name
            order = np.argsort(key[own])
            self.orders.append(self._fit(key[own][order], n[own][order].astype(float)))
            lp = self._log2p(self.orders[-1], key[own])
            w = n[own] / n[own].sum()
            mean = -(w * lp).sum()
            self.facts.append((mean, max((w * lp * lp).sum() - mean * mean, 0.01)))

    @staticmethod
    def _fit(key: np.ndarray, count: np.ndarray) -> list[tuple[np.ndarray, ...]]:
        """From order 1 up: (n-grams, discounted probability, contexts, back-off weight)."""
        counts = [(key, count)]
        for order in range(ORDER - 1, 0, -1):
            mask = U64((1 << (16 * order)) - 1)
            k, c = np.unique(counts[0][0] & mask, return_counts=True)
            counts.insert(0, (k, c.astype(float)))
        out = []
        for k, c in counts:
            ones, twos = (c == 1).sum(), (c == 2).sum()
            d = ones / (ones + 2 * twos) if ones and twos else 0.5
            ctx, inv = np.unique(k >> U64(16), return_inverse=True)
            total, kinds = np.bincount(inv, c), np.bincount(inv)
            out.append((k, np.maximum(c - d, 0) / total[inv], ctx, d * kinds / total))
        return out

    @staticmethod
    def _log2p(orders: list[tuple[np.ndarray, ...]], keys: np.ndarray) -> np.ndarray:
        p = np.full(len(keys), 1 / (len(orders[0][0]) + 1))
        for order, (k, disc, ctx, back) in enumerate(orders, 1):
            want = keys & U64((1 << (16 * order)) - 1)
            h = want >> U64(16)
            i = np.minimum(np.searchsorted(ctx, h), len(ctx) - 1)
            p *= np.where(ctx[i] == h, back[i], 1.0)
            j = np.minimum(np.searchsorted(k, want), len(k) - 1)
            p += np.where(k[j] == want, disc[j], 0.0)
        return np.log2(p)

    def score(self, keys: np.ndarray) -> np.ndarray:
        """log2 p of each n-gram (rows) under each language (columns)."""
        return np.stack([self._log2p(o, keys) for o in self.orders], axis=1)


def count_grams(docs: DataFrame, text_col: str, lang_col: str) -> DataFrame:
    """lang, key, n: all 4-grams of all rows, summed by partition before the shuffle."""
    src = docs.select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kinds = pc.dictionary_encode(batch.column(0))
            names, code = kinds.dictionary, np.asarray(kinds.indices)
            found: dict[int, list] = {}
            for a, b in blocks(text_bytes(batch.column(1))[1], BLOCK):
                u, inv, first = grams(*text_bytes(pc.utf8_lower(batch.column(1).slice(a, b - a))))
                of = np.repeat(code[a:b], np.diff(first))
                for k in np.unique(code[a:b]):
                    n = np.bincount(inv[of == k], minlength=len(u))
                    parts = found.setdefault(int(k), [])
                    parts.append((u[n > 0], n[n > 0]))
                    if len(parts) == PARTS:
                        parts[:] = [_summed(parts)]
            for k, parts in found.items():
                u, n = _summed(parts)
                yield pa.RecordBatch.from_arrays([pa.repeat(names[k], len(u)), pa.array(u.view(np.int64)), pa.array(n)], names=["lang", "key", "n"])

    return src.mapInArrow(run, "lang string, key long, n long").groupBy("lang", "key").agg(F.sum("n").alias("n"))


def train(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id") -> Model | None:
    """The model of all rows that are not held out and have a language; None if there are none."""
    rows = docs.filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & F.col(id_col).isNotNull() & ~held_out(id_col))
    counts = written(count_grams(rows, text_col, lang_col))
    got = counts.toArrow()
    dropped(counts)
    if not got.num_rows:
        return None
    lang = got["lang"].combine_chunks().dictionary_encode()
    return Model(np.asarray(lang.dictionary.to_pylist(), object)[lang.indices.to_numpy()], got["key"].to_numpy().view(np.uint64), got["n"].to_numpy())


def language_id(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id", z: float = 6.0, slack: float = 1.0
) -> DataFrame:
    """docs with lang_pred, lang_score, cross_entropy and lang_rejected added; only the text is looked at for a prediction."""
    model = train(docs, text_col, lang_col, id_col)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def kernel(texts: pa.Array) -> list[pa.Array]:
        m: Model | None = shared.value
        column = texts.cast(pa.large_string())
        letter = np.asarray(pc.fill_null(pc.match_substring_regex(column, r"\p{L}"), False).to_numpy(zero_copy_only=False), bool)
        pred, score, cross, bad = np.full(len(letter), UND, object), np.zeros(len(letter)), np.full(len(letter), np.nan), np.ones(len(letter), bool)
        for a, b in blocks(text_bytes(column)[1], BLOCK) if m else ():
            u, inv, first = grams(*text_bytes(pc.utf8_lower(column.slice(a, b - a))))
            n = np.diff(first)
            some = np.flatnonzero(n)
            if not len(some):
                continue
            lp = m.score(u)
            h = np.stack([-np.add.reduceat(lp[:, k][inv], first[some]) for k in range(lp.shape[1])], 1) / n[some, None]
            best = h.argmin(1)
            low = h.min(1)
            facts = np.array(m.facts)[best]
            rows = a + some
            pred[rows] = np.array(m.langs, object)[best]
            score[rows] = 1 / np.exp2(4 * (low[:, None] - h)).sum(1)
            cross[rows] = low
            bad[rows] = low > facts[:, 0] + z * np.sqrt(facts[:, 1] / n[some]) + slack
        pred[~letter], score[~letter], bad[~letter] = UND, 0.0, True
        return [pa.array(pred, pa.string()), pa.array(score), pa.array(cross, from_pandas=True), pa.array(bad)]

    fields = [("lang_pred", "string"), ("lang_score", "double"), ("cross_entropy", "double"), ("lang_rejected", "boolean")]
    return appended(docs, fields, kernel, text_col)
