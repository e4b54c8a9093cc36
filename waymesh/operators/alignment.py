"""Alignment of two lines: the shift along the reference at which they run together best, as fractions of both.

A shift o lays measure m of the reference on measure m - o of the target, read forwards or backwards.
Its score is the sum over 16 places of the overlap of max(0, cosine of the directions) / (buffer +
distance), less for overlaps shorter than the buffer. 24 shifts over all that overlap and the shift of
the midpoints are tried; shifts that lay an end on its projection are taken only if they score more
than five times as much; the best is refined in steps that shrink to a third. All shifts of a step and all
pairs of a block are scored at once; lines of a block are padded to its longest one.

Short overlaps (under 20 m) are derived anew from the projections of the ends, and the ends of an
overlap where the lines part (too far, or turned by more than 60 degrees) are cut off.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

SAMPLES, GRID, STEPS = 16, 24, 16

#: Pairs scored at once, and points that a block of padded lines holds at most.
BLOCK, POINTS = 512, 200_000


class Lines:
    """Lines of a block by row: points, pieces and measures, padded with pieces that no measure reaches; lines of no length have length 0."""

    def __init__(self, xy: list[np.ndarray]):
        kept = [self._pieces(p) for p in xy]
        self.n = np.array([len(m) for _, _, m in kept])
        rows, most = len(kept), max(1, int(self.n.max()) if len(kept) else 1)
        self.x, self.y, self.u, self.v, self.m = (np.zeros((rows, most)) for _ in range(5))
        self.d = np.full((rows, most), -1.0)
        self.length = np.zeros(rows)
        self.ends = np.zeros((rows, 2, 2))
        for i, (p, way, m) in enumerate(kept):
            k = len(m)
            if k:
                self.x[i, :k], self.y[i, :k] = p[:-1, 0], p[:-1, 1]
                self.u[i, :k], self.v[i, :k] = way[:, 0], way[:, 1]
                self.length[i] = m[-1]
                self.m[i, :k] = np.concatenate([[0.0], m[:-1]])
                self.d[i, :k] = np.diff(np.concatenate([[0.0], m]))
                self.ends[i] = p[0], p[-1]
        self.row = np.arange(rows)

    @staticmethod
    def _pieces(p: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(points, unit directions, measures of the pieces' ends) without pieces of no length."""
        d = np.diff(p, axis=0)
        n = np.hypot(d[:, 0], d[:, 1])
        keep = n > 0
        return np.vstack([p[:1], p[1:][keep]]), d[keep] / n[keep, None], np.cumsum(n[keep])

    def take(self, rows: np.ndarray) -> Lines:
        out = object.__new__(Lines)
        for k, v in self.__dict__.items():
            setattr(out, k, v[rows])
        out.row = np.arange(len(rows))
        return out

    def at(self, m: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """x, y and direction at measures (by row), which are kept within the line."""
        row = self.row.reshape(-1, *[1] * (m.ndim - 1))
        last = (self.n - 1).reshape(row.shape)
        m = np.clip(m, 0, self.length.reshape(row.shape))
        i = np.zeros(m.shape, int)
        step = 1 << max(0, int(self.x.shape[1] - 1).bit_length())
        while step := step >> 1:
            far = np.minimum(i + step, last)
            i = np.where(self.m[row, far] <= m, far, i)
        off, u, v = m - self.m[row, i], self.u[row, i], self.v[row, i]
        return self.x[row, i] + off * u, self.y[row, i] + off * v, u, v

    def project(self, q: np.ndarray) -> np.ndarray:
        """Measure of each line's place nearest to its point of q."""
        qx, qy = q[:, :1], q[:, 1:]
        t = np.clip((qx - self.x) * self.u + (qy - self.y) * self.v, 0, np.maximum(self.d, 0))
        far = np.where(self.d < 0, np.inf, np.hypot(self.x + t * self.u - qx, self.y + t * self.v - qy))
        k = far.argmin(1)
        return self.m[self.row, k] + t[self.row, k]

    def is_loop(self) -> np.ndarray:
        return np.hypot(*(self.ends[:, 0] - self.ends[:, 1]).T) < 1.0


def _together(r: Lines, t: Lines, shift: np.ndarray, back: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(overlap, distances, cosines) of each row's shifts, at n places of their overlap."""
    lo, hi = np.maximum(shift, 0), np.minimum(shift + t.length[:, None], r.length[:, None])
    m = lo[..., None] + (hi - lo)[..., None] * (np.arange(n) + 0.5) / n
    on_t = m - shift[..., None]
    turned = back[:, None, None]
    px, py, ux, uy = r.at(m)
    qx, qy, vx, vy = t.at(np.where(turned, t.length[:, None, None] - on_t, on_t))
    return hi - lo, np.hypot(px - qx, py - qy), (ux * vx + uy * vy) * np.where(turned, -1, 1)


def _scores(r: Lines, t: Lines, shift: np.ndarray, back: np.ndarray, buffer: float) -> np.ndarray:
    over, far, dot = _together(r, t, shift, back, SAMPLES)
    s = (np.maximum(dot, 0) / (buffer + far)).sum(-1)
    return np.where(over > 0, s * np.minimum(over / buffer, 1), -1.0)


def _best_shift(r: Lines, t: Lines, back: bool, buffer: float) -> tuple[np.ndarray, np.ndarray]:
    row, way = r.row, np.full(len(r.row), back)
    first, last = (t.ends[:, 1], t.ends[:, 0]) if back else (t.ends[:, 0], t.ends[:, 1])
    grid = np.column_stack([np.linspace(-t.length, r.length, GRID, axis=-1), (r.length - t.length) / 2])
    s = _scores(r, t, grid, way, buffer)
    at, best = grid[row, s.argmax(1)], s.max(1)
    start = t.project(r.ends[:, 0])
    ends = np.column_stack([r.project(first), r.project(last) - t.length, -(t.length - start) if back else -start])
    s = _scores(r, t, ends, way, buffer)
    better = s.max(1) > 5 * np.maximum(best, 0)
    at, best = np.where(better, ends[row, s.argmax(1)], at), np.where(better, s.max(1), best)
    step = (r.length + t.length) / (GRID - 1)
    for _ in range(STEPS):
        step = step / 3
        near = at[:, None] + step[:, None] * np.array([-2.0, -1.0, 1.0, 2.0])
        s = _scores(r, t, near, way, buffer)
        better = s.max(1) > best
        at, best = np.where(better, near[row, s.argmax(1)], at), np.where(better, s.max(1), best)
    return at, best


def _within(p: np.ndarray, q: np.ndarray, lo: np.ndarray, hi: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where the measures of two projections and those of a short overlap meet; midpoints where they cross over."""
    lo, hi = np.maximum(np.minimum(p, q), lo), np.minimum(np.maximum(p, q), hi)
    return np.where(lo < hi, lo, (lo + hi) / 2), np.where(lo < hi, hi, (lo + hi) / 2)


def _aligned(r: Lines, t: Lines, buffer: float) -> tuple[np.ndarray, ...]:
    """The fields of align() by row; NaN starts where lines don't overlap."""
    (shift, score), (turned, other) = (_best_shift(r, t, back, buffer) for back in (False, True))
    back = other > score
    shift, score = np.where(back, turned, shift), np.where(back, other, score)
    lo, hi = np.maximum(shift, 0.0), np.minimum(shift + t.length, r.length)
    none = hi <= lo
    _, far, dot = _together(r, t, shift[:, None], back, 32)
    good = (far[:, 0] <= max(20.0, 3 * buffer)) & (dot[:, 0] >= 0.5)
    head, tail = good.argmax(1), good[:, ::-1].argmax(1)
    truncated = ((hi - lo) / r.length > 0.1) & good.any(1) & ((head > 0) | (tail > 0))
    step = (hi - lo) / 32
    lo, hi = np.where(truncated, lo + head * step, lo), np.where(truncated, hi - tail * step, hi)
    from_t, to_t = np.where(back, t.length - (hi - shift), lo - shift), np.where(back, t.length - (lo - shift), hi - shift)
    tightened = (hi - lo < 20) & ~r.is_loop() & ~t.is_loop()
    a, b = _within(r.project(t.ends[:, 0]), r.project(t.ends[:, 1]), lo, hi), _within(t.project(r.ends[:, 0]), t.project(r.ends[:, 1]), from_t, to_t)
    lo, hi = np.where(tightened, a[0], lo), np.where(tightened, a[1], hi)
    from_t, to_t = np.where(tightened, b[0], from_t), np.where(tightened, b[1], to_t)
    return np.where(none, np.nan, lo / r.length), hi / r.length, from_t / t.length, to_t / t.length, back, score, tightened, truncated


def align_all(refs: list[np.ndarray], targets: list[np.ndarray], buffer: float = 15.0) -> tuple[np.ndarray, tuple[np.ndarray, ...]]:
    """(rows that have an alignment, the fields of align() for them) of pairs of lines, given as arrays of points."""
    size = np.array([max(len(a), len(b)) for a, b in zip(refs, targets, strict=True)], int)
    able = np.flatnonzero([len(a) > 1 and len(b) > 1 for a, b in zip(refs, targets, strict=True)])
    able = able[np.argsort(size[able], kind="stable")]  # lines of like size share a block
    found, fields, i = [], [], 0
    while i < len(able):
        k = min(BLOCK, len(able) - i)
        while k > 1 and k * size[able[i + k - 1]] > POINTS:
            k = (k + 1) // 2
        rows, i = able[i : i + k], i + k
        r, t = Lines([refs[j] for j in rows]), Lines([targets[j] for j in rows])
        some = np.flatnonzero((r.length != 0) & (t.length != 0))
        if len(some):
            got = _aligned(r.take(some), t.take(some), buffer)
            hit = ~np.isnan(got[0])
            found.append(rows[some[hit]])
            fields.append([f[hit] for f in got])
    if not found:
        return np.array([], int), tuple(np.array([]) for _ in range(8))
    rows = np.concatenate(found)
    order = np.argsort(rows)
    return rows[order], tuple(np.concatenate(f)[order] for f in zip(*fields, strict=True))


def align(ref: list | None, target: list | None, buffer: float = 15.0) -> tuple[float | None, ...]:
    """(ref_start, ref_end, target_start, target_end, is_reversed, score, tightened, truncated); nulls for lines without length."""
    xy = lambda line: np.array([(q["x"], q["y"]) for q in line or []], float).reshape(-1, 2)
    rows, fields = align_all([xy(ref)], [xy(target)], buffer)
    return tuple(f[0].item() for f in fields) if len(rows) else (None,) * 8


FIELDS = "ref_start double, ref_end double, target_start double, target_end double, is_reversed boolean, score double, tightened boolean, truncated boolean"


def points(lines: pa.Array) -> list[np.ndarray]:
    """Arrays of points of a column of lines; null lines have none."""
    flat = lines.flatten()
    xy = np.column_stack([pc.struct_field(flat, c).to_numpy(zero_copy_only=False).astype(float) for c in ("x", "y")])
    return np.split(xy, np.cumsum(pc.fill_null(pc.list_value_length(lines), 0).to_numpy(zero_copy_only=False))[:-1])


def aligned(pairs: DataFrame, ref: Column, target: Column, buffer: float = 15.0) -> DataFrame:
    """pairs with the fields of align(), coverage of both, and the target's fractions in the reference's direction (target_from, target_to)."""
    rows = pairs.select("*", ref.alias("__ref"), target.alias("__target"))
    names = [f.split()[0] for f in FIELDS.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            if part.num_rows:
                at, fields = align_all(points(part["__ref"]), points(part["__target"]), buffer)
                kept = part.drop_columns(["__ref", "__target"]).take(pa.array(at, pa.int64()))
                kinds = [pa.bool_() if f.endswith("boolean") else pa.float64() for f in FIELDS.split(", ")]
                yield pa.RecordBatch.from_arrays([*kept.columns, *[pa.array(f, k) for f, k in zip(fields, kinds, strict=True)]], [*kept.schema.names, *names])

    out = rows.mapInArrow(run, StructType([*pairs.schema.fields, *StructType.fromDDL(FIELDS).fields]))
    swap = F.col("is_reversed")
    return out.withColumns(
        {
            "ref_coverage": F.col("ref_end") - F.col("ref_start"), "target_coverage": F.col("target_end") - F.col("target_start"),
            "target_from": F.when(swap, F.col("target_end")).otherwise(F.col("target_start")), "target_to": F.when(swap, F.col("target_start")).otherwise(F.col("target_end")),
        }
    )
