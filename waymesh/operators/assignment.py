"""Assignment refinements: contiguity, coverage conflicts, buffer overlap."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import geometry as g
from . import blocking, matching
from .alignment import points


def contiguity_groups(rows: DataFrame, metres: float = 5.0, turn: float = 40.0) -> DataFrame:
    """rows with contiguity: chains of segments whose ends meet and that go on in line or bear the same name."""
    ends = F.array(g.first(F.col("xy")), g.last(F.col("xy")))
    leave = F.array(g.bearing(F.element_at("xy", 1), F.element_at("xy", 2)), g.bearing(F.element_at("xy", -1), F.element_at("xy", -2)))
    e = rows.select("id", "name", F.posexplode(F.arrays_zip(ends.alias("p"), leave.alias("h"))).alias("which", "z")).select("id", "name", F.col("z.p").alias("p"), F.col("z.h").alias("h"))
    pairs = blocking.point_join(e, e, metres).filter("id < r_id")
    apart = F.pmod(F.abs(F.col("h") - F.col("r_h")), F.lit(360.0))
    bend = 180 - F.least(apart, 360 - apart)
    named = (F.coalesce("name", F.lit("")) != "") & (F.col("name") == F.col("r_name"))
    edges = pairs.filter((bend <= turn) | named).select(F.col("id").alias("u"), F.col("r_id").alias("v"))
    own = matching.components(edges).withColumnRenamed("node", "id")
    return rows.join(own, "id", "left").withColumn("contiguity", F.coalesce("component", "id")).drop("component")


def coverage_conflicts(pairs: DataFrame, metres: float = 5.0) -> DataFrame:
    """pairs with decision: best first, a pair is for review if its span overlaps an accepted one by more than `metres` on either side.

    Order matters, so each set of pairs that share sides is walked in one task, set after set in
    sorted rows; sets are components of the accepted edges, which blocking keeps local.
    """
    pairs = matching.scratch(pairs.select("ref_id", "target_id", "confidence", "ref_from", "ref_to", "target_from", "target_to", "ref_length", "target_length"))
    edges = pairs.select(F.concat(F.lit("r:"), "ref_id").alias("u"), F.concat(F.lit("t:"), "target_id").alias("v"))
    own = matching.components(edges).withColumnRenamed("node", "__n")
    named = pairs.join(own, F.concat(F.lit("r:"), "ref_id") == F.col("__n")).drop("__n")
    cols = ["component", "ref_id", "target_id", "confidence", "ref_from", "ref_to", "target_from", "target_to", "ref_length", "target_length"]

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        taken: dict[str, list[tuple[float, float]]] = {}
        at = None
        for part in batches:
            out = []
            for r in part.itertuples():
                if r.component != at:
                    taken, at = {}, r.component
                spans = {"r:" + r.ref_id: (r.ref_from * r.ref_length, r.ref_to * r.ref_length), "t:" + r.target_id: (r.target_from * r.target_length, r.target_to * r.target_length)}
                bad = any(min(hi, b) - max(lo, a) > metres for k, (lo, hi) in spans.items() for a, b in taken.get(k, ()))
                if not bad:
                    for k, v in spans.items():
                        taken.setdefault(k, []).append(v)
                out.append((r.ref_id, r.target_id, r.confidence, "review" if bad else "match"))
            yield pd.DataFrame(out, columns=["ref_id", "target_id", "confidence", "decision"])

    rows = named.select(*cols).repartition("component").sortWithinPartitions("component", F.isnan("confidence"), F.desc("confidence"), "ref_id", "target_id")
    return rows.mapInPandas(walk, "ref_id string, target_id string, confidence double, decision string")


#: Grid points and rows that are held at once, and the width about a buffer's edge in which points are measured one by one.
CELLS, ROWS, EDGE = 2_000_000, 200_000, 1e-6


def _runs(first: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(i, value) of all values first[i] .. first[i] + size[i] - 1."""
    i = np.repeat(np.arange(len(size)), size)
    return i, np.arange(len(i)) - np.repeat(np.cumsum(size) - size, size) + first[i]


def _spans(y: np.ndarray, p: np.ndarray, q: np.ndarray, metres: float) -> tuple[np.ndarray, np.ndarray]:
    """First and last x at height y within `metres` of the piece pq, by row (first > last: none): the hull of two discs and the slab between."""
    lo, hi = np.full(len(y), np.inf), np.full(len(y), -np.inf)
    if metres <= 0:
        return lo, hi
    for c in (p, q):
        dy = y - c[:, 1]
        root = np.sqrt(np.maximum(metres**2 - dy**2, 0))
        on = np.abs(dy) <= metres
        lo, hi = np.where(on, np.minimum(lo, c[:, 0] - root), lo), np.where(on, np.maximum(hi, c[:, 0] + root), hi)
    v = q - p
    n = np.hypot(v[:, 0], v[:, 1])
    side = np.stack([-v[:, 1], v[:, 0]], 1) * (metres / np.where(n > 0, n, 1.0))[:, None]
    corners = (p + side, p - side, q - side, q + side)
    for a, b in zip(corners, (*corners[1:], corners[0]), strict=True):
        rise = b[:, 1] - a[:, 1]
        on = (rise != 0) & (y >= np.minimum(a[:, 1], b[:, 1])) & (y <= np.maximum(a[:, 1], b[:, 1]))
        x = a[:, 0] + (y - a[:, 1]) / np.where(rise != 0, rise, 1.0) * (b[:, 0] - a[:, 0])
        lo, hi = np.where(on, np.minimum(lo, x), lo), np.where(on, np.maximum(hi, x), hi)
    return lo, hi


class _Pieces:
    """The pieces of many lines, one after the other."""

    def __init__(self, lines: list[np.ndarray]):
        self.n = np.array([max(len(a) - 1, 0) for a in lines], int)
        self.first = np.cumsum(self.n) - self.n
        self.p, self.q = (np.concatenate([np.zeros((0, 2)), *[a[cut] for a in lines]]) for cut in (slice(None, -1), slice(1, None)))


def _covered(lines: _Pieces, pair: np.ndarray, y: np.ndarray, x0: np.ndarray, dx: np.ndarray, nx: np.ndarray, metres: float) -> np.ndarray:
    """Which points of rows of grids (nx[i] points and one that stays unset) are within `metres` of the row's line.

    What is well inside a piece's span is within, what is well outside is not, and the points about the edge are measured.
    """
    start = np.cumsum(nx + 1) - (nx + 1)
    row, k = _runs(lines.first[pair], lines.n[pair])
    near = (y[row] >= np.minimum(lines.p[k, 1], lines.q[k, 1]) - metres - 2 * EDGE) & (y[row] <= np.maximum(lines.p[k, 1], lines.q[k, 1]) + metres + 2 * EDGE)
    row, k = row[near], k[near]
    p, q, last = lines.p[k], lines.q[k], nx[row] - 1

    def places(r: float) -> tuple[np.ndarray, np.ndarray]:
        lo, hi = _spans(y[row], p, q, r)
        some = lo <= hi
        return np.where(some, (np.where(some, lo, 0) - x0[row]) / dx[row], np.inf), np.where(some, (np.where(some, hi, 0) - x0[row]) / dx[row], -np.inf)

    lo, hi = places(metres + EDGE)
    some = lo <= hi
    first, end = np.clip(np.where(some, np.floor(lo), 0).astype(int), 0, last + 1), np.clip(np.where(some, np.ceil(hi) + 1, 0).astype(int), 0, last + 1)
    lo, hi = places(metres - EDGE)
    some = lo <= hi
    a = np.clip(np.where(some, np.floor(lo) + 1, 0).astype(int), first, np.maximum(end, first))
    b = np.where(some, np.clip(np.where(some, np.ceil(hi), 0).astype(int), a, np.maximum(end, a)), a)
    edge = np.zeros(int((nx + 1).sum()) + 1, np.int32)
    np.add.at(edge, start[row] + a, 1)
    np.add.at(edge, start[row] + b, -1)
    inside = edge[:-1].cumsum() > 0
    for head, size in ((first, a - first), (b, np.maximum(end - b, 0))):
        i, col = _runs(head, size)
        gx, gy = x0[row[i]] + col * dx[row[i]] - p[i, 0], y[row[i]] - p[i, 1]
        vx, vy = q[i, 0] - p[i, 0], q[i, 1] - p[i, 1]
        t = np.clip((gx * vx + gy * vy) / np.maximum(vx * vx + vy * vy, 1e-12), 0, 1)
        hit = np.hypot(gx - t * vx, gy - t * vy) <= metres
        inside[start[row[i[hit]]] + col[hit]] = True
    return inside


def iou_all(refs: list[np.ndarray], targets: list[np.ndarray], metres: float, step: float = 0.5) -> np.ndarray:
    """Overlap of the round buffers of each pair of lines over their union, by counting grid points; rows of all grids are worked on in blocks."""
    box = np.array([(*p.min(0), *p.max(0)) for p in (np.concatenate(z) for z in zip(refs, targets, strict=True))]).reshape(-1, 4)
    lo, hi = box[:, :2] - metres, box[:, 2:] + metres
    n = np.ceil((hi - lo) / step).astype(int)
    d = (lo + step) - lo  # as arange steps
    r, t = _Pieces(refs), _Pieces(targets)
    both, either = np.zeros(len(refs), int), np.zeros(len(refs), int)
    rows, done = np.cumsum(n[:, 1]), 0
    while done < (rows[-1] if len(rows) else 0):
        at = np.arange(done, min(done + ROWS, rows[-1]))
        pair = np.searchsorted(rows, at, "right")
        held = max(1, int(np.searchsorted(np.cumsum(n[pair, 0] + 1), CELLS, "right")))
        at, pair = at[:held], pair[:held]
        done += len(at)
        y = lo[pair, 1] + (at - (rows[pair] - n[pair, 1])) * d[pair, 1]
        grid = (pair, y, lo[pair, 0], d[pair, 0], n[pair, 0], metres)
        a, b = _covered(r, *grid), _covered(t, *grid)
        start = np.cumsum(n[pair, 0] + 1) - (n[pair, 0] + 1)
        np.add.at(both, pair, np.add.reduceat(a & b, start, dtype=int))
        np.add.at(either, pair, np.add.reduceat(a | b, start, dtype=int))
    return both / np.maximum(either, 1)


def buffer_iou(pairs: DataFrame, metres: float, step: float = 0.5) -> DataFrame:
    """ref_id, target_id, iou of round buffers, by counting grid points (tolerance about step / metres)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in batches:
            if part.num_rows:
                out = iou_all(points(part["ref_xy"]), points(part["target_xy"]), metres, step)
                yield pa.RecordBatch.from_arrays([part["ref_id"], part["target_id"], pa.array(out, pa.float64())], ["ref_id", "target_id", "iou"])

    return pairs.select("ref_id", "target_id", "ref_xy", "target_xy").mapInArrow(run, "ref_id string, target_id string, iou double")
