"""Pieces of DuckDB SQL for the oracles: the synthetic tables and plain geometry on lists of points."""

from __future__ import annotations

from ..sources.synthetic import SQL


def with_tables(body: str, *more: str) -> str:
    return "WITH " + ",\n".join([SQL.strip(), *more]) + "\n" + body


def dist(ax: str, ay: str, bx: str, by: str) -> str:
    return f"sqrt((({ax}) - ({bx})) * (({ax}) - ({bx})) + (({ay}) - ({by})) * (({ay}) - ({by})))"


def length(xy: str, v: str = "i") -> str:
    return f"list_sum(list_transform(range(1, len({xy})), lambda {v}: {dist(f'{xy}[{v}].x', f'{xy}[{v}].y', f'{xy}[{v}+1].x', f'{xy}[{v}+1].y')}))"


def heading(xy: str) -> str:
    d = f"degrees(atan2({xy}[-1].y - {xy}[1].y, {xy}[-1].x - {xy}[1].x))"
    return f"CASE WHEN {d} < 0 THEN {d} + 360 ELSE {d} END"


def heading_delta(a: str, b: str) -> str:
    d = f"(abs(({heading(a)}) - ({heading(b)})) % 180)"
    return f"least({d}, 180 - {d})"


def point_piece(px: str, py: str, xy: str, v: str) -> str:
    """Distance of a point to piece v of a line."""
    ax, ay, bx, by = f"{xy}[{v}].x", f"{xy}[{v}].y", f"{xy}[{v}+1].x", f"{xy}[{v}+1].y"
    t = f"greatest(0.0, least(1.0, (({px} - {ax}) * ({bx} - {ax}) + ({py} - {ay}) * ({by} - {ay})) / (({bx} - {ax}) * ({bx} - {ax}) + ({by} - {ay}) * ({by} - {ay}))))"
    return dist(px, py, f"{ax} + {t} * ({bx} - {ax})", f"{ay} + {t} * ({by} - {ay})")


def point_line(px: str, py: str, xy: str, v: str = "j") -> str:
    return f"list_min(list_transform(range(1, len({xy})), lambda {v}: {point_piece(px, py, xy, v)}))"


def vertex_distances(a: str, b: str) -> str:
    one = lambda s, o, v, w: f"list_transform(range(1, len({s}) + 1), lambda {v}: {point_line(f'{s}[{v}].x', f'{s}[{v}].y', o, w)})"
    return f"({one(a, b, 'p', 'j')} || {one(b, a, 'q', 'k')})"


def bbox(xy: str, f: str, axis: str) -> str:
    return f"list_{f}(list_transform({xy}, lambda z: z.{axis}))"


def boxes_overlap(a: str, b: str, pad: float) -> str:
    return " AND ".join(f"{bbox(a, 'min', c)} <= {bbox(b, 'max', c)} + {pad} AND {bbox(a, 'max', c)} >= {bbox(b, 'min', c)} - {pad}" for c in "xy")


def pairs(pad: float, name: str = "pairs") -> str:
    """Reference and target rows whose boxes overlap."""
    return f"{name} AS (SELECT r.id AS ref_id, t.id AS target_id, r.xy AS a, t.xy AS b, r.name AS ref_name, t.name AS target_name, r.class AS ref_class, t.class AS target_class FROM ref r JOIN tgt t ON {boxes_overlap('r.xy', 't.xy', pad)})"


def crossing(a: str, b: str) -> str:
    """Whether any pieces of two lines cross."""

    def side(p: str, q: str, r: str) -> str:
        return f"(({q}.x - {p}.x) * ({r}.y - {p}.y) - ({q}.y - {p}.y) * ({r}.x - {p}.x))"

    s, s2, t, t2 = f"{a}[m]", f"{a}[m+1]", f"{b}[n]", f"{b}[n+1]"
    hit = f"{side(s, s2, t)} * {side(s, s2, t2)} < 0 AND {side(t, t2, s)} * {side(t, t2, s2)} < 0"
    return f"list_bool_or(list_transform(range(1, len({a})), lambda m: list_bool_or(list_transform(range(1, len({b})), lambda n: {hit}))))"


def line_distance(a: str, b: str) -> str:
    return f"CASE WHEN {crossing(a, b)} THEN 0.0 ELSE list_min({vertex_distances(a, b)}) END"


#: A bridge table with closed-form confidences, and label tables derived from it.
BRIDGE = """bridge AS (SELECT id AS local_id, 'r' || k AS gers_id, round(((k * 37 + CASE WHEN part = 'b' THEN 11 ELSE 0 END) % 101) / 100.0, 2) AS confidence,
  CASE WHEN part = 'b' THEN 0.5 ELSE 0.0 END::DOUBLE AS start_frac, CASE WHEN part = 'a' THEN 0.5 ELSE 1.0 END::DOUBLE AS end_frac, k FROM tgt),
decided AS (SELECT *, CASE WHEN confidence >= 0.5 THEN 'match' WHEN confidence >= 0.1 THEN 'review' ELSE 'no_match' END AS decision FROM bridge),
truth AS (SELECT gers_id, local_id, CASE WHEN k % 7 = 0 THEN 'no_match' WHEN k % 11 = 0 THEN 'unsure' ELSE 'match' END AS label FROM bridge WHERE k % 2 = 0)"""

VOTES = """votes AS (SELECT event_id AS vote_id, event_id % 400 AS group_id, user_id % 5 AS seat, event_type AS choice, value AS conf, ts FROM events)"""
