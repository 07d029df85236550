"""SQL fragments for the DuckDB side: geometry on prefixed columns."""

from __future__ import annotations


def area(a: str) -> str:
    return f"(({a}x2 - {a}x1) * ({a}y2 - {a}y1))"


def inter(a: str, b: str) -> str:
    return f"(greatest(0.0::double, least({a}x2, {b}x2) - greatest({a}x1, {b}x1)) * greatest(0.0::double, least({a}y2, {b}y2) - greatest({a}y1, {b}y1)))"


def iou(a: str, b: str) -> str:
    i = inter(a, b)
    u = f"({area(a)} + {area(b)} - {i})"
    return f"(case when {i} <= 0 or {u} <= 0 then 0.0::double else {i} / {u} end)"


def cover(a: str, b: str) -> str:
    return f"({inter(a, b)} / greatest({area(a)}, 1e-6::double))"


def dist(a: str, b: str) -> str:
    return f"sqrt((({a}x1+{a}x2)/2 - ({b}x1+{b}x2)/2) * (({a}x1+{a}x2)/2 - ({b}x1+{b}x2)/2) + (({a}y1+{a}y2)/2 - ({b}y1+{b}y2)/2) * (({a}y1+{a}y2)/2 - ({b}y1+{b}y2)/2))"


def near(a: str, b: str) -> str:
    return f"({iou(a, b)} >= 0.3 or {dist(a, b)} < 0.5 * greatest({a}y2 - {a}y1, {b}y2 - {b}y1))"


def lag_box(window: str) -> str:
    return ", ".join(f"lag({c}) over {window} p{c}" for c in ("f", "x1", "y1", "x2", "y2"))


def greedy_pairs(source: str, a: str = "tid_a", b: str = "tid_b", by: str = "iou") -> str:
    """(clip_id, f, tid_a, tid_b, iou): pairs of each frame of `source` taken one to one, best first, ties to the larger ids."""
    pair = f"{{'tid_a': {a}, 'tid_b': {b}, 'iou': {by}}}"
    start = "{'a': []::int[], 'b': []::int[], 'kept': []::struct(tid_a int, tid_b int, iou double)[]}"
    step = "case when list_contains(acc.a, x.tid_a) or list_contains(acc.b, x.tid_b) then acc else {'a': list_append(acc.a, x.tid_a), 'b': list_append(acc.b, x.tid_b), 'kept': list_append(acc.kept, x)} end"
    return f"select clip_id, f, unnest(kept, recursive := true) from (select clip_id, f, list_reduce(list({pair} order by {by} desc, {a} desc, {b} desc), lambda acc, x: {step}, {start}).kept kept from {source} group by clip_id, f)"
