"""Helpers that assemble the SQL checks from named views."""

from __future__ import annotations

import re

from .recipe import NI, NJ, NK, VIEWS

VOX = "subject_id, i, j, k"


def sql(body: str, **extra: str) -> str:
    """``WITH RECURSIVE`` the views that ``body`` (or another used view) mentions, in order of definition."""
    known = {**VIEWS, **extra}
    names = list(known)
    used, todo = set(), [body]
    while todo:
        text = todo.pop()
        for name in names:
            if name not in used and re.search(rf"\b{name}\b", text):
                used.add(name)
                todo.append(known[name])
    parts = ",\n".join(f"{n} AS MATERIALIZED ({known[n]})" if "UNION" not in known[n] or f"FROM {n} " not in known[n]
                       else f"{n} AS ({known[n]})" for n in names if n in used)
    return f"WITH RECURSIVE {parts}\n{body}" if parts else body


def near(source: str, r: int, extra_keys: str = "") -> str:
    """Grid voxels within taxicab distance r of a mask."""
    keys = "".join(f", s.{k}" for k in extra_keys.split() if k)
    return (f"SELECT DISTINCT g.subject_id{keys}, g.i, g.j, g.k FROM grid g JOIN {source} s ON g.subject_id = s.subject_id "
            f"AND abs(g.i-s.i) + abs(g.j-s.j) + abs(g.k-s.k) <= {r}")


def eroded(source: str, r: int, extra_keys: str = "", border: bool = False) -> str:
    """Mask voxels at taxicab distance of at least r from the background inside the grid (or also from the border)."""
    keys = "".join(f" AND b.{k} = s.{k}" for k in extra_keys.split() if k)
    all_keys = " ".join(["", *extra_keys.split()]).replace(" ", ", s.") if extra_keys else ""
    cond = f" AND least(s.i + 1, {NI} - s.i, s.j + 1, {NJ} - s.j, s.k + 1, {NK} - s.k) >= {r}" if border else ""
    return (f"SELECT s.subject_id{all_keys}, s.i, s.j, s.k FROM {source} s WHERE NOT EXISTS (SELECT 1 FROM grid g WHERE g.subject_id = s.subject_id "
            f"AND abs(g.i-s.i) + abs(g.j-s.j) + abs(g.k-s.k) < {r} AND NOT EXISTS (SELECT 1 FROM {source} b WHERE b.subject_id = g.subject_id{keys} "
            f"AND b.i = g.i AND b.j = g.j AND b.k = g.k)){cond}")


def components(source: str, reach: int = 3, keys: str = "", equal: str = "", name: str = "cc", sides: tuple[int, int] = (NJ, NK)) -> dict[str, str]:
    """Views ``<name>_m``, ``_e``, ``_r`` and ``<name>``: every voxel of a mask with the smallest voxel number of its component."""
    extra = "".join(f", {k}" for k in keys.split())
    same = "".join(f" AND a.{k} = b.{k}" for k in [*keys.split(), *equal.split()])
    same_r = "".join(f" AND r.{k} = e.{k}" for k in keys.split())
    carried = "".join(f", {k}" for k in equal.split())
    e_extra = "".join(f", a.{k}" for k in keys.split())
    return {
        f"{name}_m": f"SELECT subject_id{extra}{carried}, i, j, k, ((i::BIGINT*{sides[0]} + j)*{sides[1]} + k) AS id FROM {source}",
        f"{name}_e": (f"SELECT a.subject_id{e_extra}, a.id AS a, b.id AS b FROM {name}_m a JOIN {name}_m b ON a.subject_id = b.subject_id{same} "
                      f"AND abs(a.i-b.i) <= 1 AND abs(a.j-b.j) <= 1 AND abs(a.k-b.k) <= 1 AND abs(a.i-b.i) + abs(a.j-b.j) + abs(a.k-b.k) <= {reach}"),
        f"{name}_r": (f"SELECT subject_id{extra}, a, b FROM {name}_e UNION SELECT r.subject_id{''.join(f', r.{k}' for k in keys.split())}, r.a, e.b "
                      f"FROM {name}_r r JOIN {name}_e e ON r.subject_id = e.subject_id{same_r} AND r.b = e.a"),
        name: (f"SELECT m.*, l.cluster_id FROM {name}_m m JOIN (SELECT subject_id{extra}, a, min(b) AS cluster_id FROM {name}_r GROUP BY ALL) l "
               f"ON m.subject_id = l.subject_id AND m.id = l.a{''.join(f' AND m.{k} = l.{k}' for k in keys.split())}"),
    }
