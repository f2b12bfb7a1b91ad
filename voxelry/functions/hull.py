"""Facets of the convex hull of voxels, exact in integers."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

#: Displacement that brings points into general position while the hull is searched; facets are computed from the undisplaced ones.
SHIFT = 1e-6


def complement(points: np.ndarray) -> np.ndarray:
    """Integer vectors that span the directions in which a set of points does not extend."""
    d = points - points[0]
    longest = np.abs(d).sum(axis=1)
    u = d[longest.argmax()]
    if not u.any():
        return np.eye(3, dtype=np.int64)
    across = np.cross(u, d)
    n = across[np.abs(across).sum(axis=1).argmax()]
    if not n.any():
        first = np.cross(u, np.eye(3, dtype=np.int64)[np.abs(u).argmin()])
        return np.stack([first, np.cross(u, first)])
    return np.zeros((0, 3), np.int64) if (d @ n).any() else n[None]


def _simplices(x: np.ndarray) -> np.ndarray | None:
    """Triangles (outward, as rows of point numbers) of the hull of points in general position; None if they are not."""
    a = int(x[:, 0].argmin())
    b = int(np.square(x - x[a]).sum(axis=1).argmax())
    c = int(np.square(np.cross(x[b] - x[a], x - x[a])).sum(axis=1).argmax())
    d = int(np.abs((x - x[a]) @ np.cross(x[b] - x[a], x[c] - x[a])).argmax())
    centre = x[[a, b, c, d]].mean(axis=0)

    def planes(tri: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        p, q, r = x[tri[:, 0]], x[tri[:, 1]], x[tri[:, 2]]
        n = np.cross(q - p, r - p)
        inward = ((centre - p) * n).sum(axis=1) > 0
        tri[inward] = tri[inward][:, [0, 2, 1]]
        n[inward] *= -1
        return tri, n, (n * p).sum(axis=1)

    tri, normal, level = planes(np.array([[a, b, c], [a, b, d], [a, c, d], [b, c, d]]))
    # the outermost points first: the hull is nearly whole when the many inner ones are tested
    for p in np.argsort(-np.square(x - centre).sum(axis=1)):
        if p in (a, b, c, d):
            continue
        seen = normal @ x[p] > level
        if not seen.any():
            continue
        lit = tri[seen]
        edges = np.concatenate([lit[:, [0, 1]], lit[:, [1, 2]], lit[:, [2, 0]]])
        code, back = edges[:, 0] * len(x) + edges[:, 1], edges[:, 1] * len(x) + edges[:, 0]
        rim = edges[~np.isin(code, back)]
        if len(rim) < 3 or len(np.unique(rim[:, 0])) != len(rim):
            return None
        fresh, n, h = planes(np.column_stack([rim, np.full(len(rim), p)]))
        tri, normal, level = (np.concatenate(pair) for pair in ((tri[~seen], fresh), (normal[~seen], n), (level[~seen], h)))
    return tri


def half_spaces(points: np.ndarray) -> np.ndarray:
    """Rows (a, b, c, h), integers without common divisor: the hull of ``points`` is where ``a*i + b*j + c*k <= h`` for all of them.

    Flat sets are thickened along the missing directions while facets are searched. A triangle of the displaced hull gives the exact normal of
    its undisplaced points, and every facet of the true hull is met by such a triangle; the level of a normal is its exact maximum over
    the points, so no half-space can cut the hull.
    """
    points = np.unique(points.astype(np.int64), axis=0)
    solid = points
    for w in complement(points):
        solid = np.concatenate([solid, solid + w // np.gcd.reduce(w)])
    for attempt in range(20):
        moved = solid + np.random.default_rng(attempt).uniform(-SHIFT, SHIFT, solid.shape) * 4 ** attempt
        tri = _simplices(moved)
        if tri is not None:
            break
    else:
        raise ArithmeticError("no general position found")
    p = solid[tri[:, 0]]
    normal = np.cross(solid[tri[:, 1]] - p, solid[tri[:, 2]] - p)
    normal = normal[normal.any(axis=1)]
    normal = np.unique(normal // np.gcd.reduce(normal, axis=1)[:, None], axis=0)
    return np.column_stack([normal, (points @ normal.T).max(axis=0)])


#: Pairs of points, over all sets, whose hulls are searched at a time.
PAIRS = 1 << 24


def _cross(u: np.ndarray, v: np.ndarray) -> np.ndarray:
    return np.stack([u[:, 1] * v[:, 2] - u[:, 2] * v[:, 1], u[:, 2] * v[:, 0] - u[:, 0] * v[:, 2], u[:, 0] * v[:, 1] - u[:, 1] * v[:, 0]], axis=1)


def _dot(u: np.ndarray, v: np.ndarray) -> np.ndarray:
    return u[:, 0] * v[:, 0] + u[:, 1] * v[:, 1] + u[:, 2] * v[:, 2]


def _starts(owner: np.ndarray) -> np.ndarray:
    return np.searchsorted(owner, np.arange(owner[-1] + 1))


def _greatest(values: np.ndarray, owner: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Position of the (first) greatest value of every set."""
    at = np.flatnonzero(values == np.maximum.reduceat(values, starts)[owner])
    return at[np.searchsorted(owner[at], np.arange(len(starts)))]


def _thickened(points: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The sets, flat ones with copies moved along the directions they miss."""
    starts = _starts(owner)
    d = points - points[starts][owner]
    across = _cross(d[_greatest(np.abs(d).sum(axis=1), owner, starts)][owner], d)
    normal = across[_greatest(np.abs(across).sum(axis=1), owner, starts)]
    flat = np.flatnonzero(np.maximum.reduceat(np.abs(_dot(d, normal[owner])), starts) == 0)
    ends = np.append(starts, len(points))
    parts, owners = [points], [owner]
    for s in flat:
        own = points[ends[s]:ends[s + 1]]
        thick = own
        for w in complement(own):
            thick = np.concatenate([thick, thick + w // np.gcd.reduce(w)])
        parts.append(thick[len(own):])
        owners.append(np.full(len(thick) - len(own), s))
    owner = np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    return np.concatenate(parts)[order], owner[order]


def _simplices_each(x: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """``_simplices`` of many sets in step: the triangles, the set of each, and whether a set was in general position. In every round each set takes its next point."""
    starts = _starts(owner)
    sets = np.arange(len(starts))
    a = _greatest(-x[:, 0], owner, starts)
    d = x - x[a][owner]
    b = _greatest(_dot(d, d), owner, starts)
    across = _cross(d[b][owner], d)
    c = _greatest(_dot(across, across), owner, starts)
    e = _greatest(np.abs(_dot(d, across[c][owner])), owner, starts)
    centre = (x[a] + x[b] + x[c] + x[e]) / 4

    def planes(tri: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        p = x[tri[:, 0]]
        n = _cross(x[tri[:, 1]] - p, x[tri[:, 2]] - p)
        inward = _dot(centre[of] - p, n) > 0
        tri[inward] = tri[inward][:, [0, 2, 1]]
        n[inward] *= -1
        return tri, n, _dot(n, p)

    of = np.tile(sets, 4)
    tri, normal, level = planes(np.concatenate([np.column_stack(f) for f in ((a, b, c), (a, b, e), (a, c, e), (b, c, e))]), of)
    # the outermost points first: the hulls are nearly whole when the many inner ones are tested
    free = np.ones(len(x), bool)
    free[np.concatenate([a, b, c, e])] = False
    rest = np.flatnonzero(free)
    rest = rest[np.lexsort((-_dot(x - centre[owner], x - centre[owner])[rest], owner[rest]))]
    turn = np.arange(len(rest)) - np.searchsorted(owner[rest], owner[rest])
    rest = rest[np.argsort(turn, kind="stable")]
    rounds = np.append(0, np.cumsum(np.bincount(turn)))
    local = np.arange(len(x)) - starts[owner]
    width = int(local.max()) + 1
    marked, good = np.zeros(len(sets) * width * width, bool), np.ones(len(sets), bool)
    for first, last in zip(rounds, rounds[1:]):
        point = np.full(len(sets), -1)
        point[owner[rest[first:last]]] = rest[first:last]
        point[~good] = -1
        q = point[of]
        seen = (q >= 0) & (_dot(normal, x[q]) > level)
        if not seen.any():
            continue
        lit, by = tri[seen], np.tile(of[seen], 3)
        edges = np.concatenate([lit[:, [0, 1]], lit[:, [1, 2]], lit[:, [2, 0]]])
        u, v = local[edges[:, 0]], local[edges[:, 1]]
        code = (by * width + u) * width + v
        marked[code] = True
        rim = ~marked[(by * width + v) * width + u]
        marked[code] = False
        edges, by = edges[rim], by[rim]
        # a rim that is no simple ring tells that the points were not in general position
        twice = np.bincount(edges[:, 0], minlength=1) > 1
        good[owner[np.flatnonzero(twice)]] = False
        short = np.bincount(by, minlength=len(sets)) < 3
        good[of[seen][short[of[seen]]]] = False
        fresh = planes(np.column_stack([edges, point[by]]), by)
        tri, normal, level = (np.concatenate([old[~seen], new]) for old, new in zip((tri, normal, level), fresh))
        of = np.concatenate([of[~seen], by])
    return tri, of, good


def _ranges(sizes: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of sets of which as many as pairs of their points may be marked at a time."""
    first, width = 0, 0
    for s, size in enumerate(sizes.tolist()):
        if s > first and (s + 1 - first) * max(width, size) ** 2 > PAIRS:
            yield first, s
            first, width = s, 0
        width = max(width, size)
    yield first, len(sizes)


def half_spaces_each(points: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """``half_spaces`` of many sets of distinct points, found together: the set of each row (ascending), and the rows (a, b, c, h). ``owner`` is the set of each point, from 0
    on and ascending."""
    points = points.astype(np.int64)
    solid, thick = _thickened(points, owner)
    moved = solid + np.random.default_rng(0).uniform(-SHIFT, SHIFT, solid.shape)
    ends = np.append(_starts(thick), len(thick))
    found = []
    for first, last in _ranges(np.diff(ends)):
        a, b = ends[first], ends[last]
        tri, of, good = _simplices_each(moved[a:b], thick[a:b] - first)
        found.append((tri + a, of + first, good))
    tri, of, good = map(np.concatenate, zip(*found))
    p = solid[tri[:, 0]]
    normal = _cross(solid[tri[:, 1]] - p, solid[tri[:, 2]] - p)
    kept = normal.any(axis=1) & good[of]
    normal, of = normal[kept], of[kept]
    normal //= np.gcd.reduce(normal, axis=1)[:, None]
    bound = int(np.abs(normal).max(initial=0))
    side = 2 * bound + 1
    code = ((of * side + normal[:, 0] + bound) * side + normal[:, 1] + bound) * side + normal[:, 2] + bound
    _, at = np.unique(code, return_index=True)
    normal, of = normal[at], of[at]
    # the level is the exact maximum over the points, here of sets padded to one length
    starts = _starts(owner)
    sizes = np.diff(np.append(starts, len(owner)))
    level = np.full(len(of), np.iinfo(np.int64).min)
    for n in range(int(sizes.max())):
        level = np.maximum(level, _dot(normal, points[starts + np.minimum(n, sizes - 1)][of]))
    rows = np.column_stack([normal, level])
    bad = np.flatnonzero(~good)
    if len(bad):
        alone = [half_spaces(points[owner == s]) for s in bad]
        of = np.concatenate([of, np.repeat(bad, [len(r) for r in alone])])
        rows = np.concatenate([rows, *alone])
        order = np.argsort(of, kind="stable")
        of, rows = of[order], rows[order]
    return of, rows
