"""Anatomical rules on dense label maps of a small grid, as they are inside a task.

Every rule is the operator of the same name in ``parcellation``, which calls it for arrays. Maps lie along the last axis, (ni, nj, nk, number of maps), so a step works on
the same voxel of all maps at once; label 0 is an absent voxel. A sided result is 0, 1 (left) or 2 (right), ``SIDES``.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np

from ..functions import regions as R
from ..functions.hull import half_spaces_each
from ..schema import Dims
from .components import merge_pairs

SIDES = {"L": 1, "R": 2}
#: Half-spaces times lines that are held at a time.
BOUNDS = 1 << 18


def recode(labels: np.ndarray, table: dict[int, int]) -> np.ndarray:
    """New values of the labels in ``table``, 0 for the others."""
    top = max(table)
    values = np.zeros(top + 2, np.int32)
    values[list(table)] = list(table.values())
    return values[np.clip(labels, 0, top + 1)]


def marked(labels: np.ndarray, codes: Sequence[int]) -> np.ndarray:
    return recode(labels, dict.fromkeys(codes, 1)) > 0


def sided(labels: np.ndarray, members: dict[str, Sequence[int]]) -> np.ndarray:
    """Side of the voxels of the given labels; the left one first, where both have a label."""
    return recode(labels, {v: SIDES[s] for s in "RL" for v in members[s]}).astype(np.int8)


def white_matter(labels: np.ndarray) -> np.ndarray:
    return sided(labels, {s: [c] for s, c in R.WHITE_MATTER.items()})


def both_sides(x: np.ndarray) -> np.ndarray:
    """Masks of the left sides of all maps, then of the right ones."""
    return np.concatenate([x == SIDES["L"], x == SIDES["R"]], axis=-1)


def halves(masks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return masks[..., :masks.shape[-1] // 2], masks[..., masks.shape[-1] // 2:]


def on_white_matter(masks: np.ndarray, wm: np.ndarray) -> np.ndarray:
    """Sides of the voxels of the masks of both sides on the white matter of their own."""
    left, right = halves(masks)
    return np.where(((wm == SIDES["L"]) & left) | ((wm == SIDES["R"]) & right), wm, 0).astype(np.int8)


def _neighbours() -> Iterator[tuple[tuple[slice, ...], tuple[slice, ...]]]:
    """Cells and the next ones along each axis."""
    for axis in range(3):
        before = (slice(None),) * axis
        yield (*before, slice(None, -1)), (*before, slice(1, None))


def grown(masks: np.ndarray, steps: int) -> np.ndarray:
    """Cells within taxicab distance ``steps`` of the masks."""
    for _ in range(steps):
        wider = masks.copy()
        for low, high in _neighbours():
            wider[low] |= masks[high]
            wider[high] |= masks[low]
        if np.array_equal(wider, masks):
            break
        masks = wider
    return masks


def cores(masks: np.ndarray, r: int, border_erodes: bool = False) -> np.ndarray:
    """Cells at taxicab distance of at least ``r`` from the others, and with ``border_erodes`` from the outside of the grid."""
    kept = masks & ~grown(~masks, r - 1)
    if border_erodes:
        inside = np.zeros(masks.shape, bool)
        inside[tuple(slice(r - 1, max(n - r + 1, 0)) for n in masks.shape[:3])] = True
        kept &= inside
    return kept


def closed(masks: np.ndarray, r: int) -> np.ndarray:
    return cores(grown(masks, r), r)


def opened(masks: np.ndarray, steps: int) -> np.ndarray:
    return grown(cores(masks, steps + 1, True), steps)


def nearest(seeds: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """Label of the nearest seed (chessboard metric, smallest label on ties) of the wanted cells, 0 where there is none.

    A round reaches the cells one step further; those take the smallest label among their neighbours, which are one step nearer to the same seeds.
    """
    far = np.int32(np.iinfo(np.int32).max)
    front = np.where(seeds > 0, seeds.astype(np.int32), far)
    wanted = wanted & (seeds > 0).any(axis=(0, 1, 2))
    while ((front == far) & wanted).any():
        wider = front
        for low, high in _neighbours():
            line = wider.copy()
            np.minimum(line[low], wider[high], out=line[low])
            np.minimum(line[high], wider[low], out=line[high])
            wider = line
        front = np.where(front == far, wider, front)
    return np.where(wanted, front, 0)


def _corners(masks: np.ndarray) -> np.ndarray:
    """Cells that do not lie between two others along an axis: all corners of the hulls are among them."""
    found = masks.copy()
    for axis in range(3):
        line, kept = np.moveaxis(masks, axis, 0), np.moveaxis(found, axis, 0)
        before, after = line[0].copy(), np.logical_or.accumulate(line[::-1], axis=0)[::-1]
        for n in range(1, len(line) - 1):
            kept[n] &= ~(before & after[n + 1])
            before |= line[n]
    return found


def hull(masks: np.ndarray) -> np.ndarray:
    """Cells inside the convex hulls of the masks, borders included; exact, also for flat masks."""
    ni, nj, nk, _ = masks.shape
    out = np.zeros(masks.shape, bool)
    *points, names = np.nonzero(_corners(masks))
    if not len(names):
        return out
    order = np.argsort(names, kind="stable")
    points = np.column_stack(points)[order]
    names, owner = np.unique(names[order], return_inverse=True)
    of, planes = half_spaces_each(points, owner)
    i, j = (x.reshape(-1) for x in np.indices((ni, nj)))
    k = np.arange(nk)[:, None]
    step = max(1, int(BOUNDS * len(names) / (ni * nj * len(of))))
    for first in range(0, len(names), step):
        a, b = np.searchsorted(of, [first, first + step])
        starts = np.searchsorted(of[a:b], np.arange(first, min(first + step, len(names))))
        p, q, c, h = (x[:, None].astype(float) for x in planes[a:b].T)
        room = h - p * i - q * j
        # whole numbers: a quotient is at least 1 / c off the next integer, or exact
        end = room / np.where(c == 0, 1.0, c)
        high = np.where(c > 0, np.floor(end), np.where((c == 0) & (room < 0), -np.inf, np.inf))
        low = np.where(c < 0, np.ceil(end), -np.inf)
        high, low = np.minimum.reduceat(high, starts).T[:, None], np.maximum.reduceat(low, starts).T[:, None]
        out[..., names[first:first + step]] = ((low <= k) & (k <= high)).reshape(ni, nj, nk, -1)
    return out


def hyperintensity_to_wm(labels: np.ndarray, dims: Dims) -> np.ndarray:
    hyper = labels == R.HYPERINTENSITY
    at = np.flatnonzero(hyper)
    if not len(at):
        return labels
    number = np.full(labels.size, -1)
    number[at] = np.arange(len(at))
    number = number.reshape(labels.shape)
    pairs = [(number[low][both], number[high][both]) for low, high in _neighbours() for both in (hyper[low] & hyper[high],)]
    root = merge_pairs(len(at), *map(np.concatenate, zip(*pairs)))
    touching, all_of = [], []
    for code in (R.WHITE_MATTER["L"], R.WHITE_MATTER["R"]):
        wm = labels == code
        touching.append(np.bincount(root, weights=grown(wm, 1).reshape(-1)[at], minlength=len(at))[root])
        all_of.append(wm.sum(axis=(0, 1, 2))[at % labels.shape[-1]])
    (l, r), (al, ar) = touching, all_of
    out = labels.copy()
    out.reshape(-1)[at] = np.where((l > r) | ((l == r) & (al >= ar)), R.WHITE_MATTER["L"], R.WHITE_MATTER["R"])
    return out


def lobe_tables() -> tuple[dict[int, int], dict[str, list[int]], dict[int, int]]:
    """Codes of the seeds of lobes, labels to be filled per side, codes of the other structures."""
    shift = {"L": 0, "R": R.RIGHT_PARCEL}
    seeds = {p + shift[s]: R.code(lobe, s) for s in "LR" for lobe, ps in R.LOBE_PARCELS.items()
             for p in ps if p not in R.FILLED_PARCELS}
    others = {v: R.code(name, s) for name, sides in R.STRUCTURES.items() for s, vs in zip("LR", sides) for v in vs}
    others[R.BRAINSTEM] = R.BRAINSTEM_CODE
    return seeds, {s: [R.WHITE_MATTER[s]] + [p + shift[s] for p in R.FILLED_PARCELS] for s in "LR"}, others


def lobar_labels(labels: np.ndarray, dims: Dims) -> np.ndarray:
    seeds, open_labels, others = lobe_tables()
    lobes = recode(labels, seeds)
    own = both_sides(sided(labels, {s: [v for v in seeds if (v >= 2000) == (s == "R")] for s in "LR"}))
    filled = nearest(np.where(own, np.concatenate([lobes, lobes], axis=-1), 0), both_sides(sided(labels, open_labels)))
    # a voxel has one label, so it is a seed, filled or another structure
    return lobes + sum(halves(filled)) + recode(labels, others)


def internal_capsule(labels: np.ndarray, dims: Dims) -> np.ndarray:
    return on_white_matter(cores(hull(both_sides(sided(labels, R.CAPSULE_NUCLEI))), 3, True), white_matter(labels))


def juxtacortical_wm(labels: np.ndarray, dims: Dims, thickness: int) -> np.ndarray:
    parcels = [p for ps in R.LOBE_PARCELS.values() for p in ps]
    near = grown(marked(labels, parcels + [p + R.RIGHT_PARCEL for p in parcels]), thickness)
    return np.where(near, white_matter(labels), 0)


def periventricular(labels: np.ndarray, dims: Dims, thickness: int) -> np.ndarray:
    ventricles = marked(labels, R.VENTRICLES["L"] + R.VENTRICLES["R"])
    return grown(ventricles, thickness) & ~ventricles


def external_capsule(labels: np.ndarray, dims: Dims, exclude: np.ndarray, reach: int, low: int, closing: int) -> np.ndarray:
    wm = white_matter(labels)
    putamen, insula = (both_sides(sided(labels, {s: [part[s]] for s in "LR"})) for part in (R.PUTAMEN, R.INSULA))
    walls = putamen | insula
    barred = exclude | grown(marked(labels, R.HIPPOCAMPUS_VENTRAL_DC), low)
    raw = hull(walls) & grown(putamen, reach) & grown(insula, reach) & ~np.concatenate([barred, barred], axis=-1)
    return on_white_matter(closed((raw & both_sides(wm)) | walls, closing) & ~walls, wm)


def corpus_callosum(labels: np.ndarray, dims: Dims, ventricle_reach: int, cingulum_closing: int, growth: int, opening: int) -> np.ndarray:
    wm = white_matter(labels)
    own = marked(labels, R.CORPUS_CALLOSUM)
    has_own = own.any(axis=(0, 1, 2))
    out = np.zeros(labels.shape, np.int8)
    if has_own.any():
        around = grown(own[..., has_own], 1)
        out[..., has_own] = nearest(np.where(around, wm[..., has_own], 0), around)
    if not has_own.all():
        rest, wm = labels[..., ~has_own], wm[..., ~has_own]
        fornix = closed(marked(rest, R.LATERAL_VENTRICLES) | grown(marked(rest, [R.THIRD_VENTRICLE]), ventricle_reach), ventricle_reach)
        cingulate = {"L": R.CINGULATE_PARCELS, "R": [v + R.RIGHT_PARCEL for v in R.CINGULATE_PARCELS]}
        left, right = halves(closed(both_sides(sided(rest, cingulate)), cingulum_closing))
        free = (wm > 0) & ~fornix & ~left & ~right
        left, right = halves(grown(both_sides(wm), 1))
        body = opened(grown(left & right & free, growth) & free, opening)
        out[..., ~has_own] = np.where(body, wm, 0)
    return out
