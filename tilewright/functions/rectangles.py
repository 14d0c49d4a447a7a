"""Outlines of regions that upright rectangles make, of many groups at once, as arrays.

Coordinates become their ranks within a group, which makes a group a small raster. Sums over
differences in the rectangles' corners tell how many of them cover each place, and sides run
where neighbouring places differ. A raster of more than PLACES is halved until it has fewer, so
memory doesn't grow with a group, and rectangles that are small have few ranks in a part.
"""

from __future__ import annotations

import numpy as np

#: Places of rasters that are worked on at once.
PLACES = 1 << 20


def _ranks(group: np.ndarray, values: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Ranks of values among the distinct ones of their group, where each group's distinct values begin, and these."""
    order = np.lexsort((values, group))
    g, v = group[order], values[order]
    new = np.ones(len(v), bool)
    new[1:] = (g[1:] != g[:-1]) | (v[1:] != v[:-1])
    start = np.searchsorted(g[new], np.arange(n + 1))
    rank = np.empty(len(v), np.int64)
    rank[order] = np.cumsum(new) - 1
    return rank - start[group], start, v[new]


def _order(*keys: np.ndarray) -> np.ndarray:
    """Places of rows in the order of keys, which are whole numbers from 0."""
    spans = [int(k.max()) + 1 for k in keys]
    if np.prod([float(s) for s in spans]) >= 2**62:
        return np.lexsort(keys[::-1])
    code = np.zeros(len(keys[0]), np.int64)
    for k, s in zip(keys, spans):
        code = code * s + k
    return np.argsort(code, kind="stable")


def _sides(unit: np.ndarray, ranks: np.ndarray, frames: np.ndarray, weights: list[np.ndarray], labels) -> list[np.ndarray]:
    """which, unit, label, ax, ay, bx, by, direction (0 east, 1 north, 2 west, 3 south) of sides, the labelled place on their left.

    frames: the places [x0, x1) by [y0, y1) of each unit, whose sides left of and below them are given; ranks reach one
    place further to the left and down, so that a side between two units is met by one of them.
    """
    k, m = len(unit), len(frames)
    own = np.arange(m)
    size, start, value, low, high = [], [], [], [], []
    for axis in (0, 1):
        group = np.concatenate((unit, unit, own, own, own))
        rank, at, distinct = _ranks(group, np.concatenate((ranks[:, axis], ranks[:, axis + 2], frames[:, axis] - 1, frames[:, axis], frames[:, axis + 2])), m)
        size.append(np.diff(at))
        start.append(at)
        value.append(distinct)
        low.append(rank[:k])
        high.append(rank[k : 2 * k])
    nx, ny = size
    begin = np.concatenate(([0], np.cumsum(nx * ny)))
    at = np.repeat(own, nx * ny)
    wide = nx[at]
    iy, ix = np.divmod(np.arange(begin[-1]) - begin[at], wide)
    turned = begin[at] + ix * ny[at] + iy
    corner = lambda x, y: begin[unit] + x * ny[unit] + y
    corners = np.concatenate((corner(low[0], low[1]), corner(high[0], high[1]), corner(high[0], low[1]), corner(low[0], high[1])))
    # Every row and column of differences adds up to 0, so one running sum does for all of them.
    depths = [np.rint(np.cumsum(np.cumsum(np.bincount(corners, np.concatenate((w, w, -w, -w)), begin[-1]))[turned])) for w in weights]
    inner = np.flatnonzero((ix > 0) & (iy > 0) & (ix < wide - 1) & (iy < ny[at] - 1))
    out = []
    for which, label in enumerate(labels(*depths)):
        for beside, upright in ((inner - 1, True), (inner - wide[inner], False)):
            differ = label[inner] != label[beside]
            here, there = inner[differ], beside[differ]
            u = at[here]
            px, py = start[0][u] + ix[here], start[1][u] + iy[here]
            x, y = value[0][px], value[1][py]
            end = (x, value[1][py + 1]) if upright else (value[0][px + 1], y)
            for own_label, back, way in ((label[here], upright, 3 if upright else 0), (label[there], not upright, 1 if upright else 2)):
                has = own_label >= 0
                p, q = ((end, (x, y)) if back else ((x, y), end))
                out.append(np.stack([np.full(has.sum(), which), u[has], own_label[has], p[0][has], p[1][has], q[0][has], q[1][has], np.full(has.sum(), way)]).astype(np.int64))
    return np.concatenate(out, axis=1)


def _parts(ranks: np.ndarray, frame: np.ndarray):
    """Frames of parts of a group with few enough places, each with its rectangles and their ranks held within it."""
    left = [(np.arange(len(ranks)), frame)]
    while left:
        rows, f = left.pop()
        r = ranks[rows]
        rows = rows[(r[:, 0] < f[2]) & (r[:, 2] >= f[0]) & (r[:, 1] < f[3]) & (r[:, 3] >= f[1])]
        held = np.clip(ranks[rows], np.tile(f[:2] - 1, 2), np.tile(f[2:], 2))
        cuts = [np.unique(np.append(held[:, [axis, axis + 2]], [f[axis] - 1, f[axis], f[axis + 2]])) for axis in (0, 1)]
        if len(cuts[0]) * len(cuts[1]) <= PLACES:
            yield rows, held, f
            continue
        axis = int(len(cuts[1]) > len(cuts[0]))
        middle = cuts[axis][len(cuts[axis]) // 2]
        for side, bound in ((axis + 2, middle), (axis, middle)):
            half = f.copy()
            half[side] = bound
            left.append((rows, half))


def outlines(group: np.ndarray, boxes: np.ndarray, weights: list[np.ndarray], labels) -> tuple[np.ndarray, ...]:
    """which, group, label and length of rings, and the x and y of all their corners: where labels(*depths) are alike and not -1.

    group: whole numbers in rising order; boxes: rows of x0, y0, x1, y1 with an area; weights: a number for each box, of
    which depths has the sums over the boxes that cover a place; labels gives one or more arrays. Outer rings run
    counter-clockwise, holes clockwise, rings that touch in a corner are apart.
    """
    n = int(group[-1]) + 1 if len(group) else 0
    twice = np.concatenate((group, group))
    axes = [_ranks(twice, np.concatenate((boxes[:, axis], boxes[:, axis + 2])), n) for axis in (0, 1)]
    k = len(group)
    ranks = np.stack([axes[0][0][:k], axes[1][0][:k], axes[0][0][k:], axes[1][0][k:]], axis=1)
    width, height = np.diff(axes[0][1]), np.diff(axes[1][1])
    frames = np.stack([np.zeros(n, np.int64), np.zeros(n, np.int64), width, height], axis=1)
    places = (width + 2) * (height + 2)
    first = np.searchsorted(group, np.arange(n + 1))
    found, g = [np.zeros((8, 0), np.int64)], 0
    while g < n:
        if places[g] > PLACES:
            rows = np.arange(first[g], first[g + 1])
            for some, held, frame in _parts(ranks[rows], frames[g]):
                made = _sides(np.zeros(len(some), np.int64), held, frame[None], [w[rows[some]] for w in weights], labels)
                made[1] = g
                found.append(made)
            g += 1
            continue
        end = g + max(1, int(np.searchsorted(np.cumsum(places[g:]), PLACES, side="right")))
        rows = slice(first[g], first[end])
        made = _sides(group[rows] - g, ranks[rows], frames[g:end], [w[rows] for w in weights], labels)
        made[1] += g
        found.append(made)
        g = end
    which, own, label, ax, ay, bx, by, way = np.concatenate(found, axis=1)
    if not len(which):
        return (*np.zeros((4, 0), np.int64), *np.zeros((2, 0)))
    order = _order(which, own, label)
    sorted_ = np.stack([which, own, label])[:, order]
    keys = np.empty(len(order), np.int64)
    keys[order] = np.concatenate(([0], np.cumsum((sorted_[:, 1:] != sorted_[:, :-1]).any(axis=0))))
    # What enters a corner goes on to its left where two sides leave it, which keeps the place on its left.
    follow = np.empty(len(order), np.int64)
    follow[_order(keys, bx, by, (way + 1) % 4)] = _order(keys, ax, ay, way)
    bend = np.empty(len(order), bool)
    bend[follow] = way[follow] != way
    path, ends, seen, to = [], [], bytearray(len(order)), follow.tolist()
    for at in range(len(to)):
        if not seen[at]:
            while not seen[at]:
                seen[at] = 1
                path.append(at)
                at = to[at]
            ends.append(len(path))
    path, ends = np.array(path), np.array(ends)
    begin = np.concatenate(([0], ends[:-1]))
    length = np.add.reduceat(bend[path].astype(np.int64), begin)
    head, corner = path[begin], path[bend[path]]
    return which[head], own[head], label[head], length, axes[0][2][axes[0][1][own[corner]] + ax[corner]], axes[1][2][axes[1][1][own[corner]] + ay[corner]]
