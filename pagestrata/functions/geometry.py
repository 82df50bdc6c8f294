"""Geometry over page arrays: expressions where Catalyst has them, Arrow-batched functions where it has not."""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F


def segment_length(sx, sy, ex, ey) -> Column:
    return F.hypot(ex - sx, ey - sy)


def segment_angle(sx, sy, ex, ey) -> Column:
    """Degrees in [0, 180)."""
    return F.pmod(F.degrees(F.atan2(ey - sy, ex - sx)), F.lit(180.0))


def is_grid(angle: Column) -> Column:
    return F.least(F.abs(angle), F.abs(angle - 90), F.abs(angle - 180)) < 2


def angle_bin(angle: Column) -> Column:
    return F.least(F.floor(angle / 5), F.lit(35)).cast("int")


def greedy_clusters(keys: Column, tolerance: float = 10.0) -> Column:
    """Number of the first cluster, in order of founding, whose founding key is within tolerance of each key; else a new one."""
    empty = F.struct(F.array().cast("array<double>").alias("founders"), F.array().cast("array<int>").alias("out"))

    def step(a, key):
        place = F.get(F.filter(F.transform(a["founders"], lambda f, i: F.struct((F.abs(f - key) <= tolerance).alias("hit"), i.alias("i"))), lambda x: x["hit"]), F.lit(0))["i"]
        return F.struct(F.when(place.isNull(), F.concat(a["founders"], F.array(key))).otherwise(a["founders"]).alias("founders"), F.concat(a["out"], F.array(F.coalesce(place, F.size(a["founders"])).cast("int"))).alias("out"))

    return F.aggregate(keys, empty, step, lambda a: a["out"])


def greedy(keys: list[float], tolerance: float = 10.0) -> list[int]:
    """greedy_clusters() of plain numbers."""
    founders: list[float] = []
    out = []
    for key in keys:
        place = next((i for i, f in enumerate(founders) if abs(f - key) <= tolerance), len(founders))
        if place == len(founders):
            founders.append(key)
        out.append(place)
    return out


def union_area_of(boxes: np.ndarray) -> float:
    """Area covered by boxes (x0, y0, x1, y1), by a sweep over compressed coordinates."""
    boxes = boxes[(boxes[:, 2] > boxes[:, 0]) & (boxes[:, 3] > boxes[:, 1])] if len(boxes) else boxes
    if not len(boxes):
        return 0.0
    # boxes by top: those of one horizontal band are swept together, so that memory follows the boxes of a band
    order = np.argsort(boxes[:, 1], kind="stable")
    boxes, reach = boxes[order], np.maximum.accumulate(boxes[order, 3])
    cuts = np.r_[0, np.flatnonzero(boxes[1:, 1] >= reach[:-1]) + 1, len(boxes)]
    return float(sum(_band_area(boxes[i:j]) for i, j in zip(cuts[:-1], cuts[1:], strict=True)))


def _band_area(boxes: np.ndarray) -> float:
    if len(boxes) == 1:
        return float((boxes[0, 2] - boxes[0, 0]) * (boxes[0, 3] - boxes[0, 1]))
    xs, ys = np.unique(boxes[:, [0, 2]]), np.unique(boxes[:, [1, 3]])
    cover = np.zeros((len(xs), len(ys)), np.int32)
    a, b, c, d = (np.searchsorted(g, boxes[:, k]) for g, k in ((xs, 0), (ys, 1), (xs, 2), (ys, 3)))
    for i, j, v in ((a, b, 1), (c, d, 1), (a, d, -1), (c, b, -1)):
        np.add.at(cover, (i, j), v)
    cover = cover.cumsum(0).cumsum(1) > 0
    return float((cover[:-1, :-1] * np.diff(xs)[:, None] * np.diff(ys)[None, :]).sum())


def block_labels(boxes: np.ndarray, margin: float = 15.0) -> np.ndarray:
    """Block number of each line, in order of its first line; lines whose boxes overlap after `margin` is added above and below share a block.

    Lines are swept by their top; each meets only those that still reach it.
    """
    n = len(boxes)
    up = list(range(n))

    def root(i: int) -> int:
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    rows, active = boxes.tolist(), []
    for i in np.argsort(boxes[:, 1], kind="stable").tolist() if n else ():
        x0, y0, x1, y1 = rows[i]
        active = [j for j in active if rows[j][3] + margin > y0]
        for j in active:
            if x0 < rows[j][2] and rows[j][0] < x1 and rows[j][1] - margin < y1:
                a, b = root(i), root(j)
                up[max(a, b)] = min(a, b)
        active.append(i)
    return np.unique([root(i) for i in range(n)], return_inverse=True)[1] if n else np.zeros(0, int)


def components(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Least member of the component of each of n nodes under edges a, b."""
    root = np.arange(n)
    while True:
        low, high = np.minimum(root[a], root[b]), np.maximum(root[a], root[b])
        apart = low < high
        if not apart.any():
            return root
        a, b = a[apart], b[apart]
        np.minimum.at(root, high[apart], low[apart])
        while (root[root] != root).any():
            root = root[root]


def reach_of(page: np.ndarray, value: np.ndarray) -> np.ndarray:
    """Greatest value so far within a page; page ascends."""
    if not len(value):
        return value
    ordered, rank = np.unique(value, return_inverse=True)
    return ordered[np.maximum.accumulate(page * len(ordered) + rank) - page * len(ordered)]


def paged_blocks(boxes: np.ndarray, page: np.ndarray, margin: float = 15.0, steps: int = 64) -> np.ndarray:
    """block_labels() of the lines of many pages at once, numbered on from page to page; page ascends from 0.

    Each line, by top, meets the one before it, the second before it and so on, while any of its page still reaches it; a page on which one reaches
    over more than `steps` lines is swept by itself.
    """
    order = np.lexsort((boxes[:, 1], page))
    sides, of = boxes[order], page[order]
    reach, a, b = reach_of(of, sides[:, 3]) + margin, [], []
    live = np.arange(len(order))
    for k in range(1, steps + 1):
        live = live[live >= k]
        live = live[(of[live - k] == of[live]) & (reach[live - k] > sides[live, 1])]
        if not len(live):
            break
        one, other = sides[live], sides[live - k]
        met = (other[:, 3] + margin > one[:, 1]) & (one[:, 0] < other[:, 2]) & (other[:, 0] < one[:, 2]) & (other[:, 1] - margin < one[:, 3])
        a.append(order[live[met]])
        b.append(order[live[met] - k])
    root = components(len(boxes), np.concatenate(a), np.concatenate(b)) if a else np.arange(len(boxes))
    for p in np.unique(of[live]).tolist():  # still reached after all steps
        i, j = np.searchsorted(page, [p, p + 1])
        labels = block_labels(boxes[i:j], margin)
        root[i:j] = i + np.unique(labels, return_index=True)[1][labels]
    return np.unique(root, return_inverse=True)[1]


def paged_union_area(boxes: np.ndarray, page: np.ndarray, n: int) -> np.ndarray:
    """union_area_of() the boxes of each of n pages; where they stand one below the other, areas add up."""
    solid = (boxes[:, 2] > boxes[:, 0]) & (boxes[:, 3] > boxes[:, 1])
    boxes, page = boxes[solid], page[solid]
    order = np.lexsort((boxes[:, 1], page))
    boxes, page = boxes[order], page[order]
    out = np.bincount(page, (boxes[:, 2] - boxes[:, 0]) * (boxes[:, 3] - boxes[:, 1]), minlength=n)
    meets = (page[1:] == page[:-1]) & (boxes[1:, 1] < boxes[:-1, 3])
    for p in np.unique(page[1:][meets]).tolist():
        i, j = np.searchsorted(page, [p, p + 1])
        out[p] = union_area_of(boxes[i:j])
    return out


def aligned_clusters(keys: np.ndarray, y0: np.ndarray, height: np.ndarray, threshold: float) -> list[list[int]]:
    """Seeded directed reachability: a member pulls every unassigned line whose key differs by less than threshold and whose
    top is less than five times the member's own height away. Seeds by y0, then position; single lines are no cluster."""
    left, out = list(np.lexsort((np.arange(len(y0)), y0))), []
    while left:
        group, queue = [left[0]], [left.pop(0)]
        while queue:
            i = queue.pop()
            pulled = [j for j in left if abs(keys[j] - keys[i]) < threshold and abs(y0[j] - y0[i]) < 5 * height[i]]
            left = [j for j in left if j not in set(pulled)]
            group += pulled
            queue += pulled
        if len(group) > 1:
            out.append(sorted(group))
    return out


def drop_outlier(values: np.ndarray, which: list[int] | None = None, ratio: float = 0.6) -> np.ndarray:
    """values without the one whose removal shrinks the sample deviation most, if to less than `ratio` of it."""
    if len(values) < 3:
        return values
    whole = values.std(ddof=1)
    if not whole:
        return values
    options = [(np.delete(values, i).std(ddof=1) / whole, i) for i in (which if which is not None else range(len(values)))]
    best, i = min(options)
    return np.delete(values, i) if best < ratio else values


def title_layout(boxes: np.ndarray, words: np.ndarray, width: float, height: np.ndarray | None = None) -> tuple[bool, bool]:
    """(centered, aligned) layout of a page's lines; height: their font sizes, if not those of the boxes."""
    if not len(boxes):
        return False, False
    x0, y0, x1, y1 = boxes.T
    center, tall, near, total = x0 + (x1 - x0) / 2, np.abs(y1 - y0) if height is None else height, 0.05 * width, max(words.sum(), 1)
    kept = 0
    for g in aligned_clusters(center, y0, tall, near):
        left = drop_outlier(x0[g])
        if len(left) > 1 and left.std(ddof=1) >= near:
            kept += words[g].sum()
    free, clustered = np.arange(len(boxes)), 0
    for key in (x0, x1, center):
        used: list[int] = []
        for g in aligned_clusters(key[free], y0[free], tall[free], near):
            used += g
        clustered += words[free[used]].sum() if used else 0
        free = np.delete(free, used)
    return bool(kept / total > 0.75), bool(clustered / total > 0.8)
