"""Boxes, cells and areas in planar degrees."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BOX = ("minx", "miny", "maxx", "maxy")


def bbox_agg(df: DataFrame, keys: list[str]) -> DataFrame:
    """The bounding box of each group of boxes."""
    return df.groupBy(*keys).agg(
        F.min("minx").alias("minx"), F.min("miny").alias("miny"), F.max("maxx").alias("maxx"), F.max("maxy").alias("maxy")
    )


def cells(low: Column, high: Column, width: float) -> Column:
    """Numbers of all cells that an interval touches."""
    return F.sequence(F.floor(low / width), F.floor(high / width))


def boxes_overlap(a: str, b: str) -> Column:
    """Positive shared area of two boxes, given by the aliases of their frames."""
    return (
        (F.col(f"{a}.minx") < F.col(f"{b}.maxx"))
        & (F.col(f"{b}.minx") < F.col(f"{a}.maxx"))
        & (F.col(f"{a}.miny") < F.col(f"{b}.maxy"))
        & (F.col(f"{b}.miny") < F.col(f"{a}.maxy"))
    )


def out_of_range(minx: Column, maxx: Column) -> Column:
    """Boxes that cross the date line, which are reported and not split."""
    return (minx < -180) | (maxx > 180)


#: Corners from which on a mosaic is swept by itself.
MANY = 256
#: Entries (an edge in a slab) that are held at a time.
_ENTRIES = 1 << 21
#: Part of a slab's height in which a change of places doesn't count.
_ASIDE = 1e-6


def _spread(first: np.ndarray, count: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each of ``count`` numbers from ``first`` on: which row it belongs to, and the number."""
    row = np.repeat(np.arange(len(first)), count)
    return row, np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count) + first[row]


def _cut(slab: np.ndarray, edge: np.ndarray, low: np.ndarray, high: np.ndarray, x: np.ndarray, y: np.ndarray, slope: np.ndarray):
    """Slabs cut until no two edges change places inside one.

    Entries (``slab``, ``edge``) in slabs ``low`` to ``high``. Where neighbours at the lower
    side stand the other way round at the upper one, the slab is cut where they cross; a
    slab with any two edges that change places has such neighbours.
    """
    done_slab, done_edge, done_low, done_high, done_from, base = [], [], [], [], [], 0
    origin, thin = np.arange(len(low)), 1e-12 * (high.max() - low.min())
    while len(slab):
        at = x[edge] + (low[slab] - y[edge]) * slope[edge]
        run = (high[slab] - low[slab]) * slope[edge]
        # a little inside both sides, as edges that cross at a side stand in either order there
        order = np.lexsort((at + (1 - _ASIDE) * run, at + _ASIDE * run, slab))
        slab, edge, at, run = slab[order], edge[order], at[order], run[order]
        to = at + (1 - _ASIDE) * run
        i = np.flatnonzero((slab[1:] == slab[:-1]) & (to[1:] < to[:-1]))
        i = i[(high - low)[slab[i]] > thin]
        when = (at[i + 1] - at[i]) / (run[i] - run[i + 1])
        of = slab[i]
        heights = low[of] + when * (high[of] - low[of])
        again = np.zeros(len(low), bool)
        again[of] = True
        rest = again[slab]
        number = np.cumsum(~again) - 1
        done_slab.append(number[slab[~rest]] + base)
        done_edge.append(edge[~rest])
        done_low.append(low[~again])
        done_high.append(high[~again])
        done_from.append(origin[~again])
        base += int((~again).sum())
        slab, edge = slab[rest], edge[rest]
        if not len(slab):
            break
        # the slabs to cut, each from its lower side over its cuts to its upper side
        which = np.concatenate([np.flatnonzero(again), of, np.flatnonzero(again)])
        side = np.concatenate([low[again], heights, high[again]])
        order = np.lexsort((side, which))
        which, side = which[order], side[order]
        whole = (which[1:] == which[:-1]) & (side[1:] > side[:-1])
        parent = which[:-1][whole]
        pieces = np.bincount(parent, minlength=len(low))
        first = np.cumsum(pieces) - pieces
        row, new = _spread(first[slab], pieces[slab])
        edge = edge[row]
        slab, low, high, origin = new, side[:-1][whole], side[1:][whole], origin[parent]
    join = np.concatenate
    return join(done_slab), join(done_edge), join(done_low), join(done_high), join(done_from)


def _widths(x: np.ndarray, ring: np.ndarray, low: float, high: float) -> np.ndarray:
    """For each line (row of ``x``) the length of [low, high] that rings cover which cross it at ``x``, each filled even-odd."""
    order = np.argsort(x, 1)
    order = np.take_along_axis(order, np.argsort(ring[order], 1, kind="stable"), 1)
    x = np.clip(np.take_along_axis(x, order, 1), low, high)
    a, b = x[:, ::2], x[:, 1::2]
    order = np.argsort(a, 1)
    a, b = np.take_along_axis(a, order, 1), np.take_along_axis(b, order, 1)
    before = np.maximum.accumulate(np.concatenate([np.full((len(b), 1), low), b[:, :-1]], 1), 1)
    return np.maximum(b - np.maximum(a, before), 0).sum(1)


def _swept(rings: list[np.ndarray], box: tuple[float, float, float, float]) -> float:
    """The area of one large mosaic, slab by slab: only edges of one slab are held against each other."""
    minx, miny, maxx, maxy = box
    nxt = np.concatenate([np.roll(r, -1, axis=0) for r in rings])
    at = np.concatenate(rings)
    ring = np.repeat(np.arange(len(rings)), [len(r) for r in rings])
    keep = at[:, 1] != nxt[:, 1]
    (x1, y1), (x2, y2), ring = at[keep].T, nxt[keep].T, ring[keep]
    slope = (x2 - x1) / (y2 - y1)
    bottom, top = np.minimum(y1, y2), np.maximum(y1, y2)
    heights = np.unique(np.clip(np.concatenate([[miny, maxy], y1, y2]), miny, maxy))
    total = 0.0
    for low, high in zip(heights[:-1], heights[1:], strict=True):
        on = np.flatnonzero((bottom <= low) & (top >= high))
        if not len(on):
            continue
        start, run = x1[on] + (low - y1[on]) * slope[on], slope[on]
        end = start + (high - low) * run
        cut = [low, high]
        if run.any():
            with np.errstate(divide="ignore", invalid="ignore"):
                for side in (minx, maxx):
                    cut += (low + ((side - start) / run)[(start < side) != (end < side)]).tolist()
            order = np.argsort(start)
            e = end[order]
            moved = order[(e < np.maximum.accumulate(e)) | (e > np.minimum.accumulate(e[::-1])[::-1])]  # those that change places
            i, j = np.nonzero((start[moved, None] < start[moved]) & (end[moved, None] > end[moved]))
            i, j = moved[i], moved[j]
            cut += (low + (start[j] - start[i]) / (run[i] - run[j])).tolist()
        parts = np.unique(np.clip(cut, low, high))
        middle = (parts[:-1] + parts[1:]) / 2 - low
        total += _widths(start + middle[:, None] * run, ring[on], minx, maxx) @ np.diff(parts)
    return float(total)


def union_areas(x: np.ndarray, y: np.ndarray, ring_ends: np.ndarray, mosaic: np.ndarray, boxes: np.ndarray) -> np.ndarray:
    """Areas of the unions of rings within boxes, of many mosaics at once.

    ``x, y`` are the corners of all rings one after the other, ``ring_ends`` where each ring
    ends, ``mosaic`` to which row of ``boxes`` (minx, miny, maxx, maxy) it belongs. Mosaics
    are swept by slabs between the heights of corners and of crossings with the sides of
    the box; slabs are cut where edges cross, so the covered width is linear in each, and
    the width in the middle times the height is exact. A ring is filled even-odd. Mosaics
    of more than ``MANY`` corners are swept one by one.
    """
    out = np.zeros(len(boxes))
    if not len(x):
        return out
    size = np.diff(np.concatenate(([0], ring_ends)))
    large = np.bincount(mosaic, size, len(boxes)) > MANY
    for m in np.flatnonzero(large & (boxes[:, 0] < boxes[:, 2]) & (boxes[:, 1] < boxes[:, 3])):
        own = np.flatnonzero((mosaic == m) & (size >= 3))
        out[m] = _swept([np.stack([x[e - n : e], y[e - n : e]], 1) for e, n in zip(ring_ends[own], size[own], strict=True)], tuple(boxes[m])) if len(own) else 0.0
    ring = np.repeat(np.arange(len(size)), size)
    after = np.arange(len(x)) + 1
    after[ring_ends[size > 0] - 1] = (ring_ends - size)[size > 0]
    up = y[after] > y
    x1, y1 = np.where(up, x, x[after]), np.where(up, y, y[after])
    x2, y2 = np.where(up, x[after], x), np.where(up, y[after], y)
    of = mosaic[ring]
    low, high = np.maximum(y1, boxes[of, 1]), np.minimum(y2, boxes[of, 3])
    keep = (low < high) & (size[ring] >= 3) & (boxes[of, 0] < boxes[of, 2]) & ~large[of]
    x1, y1, x2, y2, ring, of, low, high = (c[keep] for c in (x1, y1, x2, y2, ring, of, low, high))
    if not len(x1):
        return out
    slope = (x2 - x1) / (y2 - y1)
    heights, owner = [low, high], [of, of]
    with np.errstate(divide="ignore", invalid="ignore"):
        for k in (0, 2):
            h = y1 + (boxes[of, k] - x1) / slope
            met = (h > low) & (h < high)
            heights.append(h[met])
            owner.append(of[met])
    height, owner = np.concatenate(heights), np.concatenate(owner)
    order = np.lexsort((height, owner))
    height, owner = height[order], owner[order]
    new = np.concatenate(([True], (height[1:] != height[:-1]) | (owner[1:] != owner[:-1])))
    place = np.empty(len(order), np.int64)
    place[order] = np.cumsum(new) - 1
    height, owner = height[new], owner[new]
    start, stop = place[: len(low)], place[len(low) : 2 * len(low)]
    active = np.cumsum(np.bincount(start, minlength=len(height)) - np.bincount(stop, minlength=len(height)))
    chunk = np.cumsum(active) // _ENTRIES
    edges = np.concatenate(([0], np.flatnonzero(chunk[1:] != chunk[:-1]) + 1, [len(height)]))
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        on = np.flatnonzero((start < b) & (stop > a))
        if not len(on):
            continue
        first = np.maximum(start[on], a)
        row, slab = _spread(first, np.minimum(stop[on], b) - first)
        used, slab = np.unique(slab, return_inverse=True)
        slab, edge, bottom, top, origin = _cut(slab, on[row], height[used], height[used + 1], x1, y1, slope)
        own = owner[used][origin]
        at = x1[edge] + ((bottom + top)[slab] / 2 - y1[edge]) * slope[edge]
        order = np.lexsort((at, ring[edge], slab))
        slab, at = slab[order], np.clip(at[order], boxes[own[slab[order]], 0], boxes[own[slab[order]], 2])
        left, right, slab = at[::2], at[1::2], slab[::2]
        order = np.lexsort((left, slab))
        left, right, slab = left[order], right[order], slab[order]
        # the furthest right end before each span of its slab: a running maximum of slab and rank
        by_end = np.argsort(right, kind="stable")
        rank = np.empty(len(right), np.int64)
        rank[by_end] = np.arange(len(right))
        most = np.maximum.accumulate(slab * len(right) + rank)
        same = slab[1:] == slab[:-1]
        reach = np.full(len(left), -np.inf)
        reach[1:][same] = right[by_end[most[:-1][same] % len(right)]]
        width = np.bincount(slab, np.maximum(right - np.maximum(left, reach), 0), len(bottom))
        out += np.bincount(own, width * (top - bottom), len(out))
    return out


def union_area(rings: list[np.ndarray], box: tuple[float, float, float, float]) -> float:
    """Area of the union of rings (rows of x and y) within a box."""
    if not rings:
        return 0.0
    at = np.concatenate(rings).astype(float)
    return float(union_areas(at[:, 0], at[:, 1], np.cumsum([len(r) for r in rings]), np.zeros(len(rings), np.int64), np.array([box], float))[0])


@F.arrow_udf(T.DoubleType())
def mosaic_area(rings: pa.Array, minx: pa.Array, miny: pa.Array, maxx: pa.Array, maxy: pa.Array) -> pa.Array:
    """The area of each row's box under the union of its rings (arrays of x/y structs; null ones are left out); null without a box."""
    boxes = np.stack([c.to_numpy(zero_copy_only=False).astype(float) for c in (minx, miny, maxx, maxy)], 1)
    known = ~np.isnan(boxes).any(1)
    per_row = rings.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    each = rings.flatten()
    size = each.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
    points = each.flatten()
    x, y = (points.field(c).to_numpy(zero_copy_only=False).astype(float) for c in ("x", "y"))
    areas = union_areas(x, y, np.cumsum(size), np.repeat(np.arange(len(rings)), per_row), np.where(known[:, None], boxes, 0.0))
    return pa.array(np.where(known, areas, np.nan), from_pandas=True)


def banded_areas(scenes: DataFrame, keys: list[str], band: float) -> DataFrame:
    """``keys, area``: of each group of scenes (keys, the AOI's box, ``ring``) the area of the AOI under their union.

    Scenes are dealt to bands of latitude, ``band`` degrees high, before they are gathered,
    so a mosaic of any number of scenes is spread over tasks; a sum puts its bands together.
    """
    ys = F.transform("ring", lambda p: p["y"])
    low, high = F.greatest("miny", F.array_min(ys)), F.least("maxy", F.array_max(ys))
    rows = scenes.filter(F.size("ring") >= 3).withColumns({"__low": low, "__high": high}).filter("__low < __high")
    rows = rows.withColumn("__band", F.explode(cells(F.col("__low"), F.col("__high"), band)))
    own = rows.groupBy(*keys, *BOX, "__band").agg(F.collect_list("ring").alias("__rings"))
    from_, to = F.greatest(F.col("miny"), F.col("__band") * band), F.least(F.col("maxy"), (F.col("__band") + 1) * band)
    parts = own.select(*keys, mosaic_area("__rings", "minx", from_, "maxx", to).alias("area"))
    return parts.groupBy(*keys).agg(F.sum("area").alias("area"))
