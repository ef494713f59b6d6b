"""Polygon measures.

A polygon is two coordinate arrays ``xs``/``ys`` plus ``ring_sizes`` (points per ring, not repeating the first
point). Holes run against the direction of the outer ring, so signed sums handle them without special cases.
Rectangles have closed forms in plain expressions. Spark has no polygon intersection, so that one measure is an
Arrow-batched function over candidate pairs.
"""

import numpy as np
import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from cotejo.functions.text import _col

_CHUNK = 200_000  # pairs of edges held in memory at a time
_POINTS = 1_000_000  # points of the polygons worked on together


def boxes_meet(a: str, b: str) -> Column:
    """Closed boxes share at least a point; ``a`` and ``b`` are column prefixes."""
    return (
        (F.col(f"{a}xmin") <= F.col(f"{b}xmax"))
        & (F.col(f"{a}xmax") >= F.col(f"{b}xmin"))
        & (F.col(f"{a}ymin") <= F.col(f"{b}ymax"))
        & (F.col(f"{a}ymax") >= F.col(f"{b}ymin"))
    )


def box_overlap_area(a: str, b: str) -> Column:
    """Shared area of two boxes, 0 if they only touch."""
    width = F.least(F.col(f"{a}xmax"), F.col(f"{b}xmax")) - F.greatest(F.col(f"{a}xmin"), F.col(f"{b}xmin"))
    height = F.least(F.col(f"{a}ymax"), F.col(f"{b}ymax")) - F.greatest(F.col(f"{a}ymin"), F.col(f"{b}ymin"))
    zero = F.lit(0.0)
    return F.greatest(width, zero) * F.greatest(height, zero)


def box_area(prefix="") -> Column:
    return (F.col(f"{prefix}xmax") - F.col(f"{prefix}xmin")) * (F.col(f"{prefix}ymax") - F.col(f"{prefix}ymin"))


def polygon_area(xs, ys, ring_sizes) -> Column:
    """Shoelace sum over all rings, as a built-in expression."""
    # Relative to the first point, so that large coordinates do not cost digits.
    def shifted(a):
        return F.transform(a, lambda v: v - F.element_at(a, 1))

    xs, ys = shifted(_col(xs)), shifted(_col(ys))

    def turned(a):
        return F.concat(F.slice(a, F.lit(2), F.size(a)), F.slice(a, F.lit(1), F.lit(1)))

    def ring(x, y):
        forward = F.zip_with(x, turned(y), lambda p, q: p * q)
        backward = F.zip_with(turned(x), y, lambda p, q: p * q)
        return F.aggregate(F.zip_with(forward, backward, lambda p, q: p - q), F.lit(0.0), lambda t, v: t + v)

    start = F.struct(F.lit(0).alias("at"), F.lit(0.0).alias("twice"))
    total = F.aggregate(
        _col(ring_sizes).cast("array<int>"),
        start,
        lambda acc, n: F.struct(
            (acc["at"] + n).alias("at"),
            (acc["twice"] + ring(F.slice(xs, acc["at"] + 1, n), F.slice(ys, acc["at"] + 1, n))).alias("twice"),
        ),
    )
    return F.abs(total["twice"]) / 2


def with_box(df, xs="xs", ys="ys"):
    """Add xmin, ymin, xmax, ymax from the coordinate arrays."""
    return df.withColumns(
        {
            "xmin": F.array_min(xs), "ymin": F.array_min(ys),
            "xmax": F.array_max(xs), "ymax": F.array_max(ys),
        }
    )


class _Batch:
    """The polygons of one Arrow batch, flattened: one row per edge, and who owns it."""

    def __init__(self, xs, ys, sizes):
        self.n = len(xs)
        points = np.fromiter((len(v) for v in xs), int, self.n)
        rings = np.concatenate([np.asarray(v, int) for v in sizes])
        x, y = (np.concatenate([np.asarray(v, float) for v in c]) for c in (xs, ys))
        following = np.arange(1, len(x) + 1)
        stop = np.cumsum(rings)
        following[stop - 1] = stop - rings
        self.first = np.cumsum(points) - points
        self.owner = np.repeat(np.arange(self.n), points)
        self.edges = np.column_stack([x, y, x[following], y[following]])
        self.counts = points

    def shift(self, origin):
        """Coordinates relative to one point per polygon, so that large ones do not cost digits."""
        self.edges -= np.tile(origin, (1, 2))[self.owner]

    def starts(self):
        return self.edges[self.first, :2]

    def sizes(self):
        e = self.edges
        return np.abs(np.bincount(self.owner, e[:, 0] * e[:, 3] - e[:, 2] * e[:, 1], self.n)) / 2

    def part(self, pairs):
        """The polygons of some pairs, by mask; the others are left without edges."""
        out = object.__new__(_Batch)
        keep = pairs[self.owner]
        out.n, out.owner, out.edges = self.n, self.owner[keep], self.edges[keep]
        return out

    def turned(self):
        """The same polygons with the axes exchanged."""
        out = object.__new__(_Batch)
        out.n, out.owner, out.edges = self.n, self.owner, self.edges[:, [1, 0, 3, 2]]
        return out


class _Sweep:
    """Edges of the left and right polygons of each pair whose x-intervals meet, found by sorted ends.

    Of two intervals that meet, one begins inside the other. So the edges that meet an interval are those that begin in it,
    a run of the list sorted by beginnings, and those in which it begins, which the other direction finds. All pairs are
    swept at once: an end's rank in the order by (pair, x) stands for its x. ``wide`` widens the left intervals.
    """

    def __init__(self, left, right, wide=0.0):
        l, r = left.edges[:, ::2], right.edges[:, ::2]
        ends = [l.min(axis=1) - wide, l.max(axis=1) + wide, r.min(axis=1), r.max(axis=1)]
        n, m = len(l), len(r)
        value = np.concatenate(ends)
        pair = np.concatenate([left.owner, left.owner, right.owner, right.owner])
        order = np.lexsort((value, pair))
        new = np.ones(len(order), bool)
        new[1:] = (np.diff(value[order]) != 0) | (np.diff(pair[order]) != 0)
        rank = np.empty(len(order), np.int64)
        rank[order] = np.cumsum(new)
        a, b, c, d = np.split(rank, [n, 2 * n, 2 * n + m])
        self.by_c, self.by_a = np.argsort(c, kind="stable"), np.argsort(a, kind="stable")
        c_sorted, a_sorted = c[self.by_c], a[self.by_a]
        # right edges that begin in the left one, ends included; left edges that begin in the right one, after its start
        self.low_c, self.high_c = np.searchsorted(c_sorted, a, "left"), np.searchsorted(c_sorted, b, "right")
        self.low_a, self.high_a = np.searchsorted(a_sorted, c, "right"), np.searchsorted(a_sorted, d, "right")
        self.left, self.right = left, right

    def cost(self):
        """Meeting edges per pair."""
        n = self.left.n
        return np.bincount(self.left.owner, self.high_c - self.low_c, n) + np.bincount(self.right.owner, np.maximum(self.high_a - self.low_a, 0), n)

    def chunks(self):
        """(pair, left edge, right edge) arrays of at most about _CHUNK rows."""
        for low, high, other, mine_left in ((self.low_c, self.high_c, self.by_c, True), (self.low_a, self.high_a, self.by_a, False)):
            owner = (self.left if mine_left else self.right).owner
            counts = np.maximum(high - low, 0)
            ends = np.cumsum(counts)
            total = int(ends[-1]) if len(ends) else 0
            for first in range(0, total, _CHUNK):
                k = np.arange(first, min(first + _CHUNK, total))
                mine = np.searchsorted(ends, k, side="right")
                theirs = other[low[mine] + k - (ends[mine] - counts[mine])]
                yield (owner[mine], mine, theirs) if mine_left else (owner[mine], theirs, mine)


def _by_axis(left, right, wide=0.0, wanted=None):
    """Sweeps over the wanted pairs, each along the axis that has fewer meeting edges for it."""
    wanted = np.ones(left.n, bool) if wanted is None else wanted
    if not wanted.any():
        return
    along_x = _Sweep(left, right, wide).cost() <= _Sweep(left.turned(), right.turned(), wide).cost()
    for pairs, turn in ((wanted & along_x, False), (wanted & ~along_x, True)):
        if pairs.any():
            l, r = left.part(pairs), right.part(pairs)
            yield (l.turned(), r.turned(), True) if turn else (l, r, False)


def _shared_area(left, right):
    """Area of the intersection of each pair.

    A polygon is the signed sum of the trapezoids between its edges and a line below both polygons; the common area of
    two such trapezoids is the integral of the lower edge over their common x-interval.
    """
    total = np.zeros(left.n)
    for l, r, _ in _by_axis(left, right):
        base = np.full(l.n, np.inf)
        for side in (l, r):
            np.minimum.at(base, side.owner, side.edges[:, [1, 3]].min(axis=1))
        sweep = _Sweep(l, r)
        for pair, i, j in sweep.chunks():
            e, f = l.edges[i], r.edges[j]
            low = np.maximum(e[:, ::2].min(axis=1), f[:, ::2].min(axis=1))
            high = np.minimum(e[:, ::2].max(axis=1), f[:, ::2].max(axis=1))
            some = high > low
            pair, e, f, low, high = pair[some], e[some], f[some], low[some], high[some]

            def heights(edge, x):
                run = edge[:, 2] - edge[:, 0]
                return edge[:, 1] + (x - edge[:, 0]) / run * (edge[:, 3] - edge[:, 1]) - base[pair]

            e0, e1, f0, f1 = heights(e, low), heights(e, high), heights(f, low), heights(f, high)
            d0, d1 = e0 - f0, e1 - f1
            # Where the edges cross, the lower one changes; the lost triangles lie between the crossing and either end.
            crosses = (d0 < 0) != (d1 < 0)
            at = np.divide(d0, d0 - d1, out=np.zeros(len(d0)), where=crosses)
            flat = (np.minimum(e0, f0) + np.minimum(e1, f1)) / 2
            with_cross = (np.minimum(e0, f0) * at + np.minimum(e1, f1) * (1 - at) + (e0 + at * (e1 - e0))) / 2
            sign = np.sign(e[:, 2] - e[:, 0]) * np.sign(f[:, 2] - f[:, 0])
            total += np.bincount(pair, (high - low) * np.where(crosses, with_cross, flat) * sign, left.n)
    return np.abs(total)


def _boundaries_meet(left, right, wanted, tol):
    """For the wanted pairs: some edge of one comes within ``tol`` of an edge of the other."""
    meets = np.zeros(left.n, bool)
    for l, r, _ in _by_axis(left, right, tol, wanted):
        for pair, i, j in _Sweep(l, r, tol).chunks():
            s, t = l.edges[i], r.edges[j]
            close = (s[:, 1::2].min(axis=1) - tol <= t[:, 1::2].max(axis=1)) & (t[:, 1::2].min(axis=1) - tol <= s[:, 1::2].max(axis=1))
            close &= ~meets[pair]
            pair, s, t = pair[close], s[close], t[close]
            near = np.full(len(s), np.inf)
            for p, seg in ((s[:, :2], t), (s[:, 2:], t), (t[:, :2], s), (t[:, 2:], s)):
                d = seg[:, 2:] - seg[:, :2]
                length = (d * d).sum(axis=1)
                at = np.divide(((p - seg[:, :2]) * d).sum(axis=1), length, out=np.zeros(len(s)), where=length > 0)
                foot = seg[:, :2] + np.clip(at, 0, 1)[:, None] * d
                near = np.minimum(near, np.hypot(*(p - foot).T))

            def turn(a, b, c):
                return (b[:, 0] - a[:, 0]) * (c[:, 1] - a[:, 1]) - (b[:, 1] - a[:, 1]) * (c[:, 0] - a[:, 0])

            cross = (turn(s[:, :2], s[:, 2:], t[:, :2]) * turn(s[:, :2], s[:, 2:], t[:, 2:]) < 0) & (
                turn(t[:, :2], t[:, 2:], s[:, :2]) * turn(t[:, :2], t[:, 2:], s[:, 2:]) < 0
            )
            np.logical_or.at(meets, pair, (near <= tol) | cross)
    return meets


def _cuts(points):
    """Row ranges of at most _POINTS points, or of one row."""
    ends, low = np.concatenate([[0], np.cumsum(points)]), 0
    while low < len(points):
        high = max(low + 1, int(np.searchsorted(ends, ends[low] + _POINTS, side="right")) - 1)
        yield low, high
        low = high


def polygon_overlap(xy_tol=1e-9, area_tol=1e-9):
    """Pandas UDF (xs, ys, sizes of both polygons) -> struct(area, touches).

    The area is exact for non-convex rings and holes. A share of at most ``area_tol`` of the smaller polygon counts as
    none; then ``touches`` says whether the boundaries come within ``xy_tol`` of each other. Edges meet edges through sorted
    intervals, so the work follows those that meet and not all combinations, and a batch is worked off by points.
    """

    def part(lx, ly, ls, rx, ry, rs):
        left, right = _Batch(lx, ly, ls), _Batch(rx, ry, rs)
        origin = left.starts().copy()
        left.shift(origin)
        right.shift(origin)
        area = _shared_area(left, right)
        smaller = np.minimum(left.sizes(), right.sizes())
        area[area <= area_tol * np.maximum(smaller, area_tol)] = 0.0
        return area, _boundaries_meet(left, right, area == 0, xy_tol)

    @F.pandas_udf("area double, touches boolean")
    def measure(
        lx: pd.Series, ly: pd.Series, ls: pd.Series, rx: pd.Series, ry: pd.Series, rs: pd.Series
    ) -> pd.DataFrame:
        points = np.fromiter((len(a) + len(b) for a, b in zip(lx, rx)), int, len(lx))
        found = [part(*[c.iloc[low:high] for c in (lx, ly, ls, rx, ry, rs)]) for low, high in _cuts(points)]
        area, touches = zip(*found) if found else ([np.zeros(0)], [np.zeros(0, bool)])
        return pd.DataFrame({"area": np.concatenate(area), "touches": np.concatenate(touches)})

    return measure.asNondeterministic()  # else a filter on the result is pushed below the spread and runs it twice
