"""Robust LOWESS of channel ROI on budget, from moments of segments.

The curve is fitted at an even grid of points per channel and is linear between them.  At a point g, the bandwidth h
is the distance to the k-th nearest budget (k = floor(frac * n)), rows are weighted by tricube (1 - (|x - g| / h)^3)^3
times their robustness weight, and a line is fitted by least squares.  After each pass a row's robustness weight is the
bisquare of its residual over six times the channel's median absolute residual (Cleveland, 1979).

No row is repeated per point.  Left and right of g, tricube is a polynomial of degree 9 in x.  The points g - h, g and
g + h of all grid points cut a channel into at most three segments per point; one aggregation per pass sums
w t^a and w y t^a in every segment (t: the place inside the segment, -1 to 1, so that nothing cancels), and the
weighted sums of every fit are combinations of those moments, worked out on a table of segments.

The budgets and their ROI are written once as blocks of numbers, and every pass reads blocks: a task adds up the moments
of its blocks, and only sums are shuffled.

The bandwidths and the median residuals are exact.  Distances and residuals are not negative, so their binary forms are
in their order: one pass counts the values by their leading bits, further passes cut the bucket that holds the wanted rank
into finer ones, and the last buckets are single values, however many rows share one.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark import RDD, StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.exprs import rnd
from ..session import ship_package
from .profile import channel_roi

DEGREE = 11       # of tricube times a squared distance
SHELL = 20_000    # rows of a bucket that are told apart by all their bits at once
FLAT = 1e-9       # relative spread of the neighbours under which a line is not fitted
BLOCK = 32_768    # rows of a block, about
FIRST = 49        # low bits of a double that the first count leaves open ...
STEP = 8          # ... and bits that each further count settles
MERGERS = 16      # tasks that add up what the partitions counted

Block = tuple[str, np.ndarray, np.ndarray]  # channel, budgets, ROI


def blocks_of(df: DataFrame) -> RDD:
    """The rows of ``channel_roi`` as blocks of one channel."""
    rows = channel_roi(df)

    def write(frames):
        held: dict[str, list] = {}
        for frame in frames:
            for ch, f in frame.groupby("channel"):
                held.setdefault(ch, []).append((f["budget"].to_numpy(), f["roi"].to_numpy()))
                if sum(len(x) for x, _ in held[ch]) >= BLOCK:
                    yield written(ch, held.pop(ch))
        for ch, parts in held.items():
            yield written(ch, parts)

    def written(ch, parts):
        x, y = (np.concatenate(v) for v in zip(*parts))
        return pd.DataFrame({"channel": [ch], "x": [x.tobytes()], "y": [y.tobytes()]})

    ship_package(df.sparkSession)
    return rows.select("channel", "budget", "roi").mapInPandas(write, "channel string, x binary, y binary").rdd.map(
        lambda r: (r["channel"], np.frombuffer(r["x"]), np.frombuffer(r["y"])))


def ranges(blocks: RDD) -> dict[str, tuple[float, float, int]]:
    """Smallest and largest budget and the rows of each channel."""
    def local(it):
        for ch, x, _ in it:
            yield ch, (float(x.min()), float(x.max()), len(x))
    return blocks.mapPartitions(local).reduceByKey(lambda a, b: (min(a[0], b[0]), max(a[1], b[1]), a[2] + b[2]),
                                                   MERGERS).collectAsMap()


def _counted(values: Callable, buckets: dict, blocks) -> Iterator[tuple]:
    """Rows of a partition by finer buckets: ``((key, prefix, shift, into), (codes, counts))``."""
    sums: dict = {}
    for block in blocks:
        for key, v in values(block, buckets):
            bits = v.view(np.int64)
            for prefix, shift, into in buckets[key]:
                inside = bits if shift == 63 else bits[(bits >> shift) == prefix]
                if not len(inside):
                    continue
                at, width = (key, prefix, shift, into), 1 << (shift - into)
                if into:
                    n = np.bincount((inside >> into) - prefix * width, minlength=width)
                    sums[at] = sums[at] + n if at in sums else n
                else:  # whole values
                    sums.setdefault(at, []).append(inside)
    for at, n in sums.items():
        if at[3]:
            codes = np.flatnonzero(n)
            yield at, (codes + (at[1] << (at[2] - at[3])), n[codes])
        else:
            yield at, np.unique(np.concatenate(n), return_counts=True)


def _merged(a: tuple, b: tuple) -> tuple:
    codes, at = np.unique(np.concatenate([a[0], b[0]]), return_inverse=True)
    counts = np.zeros(len(codes), np.int64)
    np.add.at(counts, at, np.concatenate([a[1], b[1]]))
    return codes, counts


def order_statistics(blocks: RDD, values: Callable, ranks: Callable) -> dict[tuple, tuple[float, int]]:
    """Exact order statistics of numbers that are not negative: ``(key, rank)`` (from 0) to the value and the number of
    smaller ones.

    ``values(block, keys)`` gives a block's ``(key, numbers)``; ``ranks(key, n)`` the ranks wanted among a key's n numbers.
    """
    found: dict = {}
    wanted: dict | None = None  # bucket: its (rank, number of values below the bucket)

    def picked(entry):
        bucket, (codes, counts) = entry
        upto = np.cumsum(counts)
        ask = [(r, 0) for r in ranks(bucket[0], int(upto[-1]))] if wanted is None else wanted[bucket]
        for rank, below in ask:
            i = int(np.searchsorted(upto, rank - below, side="right"))
            yield bucket[0], rank, int(codes[i]), below + int(upto[i] - counts[i]), int(counts[i]), bucket[3]

    while wanted is None or wanted:
        buckets = _EveryKey() if wanted is None else {}
        for key, *rest in wanted or ():
            buckets.setdefault(key, []).append(tuple(rest))
        sums = blocks.mapPartitions(functools.partial(_counted, values, buckets)).reduceByKey(_merged, MERGERS)
        told, wanted = sums.flatMap(picked).collect(), {}  # a row per rank
        for key, rank, code, below, n, shift in told:
            if shift:
                finer = (key, code, shift, 0 if n <= SHELL else max(0, shift - STEP))
                wanted.setdefault(finer, []).append((rank, below))
            else:
                found[key, rank] = float(np.array(code).view(np.float64)), below
    return found


class _EveryKey:
    """The buckets of the first count: every key has one, of all its numbers."""

    def __contains__(self, key) -> bool:
        return True

    def __getitem__(self, key) -> list[tuple]:
        return [(0, 63, FIRST)]


def bandwidths(blocks: RDD, grid: dict, frac: float) -> tuple[dict, dict]:
    """``h`` and ``nearer``: per (channel, j), the distance to the k-th nearest budget and the number of nearer ones."""
    def distances(block: Block, keys):
        ch, x, _ = block
        for j, g in enumerate(grid.get(ch, ())):
            if (ch, j) in keys:
                yield (ch, j), np.abs(x - g)

    found = order_statistics(blocks, distances, lambda key, n: [max(1, math.floor(frac * n + 1e-10)) - 1])
    return {key: v for (key, _), (v, _) in found.items()}, {key: below for (key, _), (_, below) in found.items()}


def _times(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Products of polynomials, one a row, coefficients by rising power."""
    out = np.zeros((len(p), p.shape[1] + q.shape[1] - 1))
    for i in range(p.shape[1]):
        out[:, i:i + q.shape[1]] += p[:, i:i + 1] * q
    return out


class Segments:
    """The cuts of a channel, and its lines from the moments of the segments between them."""

    def __init__(self, points: list[float], h: list[float], low: float, high: float):
        self.points, self.h = points, h
        cuts = {x for g, r in zip(points, h) for x in (g - r, g, g + r) if low < x < high}
        self.cuts = sorted(cuts)
        edges = np.array([low, *self.cuts, high])
        self.left, self.right = edges[:-1], edges[1:]
        self.mid, self.half = (self.left + self.right) / 2, np.maximum((self.right - self.left) / 2, 1e-300)

    def lines(self, w: np.ndarray, wy: np.ndarray) -> list[float | None]:
        """Value of the line at every point; ``w`` and ``wy`` hold moments (segment, power)."""
        out = []
        for g, h in zip(self.points, self.h):
            s = np.zeros(5)  # sums of w, w x, w y, w x x, w x y with x from g, in units of h
            for sign, at in ((-1.0, (self.right <= g) & (self.left >= g - h)), (1.0, (self.left >= g) & (self.right <= g + h))):
                if not at.any():
                    continue
                x = np.stack([(self.mid[at] - g) / h, self.half[at] / h], axis=1)  # (x - g) / h by the place in the segment
                cube = _times(_times(x, x), x) * -sign
                cube[:, 0] += 1.0
                p = _times(_times(cube, cube), cube)
                px = _times(p, x)
                pxx = _times(px, x)
                total = lambda q, m: float((q * m[at][:, :q.shape[1]]).sum())  # noqa: B023, E731
                s += [total(p, w), total(px, w), total(p, wy), total(pxx, w), total(px, wy)]
            sw, swx, swy, swxx, swxy = s.tolist()
            den = sw * swxx - swx * swx
            if den > FLAT * sw * swxx:
                out.append((swy * swxx - swx * swxy) / den)
            else:
                out.append(swy / sw if sw > 0 else None)
        return out


class Curve:
    """A channel's line of straight pieces between the grid's points."""

    def __init__(self, low: float, step: float, level: list[float | None], reach: float | None = None):
        self.low, self.step, self.reach = low, step, reach
        self.level = np.array([math.nan if v is None else v for v in level])

    def errors(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Distances from the curve, NaN beside a point without a fit."""
        place = (x - self.low) / self.step
        j = np.minimum(np.floor(place), len(self.level) - 2).astype(np.int64)
        return np.abs(y - (self.level[j] + (place - j) * (self.level[j + 1] - self.level[j])))

    def weights(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Robustness weights: the bisquare of the distance over ``reach``."""
        if self.reach is None:
            return np.ones(len(x))
        u = self.errors(x, y) / self.reach
        return np.where(np.isnan(u), 1.0, np.where(u < 1, (1 - u * u) * (1 - u * u), 0.0))


def medians(blocks: RDD, curves: dict[str, Curve]) -> dict[str, float]:
    """The median distance from the curve of each channel."""
    def errors(block: Block, keys):
        ch, x, y = block
        if ch in curves and ch in keys:
            e = curves[ch].errors(x, y)
            yield ch, e[~np.isnan(e)]

    middle: dict[str, list[float]] = {}
    for (ch, _), (v, _) in order_statistics(blocks, errors, lambda ch, n: sorted({(n - 1) // 2, n // 2})).items():
        middle.setdefault(ch, []).append(v)
    return {ch: min(v) + (max(v) - min(v)) * 0.5 for ch, v in middle.items()}


def fit(blocks: RDD, segments: dict[str, Segments], curves: dict[str, Curve] | None) -> dict[str, list[float | None]]:
    """The lines' values at the points, rows weighted by their distance from ``curves``; the moments are added up in one pass."""
    def local(it):
        sums = {}
        for ch, x, y in it:
            if ch not in segments:
                continue
            seg = segments[ch]
            n, s = len(seg.mid), np.searchsorted(seg.cuts, x, side="left")
            t = (x - seg.mid[s]) / seg.half[s]
            m = np.ones(len(x)) if curves is None else curves[ch].weights(x, y)
            total = sums.setdefault(ch, np.zeros((2, n, DEGREE + 1)))
            for a in range(DEGREE + 1):  # m t^a, one power from the one before
                if a:
                    m = m * t
                total[0, :, a] += np.bincount(s, m, n)
                total[1, :, a] += np.bincount(s, m * y, n)
        yield from sums.items()

    moments = blocks.mapPartitions(local).reduceByKey(np.add, MERGERS).collectAsMap()
    return {ch: seg.lines(*moments[ch]) for ch, seg in segments.items()}


def lowess_curve(df: DataFrame, points: int = 50, frac: float = 2 / 3, passes: int = 3) -> DataFrame:
    """``(channel, j, x, roi_fit, n_used, bandwidth)`` after ``passes`` robust passes.

    A bandwidth of 0 (as many equal budgets at the point) leaves the fit null; rows beside such a point keep weight 1,
    as all rows of a channel do whose median residual is 0.  A channel of one budget only has no curve.
    """
    blocks = blocks_of(df).persist(StorageLevel.MEMORY_AND_DISK)
    found = {ch: (low, high) for ch, (low, high, _) in ranges(blocks).items() if low < high}
    schema = "channel string, j int, x double, roi_fit double, n_used long, bandwidth double"
    if not found:
        blocks.unpersist()
        return df.sparkSession.createDataFrame([], schema)
    step = {ch: (high - low) / (points - 1) for ch, (low, high) in found.items()}
    grid = {ch: [low + j * step[ch] for j in range(points)] for ch, (low, _) in found.items()}
    h, nearer = bandwidths(blocks, grid, frac)
    segments = {ch: Segments(grid[ch], [h[ch, j] for j in range(points)], *found[ch]) for ch in found}

    level = fit(blocks, segments, None)
    for _ in range(passes):
        curves = {ch: Curve(found[ch][0], step[ch], level[ch]) for ch in found}
        for ch, m in medians(blocks, curves).items():
            curves[ch].reach = 6 * m if m else None
        level = fit(blocks, segments, curves)
    blocks.unpersist()
    out = [(ch, j, grid[ch][j], level[ch][j], nearer[ch, j], h[ch, j]) for ch in grid for j in range(points)]
    return df.sparkSession.createDataFrame(out, schema).select(
        "channel", "j", rnd("x", 6).alias("x"), rnd("roi_fit", 4).alias("roi_fit"), "n_used", rnd("bandwidth", 6).alias("bandwidth"))
