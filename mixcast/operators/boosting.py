"""K5-K7: gradient boosting of many settings, folds and classes at once.

A fit of a few hundred rounds is thousands of short jobs, and a grid on five folds is a hundred fits; the jobs, not the
rows, cost the time.  Here all fits grow their trees level by level together: one job per level adds up the histograms
(fit, node, feature, bin) of every fit over all partitions, and the driver, which holds only those sums, picks every
fit's splits.  The number of jobs is rounds x depth, whatever the number of fits.

The rules are those of ``GBTRegressor`` / ``GBTClassifier``: features in at most ``BINS`` quantile bins, trees on the
negative gradient (twice the residual; for classes the logistic loss of labels -1 and 1), leaves at the mean, the first
tree with weight 1 and the others with the step, splits by variance reduction with at least ``least`` rows on either
side, a share of the rows drawn for each round by hash.  A fit sees the rows outside its fold; the rows inside give its
score after every round.

Rows are written once as blocks of bins, targets, folds and hashes, and dealt by their bins, so that a partition holds
all rows of its cells (a cell: one bin of every feature).  Trees tell cells apart, not rows, so the gradients of a
cell's rows add up to a function of its drawn rows, their targets and the cell's prediction.  Each round reads the rows
once, to draw them and add them up by cell and fold; its levels read only these sums, for all fits.  Where every row is
a cell of its own that is the work on rows.

A task keeps the predictions of the cells it has met, up to ``HELD`` partitions of them, and adds the trees grown
since; a partition it has not met (or has forgotten, or an executor that was lost held) starts from the first tree,
with the same result.
"""

from __future__ import annotations

import hashlib
import math
import uuid
from collections import OrderedDict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import StorageLevel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import ship_package

BINS = 32
BLOCK = 16_384  # rows of a block
PACK = 25       # rounds of trees sent together
HELD = 32       # partitions of cells whose predictions a worker keeps
ROWS = 4_000_000  # rows of a partition of cells at most, about
FEW = 1 << 20   # sums that partitions may send to the driver uncombined
WHOLE = 1 << 18  # cells over which one task grows a fit, at most
SENT = 96 << 20  # bytes of sums by cell sent together, about
_HELD: OrderedDict = OrderedDict()


@dataclass(frozen=True)
class Fit:
    """One model: the fold it does not see (-1: it sees all), its step and depth; ``positive`` names the class told from
    the rest (None: regression)."""
    fold: int
    step: float
    depth: int
    positive: int | None = None


@dataclass
class Trees:
    """A tree of every fit as complete binary trees: split feature (-1: leaf), last bin of the left side, mean.

    ``gain`` is a split's variance reduction, ``totals`` (rows, sum, squares) of a node; predictions need neither."""
    feature: np.ndarray
    bin: np.ndarray
    value: np.ndarray
    gain: np.ndarray | None = None
    totals: np.ndarray | None = None

    @classmethod
    def empty(cls, fits: int, depth: int) -> "Trees":
        shape = (fits, (1 << depth + 1) - 1)
        return cls(np.full(shape, -1, np.int16), np.zeros(shape, np.int16), np.zeros(shape), np.zeros(shape), np.zeros((3, *shape)))

    def put(self, i: int, one: "Trees") -> None:
        """Take the tree of the only fit of ``one`` as that of fit ``i``."""
        self.feature[i], self.bin[i], self.value[i], self.gain[i], self.totals[:, i] = (
            one.feature[0], one.bin[0], one.value[0], one.gain[0], one.totals[:, 0])

    def bare(self) -> "Trees":
        return Trees(self.feature, self.bin, self.value)

    def nodes(self, bins: np.ndarray, levels: int) -> np.ndarray:
        """(fit, row): the node where a row stands after ``levels`` splits, or the leaf where it stopped before."""
        fits = np.arange(len(self.feature))[:, None]
        rows = np.arange(bins.shape[1])[None, :]
        at = np.zeros((len(fits), bins.shape[1]), np.int64)
        for _ in range(levels):
            f = self.feature[fits, at]
            right = bins[np.maximum(f, 0), rows] > self.bin[fits, at]
            at = np.where(f < 0, at, 2 * at + 1 + right)
        return at


class _Sent:
    """The trees grown so far, sent to the workers in packs: only the last, short one is sent anew each round."""

    def __init__(self, sc, packs=(), recent=()):
        self.size, self.packs, self.rounds = PACK, list(packs), len(packs) * PACK + len(recent)
        self.recent = sc.broadcast(list(recent))

    def trees(self, number: int) -> Trees:
        pack = number // self.size
        return (self.packs[pack] if pack < len(self.packs) else self.recent).value[number % self.size]

    def then(self, sc, trees: Trees) -> "_Sent":
        more = [*self.recent.value, trees.bare()]
        self.recent.unpersist()
        if len(more) == self.size:
            return _Sent(sc, [*self.packs, sc.broadcast(more)])
        return _Sent(sc, self.packs, more)


def _draw(u: np.ndarray, number: int) -> np.ndarray:
    """A hash in [0, 1) per row and round."""
    x = u + np.uint64(0x9E3779B97F4A7C15 * (number + 1) & (1 << 64) - 1)
    for shift, times in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(times)
    return ((x ^ (x >> np.uint64(31))) >> np.uint64(11)).astype(np.float64) / float(1 << 53)


class _Block:
    """Rows of a block with the predictions of every fit."""

    def __init__(self, row, fits: list[Fit], outputs: "Outputs"):
        n = row["n"]
        self.bins = np.frombuffer(row["bins"], np.uint8).reshape(-1, n)
        y, self.fold = np.frombuffer(row["y"]), np.frombuffer(row["fold"], np.int32)
        self.y = np.stack([y if f.positive is None else np.where(y == f.positive, 1.0, -1.0) for f in fits])
        self.held = np.stack([self.fold == f.fold for f in fits])
        self.out = outputs.at(self.bins)


class Outputs:
    """The trees of all fits as a function of bins, or of a block of rows."""

    def __init__(self, sent: _Sent, fits: list[Fit]):
        self.sent, self.fits = sent, fits
        self.steps, self.depth = np.array([f.step for f in fits])[:, None], max(f.depth for f in fits)

    def after(self, bins: np.ndarray, out: np.ndarray, rounds: int) -> Iterator[np.ndarray]:
        """``out`` (fit, cell) after each further round, from ``rounds`` on."""
        for number in range(rounds, self.sent.rounds):
            t = self.sent.trees(number)
            at = t.nodes(bins, self.depth)
            out += np.take_along_axis(t.value, at, axis=1) * (self.steps if number else 1.0)
            yield out

    def at(self, bins: np.ndarray) -> np.ndarray:
        out = np.zeros((len(self.fits), bins.shape[1]))
        for _ in self.after(bins, out, 0):
            pass
        return out

    def __call__(self, row) -> _Block:
        return _Block(row, self.fits, self)


def _predicted(run: str, cells: dict, outputs: Outputs) -> np.ndarray:
    """(fit, cell): the predictions of all rounds sent, from those the worker holds."""
    key = (run, cells["id"])
    rounds, out = _HELD.pop(key, (0, None))
    if out is None or rounds > outputs.sent.rounds:
        rounds, out = 0, np.zeros((len(outputs.fits), cells["bins"].shape[1]))
    for _ in outputs.after(cells["bins"], out, rounds):
        pass
    _HELD[key] = outputs.sent.rounds, out
    for old in [k for k in _HELD if k[0] != run] + list(_HELD)[:max(0, len(_HELD) - HELD)]:
        _HELD.pop(old, None)
    return out


def _codes(bins: np.ndarray) -> np.ndarray:
    """One value per row, equal for equal bins."""
    m, n = bins.shape
    wide = np.zeros((n, max(8, m)), np.uint8)
    wide[:, :m] = bins.T
    return wide.view(np.uint64 if m <= 8 else np.dtype((np.void, m))).ravel()


class _Groups:
    """Rows of a cell by what fits tell apart: the classes asked for (the others together), and the folds held out."""

    def __init__(self, fits: list[Fit]):
        self.kinds = sorted({f.positive for f in fits if f.positive is not None})
        self.folds = sorted({f.fold for f in fits})
        self.squared = any(f.positive is None for f in fits)
        self.fold_of = np.array([self.folds.index(f.fold) for f in fits])
        self.kind_of = [None if f.positive is None else self.kinds.index(f.positive) for f in fits]
        self.shape = (len(self.kinds) + 1, len(self.folds) + 1)

    def of(self, y: np.ndarray, fold: np.ndarray) -> np.ndarray:
        kind, held = np.full(len(y), len(self.kinds)), np.full(len(y), len(self.folds))
        for i, k in enumerate(self.kinds):
            kind[y == k] = i
        for i, f in enumerate(self.folds):
            held[fold == f] = i
        return kind * self.shape[1] + held

    def sums(self, cells: dict, pick=slice(None), squares: bool = False) -> np.ndarray:
        """(rows by class, then sum and squares of the targets; fold, cell) of some rows of the cells."""
        kinds, folds = self.shape
        n = cells["bins"].shape[1]
        slot, y = cells["slot"][pick], cells["y"][pick]
        parts = [np.bincount(slot, minlength=kinds * folds * n).reshape(kinds, folds, n).astype(float)]
        if self.squared:
            for power in range(1, 2 + squares):
                parts.append(np.bincount(slot, weights=y ** power, minlength=kinds * folds * n).reshape(kinds, folds, n)
                             .sum(axis=0, keepdims=True))
        return np.concatenate(parts)

    def seen(self, sums: np.ndarray) -> np.ndarray:
        """The same sums (part; held-out fold, cell) over the rows outside of each fold."""
        folds = self.shape[1]
        return (1.0 - np.eye(folds))[:-1] @ sums

    def gradient(self, i: int, rows: np.ndarray, f: np.ndarray, first: bool, squares: bool) -> list[np.ndarray]:
        """By cell: rows, sum and, if asked for, squares of what a fit's next tree is grown on: the labels first, then the
        negative gradient.  ``rows`` are the sums (part, cell) that the fit sees."""
        kinds, kind = self.shape[0], self.kind_of[i]
        n = rows[:kinds].sum(axis=0)
        if kind is None:
            s = rows[kinds]
            parts = [n, s if first else 2.0 * (s - n * f)]
            if squares:
                q = rows[kinds + 1]
                parts.append(q if first else 4.0 * np.maximum(q - 2.0 * f * s + n * f * f, 0.0))
            return parts
        yes, no = rows[kind], n - rows[kind]
        up = 1.0 if first else 4.0 / (1.0 + np.exp(np.minimum(2.0 * f, 700.0)))
        down = -1.0 if first else -4.0 / (1.0 + np.exp(np.minimum(-2.0 * f, 700.0)))
        return [n, yes * up + no * down, *([yes * up ** 2 + no * down ** 2] if squares else [])]

    def gradients(self, seen: np.ndarray, out: np.ndarray, first: bool, squares: bool) -> list[np.ndarray]:
        """(fit, cell): the same for all fits."""
        each = [self.gradient(i, seen[:, fold], out[i], first, squares) for i, fold in enumerate(self.fold_of)]
        return [np.stack(part) for part in zip(*each)]

    def held(self, i: int, sums: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
        """Of the rows in a fit's fold: rows and mean target by cell, and the squares that no function of cells explains.
        ``sums`` (part; held-out fold, cell) hold the squares too."""
        kinds, kind, own = self.shape[0], self.kind_of[i], sums[:, self.fold_of[i]]
        n = own[:kinds].sum(axis=0)
        some = np.maximum(n, 1.0)
        s, q = own[kinds:] if kind is None else (2.0 * own[kind] - n, n)
        return n, s / some, float(np.maximum(q - s * s / some, 0.0).sum())


def _cells(blocks, groups: _Groups):
    """The rows dealt by their bins: an element per partition, with the bins of its cells and its rows' ``slot`` (group and
    cell), target, hash and, if blocks have them, weight, in the order of the slots."""
    sc = blocks.context
    n = blocks.map(lambda r: r["n"]).sum()
    parts = max(1, min(sc.defaultParallelism, -(-n // 5_000)), -(-n // ROWS))

    def deal(row):
        bins = np.frombuffer(row["bins"], np.uint8).reshape(-1, row["n"])
        mixed = np.zeros(row["n"], np.uint64)
        for j in range(len(bins)):
            mixed = mixed * np.uint64(BINS + 1) + bins[j]
        part = (_draw(mixed, 0) * parts).astype(np.int64)
        order = np.argsort(part, kind="stable")
        ends = np.searchsorted(part[order], np.arange(parts + 1))
        y, fold, u = np.frombuffer(row["y"]), np.frombuffer(row["fold"], np.int32), np.frombuffer(row["u"], np.uint64)
        w = [np.frombuffer(row["w"])] if row["w"] else []
        for p in range(parts):
            own = order[ends[p]:ends[p + 1]]
            if len(own):
                yield p, (bins[:, own], groups.of(y[own], fold[own]).astype(np.int32), y[own], u[own], *[v[own] for v in w])

    def gather(p, pieces):
        pieces = [v for _, v in pieces]
        if pieces:
            bins, group, y, u, *w = (np.concatenate(c, axis=-1) for c in zip(*pieces))
            _, first, cell = np.unique(_codes(bins), return_index=True, return_inverse=True)
            slot = group * np.int64(len(first)) + cell
            order = np.argsort(slot, kind="stable")
            yield {"id": p, "bins": bins[:, first], "slot": slot[order].astype(np.int32), "y": y[order], "u": u[order],
                   "w": w[0][order] if w else None}

    return blocks.flatMap(deal).partitionBy(parts, int).mapPartitionsWithIndex(gather)


def blocks_of(data: DataFrame, label: str, fold: str, key: str, features: str = "features", weight: str | None = None,
              most: int | None = None):
    """``(blocks, edges)``: the rows as blocks of bins, and the upper edges of each feature's bins.

    ``weight`` names a column of row weights to carry along; ``most`` bounds the number of partitions."""
    ship_package(data.sparkSession)
    flat = data.select(vector_to_array(features).alias("x"), F.col(label).cast("double").alias("y"),
                       F.col(fold).cast("int").alias("fold"), F.xxhash64(F.col(key)).alias("u"),
                       *([F.col(weight).cast("double").alias("w")] if weight else [])).where(F.col("y").isNotNull())
    flat.persist(StorageLevel.MEMORY_AND_DISK)  # the edges take several passes
    size = flat.select(F.size("x").alias("m")).first()
    m = size["m"] if size else 0
    at = [i / BINS for i in range(1, BINS)]
    few = flat.agg(*[F.percentile_approx(F.col("x")[j], at, 10_000).alias(f"q{j}") for j in range(m)],
                   *[F.approx_count_distinct(F.col("x")[j]).alias(f"n{j}") for j in range(m)]).first()
    edges = []
    for j in range(m):
        own = []
        if few[f"n{j}"] <= 2 * BINS:  # every value of a feature of few values has its own bin
            own = [r["v"] for r in flat.select(F.col("x")[j].alias("v")).distinct().limit(BINS + 1).collect()]
        edges.append(np.array(sorted(own)[:-1]) if 0 < len(own) <= BINS else np.unique(np.array(few[f"q{j}"] or [], float)))

    flat.unpersist()

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for a in range(0, len(pdf), BLOCK):
                g = pdf.iloc[a:a + BLOCK]
                x = np.stack(g["x"].to_numpy()).astype(float)
                bins = np.stack([np.searchsorted(edges[j], x[:, j], side="left") for j in range(m)]).astype(np.uint8)
                body = {"bins": bins.tobytes(), "y": g["y"].to_numpy(np.float64).tobytes(),
                        "fold": g["fold"].fillna(-2).to_numpy(np.int32).tobytes(), "u": g["u"].to_numpy(np.int64).tobytes()}
                named = hashlib.sha256(b"".join(body.values())).hexdigest()  # blocks of equal rows may share predictions
                body["w"] = g["w"].to_numpy(np.float64).tobytes() if weight else None
                yield pd.DataFrame([{"id": named, "n": len(g), **body}])

    blocks = flat.mapInPandas(write, "id string, n int, bins binary, y binary, fold binary, u binary, w binary")
    if most:
        blocks = blocks.coalesce(most)
    return blocks.rdd.map(lambda r: r.asDict()).persist(StorageLevel.MEMORY_AND_DISK), edges


def boost(blocks, m: int, fits: list[Fit], rounds: int, share: float = 0.8, least: int = 2, seed: int = 42,
          squares: bool = False):
    """Grow ``rounds`` trees of every fit; returns the trees, ``sse`` (round, fit): squared error over the fit's fold, and
    ``Outputs``.

    With few cells two jobs for a pack of rounds (``_boost_whole``), otherwise one job per level; its result has fits x nodes x features x bins sums, with ``squares`` also those of squares (for the
    impurities of nodes).  Partial sums of many partitions are combined on the executors before they reach the driver.
    """
    run, groups = uuid.uuid4().hex, _Groups(fits)
    sc = blocks.context
    depth, n_fits = max(f.depth for f in fits), len(fits)
    limit = np.array([f.depth for f in fits])
    cells = _cells(blocks, groups).persist(StorageLevel.MEMORY_AND_DISK)
    if 0 < cells.map(_width).sum() <= WHOLE:
        found = _boost_whole(cells, groups, fits, rounds, share, least, seed, squares)
        cells.unpersist()
        return found
    parts = cells.getNumPartitions()
    done: list[Trees] = []
    shared = _Sent(sc)

    def drawn(number: int):
        sent = Outputs(shared, fits)

        def draw(c):
            pick = np.flatnonzero(_draw(c["u"], seed * 1_000_003 + number) < share)
            seen = groups.seen(groups.sums(c, pick, squares))
            return c["bins"], groups.gradients(seen, _predicted(run, c, sent), not number, squares)
        return cells.map(draw).persist(StorageLevel.MEMORY_AND_DISK)

    def level_sums(rows, level: int, grown: Trees):
        width, base = 1 << level, (1 << level) - 1
        shape = (2 + squares, n_fits, width, m, BINS)

        def add(found):
            total = np.zeros(shape)
            for bins, sums in found:
                at = grown.nodes(bins, level) - base
                fit, place = np.nonzero((sums[0] > 0) & (at >= 0) & (limit > level)[:, None])
                node = (fit * width + at[fit, place]) * BINS
                values = [p[fit, place] for p in sums]
                for j in range(m):
                    cell = node + bins[j, place]
                    for i, v in enumerate(values):
                        total[i, :, :, j] += np.bincount(cell, weights=v, minlength=n_fits * width * BINS).reshape(n_fits, width, BINS)
            yield total

        sums = rows.mapPartitions(add)
        few = parts * math.prod(shape) <= FEW
        return sums.reduce(np.add) if few else sums.treeReduce(np.add, depth=2)

    for number in range(rounds):
        grown = Trees.empty(n_fits, depth)
        rows = drawn(number)
        for level in range(depth):
            _split(grown, level_sums(rows, level, grown.bare()), level, least)
            if not (grown.feature[:, (1 << level) - 1:(1 << level + 1) - 1] >= 0).any():
                break
        rows.unpersist()
        done.append(grown)
        shared = shared.then(sc, grown)
    final = Outputs(shared, fits)
    sse = cells.map(lambda c: _errors(c, groups, final)).reduce(np.add)
    cells.unpersist()
    return done, sse, final


def _width(cells: dict) -> int:
    return cells["bins"].shape[1]


def joined(parts: list, at: int) -> np.ndarray:
    """One of the arrays by cell that the partitions of cells gave, over all cells."""
    return np.concatenate([p[at] for p in sorted(parts, key=lambda p: p[0])], axis=-1)


def _boost_whole(cells, groups: _Groups, fits: list[Fit], rounds: int, share: float, least: int, seed: int, squares: bool):
    """``boost`` over few cells: a job adds up a pack of rounds by cell, the next grows the trees of each fit in a task.

    The predictions by cell stay in a persisted element per fit; a lost one is grown again from the sums sent."""
    sc, kinds, depth = cells.context, groups.shape[0], max(f.depth for f in fits)
    whole = cells.map(lambda c: (c["id"], c["bins"], groups.sums(c, squares=True)[:, :-1])).collect()
    table = sc.broadcast((joined(whole, 1), joined(whole, 2)))
    width = joined(whole, 1).shape[1]
    del whole
    size = width * len(groups.folds) * (4 * kinds + 8 * groups.squared * (1 + squares))
    pack = max(1, SENT // size)
    done, sse = [Trees.empty(len(fits), depth) for _ in range(rounds)], np.empty((rounds, len(fits)))
    state, sent = sc.parallelize([(i, None, None, None) for i in range(len(fits))], len(fits)), [table]

    def drawn(numbers):
        def draw(c):
            every = []
            for number in numbers:
                pick = np.flatnonzero(_draw(c["u"], seed * 1_000_003 + number) < share)
                every.append(groups.seen(groups.sums(c, pick, squares)))
            every = np.stack(every)
            return c["id"], every[:, :kinds].astype(np.int32), every[:, kinds:]
        return cells.map(draw).collect()

    def grown(first, sums):
        def grow(one):
            i, out = one[:2]
            return i, *_grow(i, np.zeros(width) if out is None else out, groups, fits[i], depth, table.value, sums.value, first,
                             least, squares)
        return grow

    for first in range(0, rounds, pack):
        parts = drawn(range(first, min(rounds, first + pack)))
        sent.append(sc.broadcast((joined(parts, 1), joined(parts, 2))))
        del parts
        before, state = state, state.map(grown(first, sent[-1])).persist(StorageLevel.MEMORY_AND_DISK)
        for i, trees, errors in state.map(lambda one: (one[0], *one[2:])).collect():
            for number, t in enumerate(trees, first):
                done[number].put(i, t)
            sse[first:first + len(errors), i] = errors
        before.unpersist()
    state.unpersist()
    for b in sent:
        b.destroy()
    packs = [[t.bare() for t in done[a:a + PACK]] for a in range(0, rounds, PACK)]
    last = packs.pop() if packs and len(packs[-1]) < PACK else []
    return done, sse, Outputs(_Sent(sc, [sc.broadcast(p) for p in packs], last), fits)


def _grow(i: int, out: np.ndarray, groups: _Groups, fit: Fit, depth: int, table, sums, first: int, least: int, squares: bool):
    """The predictions of a fit by cell after a pack of rounds, the trees, and the squared errors over its fold."""
    (bins, every), (counts, totals) = table, sums
    m, width = bins.shape
    flat, row = bins.ravel(), np.arange(width)
    held, mean, rest = groups.held(i, every)
    places = [b.astype(np.int64) for b in bins]
    trees, errors = [], []
    for r in range(len(counts)):
        seen = np.concatenate([counts[r, :, groups.fold_of[i]], totals[r, :, groups.fold_of[i]]])
        values = groups.gradient(i, seen, out, not first + r, squares)
        grown, at = Trees.empty(1, depth), np.zeros(width, np.int64)
        feature, cut, some = grown.feature[0], grown.bin[0], values[0] > 0
        for level in range(fit.depth):
            nodes, base = 1 << level, (1 << level) - 1
            live = np.flatnonzero(some & (at >= base))
            node = (at.take(live) - base) * BINS
            weights = [v.take(live) for v in values]
            hist = np.empty((len(values), 1, nodes, m, BINS))
            for j in range(m):
                place = node + places[j].take(live)
                for k, w in enumerate(weights):
                    hist[k, 0, :, j] = np.bincount(place, weights=w, minlength=nodes * BINS).reshape(nodes, BINS)
            _split(grown, hist, level, least)
            if not (feature[base:base + nodes] >= 0).any():
                break
            f = feature.take(at).astype(np.int64)
            right = flat.take(np.maximum(f, 0) * width + row) > cut.take(at)
            at = np.where(f < 0, at, 2 * at + 1 + right)
        out = out + grown.value[0].take(at) * (fit.step if first + r else 1.0)
        trees.append(grown)
        errors.append(rest + float((held * (mean - out) ** 2).sum()))
    return out, trees, errors


def _errors(cells: dict, groups: _Groups, outputs: Outputs) -> np.ndarray:
    """(round, fit): squared error over the rows of the fit's fold after each round."""
    sums = groups.sums(cells, squares=True)[:, :-1]
    n, mean, rest = (np.array(part) for part in zip(*[groups.held(i, sums) for i in range(len(outputs.fits))]))
    sse = np.empty((outputs.sent.rounds, len(n)))
    for number, out in enumerate(outputs.after(cells["bins"], np.zeros(n.shape), 0)):
        sse[number] = rest + (n * (mean - out) ** 2).sum(axis=1)
    return sse


def _split(grown: Trees, sums: np.ndarray, level: int, least: int) -> None:
    """Best split of every node of a level: the first of the largest variance reductions."""
    n, s = sums[:2]
    fits, width, m, bins = n.shape
    nl, sl = n.cumsum(axis=3)[..., :-1], s.cumsum(axis=3)[..., :-1]
    whole, total = n.sum(axis=3)[:, :, :1], s.sum(axis=3)[:, :, :1]
    nr, sr = whole[..., None] - nl, total[..., None] - sl
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = sl * sl / nl + sr * sr / nr - (total * total / whole)[..., None]
    gain[(nl < least) | (nr < least) | ~np.isfinite(gain)] = -np.inf
    best = gain.reshape(fits, width, -1).argmax(axis=2)
    top = np.take_along_axis(gain.reshape(fits, width, -1), best[..., None], axis=2)[..., 0]
    base = (1 << level) - 1
    if level == 0:
        grown.totals[:len(sums), :, 0] = sums[:, :, 0, 0].sum(axis=2)
        grown.value[:, 0] = np.where(whole[:, 0, 0] > 0, total[:, 0, 0] / np.maximum(whole[:, 0, 0], 1), 0.0)
    scale = 1e-12 * np.maximum(1e-300, np.abs(total[..., 0] ** 2 / np.maximum(whole[..., 0], 1)))
    fit, node = np.nonzero(top > scale)  # a gain that is more than rounding
    j, cut = np.divmod(best[fit, node], bins - 1)
    grown.feature[fit, base + node], grown.bin[fit, base + node] = j, cut
    grown.gain[fit, base + node] = top[fit, node] / whole[fit, node, 0]
    left = sums[:, fit, node, j].cumsum(axis=2)[:, np.arange(len(fit)), cut]
    for side, own in enumerate((left, sums[:, fit, node, j].sum(axis=2) - left)):
        at = 2 * (base + node) + 1 + side
        grown.totals[:len(sums), fit, at] = own
        grown.value[fit, at] = own[1] / own[0]


def class_counts(blocks, fits: list[Fit], outputs: Outputs, classes: int) -> dict[int, np.ndarray]:
    """Confusion counts (actual, predicted) of every fold from one-vs-rest fits: the class of the largest output."""
    groups = _Groups(fits)
    order = [np.flatnonzero(groups.fold_of == i) for i in range(len(groups.folds))]

    def count(c):
        out, n = outputs.at(c["bins"]), groups.sums(c)
        total = np.zeros((len(groups.folds), classes, classes))
        for i, own in enumerate(order):
            guess = np.array([fits[k].positive for k in own])[out[own].argmax(axis=0)]
            for k, kind in enumerate(groups.kinds):
                total[i, kind] += np.bincount(guess, weights=n[k, i], minlength=classes)
        return total

    found = _cells(blocks, groups).map(count).reduce(np.add)
    return dict(zip(groups.folds, found))


def weighted_f1(counts: np.ndarray) -> float:
    """F1 by class, weighted by the class's rows; a class never met or never told scores 0."""
    right, actual, told = np.diag(counts), counts.sum(axis=1), counts.sum(axis=0)
    f1 = np.divide(2 * right, actual + told, out=np.zeros(len(right)), where=(actual + told) > 0)
    return float((f1 * actual).sum() / actual.sum())
