"""Operator 13: hard negatives by rotated one-bit codes with deterministic residual intervals.

A row's vector x is turned pseudo-randomly; the signs of its components are a code, and c = <x, u> along the code's
unit vector u (the stored alignment) leaves the residual r = x - c u, which is coded in the same way under the next
rotation, ``LEVELS`` times.  For an anchor q, <x, q> = sum of c <u, q> + <r, q>.  Each <u, q> is estimated by counting
bits of the code under the bit planes of the turned anchor, whose rounding error is summed exactly; by Cauchy and
Schwarz the rest lies within |r| sqrt(|q|^2 - <u, q>^2), as r is at right angles to the last u.  So every row gets an
interval that surely holds its score.  The k-th largest lower bound rules rows out after each level, and the rows whose
intervals survive are scored in whole numbers.

Rows are dealt evenly to pages (codes, alignments and whole-number vectors as binary arrays, about ``PAGE`` components
each), anchors to groups of ``ANCHORS``; a cell is one page against one group.  The cells' lists of k rows are merged
by rank.  Labels, copies and hot values play no part in how rows are dealt.  The positives are found first; their
scores give the windows of the negatives.

Components become floor(scale * x).  While the largest squared norm stays under 2^46 all scores and their multiples by
``PERCENT`` are exact doubles; beyond, a cell scores all its rows in Python integers (same results, slower), and a score
that no long holds becomes the nearest long.

Defined results: rows whose id, label or vector is null, or whose vector holds a null or non-finite component, take no
part; vectors meet only vectors of their length (empty ones score 0 with each other); an anchor is a row, and meets
every row but itself, so rows repeated in id, label and vector are rows like any other; ties go to the smaller id; an
anchor without positives, or a positive without negatives in its window, gives no row; an empty table gives an empty
result.  Other columns are not read, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut
from .embed_dups import rotate

LEVELS = 5        # codes of a row, each of what the ones before leave
PLANES = 8        # bits of an anchor's turned components
PAGE = 1 << 18    # components of a page's vectors
ANCHORS = 16384   # anchors of a cell
PERCENT = 100     # windows are given in hundredths of the positive's score
_EXACT = float(1 << 46)
_SEED = 1300

_PAGE = ("dim int, b long, n int, u binary, ids binary, labels binary, vecs binary, codes binary, ones binary, "
         "along binary, rest binary")


def _width(dim: int) -> int:
    """Length of a turned vector: a power of two, a word at least."""
    return max(64, 1 << max(0, dim - 1).bit_length())


def encode(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Codes (level, word, row), their set bits (level, row), alignments (level, row) and norms of what is left (row)."""
    n, d = x.shape
    w = _width(d)
    left = np.pad(x, ((0, 0), (0, w - d)))
    codes, ones, along = np.zeros((LEVELS, w // 64, n), np.uint64), np.zeros((LEVELS, n), np.int32), np.zeros((LEVELS, n))
    for level in range(LEVELS):  # ``left`` stays in the turned space: turns add up
        left = rotate(left, _SEED + level)
        up = left > 0
        codes[level] = np.ascontiguousarray(np.packbits(up, axis=1, bitorder="little")).view("<u8").T
        ones[level] = up.sum(axis=1)
        along[level] = np.abs(left).sum(axis=1) / np.sqrt(w)
        left = left - np.where(up, 1.0, -1.0) * (along[level] / np.sqrt(w))[:, None]
    return codes, ones, along, np.sqrt(np.einsum("ij,ij->i", left, left))


class _Anchor:
    """An anchor turned for each level, its components rounded to ``PLANES`` bits."""

    def __init__(self, turned: np.ndarray):
        self.norm2 = float((turned[0] ** 2).sum())
        w = turned.shape[1]
        self.root = np.sqrt(w)
        self.planes, self.low, self.step, self.total, self.error = [], [], [], [], []
        for q in turned:
            low, step = q.min(), (q.max() - q.min()) / ((1 << PLANES) - 1) or 1.0
            unit = np.rint((q - low) / step).astype(np.uint8)
            bits = np.unpackbits(unit[:, None], axis=1, bitorder="little", count=PLANES).T  # plane, component
            self.planes.append(np.ascontiguousarray(np.packbits(bits, axis=1, bitorder="little")).view("<u8"))
            self.low.append(low)
            self.step.append(step)
            self.total.append(float(unit.sum()))
            self.error.append(float(np.abs(q - (low + step * unit)).sum()) / self.root)

    def estimate(self, level: int, codes: np.ndarray, ones: np.ndarray) -> np.ndarray:
        """<u, q> of each code, within ``error[level]``: set bits of the code under each plane, weighted."""
        hits = np.bitwise_count(self.planes[level][:, :, None] & codes[None]).sum(axis=1, dtype=np.int32)
        held = (1 << np.arange(PLANES, dtype=np.int32)) @ hits
        w = self.root * self.root
        return (self.low[level] * (2.0 * ones - w) + self.step[level] * (2.0 * held - self.total[level])) / self.root


class _Page:
    def __init__(self, row):
        n, dim, w = int(row.n), int(row.dim), _width(int(row.dim))
        self.u, self.ids, self.labels = (np.frombuffer(b, np.int64) for b in (row.u, row.ids, row.labels))
        self.vecs = np.frombuffer(row.vecs, np.int64).reshape(n, dim)
        self.flat = self.vecs.astype(np.float64)
        self.codes = np.frombuffer(row.codes, np.uint64).reshape(LEVELS, w // 64, n)
        self.ones = np.frombuffer(row.ones, np.int32).reshape(LEVELS, n)
        self.along, self.rest = np.frombuffer(row.along).reshape(LEVELS, n), np.frombuffer(row.rest)
        total = (self.along ** 2).sum(axis=0) + self.rest ** 2
        # norm of what is left after each level
        self.left = np.sqrt(np.maximum(0.0, total - np.cumsum(self.along ** 2, axis=0)))
        self.left[-1] = self.rest

    def survivors(self, at: np.ndarray, anchor: _Anchor, floors: np.ndarray, ceilings: np.ndarray, k: int) -> np.ndarray:
        """Of rows ``at``, those that may be among the k highest scores in one of the windows [floor, ceiling]."""
        value, slack, floors = np.zeros(len(at)), np.zeros(len(at)), floors.copy()
        for level in range(LEVELS):
            part = anchor.estimate(level, self.codes[level][:, at], self.ones[level][at])
            along = self.along[level][at]
            value = value + along * part
            slack = slack + along * anchor.error[level]
            off = np.maximum(0.0, np.abs(part) - anchor.error[level])  # the least that |<u, q>| may be
            free = np.sqrt(np.maximum(0.0, anchor.norm2 - off * off))
            wide = slack + self.left[level][at] * free
            wide = wide * (1 + 1e-9) + 1e-9 * (np.abs(value) + 1.0) + 1e-6
            low, high = value - wide, value + wide
            keep = np.zeros(len(at), bool)
            for j in range(len(floors)):
                sure = low[(low >= floors[j]) & (high <= ceilings[j])]
                if len(sure) >= k:
                    floors[j] = max(floors[j], np.partition(sure, len(sure) - k)[-k])
                keep |= (high >= floors[j]) & (low <= ceilings[j])
            at, value, slack = at[keep], value[keep], slack[keep]
            if len(at) <= k:
                break
        return at


def _turned(x: np.ndarray) -> np.ndarray:
    """``x`` (row, component) turned for each level: (level, row, component)."""
    x = np.pad(x, ((0, 0), (0, _width(x.shape[1]) - x.shape[1])))
    out = []
    for level in range(LEVELS):
        x = rotate(x, _SEED + level)
        out.append(x)
    return np.stack(out)


def _first(scores: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k highest scores, ties to the smaller id."""
    return np.lexsort((ids, -scores))[:k]


def _long(s: int) -> int:
    return max(-1 << 63, min(int(s), (1 << 63) - 1))


def _positives(page: _Page, rows: pd.DataFrame, k: int, exact: bool) -> list[tuple]:
    """``(anchor row, score, id)`` of the page's best k rows of each anchor's label."""
    out: list[tuple] = []
    vecs = _matrix(rows["v"], page.vecs.shape[1])
    turned = _turned(vecs.astype(np.float64)) if exact else None
    for i, (u, label) in enumerate(zip(rows["u"], rows["label"])):
        at = np.flatnonzero((page.labels == label) & (page.u != u))
        if exact:
            at = page.survivors(at, _Anchor(turned[:, i]), np.array([-np.inf]), np.array([np.inf]), k)
        s = _scores(page, at, vecs[i], exact)
        best = _first(s, page.ids[at], k)
        out += [(u, _long(s[j]), int(page.ids[at[j]])) for j in best]
    return out


def _negatives(page: _Page, rows: pd.DataFrame, k: int, exact: bool, share: tuple[int, int]) -> list[tuple]:
    """``(anchor row, positive's rank, score, id)`` of the page's best k rows of other labels in each window."""
    out: list[tuple] = []
    vecs = _matrix(rows["v"], page.vecs.shape[1])
    turned = _turned(vecs.astype(np.float64)) if exact else None
    for i, (u, label, wanted) in enumerate(zip(rows["u"], rows["label"], rows["wanted"])):
        at = np.flatnonzero(page.labels != label)
        wanted = [int(p) for p in wanted]
        if exact:
            p = np.array(wanted, np.float64)
            at = page.survivors(at, _Anchor(turned[:, i]), np.ceil(p * share[0] / PERCENT - 1e-6),
                                np.floor(p * share[1] / PERCENT + 1e-6), k)
        s = _scores(page, at, vecs[i], exact)
        for r, p in enumerate(wanted):
            fit = np.flatnonzero((share[0] * p <= PERCENT * s) & (PERCENT * s <= share[1] * p))
            out += [(u, r, _long(s[fit[j]]), int(page.ids[at[fit[j]]])) for j in _first(s[fit], page.ids[at[fit]], k)]
    return out


def _matrix(vs: pd.Series, dim: int) -> np.ndarray:
    return np.concatenate([np.asarray(v, np.int64) for v in vs]).reshape(len(vs), dim) if dim else np.zeros((len(vs), 0), np.int64)


def _scores(page: _Page, at: np.ndarray, q: np.ndarray, exact: bool) -> np.ndarray:
    if exact:
        return (page.flat[at] @ q.astype(np.float64)).astype(np.int64)
    return np.array([sum(a * b for a, b in zip(map(int, x), map(int, q))) for x in page.vecs[at]], object)


def mine(rows: DataFrame, id_col: str, vec: str, label: Column, is_anchor: Column, positives: int, negatives: int,
         share: tuple[int, int], scale: float) -> DataFrame:
    """``(anchor_id, positive_id, rank, negative_id, positive_score, negative_score)``.

    An anchor's positives are its ``positives`` best rows of its label; for each, the ``negatives`` best rows of other
    labels with ``share[0] * positive <= 100 * negative <= share[1] * positive``.
    """
    v = F.col(f"`{vec}`").cast("array<double>")
    fit = v.isNotNull() & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    src = rows.select(F.col(f"`{id_col}`").cast("long").alias("id"), label.cast("long").alias("label"),
                      F.when(fit, F.transform(v, lambda x: F.floor(F.lit(scale) * x))).alias("v"),
                      F.coalesce(is_anchor, F.lit(False)).alias("ask"))
    src = cut(src.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.col("v").isNotNull())
              .select("*", F.size("v").alias("dim"), F.monotonically_increasing_id().alias("u"),
                      F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")).alias("norm")))
    n, asked, dim, top = src.agg(F.count(F.lit(1)), F.count(F.when(F.col("ask"), 1)), F.max("dim"), F.max("norm")).first()
    pages, groups = max(1, -(-n * max(1, dim or 1) // PAGE)), max(1, -(-asked // ANCHORS))
    exact = float(top or 0.0) < _EXACT
    deal = lambda m: F.pmod(F.xxhash64("u"), F.lit(m))

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        d = int(pdf["dim"].iloc[0])
        vecs = _matrix(pdf["v"], d)
        codes, ones, along, rest = encode(vecs.astype(np.float64))
        longs = {c: pdf[c].to_numpy(np.int64).tobytes() for c in ("u", "id", "label")}
        return pd.DataFrame([{"dim": d, "b": int(pdf["b"].iloc[0]), "n": len(pdf), "u": longs["u"], "ids": longs["id"],
                              "labels": longs["label"], "vecs": vecs.tobytes(), "codes": codes.tobytes(),
                              "ones": ones.tobytes(), "along": along.tobytes(), "rest": rest.tobytes()}])

    stored = cut(src.select("u", "id", "label", "v", "dim", deal(pages).alias("b"))
                 .groupBy("dim", "b").applyInPandas(pack, _PAGE))
    stored = stored.withColumn("g", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))))
    anchors = src.where("ask").select("u", "id", "label", "v", "dim", deal(groups).alias("g"))

    def cells(asking: DataFrame, find, out: str) -> DataFrame:
        every = asking.withColumn("b", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(pages - 1).cast("long"))))
        columns = [c.split()[0] for c in out.split(", ")]

        def cell(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
            got = find(_Page(next(left.itertuples())), right) if len(left) and len(right) else []
            return pd.DataFrame(got, columns=columns)

        return stored.groupBy("dim", "b", "g").cogroup(every.groupBy("dim", "b", "g")).applyInPandas(cell, out)

    found = cells(anchors, lambda p, a: _positives(p, a, positives, exact), "u long, score long, id long")
    w = Window.partitionBy("u").orderBy(F.desc("score"), "id")  # k rows per page
    found = cut(found.withColumn("r", F.row_number().over(w) - 1).where(F.col("r") < positives))
    wanted = found.groupBy("u").agg(F.sort_array(F.collect_list(F.struct("r", "score", "id"))).alias("found"))
    asking = cut(anchors.join(wanted, "u").select("*", F.col("found.score").alias("wanted")))
    hard = cells(asking.drop("found", "id"), lambda p, a: _negatives(p, a, negatives, exact, share),
                 "u long, r int, score long, negative_id long")
    w = Window.partitionBy("u", "r").orderBy(F.desc("score"), "negative_id")
    hard = hard.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= negatives)
    named = asking.select("u", F.col("id").alias("anchor_id"), F.explode("found").alias("f")).select(
        "u", "anchor_id", F.col("f.r").alias("r"), F.col("f.id").alias("positive_id"), F.col("f.score").alias("positive_score"))
    return hard.join(named, ["u", "r"]).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score",
        F.col("score").alias("negative_score"))
