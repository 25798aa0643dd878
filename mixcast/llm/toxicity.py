"""Operator 10: toxic passages as maximum-scoring segments of token log-odds.

* Training: labelled rows, at most ``per_class`` of each label (smallest hashes of the id), one row per distinct
  text.  For every token the documents of each class that hold it are counted.  A token's share of toxic documents
  is smoothed by a Dirichlet prior of weight ``PRIOR`` around the share of its first five letters, that one around
  the share of its first four, and that around the share of all; the token's score is the log-odds of its share
  against the share of all (log-odds with an informative prior: Monroe, Colaresi and Quinn, 2008), less a cost per
  token.  Features are hashed to ``BUCKETS`` cells, so the model has a fixed size.
* Scan: the maximal scoring segments of a text (Ruzzo and Tompa, 1999) in one pass over its tokens; the significant
  ones are its toxic passages.
* Calibration: a segment's score S in n tokens is put on the extreme-value scale  x = lambda S - ln(K n)  (Karlin
  and Altschul, 1990), lambda being the positive root of  E[exp(lambda s)] = 1  over tokens of clean training texts.
  The expected numbers of such segments add up over a text's segments, and a logistic curve of the sum, fitted on
  labelled texts kept apart from the counts, turns it into a score between 0 and 1.

Defined results: null and empty texts have no segment and get the lowest score; repeated rows get equal scores;
labels that are null or neither 0 nor 1 are ignored, and a text labelled both ways counts as toxic; with no toxic or
no clean training row every score is 0; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import Memo, cut

BUCKETS = 1 << 18
PER_CLASS = 20_000   # labelled rows of either label that the model is fitted on
COST = 2.0           # taken off every token's score, so that chance segments stay short
PRIOR = 20.0         # documents that the prior of a token's toxic share stands for
MEMO = 120_000       # remembered tokens per worker; memory only
_EDGE = re.compile(r"^[\W_]+|[\W_]+$")


def features(chunk: str) -> list[int]:
    """Cells of a token's first four letters, first five and whole word, as far as they differ."""
    word = _EDGE.sub("", chunk.lower())
    if not word:
        return []
    names = [f"p {word[:n]}" for n in (4, 5) if len(word) > n] + [f"w {word}"]
    return [xxhash.xxh64_intdigest(x.encode()) & (BUCKETS - 1) for x in names]


@dataclass
class Model:
    """Fixed-size model: documents per cell, the segment scale and the logistic curve."""
    toxic: np.ndarray = field(default_factory=lambda: np.zeros(BUCKETS, np.float32))
    every: np.ndarray = field(default_factory=lambda: np.zeros(BUCKETS, np.float32))
    share: float = 0.5
    lam: float = 1.0
    k: float = 0.1
    slope: float = 0.0
    shift: float = -50.0

    def token(self, chunk: str) -> float:
        p = self.share
        for c in features(chunk):
            p = (float(self.toxic[c]) + PRIOR * p) / (float(self.every[c]) + PRIOR)
        return math.log(p / (1 - p)) - math.log(self.share / (1 - self.share))


def segments(scores: list[tuple[int, float]], cost: float) -> list[tuple[float, int, int]]:
    """All maximal scoring segments ``(score, first, last)``, in linear time.

    ``scores`` holds ``(position, score)`` of the tokens whose score is not zero; every token costs ``cost``.  A
    segment begins and ends at tokens whose net score is positive, so the others only add to the running total.
    """
    stack: list[tuple[float, float, int, int]] = []  # total before, total after, first, last
    total, nxt = 0.0, 0
    for at, s in scores:
        total -= cost * (at - nxt)
        nxt = at + 1
        net = s - cost
        if net <= 0:
            total += net
            continue
        low, first = total, at
        total += net
        while stack:
            j = len(stack) - 1
            while j >= 0 and stack[j][0] >= low:
                j -= 1
            if j < 0 or stack[j][1] >= total:
                break
            low, first = stack[j][0], stack[j][2]
            del stack[j:]
        stack.append((low, total, first, at))
    return [(b - a, f, t) for a, b, f, t in stack]


class Scorer:
    def __init__(self, model: Model):
        self.model = model
        self.tokens = Memo(model.token, MEMO)

    def scan(self, text: str | None) -> tuple[float, list[tuple[float, int, int]]]:
        """Extreme-value statistic of a text and its maximal segments."""
        if not text:
            return -30.0, []
        chunks = text.lower().split()
        found = segments([(i, s) for i, s in enumerate(map(self.tokens.__getitem__, chunks)) if s], COST)
        base = math.log(max(1e-12, self.model.k * max(1, len(chunks))))
        xs = sorted((self.model.lam * s - base for s, _, _ in found), reverse=True)
        # expected chance segments as good: exp(-x) each; their evidence adds up over distinct segments
        x = sum(x for x in xs if x > 0) if xs and xs[0] > 0 else (xs[0] if xs else -30.0)
        return max(-30.0, min(200.0, x)), found

    def score(self, x: float) -> float:
        z = self.model.slope * x + self.model.shift
        return 1 / (1 + math.exp(-z)) if z > -500 else 0.0


def fold(id_col: Column, folds: int = 5) -> Column:
    """crc32 of the id as text, modulo ``folds``; ids that are null belong to fold 0."""
    return F.coalesce(F.crc32(id_col.cast("string").cast("binary")) % folds, F.lit(0))


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text: str = "text", label: str = "toxic",
        per_class: int = PER_CLASS) -> Model:
    """Fit on labelled rows outside fold 0: counts on folds 2 to 4, the curve on fold 1; at most 2 * per_class rows."""
    spark = docs.sparkSession
    i, y = F.col(f"`{id_col}`").cast("long"), F.col(f"`{label}`").cast("int")
    known = labels.select(i.alias("id"), y.alias("y")).where(F.col("y").isin(0, 1) & (fold(F.col("id")) != 0))
    pick = [known.where(F.col("y") == v).distinct().orderBy(F.xxhash64("id"), "id").limit(per_class) for v in (0, 1)]
    few = pick[0].unionByName(pick[1]).groupBy("id").agg(F.max("y").alias("y"))  # at most 2 * per_class rows
    texts = docs.select(i.alias("id"), F.col(f"`{text}`").alias("text"))
    rows = texts.join(F.broadcast(few), "id").groupBy(F.xxhash64("text").alias("h"), "text").agg(
        F.max("y").alias("y"), F.min("id").alias("id")).select("y", "text", fold(F.col("id")).alias("part"))
    rows = cut(rows)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        n = np.zeros((2, BUCKETS), np.int32)
        memo = Memo(features, MEMO)
        for pdf in batches:
            for label_, t in zip(pdf["y"], pdf["text"]):
                cells = {c for w in set((t or "").lower().split()) for c in memo[w]}
                n[label_, np.fromiter(cells, np.int64, len(cells))] += 1
        at = np.flatnonzero(n.any(axis=0))
        yield pd.DataFrame({"cell": at, "clean": n[0, at], "toxic": n[1, at]})

    fitted = rows.where("part <> 1")
    per_class_n = {r["y"]: r["n"] for r in fitted.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    model = Model()
    if len(per_class_n) < 2:
        return model
    c = (fitted.mapInPandas(count, "cell int, clean int, toxic int").groupBy("cell")
         .agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")).toPandas())  # at most BUCKETS rows
    model.toxic[c["cell"]] = c["toxic"]
    model.every[c["cell"]] = c["toxic"] + c["clean"]
    model.share = per_class_n[1] / (per_class_n[0] + per_class_n[1])
    model.lam, model.k = _scale(fitted.where("y = 0"), model)
    shared = spark.sparkContext.broadcast(model)

    def xs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = Scorer(shared.value)
        for pdf in batches:
            yield pd.DataFrame({"y": pdf["y"], "x": [scorer.scan(t)[0] for t in pdf["text"]]})

    held = rows.where("part = 1").mapInPandas(xs, "y int, x double").toPandas()  # part of the bounded sample
    model.slope, model.shift = _logistic(held["x"].to_numpy(), held["y"].to_numpy())
    return model


def _scale(clean: DataFrame, model: Model) -> tuple[float, float]:
    """lambda and K of chance segments: the tokens' net scores over clean texts, as a bounded histogram."""
    shared = clean.sparkSession.sparkContext.broadcast(model)

    def hist(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        tokens = Scorer(shared.value).tokens
        n = np.zeros(400, np.int64)
        for pdf in batches:
            for t in pdf["text"]:
                s = np.fromiter(map(tokens.__getitem__, (t or "").lower().split()), np.float64)
                n += np.bincount(np.clip(np.rint((s - COST) * 10).astype(np.int64) + 200, 0, 399), minlength=400)
        at = np.flatnonzero(n)
        yield pd.DataFrame({"bin": at, "n": n[at]})

    h = clean.mapInPandas(hist, "bin int, n long").groupBy("bin").agg(F.sum("n").alias("n")).toPandas()  # 400 rows
    s = (h["bin"].to_numpy() - 200) / 10.0
    p = h["n"].to_numpy(dtype=float)
    s, p = np.append(s, 1.0), np.append(p, 0.5)  # half a token of score 1, so that a root exists
    p /= p.sum()
    low, high = 1e-6, 5.0
    for _ in range(80):
        mid = (low + high) / 2
        low, high = (mid, high) if float((p * np.exp(mid * s)).sum()) < 1 else (low, mid)
    return low, max(1e-6, float(p[s > 0].sum()))


def _logistic(x: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and shift of the likeliest logistic curve on a grid of slopes and midpoints."""
    if len(x) == 0 or y.min() == y.max():
        return 1.0, -3.0
    x = np.clip(x, -10, 60)
    # a text of either class at the ends of the scale keeps the curve from becoming a step
    x, y = np.append(x, [-10.0, 60.0]), np.append(y, [1, 0])
    best = (-np.inf, 1.0, -3.0)
    for mid in np.arange(-8, 40, 0.25):
        for slope in (0.1, 0.15, 0.2, 0.3, 0.4, 0.6, 0.8, 1.0, 1.5, 2.0):
            z = np.where(y == 1, -1, 1) * slope * (x - mid)
            best = max(best, (-float(np.logaddexp(0, z).sum()), slope, -slope * mid))
    return best[1], best[2]


def score(docs: DataFrame, model: Model, text: str = "text", name: str = "score", passages: str | None = None) -> DataFrame:
    """``docs`` plus its score (0 to 1) as column ``name`` and, if ``passages`` names a column, the significant segments
    (first token, last token, score).  Input columns of these names are replaced."""
    cols = [c for c in docs.columns if c not in {name, passages}]
    own = [f"__c{i}" for i in range(len(cols))]
    src = docs.select(*[F.col(f"`{c}`").alias(o) for c, o in zip(cols, own)], F.col(f"`{text}`").alias("__text"))
    shared = docs.sparkSession.sparkContext.broadcast(model)
    kind = "array<struct<first:int,last:int,score:double>>"
    extra = [F.expr(f"cast(array() as {kind})").alias("__passages")] if passages else []
    body = own[cols.index(text)] if text in cols else "__text"
    if text in cols:
        src = src.drop("__text")
    schema = src.select(*own, F.lit(0.0).alias("__score"), *extra).schema

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scorer = Scorer(shared.value)
        fitted = scorer.model
        for pdf in batches:
            texts = pdf[body]
            scanned = [scorer.scan(t) for t in texts]
            pdf["__score"] = [scorer.score(x) for x, _ in scanned]
            if passages:
                sizes = [len(t.split()) if t else 0 for t in texts]
                pdf["__passages"] = [
                    [{"first": a, "last": b, "score": s} for s, a, b in found
                     if fitted.lam * s - math.log(max(1e-12, fitted.k * max(1, n))) > 0]
                    for (_, found), n in zip(scanned, sizes)]
            yield pdf[schema.names]

    out = src.mapInPandas(run, schema)
    tail = [F.col("__passages").alias(passages)] if passages else []
    return out.select(*[F.col(o).alias(c) for c, o in zip(cols, own)], F.col("__score").alias(name), *tail)
