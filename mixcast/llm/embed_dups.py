"""Operator 7: near-duplicate embeddings by cross-polytope hashing with multiprobe buckets.

Equal vectors are collapsed first.  A hash function rotates the unit vector pseudo-randomly (three rounds of random
signs and a fast Walsh-Hadamard transform) and names the nearest vertex of the cross-polytope: the coordinate of
the largest size, and its sign (Andoni et al., 2015).  A table joins ``width`` functions; the vector is stored under
its own bucket and looked up in that bucket and in those where one function takes a next-nearest vertex.  The
number of functions follows the logarithm of the number of vectors, so a bucket holds a few; that of the tables
makes up for the smaller chance of each.  Candidate pairs pass a 64-bit sign sketch (a pair at the threshold differs
in about 6 bits with a deviation of 2.4; more than ``SKETCH_BITS`` rules it out), are made distinct, and verified by
the cosine in double precision.

Defined results: vectors that are null, empty, zero or hold null or non-finite components link with nothing and are
their own component; vectors meet only vectors of their length; equal vectors link whatever their ids; rows with a
null id count as links, and never name a component (a component of null ids only has a null name, and no row kept);
rows repeated in id and vector are rows like any other; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import connected_components, cut
from .topk import finite

SEED = 20
LOAD = 8          # vectors a bucket holds on average, about
SKETCH_BITS = 22  # at the default threshold; scaled with the angle
PROBES = 3        # vertices tried per function


def hadamard(x: np.ndarray) -> np.ndarray:
    """Walsh-Hadamard transform of the rows of ``x``; their length is a power of two."""
    n, d = x.shape
    h = 1
    while h < d:
        y = x.reshape(n, d // (2 * h), 2, h)
        x = np.concatenate([y[:, :, :1] + y[:, :, 1:], y[:, :, :1] - y[:, :, 1:]], axis=2).reshape(n, d)
        h *= 2
    return x


def rotate(x: np.ndarray, seed: int) -> np.ndarray:
    """Three rounds of random signs and transforms: a pseudo-random rotation, up to scale."""
    rng = np.random.default_rng(seed)
    for _ in range(3):
        x = hadamard(x * rng.choice([-1.0, 1.0], x.shape[1])) / math.sqrt(x.shape[1])
    return x


def codes(x: np.ndarray, table: int, width: int, probes: int) -> tuple[np.ndarray, np.ndarray]:
    """Own bucket (n) and looked-up buckets (n, 1 + width * (probes - 1)) of unit rows in one table."""
    n, d = x.shape
    own = np.zeros(n, np.int64)
    tops = []
    for f in range(width):
        y = rotate(x, (SEED * 1000 + table) * 64 + f)
        best = np.argsort(-np.abs(y), axis=1, kind="stable")[:, :probes]
        vertex = 2 * best + (np.take_along_axis(y, best, axis=1) < 0)
        tops.append(vertex.astype(np.int64))
        own = own * (2 * d) + vertex[:, 0]
    look = [own]
    for f in range(width):
        place = (2 * d) ** (width - 1 - f)
        look += [own + (tops[f][:, p] - tops[f][:, 0]) * place for p in range(1, tops[f].shape[1])]
    return own, np.stack(look, axis=1)


def plan(n: int, dim: int, threshold: float) -> tuple[int, int]:
    """Functions per table, and tables, for ``n`` vectors."""
    d = 1 << max(1, (dim - 1).bit_length())
    width = max(1, round(math.log(max(2.0, n / LOAD)) / math.log(2 * d)))
    return width, {1: 6, 2: 10, 3: 20, 4: 40}.get(width, 10 * 2 ** (width - 1))


def links(vecs: DataFrame, threshold: float = 0.95, tables: int | None = None, width: int | None = None) -> DataFrame:
    """Links ``(a, b)``, a < b, between rows ``(u, v, dim)`` of distinct vectors, found by hashing, verified exactly."""
    n, dim = vecs.agg(F.count(F.lit(1)), F.max("dim")).first()
    auto = plan(n, dim or 1, threshold)
    width, tables = width or auto[0], tables or auto[1]
    bits = min(64, round(SKETCH_BITS * math.acos(max(-1.0, threshold)) / math.acos(0.95)))

    def hashed(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            for dim_, g in pdf.groupby("dim"):
                x = np.stack(g["v"].to_numpy()).astype(np.float64)
                x /= np.abs(x).max(axis=1, keepdims=True)
                x /= np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]
                x = np.pad(x, ((0, 0), (0, (1 << max(1, (int(dim_) - 1).bit_length())) - int(dim_))))
                u = g["u"].to_numpy()
                turned = np.hstack([rotate(x, 7 + r) for r in range(-(-64 // x.shape[1]))])[:, :64]
                sketch = np.packbits(turned > 0, axis=1).view(">u8").ravel().astype(np.uint64).view(np.int64)
                for t in range(tables):
                    _, look = codes(x, t, width, PROBES)
                    m = look.shape[1]
                    yield pd.DataFrame({"t": t * 100_000 + int(dim_), "k": look.ravel(), "u": np.repeat(u, m),
                                        "s": np.repeat(sketch, m), "own": np.tile(np.arange(m) == 0, len(u))})

    rows = cut(vecs.mapInPandas(hashed, "t int, k long, u long, s long, own boolean"))
    a = rows.where("own").select("t", "k", F.col("u").alias("a"), F.col("s").alias("sa"))
    b = rows.select("t", "k", F.col("u").alias("b"), F.col("s").alias("sb"))
    near = (a.join(b, ["t", "k"]).where((F.col("a") != F.col("b")) & (F.bit_count(F.col("sa").bitwiseXOR(F.col("sb"))) <= bits))
            .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())
    left = vecs.select(F.col("u").alias("a"), F.col("v").alias("va"))
    right = vecs.select(F.col("u").alias("b"), F.col("v").alias("vb"))

    def verify(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            if len(pdf):
                dims = pdf["va"].map(len)
                for _, g in pdf.groupby(dims):
                    x, y = (np.stack(g[c].to_numpy()).astype(np.float64) for c in ("va", "vb"))
                    x, y = (z / np.abs(z).max(axis=1, keepdims=True) for z in (x, y))
                    cos = np.einsum("ij,ij->i", x, y) / np.sqrt(np.einsum("ij,ij->i", x, x) * np.einsum("ij,ij->i", y, y))
                    yield g.loc[cos >= threshold, ["a", "b"]]

    return near.join(left, "a").join(right, "b").mapInPandas(verify, "a long, b long")


def near_duplicates(rows: DataFrame, id_col: str, vec: str, threshold: float = 0.95) -> DataFrame:
    """``(id, n_links, component, kept)`` for every row."""
    src = rows.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{vec}`").cast("array<double>").alias("v"))
    fit = finite(F.col("v")) & F.exists("v", lambda x: x != 0)
    src = cut(src.select("id", F.when(fit, F.col("v")).alias("v")))
    good = src.where(F.col("v").isNotNull())
    values = cut(good.groupBy("v").agg(F.count(F.lit(1)).alias("copies"), F.min("id").alias("first"))
                 .select("*", F.size("v").alias("dim"), F.monotonically_increasing_id().alias("u")))
    found = cut(links(values.select("u", "v", "dim"), threshold))
    sizes = values.select(F.col("u").alias("b"), "copies")
    both = found.union(found.select(F.col("b").alias("a"), F.col("a").alias("b")))
    degree = both.join(sizes, "b").groupBy("a").agg(F.sum("copies").alias("others"))
    comp = connected_components(found)
    named = (values.join(degree, values.u == degree.a, "left").join(comp, values.u == comp.id, "left")
             .select("v", "first", (F.col("copies") - 1 + F.coalesce("others", F.lit(0))).alias("n_links"),
                     F.coalesce("component", "u").alias("c")))
    least = named.groupBy("c").agg(F.min("first").alias("component"))
    named = named.join(least, "c").select("v", "n_links", "component")
    linked = good.join(named, "v").select("id", "n_links", "component")
    alone = src.where(F.col("v").isNull()).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component"))
    return linked.union(alone).select("*", F.coalesce(F.col("id") == F.col("component"), F.lit(False)).alias("kept"))
