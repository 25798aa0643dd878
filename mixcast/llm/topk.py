"""Operator 5: exact top-k inner products by best-first search of M-trees.

Inner products become distances: with M the largest norm, x' = (x, sqrt(M^2 - |x|^2)) and q' = (q, 0) have
|q' - x'|^2 = |q|^2 + M^2 - 2 <q, x>, so the k largest scores are the k nearest points of a metric space.

Rows are dealt evenly to blocks of about ``BLOCK``; each block becomes an M-tree (Ciaccia, Patella and Zezula, 1997),
stored as a table of pages: pivot, covering radius, distance to the parent's pivot and, for leaves, the entries with
their distances to the pivot.  Query blocks meet tree blocks in cells of bounded size; in a cell every query pops
pages in the order of their lower bounds, skips pages and entries whose stored distances already rule them out,
and stops when the next bound is beyond its k-th best; queries that pop the same page share one matrix product.  The cells' lists are merged by rank.  Pages, blocks and cells
have fixed sizes, so copies and hot values make no large group.

Components are quantised to floor(scale * x), and scores are exact integers while squared norms stay under 2^52;
beyond that a cell compares with Python integers and no bounds (same results, slower), and a score that no long
holds becomes the nearest long.

Defined results: vectors that are null, empty or hold null or non-finite components, and rows with a null id, take no
part; vectors meet only vectors of their length; rows repeated in id and vector count once; a query never meets rows
of its own id; ties go to the smaller id; fewer than k candidates give fewer rows; an empty table gives an empty
result.  Other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import cut

BLOCK = 8192      # rows of a tree
QUERIES = 1024    # queries of a cell
PAGE = 256        # entries of a leaf page
FAN = 8           # children of an inner page
_EXACT = float(1 << 52)

_PAGES = ("dim int, b long, page int, parent int, leaf boolean, pivot binary, norm double, radius double, "
          "parent_dist double, ids binary, vecs binary, dists binary")


def finite(vec: Column) -> Column:
    """Whether a vector takes part: not null, not empty, all components finite."""
    return vec.isNotNull() & (F.size(vec) > 0) & F.forall(
        vec, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))


def _build(ids: np.ndarray, x: np.ndarray, top: float) -> list[dict]:
    """Pages of one block's tree; ``x`` holds quantised vectors, ``top`` the largest squared norm of all rows."""
    norm = np.einsum("ij,ij->i", x, x)
    lift = np.sqrt(np.maximum(0.0, top - norm))
    pages: list[dict] = []

    def far(at: np.ndarray, p: int) -> np.ndarray:
        d = norm[at] + norm[p] - 2 * (x[at] @ x[p])
        return np.sqrt(np.maximum(0.0, d) + (lift[at] - lift[p]) ** 2)

    todo = [(np.arange(len(ids)), -1, -1)]
    while todo:
        at, parent, above = todo.pop()
        mid = x[at].mean(axis=0)
        p = int(at[np.argmin(((x[at] - mid) ** 2).sum(axis=1))])
        d = far(at, p)
        leaf = len(at) <= PAGE
        page = {"page": len(pages), "parent": parent, "leaf": leaf, "pivot": x[p].tobytes(), "norm": float(norm[p]),
                "radius": float(d.max()), "parent_dist": float(far(np.array([p]), above)[0]) if above >= 0 else 0.0,
                "ids": ids[at].tobytes() if leaf else b"",
                "vecs": x[at].tobytes() if leaf else b"", "dists": d.tobytes() if leaf else b""}
        pages.append(page)
        if leaf:
            continue
        # children: nearest of FAN rows picked farthest-first from a spread of rows
        some = at[np.linspace(0, len(at) - 1, min(len(at), 512)).astype(int)]
        centres, reach = [p], far(some, p)
        while len(centres) < FAN and reach.max() > 0:
            centres.append(int(some[reach.argmax()]))
            reach = np.minimum(reach, far(some, centres[-1]))
        near = np.argmin(np.stack([far(at, c) for c in centres]), axis=0)
        parts = [at[near == c] for c in range(len(centres))]
        if max(map(len, parts)) > 0.9 * len(at):  # copies cannot be told apart: equal shares
            parts = np.array_split(at[np.argsort(d, kind="stable")], FAN)
        todo += [(part, page["page"], p) for part in parts if len(part)]
    return pages


class _Tree:
    def __init__(self, pages: pd.DataFrame, dim: int):
        pages = pages.sort_values("page").reset_index(drop=True)
        self.leaf = pages["leaf"].to_numpy()
        self.pivot = np.stack([np.frombuffer(p, np.float64) for p in pages["pivot"]])
        self.norm, self.radius = pages["norm"].to_numpy(), pages["radius"].to_numpy()
        self.step, self.parent = pages["parent_dist"].to_numpy(), pages["parent"].to_numpy()
        self.ids = [np.frombuffer(b, np.int64) for b in pages["ids"]]
        self.vecs = [np.frombuffer(b, np.float64).reshape(-1, dim) for b in pages["vecs"]]
        self.dists = [np.frombuffer(b, np.float64) for b in pages["dists"]]

    def search(self, q: np.ndarray, own: np.ndarray, k: int, top: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """``(query, score, id)`` of at least the k best rows of each query but those of its own id, ties included.

        All queries of the cell search at once: each pops its next page in the order of its lower bounds, and those
        that popped the same page share one product.  Leaves are ordered by the bound their stored distance to the
        parent gives; a leaf's own pivot is only compared when the page is popped.
        """
        m, n = len(q), len(self.leaf)
        base = (q * q).sum(axis=1) + top
        reach = lambda ip, b: np.sqrt(np.maximum(0.0, b - 2 * ip))
        dist, low = np.zeros((m, n)), np.zeros((m, n))
        inner = np.flatnonzero(~self.leaf)
        if len(inner):
            dist[:, inner] = reach(q @ self.pivot[inner].T, base[:, None])
        for page in range(1, n):  # parents come before their children
            p = self.parent[page]
            low[:, page] = np.maximum(low[:, p], np.abs(dist[:, p] - self.step[page]) - self.radius[page])
        leaves = np.flatnonzero(self.leaf)
        turn = np.argsort(low[:, leaves], axis=1, kind="stable")
        best, limit = np.full((m, k), -np.inf), np.full(m, np.inf)
        every = np.arange(m)
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for r in range(len(leaves)):
            pages = leaves[turn[:, r]]
            live = every[low[every, pages] <= limit]
            if not len(live):
                break
            for page in np.unique(pages[live]):
                at = live[pages[live] == page]
                d = reach(q[at] @ self.pivot[page], base[at])
                near = d - self.radius[page] <= limit[at]
                at, d = at[near], d[near]
                if not len(at):
                    continue
                ids = self.ids[page]
                use = np.flatnonzero((np.abs(d[:, None] - self.dists[page]) <= limit[at][:, None]).any(axis=0))
                s = q[at] @ self.vecs[page][use].T
                s[own[at][:, None] == ids[use]] = -np.inf
                i, j = np.nonzero(s >= np.maximum(best[at].min(axis=1), -1e300)[:, None])
                found.append((at[i], s[i, j], ids[use][j]))
                both = np.concatenate([best[at], s], axis=1)
                best[at] = np.partition(both, both.shape[1] - k, axis=1)[:, -k:]
                worst = best[at].min(axis=1)
                full = worst > -1e300
                limit[at[full]] = reach(worst[full], base[at[full]]) * (1 + 1e-9) + 1e-6
        if not found:
            return np.empty(0, np.int64), np.empty(0), np.empty(0, np.int64)
        return tuple(np.concatenate(x) for x in zip(*found))


def top_k(rows: DataFrame, id_col: str, vec: str, is_query: Column, k: int, scale: float = 64.0) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: the k best rows of each query, by score down and id up."""
    src = rows.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{vec}`").cast("array<double>").alias("v"),
                      F.coalesce(is_query, F.lit(False)).alias("ask"))
    src = src.where(F.col("id").isNotNull() & finite(F.col("v")))
    src = src.select("id", "ask", F.transform("v", lambda x: F.floor(F.lit(scale) * x)).alias("v"))
    src = cut(src.groupBy("id", "v").agg(F.max("ask").alias("ask")).select(
        "*", F.size("v").alias("dim"), F.xxhash64("v").alias("key"),
        F.aggregate("v", F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")).alias("norm")))
    n, asked, top = src.agg(F.count(F.lit(1)), F.count(F.when(F.col("ask"), 1)), F.max("norm")).first()
    blocks, asks, top = max(1, -(-n // BLOCK)), max(1, -(-asked // QUERIES)), float(top or 0.0)
    deal = lambda m: F.pmod(F.xxhash64("id", "key"), F.lit(m))

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        dim, b = int(pdf["dim"].iloc[0]), int(pdf["b"].iloc[0])
        x = np.stack(pdf["v"].to_numpy()).astype(np.float64)
        if top >= _EXACT:  # one flat page of whole integers
            whole = np.stack(pdf["v"].to_numpy()).astype(np.int64)
            pages = [{"page": 0, "parent": -1, "leaf": True, "pivot": b"", "norm": 0.0, "radius": 0.0, "parent_dist": 0.0,
                      "ids": pdf["id"].to_numpy(np.int64).tobytes(), "vecs": whole.tobytes(), "dists": b""}]
        else:
            pages = _build(pdf["id"].to_numpy(np.int64), x, top)
        return pd.DataFrame(pages).assign(dim=dim, b=b)

    data = src.select("id", "v", "dim", deal(blocks).alias("b"))
    pages = cut(data.groupBy("dim", "b").applyInPandas(build, _PAGES))
    pages = pages.withColumn("c", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(asks - 1).cast("long"))))
    queries = src.where("ask").select("id", "key", "v", "dim", deal(asks).alias("c")).withColumn(
        "b", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))

    def cell(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out: list[tuple] = []
        if len(left) and len(right):
            dim = int(right["dim"].iloc[0])
            exact = top < _EXACT
            if exact:
                tree = _Tree(left, dim)
            else:
                ids = np.frombuffer(left["ids"].iloc[0], np.int64)
                whole = np.frombuffer(left["vecs"].iloc[0], np.int64).reshape(-1, dim).astype(object)
            if exact:
                own, keys = right["id"].to_numpy(np.int64), right["key"].to_numpy(np.int64)
                i, s, found = tree.search(np.stack(right["v"].to_numpy()).astype(np.float64), own, k, top)
                order = np.lexsort((found, -s, i))
                i, s, found = i[order], s[order], found[order]
                first = np.searchsorted(i, i)  # where the rows of the same query begin
                top_rows = np.arange(len(i)) - first < k
                return pd.DataFrame({"query_id": own[i], "key": keys[i], "score": s.astype(np.int64), "vec_id": found})[top_rows]
            for own, key, v in zip(right["id"], right["key"], right["v"]):
                got = sorted((-max(-1 << 63, min(int(s), (1 << 63) - 1)), int(i)) for s, i in zip(whole @ np.asarray(v).astype(object), ids) if i != own)[:k]
                out += [(own, key, -s, i) for s, i in got]
        return pd.DataFrame(out, columns=["query_id", "key", "score", "vec_id"])

    lists = (pages.groupBy("dim", "b", "c").cogroup(queries.groupBy("dim", "b", "c"))
             .applyInPandas(cell, "query_id long, key long, score long, vec_id long"))
    w = Window.partitionBy("query_id", "key").orderBy(F.desc("score"), "vec_id")  # k rows per block of rows
    return (lists.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
