"""Exact quantiles without a single-task value map.

Spark's exact ``percentile`` keeps a value -> count map per group and merges it in
one task: memory grows with the number of distinct values, which is unbounded on a
large table.  Here exact order statistics are found by distributed selection:

1. one pass: ``count``, ``min``, ``max`` and a ``percentile_approx`` grid of G+1
   points per (group, column) - partial aggregation, a sketch per task;
2. for every wanted rank r a bracket [lo, hi] is read off the grid, and one pass
   of conditional counts (``count_if``) proves where rank r lies:
   at lo, at hi, or strictly inside (lo, hi);
3. when the open bracket is provably small, the same pass collects its values
   (bounded list) and the rank is picked from them; otherwise the bracket becomes
   the new domain and steps 1-2 repeat inside it (each round shrinks it by ~G/6).

A hot value holding a third of the rows ends as a bracket end point and is
resolved by counts alone, so skew never lands in one list.  Interpolation follows
``quantile_cont``: ``lo + (hi - lo) * (h - floor(h))`` with ``h = (n - 1) * p``.
Only bounded scalars reach the driver: counts, grid points and bracket values.
"""

from __future__ import annotations

import math
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

GRID = 100           # grid intervals of the first sketch read-out
FINE_GRID = 1000     # grid of refinement rounds over large domains
ACCURACY = 10000     # percentile_approx accuracy (rank error <= n / ACCURACY)
SMALL = 50000        # largest bracket whose values may be collected into one list
MAX_GROUPS = 10000   # grouped quantiles are for report-sized group counts
GROUP_CELLS = 64     # up to this many (group, column) cells, grouped passes may code each row once ...
GROUP_FANOUT = 24    # ... which pays off over the single joined pass when a cell has more targets
HINT = 4             # sketch points read at +-HINT/accuracy around each wanted quantile


@dataclass
class _Target:
    group: tuple
    col: str
    rank: int                 # 0-based rank among the non-null values of the group
    lo_dom: float | None = None   # open domain (lo_dom, hi_dom); None = unbounded
    hi_dom: float | None = None
    base: int = 0             # number of values <= lo_dom
    margin: int = 1
    grid: list | None = None  # approx grid of the current domain: (probability, value) pairs
    dom_n: int = 0
    dom_min: float | None = None
    dom_max: float | None = None
    value: float | None = None
    done: bool = False
    bracket: tuple | None = field(default=None)


def _dom_cond(c: Column, t: _Target) -> Column:
    cond = F.lit(True)
    if t.lo_dom is not None:
        cond = cond & (c > F.lit(t.lo_dom))
    if t.hi_dom is not None:
        cond = cond & (c < F.lit(t.hi_dom))
    return cond


def _grouped(df: DataFrame, by: list[str]):
    return df.groupBy(*by) if by else df.groupBy()


def _key(row, by) -> tuple:
    return tuple(row[b] for b in by)


def exact_quantiles(df: DataFrame, cols: list[str], probs: list[float] | dict, by: list[str] | None = None,
                    grid: int = GRID, accuracy: int = ACCURACY, small: int = SMALL) -> dict:
    """Exact ``quantile_cont`` of each column (nulls ignored), per group of ``by``.

    ``probs`` is one list for every column, or ``{col: list}`` so that different statistics
    of different columns share the same passes.
    Returns ``{(group_tuple, col, p): value or None}``; group_tuple is ``()`` without ``by``.
    """
    plan: dict[tuple, tuple] = {}  # (group, col, p) -> (rank_lo, rank_hi, frac) or None
    per_col = probs if isinstance(probs, dict) else {c: probs for c in cols}

    def ranks(g, c, n):
        out = []
        for p in per_col[c]:
            if not n:
                plan[(g, c, p)] = None
                continue
            h = (n - 1) * p
            r_lo, r_hi = int(math.floor(h)), int(math.ceil(h))
            plan[(g, c, p)] = (r_lo, r_hi, h - math.floor(h))
            out += [r_lo, r_hi]
        return out

    values = order_statistics(df, cols, ranks, by, grid, accuracy, small, hints=per_col)
    out = {}
    for (g, c, p), pl in plan.items():
        if pl is None:
            out[(g, c, p)] = None
            continue
        r_lo, r_hi, frac = pl
        lo_v, hi_v = values[(g, c, r_lo)], values[(g, c, r_hi)]
        out[(g, c, p)] = lo_v + (hi_v - lo_v) * frac
    return out


def order_statistics(df: DataFrame, cols: list[str], ranks, by: list[str] | None = None,
                     grid: int = GRID, accuracy: int = ACCURACY, small: int = SMALL,
                     hints: dict | None = None) -> dict:
    """Exact r-th smallest non-null value (0-based) for the ranks ``ranks(group, col, n)`` asks for.

    ``hints`` ({col: probabilities}) names the quantiles that will be asked for: the first
    sketch then also reads points ``HINT / accuracy`` on either side of each, so a wanted
    rank starts in a bracket of about ``2 * HINT / accuracy`` of the rows instead of two
    grid intervals, and the pick pass shuffles only those few rows.
    Returns ``{(group_tuple, col, r): value}``.
    """
    by = list(by or [])
    dcols = {c: F.col(c).cast("double") for c in cols}

    def probs_for(c):
        ps = {i / grid for i in range(grid + 1)}
        for p in (hints or {}).get(c, ()):
            ps.update(q for q in (p - HINT / accuracy, p + HINT / accuracy) if 0 < q < 1)
        return sorted(ps)
    cprobs = {c: probs_for(c) for c in cols}

    # pass 1: sizes, extremes and the approximate grid of every (group, column)
    aggs = []
    for i, c in enumerate(cols):
        x = dcols[c]
        aggs += [F.count(x).alias(f"n{i}"), F.min(x).alias(f"mn{i}"), F.max(x).alias(f"mx{i}"),
                 F.percentile_approx(x, cprobs[c], accuracy).alias(f"g{i}")]
    stats = _grouped(df, by).agg(*aggs).limit(MAX_GROUPS + 1).collect()
    if len(stats) > MAX_GROUPS:
        raise ValueError(f"exact quantiles: more than {MAX_GROUPS} groups; use approximate quantiles")

    targets: dict[tuple, _Target] = {}
    for row in stats:
        g = _key(row, by)
        for i, c in enumerate(cols):
            n = row[f"n{i}"]
            for r in ranks(g, c, n):
                if (g, c, r) in targets or not (0 <= r < (n or 0)):
                    continue
                t = _Target(g, c, r, grid=list(zip(cprobs[c], row[f"g{i}"])), dom_n=n,
                            dom_min=row[f"mn{i}"], dom_max=row[f"mx{i}"])
                if r == 0:
                    t.value, t.done = t.dom_min, True
                elif r == n - 1:
                    t.value, t.done = t.dom_max, True
                targets[(g, c, r)] = t

    if not by:
        passes = _BucketPasses(df, cols, dcols)
    elif len(stats) * len(cols) <= GROUP_CELLS and len(targets) > GROUP_FANOUT * len(stats) * len(cols):
        passes = _GroupBucketPasses(df, cols, by)
    else:
        passes = _JoinedPasses(df, cols, by)
    for _ in range(30):
        pending = [t for t in targets.values() if not t.done]
        if not pending:
            break
        # choose brackets from each target's grid
        # a sketch point at probability p has a true rank within p*n -+ n/accuracy, so points at
        # least 2*margin/accuracy below / above the wanted position bound it (a miss widens)
        for t in pending:
            pr = (t.rank - t.base) / max(t.dom_n - 1, 1)
            d = 2 * t.margin / accuracy
            lows = [(p, v) for p, v in t.grid if 0 < p <= pr - d]
            highs = [(p, v) for p, v in t.grid if pr + d <= p < 1]
            lo_p, lo = lows[-1] if lows else (0.0, t.dom_min)
            hi_p, hi = highs[0] if highs else (1.0, t.dom_max)
            span = (hi_p - lo_p) * t.dom_n + 2 * t.dom_n / accuracy + 2
            t.bracket = (lo, hi, span <= small)
        # pass 2: where does each rank lie relative to its bracket?
        refine = []
        for t, (c1, c2, c3, c4, vals) in zip(pending, passes.counts(pending)):
            lo, hi, collect = t.bracket
            rr = t.rank - t.base
            if c1 <= rr < c2:
                t.value, t.done = lo, True
            elif c3 <= rr < c4:
                t.value, t.done = hi, True
            elif c2 <= rr < c3:
                if collect:
                    t.value, t.done = vals[rr - c2], True
                else:
                    t.lo_dom, t.hi_dom, t.base, t.margin, t.dom_n = lo, hi, t.base + c2, 1, c3 - c2
                    refine.append(t)
            else:  # bracket missed the rank (sketch error): widen and retry
                t.margin *= 4
        if refine:
            # pass 1 again, inside each new domain
            g = grid if max(t.dom_n for t in refine) <= 20 * small else FINE_GRID
            for t, (n, mn, mx, gr) in zip(refine, passes.sketch(refine, g, accuracy)):
                t.dom_n, t.dom_min, t.dom_max = n, mn, mx
                t.grid = list(zip([i / g for i in range(g + 1)], gr))
    else:
        raise RuntimeError("order_statistics did not converge")
    return {k: t.value for k, t in targets.items()}


class _WidePasses:
    """Ungrouped: one aggregation with a few literal-bounded expressions per target.

    A *cell* is what one target ranks inside: a column (ungrouped) or a (group, column)
    pair (grouped); ``_value``/``_scope`` give its value expression and row filter."""

    def __init__(self, df, cols, dcols):
        self.df, self.dcols = df, dcols

    def _cell(self, t):
        return t.col

    def _value(self, cell):
        return self.dcols[cell]

    def _scope(self, cell):
        return F.lit(True)

    def counts(self, pending):
        aggs = []
        for j, t in enumerate(pending):
            x = self._value(self._cell(t))
            d = self._scope(self._cell(t)) & _dom_cond(x, t)
            lo, hi, collect = t.bracket
            aggs += [F.count_if(d & (x < F.lit(lo))).alias(f"a{j}"), F.count_if(d & (x <= F.lit(lo))).alias(f"b{j}"),
                     F.count_if(d & (x < F.lit(hi))).alias(f"c{j}"), F.count_if(d & (x <= F.lit(hi))).alias(f"e{j}")]
            if collect:
                aggs.append(F.sort_array(F.collect_list(F.when(d & (x > F.lit(lo)) & (x < F.lit(hi)), x))).alias(f"v{j}"))
        r = self.df.agg(*aggs).first()
        return [(r[f"a{j}"], r[f"b{j}"], r[f"c{j}"], r[f"e{j}"], r[f"v{j}"] if t.bracket[2] else None)
                for j, t in enumerate(pending)]

    def sketch(self, refine, g, accuracy):
        aggs = []
        for j, t in enumerate(refine):
            cell = self._cell(t)
            x = self._value(cell)
            inner = F.when(self._scope(cell) & _dom_cond(x, t), x)
            aggs += [F.count(inner).alias(f"n{j}"), F.min(inner).alias(f"mn{j}"), F.max(inner).alias(f"mx{j}"),
                     F.percentile_approx(inner, [i / g for i in range(g + 1)], accuracy).alias(f"g{j}")]
        r = self.df.agg(*aggs).first()
        return [(r[f"n{j}"], r[f"mn{j}"], r[f"mx{j}"], r[f"g{j}"]) for j in range(len(refine))]


def _search_code(x, b: list, i: int, j: int):
    """Binary search as nested CASE: x known to lie above b[i-1] and below b[j]."""
    if i == j:
        return F.lit(2 * i)
    m = (i + j) // 2
    return (F.when(x < F.lit(b[m]), _search_code(x, b, i, m)).when(x == F.lit(b[m]), F.lit(2 * m + 1))
            .otherwise(_search_code(x, b, m + 1, j)))


class _BucketPasses(_WidePasses):
    """Ungrouped count pass in one narrow aggregation.

    All bracket and domain boundaries of a cell, sorted b_0 < b_1 < ..., give every
    value a code: 2k for values between b_(k-1) and b_k, 2k+1 for values equal to b_k,
    computed per cell on the row by a binary-search CASE (log2 of the boundary count
    comparisons).  ``groupBy(cell, code)`` counts (a few rows per cell) answer every
    "how many below / at" question by prefix sums.  Wanted ranks inside provably small
    brackets are then picked by ``row_number`` over only the rows inside those brackets,
    and only the picked values come back."""

    def _codes(self, cells, bounds) -> DataFrame:
        """(__var, __code) per row and cell; __var is the cell's index in ``cells``."""
        names = [f"__c{j}" for j in range(len(cells))]
        wide = self.df.select(*[_search_code(self._value(c), bounds[c], 0, len(bounds[c])).alias(n)
                                for c, n in zip(cells, names)])
        long = wide.unpivot([], names, "__name", "__code").where(F.col("__code").isNotNull())
        return long.select(F.substring("__name", 4, 9).cast("int").alias("__var"), "__code")

    def counts(self, pending):
        bounds: dict = {}
        for t in pending:
            vals = [t.bracket[0], t.bracket[1]] + [v for v in (t.lo_dom, t.hi_dom) if v is not None]
            bounds.setdefault(self._cell(t), set()).update(float(v) for v in vals)
        bounds = {c: sorted(b) for c, b in bounds.items()}
        index = {c: {v: k for k, v in enumerate(b)} for c, b in bounds.items()}
        cells_list = list(bounds)
        codes = self._codes(cells_list, bounds)
        cells = {(cells_list[r["__var"]], r["__code"]): r["n"]
                 for r in codes.groupBy("__var", "__code").agg(F.count(F.lit(1)).alias("n")).collect()}

        def below(c, v, strict):  # values < v (strict) or <= v
            k = index[c][float(v)]
            top = 2 * k if strict else 2 * k + 1
            return sum(n for (cc, code_), n in cells.items() if cc == c and code_ <= top)

        out, wanted = [], {}
        for t in pending:
            lo, hi, collect = t.bracket
            cell = self._cell(t)
            base = below(cell, t.lo_dom, False) if t.lo_dom is not None else 0
            c1, c2 = below(cell, lo, True) - base, below(cell, lo, False) - base
            c3, c4 = below(cell, hi, True) - base, below(cell, hi, False) - base
            rr = t.rank - t.base
            key = None
            if collect and c2 <= rr < c3:
                key = (cell, float(lo), float(hi))
                wanted.setdefault(key, set()).add(rr - c2 + 1)
            out.append((c1, c2, c3, c4, key))
        picked = {}
        if wanted:
            # rows strictly inside each small bracket, ranked within the bracket (bounded partitions)
            # one scan: every row is exploded into the (few) wanted brackets it lies strictly inside
            memb = []
            for j, (c, lo, hi) in enumerate(wanted):
                x = self._value(c)
                memb.append(F.when(self._scope(c) & (x > lo) & (x < hi),
                                   F.struct(F.lit(j).alias("__b"), x.alias("__x"))))
            inside = (self.df.select(F.explode(F.filter(F.array(*memb), lambda e: e.isNotNull())).alias("__e"))
                      .select("__e.__b", "__e.__x"))
            ranked = inside.withColumn("__pos", F.row_number().over(Window.partitionBy("__b").orderBy("__x")))
            keep = F.lit(False)
            keys = list(wanted)
            for j, k_ in enumerate(keys):
                keep = keep | ((F.col("__b") == j) & F.col("__pos").isin(*sorted(wanted[k_])))
            for r in ranked.where(keep).collect():
                picked[(keys[r["__b"]], r["__pos"])] = r["__x"]
        res = []
        for t, (c1, c2, c3, c4, key) in zip(pending, out):
            vals = None
            if key is not None:  # present the picked value where the generic loop reads it
                pos = t.rank - t.base - c2 + 1
                vals = [None] * (pos - 1) + [picked[(key, pos)]]
            res.append((c1, c2, c3, c4, vals))
        return res


class _GroupBucketPasses(_BucketPasses):
    """Grouped, for few (group, column) cells (box plots per tier, deciles per channel,
    split thresholds per class): the table is unpivoted once to (keys, column, value) and
    each row gets the code of its own cell from one CASE over the cells, so every row is
    counted once however many targets its group has; counts, picks and refinements are
    those of the ungrouped passes."""

    def __init__(self, df, cols, by):
        self.by = by
        long = df.select(*[F.col(b).alias(f"__k{i}") for i, b in enumerate(by)],
                         *[F.col(c).cast("double").alias(c) for c in cols])
        self.df = long.unpivot([f"__k{i}" for i in range(len(by))], cols, "__var", "__x").where(
            F.col("__x").isNotNull())

    def _cell(self, t):
        return (t.group, t.col)

    def _value(self, cell):
        return F.col("__x")

    def _scope(self, cell):
        g, c = cell
        cond = F.col("__var") == F.lit(c)
        for i, v in enumerate(g):
            cond = cond & F.col(f"__k{i}").eqNullSafe(F.lit(v))
        return cond

    def _codes(self, cells, bounds) -> DataFrame:
        cid = code = None
        for j, cell in enumerate(cells):
            cond = self._scope(cell)
            cc = _search_code(F.col("__x"), bounds[cell], 0, len(bounds[cell]))
            cid = F.when(cond, F.lit(j)) if cid is None else cid.when(cond, F.lit(j))
            code = F.when(cond, cc) if code is None else code.when(cond, cc)
        return self.df.select(cid.alias("__var"), code.alias("__code")).where(F.col("__var").isNotNull())


class _JoinedPasses:
    """Grouped: each value row meets only its own group's targets through a broadcast join
    of the target table (bounded by MAX_GROUPS x columns x ranks), then one aggregation
    per target id - work per row stays constant however many groups there are."""

    def __init__(self, df, cols, by):
        self.spark = df.sparkSession
        self.by = by
        self.types = {f.name: f.dataType.simpleString() for f in df.schema.fields}
        long = df.select(*[F.col(b).alias(f"__k{i}") for i, b in enumerate(by)],
                         *[F.col(c).cast("double").alias(c) for c in cols])
        self.long = long.unpivot([f"__k{i}" for i in range(len(by))], cols, "__var", "__x").where(
            F.col("__x").isNotNull())

    def _join(self, pending, extra_schema, extra):
        schema = ", ".join([f"__g{i} {self.types[b]}" for i, b in enumerate(self.by)]
                           + ["__v string", "__tid int", "__dlo double", "__dhi double", *extra_schema])
        rows = [(*t.group, t.col, j, t.lo_dom, t.hi_dom, *extra(t)) for j, t in enumerate(pending)]
        tdf = self.spark.createDataFrame(rows, schema)
        cond = [self.long[f"__k{i}"].eqNullSafe(tdf[f"__g{i}"]) for i in range(len(self.by))]
        cond.append(self.long["__var"] == tdf["__v"])
        j = self.long.join(F.broadcast(tdf), cond)
        x = F.col("__x")
        d = (F.col("__dlo").isNull() | (x > F.col("__dlo"))) & (F.col("__dhi").isNull() | (x < F.col("__dhi")))
        return j, x, d

    def counts(self, pending):
        j, x, d = self._join(pending, ["__lo double", "__hi double", "__col boolean"],
                             lambda t: (float(t.bracket[0]), float(t.bracket[1]), bool(t.bracket[2])))
        lo, hi = F.col("__lo"), F.col("__hi")
        agg = j.groupBy("__tid").agg(
            F.count_if(d & (x < lo)).alias("a"), F.count_if(d & (x <= lo)).alias("b"),
            F.count_if(d & (x < hi)).alias("c"), F.count_if(d & (x <= hi)).alias("e"),
            F.sort_array(F.collect_list(F.when(F.col("__col") & d & (x > lo) & (x < hi), x))).alias("v"))
        res = {r["__tid"]: r for r in agg.collect()}
        out = []
        for i, t in enumerate(pending):
            r = res.get(i)
            out.append((r["a"], r["b"], r["c"], r["e"], r["v"]) if r else (0, 0, 0, 0, []))
        return out

    def sketch(self, refine, g, accuracy):
        j, x, d = self._join(refine, [], lambda t: ())
        inner = F.when(d, x)
        agg = j.groupBy("__tid").agg(F.count(inner).alias("n"), F.min(inner).alias("mn"), F.max(inner).alias("mx"),
                                     F.percentile_approx(inner, [i / g for i in range(g + 1)], accuracy).alias("g"))
        res = {r["__tid"]: r for r in agg.collect()}
        return [(res[i]["n"], res[i]["mn"], res[i]["mx"], res[i]["g"]) for i in range(len(refine))]


def approx_quantiles(df: DataFrame, cols: list[str], probs: list[float], by: list[str] | None = None,
                     accuracy: int = ACCURACY) -> dict:
    """One-pass approximate quantiles (``percentile_approx``), same result shape."""
    by = list(by or [])
    aggs = [F.percentile_approx(F.col(c).cast("double"), list(probs), accuracy).alias(f"q{i}")
            for i, c in enumerate(cols)]
    out = {}
    for row in _grouped(df, by).agg(*aggs).collect():
        g = _key(row, by)
        for i, c in enumerate(cols):
            vals = row[f"q{i}"]
            for p, v in zip(probs, vals or [None] * len(probs)):
                out[(g, c, p)] = v
    return out


def quantiles(df: DataFrame, cols: list[str], probs: list[float], by: list[str] | None = None,
              method: str = "exact", **kw) -> dict:
    """Exact (default) or approximate quantiles, ``{(group, col, p): value}``.

    Exact results are remembered on the DataFrame object per (group keys, column, p), so reports
    over the same persisted table (describe, outliers, box plots) compute each statistic once;
    a table read anew is a new object and starts without any."""
    if method == "exact" and not kw:
        known = df.__dict__.setdefault("_mixcast_quantiles", {})
        base = tuple(by or [])
        missing = [c for c in cols if any((base, c, p) not in known for p in probs)]
        if missing:
            got = exact_quantiles(df, missing, probs, by)
            per: dict = {}
            for (g, c, p), v in got.items():
                per.setdefault((base, c, p), {})[g] = v
            known.update(per)
        return {(g, c, p): v for c in cols for p in probs for g, v in known[(base, c, p)].items()}
    if method == "exact":
        return exact_quantiles(df, cols, probs, by, **kw)
    if method == "approx":
        return approx_quantiles(df, cols, probs, by, **{k: v for k, v in kw.items() if k == "accuracy"})
    raise ValueError(f"unknown quantile method {method!r}")
