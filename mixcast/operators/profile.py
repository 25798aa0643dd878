"""Profiling reports over the campaign table.

Each report is one or two distributed passes: all statistics of all columns go into
a single aggregation, wide results are turned long with ``unpivot`` (an Expand, no
shuffle), and quantiles come from the exact distributed selection of
``functions.quantiles``.  Reports are report-sized; their inputs are not.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.exprs import safe_div, rnd
from ..functions.quantiles import quantiles
from ..schema import CATEGORY, CHANNELS, KEY, TARGET_REG

NUMERIC_REPORT_COLUMNS = ["TV", "Radio", "Social_Media", "Sales", "Total_Budget", "ROI",
                          "TV_Share", "Radio_Share", "Social_Share"]
DASHBOARD_CORR_COLUMNS = ["TV", "Radio", "Social_Media", "Total_Budget", "Sales", "ROI"]
COLLINEAR_COLUMNS = ["TV", "Radio", "Social_Media", "Total_Budget", "Sales"]


def _long(df: DataFrame, cols: list[str], ids: list[str] | None = None, value: str = "value") -> DataFrame:
    ids = ids or []
    return df.select(*ids, *[F.col(c).cast("double").alias(c) for c in cols]).unpivot(
        ids, cols, "variable", value)


# ---------------------------------------------------------------- shape / nulls

def null_counts(df: DataFrame, only_missing: bool = True) -> DataFrame:
    """Missing values per column in one aggregation; by default only columns with some."""
    cols = [c for c in df.columns if c != KEY]
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in cols])
    out = wide.unpivot([], cols, "variable", "n_missing")
    return out.where(F.col("n_missing") > 0) if only_missing else out


def table_info(df: DataFrame) -> DataFrame:
    """Type and non-null count of every column, and the row count."""
    types = dict(df.dtypes)
    wide = df.agg(F.count(F.lit(1)).alias("__n"), *[F.count(F.col(c)).alias(c) for c in df.columns])
    long = wide.unpivot(["__n"], list(df.columns), "variable", "non_null")
    dtype = F.lit(None).cast("string")
    for c, t in types.items():
        dtype = F.when(F.col("variable") == c, t).otherwise(dtype)
    return long.select("variable", dtype.alias("dtype"), "non_null", F.col("__n").alias("n_rows"))


def first_rows(df: DataFrame, n: int = 5) -> DataFrame:
    """The ``n`` rows of smallest key (a top-k)."""
    return df.orderBy(KEY).limit(n)


# ---------------------------------------------------------------- descriptive

def describe(df: DataFrame, cols: list[str] | None = None, digits: int = 3, method: str = "exact") -> DataFrame:
    """A1: count, mean, sample std, min, quartiles, max per column, rounded (half-even)."""
    cols = cols or [c for c in NUMERIC_REPORT_COLUMNS if c in df.columns]
    q = quantiles(df, cols, [0.25, 0.5, 0.75], method=method)
    wide = df.agg(*[e for c in cols for e in (
        F.count(c).alias(f"{c}__count"), F.avg(c).alias(f"{c}__mean"), F.stddev_samp(c).alias(f"{c}__std"),
        F.min(c).cast("double").alias(f"{c}__min"), F.max(c).cast("double").alias(f"{c}__max"))])
    rows = [F.struct(F.lit(c).alias("variable"), F.col(f"{c}__count").alias("count"),
                     F.col(f"{c}__mean").alias("mean"), F.col(f"{c}__std").alias("std"),
                     F.col(f"{c}__min").alias("min"),
                     F.lit(q[((), c, 0.25)]).cast("double").alias("q25"),
                     F.lit(q[((), c, 0.5)]).cast("double").alias("q50"),
                     F.lit(q[((), c, 0.75)]).cast("double").alias("q75"),
                     F.col(f"{c}__max").alias("max")) for c in cols]
    out = wide.select(F.explode(F.array(*rows)).alias("r")).select("r.*")
    return out.select("variable", "count", *[rnd(c, digits).alias(c) for c in
                                              ["mean", "std", "min", "q25", "q50", "q75", "max"]])


def value_counts(df: DataFrame, col: str) -> DataFrame:
    """A2: counts per value, descending, nulls left out (ties by value)."""
    return (df.where(F.col(col).isNotNull()).groupBy(col).agg(F.count(F.lit(1)).alias("n"))
            .orderBy(F.desc("n"), F.asc(col)))


def class_balance(df: DataFrame, col: str = "Performance") -> DataFrame:
    """A3: smallest over largest class count."""
    vc = value_counts(df, col)
    return vc.agg(F.min("n").alias("n_min"), F.max("n").alias("n_max")).withColumn(
        "balance", rnd(F.col("n_min") / F.col("n_max"), 4))


def kpi_overview(df: DataFrame) -> DataFrame:
    """A4: campaigns, mean sales, mean total budget, mean and max ROI (nulls ignored)."""
    return df.agg(F.count(F.lit(1)).alias("n_campaigns"),
                  rnd(F.avg("Sales"), 6).alias("mean_sales"),
                  rnd(F.avg("Total_Budget"), 6).alias("mean_total_budget"),
                  rnd(F.avg("ROI"), 6).alias("mean_roi"),
                  rnd(F.max("ROI"), 6).alias("max_roi"))


def channel_mean_budget(df: DataFrame) -> DataFrame:
    """A5: mean budget per channel."""
    return (df.agg(*[F.avg(c).alias(c) for c in CHANNELS]).unpivot([], CHANNELS, "channel", "mean_budget")
            .select("channel", rnd("mean_budget", 6).alias("mean_budget")))


def sales_by_influencer(df: DataFrame, digits: int = 1) -> DataFrame:
    """Mean sales per influencer tier, rounded."""
    return df.groupBy(CATEGORY).agg(rnd(F.avg(TARGET_REG), digits).alias("mean_sales"),
                                    F.count(F.lit(1)).alias("n_campaigns"))


# ---------------------------------------------------------------- outliers / constants

def iqr_outliers(df: DataFrame, cols: list[str] | None = None, k: float = 1.5, method: str = "exact") -> DataFrame:
    """Tukey fences; count strictly outside; percent of all rows (round 1)."""
    cols = cols or CHANNELS + [TARGET_REG]
    q = quantiles(df, cols, [0.25, 0.75], method=method)
    aggs = [F.count(F.lit(1)).alias("__n")]
    rows = []
    for c in cols:
        q1, q3 = q[((), c, 0.25)], q[((), c, 0.75)]
        iqr = q3 - q1
        lo, hi = q1 - k * iqr, q3 + k * iqr
        aggs.append(F.count_if((F.col(c) < F.lit(lo)) | (F.col(c) > F.lit(hi))).alias(c))
        rows.append((c, q1, q3, iqr, lo, hi))
    wide = df.agg(*aggs)
    structs = [F.struct(F.lit(c).alias("variable"), *[rnd(F.lit(v), 3).alias(n) for v, n in
                        zip(vals, ["q1", "q3", "iqr", "lower", "upper"])],
                        F.col(c).alias("n_outliers"),
                        rnd(F.col(c) / F.col("__n") * 100, 1).alias("pct_outliers"))
               for c, *vals in rows]
    return wide.select(F.explode(F.array(*structs)).alias("r")).select("r.*")


def flag_outliers(df: DataFrame, cols: list[str] | None = None, k: float = 1.5, method: str = "exact") -> DataFrame:
    """A7, row form: one boolean per column, true when strictly outside the fences."""
    cols = cols or CHANNELS + [TARGET_REG]
    q = quantiles(df, cols, [0.25, 0.75], method=method)
    out = df
    for c in cols:
        q1, q3 = q[((), c, 0.25)], q[((), c, 0.75)]
        iqr = q3 - q1
        out = out.withColumn(f"{c}_outlier", (F.col(c) < q1 - k * iqr) | (F.col(c) > q3 + k * iqr))
    return out


# The summary of frequent items: counters asked for, the map they need (a power of two of at least 4/3 as many), and the
# published error of such a summary, 3.5 / map of the values it saw (rounded up).
TRACKED = 1000
_MAP = 2048
SUMMARY_ERROR = 4 / _MAP
LISTED = 8     # candidates read back per column
COUNTED = 1_000_000  # rows of a task that counts all values, about
_SPREAD = 64   # the summaries of all partitions meet in two steps, so that none of the tasks reads them all


def frequent_values(df: DataFrame, cols: list[str]) -> tuple[dict[str, list[tuple[float, int]]], dict[str, int]]:
    """Candidates ``(value, estimate)`` for each column's commonest value, estimates descending, and non-null counts.

    One pass with mergeable heavy-hitter summaries (Misra and Gries; Spark's ``approx_top_k_*``): every partition keeps
    ``TRACKED`` counters per column and only those are shuffled.  An estimate is never too low, and too high by at most
    ``SUMMARY_ERROR`` of the column's count; a value missing from the list is rarer than twice that error or, when the
    list is full, not more frequent than its last estimate.  Zeros of both signs are one value.
    """
    src = df.select(*[(F.col(f"`{c}`").cast("double") + F.lit(0.0)).alias(f"v{i}") for i, c in enumerate(cols)],
                    F.pmod(F.spark_partition_id(), F.lit(_SPREAD)).alias("part"))
    n = range(len(cols))
    # summaries of no rows at all cannot be merged, hence one row of nulls
    src = src.unionByName(df.sparkSession.range(1).select(*[F.lit(None).cast("double").alias(f"v{i}") for i in n],
                                                          F.lit(0).alias("part")))
    parts = src.groupBy("part").agg(
        *[F.expr(f"approx_top_k_accumulate(v{i}, {TRACKED}) FILTER (WHERE v{i} IS NOT NULL)").alias(f"s{i}") for i in n],
        *[F.count(f"v{i}").alias(f"n{i}") for i in n])
    row = parts.agg(*[F.expr(f"approx_top_k_estimate(approx_top_k_combine(s{i}), {LISTED})").alias(f"s{i}") for i in n],
                    *[F.sum(f"n{i}").alias(f"n{i}") for i in n]).first()
    return ({c: [(r["item"], r["count"]) for r in row[f"s{i}"] or []] for i, c in enumerate(cols)},
            {c: row[f"n{i}"] or 0 for i, c in enumerate(cols)})


def _possible_modes(listed: list[tuple[float, int]], total: int) -> tuple[list[float], float]:
    """The listed values that can be the commonest, and the count that a value outside the list may have."""
    if not listed:
        return [], float(total)
    error = SUMMARY_ERROR * total
    unlisted = max(2 * error, listed[-1][1] if len(listed) == LISTED else 0)
    return [v for v, n in listed if n >= listed[0][1] - error], unlisted


def quasi_constant(df: DataFrame, cols: list[str] | None = None, threshold: float = 0.95) -> DataFrame:
    """Dominant value of each numeric column and its share of non-null rows; a column without values has no row.

    The candidates of ``frequent_values`` are counted exactly in one aggregation.  A candidate that is more frequent than
    any value outside the list can be is proven dominant, and no row is shuffled for its column.  Only columns whose
    commonest value is rarer than that (0.4 % of the rows) have all their values counted, dealt by value to tasks of bounded size; the top
    is a ``max`` over (count, -value) structs, never a window over a column.  Count ties go to the smallest value.
    """
    cols = cols or [c for c in NUMERIC_REPORT_COLUMNS if c in df.columns]
    listed, totals = frequent_values(df, cols)
    asked, limits = {}, {}
    for c in cols:
        asked[c], limits[c] = _possible_modes(listed[c], totals[c])
    pairs = [(c, v) for c in cols for v in asked[c] if listed[c][0][1] > limits[c]]
    proven: dict[str, tuple[int, float]] = {}
    if pairs:
        exact = df.agg(*[F.count_if(F.col(f"`{c}`").cast("double") == F.lit(v)).alias(f"k{i}")
                         for i, (c, v) in enumerate(pairs)]).first()
        for i, (c, v) in enumerate(pairs):
            n = exact[f"k{i}"]
            if n > limits[c] and (c not in proven or (n, -v) > (proven[c][0], -proven[c][1])):
                proven[c] = (n, v)
    spark = df.sparkSession
    out = spark.createDataFrame([(c, v, n, totals[c]) for c, (n, v) in proven.items()],
                                "variable string, dominant_value double, n long, total long")
    rest = [c for c in cols if c not in proven and totals[c]]
    if rest:
        # nearly every value of these columns is rare, so counting before the shuffle would only fill the tasks' memory: the
        # rows are dealt by value first, and a task counts about COUNTED of them, whatever the table's size
        parts = max(1, -(-sum(totals[c] for c in rest) // COUNTED))
        dealt = F.pmod(F.xxhash64("variable", F.col("value") + F.lit(0.0)), F.lit(parts))
        counts = (_long(df, rest).where(F.col("value").isNotNull()).withColumn("part", dealt).repartition(parts, "part")
                  .groupBy("part", "variable", "value").agg(F.count(F.lit(1)).alias("n")))
        out = out.unionByName(counts.groupBy("variable").agg(
            F.max(F.struct(F.col("n"), (-F.col("value")).alias("neg"))).alias("top"), F.sum("n").alias("total"))
            .select("variable", (-F.col("top.neg")).alias("dominant_value"), F.col("top.n").alias("n"), "total"))
    freq = F.col("n") / F.col("total")
    return out.select("variable", "dominant_value", rnd(freq, 4).alias("frequency"),
                      (freq > threshold).alias("quasi_constant"))


def quasi_constant_columns(df: DataFrame, cols: list[str] | None = None, threshold: float = 0.95) -> DataFrame:
    """The rows of ``quasi_constant`` above ``threshold`` only; above a share of 0.4 % no column's rows are shuffled,
    as the summary lists every such value.
    """
    cols = cols or [c for c in NUMERIC_REPORT_COLUMNS if c in df.columns]
    if threshold > 2 * SUMMARY_ERROR:
        listed, totals = frequent_values(df, cols)
        cols = [c for c in cols if listed[c] and listed[c][0][1] > threshold * totals[c]]
    if not cols:
        return df.sparkSession.createDataFrame(
            [], "variable string, dominant_value double, frequency double, quasi_constant boolean")
    return quasi_constant(df, cols, threshold).where("quasi_constant")


# ---------------------------------------------------------------- correlation

def correlation_matrix(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Pearson r of every pair, pairwise-complete, all pairs in one aggregation."""
    cols = cols or DASHBOARD_CORR_COLUMNS
    pairs = [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]
    wide = df.agg(*[F.corr(a, b).alias(f"{a}__{b}") for a, b in pairs])
    structs = []
    for a in cols:
        for b in cols:
            if a == b:
                r = F.lit(1.0)
            else:
                r = F.col(f"{a}__{b}") if (a, b) in pairs else F.col(f"{b}__{a}")
            structs.append(F.struct(F.lit(a).alias("var1"), F.lit(b).alias("var2"), rnd(r, 6).alias("r")))
    return wide.select(F.explode(F.array(*structs)).alias("x")).select("x.var1", "x.var2", "x.r")


def variable_pairs(cols: list[str]) -> list[tuple[str, str]]:
    """Pairs i < j of a variable list, fixed at plan time."""
    return [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]


def collinear_pairs(df: DataFrame, cols: list[str] | None = None, threshold: float = 0.7) -> DataFrame:
    """A10: pairs with |r| > threshold, level and risk flag; typed empty result when none."""
    cols = [c for c in (cols or COLLINEAR_COLUMNS) if c in df.columns]
    pairs = variable_pairs(cols)
    wide = df.agg(*[F.corr(a, b).alias(f"{a}__{b}") for a, b in pairs])
    structs = [F.struct(F.lit(a).alias("variable_1"), F.lit(b).alias("variable_2"), F.col(f"{a}__{b}").alias("r"))
               for a, b in pairs]
    long = wide.select(F.explode(F.array(*structs)).alias("x")).select("x.*")
    strong = F.abs("r") > 0.9
    return (long.where(F.abs("r") > threshold)
            .select("variable_1", "variable_2", rnd("r", 4).alias("r"),
                    F.when(strong, "high (> 0.9)").otherwise("moderate (0.7-0.9)").alias("level"),
                    strong.alias("risk"))
            .orderBy(F.desc(F.abs("r")), "variable_1", "variable_2"))


def target_correlation(df: DataFrame, cols: list[str] | None = None, target: str = TARGET_REG) -> DataFrame:
    """R of each column with the target, descending, round 3."""
    cols = [c for c in (cols or DASHBOARD_CORR_COLUMNS) if c != target]
    wide = df.agg(*[F.corr(c, target).alias(c) for c in cols])
    return (wide.unpivot([], cols, "variable", "r").select("variable", rnd("r", 3).alias("r"))
            .orderBy(F.desc("r"), "variable"))


# ---------------------------------------------------------------- distributions

def histogram(df: DataFrame, cols: list[str], bins: int = 20) -> DataFrame:
    """Equal-width bins between min and max, last bin closed, zero-filled, nulls dropped."""
    long = _long(df, cols).where(F.col("value").isNotNull())
    rng = long.groupBy("variable").agg(F.min("value").alias("mn"), F.max("value").alias("mx"))
    nb = F.lit(bins)
    binned = (long.join(F.broadcast(rng), "variable")  # one row per column: size bounded by len(cols)
              .select("variable", F.least(F.floor(safe_div((F.col("value") - F.col("mn")) * nb,
                                                           F.col("mx") - F.col("mn"))),
                                          F.lit(bins - 1)).cast("int").alias("bin")))
    binned = binned.withColumn("bin", F.coalesce("bin", F.lit(0)))  # constant column: one bin
    counts = binned.groupBy("variable", "bin").agg(F.count(F.lit(1)).alias("n"))
    grid = rng.select("variable", "mn", "mx", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    width = (F.col("mx") - F.col("mn")) / nb
    return (grid.join(counts, ["variable", "bin"], "left")
            .select("variable", "bin", rnd(F.col("mn") + width * F.col("bin"), 6).alias("bin_lower"),
                    rnd(F.col("mn") + width * (F.col("bin") + 1), 6).alias("bin_upper"),
                    F.coalesce("n", F.lit(0)).cast("long").alias("n")))


def box_stats(df: DataFrame, col: str = TARGET_REG, by: str = CATEGORY, k: float = 1.5,
              method: str = "exact") -> DataFrame:
    """Quartiles per group, whiskers = extreme data within the fences, flier count."""
    q = quantiles(df, [col], [0.25, 0.5, 0.75], by=[by], method=method)
    groups = sorted({g for (g, _, _) in q}, key=lambda g: (g[0] is None, g[0]))
    q1 = q3 = med = F.lit(None).cast("double")
    for (g,) in groups:
        cond = F.col(by).isNull() if g is None else F.col(by) == F.lit(g)
        q1 = F.when(cond, F.lit(q[((g,), col, 0.25)])).otherwise(q1)
        med = F.when(cond, F.lit(q[((g,), col, 0.5)])).otherwise(med)
        q3 = F.when(cond, F.lit(q[((g,), col, 0.75)])).otherwise(q3)
    x = F.col(col)
    staged = df.select(by, x.alias("x"), q1.alias("q1"), med.alias("med"), q3.alias("q3"))
    lo = F.col("q1") - k * (F.col("q3") - F.col("q1"))
    hi = F.col("q3") + k * (F.col("q3") - F.col("q1"))
    inside = (F.col("x") >= lo) & (F.col("x") <= hi)
    agg = staged.where(F.col("x").isNotNull()).groupBy(by).agg(
        F.first("q1").alias("q1"), F.first("med").alias("median"), F.first("q3").alias("q3"),
        F.min(F.when(inside, F.col("x"))).alias("whisker_low"),
        F.max(F.when(inside, F.col("x"))).alias("whisker_high"),
        F.count_if(~inside).alias("n_fliers"), F.count(F.lit(1)).alias("n"))
    return agg.select(by, *[rnd(c, 6).alias(c) for c in ["q1", "median", "q3"]],
                      rnd(F.col("q3") - F.col("q1"), 6).alias("iqr"),
                      rnd("whisker_low", 6).alias("whisker_low"), rnd("whisker_high", 6).alias("whisker_high"),
                      "n_fliers", "n")


# ---------------------------------------------------------------- trends

def trend_line(df: DataFrame, channels: list[str] | None = None, target: str = TARGET_REG,
               points: int = 100) -> DataFrame:
    """Degree-1 least squares per channel and ``points`` evenly spaced fitted values."""
    channels = channels or CHANNELS
    long = _long(df, channels, [target], "x")
    fit = long.groupBy(F.col("variable").alias("channel")).agg(
        F.regr_slope(target, "x").alias("slope"), F.regr_intercept(target, "x").alias("intercept"),
        F.min("x").alias("mn"), F.max("x").alias("mx"))
    step = (F.col("mx") - F.col("mn")) / F.lit(points - 1)
    pts = fit.select("*", F.explode(F.sequence(F.lit(0), F.lit(points - 1))).alias("i"))
    x = F.col("mn") + F.col("i") * step
    return pts.select("channel", "i", rnd(x, 6).alias("x"),
                      rnd(F.col("intercept") + F.col("slope") * x, 6).alias("y_fit"),
                      rnd("slope", 6).alias("slope"), rnd("intercept", 6).alias("intercept"))


def trend_by_group(df: DataFrame, channels: list[str] | None = None, by: str = CATEGORY,
                   target: str = TARGET_REG) -> DataFrame:
    """OLS of the target on each channel per group (slope, intercept, R², n)."""
    channels = channels or CHANNELS
    long = _long(df, channels, [by, target], "x")
    return long.groupBy(by, F.col("variable").alias("channel")).agg(
        rnd(F.regr_slope(target, "x"), 6).alias("slope"),
        rnd(F.regr_intercept(target, "x"), 6).alias("intercept"),
        rnd(F.regr_r2(target, "x"), 6).alias("r2"),
        F.regr_count(target, "x").alias("n"))


# ---------------------------------------------------------------- channel ROI, saturation

def channel_roi(df: DataFrame, channels: list[str] | None = None) -> DataFrame:
    """Long table (campaign, channel, budget, channel ROI); zero budgets give no row."""
    channels = channels or CHANNELS
    long = _long(df, channels, [KEY, TARGET_REG], "budget")
    return (long.select(KEY, F.col("variable").alias("channel"), "budget",
                        safe_div(TARGET_REG, "budget").alias("roi"))
            .where(F.col("roi").isNotNull()))


def scatter_points(df: DataFrame, channels: list[str] | None = None, by: str = CATEGORY) -> DataFrame:
    """P10: all (channel budget, sales) points with their colouring class."""
    channels = channels or CHANNELS
    long = _long(df, channels, [KEY, TARGET_REG, by, "Performance"], "budget")
    return long.where(F.col("budget").isNotNull() & F.col(TARGET_REG).isNotNull()).select(
        KEY, F.col("variable").alias("channel"), "budget", TARGET_REG, by, "Performance")


def decile_edges(roi_long: DataFrame, n_bins: int = 10, method: str = "exact") -> dict:
    """Equal-frequency edges per channel with duplicates dropped (``qcut(..., duplicates='drop')``)."""
    probs = [float(p) for p in np.linspace(0, 1, n_bins + 1)]
    q = quantiles(roi_long, ["budget"], probs, by=["channel"], method=method)
    edges = {}
    for (g, _c, p), v in q.items():
        edges.setdefault(g[0], []).append((p, v))
    return {ch: sorted({v for _, v in vals if v is not None}) for ch, vals in edges.items()}


def _saturation_bins(df: DataFrame, n_bins: int = 10, method: str = "exact") -> DataFrame:
    """Unrounded (channel, bin, budget_mean, roi_mean, n) of the equal-frequency bins.

    bin = number of edges strictly below the budget (at least 1): right-closed bins with
    the first one closed on the left, as ``qcut`` builds them.  Channels with fewer than
    two distinct edges have no bins.
    """
    # the table's long form is kept with it, so that the curve and the points find the edges once
    roi_long = df.__dict__.setdefault("_mixcast_channel_roi", channel_roi(df))
    edges = decile_edges(roi_long, n_bins, method)
    edge_arr = F.lit(None).cast("array<double>")
    for ch, e in edges.items():
        if len(e) >= 2:
            edge_arr = F.when(F.col("channel") == ch, F.array(*[F.lit(float(v)) for v in e])).otherwise(edge_arr)
    b = F.greatest(F.lit(1), F.size(F.filter(F.col("edges"), lambda v: v < F.col("budget"))))
    binned = roi_long.withColumn("edges", edge_arr).where(F.col("edges").isNotNull()).withColumn("bin", b)
    return binned.groupBy("channel", "bin").agg(
        F.avg("budget").alias("budget_mean"), F.avg("roi").alias("roi_mean"), F.count(F.lit(1)).alias("n"))


def saturation_curve(df: DataFrame, n_bins: int = 10, method: str = "exact") -> DataFrame:
    """Mean budget and mean channel ROI per equal-frequency bin of each channel."""
    return _saturation_bins(df, n_bins, method).select(
        "channel", "bin", rnd("budget_mean", 6).alias("budget_mean"), rnd("roi_mean", 6).alias("roi_mean"), "n")


def saturation_points(df: DataFrame, n_bins: int = 10, drop: float = 0.85, after_peak: bool = False,
                      method: str = "exact") -> DataFrame:
    """First bin (budget order) whose mean ROI is below ``drop`` x peak; its mean budget.

    ``after_peak=True`` looks only at bins after the peak bin.  A budget of exactly 0.0
    reads as not detected, as in the reference.  Channels without two distinct edges are
    "not calculable".
    """
    curve = _saturation_bins(df, n_bins, method)
    w = Window.partitionBy("channel")  # one small partition per channel: the curve has <= n_bins rows each
    c = curve.withColumn("peak", F.max("roi_mean").over(w)).withColumn(
        "peak_bin", F.min(F.when(F.col("roi_mean") == F.col("peak"), F.col("bin"))).over(w))
    cond = F.col("roi_mean") < F.col("peak") * F.lit(drop)
    if after_peak:
        cond = cond & (F.col("bin") > F.col("peak_bin"))
    per = c.groupBy("channel").agg(F.min_by(F.when(cond, F.col("budget_mean")), F.when(cond, F.col("bin"))).alias("sat"),
                                   F.max("peak").alias("peak"))
    detected = F.col("sat").isNotNull() & (F.col("sat") != 0.0)
    found = per.select("channel", F.when(detected, rnd("sat", 1)).alias("saturation_budget"),
                       F.when(detected, "detected").otherwise("not detected").alias("status"),
                       rnd("peak", 2).alias("peak_roi"))
    chans = df.sparkSession.createDataFrame([(ch,) for ch in CHANNELS], "channel string")
    return (chans.join(found, "channel", "left")
            .select("channel", "saturation_budget",
                    F.coalesce("status", F.lit("not calculable")).alias("status"), "peak_roi"))


def top_roi(df: DataFrame, n: int = 10) -> DataFrame:
    """The n campaigns of highest ROI (missing last, ties by key); a top-k report."""
    return (df.orderBy(F.desc_nulls_last("ROI"), F.asc(KEY)).limit(n)
            .select(KEY, *[rnd(c, 6).alias(c) for c in CHANNELS], CATEGORY, rnd(TARGET_REG, 6).alias(TARGET_REG),
                    rnd("Total_Budget", 6).alias("Total_Budget"), rnd("ROI", 6).alias("ROI")))
