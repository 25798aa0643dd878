"""DuckDB SQL equivalents of the named queries (the correctness oracle).

Every statement starts from one shared CTE prefix that derives, cleans and enriches
the campaigns from ``orders`` and ``lineitem`` exactly as the Spark code does.
"""

from __future__ import annotations

import re

import numpy as np

from ..schema import CHANNELS

DECILES = [float(p) for p in np.linspace(0, 1, 11)]


def _flag_sum(flag: str) -> str:
    return f"SUM(CASE WHEN l_returnflag = '{flag}' THEN CAST(l_extendedprice AS DECIMAL(18,2)) END)"


PREFIX = f"""WITH
li AS (SELECT l_orderkey,
  {_flag_sum('A')} AS tv_d, {_flag_sum('N')} AS radio_d, {_flag_sum('R')} AS social_d,
  SUM(CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2)))
      * (1 + CAST(l_tax AS DECIMAL(4,2)))) AS sales_d
  FROM lineitem GROUP BY l_orderkey),
raw AS (SELECT o_orderkey AS campaign_id,
  CAST(tv_d AS DOUBLE) / CAST(1000 AS DOUBLE) AS TV,
  CAST(radio_d AS DOUBLE) / CAST(1000 AS DOUBLE) AS Radio,
  CAST(social_d AS DOUBLE) / CAST(1000 AS DOUBLE) AS Social_Media,
  CASE o_orderpriority WHEN '1-URGENT' THEN 'Mega' WHEN '2-HIGH' THEN 'Macro'
       WHEN '3-MEDIUM' THEN 'Micro' WHEN '5-LOW' THEN 'Nano' END AS Influencer,
  CAST(sales_d AS DOUBLE) / CAST(1000 AS DOUBLE) AS Sales
  FROM orders LEFT JOIN li ON l_orderkey = o_orderkey),
lab AS (SELECT * FROM raw WHERE Sales IS NOT NULL),
med AS (SELECT quantile_cont(TV, 0.5) AS m_tv, quantile_cont(Radio, 0.5) AS m_radio,
               quantile_cont(Social_Media, 0.5) AS m_social FROM lab),
md AS (SELECT Influencer AS m_inf FROM lab WHERE Influencer IS NOT NULL
       GROUP BY Influencer ORDER BY count(*) DESC, Influencer LIMIT 1),
clean AS (SELECT campaign_id, coalesce(TV, m_tv) AS TV, coalesce(Radio, m_radio) AS Radio,
  coalesce(Social_Media, m_social) AS Social_Media, coalesce(Influencer, m_inf) AS Influencer, Sales
  FROM lab, med, md),
terc AS (SELECT quantile_cont(Sales, {1/3!r}) AS t1, quantile_cont(Sales, {2/3!r}) AS t2 FROM clean),
camp AS (SELECT c.campaign_id, c.TV, c.Radio, c.Social_Media, c.Influencer, c.Sales,
  c.TV + c.Radio + c.Social_Media AS Total_Budget,
  c.Sales / nullif(c.TV + c.Radio + c.Social_Media, 0) AS ROI,
  c.TV / nullif(c.TV + c.Radio + c.Social_Media, 0) AS TV_Share,
  c.Radio / nullif(c.TV + c.Radio + c.Social_Media, 0) AS Radio_Share,
  c.Social_Media / nullif(c.TV + c.Radio + c.Social_Media, 0) AS Social_Share,
  CASE WHEN c.Sales <= t1 THEN 'Low' WHEN c.Sales <= t2 THEN 'Medium' ELSE 'High' END AS Performance
  FROM clean c, terc)"""


def expand_round(text: str) -> str:
    """Rewrite ``round(x, d)`` / ``round_even(x, d)`` as ``round_even(x * 10^d, 0) / 10^d``,
    the half-to-even rounding of ``functions.exprs.rnd``."""
    out, i = [], 0
    pat = re.compile(r"\b(round_even|round)\(")
    while True:
        m = pat.search(text, i)
        if not m:
            out.append(text[i:])
            return "".join(out)
        out.append(text[i:m.start()])
        depth, j, comma = 1, m.end(), None
        while depth:
            ch = text[j]
            if ch == "(":
                depth += 1
            elif ch == ")":
                depth -= 1
            elif ch == "," and depth == 1:
                comma = j
            j += 1
        inner = expand_round(text[m.end():comma])
        digits = int(text[comma + 1:j - 1].strip())
        scale = f"CAST({10 ** digits} AS DOUBLE)"
        out.append(f"(round_even(({inner}) * {scale}, 0) / {scale} + CAST(0 AS DOUBLE))")
        i = j


def sql(body: str, *ctes: str) -> str:
    extra = "".join(f",\n{c}" for c in ctes)
    return expand_round(f"{PREFIX}{extra}\n{body}")


def long_sql(table: str, cols: list[str], ids: list[str] | None = None, name: str = "variable",
             value: str = "value") -> str:
    ids = ids or []
    idl = "".join(f"{i}, " for i in ids)
    return " UNION ALL ".join(f"SELECT {idl}'{c}' AS {name}, CAST({c} AS DOUBLE) AS {value} FROM {table}"
                              for c in cols)


def r6(x: str) -> str:
    return f"round({x}, 6)"


NUMERIC_REPORT_COLUMNS = ["TV", "Radio", "Social_Media", "Sales", "Total_Budget", "ROI",
                          "TV_Share", "Radio_Share", "Social_Share"]
DASHBOARD_CORR_COLUMNS = ["TV", "Radio", "Social_Media", "Total_Budget", "Sales", "ROI"]
COLLINEAR_COLUMNS = ["TV", "Radio", "Social_Media", "Total_Budget", "Sales"]
ENRICHED = ["campaign_id", "TV", "Radio", "Social_Media", "Influencer", "Sales", "Total_Budget", "ROI",
            "TV_Share", "Radio_Share", "Social_Share", "Performance"]
DOUBLES = {"TV", "Radio", "Social_Media", "Sales", "Total_Budget", "ROI", "TV_Share", "Radio_Share", "Social_Share"}


def _sel_rounded(cols: list[str], alias: str = "") -> str:
    a = f"{alias}." if alias else ""
    return ", ".join(f"round({a}{c}, 6) AS {c}" if c in DOUBLES else f"{a}{c}" for c in cols)


def _pairs(cols):
    return [(a, b) for i, a in enumerate(cols) for b in cols[i + 1:]]


def profile_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["campaigns_raw"] = sql("SELECT * FROM raw")
    q["clean_campaigns"] = sql(f"SELECT {_sel_rounded(['campaign_id', *CHANNELS, 'Influencer', 'Sales'])} FROM clean")
    q["enriched_campaigns"] = sql(f"SELECT {_sel_rounded(ENRICHED)} FROM camp")
    q["null_counts"] = sql(
        "SELECT variable, n_missing FROM ("
        + " UNION ALL ".join(f"SELECT '{c}' AS variable, CAST(count_if({c} IS NULL) AS BIGINT) AS n_missing FROM raw"
                             for c in [*CHANNELS, "Influencer", "Sales"])
        + ") WHERE n_missing > 0")
    types = {"campaign_id": "bigint", "Influencer": "string", "Performance": "string"}
    q["first_rows"] = sql("SELECT " + ", ".join(
        f"round({c}, 6) AS {c}" if types.get(c, "double") == "double" else c for c in ENRICHED) + " FROM camp ORDER BY campaign_id LIMIT 5")
    q["table_info"] = sql(" UNION ALL ".join(
        f"SELECT '{c}' AS variable, '{types.get(c, 'double')}' AS dtype, count({c}) AS non_null, count(*) AS n_rows FROM camp"
        for c in ENRICHED))
    parts = []
    for c in NUMERIC_REPORT_COLUMNS:
        parts.append(
            f"SELECT '{c}' AS variable, count({c}) AS count, round_even(avg({c}), 3) AS mean, "
            f"round_even(stddev_samp({c}), 3) AS std, round_even(min({c}), 3) AS min, "
            f"round_even(quantile_cont({c}, 0.25), 3) AS q25, round_even(quantile_cont({c}, 0.5), 3) AS q50, "
            f"round_even(quantile_cont({c}, 0.75), 3) AS q75, round_even(max({c}), 3) AS max FROM camp")
    q["describe"] = sql(" UNION ALL ".join(parts))
    for col, key in [("Influencer", "value_counts_influencer"), ("Performance", "value_counts_performance")]:
        q[key] = sql(f"SELECT {col}, count(*) AS n FROM camp WHERE {col} IS NOT NULL GROUP BY {col}")
    q["class_balance"] = sql(
        "SELECT min(n) AS n_min, max(n) AS n_max, round_even(min(n) / max(n), 4) AS balance FROM "
        "(SELECT count(*) AS n FROM camp WHERE Performance IS NOT NULL GROUP BY Performance)")
    q["kpi_overview"] = sql(
        "SELECT count(*) AS n_campaigns, round(avg(Sales), 6) AS mean_sales, round(avg(Total_Budget), 6) "
        "AS mean_total_budget, round(avg(ROI), 6) AS mean_roi, round(max(ROI), 6) AS max_roi FROM camp")
    q["channel_mean_budget"] = sql(" UNION ALL ".join(
        f"SELECT '{c}' AS channel, round(avg({c}), 6) AS mean_budget FROM camp" for c in CHANNELS))
    q["sales_by_influencer"] = sql(
        "SELECT Influencer, round_even(avg(Sales), 1) AS mean_sales, count(*) AS n_campaigns FROM camp GROUP BY Influencer")
    iq = " UNION ALL ".join(
        f"SELECT '{c}' AS variable, quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3 FROM camp"
        for c in [*CHANNELS, "Sales"])
    q["iqr_outliers"] = sql(
        "SELECT f.variable, round_even(q1, 3) AS q1, round_even(q3, 3) AS q3, round_even(q3 - q1, 3) AS iqr, "
        "round_even(q1 - 1.5 * (q3 - q1), 3) AS lower, round_even(q3 + 1.5 * (q3 - q1), 3) AS upper, "
        "count_if(l.value < q1 - 1.5 * (q3 - q1) OR l.value > q3 + 1.5 * (q3 - q1)) AS n_outliers, "
        "round_even(count_if(l.value < q1 - 1.5 * (q3 - q1) OR l.value > q3 + 1.5 * (q3 - q1)) / count(*) * 100, 1) "
        "AS pct_outliers FROM iq f JOIN lg l USING (variable) GROUP BY f.variable, q1, q3",
        f"iq AS ({iq})", f"lg AS ({long_sql('camp', [*CHANNELS, 'Sales'])})")
    fences = ", ".join(f"quantile_cont({c}, 0.25) AS {c}_q1, quantile_cont({c}, 0.75) AS {c}_q3"
                       for c in [*CHANNELS, "Sales"])
    q["outlier_flags"] = sql(
        "SELECT campaign_id, " + ", ".join(
            f"({c} < {c}_q1 - 1.5 * ({c}_q3 - {c}_q1) OR {c} > {c}_q3 + 1.5 * ({c}_q3 - {c}_q1)) AS {c}_outlier"
            for c in [*CHANNELS, "Sales"]) + " FROM camp, fq",
        f"fq AS (SELECT {fences} FROM camp)")
    q["quasi_constant"] = sql(
        "SELECT variable, round(value, 6) AS dominant_value, round_even(n / total, 4) AS frequency, "
        "n / total > 0.95 AS quasi_constant FROM rk WHERE r = 1",
        f"lg AS ({long_sql('camp', NUMERIC_REPORT_COLUMNS)})",
        "cn AS (SELECT variable, value, count(*) AS n FROM lg WHERE value IS NOT NULL GROUP BY variable, value)",
        "rk AS (SELECT variable, value, n, sum(n) OVER (PARTITION BY variable) AS total, "
        "row_number() OVER (PARTITION BY variable ORDER BY n DESC, value ASC) AS r FROM cn)")
    q["quasi_constant_columns"] = f"SELECT * FROM ({q['quasi_constant']}) qc WHERE quasi_constant"
    cols = DASHBOARD_CORR_COLUMNS
    q["correlation_matrix"] = sql(" UNION ALL ".join(
        (f"SELECT '{a}' AS var1, '{b}' AS var2, CAST(1.0 AS DOUBLE) AS r" if a == b else
         f"SELECT '{a}' AS var1, '{b}' AS var2, round(corr({a}, {b}), 6) AS r FROM camp")
        for a in cols for b in cols))
    pr = " UNION ALL ".join(f"SELECT '{a}' AS variable_1, '{b}' AS variable_2, corr({a}, {b}) AS r FROM camp"
                            for a, b in _pairs(COLLINEAR_COLUMNS))
    q["collinear_pairs"] = sql(
        "SELECT variable_1, variable_2, round_even(r, 4) AS r, CASE WHEN abs(r) > 0.9 THEN 'high (> 0.9)' "
        "ELSE 'moderate (0.7-0.9)' END AS level, abs(r) > 0.9 AS risk FROM pr WHERE abs(r) > 0.7", f"pr AS ({pr})")
    q["target_correlation"] = sql(" UNION ALL ".join(
        f"SELECT '{c}' AS variable, round_even(corr({c}, Sales), 3) AS r FROM camp"
        for c in DASHBOARD_CORR_COLUMNS if c != "Sales"))
    hcols = [*CHANNELS, "Sales"]
    q["histogram"] = sql(
        "SELECT g.variable, g.bin, round(mn + (mx - mn) / 20 * g.bin, 6) AS bin_lower, "
        "round(mn + (mx - mn) / 20 * (g.bin + 1), 6) AS bin_upper, CAST(coalesce(c.n, 0) AS BIGINT) AS n "
        "FROM g LEFT JOIN c ON g.variable = c.variable AND g.bin = c.bin",
        f"lg AS ({long_sql('camp', hcols)})",
        "rng AS (SELECT variable, min(value) AS mn, max(value) AS mx FROM lg WHERE value IS NOT NULL GROUP BY variable)",
        "b AS (SELECT l.variable, coalesce(CAST(least(floor((value - mn) * 20 / nullif(mx - mn, 0)), 19) AS INTEGER), 0)"
        " AS bin FROM lg l JOIN rng USING (variable) WHERE value IS NOT NULL)",
        "c AS (SELECT variable, bin, count(*) AS n FROM b GROUP BY variable, bin)",
        "g AS (SELECT variable, mn, mx, CAST(unnest(range(0, 20)) AS INTEGER) AS bin FROM rng)")
    fence = "Sales >= q1 - 1.5 * (q3 - q1) AND Sales <= q3 + 1.5 * (q3 - q1)"
    q["box_stats"] = sql(
        f"SELECT q.Influencer, round(q1, 6) AS q1, round(med, 6) AS median, round(q3, 6) AS q3, "
        f"round(q3 - q1, 6) AS iqr, round(min(CASE WHEN {fence} THEN Sales END), 6) AS whisker_low, "
        f"round(max(CASE WHEN {fence} THEN Sales END), 6) AS whisker_high, count_if(NOT ({fence})) AS n_fliers, "
        f"count(*) AS n FROM camp JOIN q USING (Influencer) WHERE Sales IS NOT NULL "
        f"GROUP BY q.Influencer, q1, med, q3",
        "q AS (SELECT Influencer, quantile_cont(Sales, 0.25) AS q1, quantile_cont(Sales, 0.5) AS med, "
        "quantile_cont(Sales, 0.75) AS q3 FROM camp GROUP BY Influencer)")
    chl = long_sql("camp", CHANNELS, ["Sales"], name="channel", value="x")
    q["trend_line"] = sql(
        "SELECT channel, CAST(i AS INTEGER) AS i, round(mn + i * ((mx - mn) / 99), 6) AS x, "
        "round(intercept + slope * (mn + i * ((mx - mn) / 99)), 6) AS y_fit, round(slope, 6) AS slope, "
        "round(intercept, 6) AS intercept FROM fit, range(0, 100) t(i)",
        f"chl AS ({chl})",
        "fit AS (SELECT channel, regr_slope(Sales, x) AS slope, regr_intercept(Sales, x) AS intercept, "
        "min(x) AS mn, max(x) AS mx FROM chl GROUP BY channel)")
    chl2 = long_sql("camp", CHANNELS, ["Influencer", "Sales"], name="channel", value="x")
    q["trend_by_influencer"] = sql(
        "SELECT Influencer, channel, round(regr_slope(Sales, x), 6) AS slope, "
        "round(regr_intercept(Sales, x), 6) AS intercept, round(regr_r2(Sales, x), 6) AS r2, "
        "CAST(regr_count(Sales, x) AS BIGINT) AS n FROM chl GROUP BY Influencer, channel", f"chl AS ({chl2})")
    rl = long_sql("camp", CHANNELS, ["campaign_id", "Sales", "Influencer", "Performance"], name="channel", value="budget")
    roi_ctes = [f"rl0 AS ({rl})",
                "rl AS (SELECT campaign_id, channel, budget, Sales / nullif(budget, 0) AS roi FROM rl0 "
                "WHERE Sales / nullif(budget, 0) IS NOT NULL)"]
    q["channel_roi_long"] = sql("SELECT campaign_id, channel, round(budget, 6) AS budget, round(roi, 6) AS roi FROM rl",
                                *roi_ctes)
    q["scatter_points"] = sql(
        "SELECT campaign_id, channel, round(budget, 6) AS budget, round(Sales, 6) AS Sales, Influencer, Performance "
        "FROM rl0 WHERE budget IS NOT NULL AND Sales IS NOT NULL", roi_ctes[0])
    probs = ", ".join(f"CAST({p!r} AS DOUBLE)" for p in DECILES)
    sat_ctes = [*roi_ctes,
                f"ed AS (SELECT channel, list_sort(list_distinct(quantile_cont(budget, [{probs}]))) AS edges "
                "FROM rl GROUP BY channel)",
                "bn AS (SELECT rl.channel, greatest(1, len(list_filter(edges, lambda v: v < budget))) AS bin, budget, roi "
                "FROM rl JOIN ed USING (channel) WHERE len(edges) >= 2)",
                "cur AS (SELECT channel, CAST(bin AS INTEGER) AS bin, avg(budget) AS budget_mean, avg(roi) AS roi_mean, "
                "count(*) AS n FROM bn GROUP BY channel, bin)"]
    q["saturation_curve"] = sql(
        "SELECT channel, bin, round(budget_mean, 6) AS budget_mean, round(roi_mean, 6) AS roi_mean, n FROM cur",
        *sat_ctes)
    q["saturation_points"] = sql(
        "SELECT ch.channel, CASE WHEN sat IS NOT NULL AND sat <> 0 THEN round_even(sat, 1) END AS saturation_budget, "
        "CASE WHEN s.channel IS NULL THEN 'not calculable' WHEN sat IS NOT NULL AND sat <> 0 THEN 'detected' "
        "ELSE 'not detected' END AS status, round_even(peak, 2) AS peak_roi "
        "FROM (VALUES ('TV'), ('Radio'), ('Social_Media')) ch(channel) LEFT JOIN s ON ch.channel = s.channel",
        *sat_ctes,
        "pk AS (SELECT channel, max(roi_mean) AS peak FROM cur GROUP BY channel)",
        "s AS (SELECT c.channel, min_by(budget_mean, bin) FILTER (WHERE roi_mean < peak * 0.85) AS sat, "
        "max(peak) AS peak FROM cur c JOIN pk USING (channel) GROUP BY c.channel)")
    f23 = f"CAST({2 / 3!r} AS DOUBLE)"
    lines = []
    for i in range(4):  # the first fit and three robust passes
        weight = "1.0" if i == 0 else f"b{i}.b"
        joined = "" if i == 0 else f"JOIN b{i} USING (campaign_id, channel) "
        lines.append(
            f"f{i} AS MATERIALIZED (SELECT channel, j, CASE WHEN sw * swxx - swx * swx > 1e-9 * sw * swxx THEN "
            "(swy * swxx - swx * swxy) / (sw * swxx - swx * swx) ELSE swy / nullif(sw, 0) END AS y FROM (SELECT channel, j, "
            "sum(w * b) AS sw, sum(w * b * x) AS swx, sum(w * b * roi) AS swy, sum(w * b * x * x) AS swxx, "
            f"sum(w * b * x * roi) AS swxy FROM (SELECT ww.*, {weight} AS b FROM ww {joined}) GROUP BY channel, j))")
        if i < 3:
            lines += [
                f"e{i} AS MATERIALIZED (SELECT campaign_id, rl.channel, abs(roi - (l.y + ((budget - mn) / st - l.j) * (r.y - l.y))) AS e "
                "FROM rl JOIN rng USING (channel) "
                f"JOIN f{i} l ON l.channel = rl.channel AND l.j = least(CAST(floor((budget - mn) / st) AS INTEGER), 48) "
                f"JOIN f{i} r ON r.channel = rl.channel AND r.j = l.j + 1)",
                f"b{i + 1} AS MATERIALIZED (SELECT campaign_id, channel, CASE WHEN e < 6 * m THEN (1 - (e / (6 * m)) * (e / (6 * m))) "
                f"* (1 - (e / (6 * m)) * (e / (6 * m))) ELSE 0.0 END AS b FROM e{i} JOIN (SELECT channel, quantile_cont(e, 0.5) AS m "
                f"FROM e{i} GROUP BY channel) USING (channel))"]
    q["lowess_roi"] = sql(
        "SELECT channel, j, round(g, 6) AS x, round(y, 4) AS roi_fit, n_used, round(h, 6) AS bandwidth "
        "FROM f3 JOIN (SELECT channel, j, first(g) AS g, first(h) AS h, count_if(w > 0) AS n_used FROM ww GROUP BY channel, j) "
        "USING (channel, j)",
        *roi_ctes,
        "rng AS MATERIALIZED (SELECT channel, min(budget) AS mn, (max(budget) - min(budget)) / 49 AS st, count(*) AS n "
        "FROM rl GROUP BY channel)",
        "dd AS (SELECT campaign_id, channel, CAST(j AS INTEGER) AS j, mn + CAST(j AS INTEGER) * st AS g, n, budget, roi, "
        "abs(budget - (mn + CAST(j AS INTEGER) * st)) AS d FROM rl JOIN rng USING (channel), range(0, 50) t(j))",
        "bw AS (SELECT channel, j, d AS h FROM (SELECT channel, j, d, n, row_number() OVER (PARTITION BY channel, j "
        f"ORDER BY d) AS rk FROM dd) WHERE rk = greatest(1, CAST(floor({f23} * CAST(n AS DOUBLE) + "
        "CAST(1e-10 AS DOUBLE)) AS BIGINT)))",
        "ww AS MATERIALIZED (SELECT dd.*, h, (budget - g) / h AS x, CASE WHEN d < h THEN (1.0 - (d / h) * (d / h) * (d / h)) * "
        "(1.0 - (d / h) * (d / h) * (d / h)) * (1.0 - (d / h) * (d / h) * (d / h)) ELSE 0.0 END AS w FROM dd JOIN bw USING (channel, j))",
        *lines)
    q["top_roi"] = sql(
        f"SELECT {_sel_rounded(['campaign_id', *CHANNELS, 'Influencer', 'Sales', 'Total_Budget', 'ROI'])} "
        "FROM camp ORDER BY ROI DESC NULLS LAST, campaign_id LIMIT 10")
    return q


def _md5(seed: int = 42) -> str:
    return f"md5('{seed}-' || CAST(campaign_id AS VARCHAR))"


SPLIT_CTES = [
    f"sp AS (SELECT *, CASE WHEN substr({_md5()}, 1, 8) < '33333333' THEN 'test' ELSE 'train' END AS split, "
    f"CAST(('0x' || substr({_md5()}, 9, 8))::BIGINT % 5 AS INTEGER) AS fold FROM camp)",
    f"ss0 AS (SELECT *, ('0x' || substr({_md5()}, 1, 13))::BIGINT AS h52, "
    f"CAST(('0x' || substr({_md5()}, 9, 8))::BIGINT % 5 AS INTEGER) AS fold FROM camp)",
    "ss1 AS (SELECT *, row_number() OVER (PARTITION BY Performance ORDER BY h52, campaign_id) AS rk, "
    "count(*) OVER (PARTITION BY Performance) AS nc FROM ss0)",
    "st AS (SELECT * EXCLUDE (h52, rk, nc), CASE WHEN rk <= floor(0.2 * nc + 0.5) THEN 'test' ELSE 'train' END AS split "
    "FROM ss1)",
]
FOLD_CTES = [
    f"sf0 AS (SELECT campaign_id, Performance, row_number() OVER (PARTITION BY Performance ORDER BY "
    f"('0x' || substr({_md5()}, 14, 13))::BIGINT, campaign_id) - 1 AS r, count(*) OVER (PARTITION BY Performance) AS nc "
    "FROM st WHERE split = 'train')",
]
TREND = {"Budget Trend": "Total_Budget", "TV Trend": "TV"}
TERC = {"Budget Terciles": "Total_Budget", "TV Terciles": "TV"}


def _trend_ctes() -> list[str]:
    ctes, parts = [], []
    for i, (name, feat) in enumerate(TREND.items()):
        ctes.append(f"fr{i} AS (SELECT regr_intercept(Sales, {feat}) AS a, regr_slope(Sales, {feat}) AS b "
                    "FROM sp WHERE split = 'train')")
        parts.append(f"SELECT campaign_id, '{name}' AS model, split, Sales AS actual, a + b * {feat} AS predicted "
                     f"FROM sp, fr{i}")
    ctes.append(f"rp AS ({' UNION ALL '.join(parts)})")
    return ctes


def _terc_ctes() -> list[str]:
    ctes, parts = [], []
    for i, (name, feat) in enumerate(TERC.items()):
        ctes.append(f"fc{i} AS (SELECT regr_intercept(Sales, {feat}) AS a, regr_slope(Sales, {feat}) AS b "
                    "FROM st WHERE split = 'train')")
        parts.append(
            f"SELECT campaign_id, '{name}' AS model, split, Performance AS actual, "
            "CASE WHEN p <= t1 THEN 'Low' WHEN p <= t2 THEN 'Medium' ELSE 'High' END AS predicted, "
            "round(-p, 6) AS score_Low, round(-abs(p - (t1 + t2) / 2), 6) AS score_Medium, round(p, 6) AS score_High "
            f"FROM (SELECT st.*, a + b * {feat} AS p FROM st, fc{i}), terc")
    ctes.append(f"cp AS ({' UNION ALL '.join(parts)})")
    return ctes


def _reg_metrics(src: str, by: str = "model", d: int = 6) -> str:
    e = "(actual - predicted)"
    return (f"SELECT {by}, count(*) AS n, round(avg(abs{e}), {d}) AS mae, round(sqrt(avg({e} * {e})), {d}) AS rmse, "
            f"round(1 - sum({e} * {e}) / nullif(var_pop(actual) * count(*), 0), {d}) AS r2 FROM {src} GROUP BY {by}")


def _clf_metrics(src: str, by: str = "model", d: int = 6) -> list[str]:
    """CTEs cc_<src> .. and the final select text for weighted metrics."""
    return [
        f"cc AS (SELECT {by}, actual, predicted, count(*) AS n FROM {src} GROUP BY {by}, actual, predicted)",
        f"tc AS (SELECT {by}, actual AS label, sum(n) AS support FROM cc GROUP BY {by}, actual)",
        f"pc AS (SELECT {by}, predicted AS label, sum(n) AS n_pred FROM cc GROUP BY {by}, predicted)",
        f"tp AS (SELECT {by}, actual AS label, n AS tp FROM cc WHERE actual = predicted)",
        f"per0 AS (SELECT coalesce(tc.{by}, pc.{by}) AS {by}, coalesce(tc.label, pc.label) AS label, "
        "coalesce(support, 0) AS support, coalesce(n_pred, 0) AS n_pred FROM tc FULL JOIN pc "
        f"ON tc.{by} = pc.{by} AND tc.label = pc.label)",
        f"per1 AS (SELECT per0.*, coalesce(tp.tp, 0) AS tp FROM per0 LEFT JOIN tp USING ({by}, label))",
        "per AS (SELECT *, coalesce(CAST(tp AS DOUBLE) / nullif(CAST(n_pred AS DOUBLE), 0), 0) AS pr, "
        "coalesce(CAST(tp AS DOUBLE) / nullif(CAST(support AS DOUBLE), 0), 0) AS rc FROM per1)",
        f"wm AS (SELECT {by}, sum(support) AS n, sum(tp) AS correct, sum(pr * support) AS wp, sum(rc * support) AS wr, "
        "sum(coalesce(2 * pr * rc / nullif(pr + rc, 0), 0) * support) AS wf FROM per GROUP BY " + by + ")",
    ]


def _clf_select(by: str = "model", d: int = 6) -> str:
    return (f"SELECT {by}, CAST(n AS BIGINT) AS n, round(correct / CAST(n AS DOUBLE), {d}) AS accuracy, "
            f"round(wp / CAST(n AS DOUBLE), {d}) AS precision, round(wr / CAST(n AS DOUBLE), {d}) AS recall, "
            f"round(wf / CAST(n AS DOUBLE), {d}) AS f1 FROM wm")


def _auc_ctes(src: str) -> list[str]:
    sc = " UNION ALL ".join(f"SELECT model, actual, '{c}' AS cls, round(score_{c}, 6) AS score FROM {src}"
                            for c in ["Low", "Medium", "High"])
    return [f"sc AS ({sc})",
            "g AS (SELECT model, cls, score, count_if(actual = cls) AS pos, count_if(actual <> cls) AS neg "
            "FROM sc GROUP BY model, cls, score)",
            "w AS (SELECT *, coalesce(sum(neg) OVER (PARTITION BY model, cls ORDER BY score "
            "ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM g)",
            "pa AS (SELECT model, cls, sum(pos * (below + neg * 0.5)) AS u, sum(pos) AS p, sum(neg) AS q "
            "FROM w GROUP BY model, cls)",
            "auc AS (SELECT model, CASE WHEN min(least(p, q)) > 0 THEN sum(u / nullif(p * q, 0) * p) / sum(p) END AS auc "
            "FROM pa GROUP BY model)"]


def _cv_ctes() -> list[str]:
    ctes, parts = ["ff AS (SELECT DISTINCT fold AS f FROM sp WHERE split = 'train')"], []
    for i, (name, feat) in enumerate(TREND.items()):
        ctes.append(f"cf{i} AS (SELECT f, regr_intercept(Sales, {feat}) AS a, regr_slope(Sales, {feat}) AS b "
                    "FROM ff JOIN sp ON sp.fold <> ff.f AND sp.split = 'train' GROUP BY f)")
        parts.append(f"SELECT '{name}' AS model, fold, round(1 - sum((Sales - (a + b * {feat})) * (Sales - (a + b * {feat}))) "
                     f"/ nullif(var_pop(Sales) * count(*), 0), 6) AS score FROM sp JOIN cf{i} ON fold = f "
                     "WHERE split = 'train' GROUP BY fold")
    ctes.append(f"cvs AS ({' UNION ALL '.join(parts)})")
    return ctes


def eval_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    q["split_regression"] = sql("SELECT campaign_id, split FROM sp", *SPLIT_CTES)
    q["stratified_folds"] = sql(
        "SELECT campaign_id, Performance, CAST(" + " + ".join(f"(r >= {i} * nc // 5)::INT" for i in range(1, 5))
        + " AS INTEGER) AS fold FROM sf0", *SPLIT_CTES, *FOLD_CTES)
    q["split_stratified"] = sql("SELECT campaign_id, Performance, split FROM st", *SPLIT_CTES)
    q["cv_folds"] = sql("SELECT campaign_id, split, fold FROM sp", *SPLIT_CTES)
    q["class_weights"] = sql(
        "SELECT Performance, n, round(CAST(tot AS DOUBLE) / (CAST(k AS DOUBLE) * n), 6) AS weight FROM "
        "(SELECT Performance, count(*) AS n FROM st WHERE split = 'train' AND Performance IS NOT NULL GROUP BY Performance), "
        "(SELECT count(*) AS tot, count(DISTINCT Performance) AS k FROM st WHERE split = 'train' AND Performance IS NOT NULL)",
        *SPLIT_CTES)
    sc = ", ".join(f"round(({c} - m_{c}) / CASE WHEN s_{c} = 0 OR s_{c} IS NULL THEN 1.0 ELSE s_{c} END, 6) AS {c}_z"
                   for c in CHANNELS)
    stats = ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in CHANNELS)
    q["scaled_features"] = sql(f"SELECT campaign_id, {sc} FROM sp, (SELECT {stats} FROM sp WHERE split = 'train')",
                               *SPLIT_CTES)
    oh = ", ".join(f"CAST(coalesce(Influencer = '{c}', false) AS DOUBLE) AS Influencer_{c}" for c in ["Macro", "Micro", "Nano"])
    q["onehot_features"] = sql(f"SELECT campaign_id, Influencer, {oh} FROM camp")
    base = [*SPLIT_CTES, *_trend_ctes()]
    cbase = [*SPLIT_CTES, *_terc_ctes()]
    q["regression_metrics"] = sql(_reg_metrics("(SELECT * FROM rp WHERE split = 'test')"), *base)
    q["classification_metrics"] = sql(_clf_select(), *cbase, "tcp AS (SELECT * FROM cp WHERE split = 'test')",
                                      *_clf_metrics("tcp"))
    q["roc_auc_ovr"] = sql("SELECT model, round(auc, 6) AS roc_auc FROM auc", *cbase,
                           "tcp AS (SELECT * FROM cp WHERE split = 'test')", *_auc_ctes("tcp"))
    q["confusion_matrix"] = sql(
        "SELECT lb.model, lb.actual, lb.predicted, CAST(coalesce(n, 0) AS BIGINT) AS n FROM "
        "(SELECT a.model, a.l AS actual, b.l AS predicted FROM labs a JOIN labs b ON a.model = b.model) lb "
        "LEFT JOIN cc USING (model, actual, predicted)",
        *cbase, "tcp AS (SELECT * FROM cp WHERE split = 'test')",
        "labs AS (SELECT model, actual AS l FROM tcp UNION SELECT model, predicted FROM tcp)",
        "cc AS (SELECT model, actual, predicted, count(*) AS n FROM tcp GROUP BY model, actual, predicted)")
    q["residuals"] = sql("SELECT model, campaign_id, round(actual, 6) AS actual, round(predicted, 6) AS predicted, "
                         "round(actual - predicted, 6) AS residual FROM rp WHERE split = 'test'", *base)
    q["residual_bounds"] = sql(
        "SELECT model, round(least(min(actual), min(predicted)), 6) AS lo, round(greatest(max(actual), max(predicted)), 6) AS hi "
        "FROM rp WHERE split = 'test' GROUP BY model", *base)
    q["metric_labels"] = sql(
        "SELECT model, format('{:.4f}', r2) AS r2_text, format('{:.4f}', mae) AS mae_text, format('{:,}', n_rows) AS n_text FROM mt "
        "JOIN (SELECT model, count(*) AS n_rows FROM rp WHERE split = 'test' GROUP BY model) USING (model)",
        *base, f"mt AS ({_reg_metrics(chr(40) + 'SELECT * FROM rp WHERE split = ' + chr(39) + 'test' + chr(39) + chr(41))})")
    q["worst_predictions"] = sql(
        "SELECT c.campaign_id, round(c.TV, 6) AS TV, round(c.Radio, 6) AS Radio, round(c.Social_Media, 6) AS Social_Media, "
        "c.Influencer, w.model, sales_actual, sales_predicted, abs_error, pct_error FROM camp c JOIN "
        "(SELECT campaign_id, model, round(actual, 3) AS sales_actual, round(predicted, 3) AS sales_predicted, "
        "round(abs(actual - predicted), 3) AS abs_error, "
        "round(abs(actual - predicted) / greatest(abs(actual), 1e-6) * 100, 1) AS pct_error FROM rp "
        "WHERE split = 'test' AND model = 'Budget Trend' ORDER BY abs_error DESC, campaign_id LIMIT 5) w "
        "USING (campaign_id)", *base)
    q["misclassified"] = sql(
        "SELECT c.campaign_id, round(c.TV, 6) AS TV, round(c.Radio, 6) AS Radio, round(c.Social_Media, 6) AS Social_Media, "
        "c.Influencer, m.model, class_actual, class_predicted FROM camp c JOIN "
        "(SELECT campaign_id, model, actual AS class_actual, predicted AS class_predicted FROM cp "
        "WHERE split = 'test' AND model = 'Budget Terciles' AND actual <> predicted ORDER BY campaign_id LIMIT 5) m "
        "USING (campaign_id)", *cbase)
    q["extreme_predictions"] = sql(
        "SELECT model, 'min' AS extreme, campaign_id, round(predicted, 6) AS predicted FROM "
        "(SELECT *, row_number() OVER (PARTITION BY model ORDER BY predicted, campaign_id) AS r FROM rp "
        "WHERE split = 'test') WHERE r = 1 UNION ALL "
        "SELECT model, 'max', campaign_id, round(predicted, 6) FROM "
        "(SELECT *, row_number() OVER (PARTITION BY model ORDER BY predicted DESC, campaign_id) AS r FROM rp "
        "WHERE split = 'test') WHERE r = 1", *base)
    gap = ("SELECT tr.model, round(tr.r2, 4) AS r2_train, round(te.r2, 4) AS r2_test, "
           "round(round(tr.r2, 4) - round(te.r2, 4), 4) AS gap")
    mt = [f"mt AS ({_reg_metrics('rp', 'model, split', 12)})",
          "tr AS (SELECT * FROM mt WHERE split = 'train')", "te AS (SELECT * FROM mt WHERE split = 'test')"]
    q["train_test_gap"] = sql(
        f"SELECT *, CASE WHEN gap > 0.05 THEN 'overfitting' ELSE 'stable' END AS diagnostic FROM "
        f"({gap} FROM tr JOIN te USING (model))", *base, *mt)
    q["r2_critique"] = sql(
        "SELECT *, CASE WHEN gap < -0.01 THEN 'yes' ELSE 'no' END AS leak_suspect, "
        f"CASE WHEN gap > 0.05 THEN 'yes' ELSE 'no' END AS overfit FROM ({gap} FROM tr JOIN te USING (model))",
        *base, *mt)
    cm = [c.replace("cc AS (SELECT model, split,", "cc AS (SELECT model, split,") for c in _clf_metrics("cp", "model, split")]
    q["train_test_gap_classification"] = sql(
        "SELECT tr.model, round(tr.f1, 4) AS f1_train, round(te.f1, 4) AS f1_test, "
        "round(round(tr.f1, 4) - round(te.f1, 4), 4) AS gap, "
        "CASE WHEN round(round(tr.f1, 4) - round(te.f1, 4), 4) > 0.05 THEN 'overfitting' ELSE 'stable' END AS diagnostic "
        "FROM (SELECT * FROM m2 WHERE split = 'train') tr JOIN (SELECT * FROM m2 WHERE split = 'test') te USING (model)",
        *cbase, *_clf_metrics_split(), f"m2 AS ({_clf_select('model, split', 12)})")
    q["cv_scores"] = sql("SELECT model, fold, score FROM cvs", *base, *_cv_ctes())
    comp = ("SELECT m.model, round(mae, 4) AS mae, round(rmse, 4) AS rmse, round(r2, 4) AS r2, cv_mean, cv_std FROM m "
            "LEFT JOIN (SELECT model, round(avg(score), 4) AS cv_mean, round(stddev_pop(score), 4) AS cv_std FROM cvs "
            "GROUP BY model) c USING (model)")
    mte = f"m AS ({_reg_metrics('(SELECT * FROM rp WHERE split = ' + chr(39) + 'test' + chr(39) + ')', 'model', 12)})"
    q["model_comparison"] = sql(comp, *base, *_cv_ctes(), mte)
    q["best_model"] = sql(f"SELECT * FROM ({comp}) ORDER BY r2 DESC, "
                          "CASE model WHEN 'Budget Trend' THEN 1 WHEN 'TV Trend' THEN 2 END LIMIT 1",
                          *base, *_cv_ctes(), mte)
    return q


def _clf_metrics_split() -> list[str]:
    by = "model, split"
    return [
        f"cc AS (SELECT {by}, actual, predicted, count(*) AS n FROM cp GROUP BY {by}, actual, predicted)",
        f"tc AS (SELECT {by}, actual AS label, sum(n) AS support FROM cc GROUP BY {by}, actual)",
        f"pc AS (SELECT {by}, predicted AS label, sum(n) AS n_pred FROM cc GROUP BY {by}, predicted)",
        f"tp AS (SELECT {by}, actual AS label, n AS tp FROM cc WHERE actual = predicted)",
        "per0 AS (SELECT coalesce(tc.model, pc.model) AS model, coalesce(tc.split, pc.split) AS split, "
        "coalesce(tc.label, pc.label) AS label, coalesce(support, 0) AS support, coalesce(n_pred, 0) AS n_pred "
        "FROM tc FULL JOIN pc ON tc.model = pc.model AND tc.split = pc.split AND tc.label = pc.label)",
        "per1 AS (SELECT per0.*, coalesce(tp.tp, 0) AS tp FROM per0 LEFT JOIN tp USING (model, split, label))",
        "per AS (SELECT *, coalesce(CAST(tp AS DOUBLE) / nullif(CAST(n_pred AS DOUBLE), 0), 0) AS pr, "
        "coalesce(CAST(tp AS DOUBLE) / nullif(CAST(support AS DOUBLE), 0), 0) AS rc FROM per1)",
        f"wm AS (SELECT {by}, sum(support) AS n, sum(tp) AS correct, sum(pr * support) AS wp, sum(rc * support) AS wr, "
        f"sum(coalesce(2 * pr * rc / nullif(pr + rc, 0), 0) * support) AS wf FROM per GROUP BY {by})",
    ]


SEGMENT_TO_MODEL = {"AUTOMOBILE": "Budget Trend", "BUILDING": "TV Trend", "MACHINERY": "Budget Trend",
                    "HOUSEHOLD": "Gradient Boosting"}


def _score_ctes() -> list[str]:
    seg = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in SEGMENT_TO_MODEL.items())
    miss = " OR ".join(f"{c} IS NULL" for c in [*CHANNELS, "Influencer"])
    neg = " OR ".join(f"{c} < 0" for c in CHANNELS)
    order = "CASE model WHEN 'Budget Trend' THEN 1 WHEN 'TV Trend' THEN 2 END"
    return [
        *SPLIT_CTES, *_trend_ctes(),
        f"seg AS (SELECT o_orderkey, CASE c_mktsegment {seg} END AS model FROM orders "
        "LEFT JOIN customer ON o_custkey = c_custkey)",
        "req AS (SELECT campaign_id AS request_id, true AS parsed, TV, Radio, Social_Media, Influencer, model "
        "FROM raw JOIN seg ON campaign_id = o_orderkey)",
        f"rm AS ({_reg_metrics(chr(40) + 'SELECT * FROM rp WHERE split = ' + chr(39) + 'test' + chr(39) + chr(41))})",
        f"best AS (SELECT model FROM rm ORDER BY r2 DESC, {order} LIMIT 1)",
        "val AS (SELECT request_id, TV, Radio, Social_Media, Influencer, coalesce(model, (SELECT model FROM best)) AS model, "
        f"CASE WHEN NOT parsed THEN 'invalid_json' WHEN {miss} THEN 'missing_field' WHEN {neg} THEN 'negative_budget' "
        "WHEN Influencer NOT IN ('Mega', 'Macro', 'Micro', 'Nano') THEN 'unknown_influencer' "
        "WHEN coalesce(model, (SELECT model FROM best)) IS NULL OR coalesce(model, (SELECT model FROM best)) "
        "NOT IN ('Budget Trend', 'TV Trend') THEN 'model_not_found' END AS reason FROM req)",
        "acc AS (SELECT * FROM val WHERE reason IS NULL)",
    ]


def _pred(model_sql: str) -> str:
    """Prediction of the closed-form models fr0 (Budget Trend) / fr1 (TV Trend) for a model name."""
    return (f"CASE {model_sql} WHEN 'Budget Trend' THEN fr0.a + fr0.b * (TV + Radio + Social_Media) "
            "WHEN 'TV Trend' THEN fr1.a + fr1.b * TV END")


def score_sql() -> dict[str, str]:
    q: dict[str, str] = {}
    base = _score_ctes()
    q["scenario_parse"] = sql("SELECT * FROM req", *base)
    q["scenario_validation"] = sql(
        "SELECT request_id, CASE WHEN reason IS NULL THEN 'accepted' ELSE 'rejected' END AS status, reason FROM val", *base)
    q["scenario_unknown_model"] = sql("SELECT request_id, model, reason FROM val WHERE reason = 'model_not_found'", *base)
    tot = "(TV + Radio + Social_Media)"
    roi = f"CASE WHEN {tot} > 0 THEN p / {tot} ELSE 0.0 END"
    q["scenario_rejected"] = sql("SELECT request_id, model, reason FROM val WHERE reason IS NOT NULL", *base)
    q["score_scenarios"] = sql(
        f"SELECT request_id, model AS model_used, round(p, 4) AS predicted_sales_M, round({roi}, 4) AS roi_estimate, "
        f"round({tot}, 4) AS total_budget_M, round(p - {tot}, 4) AS profit_estimate_M, "
        f"round({roi} - 1.0, 4) AS roi_vs_threshold, p - {tot} > 0 AS profitable "
        f"FROM (SELECT acc.*, {_pred('model')} AS p FROM acc, fr0, fr1)", *base)
    q["scenario_by_model"] = sql(
        " UNION ALL ".join(f"SELECT request_id, '{m}' AS model, round({_pred(chr(39) + m + chr(39))}, 2) AS predicted_sales "
                           "FROM acc, fr0, fr1" for m in ["Budget Trend", "TV Trend"]), *base)
    chans = " UNION ALL ".join(f"SELECT '{c}' AS channel, m_{c} AS mx FROM mx" for c in CHANNELS)
    setc = ", ".join(f"CASE WHEN channel = '{c}' THEN mx / 59 * i ELSE {c} END AS {c}" for c in CHANNELS)
    q["sensitivity"] = sql(
        "SELECT Influencer, channel, CAST(i AS INTEGER) AS i, round(mx / 59 * i, 6) AS budget, "
        f"round({_pred('(SELECT model FROM best)')}, 4) AS predicted_sales FROM x, fr0, fr1",
        *base,
        "md2 AS (SELECT Influencer, " + ", ".join(f"quantile_cont({c}, 0.5) AS {c}" for c in CHANNELS)
        + " FROM camp GROUP BY Influencer)",
        "mx AS (SELECT " + ", ".join(f"max({c}) AS m_{c}" for c in CHANNELS) + " FROM camp)",
        f"x AS (SELECT Influencer, channel, mx, i, {setc} FROM md2, ({chans}) ch, range(0, 60) t(i))")
    reg = [*SPLIT_CTES, *_trend_ctes(), *_terc_ctes(),
           f"rm AS ({_reg_metrics(chr(40) + 'SELECT * FROM rp WHERE split = ' + chr(39) + 'test' + chr(39) + chr(41))})",
           "tcp AS (SELECT * FROM cp WHERE split = 'test')", *_clf_metrics("tcp"),
           f"cm AS ({_clf_select()})",
           "runs AS (SELECT 'regression' AS task, model, false AS tuned, r2 AS score FROM rm UNION ALL "
           "SELECT 'classification', model, false, f1 FROM cm)",
           "regi AS (SELECT task, model, tuned, score, score = max(score) OVER (PARTITION BY task) AS is_best FROM runs)",
           "dflt AS (SELECT task, model FROM (SELECT *, row_number() OVER (PARTITION BY task ORDER BY score DESC, "
           "CASE model WHEN 'Budget Trend' THEN 1 WHEN 'TV Trend' THEN 2 WHEN 'Budget Terciles' THEN 1 "
           "WHEN 'TV Terciles' THEN 2 END) AS r FROM regi) WHERE r = 1)"]
    q["model_registry"] = sql("SELECT * FROM regi", *reg)
    q["model_resolve"] = sql(
        "SELECT r.task, r.model, r.tuned, r.model = d.model AS is_default FROM "
        "(SELECT *, row_number() OVER (PARTITION BY task, model ORDER BY tuned DESC) AS rr FROM regi) r "
        "LEFT JOIN dflt d USING (task) WHERE rr = 1", *reg)
    q["model_info"] = sql(
        "SELECT t.task, coalesce(string_agg(model, ', ' ORDER BY model), '') AS available_models, "
        "arg_min(model, (-score, model)) AS best_model, count(DISTINCT model) AS n_models, "
        "CASE WHEN count(DISTINCT model) > 0 THEN 'healthy' ELSE 'degraded' END AS status, target, "
        "'TV, Radio, Social_Media, Influencer' AS input_features "
        "FROM (VALUES ('regression', 'Sales'), ('classification', 'Performance')) t(task, target) LEFT JOIN regi USING (task) "
        "GROUP BY t.task, target", *reg)
    q["metadata_merge"] = sql(
        "SELECT 'best_reg_model' AS key, (SELECT model FROM dflt WHERE task = 'regression') AS value UNION ALL "
        "SELECT 'best_clf_model', (SELECT model FROM dflt WHERE task = 'classification') UNION ALL "
        "SELECT 'n_train', CAST(count_if(split = 'train') AS VARCHAR) FROM st UNION ALL "
        "SELECT 'n_test', CAST(count_if(split = 'test') AS VARCHAR) FROM st", *reg)
    return q


def explain_sql() -> dict[str, str]:
    from ..schema import DEPLOYMENT_COMPLEXITY

    q: dict[str, str] = {}
    base = [*SPLIT_CTES, *_trend_ctes()]
    swap = ", ".join(f"CASE WHEN v.c = '{c}' THEN dn.{c} ELSE t.{c} END AS {c}" for c in CHANNELS)
    names = ", ".join(f"('{c}')" for c in [*CHANNELS, "Influencer"])
    q["permutation_importance"] = sql(
        "SELECT c AS feature, round(avg(base - r2), 6) AS importance_mean, "
        "round(stddev_pop(base - r2), 6) AS importance_std FROM sc, bs GROUP BY c",
        *base,
        f"th AS (SELECT campaign_id, TV, Radio, Social_Media, Influencer, Sales, {_md5()} AS h FROM sp WHERE split = 'test')",
        "tb AS (SELECT *, ('0x' || substr(h, 1, 7))::BIGINT AS u, ('0x' || substr(h, 25, 8))::BIGINT % "
        "greatest(1, (SELECT CAST(ceil(count(*) / 1024.0) AS BIGINT) FROM th)) AS blk FROM th)",
        "tst AS (SELECT *, row_number() OVER (PARTITION BY blk ORDER BY h, campaign_id) AS i FROM tb)",
        f"vr AS (SELECT r, c FROM range(30) x(r), (VALUES {names}) y(c))",
        "d0 AS (SELECT blk, i, r, c, xor(u, ('0x' || substr(md5('42-' || r || '-' || c || '-' || blk), 1, 7))::BIGINT) "
        "* 2654435761 AS a FROM tst, vr)",
        "d1 AS (SELECT blk, i, r, c, (xor(a, a >> 29) & 2147483647) * 2246822519 AS b FROM d0)",
        "d2 AS (SELECT blk, r, c, i AS donor, row_number() OVER (PARTITION BY blk, r, c ORDER BY xor(b, b >> 31) & 2147483647, i) "
        "AS i FROM d1)",
        f"jd AS (SELECT v.r, v.c, t.Sales, {swap} FROM tst t JOIN d2 v ON v.blk = t.blk AND v.i = t.i "
        "JOIN tst dn ON dn.blk = t.blk AND dn.i = v.donor)",
        "ev AS (SELECT r, c, Sales AS actual, fr0.a + fr0.b * (TV + Radio + Social_Media) AS predicted FROM jd, fr0)",
        "sc AS (SELECT r, c, 1 - sum((actual - predicted) * (actual - predicted)) / nullif(var_pop(actual) * count(*), 0)"
        " AS r2 FROM ev GROUP BY r, c)",
        "bs AS (SELECT 1 - sum((Sales - (a + b * (TV + Radio + Social_Media))) * (Sales - (a + b * (TV + Radio + "
        "Social_Media)))) / (var_pop(Sales) * count(*)) AS base FROM tst, fr0)")
    parts = [f"SELECT campaign_id, '{c}' AS feature, CAST({c} AS DOUBLE) AS value, CAST(NULL AS VARCHAR) AS category, "
             f"fr0.b * ({c} - m_{c}) AS shap FROM sp, fr0, mn WHERE split = 'test'" for c in CHANNELS]
    parts.append("SELECT campaign_id, 'Influencer', CAST(NULL AS DOUBLE), Influencer, 0.0 FROM sp WHERE split = 'test'")
    shap_ctes = [*base,
                 "mn AS (SELECT " + ", ".join(f"avg({c}) AS m_{c}" for c in CHANNELS) + " FROM sp WHERE split = 'train')",
                 f"sh0 AS ({' UNION ALL '.join(parts)})",
                 "shp AS (SELECT campaign_id, feature, value, category, round(shap, 6) AS shap_value, "
                 "round(fr0.a + fr0.b * (" + " + ".join(f"m_{c}" for c in CHANNELS) + "), 6) AS base_value "
                 "FROM sh0, fr0, mn)"]
    q["shap_linear"] = sql("SELECT * FROM shp", *shap_ctes)
    q["shap_summary"] = sql("SELECT feature, round(avg(abs(shap_value)), 6) AS mean_abs_shap, count(*) AS n "
                            "FROM shp GROUP BY feature", *shap_ctes)
    q["shap_extremes"] = sql(
        "SELECT e.model, e.extreme, s.campaign_id, e.predicted, CASE e.extreme WHEN 'min' THEN "
        "'lowest prediction: weakest campaign' ELSE 'highest prediction: strongest campaign' END AS label, "
        "s.feature, s.value, s.category, s.shap_value FROM shp s JOIN ext e USING (campaign_id)",
        *shap_ctes,
        "bt AS (SELECT * FROM rp WHERE split = 'test' AND model = 'Budget Trend')",
        "ext AS (SELECT model, 'min' AS extreme, campaign_id, round(predicted, 6) AS predicted FROM "
        "(SELECT *, row_number() OVER (ORDER BY predicted, campaign_id) AS r FROM bt) WHERE r = 1 UNION ALL "
        "SELECT model, 'max', campaign_id, round(predicted, 6) FROM "
        "(SELECT *, row_number() OVER (ORDER BY predicted DESC, campaign_id) AS r FROM bt) WHERE r = 1)")
    fr = ", ".join(f"({i}, CAST({s!r} AS DOUBLE))" for i, s in enumerate(float(x) for x in np.linspace(0.2, 1.0, 8)))
    q["learning_curve"] = sql(
        "SELECT 'Budget Trend' AS model, CAST(per.i AS INTEGER) AS size_idx, s AS fraction, "
        "round(avg(n) FILTER (WHERE kind = 'train'), 6) AS n_train, "
        "round(avg(r2) FILTER (WHERE kind = 'train'), 6) AS train_mean, "
        "round(stddev_pop(r2) FILTER (WHERE kind = 'train'), 6) AS train_std, "
        "round(avg(r2) FILTER (WHERE kind = 'val'), 6) AS val_mean, "
        "round(stddev_pop(r2) FILTER (WHERE kind = 'val'), 6) AS val_std "
        "FROM per JOIN (VALUES " + fr + ") v(i, s) USING (i) GROUP BY per.i, s",
        *SPLIT_CTES,
        "lc0 AS (SELECT *, CAST(('0x' || substr(md5('43-' || CAST(campaign_id AS VARCHAR)), 1, 8))::BIGINT AS DOUBLE)"
        " / CAST(4294967296.0 AS DOUBLE) AS u FROM sp WHERE split = 'train')",
        f"fs AS (SELECT f, i, s FROM range(0, 5) a(f), (VALUES {fr}) b(i, s))",
        "fit AS (SELECT f, i, regr_intercept(Sales, Total_Budget) AS a, regr_slope(Sales, Total_Budget) AS b "
        "FROM fs JOIN lc0 ON lc0.fold <> fs.f AND lc0.u < fs.s GROUP BY f, i)",
        "cells AS (SELECT fs.f, fs.i, 'train' AS kind, Sales, a + b * Total_Budget AS p FROM fs "
        "JOIN lc0 ON lc0.fold <> fs.f AND lc0.u < fs.s JOIN fit ON fit.f = fs.f AND fit.i = fs.i UNION ALL "
        "SELECT fs.f, fs.i, 'val', Sales, a + b * Total_Budget FROM fs JOIN lc0 ON lc0.fold = fs.f "
        "JOIN fit ON fit.f = fs.f AND fit.i = fs.i)",
        "per AS (SELECT f, i, kind, 1 - sum((Sales - p) * (Sales - p)) / nullif(var_pop(Sales) * count(*), 0) AS r2, "
        "count(*) AS n FROM cells GROUP BY f, i, kind)")
    dim = ", ".join("(" + ", ".join("'" + v.replace("'", "''") + "'" for v in row) + ")" for row in DEPLOYMENT_COMPLEXITY)
    q["deployment_cost"] = sql(
        "SELECT 'regression' AS task, model, coalesce(params_est, '?') AS params_est, coalesce(inference_ms, '?') AS inference_ms, "
        "coalesce(export, '?') AS export, coalesce(note, '?') AS note FROM (SELECT DISTINCT model FROM req WHERE model IS NOT NULL) "
        f"LEFT JOIN (VALUES {dim}) d(model, params_est, inference_ms, export, note) USING (model)", *_score_ctes())
    return q


RAW_SPLIT = (f"lfs AS (SELECT *, CASE WHEN substr({_md5()}, 1, 8) < '33333333' THEN 'test' ELSE 'train' END AS split, "
             f"CAST(('0x' || substr({_md5()}, 9, 8))::BIGINT % 5 AS INTEGER) AS fold FROM lab)")


def _prepared_ctes(tag: str, cond: str) -> list[str]:
    """All labelled rows, filled and labelled by the statistics of those under ``cond``: ``pr_<tag>``."""
    med = ", ".join(f"quantile_cont({c}, 0.5) AS m_{c}" for c in CHANNELS)
    fill = ", ".join(f"coalesce({c}, m_{c}) AS {c}" for c in CHANNELS)
    mom = ", ".join(f"avg({c}) AS a_{c}, stddev_pop({c}) AS d_{c}" for c in CHANNELS)
    return [
        f"st_{tag} AS (SELECT {med}, quantile_cont(Sales, {1/3!r}) AS t1, quantile_cont(Sales, {2/3!r}) AS t2 FROM lfs "
        f"WHERE {cond})",
        f"mo_{tag} AS (SELECT Influencer AS m_inf FROM lfs WHERE {cond} AND Influencer IS NOT NULL GROUP BY Influencer "
        "ORDER BY count(*) DESC, Influencer LIMIT 1)",
        f"pr_{tag} AS (SELECT campaign_id, split, fold, {fill}, coalesce(Influencer, m_inf) AS Influencer, Sales, t1, t2 "
        f"FROM lfs, st_{tag}, mo_{tag})",
        f"sc_{tag} AS (SELECT {mom} FROM pr_{tag} WHERE {cond})"]


def leak_free_sql() -> dict[str, str]:
    train = "split = 'train'"
    base = [RAW_SPLIT, *_prepared_ctes("train", train)]
    tb = "(TV + Radio + Social_Media)"
    shares = ", ".join(f"round({c} / nullif({tb}, 0), 6) AS {n}" for c, n in
                       [("TV", "TV_Share"), ("Radio", "Radio_Share"), ("Social_Media", "Social_Share")])
    z = ", ".join(f"round(({c} - a_{c}) / CASE WHEN d_{c} = 0 THEN 1.0 ELSE d_{c} END, 6) AS {c}_z" for c in CHANNELS)
    hot = ", ".join(f"CAST(coalesce(Influencer = '{c}', false) AS DOUBLE) AS Influencer_{c}" for c in ["Macro", "Micro", "Nano"])
    out = {"leak_free_campaigns": sql(
        "SELECT campaign_id, " + ", ".join(f"round({c}, 6) AS {c}" for c in [*CHANNELS, "Sales"])
        + f", Influencer, round({tb}, 6) AS Total_Budget, round(Sales / nullif({tb}, 0), 6) AS ROI, {shares}, "
        "CASE WHEN Sales <= t1 THEN 'Low' WHEN Sales <= t2 THEN 'Medium' ELSE 'High' END AS Performance, "
        f"split, {z}, {hot} FROM pr_train, sc_train", *base)}
    both = [*base, *_prepared_ctes("all", "true")]
    names = ([(f"median_{c}", "st", f"m_{c}") for c in CHANNELS] + [("tercile_1", "st", "t1"), ("tercile_2", "st", "t2")]
             + [(f"mean_{c}", "sc", f"a_{c}") for c in CHANNELS] + [(f"deviation_{c}", "sc", f"d_{c}") for c in CHANNELS])
    out["preparation_shift"] = sql(" UNION ALL ".join(
        f"SELECT '{n}' AS statistic, round(a.{c}, 6) AS all_rows, round(t.{c}, 6) AS train_rows, round(a.{c} - t.{c}, 6) AS shift "
        f"FROM {t}_all a, {t}_train t" for n, t, c in names), *both)
    ctes, parts = [], []
    ctes.append(f"lf AS (SELECT *, {tb} AS Total_Budget FROM pr_train)")
    for i, (name, feat) in enumerate(TREND.items()):
        ctes.append(f"lr{i} AS (SELECT regr_intercept(Sales, {feat}) AS a, regr_slope(Sales, {feat}) AS b FROM lf WHERE {train})")
        parts.append(f"SELECT campaign_id, '{name}' AS model, split, Sales AS actual, a + b * {feat} AS predicted FROM lf, lr{i}")
    out["leak_free_metrics"] = sql(_reg_metrics("(SELECT * FROM lp WHERE split = 'test')"), *base, *ctes,
                                   f"lp AS ({' UNION ALL '.join(parts)})")
    ctes, parts = [RAW_SPLIT], []
    for f in range(5):
        ctes += _prepared_ctes(f"f{f}", f"{train} AND fold <> {f}")
        ctes.append(f"ln{f} AS (SELECT regr_intercept(Sales, {tb}) AS a, regr_slope(Sales, {tb}) AS b FROM pr_f{f} "
                    f"WHERE {train} AND fold <> {f})")
        parts.append(f"SELECT 'Budget Trend' AS model, fold, Sales AS actual, a + b * {tb} AS predicted FROM pr_f{f}, ln{f} "
                     f"WHERE {train} AND fold = {f}")
    e = "(actual - predicted)"
    out["leak_free_cv_scores"] = sql(
        f"SELECT model, fold, round(1 - sum({e} * {e}) / nullif(var_pop(actual) * count(*), 0), 6) AS score "
        "FROM lv GROUP BY model, fold", *ctes, f"lv AS ({' UNION ALL '.join(parts)})")
    return out


# Outputs of the batch run's table steps and the query whose rows each must have.
BATCH_OUTPUTS = {
    "load": {"raw": "campaigns_raw"}, "prepare": {"campaigns": "enriched_campaigns"},
    "split": {"regression": "split_regression", "classification": "split_stratified", "classification_train": "stratified_folds"},
    "explore": {n: n for n in ["null_counts", "describe", "value_counts_influencer", "class_balance", "kpi_overview",
                               "channel_mean_budget", "sales_by_influencer", "iqr_outliers", "quasi_constant",
                               "correlation_matrix", "collinear_pairs", "target_correlation", "histogram", "box_stats",
                               "trend_by_influencer", "saturation_curve", "saturation_points", "lowess_roi", "top_roi"]},
}


def _batch_outputs(known: dict[str, str]) -> str:
    return " UNION ALL ".join(f"SELECT '{step}' AS step, '{out}' AS output, count(*) AS rows FROM ({known[q]}) q{i}{j}"
                              for i, (step, outs) in enumerate(BATCH_OUTPUTS.items()) for j, (out, q) in enumerate(outs.items()))


def all_sql() -> dict[str, str]:
    out = leak_free_sql()
    out.update(profile_sql())
    out.update(eval_sql())
    out.update(score_sql())
    out.update(explain_sql())
    out["batch_outputs"] = _batch_outputs(out)
    out["stream_score"] = out["score_scenarios"]  # the stream must equal the batch scoring
    return out
