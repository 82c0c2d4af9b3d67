"""Queries of the rolling feature families."""

from __future__ import annotations

from pyspark.sql import functions as F

from barline.operators import windows as w
from barline.plans.helpers import BY, ahead, full, lag, mean, rounded, rounded_sql, win
from barline.sources.panels import BARS, duck, panel

QUERIES: dict = {}
ORACLE_SQL: dict = {}


def feature(name: str, operator, sql: dict[str, str], steps: str = "", source: str = "panel") -> None:
    QUERIES[name] = lambda spark, sf_dir: rounded(operator(panel(spark, sf_dir)), list(sql))
    ORACLE_SQL[name] = duck(BARS) + steps + rounded_sql(sql, source)


RET = f", p AS (SELECT *, close / {lag('close')} - 1 AS r, {lag('close')} AS prev FROM panel)"

feature("e01_returns", w.returns, {**{f"ret{k}": f"close / {lag('close', k)} - 1" for k in (1, 3, 5, 10, 20, 40, 60)}, "log_ret": f"LN(close / {lag('close')})"})
feature("e02_range_position", w.range_position, {"dist_high": f"close / ({full('MAX(close)', 'close', 250, 0, 60)}) - 1", "dist_low": f"close / ({full('MIN(close)', 'close', 250, 0, 60)}) - 1"})
feature(
    "e03_alignment",
    w.alignment,
    {"aligned": "CASE WHEN m60 IS NOT NULL THEN CAST(m5 > m10 AS INT) + CAST(m10 > m20 AS INT) + CAST(m20 > m60 AS INT) END", "slope": f"(m20 - {lag('m20', 5)}) / close"},
    ", p AS (SELECT *, " + ", ".join(f"{mean('CAST(ROUND(close * 100) AS BIGINT)', k)} / 100 AS m{k}" for k in (5, 10, 20, 60)) + " FROM panel)",
    "p",
)
feature(
    "e04_days_above_average",
    w.above_average,
    {"days_above": "CASE WHEN ma IS NULL THEN NULL WHEN f THEN LEAST(60, SUM(CAST(f AS INT)) OVER (PARTITION BY code, g ORDER BY date)) ELSE 0 END"},
    f", c0 AS (SELECT *, CAST(ROUND(close * 100) AS BIGINT) AS cents FROM panel), p0 AS (SELECT *, {mean('cents', 60)} AS ma FROM c0), p1 AS (SELECT *, COALESCE(cents > ma, FALSE) AS f FROM p0), p AS (SELECT *, SUM(CAST(NOT f AS INT)) OVER ({BY}) AS g FROM p1)",
    "p",
)
feature(
    "e05_compression",
    w.compression,
    {"range_compress": f"{mean('amp', 5)} / {mean('amp', 20)}", "vol_compress": f"{mean('turnover', 5)} / {mean('turnover', 20)}", "atr_ratio": f"{mean('tr', 14)} / {mean('tr', 60)}", "boll_width": f"4 * ({full('STDDEV_SAMP(close)', 'close', 20)}) / {mean('close', 20)}"},
    RET + ", q AS (SELECT *, (high - low) / close AS amp, GREATEST(high - low, ABS(high - prev), ABS(low - prev)) AS tr FROM p)",
    "q",
)
feature(
    "e06_volume_block",
    w.volume_block,
    {
        "vol_ratio5": f"turnover / {mean('turnover', 5)}",
        "vol_ratio20": f"turnover / {mean('turnover', 20)}",
        "turn_cv20": f"({full('STDDEV_SAMP(turnover)', 'turnover', 20)}) / {mean('turnover', 20)}",
        "up_vol_share20": f"({full('SUM(up)', 'up', 20)}) / ({full('SUM(turnover)', 'turnover', 20)})",
        "obv_slope20": f"({full('SUM(signed)', 'signed', 20)}) / ({full('SUM(turnover)', 'turnover', 20)})",
        "amt_ma20": f"LN(1 + {mean('amount', 20)})",
    },
    RET + ", q AS (SELECT *, CASE WHEN close > prev THEN turnover ELSE 0 END AS up, COALESCE(SIGN(close - prev), 0) * turnover AS signed FROM p)",
    "q",
)
feature("e11_five_row_aggregates", lambda d: w.five_row(w.returns(d, (1,)), ["ret1", "turnover"]), {k: v for x, e in (("ret1", "r"), ("turnover", "turnover")) for k, v in ((f"{x}__last", e), (f"{x}__mean", mean(e, 5)), (f"{x}__slope", f"({e} - {lag(e, 4)}) / 4"))}, RET, "p")
LIMIT = 0.045
feature(
    "e13_streak_of_large_gains",
    lambda d: w.run_length(d.withColumn("_r", w.gain()), F.col("_r") >= LIMIT, "streak"),
    {"streak": "CASE WHEN f THEN SUM(CAST(f AS INT)) OVER (PARTITION BY code, g ORDER BY date) ELSE 0 END"},
    RET + f", p1 AS (SELECT *, COALESCE(r >= {LIMIT}, FALSE) AS f FROM p), q AS (SELECT *, SUM(CAST(NOT f AS INT)) OVER ({BY}) AS g FROM p1)",
    "q",
)
feature(
    "e14_rows_since_large_gain",
    lambda d: w.since_flag(d.withColumn("_r", w.gain()), F.col("_r") >= LIMIT, "since"),
    {"since": f"LEAST(60, COALESCE(n - MAX(CASE WHEN r >= {LIMIT} THEN n END) OVER ({BY}), 60))"},
    RET + f", q AS (SELECT *, ROW_NUMBER() OVER ({BY}) AS n FROM p)",
    "q",
)


def market_days(bars):
    """date and its number among the dates on which at least a tenth of the codes have a bar."""
    from pyspark.sql.window import Window

    n = bars.groupBy("date").agg(F.count("*").alias("n"))
    return n.withColumn("day", F.row_number().over(Window.orderBy("date"))).select("date", "day")


feature("e15_suspension_gaps", lambda d: w.gaps(d, market_days(d)), {"missed": "m", "max_missed": f"MAX(m) {win(20)}"}, f", k AS (SELECT date, ROW_NUMBER() OVER (ORDER BY date) AS day FROM (SELECT DISTINCT date FROM panel)), j AS (SELECT panel.*, day FROM panel JOIN k ON panel.date = k.date), p AS (SELECT *, COALESCE(day - LAG(day) OVER ({BY}) - 1, 0) AS m FROM j)", "p")
SPAN, TOP, BOTTOM = "(high - low + 1e-12)", "GREATEST(open, close)", "LEAST(open, close)"
feature("e17_bar_shapes", w.shapes, {"kmid": "(close - open) / open", "klen": "(high - low) / open", "kmid2": f"(close - open) / {SPAN}", "kup": f"(high - {TOP}) / open", "kup2": f"(high - {TOP}) / {SPAN}", "klow": f"({BOTTOM} - low) / open", "klow2": f"({BOTTOM} - low) / {SPAN}", "ksft": "(2 * close - high - low) / open", "ksft2": f"(2 * close - high - low) / {SPAN}", "open0": "open / close", "high0": "high / close", "low0": "low / close"})
SPANS = (5, 10, 20, 30, 60)
feature("e18_rolling_moments", w.moments, {k: v for d in SPANS for k, v in {f"roc{d}": f"{lag('close', d)} / close", f"ma{d}": f"{mean('close', d)} / close", f"std{d}": f"({full('STDDEV_POP(close)', 'close', d)}) / close", f"max{d}": f"({full('MAX(high)', 'close', d)}) / close", f"min{d}": f"({full('MIN(low)', 'close', d)}) / close", f"vma{d}": f"{mean('volume', d)} / volume", f"vstd{d}": f"({full('STDDEV_POP(volume)', 'volume', d)}) / volume"}.items()})
feature("e19_rolling_trend", w.trend, {k: v for d in SPANS for k, v in {f"beta{d}": f"({full('REGR_SLOPE(close, t)', 'close', d)}) / close", f"rsqr{d}": f"({full('REGR_R2(close, t)', 'close', d)})", f"resi{d}": f"(close - (AVG(close) {win(d)} + ({full('REGR_SLOPE(close, t)', 'close', d)}) * (t - AVG(t) {win(d)}))) / close"}.items()}, f", p AS (SELECT *, CAST(ROW_NUMBER() OVER ({BY}) AS DOUBLE) AS t FROM panel)", "p")
feature("e20_window_quantiles", w.quantiles_in_window, {k: v for d in (10, 20) for k, v in {f"qtlu{d}": f"({full('QUANTILE_CONT(close, 0.8)', 'close', d)}) / close", f"qtld{d}": f"({full('QUANTILE_CONT(close, 0.2)', 'close', d)}) / close", f"rank{d}": f"CASE WHEN COUNT(close) {win(d)} = {d} THEN len(list_filter(LIST(close) {win(d)}, lambda x: x <= close)) / {d}.0 END", f"rsv{d}": f"(close - ({full('MIN(low)', 'close', d)})) / (({full('MAX(high)', 'close', d)}) - ({full('MIN(low)', 'close', d)}) + 1e-12)"}.items()})
feature("e21_rows_since_extremes", w.extremes, {k: v for d in (10, 20) for k, v in {f"imax{d}": f"(t - h{d}) / {d}.0", f"imin{d}": f"(t - l{d}) / {d}.0", f"imxd{d}": f"(l{d} - h{d}) / {d}.0"}.items()}, f", p AS (SELECT *, ROW_NUMBER() OVER ({BY}) AS t FROM panel), q AS (SELECT *, " + ", ".join(f"CASE WHEN COUNT(high) {win(d)} = {d} THEN -(MAX(ROW(high, -t)) {win(d)})[2] END AS h{d}, CASE WHEN COUNT(low) {win(d)} = {d} THEN (MIN(ROW(low, t)) {win(d)})[2] END AS l{d}" for d in (10, 20)) + " FROM p)", "q")


def corr(x: str, y: str, n: int) -> str:
    w = win(n)
    return f"CASE WHEN COUNT({x}) {w} = {n} THEN COVAR_POP({x}, {y}) {w} / NULLIF(STDDEV_POP({x}) {w} * STDDEV_POP({y}) {w}, 0) END"


feature("e22_rolling_correlations", w.correlations, {k: v for d in (10, 20) for k, v in {f"corr{d}": corr("close", "lv", d), f"cord{d}": corr("r", "dv", d)}.items()}, RET + f", q0 AS (SELECT *, LN(volume + 1) AS lv FROM p), q AS (SELECT *, lv - LAG(lv) OVER ({BY}) AS dv FROM q0)", "q")
feature("e23_sign_counts", w.signs, {k: v for d in (10, 20) for k, v in {f"cntp{d}": f"CASE WHEN COUNT(x) {win(d)} = {d} THEN AVG(CAST(x > 0 AS DOUBLE)) {win(d)} END", f"cntn{d}": f"CASE WHEN COUNT(x) {win(d)} = {d} THEN AVG(CAST(x < 0 AS DOUBLE)) {win(d)} END", f"sump{d}": f"CASE WHEN COUNT(x) {win(d)} = {d} THEN SUM(GREATEST(x, 0)) {win(d)} / (SUM(ABS(x)) {win(d)} + 1e-12) END", f"sumn{d}": f"CASE WHEN COUNT(x) {win(d)} = {d} THEN SUM(GREATEST(-x, 0)) {win(d)} / (SUM(ABS(x)) {win(d)} + 1e-12) END", f"vsump{d}": f"CASE WHEN COUNT(x) {win(d)} = {d} THEN SUM(GREATEST(v, 0)) {win(d)} / (SUM(ABS(v)) {win(d)} + 1e-12) END"}.items()}, f", q AS (SELECT *, close - {lag('close')} AS x, volume - {lag('volume')} AS v FROM panel)", "q")
feature("e24_overnight", w.overnight, {**{k: v for n in (5, 20, 60) for k, v in {f"on{n}": full("SUM(o)", "o", n), f"id{n}": full("SUM(i)", "i", n)}.items()}, "on_less_id20": full("SUM(o - i)", "o", 20), "on_std20": full("STDDEV_SAMP(o)", "o", 20), "on_pos20": full("AVG(CAST(o > 0 AS DOUBLE))", "o", 20)}, f", q AS (SELECT *, LN(open / {lag('close')}) AS o, LN(close / open) AS i FROM panel)", "q")
feature("e27_tails", w.tails, {"max3_20": f"CASE WHEN COUNT(r) {win(20)} = 20 THEN list_sum(list_reverse_sort(LIST(r) {win(20)})[1:3]) / 3 END", "max60": full("MAX(r)", "r", 60), "min20": full("MIN(r)", "r", 20), "skew60": f"CASE WHEN COUNT(r) {win(60)} = 60 THEN (m3 - 3 * m1 * m2 + 2 * m1 * m1 * m1) / POWER(m2 - m1 * m1, 1.5) END"}, RET + f", q AS (SELECT *, AVG(r) {win(60)} AS m1, AVG(r * r) {win(60)} AS m2, AVG(r * r * r) {win(60)} AS m3 FROM p)", "q")
feature("e29_turnover_structure", w.turnover_block, {"turn5_60": f"{mean('turnover', 5)} / {mean('turnover', 60)}", "turn_conc20": f"({full('MAX(turnover)', 'turnover', 20)}) / ({full('SUM(turnover)', 'turnover', 20)})", "turn_z60": f"(turnover - {mean('turnover', 60)}) / ({full('STDDEV_SAMP(turnover)', 'turnover', 60)})", "amihud20": mean("ABS(r) / amount * 1e6", 20)}, RET, "p")
feature("e39_previous_day", w.previous_day, {"prev_close": lag("close"), "prev_amount": lag("amount"), "pos60": f"({lag('close')} - ({full('MIN(low)', 'close', 60, 1, 25)})) / NULLIF(({full('MAX(high)', 'close', 60, 1, 25)}) - ({full('MIN(low)', 'close', 60, 1, 25)}), 0)", "platform": full("MAX(high)", "close", 20, 1, 5), "amount_ratio": f"{lag('amount')} / {mean('amount', 5, 2)}"})
feature("e40_future_max", w.future_max, {"max_ahead": f"MAX(high) {ahead(20)}", "n_ahead": f"COUNT(high) {ahead(20)}"})
