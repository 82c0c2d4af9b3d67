"""Queries across codes, of labels, joins, lists and statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from barline.functions import scalars
from barline.operators import crosssection as cs
from barline.operators import joins, labels, series
from barline.operators import windows as w
from barline.plans.helpers import BY, NUDGE, ahead, lag, rounded, rounded_sql
from barline.sources import panels
from barline.sources.panels import BARS, DUCK_DISCLOSURES, NOTICES, duck, panel

QUERIES: dict = {}
ORACLE_SQL: dict = {}


def add(name: str, query, sql: str, *more: str) -> None:
    QUERIES[name] = query
    ORACLE_SQL[name] = duck(BARS, *more) + sql


def r6(e: str, name: str) -> str:
    return f"ROUND(CAST({e} AS DOUBLE) + {NUDGE}, 6) + CAST(0 AS DOUBLE) AS {name}"


RET = f", p AS (SELECT *, close / {lag('close')} - 1 AS r, close / {lag('close', 20)} - 1 AS r20, close / {lag('close', 60)} - 1 AS r60 FROM panel)"


def returns(spark, sf_dir):
    return panel(spark, sf_dir).select("*", w.gain().alias("r"), w.gain(20).alias("r20"), w.gain(60).alias("r60"))


def tied(x: str) -> str:
    """Rank share with mean ranks for ties, nulls left out."""
    return f"CASE WHEN {x} IS NOT NULL THEN (RANK() OVER (PARTITION BY date ORDER BY {x} NULLS LAST) + (COUNT({x}) OVER (PARTITION BY date, {x}) - 1) / 2.0) / COUNT({x}) OVER (PARTITION BY date) END"


# scalar functions
add(
    "b01_segments_and_limits",
    lambda s, d: (lambda x: rounded(x.withColumn("cap", scalars.limit_price(F.col("close"), scalars.limit_pct(F.col("seg"), F.col("sector")), F.col("seg"))), ["cap"], ("code", "date", "code6", "seg", "flagged")))(
        panel(s, d).withColumn("code6", scalars.code6(F.col("code") * 9173)).withColumn("seg", scalars.board_of(F.col("code6"))).withColumn("flagged", scalars.is_flagged(F.col("sector")))
    ),
    """, a AS (SELECT *, lpad(CAST(code * 9173 AS VARCHAR), 6, '0') AS code6 FROM panel),
    b AS (SELECT *, CASE WHEN code6[1:3] = '688' THEN 'star' WHEN code6[1:1] = '3' THEN 'chinext' WHEN code6[1:2] IN ('83','87','88','43','92') THEN 'bj' ELSE 'main' END AS seg FROM a),
    c AS (SELECT *, close * (1 + (CASE WHEN seg IN ('star','chinext') THEN 20 WHEN seg = 'bj' THEN 30 WHEN upper(sector)[1:1] = 'S' THEN 5 ELSE 10 END) / CAST(100 AS DOUBLE)) AS raw FROM b)
    SELECT code, date, code6, seg, contains(upper(sector), 'ST') OR contains(sector, 'OUT') AS flagged, """
    + r6("CASE WHEN seg = 'bj' THEN FLOOR(raw * 100 + 1e-6) / 100 ELSE ROUND(raw + 1e-9, 2) END", "cap")
    + " FROM c",
)
add(
    "b08_old_enough_codes",
    lambda s, d: panel(s, d).groupBy("code").agg(F.count("*").alias("n")).where("n > 120"),
    " SELECT code, COUNT(*) AS n FROM panel GROUP BY code HAVING COUNT(*) > 120",
)
add(
    "b09_common_start",
    lambda s, d: (lambda p, n: p.join(n.where(F.col("n") >= F.col("most") * 0.5).agg(F.min("date").alias("start")), p.date >= F.col("start")).groupBy("code").agg(F.min("date").alias("first"), F.count("*").alias("n")))(
        panel(s, d), panel(s, d).groupBy("date").agg(F.count("*").alias("n")).withColumn("most", F.max("n").over(cs.Window.partitionBy()))
    ),
    ", n AS (SELECT date, COUNT(*) AS n FROM panel GROUP BY date), m AS (SELECT MIN(date) AS start FROM n WHERE n >= 0.5 * (SELECT MAX(n) FROM n)) SELECT code, MIN(date) AS first, COUNT(*) AS n FROM panel, m WHERE date >= start GROUP BY code",
)
add(
    "a10_clean_bars",
    lambda s, d: panel(s, d).where("open > 0 AND high > 0 AND low > 0 AND close > 0 AND high >= low AND volume > 0").groupBy("board").agg(F.count("*").alias("n"), F.round(F.sum("volume"), 2).alias("volume")),
    " SELECT board, COUNT(*) AS n, ROUND(SUM(volume), 2) AS volume FROM panel WHERE open > 0 AND high > 0 AND low > 0 AND close > 0 AND high >= low AND volume > 0 GROUP BY board",
)
# joins
add(
    "c05_dimension_map",
    lambda s, d: rounded(panel(s, d).groupBy("sector", "board").agg(F.avg("turnover").alias("turnover"), F.countDistinct("code").alias("codes")), ["turnover"], ("sector", "board", "codes")),
    " SELECT sector, board, COUNT(DISTINCT code) AS codes, " + r6("AVG(turnover)", "turnover") + " FROM panel GROUP BY sector, board",
)
add(
    "c06_as_of_disclosures",
    lambda s, d: joins.as_of(panel(s, d), panels.disclosures(s, d), "notice", ["holders", "period"], "period").select("code", "date", "holders", "period", "age"),
    " SELECT code, date, m[3] AS holders, m[2] AS period, date - m[1] AS age FROM (SELECT p.code, p.date, (SELECT MAX(ROW(notice, period, holders)) FROM reports h WHERE h.code = p.code AND h.notice <= p.date) AS m FROM panel p)",
    DUCK_DISCLOSURES,
)
add(
    "c07_strict_as_of",
    lambda s, d: joins.as_of(panel(s, d), panels.disclosures(s, d), "notice", ["holders"], "period", strict=True).select("code", "date", "holders", "age"),
    " SELECT code, date, m[3] AS holders, date - m[1] AS age FROM (SELECT p.code, p.date, (SELECT MAX(ROW(notice, period, holders)) FROM reports h WHERE h.code = p.code AND h.notice < p.date) AS m FROM panel p)",
    DUCK_DISCLOSURES,
)
add(
    "c08_sum_of_next_30_days",
    lambda s, d: joins.sum_between(panel(s, d), panels.notices(s, d), "date", F.lit(1.0), 1, 30, "next").select("code", "date", F.col("next_n").alias("n")),
    " SELECT p.code, p.date, COUNT(n.code) AS n FROM panel p LEFT JOIN notices n ON n.code = p.code AND n.date > p.date AND n.date <= p.date + 30 GROUP BY 1, 2",
    NOTICES,
)
add(
    "c09_next_trading_day",
    lambda s, d: joins.next_day(panels.notices(s, d), "date", panel(s, d).select("date").distinct()).select("notice_id", "date", "next_day"),
    " SELECT notice_id, date, (SELECT MIN(c.date) FROM (SELECT DISTINCT date FROM panel) c WHERE c.date >= n.date) AS next_day FROM notices n",
    NOTICES,
)
add(
    "c11_days_since_notice",
    lambda s, d: joins.days_since(panel(s, d), panels.notices(s, d).where("kind = '1-URGENT'"), "date", 20, "since").select("code", "date", "since"),
    " SELECT code, date, CASE WHEN date - m <= 20 THEN date - m ELSE 99 END AS since FROM (SELECT code, date, (SELECT MAX(n.date) FROM notices n WHERE n.code = p.code AND n.kind = '1-URGENT' AND n.date <= p.date) AS m FROM panel p)",
    NOTICES,
)
add(
    "c13_open_processes",
    lambda s, d: joins.open_processes(panels.notices(s, d), F.lit("1998-06-30").cast("date"), 730, ["1-URGENT", "2-HIGH"], ["5-LOW"]),
    """, r AS (SELECT * FROM notices WHERE date <= DATE '1998-06-30' AND date >= DATE '1998-06-30' - 730),
    l AS (SELECT code, arg_max(notice_id, ROW(date, notice_id)) AS notice_id, MAX(date) AS date FROM r WHERE kind IN ('1-URGENT', '2-HIGH') GROUP BY code),
    o AS (SELECT code, MAX(date) AS fin FROM r WHERE kind = '5-LOW' GROUP BY code)
    SELECT l.code, l.notice_id, l.date FROM l LEFT JOIN o ON o.code = l.code WHERE fin IS NULL OR fin <= l.date""",
    NOTICES,
)
add(
    "c15_lag_pointer",
    lambda s, d: panel(s, d).select("code", "date", F.lag("date", 20).over(w.by_code()).alias("then"), F.datediff("date", F.lag("date", 20).over(w.by_code())).alias("span")),
    f" SELECT code, date, {lag('date', 20)} AS \"then\", date - {lag('date', 20)} AS span FROM panel",
)
# aggregations
add(
    "d01_market_days",
    lambda s, d: rounded(returns(s, d).groupBy("date").agg(F.count("*").alias("n"), F.sum("amount").alias("amount"), F.avg((F.col("r") > 0).cast("double")).alias("up"), F.sum((F.col("r") >= 0.045).cast("int")).alias("large"), F.avg("r").alias("mean"), F.percentile("r", F.lit(0.5)).alias("mid")), ["amount", "up", "mean", "mid"], ("date", "n", "large"), 4),
    RET + rounded_sql({"amount": "SUM(amount)", "up": "AVG(CAST(r > 0 AS DOUBLE))", "mean": "AVG(r)", "mid": "QUANTILE_CONT(r, 0.5)"}, "p GROUP BY date", "date, COUNT(*) AS n, CAST(SUM(CAST(r >= 0.045 AS INT)) AS BIGINT) AS large", 4),
)
UP = f"CASE WHEN COUNT(high) {ahead(20)} = 20 THEN MAX(high) {ahead(20)} / close - 1 END"
LABELS = f", u0 AS (SELECT *, {UP} AS rise FROM p), u AS (SELECT *, CAST(rise > 0.3 AS INT) AS y FROM u0)"


def labelled(s, d):
    return labels.label_up(returns(s, d))


add("d04_clustered_rate", lambda s, d: rounded(series.clustered(labelled(s, d), "y"), ["rate", "se"], ("n", "k")), RET + LABELS + ", d AS (SELECT date, SUM(y) AS k, COUNT(y) AS n FROM u WHERE y IS NOT NULL GROUP BY date), s AS (SELECT SUM(n) AS n, SUM(k) AS k FROM d) SELECT CAST(s.n AS BIGINT) AS n, CAST(s.k AS BIGINT) AS k, " + r6("s.k / s.n", "rate") + ", " + r6("SQRT(SUM(POWER(d.k - d.n * CAST(s.k AS DOUBLE) / s.n, 2))) / s.n", "se") + " FROM d, s GROUP BY s.n, s.k")
add("d05_monthly_rates", lambda s, d: rounded(labelled(s, d).where("y IS NOT NULL").groupBy(F.trunc("date", "month").alias("month")).agg(F.count("*").alias("n"), F.avg("y").alias("rate")), ["rate"], ("month", "n")), RET + LABELS + " SELECT CAST(date_trunc('month', date) AS DATE) AS month, COUNT(*) AS n, " + r6("AVG(y)", "rate") + " FROM u WHERE y IS NOT NULL GROUP BY 1")
WILSON = ", ".join(r6(f"(k / n + 1.9208 / n {sign} 1.96 * SQRT(k / n * (1 - k / n) / n + 0.9604 / (n * n))) / (1 + 3.8416 / n)", name) for sign, name in (("-", "low"), ("+", "high")))
add("d06_hit_table", lambda s, d: rounded(series.hit_table(labelled(s, d), F.col("board"), "y"), ["rate", "low", "high"], ("bucket", "n", "k")), RET + LABELS + ", g AS (SELECT board AS bucket, COUNT(*) AS n0, SUM(y) AS k0 FROM u WHERE y IS NOT NULL GROUP BY 1), h AS (SELECT bucket, n0, k0, CAST(n0 AS DOUBLE) AS n, CAST(k0 AS DOUBLE) AS k FROM g) SELECT bucket, n0 AS n, CAST(k0 AS BIGINT) AS k, " + r6("h.k / h.n", "rate") + ", " + WILSON.replace("k / n", "h.k / h.n").replace("/ n", "/ h.n").replace("(n * n)", "(h.n * h.n)") + " FROM h")
add("d10_decile_cells", lambda s, d: rounded(labelled(s, d).withColumn("bin", cs.quantile_bin("r20", 10, "date")).where("y IS NOT NULL").groupBy("board", "bin").agg(F.count("*").alias("n"), F.avg("y").alias("rate")), ["rate"], ("board", "bin", "n")), RET + LABELS + ", b AS (SELECT *, CASE WHEN r20 IS NOT NULL THEN GREATEST(CAST(CEIL((ROW_NUMBER() OVER (PARTITION BY date ORDER BY r20 NULLS LAST, code) - 1) * 10 / NULLIF(CAST(COUNT(r20) OVER (PARTITION BY date) - 1 AS DOUBLE), 0)) AS BIGINT) - 1, 0) END AS bin FROM u) SELECT board, bin, COUNT(*) AS n, " + r6("AVG(y)", "rate") + " FROM b WHERE y IS NOT NULL GROUP BY board, bin")
add("d11_grouping_sets", lambda s, d: rounded(labelled(s, d).where("y IS NOT NULL").withColumn("year", F.year("date")).cube("year", "board").agg(F.count("*").alias("n"), F.avg("y").alias("rate")), ["rate"], ("year", "board", "n")), RET + LABELS + ", b AS (SELECT *, YEAR(date) AS year FROM u WHERE y IS NOT NULL) SELECT year, board, COUNT(*) AS n, " + r6("AVG(y)", "rate") + " FROM b GROUP BY CUBE (year, board)")
add("d13_quantiles", lambda s, d: rounded(returns(s, d).groupBy("board").agg(*(F.percentile("r", F.lit(q / 100)).alias(f"q{q}") for q in (10, 25, 50, 75, 90))), [f"q{q}" for q in (10, 25, 50, 75, 90)], ("board",)), RET + rounded_sql({f"q{q}": f"QUANTILE_CONT(r, {q / 100})" for q in (10, 25, 50, 75, 90)}, "p GROUP BY board", "board"))
add("d14_event_days", lambda s, d: panels.notices(s, d).groupBy("code", "date").agg(F.count("*").alias("n"), F.max("size").alias("largest"), F.min("kind").alias("first_kind")), " SELECT code, date, COUNT(*) AS n, MAX(size) AS largest, MIN(kind) AS first_kind FROM notices GROUP BY code, date", NOTICES)
add("d15_rank_correlation_by_month", lambda s, d: rounded(series.spearman(labelled(s, d).withColumn("month", F.trunc("date", "month")), "r20", "rise", "month"), ["rho"], ("month", "n")), RET + LABELS + ", m AS (SELECT CAST(date_trunc('month', date) AS DATE) AS month, r20 AS a, rise AS b FROM u WHERE r20 IS NOT NULL AND rise IS NOT NULL), k AS (SELECT month, " + ", ".join(f"(RANK() OVER (PARTITION BY month ORDER BY {c}) + (COUNT(*) OVER (PARTITION BY month, {c}) - 1) / 2.0) / COUNT(*) OVER (PARTITION BY month) AS {c}" for c in "ab") + " FROM m) SELECT month, COUNT(*) AS n, " + r6("COVAR_POP(a, b) / NULLIF(STDDEV_POP(a) * STDDEV_POP(b), 0)", "rho") + " FROM k GROUP BY month")
add("d17_auc_by_month", lambda s, d: rounded(series.auc(labelled(s, d).withColumn("month", F.trunc("date", "month")), "r20", "y", "month"), ["auc"], ("month", "n", "pos")), RET + LABELS + ", m AS (SELECT CAST(date_trunc('month', date) AS DATE) AS month, r20 AS a, y FROM u WHERE r20 IS NOT NULL AND y IS NOT NULL), k AS (SELECT *, RANK() OVER (PARTITION BY month ORDER BY a) + (COUNT(*) OVER (PARTITION BY month, a) - 1) / 2.0 AS r FROM m), g AS (SELECT month, COUNT(*) AS n, SUM(y) AS pos, SUM(CASE WHEN y = 1 THEN r ELSE 0 END) AS s FROM k GROUP BY month) SELECT month, n, CAST(pos AS BIGINT) AS pos, " + r6("(s - pos * (pos + 1) / CAST(2 AS DOUBLE)) / NULLIF(CAST(pos * (n - pos) AS DOUBLE), 0)", "auc") + " FROM g")
add("d19_robust_label", lambda s, d: rounded(cs.robust_z(labelled(s, d).withColumn("month", F.trunc("date", "month")), "rise", "month", 20), ["rise_robust"]), RET + LABELS + ", m AS (SELECT *, CAST(date_trunc('month', date) AS DATE) AS month FROM u), s AS (SELECT month, QUANTILE_CONT(rise, 0.5) AS mid, QUANTILE_CONT(rise, 0.01) AS lo, QUANTILE_CONT(rise, 0.99) AS hi FROM m GROUP BY month HAVING COUNT(rise) >= 20), j AS (SELECT m.*, mid, lo, hi FROM m JOIN s ON m.month = s.month), a AS (SELECT month, QUANTILE_CONT(ABS(rise - mid), 0.5) AS mad FROM j GROUP BY month)" + rounded_sql({"rise_robust": "(LEAST(GREATEST(rise, lo), hi) - mid) / NULLIF(1.4826 * mad, 0)"}, "j JOIN a ON j.month = a.month"))
add("d20_expanding_gate", lambda s, d: (lambda m: rounded(m.withColumn("gate", F.percentile("v", F.lit(0.5)).over(cs.Window.orderBy("month").rowsBetween(cs.Window.unboundedPreceding, -1))), ["v", "gate"], ("month",)))(returns(s, d).groupBy(F.trunc("date", "month").alias("month")).agg(F.stddev_samp("r").alias("v"))), RET + ", m AS (SELECT CAST(date_trunc('month', date) AS DATE) AS month, STDDEV_SAMP(r) AS v FROM p GROUP BY 1)" + rounded_sql({"v": "v", "gate": "QUANTILE_CONT(v, 0.5) OVER (ORDER BY month ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)"}, "m", "month"))
# cross-section
add("j01_rank_share", lambda s, d: rounded(returns(s, d).withColumn("rk", cs.pct_rank("r20", "date")), ["rk"]), RET + rounded_sql({"rk": tied("r20")}, "p"))
add("e07_relative_strength", lambda s, d: rounded(returns(s, d).select("*", cs.pct_rank("r20", "date").alias("rs20"), cs.pct_rank("r60", "date").alias("rs60")).withColumn("accel", F.col("rs20") - F.col("rs60")), ["rs20", "rs60", "accel"]), RET + f", k AS (SELECT *, {tied('r20')} AS a, {tied('r60')} AS b FROM p)" + rounded_sql({"rs20": "a", "rs60": "b", "accel": "a - b"}, "k"))
BIN5 = "CASE WHEN amount IS NOT NULL THEN GREATEST(CAST(CEIL((ROW_NUMBER() OVER (PARTITION BY date ORDER BY amount NULLS LAST, code) - 1) * 5 / NULLIF(CAST(COUNT(amount) OVER (PARTITION BY date) - 1 AS DOUBLE), 0)) AS BIGINT) - 1, 0) END"
add("j02_neutral_by_segment_and_size", lambda s, d: rounded(cs.neutral(returns(s, d).withColumn("bin", cs.quantile_bin("amount", 5, "date")), "r20", "date", "board", "bin"), ["r20_neutral"]), RET + f", b AS (SELECT *, {BIN5} AS bin FROM p)" + rounded_sql({"r20_neutral": "r20 - AVG(r20) OVER (PARTITION BY date, board, bin)"}, "b"))
add("j05_eligible_z", lambda s, d: rounded(cs.eligible_z(returns(s, d), "r20", F.col("volume") >= 25, "date"), ["r20_z"]), RET + rounded_sql({"r20_z": "(r20 - AVG(CASE WHEN volume >= 25 THEN r20 END) OVER (PARTITION BY date)) / NULLIF(STDDEV_SAMP(CASE WHEN volume >= 25 THEN r20 END) OVER (PARTITION BY date), 0)"}, "p"))
add("j06_sector_medians", lambda s, d: rounded(returns(s, d).groupBy("date", "sector").agg(F.percentile("r", F.lit(0.5)).alias("mid"), F.avg((F.col("r") > 0).cast("double")).alias("up")), ["mid", "up"], ("date", "sector")), RET + rounded_sql({"mid": "QUANTILE_CONT(r, 0.5)", "up": "AVG(CAST(r > 0 AS DOUBLE))"}, "p GROUP BY date, sector", "date, sector"))
add("j07_terciles", lambda s, d: returns(s, d).select("code", "date", cs.terciles("r20", "date").alias("third")), RET + f", k AS (SELECT *, {tied('r20')} AS a FROM p) SELECT code, date, CASE WHEN a > CAST(2 AS DOUBLE) / 3 THEN 'hi' WHEN a <= CAST(1 AS DOUBLE) / 3 THEN 'lo' WHEN a IS NOT NULL THEN 'mid' END AS third FROM k")
# labels
add("h01_label_up", lambda s, d: rounded(labels.first_days(labelled(s, d)), ["rise"], ("code", "date", "y", "first")), RET + LABELS + f" SELECT code, date, y, COALESCE(CAST(y = 1 AND COALESCE({lag('y')}, 0) <> 1 AS INT), CASE WHEN y IS NULL AND COALESCE({lag('y')}, 0) = 1 THEN 0 END) AS first, " + r6("rise", "rise") + " FROM u")
add("h04_label_buyable", lambda s, d: rounded(labels.label_buyable(panel(s, d)), ["rise_open"], ("code", "date", "y_open")), f", q AS (SELECT *, LEAD(open) OVER ({BY}) AS o1, LEAD(low) OVER ({BY}) AS l1, CASE WHEN COUNT(high) {ahead(20)} = 20 THEN MAX(high) {ahead(20)} END AS h FROM panel) SELECT code, date, CASE WHEN h IS NOT NULL THEN CAST(h / o1 - 1 > 0.3 AND NOT l1 >= close * (1 + 0.045) AS INT) END AS y_open, " + r6("h / o1 - 1", "rise_open") + " FROM q")
add("h05_path_risk", lambda s, d: rounded(labels.path_risk(panel(s, d)), ["fall"], ("code", "date", "y_safe")), f", q AS (SELECT *, LIST(low) {ahead(20)} AS ls, LIST(high) {ahead(20)} AS hs FROM panel), t AS (SELECT *, CASE WHEN len(hs) = 20 THEN list_min(ls[1:list_position(hs, list_max(hs))]) / close - 1 END AS fall FROM q) SELECT code, date, CASE WHEN fall IS NOT NULL THEN CAST(list_max(hs) / close - 1 > 0.3 AND fall > -0.15 AS INT) END AS y_safe, " + r6("fall", "fall") + " FROM t")
add("h06_continuation", lambda s, d: rounded(labels.continuation(panel(s, d)), ["next_day"], ("code", "date", "cont")), f" SELECT code, date, CASE WHEN COUNT(high) {ahead(10)} = 10 THEN CAST(MAX(high) {ahead(10)} / LEAD(open) OVER ({BY}) - 1 >= 0.15 AS INT) END AS cont, " + r6(f"LEAD(close) OVER ({BY}) / LEAD(open) OVER ({BY}) - 1", "next_day") + " FROM panel")
add("h12_forward_of_events", lambda s, d: rounded(labels.forward(returns(s, d).where("r >= 0.045").select("code", "date"), panel(s, d)), ["max_up", "ret"], ("code", "date", "n_after")), RET + f", f AS (SELECT code, date, COUNT(high) {ahead(20)} AS n_after, MAX(high) {ahead(20)} / close - 1 AS m, LAST(close) {ahead(20)} / close - 1 AS x FROM panel) SELECT f.code, f.date, n_after, " + r6("m", "max_up") + ", " + r6("x", "ret") + " FROM f JOIN p ON p.code = f.code AND p.date = f.date WHERE r >= 0.045")
# lists
PICKS = ", k AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY date ORDER BY ROUND(r20, 9) DESC, code) AS rank FROM p WHERE r20 IS NOT NULL)"


def picks(s, d, n):
    return cs.top(returns(s, d).where("r20 IS NOT NULL"), n, [F.round("r20", 9).desc(), F.col("code")], "date")


add("f02_pick_days", lambda s, d: rounded(picks(s, d, 10), ["r20"], ("date", "code", "rank")), RET + PICKS + " SELECT date, code, rank, " + r6("r20", "r20") + " FROM k WHERE rank <= 10")
add("f06_rank_after_exclusion", lambda s, d: cs.top(returns(s, d).where("r20 IS NOT NULL").join(panels.notices(s, d).where("kind = '1-URGENT'").select("code", "date").distinct(), ["code", "date"], "left_anti"), 5, [F.round("r20", 9).desc(), F.col("code")], "date").select("date", "code", "rank"), RET + ", k AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY date ORDER BY ROUND(r20, 9) DESC, code) AS rank FROM p WHERE r20 IS NOT NULL AND NOT EXISTS (SELECT 1 FROM notices n WHERE n.code = p.code AND n.date = p.date AND n.kind = '1-URGENT')) SELECT date, code, rank FROM k WHERE rank <= 5", NOTICES)
add("f09_latest_rows", lambda s, d: cs.top(panel(s, d), 21, [F.col("date").desc()], "code").select("code", "date", "rank", "close"), " SELECT code, date, rank, close FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY code ORDER BY date DESC) AS rank FROM panel) WHERE rank <= 21")
add("f03_score_scale", lambda s, d: (lambda x: x.crossJoin(F.broadcast(x.agg(F.percentile("r20", F.array(*(F.lit(i / 100) for i in range(101)))).alias("q")))).select("code", "date", scalars.score_on(F.col("q"), F.col("r20")).alias("score")))(returns(s, d).where("r20 IS NOT NULL")), RET + ", q AS (SELECT QUANTILE_CONT(r20, [" + ", ".join(f"{i / 100}" for i in range(101)) + "]) AS q FROM p WHERE r20 IS NOT NULL) SELECT code, date, CAST(LEAST(100, len(list_filter(q, lambda x: x < r20))) AS DOUBLE) AS score FROM p, q WHERE r20 IS NOT NULL")
add("c19_list_overlap", lambda s, d: rounded(series.overlap(picks(s, d, 10)), ["jaccard"], ("date",)), RET + PICKS + ", l AS (SELECT date, LIST(code) AS s FROM k WHERE rank <= 10 GROUP BY date), b AS (SELECT *, LAG(s) OVER (ORDER BY date) AS t FROM l)" + rounded_sql({"jaccard": "len(list_intersect(s, t)) / CAST(len(list_distinct(list_concat(s, t))) AS DOUBLE)"}, "b WHERE t IS NOT NULL", "date"))
# sets
add("g02_last_by_key", lambda s, d: cs.last_by(panels.notices(s, d), ["code", "kind"], [F.col("date").desc(), F.col("notice_id").desc()]).select("code", "kind", "notice_id", "date"), " SELECT code, kind, notice_id, date FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY code, kind ORDER BY date DESC, notice_id DESC) AS n FROM notices) WHERE n = 1", NOTICES)
add("g03_key_differences", lambda s, d: (lambda a, b: a.withColumn("a", F.lit(1)).join(b.withColumn("b", F.lit(1)), ["code", "date"], "outer").groupBy(F.coalesce("a", F.lit(0)).alias("in_panel"), F.coalesce("b", F.lit(0)).alias("in_notices")).agg(F.count("*").alias("n")))(panel(s, d).select("code", "date"), panels.notices(s, d).select("code", "date").distinct()), ", a AS (SELECT code, date FROM panel), b AS (SELECT DISTINCT code, date FROM notices) SELECT CAST(a.code IS NOT NULL AS INT) AS in_panel, CAST(b.code IS NOT NULL AS INT) AS in_notices, COUNT(*) AS n FROM a FULL JOIN b ON a.code = b.code AND a.date = b.date GROUP BY 1, 2", NOTICES)
add("g05_calendar_reindex", lambda s, d: (lambda m, p: m.join(p.where("r >= 0.08").groupBy(F.trunc("date", "month").alias("month")).agg(F.count("*").alias("n")), "month", "left").select("month", F.coalesce("n", F.lit(0)).alias("n")))(panel(s, d).select(F.trunc("date", "month").alias("month")).distinct(), returns(s, d)), RET + ", m AS (SELECT DISTINCT CAST(date_trunc('month', date) AS DATE) AS month FROM panel) SELECT m.month, COUNT(p.code) AS n FROM m LEFT JOIN p ON CAST(date_trunc('month', p.date) AS DATE) = m.month AND r >= 0.08 GROUP BY m.month", )
# series
DAYS = ", s AS (SELECT board AS series, date, AVG(r) AS d FROM p WHERE r IS NOT NULL GROUP BY 1, 2)"


def day_series(s, d):
    return returns(s, d).where("r IS NOT NULL").groupBy(F.col("board").alias("series"), "date").agg(F.avg("r").alias("d"))


add("l01_newey_west", lambda s, d: rounded(series.newey_west(day_series(s, d)), ["mean", "se", "t"], ("series", "n")), RET + DAYS + ", e AS (SELECT *, d - AVG(d) OVER (PARTITION BY series) AS e FROM s), g AS (SELECT series, d, e * e + " + " + ".join(f"{2 * (1 - k / 21)} * COALESCE(e * LAG(e, {k}) OVER (PARTITION BY series ORDER BY date), 0)" for k in range(1, 21)) + " AS g FROM e), h AS (SELECT series, COUNT(*) AS n, AVG(d) AS mean, CASE WHEN COUNT(*) >= 23 AND SUM(g) > 0 THEN SQRT(SUM(g)) / COUNT(*) END AS se FROM g GROUP BY series)" + rounded_sql({"mean": "mean", "se": "se", "t": "mean / se"}, "h", "series, n"))
add("l02_autocorrelations", lambda s, d: rounded(series.autocorrelations(day_series(s, d), 5), ["acf"], ("series", "lag")), RET + DAYS + ", e AS (SELECT *, d - AVG(d) OVER (PARTITION BY series) AS e FROM s), g AS (" + " UNION ALL ".join(f"SELECT series, {k} AS lag, e * e AS v, e * LAG(e, {k}) OVER (PARTITION BY series ORDER BY date) AS c FROM e" for k in range(1, 6)) + ")" + rounded_sql({"acf": "SUM(c) / NULLIF(SUM(v), 0)"}, "g GROUP BY series, lag", "series, lag"))
add("l09_multiple_tests", lambda s, d: rounded(series.adjusted(returns(s, d).where("r IS NOT NULL").groupBy("sector").agg(F.exp(-F.abs(F.avg("r")) * 2000).alias("p")), "p", "sector"), ["p", "bonferroni", "holm", "bh"], ("sector",)), RET + ", t AS (SELECT sector, EXP(-ABS(AVG(r)) * 2000) AS p FROM p WHERE r IS NOT NULL GROUP BY sector), k AS (SELECT *, ROW_NUMBER() OVER (ORDER BY p, sector) AS i, COUNT(*) OVER () AS n FROM t)" + rounded_sql({"p": "p", "bonferroni": "LEAST(p * n, 1)", "holm": "MAX(LEAST(p * (n - i + 1), 1)) OVER (ORDER BY i)", "bh": "MIN(LEAST(p * n / i, 1)) OVER (ORDER BY i ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)"}, "k", "sector"))
