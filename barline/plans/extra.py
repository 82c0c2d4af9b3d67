"""Queries of the further families and list statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from barline.operators import crosssection as cs
from barline.operators import families as fam
from barline.operators import intraday, labels
from barline.plans.helpers import BY, full, lag, rounded, rounded_sql, win
from barline.plans.panels import LABELS, PICKS, RET, labelled, r6, returns, tied
from barline.sources import panels
from barline.sources.panels import BARS, DUCK_TICKS, NOTICES, duck, panel

QUERIES: dict = {}
ORACLE_SQL: dict = {}


def add(name: str, query, sql: str, *parts: str) -> None:
    QUERIES[name] = query
    ORACLE_SQL[name] = duck(*(parts or (BARS,))) + sql


FLAGS = f", f0 AS (SELECT *, {lag('close')} AS pc FROM panel), f1 AS (SELECT *, close / pc - 1 AS r, COALESCE(close / pc - 1 >= 0.045 AND close >= high, FALSE) AS u FROM f0), f AS (SELECT *, CAST(u AS INT) AS lu, CAST(COALESCE(high / pc - 1 >= 0.045 AND NOT u, FALSE) AS INT) AS zb, CAST(COALESCE(close / pc - 1 <= -0.045, FALSE) AS INT) AS ld, CAST(COALESCE(low / pc - 1 >= 0.045, FALSE) AS INT) AS one_word FROM f1)"
add("e12_limit_flags", lambda s, d: fam.limit_flags(panel(s, d)).select("code", "date", "lu", "zb", "ld", "one_word"), FLAGS + " SELECT code, date, lu, zb, ld, one_word FROM f")
add("d02_sentiment_days", lambda s, d: rounded(fam.sentiment_days(fam.limit_flags(panel(s, d))), ["zb_rate", "prev_lu_ret", "promoted"], ("date", "n_lu", "n_zb", "n_ld")), FLAGS + f", g AS (SELECT *, LAG(lu) OVER ({BY}) AS l1 FROM f), h AS (SELECT date, CAST(SUM(lu) AS BIGINT) AS n_lu, CAST(SUM(zb) AS BIGINT) AS n_zb, CAST(SUM(ld) AS BIGINT) AS n_ld, AVG(CASE WHEN l1 = 1 THEN r END) AS prev_lu_ret, AVG(CASE WHEN l1 = 1 THEN CAST(lu AS DOUBLE) END) AS promoted FROM g GROUP BY date)" + rounded_sql({"zb_rate": "n_zb / NULLIF(CAST(n_lu + n_zb AS DOUBLE), 0)", "prev_lu_ret": "prev_lu_ret", "promoted": "promoted"}, "h", "date, n_lu, n_zb, n_ld"))
BOX = lambda n: f"(({full('MAX(high)', 'close', n)}) / ({full('MIN(low)', 'close', n)}) - 1)"


def local(name: str, operator, sql: dict[str, str], steps: str = "", source: str = "panel") -> None:
    QUERIES[name] = lambda spark, sf_dir: rounded(operator(panel(spark, sf_dir)), list(sql))
    ORACLE_SQL[name] = duck(BARS) + steps + rounded_sql(sql, source)


local("e25_contraction", fam.contraction, {"std5_60": f"({full('STDDEV_POP(r)', 'r', 5)}) / NULLIF(({full('STDDEV_POP(r)', 'r', 60)}), 0)", "box20_120": f"{BOX(20)} / NULLIF({BOX(120)}, 0)", "break20": f"close / ({full('MAX(high)', 'close', 20, 1)}) - 1", "break60": f"close / ({full('MAX(high)', 'close', 60, 1)}) - 1"}, RET, "p")
local("e26_horizons", lambda p: fam.horizons(p.select("code", "date", "close", "high", "low")), {k: v for n in (120, 250) for k, v in {f"to_high{n}": f"close / ({full('MAX(high)', 'close', n)}) - 1", f"to_low{n}": f"close / ({full('MIN(low)', 'close', n)}) - 1", f"since_high{n}": f"CASE WHEN COUNT(close) {win(n)} = {n} THEN t - (MAX(ROW(high, t)) {win(n)})[2] END"}.items()}, f", p AS (SELECT *, ROW_NUMBER() OVER ({BY}) AS t FROM panel)", "p")
local("e31_residual_momentum", fam.residual_momentum, {"beta": "beta", "res20": f"CASE WHEN beta IS NOT NULL THEN SUM(r) {win(20)} - beta * SUM(m) {win(20)} END"}, RET + f", q AS (SELECT *, AVG(r) OVER (PARTITION BY date) AS m FROM p), b AS (SELECT *, CASE WHEN COUNT(r) {win(60)} = 60 THEN COVAR_POP(r, m) {win(60)} / NULLIF(VAR_POP(m) {win(60)}, 0) END AS beta FROM q)", "b")
add("e36_industry_block", lambda s, d: rounded(fam.industry_block(panel(s, d)), ["mid", "large5", "place"], ("date", "sector", "n")), RET + ", g AS (SELECT date, sector, COUNT(*) AS n, QUANTILE_CONT(r, 0.5) AS mid, COALESCE(SUM(CAST(r >= 0.045 AS INT)), 0) AS large, COUNT(r) AS k FROM p GROUP BY 1, 2), h AS (SELECT *, SUM(CASE WHEN k > 0 THEN large END) OVER v / SUM(n) OVER v AS large5 FROM g WINDOW v AS (PARTITION BY sector ORDER BY date ROWS BETWEEN 4 PRECEDING AND CURRENT ROW))" + rounded_sql({"mid": "mid", "large5": "large5", "place": tied("mid")}, "h", "date, sector, n"))
local("e37_event_history", lambda d: fam.event_history(d.withColumn("_g", F.col("close") / F.lag("close").over(cs.Window.partitionBy("code").orderBy("date")) - 1), F.col("_g") >= 0.045), {"events": f"COALESCE(SUM(f) {win(250, 21)}, 0)", "since_event": f"LEAST(600, COALESCE(t - MAX(CASE WHEN f = 1 THEN t END) OVER ({BY} ROWS BETWEEN UNBOUNDED PRECEDING AND 21 PRECEDING), 600))"}, RET + f", q AS (SELECT *, COALESCE(CAST(r >= 0.045 AS INT), 0) AS f, ROW_NUMBER() OVER ({BY}) AS t FROM p)", "q")
local("j03_interactions", lambda d: fam.interactions(d.select("*", cs.pct_rank("volume", "date").alias("a"), cs.pct_rank("amount", "date").alias("b")), [("a", 1, "b", -1)]), {"a_and_b": f"LEAST({tied('volume')}, -({tied('amount')}))"})
local("j04_rank_to_unit", lambda d: d.withColumn("u", 2 * cs.pct_rank("amount", "date") - 1), {"u": f"2 * ({tied('amount')}) - 1"})
add(
    "h03_label_top",
    lambda s, d: fam.label_top(labelled(s, d)).select("code", "date", F.col("top").cast("double").alias("top")),
    RET + LABELS + f""", t AS (SELECT *, ROW_NUMBER() OVER ({BY}) AS t, COUNT(*) OVER (PARTITION BY code) AS n, COALESCE({lag("y")}, 0) AS y1 FROM u),
    s AS (SELECT a.code, a.t AS t0, MIN(LEAST(a.t + 59, a.n)) AS t1, (MIN(ROW(-b.high, b.t)))[2] AS top, MAX(b.high) AS peak FROM t a JOIN t b ON a.code = b.code AND b.t BETWEEN a.t AND a.t + 59 WHERE a.y = 1 AND a.y1 <> 1 GROUP BY 1, 2),
    m AS (SELECT DISTINCT s.code, s.top FROM s JOIN t c ON c.code = s.code AND c.t > s.top AND c.t <= s.t1 AND c.close < s.peak * (1 - 0.2) WHERE t1 - t0 >= 2),
    k AS (SELECT code, top AS t FROM m UNION SELECT code, top - 1 FROM m)
    SELECT t.code, t.date, CASE WHEN t.t > t.n - 20 THEN NULL WHEN k.t IS NOT NULL THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS top FROM t LEFT JOIN k ON k.code = t.code AND k.t = t.t""",
)
add("h02_first_days", lambda s, d: labels.first_days(labelled(s, d)).where("first = 1").select("code", "date"), RET + LABELS + f", z1 AS (SELECT *, COALESCE({lag('y')}, 0) AS y1 FROM u) SELECT code, date FROM z1 WHERE y = 1 AND y1 <> 1")
add("f04_rolling_scale", lambda s, d: rounded(fam.rolling_scale(returns(s, d), "r20"), ["mid"], ("date", "n")), RET + ", d AS (SELECT DISTINCT date FROM panel) SELECT d.date, COUNT(r20) AS n, " + r6("QUANTILE_CONT(r20, 0.5)", "mid") + " FROM d LEFT JOIN p ON p.date < d.date AND p.date >= d.date - 60 AND r20 IS NOT NULL GROUP BY d.date")
add("f07_multi_key_rank", lambda s, d: cs.top(returns(s, d).where("r >= 0.045").withColumn("big", (F.col("volume") > 30).cast("int")), 3, [F.col("big").desc(), F.col("volume").desc(), F.round("r", 9).desc(), F.col("code")], "date").select("date", "code", "rank"), RET + " SELECT date, code, rank FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY date ORDER BY CAST(volume > 30 AS INT) DESC, volume DESC, ROUND(r, 9) DESC, code) AS rank FROM p WHERE r >= 0.045) WHERE rank <= 3")
add("f08_top_of_groups", lambda s, d: cs.top(panel(s, d), 2, [F.col("amount").desc(), F.col("code")], "date", "board").select("date", "board", "code", "rank"), " SELECT date, board, code, rank FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY date, board ORDER BY amount DESC, code) AS rank FROM panel) WHERE rank <= 2")
add("g01_union_by_name", lambda s, d: panel(s, d).select("code", "date", "volume").unionByName(panels.notices(s, d).select("date", "code", "kind"), allowMissingColumns=True).groupBy("code").agg(F.count("*").alias("n"), F.count("kind").alias("kinds"), F.sum("volume").alias("volume")), " , u AS (SELECT code, date, volume, NULL AS kind FROM panel UNION ALL BY NAME SELECT date, code, kind FROM notices) SELECT code, COUNT(*) AS n, COUNT(kind) AS kinds, SUM(volume) AS volume FROM u GROUP BY code", BARS, NOTICES)
add("g04_calendar", lambda s, d: panel(s, d).select("date").distinct(), " SELECT DISTINCT date FROM panel")
add("l13_rank_decay", lambda s, d: rounded(fam.rank_decay(cs.top(labelled(s, d).where("r20 IS NOT NULL"), 200, [F.round("r20", 9).desc(), F.col("code")], "date")), ["rate"], ("bucket", "n")), RET + LABELS + PICKS.replace("FROM p WHERE", "FROM u WHERE") + " SELECT CASE WHEN rank <= 3 THEN '01-03' WHEN rank <= 10 THEN '04-10' WHEN rank <= 20 THEN '11-20' WHEN rank <= 50 THEN '21-50' ELSE '51-' END AS bucket, COUNT(*) AS n, " + r6("AVG(y)", "rate") + " FROM k WHERE y IS NOT NULL AND rank <= 200 GROUP BY 1")
add(
    "l15_conformal",
    lambda s, d: rounded(fam.conformal(labelled(s, d).withColumn("s", F.round("r20", 9)), "s", "y").withColumn("selected", F.col("selected").cast("double")), ["p", "selected"]),
    RET + LABELS + f""", a AS (SELECT code, date, y, ROUND(r20, 9) AS s, LEAD(date, 20) OVER ({BY}) AS closed, CAST(date_trunc('month', date) AS DATE) AS own FROM (SELECT * FROM u WHERE r20 IS NOT NULL OR y IS NOT NULL)),
    ms AS (SELECT DISTINCT own AS month FROM a), ng AS (SELECT month, s, COUNT(*) AS k FROM a JOIN ms ON closed < month AND own >= month - INTERVAL 12 MONTH WHERE y = 0 AND s IS NOT NULL AND closed IS NOT NULL GROUP BY month, s),
    al AS (SELECT month, SUM(k) AS n0 FROM ng GROUP BY month), aq AS (SELECT own AS month, s, 0 AS k FROM a WHERE s IS NOT NULL GROUP BY 1, 2),
    cu AS (SELECT month, s, SUM(SUM(k)) OVER (PARTITION BY month ORDER BY s DESC) AS above FROM (SELECT * FROM ng UNION ALL SELECT * FROM aq) GROUP BY month, s),
    pp AS (SELECT code, date, CASE WHEN n0 > 0 THEN (1 + above) / CAST(n0 + 1 AS DOUBLE) END AS p FROM a JOIN cu ON cu.month = a.own AND cu.s = a.s LEFT JOIN al ON al.month = a.own),
    rk AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY date ORDER BY p NULLS LAST, code) AS r, COUNT(p) OVER (PARTITION BY date) AS n FROM pp), sl AS (SELECT *, MAX(CASE WHEN p <= CAST(0.1 AS DOUBLE) * r / n THEN r END) OVER (PARTITION BY date) AS last FROM rk)"""
    + rounded_sql({"p": "p", "selected": "CASE WHEN p IS NOT NULL THEN CAST(COALESCE(r <= last, FALSE) AS INT) END"}, "sl"),
)
add("l19_credibility", lambda s, d: rounded(fam.credibility(labelled(s, d), "turnover", "y"), ["cred"]), RET + LABELS + rounded_sql({"cred": "COALESCE(SUM(y - turnover) OVER v, 0) / (COUNT(y - turnover) OVER v + 20)"}, f"u WINDOW v AS ({BY} ROWS BETWEEN UNBOUNDED PRECEDING AND 21 PRECEDING)"))
add("l24_softmax_excess", lambda s, d: rounded(fam.softmax_excess(labelled(s, d), "r20", "rise"), ["excess"], ("date",)), RET + LABELS + ", e AS (SELECT *, EXP((r20 - MAX(r20) OVER (PARTITION BY date)) / 0.1) AS e FROM u WHERE r20 IS NOT NULL AND rise IS NOT NULL)" + rounded_sql({"excess": "SUM(e * rise) / SUM(e) - AVG(rise)"}, "e GROUP BY date", "date"))
add("m01_event_shares", lambda s, d: rounded(fam.event_shares(panel(s, d), panels.notices(s, d), "size"), ["n5", "share5", "n20", "share20"], ("code", "date", "today")), ", e AS (SELECT code, date, COUNT(*) AS n, SUM(size) AS v FROM notices GROUP BY 1, 2), q AS (SELECT p.*, COALESCE(e.n, 0) AS n, COALESCE(v, 0) AS v FROM panel p LEFT JOIN e ON e.code = p.code AND e.date = p.date)" + rounded_sql({k: x for n in (5, 20) for k, x in {f"n{n}": f"SUM(n) {win(n)}", f"share{n}": f"SUM(v) {win(n)} / SUM(amount) {win(n)}"}.items()}, "q", "code, date, CAST(n > 0 AS INT) AS today"), BARS, NOTICES)
POINTS = ", x AS (SELECT code, CAST(ts AS DATE) AS date, ts, event_id, price, h, epoch_us(ts) / 1e6 - epoch(CAST(CAST(ts AS DATE) AS TIMESTAMP)) - h * 3600 AS late FROM ticks, (SELECT UNNEST([0, 6, 12, 18]) AS h)), y AS (SELECT code, date, h, (MIN(ROW(ts, event_id, price)))[3] AS price FROM x WHERE late >= 0 AND late <= 7200 GROUP BY 1, 2, 3), pt AS (SELECT code, date, " + ", ".join(f"MAX(CASE WHEN h = {h} THEN price END) AS at{h}" for h in (0, 6, 12, 18)) + " FROM y GROUP BY 1, 2)"
GAP, SLOPE = "(at12 / prev - 1)", "((at12 - at0) / prev)"
add("p03_snapshot_scores", lambda s, d: rounded(fam.snapshot_scores(intraday.samples(panels.ticks(s, d), [0, 6, 12, 18], 7200), panels.ticks(s, d).groupBy("code").agg(F.avg("price").alias("prev"))), ["gap", "slope"], ("code", "date", "rising")), POINTS + ", v AS (SELECT code, AVG(price) AS prev FROM ticks GROUP BY code)" + rounded_sql({"gap": GAP, "slope": SLOPE}, "pt JOIN v ON v.code = pt.code WHERE at0 IS NOT NULL AND at12 IS NOT NULL", "pt.code, date, CAST(at0 <= COALESCE(at6, at0) AND COALESCE(at6, at0) <= at12 AS INT) AS rising"), DUCK_TICKS)
add("c01_label_left_join", lambda s, d: rounded(panel(s, d).select("code", "date").join(labelled(s, d).where("y IS NOT NULL").select("code", "date", "rise"), ["code", "date"], "left"), ["rise"]), RET + LABELS + " SELECT code, date, " + r6("CASE WHEN y IS NOT NULL THEN rise END", "rise") + " FROM u")
add("c02_join_coverage", lambda s, d: (lambda a, b: rounded(a.join(b.withColumn("_l", F.lit(1)), ["code", "date"], "left").groupBy("code").agg(F.count("*").alias("n"), F.avg(F.coalesce(F.col("_l").cast("double"), F.lit(0.0))).alias("covered")), ["covered"], ("code", "n")))(panel(s, d).select("code", "date"), panels.notices(s, d).select("code", "date").distinct()), ", b AS (SELECT DISTINCT code, date FROM notices) SELECT p.code, COUNT(*) AS n, " + r6("AVG(CASE WHEN b.code IS NULL THEN 0.0 ELSE 1.0 END)", "covered") + " FROM panel p LEFT JOIN b ON b.code = p.code AND b.date = p.date GROUP BY p.code", BARS, NOTICES)
add("c03_outer_join_of_sides", lambda s, d: (lambda n: n.where("kind IN ('1-URGENT', '2-HIGH')").groupBy("code", "date").agg(F.count("*").alias("buys")).join(n.where("kind = '5-LOW'").groupBy("code", "date").agg(F.count("*").alias("sells")), ["code", "date"], "outer").select("code", "date", F.coalesce("buys", F.lit(0)).alias("buys"), F.coalesce("sells", F.lit(0)).alias("sells")))(panels.notices(s, d)), ", g AS (SELECT code, date, COUNT(*) FILTER (kind IN ('1-URGENT', '2-HIGH')) AS buys, COUNT(*) FILTER (kind = '5-LOW') AS sells FROM notices GROUP BY code, date) SELECT * FROM g WHERE buys + sells > 0", BARS, NOTICES)
add("c12_events_in_a_range", lambda s, d: panels.notices(s, d).where("date BETWEEN DATE'1998-01-01' AND DATE'1998-06-30'").groupBy("code", "kind").agg(F.count("*").alias("n"), F.max("date").alias("last")), " SELECT code, kind, COUNT(*) AS n, MAX(date) AS last FROM notices WHERE date BETWEEN DATE '1998-01-01' AND DATE '1998-06-30' GROUP BY code, kind", BARS, NOTICES)
add("f05_rank_table", lambda s, d: cs.top(returns(s, d).where("r20 IS NOT NULL AND volume >= 20"), 200, [F.round("r20", 9).desc(), F.col("code")], "date").select("date", "code", "rank"), RET + PICKS.replace("r20 IS NOT NULL)", "r20 IS NOT NULL AND volume >= 20)") + " SELECT date, code, rank FROM k WHERE rank <= 200")
add("h07_label_variants", lambda s, d: rounded(labelled(s, d).select("code", "date", F.greatest(F.col("rise") - 0.2, F.lit(0.0)).alias("hinge"), F.log1p("rise").alias("soft"), (F.col("rise") >= F.percentile("rise", F.lit(0.9)).over(cs.Window.partitionBy("date"))).cast("double").alias("top_of_day")).where("soft IS NOT NULL"), ["hinge", "soft", "top_of_day"]), RET + LABELS + ", q AS (SELECT *, QUANTILE_CONT(rise, 0.9) OVER (PARTITION BY date) AS q9 FROM u)" + rounded_sql({"hinge": "GREATEST(rise - 0.2, 0)", "soft": "LN(1 + rise)", "top_of_day": "CAST(rise >= q9 AS DOUBLE)"}, "q WHERE rise IS NOT NULL"))
add("h11_paired_lists", lambda s, d: (lambda u: rounded(cs.top(u, 10, [F.round("r20", 9).desc(), F.col("code")], "date").groupBy("date").agg(F.avg("y").alias("a")).join(cs.top(u, 10, [F.col("amount").desc(), F.col("code")], "date").groupBy("date").agg(F.avg("y").alias("b")), "date").select("date", (F.col("a") - F.col("b")).alias("diff")), ["diff"], ("date",)))(labelled(s, d).where("y IS NOT NULL AND r20 IS NOT NULL")), RET + LABELS + ", k AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY date ORDER BY ROUND(r20, 9) DESC, code) AS ra, ROW_NUMBER() OVER (PARTITION BY date ORDER BY amount DESC, code) AS rb FROM u WHERE y IS NOT NULL AND r20 IS NOT NULL)" + rounded_sql({"diff": "AVG(CASE WHEN ra <= 10 THEN y END) - AVG(CASE WHEN rb <= 10 THEN y END)"}, "k GROUP BY date", "date"))
add("i07_signals", lambda s, d: (lambda f: f.where("lu = 1 AND h60").select("code", "date", F.lit("high").alias("kind")).unionByName(f.where("lu = 1 AND COALESCE(lu1, 0) = 1").select("code", "date", F.lit("second").alias("kind"))))(fam.limit_flags(panel(s, d)).select("*", F.lag("lu").over(cs.Window.partitionBy("code").orderBy("date")).alias("lu1"), (F.col("close") >= F.max("high").over(cs.Window.partitionBy("code").orderBy("date").rowsBetween(-59, 0))).alias("h60"))), FLAGS + f", g AS (SELECT *, LAG(lu) OVER ({BY}) AS lu1, close >= MAX(high) {win(60)} AS h60 FROM f) SELECT code, date, 'high' AS kind FROM g WHERE lu = 1 AND h60 UNION ALL SELECT code, date, 'second' FROM g WHERE lu = 1 AND COALESCE(lu1, 0) = 1")
add("l23_gated_rate", lambda s, d: (lambda u, m: rounded(u.where("y IS NOT NULL").join(m, "date").groupBy("weak").agg(F.count("*").alias("n"), F.avg("y").alias("rate")), ["rate"], ("weak", "n")))(labelled(s, d), returns(s, d).groupBy("date").agg((F.avg(F.coalesce((F.col("r") > 0).cast("double"), F.lit(0.0))) < 0.5).cast("int").alias("weak"))), RET + LABELS + ", m AS (SELECT date, CAST(AVG(COALESCE(CAST(r > 0 AS DOUBLE), 0)) < 0.5 AS INT) AS weak FROM p GROUP BY date) SELECT weak, COUNT(*) AS n, " + r6("AVG(y)", "rate") + " FROM u JOIN m ON m.date = u.date WHERE y IS NOT NULL GROUP BY weak")
