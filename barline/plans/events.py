"""Queries of event blocks, pattern states, snapshots, day statistics, and the batch form of the streaming operators."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from barline import streaming
from barline.operators import crosssection as cs
from barline.operators import intraday, joins, lists, patterns
from barline.operators import windows as w
from barline.plans.extra import POINTS
from barline.plans.helpers import BY, lag, rounded, rounded_sql, win
from barline.plans.more import LAUNCHES, PREPARED, STAYS
from barline.plans.panels import LABELS, RET, labelled, picks, r6, returns, tied
from barline.plans.rows import CHIPS
from barline.sources import panels
from barline.sources.panels import BARS, DUCK_DISCLOSURES, DUCK_TICKS, NOTICES, duck, panel
from barline.streaming import stateful

QUERIES: dict = {}
ORACLE_SQL: dict = {}


def query(name: str, sql: str, *parts: str):
    def register(function):
        QUERIES[name], ORACLE_SQL[name] = function, duck(*(parts or (BARS,))) + sql
        return function

    return register


# --- patterns -------------------------------------------------------------------------------------


@query("e38_state_since_launch", PREPARED + LAUNCHES + f", s AS (SELECT p.*, LAST_VALUE(l.pos IGNORE NULLS) OVER v AS lpos, LAST_VALUE(l.volume IGNORE NULLS) OVER v AS lv, LAST_VALUE(l.high IGNORE NULLS) OVER v AS lh FROM p LEFT JOIN l ON l.code = p.code AND l.pos = p.pos WINDOW v AS (PARTITION BY p.code ORDER BY p.date))" + rounded_sql({"days": "CASE WHEN lpos IS NOT NULL THEN LEAST(pos - lpos, 60) END", "volume_ratio": "volume / lv", "above": "CAST(close > lh AS INT)"}, "s"))
def e38(s, d):
    bars = patterns.prepared(panel(s, d))
    start = patterns.launches(bars).select("code", "pos", F.struct("pos", "volume", "high").alias("_l"))
    j = bars.join(start, ["code", "pos"], "left")
    last = F.last("_l", ignorenulls=True).over(w.by_code().rowsBetween(Window.unboundedPreceding, 0))
    j = j.withColumn("_l", last)
    out = j.select("code", "date", F.when(F.col("_l").isNotNull(), F.least(F.col("pos") - F.col("_l.pos"), F.lit(60))).alias("days"), (F.col("volume") / F.col("_l.volume")).alias("volume_ratio"), (F.col("close") > F.col("_l.high")).cast("int").alias("above"))
    return rounded(out, ["days", "volume_ratio", "above"])


EVER = ", s AS (SELECT l.code, l.date AS launch_date, l.high AS lh, l.low AS ll, l.volume AS lv, l.pos + k.step AS pos, k.step FROM l, (SELECT UNNEST(range(1, 11)) AS step) k), t AS (SELECT s.*, p.date, p.volume, SUM(CASE WHEN p.low < ll OR p.close > lh OR p.volume >= lv THEN 1 ELSE 0 END) OVER v AS bad, AVG(p.volume) OVER v AS mv FROM s JOIN p ON p.code = s.code AND p.pos = s.pos WINDOW v AS (PARTITION BY s.code, launch_date ORDER BY step))"


@query("i04_first_day_on_list_b", PREPARED + LAUNCHES + EVER + " SELECT code, launch_date, MIN(date) AS b_date FROM t WHERE bad = 0 AND step >= 2 AND mv <= 0.8 * lv GROUP BY code, launch_date")
def i04(s, d):
    return patterns.first_quiet_day(panel(s, d))


@query("i11_moves_and_notices", RET + f", m AS (SELECT code, date, close / {lag('close', 3)} - 1 >= 0.12 AS moved FROM p), n AS (SELECT DISTINCT code, date FROM notices), j AS (SELECT m.code, m.date, moved, EXISTS (SELECT 1 FROM n WHERE n.code = m.code AND n.date BETWEEN m.date AND m.date + 3) AS told FROM m WHERE moved IS NOT NULL) SELECT moved, told, COUNT(*) AS n FROM j GROUP BY 1, 2", BARS, NOTICES)
def i11(s, d):
    m = panel(s, d).select("code", "date", (w.gain(3) >= 0.12).alias("moved")).where("moved IS NOT NULL")
    told = joins.sum_between(m, panels.notices(s, d), "date", F.lit(1.0), 0, 3, "t")
    return told.groupBy("moved", (F.col("t_n") > 0).alias("told")).agg(F.count("*").alias("n"))


@query("i13_risk_reasons", ", a AS (SELECT MAX(date) AS day FROM panel), risk AS (SELECT c.code, c.sector, COUNT(*) FILTER (kind = '1-URGENT' AND n.date >= day - 30) AS cut, COUNT(*) FILTER (kind = '2-HIGH' AND n.date >= day - 60) AS placed FROM codes c CROSS JOIN a LEFT JOIN notices n ON n.code = c.code AND n.date <= day GROUP BY 1, 2) SELECT code, COALESCE(CASE WHEN contains(upper(sector), 'ST') THEN 'name' WHEN cut > 0 THEN 'reduction' WHEN placed > 0 THEN 'placement' END, 'none') AS reason FROM risk", BARS, NOTICES)
def i13(s, d):
    day = panel(s, d).agg(F.max("date").alias("day"))
    n = panels.notices(s, d).crossJoin(F.broadcast(day)).where("date <= day").groupBy("code").agg(F.count_if((F.col("kind") == "1-URGENT") & (F.col("date") >= F.date_sub("day", 30))).alias("cut"), F.count_if((F.col("kind") == "2-HIGH") & (F.col("date") >= F.date_sub("day", 60))).alias("placed"))
    reason = F.when(F.upper("sector").contains("ST"), "name").when(F.col("cut") > 0, "reduction").when(F.col("placed") > 0, "placement")
    return panels.codes(s, d).join(n, "code", "left").select("code", F.coalesce(reason, F.lit("none")).alias("reason"))


# --- event blocks ---------------------------------------------------------------------------------

BLOCK = ", e AS (SELECT code, date, COUNT(*) AS n, MAX(ROW(notice_id, size)) AS last FROM notices WHERE kind IN ('1-URGENT', '2-HIGH') GROUP BY 1, 2), q AS (SELECT p.code, p.date, p.sector, p.board, COALESCE(n, 0) AS n, last[2] AS size, CASE WHEN n > 0 THEN p.date END AS told FROM panel p LEFT JOIN e ON e.code = p.code AND e.date = p.date)"


def event_block(s, d):
    e = panels.notices(s, d).where("kind IN ('1-URGENT', '2-HIGH')").groupBy("code", "date").agg(F.count("*").alias("n"), F.max_by("size", "notice_id").alias("size"))
    return panel(s, d).join(e, ["code", "date"], "left").fillna(0, ["n"]).withColumn("at", F.when(F.col("n") > 0, F.col("date")))


@query("m03_level_and_change", ", r AS (SELECT code, period, notice + 1 AS known, holders FROM reports), j AS (SELECT p.code, p.date, (SELECT MAX(ROW(known, period, holders)) FROM r WHERE r.code = p.code AND r.known <= p.date) AS m FROM panel p), q AS (SELECT code, date, CAST(m[3] AS DOUBLE) AS x FROM j)" + rounded_sql({"level": "LN(1 + x)", "chg5": f"x / NULLIF({lag('x', 5)}, 0) - 1", "chg20": f"x / NULLIF({lag('x', 20)}, 0) - 1", "eligible": "CAST(x IS NOT NULL AS INT)"}, "q"), BARS, DUCK_DISCLOSURES)
def m03(s, d):
    """A balance known from the next session on: its level, changes over rows, and whether there is one."""
    r = panels.disclosures(s, d).withColumn("known", F.date_add("notice", 1)).withColumn("x", F.col("holders").cast("double"))
    q = joins.as_of(panel(s, d).select("code", "date"), r, "known", ["x"], "period")
    change = lambda k: F.col("x") / F.nullif(w.lag("x", k), F.lit(0.0)) - 1
    return rounded(q.select("code", "date", F.log1p("x").alias("level"), change(5).alias("chg5"), change(20).alias("chg20"), F.col("x").isNotNull().cast("int").alias("eligible")), ["level", "chg5", "chg20", "eligible"])


@query("m11_corporate_events", BLOCK + rounded_sql({"age": f"CASE WHEN LAST_VALUE(told IGNORE NULLS) OVER ({BY}) IS NOT NULL THEN LEAST(date - LAST_VALUE(told IGNORE NULLS) OVER ({BY}), 600) END", "n20": f"SUM(n) {win(20)}", "n60": f"SUM(n) {win(60)}", "last_size": f"LAST_VALUE(size IGNORE NULLS) OVER ({BY})"}, "q"), BARS, NOTICES)
def m11(s, d):
    so_far = w.by_code().rowsBetween(Window.unboundedPreceding, 0)
    last = lambda c: F.last(c, ignorenulls=True).over(so_far)
    age = F.when(last("at").isNotNull(), F.least(F.datediff("date", last("at")), F.lit(600)))
    return rounded(event_block(s, d).select("code", "date", age.alias("age"), *(F.sum("n").over(w.last_n(k)).alias(f"n{k}") for k in (20, 60)), last("size").alias("last_size")), ["age", "n20", "n60", "last_size"])


@query("m12_rating_counts", BLOCK + " SELECT code, date, " + ", ".join(f"CAST(SUM(n) {win(k)} AS BIGINT) AS n{k}" for k in (5, 20, 60, 250)) + f", SUM(n) {win(20)} >= 2 AND SUM(n) {win(20)} > 2 * SUM(n) {win(60, 20)} / 3 AS surge FROM q", BARS, NOTICES)
def m12(s, d):
    total = lambda k, back=0: F.sum("n").over(w.last_n(k, back))
    surge = (total(20) >= 2) & (total(20) > 2 * total(60, 20) / 3)
    return event_block(s, d).select("code", "date", *(total(k).alias(f"n{k}") for k in (5, 20, 60, 250)), surge.alias("surge"))


@query("m14_theme_heat", ", x AS (SELECT DISTINCT code, date, kind FROM notices) SELECT a.kind, a.date, COUNT(DISTINCT CASE WHEN b.date = a.date THEN b.code END) AS today, COUNT(DISTINCT CASE WHEN b.date > a.date - 5 THEN b.code END) AS heat5, COUNT(DISTINCT b.code) AS heat20 FROM (SELECT DISTINCT kind, date FROM x) a JOIN x b ON b.kind = a.kind AND b.date BETWEEN a.date - 19 AND a.date GROUP BY 1, 2", NOTICES)
def m14(s, d):
    """Distinct codes of a theme today and over 5 and 20 days: each mention is sent to the days it counts for."""
    x = panels.notices(s, d).select("code", "date", "kind").distinct()
    sent = x.select("kind", "code", F.explode(F.sequence(F.lit(0), F.lit(19))).alias("k"), "date").select("kind", "code", "k", F.date_add("date", F.col("k")).alias("date"))
    g = sent.groupBy("kind", "date").agg(F.count_distinct(F.when(F.col("k") == 0, F.col("code"))).alias("today"), F.count_distinct(F.when(F.col("k") < 5, F.col("code"))).alias("heat5"), F.count_distinct("code").alias("heat20"))
    return g.where("today > 0")


@query("m16_candidate_pool", RET + NOTICES.replace("\nnotices AS", ", notices AS").format(supplier="supplier", orders="orders") + f", q AS (SELECT *, ROW_NUMBER() OVER ({BY}) AS i, MAX(date - d1) {win(20)} AS gap FROM (SELECT *, {lag('date')} AS d1 FROM p)) SELECT date, COUNT(*) AS n FROM q WHERE NOT contains(upper(sector), 'ST') AND close >= 2 AND i > 120 AND gap <= 40 AND r20 IS NOT NULL AND NOT EXISTS (SELECT 1 FROM notices n WHERE n.code = q.code AND n.date = q.date AND kind = '1-URGENT') GROUP BY date")
def m16(s, d):
    q = returns(s, d).select("*", F.row_number().over(w.by_code()).alias("i"), F.datediff("date", w.lag("date")).alias("_g")).withColumn("gap", F.max("_g").over(w.last_n(20)))
    risky = panels.notices(s, d).where("kind = '1-URGENT'").select("code", "date").distinct()
    return q.where(~F.upper("sector").contains("ST")).where("close >= 2 AND i > 120 AND gap <= 40 AND r20 IS NOT NULL").join(risky, ["code", "date"], "left_anti").groupBy("date").agg(F.count("*").alias("n"))


# --- intraday and snapshots -----------------------------------------------------------------------


@query("n04_touches", ", m AS (SELECT *, CAST(ts AS DATE) AS date, price >= 115 AS up, LAG(price >= 115) OVER (PARTITION BY code, CAST(ts AS DATE) ORDER BY ts, event_id) AS up1 FROM ticks) SELECT code, date, bool_or(up) AS touched, COUNT(*) FILTER (NOT up AND up1) AS opened, arg_max(up, ROW(ts, event_id)) AS sealed, " + r6("AVG(CAST(up AS DOUBLE))", "held") + " FROM m GROUP BY code, date", DUCK_TICKS)
def n04(s, d):
    t = panels.ticks(s, d).select("*", F.to_date("ts").alias("date"), (F.col("price") >= 115).alias("up"))
    t = t.withColumn("up1", F.lag("up").over(Window.partitionBy("code", "date").orderBy("ts", "event_id")))
    g = t.groupBy("code", "date").agg(F.bool_or("up").alias("touched"), F.count_if(~F.col("up") & F.col("up1")).alias("opened"), F.max_by("up", F.struct("ts", "event_id")).alias("sealed"), F.avg(F.col("up").cast("double")).alias("held"))
    return rounded(g, ["held"], ("code", "date", "touched", "opened", "sealed"))


@query("p01_snapshot_features", POINTS + rounded_sql({"slope": "(at18 - at0) / at0", "dive": "LEAST(at6, at12, at18) / at0 - 1"}, "pt WHERE at0 IS NOT NULL AND at18 IS NOT NULL", "code, date, at0 <= COALESCE(at6, at0) AND COALESCE(at6, at0) <= COALESCE(at12, at18) AND COALESCE(at12, at18) <= at18 AS rising"), DUCK_TICKS)
def p01(s, d):
    pt = intraday.samples(panels.ticks(s, d), [0, 6, 12, 18], 7200).where("at0 IS NOT NULL AND at18 IS NOT NULL")
    b, c = F.coalesce("at6", "at0"), F.coalesce("at12", "at18")
    rising = (F.col("at0") <= b) & (b <= c) & (c <= F.col("at18"))
    return rounded(pt.select("code", "date", rising.alias("rising"), ((F.col("at18") - F.col("at0")) / F.col("at0")).alias("slope"), (F.least("at6", "at12", "at18") / F.col("at0") - 1).alias("dive")), ["slope", "dive"], ("code", "date", "rising"))


@query("p04_sector_in_pool", RET + f", q AS (SELECT code, date, sector, r20, COALESCE({lag('r')} >= 0.045, FALSE) AS lu1 FROM p) SELECT code, date, CASE WHEN sector = 'CHINA' THEN 0 ELSE COUNT(*) OVER v END AS members, CASE WHEN sector = 'CHINA' THEN 0 ELSE CAST(SUM(CAST(lu1 AS INT)) OVER v AS BIGINT) END AS prev_large FROM q WHERE r20 > 0 WINDOW v AS (PARTITION BY date, sector)")
def p04(s, d):
    """Members of a sector in the day's pool and yesterday's large gains among them; one sector counts as unclassified."""
    q = returns(s, d).withColumn("lu1", F.coalesce((w.lag("r") >= 0.045), F.lit(False))).where("r20 > 0")
    v = Window.partitionBy("date", "sector")
    known = lambda x: F.when(F.col("sector") == "CHINA", 0).otherwise(x).cast("long")
    return q.select("code", "date", known(F.count("*").over(v)).alias("members"), known(F.sum(F.col("lu1").cast("int")).over(v)).alias("prev_large"))


@query("p06_daily_results", RET + LABELS + f", q AS (SELECT date, rise, ({tied('r20')}) AS a, ROW_NUMBER() OVER (PARTITION BY date ORDER BY ROUND(r20, 9) DESC, code) AS k FROM u WHERE r20 IS NOT NULL AND rise IS NOT NULL), t AS (SELECT *, (RANK() OVER (PARTITION BY date ORDER BY rise) + (COUNT(*) OVER (PARTITION BY date, rise) - 1) / 2.0) / COUNT(*) OVER (PARTITION BY date) AS b FROM q) SELECT date, COUNT(*) AS pool, " + r6("COVAR_POP(a, b) / NULLIF(STDDEV_POP(a) * STDDEV_POP(b), 0)", "ic") + ", " + r6("AVG(CASE WHEN k <= 5 THEN rise END) - AVG(rise) - 0.002", "excess") + " FROM t GROUP BY date")
def p06(s, d):
    u = labelled(s, d).where("r20 IS NOT NULL AND rise IS NOT NULL")
    k = F.row_number().over(Window.partitionBy("date").orderBy(F.round("r20", 9).desc(), "code"))
    t = u.select("date", "rise", cs.pct_rank("r20", "date").alias("a"), cs.pct_rank("rise", "date").alias("b"), k.alias("k"))
    ic = F.covar_pop("a", "b") / F.nullif(F.stddev_pop("a") * F.stddev_pop("b"), F.lit(0.0))
    g = t.groupBy("date").agg(F.count("*").alias("pool"), ic.alias("ic"), (F.avg(F.when(F.col("k") <= 5, F.col("rise"))) - F.avg("rise") - 0.002).alias("excess"))
    return rounded(g, ["ic", "excess"], ("date", "pool"))


# --- evaluation -----------------------------------------------------------------------------------


@query("l07_arm_comparison", RET + LABELS + ", k AS (SELECT date, y, ROW_NUMBER() OVER (PARTITION BY date ORDER BY ROUND(r20, 9) DESC, code) AS ra, ROW_NUMBER() OVER (PARTITION BY date ORDER BY amount DESC, code) AS rb FROM u WHERE y IS NOT NULL AND r20 IS NOT NULL), g AS (SELECT date, AVG(CASE WHEN ra <= 10 THEN y END) - AVG(CASE WHEN rb <= 10 THEN y END) AS d FROM k GROUP BY date), m AS (SELECT date_trunc('month', date) AS month, AVG(d) AS d FROM g GROUP BY 1), r AS (SELECT *, AVG(d) OVER (ORDER BY month ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS roll, COUNT(*) OVER (ORDER BY month ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS n3 FROM m) SELECT COUNT(*) AS months, COUNT(*) FILTER (ROUND(d, 9) > 0) AS wins, " + r6("AVG(d)", "mean") + ", " + r6("MIN(CASE WHEN n3 = 3 THEN roll END)", "worst3") + ", " + r6("(SUM(d) - MAX(d)) / NULLIF(COUNT(*) - 1, 0)", "without_best") + " FROM r")
def l07(s, d):
    """Two lists compared by month: wins, mean difference, worst three months in a row, and the mean without the best month.

    Differences are sums of tenths, whose sum in doubles need not be 0 where it should be; the smallest true one is above 1e-6.
    """
    u = labelled(s, d).where("y IS NOT NULL AND r20 IS NOT NULL")
    place = lambda *order: F.row_number().over(Window.partitionBy("date").orderBy(*order))
    k = u.select("date", "y", place(F.round("r20", 9).desc(), "code").alias("ra"), place(F.col("amount").desc(), "code").alias("rb"))
    g = k.groupBy("date").agg((F.avg(F.when(F.col("ra") <= 10, F.col("y"))) - F.avg(F.when(F.col("rb") <= 10, F.col("y")))).alias("d"))
    m = g.groupBy(F.trunc("date", "month").alias("month")).agg(F.avg("d").alias("d"))
    three = Window.orderBy("month").rowsBetween(-2, 0)  # a row per month
    r = m.select("d", F.when(F.count("*").over(three) == 3, F.avg("d").over(three)).alias("roll"))
    out = r.agg(F.count("*").alias("months"), F.count_if(F.round("d", 9) > 0).alias("wins"), F.avg("d").alias("mean"), F.min("roll").alias("worst3"), ((F.sum("d") - F.max("d")) / F.nullif(F.count("*") - 1, F.lit(0))).alias("without_best"))
    return rounded(out, ["mean", "worst3", "without_best"], ("months", "wins"))


@query("u06_aggregate_helpers", RET + ", m AS (SELECT board, QUANTILE_CONT(r, 0.5) AS mid FROM p GROUP BY board) SELECT p.board, " + r6("QUANTILE_CONT(ABS(r - mid), 0.5) * 1.4826", "mad") + ", COUNT(r) AS n FROM p JOIN m ON m.board = p.board GROUP BY p.board")
def u06(s, d):
    p = returns(s, d)
    m = p.groupBy("board").agg(F.percentile("r", F.lit(0.5)).alias("mid"))
    g = p.join(m, "board").groupBy("board").agg((F.percentile(F.abs(F.col("r") - F.col("mid")), F.lit(0.5)) * 1.4826).alias("mad"), F.count("r").alias("n"))
    return rounded(g, ["mad"], ("board", "n"))


@query("u04_injected_risk", RET + NOTICES.replace("\nnotices AS", ", notices AS").format(supplier="supplier", orders="orders") + ", k AS (SELECT date, code, ROW_NUMBER() OVER (PARTITION BY date ORDER BY ROUND(r20, 9) DESC, code) AS rank FROM p WHERE r20 IS NOT NULL AND NOT EXISTS (SELECT 1 FROM notices n WHERE n.code = p.code AND n.kind = '1-URGENT' AND n.date BETWEEN p.date - 5 AND p.date)) SELECT date, code, rank FROM k WHERE rank <= 3")
def u04(s, d):
    """A list with a risk function put in: a DataFrame in, the rows without a risk out."""

    def no_recent_notice(df):
        told = joins.sum_between(df, panels.notices(s, d).where("kind = '1-URGENT'"), "date", F.lit(1.0), -5, 0, "risk")
        return told.where("risk_n = 0").drop("risk_sum", "risk_n")

    p = returns(s, d).where("r20 IS NOT NULL").transform(no_recent_notice)
    return cs.top(p, 3, [F.round("r20", 9).desc(), F.col("code")], "date").select("date", "code", "rank")


# --- the streaming operators over the whole table --------------------------------------------------


@query("s02_late_quotes", ", t AS (SELECT *, MAX(ts) OVER (ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS seen FROM ticks) SELECT event_type, COUNT(*) AS n, COUNT(*) FILTER (ts < seen - INTERVAL 10 MINUTE) AS late FROM t GROUP BY event_type", DUCK_TICKS)
def s02(s, d):
    """In order of arrival, quotes older than the newest one before by ten minutes are late; they are counted by type."""
    t = panels.ticks(s, d).select("event_type", "event_id", F.unix_micros(F.col("ts").cast("timestamp")).alias("at"))
    return streaming.late_counts(t, "event_type", 600)


@query("s05_sliding_counts", " SELECT CAST(start AS VARCHAR) AS start, event_type, COUNT(*) AS n FROM (SELECT event_type, time_bucket(INTERVAL 15 minutes, ts) - to_minutes(15 * k) AS start FROM ticks, (SELECT UNNEST(range(0, 4)) AS k)) GROUP BY 1, 2", DUCK_TICKS)
def s05(s, d):
    t = panels.ticks(s, d).withColumn("ts", F.col("ts").cast("timestamp"))
    return streaming.sliding_counts(t, "event_type").select(F.date_format("start", "yyyy-MM-dd HH:mm:ss").alias("start"), "event_type", "n")


@query("s06_sessions", ", g AS (SELECT code, ts, CASE WHEN ts - LAG(ts) OVER (PARTITION BY code ORDER BY ts) < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS nw FROM ticks), h AS (SELECT *, SUM(nw) OVER (PARTITION BY code ORDER BY ts) AS k FROM g) SELECT code, epoch_us(MIN(ts)) AS start, COUNT(*) AS n FROM h GROUP BY code, k", DUCK_TICKS)
def s06(s, d):
    t = panels.ticks(s, d).withColumn("ts", F.col("ts").cast("timestamp"))
    return streaming.sessions(t).select("code", F.unix_micros("start").alias("start"), "n")


@query("s07_nearest_samples", ", x AS (SELECT code, CAST(ts AS DATE) AS date, h, price, event_id, ABS(epoch_us(ts) - epoch_us(CAST(CAST(ts AS DATE) AS TIMESTAMP)) - h * 3600000000) AS off FROM ticks, (SELECT UNNEST([6, 12, 18]) AS h)) SELECT code, date, CAST(h AS INTEGER) AS hour, " + r6("(MIN(ROW(off, event_id, price)))[3]", "price") + " FROM x WHERE off <= 1800000000 GROUP BY 1, 2, 3", DUCK_TICKS)
def s07(s, d):
    t = panels.ticks(s, d).select("code", F.col("ts").cast("timestamp").alias("ts"), "event_id", "price", F.explode(F.array(*map(F.lit, (6, 12, 18)))).alias("hour")).withColumn("date", F.to_date("ts"))
    off = F.abs(F.unix_micros("ts") - F.unix_micros(F.col("date").cast("timestamp")) - F.col("hour").cast("long") * 3600000000)
    g = t.withColumn("off", off).where("off <= 1800000000").groupBy("code", "date", "hour").agg(F.min_by("price", F.struct("off", "event_id")).alias("price"))
    return rounded(g, ["price"], ("code", "date", "hour"))


@query("s11_enriched_quotes", " SELECT board, event_type, COUNT(*) AS n FROM ticks LEFT JOIN codes ON codes.code = ticks.code GROUP BY 1, 2", BARS, DUCK_TICKS)
def s11(s, d):
    return streaming.enriched(panels.ticks(s, d), panels.codes(s, d)).groupBy("board", "event_type").agg(F.count("*").alias("n"))


# --- state carried over micro-batches ---------------------------------------------------------------

#: A replay hands the days in by these ranges, each a micro-batch.
CUTS = ["1993-07-01", "1994-12-01", "1996-06-01", "1997-11-15"]


@query("s08_stateful_pool", STAYS + " SELECT stays.*, cal.day + 62 <= (SELECT MAX(day) FROM cal) AS expired FROM stays JOIN cal ON cal.date = stays.last", BARS)
def s08(s, d):
    """Stays of the pool from a replay of all listings, kept as state and expired by a clock of market days."""
    days = lists.day_numbers(panel(s, d))
    clock = days.select(F.lit(0).cast("long").alias("code"), "date", "day", F.lit(None).cast("int").alias("rank"))
    listed = picks(s, d, 5).select("code", "date", "rank").join(days, "date").select("code", "date", "day", "rank")
    return stateful.newest(stateful.replay(listed.unionByName(clock), stateful.pool, CUTS))


@query("s09_carried_state", CHIPS + f", cal AS (SELECT date, ROW_NUMBER() OVER (ORDER BY date) AS day FROM (SELECT DISTINCT date FROM panel)), rr AS (SELECT barz.code, barz.date, day - i AS g FROM barz JOIN cal ON cal.date = barz.date), r2 AS (SELECT code, date, ROW_NUMBER() OVER (PARTITION BY code, g ORDER BY date) AS run FROM rr), j AS (SELECT basis.*, run FROM basis JOIN r2 ON r2.code = basis.code AND r2.date = basis.date)" + rounded_sql({"avg_cost": "avg_cost", "winners": "winners", "deviation": "close / avg_cost - 1", "width90": "width90", "peak_gap": "peak_gap"}, "j", "code, date, run", 4), BARS)
def s09(s, d):
    """Cost basis and run of market days of every bar, from state that moves on with each micro-batch."""
    bars = panel(s, d).select("code", "date", "high", "low", "close", "turnover").join(F.broadcast(lists.day_numbers(panel(s, d))), "date")  # a row a day
    return rounded(stateful.replay(bars, stateful.carried, CUTS), ["avg_cost", "winners", "deviation", "width90", "peak_gap"], ("code", "date", "run"), 4)


@query("s03_duplicates", " SELECT event_type, COUNT(*) AS n, COUNT(DISTINCT event_id) AS events FROM ticks GROUP BY event_type", DUCK_TICKS)
def s03(s, d):
    """All events handed in twice, the second time in later micro-batches; an event's first row alone comes out."""
    t = panels.ticks(s, d).select("event_id", "event_type", F.to_date("ts").alias("date"))
    last = t.agg(F.max("date")).first()[0]
    both = t.unionByName(t.withColumn("date", F.date_add(F.lit(last), 1 + F.pmod("event_id", F.lit(3)).cast("int"))))
    cuts = [str(last + dt.timedelta(days=k)) for k in (1, 2, 3)]
    out = stateful.replay(both, lambda stream: stream.dropDuplicates(["event_id"]), cuts)
    return out.groupBy("event_type").agg(F.count("*").alias("n"), F.count_distinct("event_id").alias("events"))


@query("s01_daily_append", " SELECT code, COUNT(*) AS n, CAST(SUM(CAST(ROUND(close * 100) AS BIGINT)) AS BIGINT) AS cents, MAX(date) AS last FROM panel GROUP BY code", BARS)
def s01(s, d):
    """Bars appended by micro-batches, each upserted by code and date into a table of versions; the days around a cut come twice."""
    bars = panel(s, d).select("code", "date", "close")
    return stateful.upserted(bars.unionByName(bars.where(F.dayofmonth("date") == 1)), ["code", "date"], ["close"], CUTS).groupBy("code").agg(F.count("*").alias("n"), F.sum(F.round(F.col("close") * 100).cast("long")).alias("cents"), F.max("date").alias("last"))
