"""Queries of patterns, intraday data, sampling, sources and text rules."""

from __future__ import annotations

from pyspark.sql import functions as F

from barline.operators import intraday, labels, learning, lists, patterns
from barline.operators import crosssection as cs
from barline.operators import windows as w
from barline.plans.helpers import BY, lag, rounded, rounded_sql, win
from barline.plans.panels import LABELS, PICKS, RET, labelled, picks, r6, returns
from barline.sources import panels, tables
from barline.sources.panels import BARS, DUCK_TICKS, NOTICES, duck, panel

QUERIES: dict = {}
ORACLE_SQL: dict = {}


def add(name: str, query, sql: str | None = None, *parts: str) -> None:
    QUERIES[name] = query
    if sql is not None:
        ORACLE_SQL[name] = duck(*(parts or (BARS,))) + sql


PREPARED = f", p0 AS (SELECT *, ROW_NUMBER() OVER ({BY}) AS pos, close / {lag('close')} - 1 AS gain, volume / {lag('volume')} AS vr FROM panel), p AS (SELECT *, COALESCE(gain >= 0.03 AND vr >= 1.5, FALSE) AS big FROM p0)"
LAUNCHES = f", b AS (SELECT *, COUNT(close) {win(20, 1)} AS n, MAX(close) {win(20, 1)} / MIN(close) {win(20, 1)} - 1 AS amp, AVG(volume) {win(20, 1)} AS bv FROM p), l AS (SELECT * FROM b WHERE n = 20 AND amp <= 0.6 AND big AND volume >= 1.2 * bv)"
STEPS = """, s AS (SELECT l.code, l.date AS launch_date, l.high AS lh, l.low AS ll, l.volume AS lv, l.pos + k.step AS pos, k.step FROM l, (SELECT UNNEST(range(1, 12)) AS step) k),
t0 AS (SELECT s.*, p.date AS date, p.low, p.close, p.volume, p.big, AVG(p.volume) OVER (PARTITION BY s.code, s.launch_date ORDER BY step ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS vm FROM s LEFT JOIN p ON p.code = s.code AND p.pos = s.pos),
t AS (SELECT *, CASE WHEN date IS NULL THEN 'open' WHEN low < ll THEN 'broken' WHEN close > lh AND step <= 2 THEN 'early' WHEN close > lh AND NOT big THEN 'weak' WHEN close > lh AND vm > 0.8 * lv THEN 'thick' WHEN close > lh THEN 'hit'
      WHEN volume >= lv THEN 'heavy' WHEN step > 10 THEN 'late' END AS status FROM t0)
SELECT code, launch_date, arg_min(status, step) AS status, CAST(MIN(step) AS INTEGER) AS step, (MIN(ROW(step, date)))[2] AS date FROM t WHERE status IS NOT NULL GROUP BY code, launch_date"""
add("i02_base_launch_adjust_trigger", lambda s, d: patterns.base_launch_adjust_trigger(panel(s, d)), PREPARED + LAUNCHES + STEPS)
add("i01_prepared_bars", lambda s, d: rounded(patterns.prepared(panel(s, d)), ["gain", "vr"], ("code", "date", "pos", "big")), PREPARED + rounded_sql({"gain": "gain", "vr": "vr"}, "p", "code, date, pos, big"))
STRICT = LAUNCHES.replace("volume >= 1.2 * bv", "volume >= 1.5 * bv AND volume > bx").replace("amp <= 0.6", "amp <= 0.3").replace("AVG(volume)", f"MAX(volume) {win(20, 1)} AS bx, AVG(volume)", 1)
add("i02_strict_bases", lambda s, d: patterns.base_launch_adjust_trigger(panel(s, d), amplitude=0.3, times=1.5, over_largest=True), PREPARED + STRICT + STEPS)
add("d08_status_counts", lambda s, d: patterns.base_launch_adjust_trigger(panel(s, d)).groupBy("status").agg(F.count("*").alias("n")), PREPARED + LAUNCHES + STEPS.replace("SELECT code, launch_date, arg_min", ", zz AS (SELECT code, launch_date, arg_min") + ") SELECT status, COUNT(*) AS n FROM zz GROUP BY status")
STAYS = RET + PICKS + ", cal AS (SELECT date, ROW_NUMBER() OVER (ORDER BY date) AS day FROM (SELECT DISTINCT date FROM panel)), q0 AS (SELECT k.code, k.date, rank, cal.day, cal.day - LAG(cal.day) OVER (PARTITION BY k.code ORDER BY k.date) AS gap FROM k JOIN cal ON cal.date = k.date WHERE rank <= 5), q1 AS (SELECT *, SUM(COALESCE(CAST(gap > 61 AS INT), 1)) OVER (PARTITION BY code ORDER BY day) AS stay, SUM(COALESCE(CAST(gap <> 1 AS INT), 1)) OVER (PARTITION BY code ORDER BY day) AS island FROM q0), q2 AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY code, island ORDER BY day) AS run FROM q1), stays AS (SELECT code, CAST(stay AS BIGINT) AS stay, MIN(date) AS first, MAX(date) AS last, COUNT(*) AS days, MIN(rank) AS best, MAX(run) AS streak FROM q2 GROUP BY code, stay)"
add("i09_pool_stays", lambda s, d: patterns.pool_days(picks(s, d, 5), lists.day_numbers(panel(s, d))), STAYS + " SELECT * FROM stays")
DAY = ", m AS (SELECT date, COUNT(*) AS n, AVG(CAST(r > 0 AS DOUBLE)) AS up, CAST(SUM(CAST(r >= 0.045 AS INT)) AS BIGINT) AS large FROM p GROUP BY date)"


def market(s, d):
    return returns(s, d).groupBy("date").agg(F.count("*").alias("n"), F.avg((F.col("r") > 0).cast("double")).alias("up"), F.sum((F.col("r") >= 0.045).cast("long")).alias("large"))


add("i10_phases", lambda s, d: patterns.phases(market(s, d)).select("date", "phase"), RET + DAY + ", u AS (SELECT *, AVG(large) OVER (ORDER BY date ROWS BETWEEN 20 PRECEDING AND 1 PRECEDING) AS usual FROM m) SELECT date, CASE WHEN up < 0.35 THEN 'ice' WHEN up > 0.6 AND large > 1.5 * usual THEN 'mania' ELSE 'normal' END AS phase FROM u")
add("i12_count_drift", lambda s, d: patterns.drift(market(s, d)).select("date", "n", "alert"), RET + DAY + " SELECT date, n, COUNT(n) OVER v >= 20 AND n > 1.5 * MAX(n) OVER v AS alert FROM m WINDOW v AS (ORDER BY date ROWS BETWEEN 60 PRECEDING AND 1 PRECEDING)")
add("a14_coverage_gate", lambda s, d: rounded(tables.coverage(panel(s, d)), ["usual"], ("date", "n", "complete")), ", n AS (SELECT date, COUNT(*) AS n FROM panel GROUP BY date), u AS (SELECT *, QUANTILE_CONT(n, 0.5) OVER (ORDER BY date ROWS BETWEEN 5 PRECEDING AND 1 PRECEDING) AS usual FROM n) SELECT date, n, COALESCE(n >= 0.97 * usual, TRUE) AS complete, " + r6("usual", "usual") + " FROM u")
add("a11_shard_merge", lambda s, d: tables.merge_shards(panels.notices(s, d).withColumn("shard", F.year("date")), ["code", "kind", "date"], "shard").groupBy("code").agg(F.count("*").alias("n"), F.max("shard").alias("shard")), " , x AS (SELECT *, YEAR(date) AS shard FROM notices), m AS (SELECT code, MAX(shard) AS shard FROM x GROUP BY code) SELECT m.code, COUNT(DISTINCT ROW(kind, date)) AS n, MAX(m.shard) AS shard FROM x JOIN m ON x.code = m.code AND x.shard = m.shard GROUP BY m.code", NOTICES)
add("a17_keyed_upsert", lambda s, d: (lambda p: tables.upsert(p.where("volume < 30").select("code", "date", "volume"), p.where("volume > 20").select("code", "date", (F.col("volume") + 1).alias("volume")), ["code", "date"]).groupBy("code").agg(F.count("*").alias("n"), F.sum("volume").alias("volume")))(panel(s, d)), " SELECT code, COUNT(*) AS n, SUM(CASE WHEN volume > 20 THEN volume + 1 ELSE volume END) AS volume FROM panel WHERE volume < 30 OR volume > 20 GROUP BY code")
add("a12_snapshot_classes", lambda s, d: (lambda p: tables.classify(p.where("date >= '1998-01-01'").select("code", "date", F.lag("close").over(w.by_code()).alias("prev_close")), p.where("date < '1998-06-01' AND code % 10 <> 3").groupBy("code").agg(F.max("date").alias("date"), F.max_by("close", "date").alias("close"))).groupBy("status").agg(F.count("*").alias("n")))(panel(s, d)), f", a AS (SELECT code, date, {lag('close')} AS pc FROM panel WHERE date >= DATE '1998-01-01'), l AS (SELECT code, MAX(date) AS date, arg_max(close, date) AS close FROM panel WHERE date < DATE '1998-06-01' AND code % 10 <> 3 GROUP BY code) SELECT CASE WHEN l.date IS NULL THEN 'new' WHEN a.date <= l.date THEN 'stale' WHEN ABS(pc - l.close) > 0.006 THEN 'refetch' ELSE 'row' END AS status, COUNT(*) AS n FROM a LEFT JOIN l ON a.code = l.code GROUP BY 1")
add("a22_source_comparison", lambda s, d: (lambda p: rounded(tables.compare_sources(p.where("volume > 15"), p.where("volume < 40").withColumn("close", F.round("close", 1)), "close", 0.03), ["agree"], ("code", "n", "both")))(panel(s, d)), " SELECT code, COUNT(*) AS n, CAST(SUM(CAST(volume > 15 AND volume < 40 AS INT)) AS BIGINT) AS \"both\", " + r6("AVG(CASE WHEN volume > 15 AND volume < 40 THEN CAST(ABS(close - ROUND(close, 1)) <= 0.03 AS DOUBLE) END)", "agree") + " FROM panel WHERE volume > 15 OR volume < 40 GROUP BY code")
# learning
MONTH = ", v AS (SELECT *, CAST(date_trunc('month', date) AS DATE) AS month FROM u WHERE y IS NOT NULL)"
add("k01_stratified_sample", lambda s, d: learning.stratified(labelled(s, d).withColumn("month", F.trunc("date", "month"))).groupBy("month", "y").agg(F.count("*").alias("n")), RET + LABELS + MONTH + ", c AS (SELECT month, y, COUNT(*) AS n, SUM(SUM(CASE WHEN y = 1 THEN 1 ELSE 0 END)) OVER (PARTITION BY month) AS pos FROM v GROUP BY month, y) SELECT month, y, CAST(CASE WHEN y = 1 THEN n ELSE LEAST(n, 12 * pos) END AS BIGINT) AS n FROM c WHERE y = 1 OR pos > 0")
add("k02_weights", lambda s, d: rounded(learning.weights(labelled(s, d).where("y IS NOT NULL").withColumn("month", F.trunc("date", "month"))), ["w_month", "w_age"]), RET + LABELS + MONTH + rounded_sql({"w_month": "(SELECT CAST(COUNT(*) AS DOUBLE) / COUNT(DISTINCT month) FROM v) / COUNT(*) OVER (PARTITION BY month)", "w_age": "POWER(0.5, ((SELECT MAX(date) FROM v) - date) / CAST(250 AS DOUBLE))"}, "v"))
add("k04_purged_slice", lambda s, d: learning.purged(labelled(s, d), "1998-01-01").groupBy("code").agg(F.count("*").alias("n"), F.max("date").alias("last")), RET + f", q AS (SELECT *, LEAD(date, 20) OVER ({BY}) AS closed FROM p) SELECT code, COUNT(*) AS n, MAX(date) AS last FROM q WHERE date < DATE '1998-01-01' AND closed < DATE '1998-01-01' GROUP BY code")
# intraday
add("s04_minute_bars", lambda s, d: rounded(intraday.minute_bars(panels.ticks(s, d), "15 minutes"), ["open", "high", "low", "close", "flow", "volume"], ("code", "minute", "n")), " SELECT code, time_bucket(INTERVAL 15 minutes, ts) AS minute, COUNT(*) AS n, " + r6("(MIN(ROW(ts, event_id, price)))[3]", "open") + ", " + r6("MAX(price)", "high") + ", " + r6("MIN(price)", "low") + ", " + r6("(MAX(ROW(ts, event_id, price)))[3]", "close") + ", " + r6("SUM(side * value)", "flow") + ", " + r6("SUM(value)", "volume") + " FROM ticks GROUP BY 1, 2", DUCK_TICKS)
add("n02_day_features", lambda s, d: rounded(intraday.day_features(intraday.minute_bars(panels.ticks(s, d))), ["vwap_gap", "drawdown", "realised", "first_hour"], ("code", "date", "minutes", "high_at")), f""", m AS (SELECT code, time_bucket(INTERVAL 1 minute, ts) AS minute, CAST(ts AS DATE) AS date, MAX(price) AS high, MIN(price) AS low, (MAX(ROW(ts, event_id, price)))[3] AS close, SUM(value) AS volume FROM ticks GROUP BY 1, 2, 3),
q AS (SELECT *, MAX(high) OVER v AS peak, LN(close / LAG(close) OVER v) AS r, MIN(minute) OVER (PARTITION BY code, date) AS f FROM m WINDOW v AS (PARTITION BY code, date ORDER BY minute))
SELECT code, date, COUNT(*) AS minutes, arg_min(minute, ROW(-high, minute)) AS high_at, {r6('arg_max(close, minute) / NULLIF(SUM(close * volume) / NULLIF(SUM(volume), 0), 0) - 1', 'vwap_gap')}, {r6('MIN(low / peak - 1)', 'drawdown')}, {r6('SQRT(SUM(r * r))', 'realised')}, {r6("SUM(CASE WHEN minute < f + INTERVAL 1 hour THEN volume ELSE 0 END) / NULLIF(SUM(volume), 0)", 'first_hour')} FROM q GROUP BY code, date""", DUCK_TICKS)
add("n06_sampling_points", lambda s, d: intraday.samples(panels.ticks(s, d), [0, 6, 12, 18]), ", x AS (SELECT code, CAST(ts AS DATE) AS date, ts, event_id, price, h, epoch_us(ts) / 1e6 - epoch(CAST(CAST(ts AS DATE) AS TIMESTAMP)) - h * 3600 AS late FROM ticks, (SELECT UNNEST([0, 6, 12, 18]) AS h)), y AS (SELECT code, date, h, (MIN(ROW(ts, event_id, price)))[3] AS price FROM x WHERE late >= 0 AND late <= 1800 GROUP BY 1, 2, 3) SELECT code, date, " + ", ".join(f"MAX(CASE WHEN h = {h} THEN price END) AS at{h}" for h in (0, 6, 12, 18)) + " FROM y GROUP BY 1, 2", DUCK_TICKS)
# grades and ranks of labels
add("h08_grades", lambda s, d: (lambda x: x.select("code", "date", labels.grade(F.col("rise_open"), F.col("y_open")).alias("grade")))(labels.label_buyable(panel(s, d))), f", q AS (SELECT *, LEAD(open) OVER ({BY}) AS o1, LEAD(low) OVER ({BY}) AS l1, CASE WHEN COUNT(high) OVER f = 20 THEN MAX(high) OVER f END AS h FROM panel WINDOW f AS ({BY} ROWS BETWEEN 1 FOLLOWING AND 20 FOLLOWING)) SELECT code, date, CASE WHEN h IS NULL THEN NULL WHEN h / o1 - 1 > 0.3 AND NOT l1 >= close * (1 + 0.045) THEN 3 WHEN h / o1 - 1 > 0.2 THEN 2 WHEN h / o1 - 1 > 0.1 THEN 1 ELSE 0 END AS grade FROM q")
add("e35_sector_resonance", lambda s, d: (lambda x, by: rounded(x.select("code", "date", F.avg("r").over(by).alias("sector_r"), F.avg((F.col("r") >= 0.045).cast("double")).over(by).alias("large"), F.count("*").over(by).alias("size"), (F.col("r") - F.avg("r").over(by)).alias("own")), ["sector_r", "large", "own"], ("code", "date", "size")))(returns(s, d), cs.Window.partitionBy("date", "sector")), RET + rounded_sql({"sector_r": "AVG(r) OVER v", "large": "AVG(CAST(r >= 0.045 AS DOUBLE)) OVER v", "own": "r - AVG(r) OVER v"}, "p WINDOW v AS (PARTITION BY date, sector)", "code, date, COUNT(*) OVER v AS size"))
add("e08_market_columns", lambda s, d: (lambda m: rounded(m.select("date", "breadth", F.when(F.count("m").over(cs.Window.orderBy("date").rowsBetween(-4, 0)) == 5, F.sum("m").over(cs.Window.orderBy("date").rowsBetween(-4, 0))).alias("ret5")), ["breadth", "ret5"], ("date",)))(returns(s, d).groupBy("date").agg(F.avg((F.col("r") > 0).cast("double")).alias("breadth"), F.avg("r").alias("m"))), RET + ", m AS (SELECT date, AVG(CAST(r > 0 AS DOUBLE)) AS breadth, AVG(r) AS m FROM p GROUP BY date)" + rounded_sql({"breadth": "breadth", "ret5": "CASE WHEN COUNT(m) OVER v = 5 THEN SUM(m) OVER v END"}, "m WINDOW v AS (ORDER BY date ROWS BETWEEN 4 PRECEDING AND CURRENT ROW)", "date"))
