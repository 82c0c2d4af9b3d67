"""Queries of single survey rows: scalar rules, filters, joins, aggregates, families, lists, and learning by sums."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from barline.functions import scalars
from barline.operators import costbasis, families, joins, labels, lists, patterns, series
from barline.operators import crosssection as cs
from barline.operators import windows as w
from barline.plans.extra import FLAGS
from barline.plans.helpers import BY, ahead, full, lag, mean, rounded, rounded_sql, win
from barline.plans.more import PREPARED
from barline.plans.panels import LABELS, PICKS, RET, labelled, picks, r6, returns, tied
from barline.sources import panels
from barline.sources.panels import BARS, DUCK_DISCLOSURES, DUCK_TICKS, NOTICES, duck, panel

QUERIES: dict = {}
ORACLE_SQL: dict = {}


def query(name: str, sql: str | None, *parts: str):
    """Registers the decorated function with its SQL over the derivations named."""

    def register(function):
        QUERIES[name] = function
        if sql is not None:
            ORACLE_SQL[name] = duck(*(parts or (BARS,))) + sql
        return function

    return register


# --- scalar rules -------------------------------------------------------------------------------

CODE6 = ", a AS (SELECT *, lpad(CAST(code * 9173 AS VARCHAR), 6, '0') AS code6 FROM panel)"
SEGMENT = "CASE WHEN code6[1:3] = '688' THEN 'star' WHEN code6[1:1] = '3' THEN 'chinext' WHEN code6[1:2] IN ('83', '87', '88', '43', '92') THEN 'bj' ELSE 'main' END"
PCT = f"CASE WHEN {SEGMENT} IN ('star', 'chinext') THEN 20 WHEN {SEGMENT} = 'bj' THEN 30 WHEN upper(sector)[1:1] = 'S' THEN 5 ELSE 10 END"


def segmented(s, d):
    return panel(s, d).withColumn("code6", scalars.code6(F.col("code") * 9173)).withColumn("seg", scalars.board_of(F.col("code6")))


@query("b02_limit_percent", CODE6 + f" SELECT code6, {PCT} AS pct, COUNT(*) AS n FROM a GROUP BY 1, 2")
def b02(s, d):
    return segmented(s, d).groupBy("code6", scalars.limit_pct(F.col("seg"), F.col("sector")).alias("pct")).agg(F.count("*").alias("n"))


@query("b03_limit_price", CODE6 + f", b AS (SELECT code, date, {SEGMENT} AS seg, {lag('close')} * (1 + ({PCT}) / CAST(100 AS DOUBLE)) AS raw FROM a)" + rounded_sql({"cap": "CASE WHEN seg = 'bj' THEN FLOOR(raw * 100 + 1e-6) / 100 ELSE ROUND(raw + 1e-9, 2) END"}, "b"))
def b03(s, d):
    pct = scalars.limit_pct(F.col("seg"), F.col("sector"))
    return rounded(segmented(s, d).withColumn("cap", scalars.limit_price(w.lag("close"), pct, F.col("seg"))), ["cap"])


@query("b04_flagged_names", " SELECT sector, contains(upper(sector), 'ST') OR contains(sector, 'OUT') AS flagged, COUNT(*) AS n FROM panel GROUP BY 1, 2")
def b04(s, d):
    return panel(s, d).groupBy("sector", scalars.is_flagged(F.col("sector")).alias("flagged")).agg(F.count("*").alias("n"))


@query("b05_keys_in_text", " SELECT lpad(CAST(code AS VARCHAR), 6, '0') AS code6, strftime(date, '%Y-%m') AS month, MIN(strftime(date, '%Y-%m-%d')) AS first FROM panel GROUP BY 1, 2")
def b05(s, d):
    return panel(s, d).groupBy(scalars.code6(F.col("code")).alias("code6"), F.date_format("date", "yyyy-MM").alias("month")).agg(F.min(F.date_format("date", "yyyy-MM-dd")).alias("first"))


@query("b06_as_of", " SELECT code, COUNT(*) AS n, MAX(date) AS last FROM panel WHERE date <= DATE '1998-06-30' GROUP BY code")
def b06(s, d):
    return panel(s, d).where("date <= DATE'1998-06-30'").groupBy("code").agg(F.count("*").alias("n"), F.max("date").alias("last"))


MEDIAN250 = full("QUANTILE_CONT(volume, 0.5)", "volume", 250, 0, 60)


@query("b07_turnover_and_size", rounded_sql({"turn": f"LEAST(GREATEST(volume / ({MEDIAN250}) * 0.015, 0), 0.6)", "size": "shares * close"}, "panel"))
def b07(s, d):
    v = F.col("volume")
    usual = w.full(F.percentile(v, F.lit(0.5)), v, 250, w.last_n(250), 60)
    return rounded(panel(s, d).select("code", "date", scalars.clip(v / usual * 0.015, 0.0, 0.6).alias("turn"), (F.col("shares") * F.col("close")).alias("size")), ["turn", "size"])


@query("b10_thin_dates_and_warm_up", f", n AS (SELECT date, COUNT(*) AS n FROM panel GROUP BY date), m AS (SELECT date FROM n WHERE n >= 0.5 * (SELECT QUANTILE_CONT(n, 0.5) FROM n)), q AS (SELECT p.code, p.date, ROW_NUMBER() OVER (PARTITION BY p.code ORDER BY p.date) AS i FROM panel p JOIN m ON m.date = p.date) SELECT code, COUNT(*) AS n, MIN(date) AS first FROM q WHERE i > 120 GROUP BY code")
def b10(s, d):
    p = panel(s, d).select("code", "date")
    n = p.groupBy("date").agg(F.count("*").alias("n"))
    dates = n.crossJoin(F.broadcast(n.agg(F.percentile("n", F.lit(0.5)).alias("mid")))).where("n >= 0.5 * mid").select("date")
    return p.join(dates, "date").withColumn("i", F.row_number().over(w.by_code())).where("i > 120").groupBy("code").agg(F.count("*").alias("n"), F.min("date").alias("first"))


@query("b11_coverage_start", f", i AS (SELECT date, COUNT(*) FILTER (i > 60) AS ready FROM (SELECT date, ROW_NUMBER() OVER ({BY}) AS i FROM panel) GROUP BY date) SELECT MIN(date) AS start FROM i WHERE ready >= 0.9 * (SELECT QUANTILE_CONT(ready, 0.5) FROM i WHERE ready > 0)")
def b11(s, d):
    ready = panel(s, d).select("date", F.row_number().over(w.by_code()).alias("i")).groupBy("date").agg(F.count_if(F.col("i") > 60).alias("ready"))
    usual = ready.where("ready > 0").agg(F.percentile("ready", F.lit(0.5)).alias("mid"))
    return ready.crossJoin(F.broadcast(usual)).where("ready >= 0.9 * mid").agg(F.min("date").alias("start"))


@query("b12_any_of", RET + f", q AS (SELECT code, date, {lag('r')} AS r1, {lag('turnover')} AS t1, RANK() OVER (PARTITION BY date ORDER BY amount DESC) AS a FROM p) SELECT date, COUNT(*) AS n FROM q WHERE r1 >= 0.045 OR t1 >= 0.01 OR a <= 3 GROUP BY date")
def b12(s, d):
    q = returns(s, d).select("date", w.lag("r").alias("r1"), w.lag("turnover").alias("t1"), F.rank().over(Window.partitionBy("date").orderBy(F.col("amount").desc())).alias("a"))
    return q.where("r1 >= 0.045 OR t1 >= 0.01 OR a <= 3").groupBy("date").agg(F.count("*").alias("n"))


@query("b13_universe", RET + f", q AS (SELECT *, {lag('r')} AS r1 FROM p), k AS (SELECT date, code, ROW_NUMBER() OVER (PARTITION BY date ORDER BY amount DESC, code) AS rank FROM q WHERE NOT contains(upper(sector), 'ST') AND amount > 0 AND shares * close BETWEEN 2e7 AND 5e8 AND COALESCE(r1, 0) > -0.045) SELECT date, code, rank FROM k WHERE rank <= 5")
def b13(s, d):
    q = returns(s, d).withColumn("r1", w.lag("r")).where(~F.upper("sector").contains("ST")).where("amount > 0 AND shares * close BETWEEN 2e7 AND 5e8 AND COALESCE(r1, 0) > -0.045")
    return cs.top(q, 5, [F.col("amount").desc(), F.col("code")], "date").select("date", "code", "rank")


@query("b14_first_reject_reason", RET + ", q AS (SELECT *, open / " + lag("close") + " - 1 AS gap FROM p) SELECT COALESCE(CASE WHEN contains(sector, 'UNITED') THEN 'name' WHEN open = high AND high = low THEN 'one price' WHEN close <= 0 THEN 'price' WHEN gap < -0.01 OR gap > 0.03 THEN 'gap' WHEN amount < 1000 THEN 'amount' END, 'kept') AS reason, COUNT(*) AS n FROM q GROUP BY 1")
def b14(s, d):
    q = returns(s, d).withColumn("gap", F.col("open") / w.lag("close") - 1)
    reason = F.when(F.col("sector").contains("UNITED"), "name").when((F.col("open") == F.col("high")) & (F.col("high") == F.col("low")), "one price").when(F.col("close") <= 0, "price").when((F.col("gap") < -0.01) | (F.col("gap") > 0.03), "gap").when(F.col("amount") < 1000, "amount")
    return q.groupBy(F.coalesce(reason, F.lit("kept")).alias("reason")).agg(F.count("*").alias("n"))


@query("b19_name_tokens", " SELECT token, COUNT(*) AS n FROM (SELECT UNNEST(list_distinct(list_filter(string_split(p_name, ' '), lambda x: x NOT IN ('widget', 'small')))) AS token FROM part) GROUP BY token", NOTICES)
def b19(s, d):
    tokens = F.array_distinct(F.filter(F.transform(F.split("p_name", " "), lambda x: F.trim(x)), lambda x: ~x.isin("widget", "small")))
    return s.read.parquet(f"{d}/part.parquet").select(F.explode(tokens).alias("token")).groupBy("token").agg(F.count("*").alias("n"))


@query("b20_safe_ratios", RET + rounded_sql({"a": "COALESCE(r / NULLIF(high - low, 0), 0)", "b": "CASE WHEN r IS NOT NULL THEN LEAST(GREATEST(r, -0.02), 0.02) END"}, "p"))
def b20(s, d):
    span = F.col("high") - F.col("low")
    return rounded(returns(s, d).select("code", "date", F.coalesce(scalars.known(scalars.ratio(F.col("r"), span)), F.lit(0.0)).alias("a"), F.when(F.col("r").isNotNull(), scalars.clip(F.col("r"), -0.02, 0.02)).alias("b")), ["a", "b"])


@query("b21_volume_unit", ", u AS (SELECT code, date, CASE WHEN code % 2 = 0 THEN volume * 100 ELSE volume END AS given, turnover * shares / 400 AS usual FROM panel)" + rounded_sql({"volume": "CASE WHEN ABS(LN(given / 100 / usual)) < ABS(LN(given / usual)) THEN given / 100 ELSE given END"}, "u"))
def b21(s, d):
    """The unit of a vendor's volume, hundreds or ones, that lies closer to turnover times shares."""
    u = panel(s, d).select("code", "date", F.when(F.col("code") % 2 == 0, F.col("volume") * 100).otherwise(F.col("volume")).alias("given"), (F.col("turnover") * F.col("shares") / 400).alias("usual"))
    near = F.abs(F.log(F.col("given") / 100 / F.col("usual"))) < F.abs(F.log(F.col("given") / F.col("usual")))
    return rounded(u.withColumn("volume", F.when(near, F.col("given") / 100).otherwise(F.col("given"))), ["volume"])


@query("b22_reweighted_score", RET + f", k AS (SELECT *, {tied('r20')} AS a, {tied('amount')} AS b, {tied('turnover')} AS c FROM p)" + rounded_sql({"score": "(0.5 * a + 0.2 * b) / 0.7", "whole": "0.5 * a + 0.2 * b + 0.3 * c"}, "k"))
def b22(s, d):
    """A weighted score with one part dropped and the other weights raised to sum to one."""
    parts = {"r20": 0.5, "amount": 0.2, "turnover": 0.3}
    k = cs.pct_ranks(panels.dealt(returns(s, d).select("code", "date", *parts), "date", table=s.read.parquet(f"{d}/lineitem.parquet")), list(parts), "date")
    left = {c: x for c, x in parts.items() if c != "turnover"}
    score = lambda p: sum((F.col(c) * x for c, x in p.items()), F.lit(0.0))
    return rounded(k.select("code", "date", (score(left) / sum(left.values())).alias("score"), score(parts).alias("whole")), ["score", "whole"])


# --- joins ----------------------------------------------------------------------------------------


@query("c04_keep_and_drop_by_list", ", g AS (SELECT DISTINCT code FROM notices WHERE kind = '1-URGENT' AND date >= DATE '1998-01-01'), k AS (SELECT code FROM codes WHERE board IN ('ASIA', 'EUROPE')) SELECT code, COUNT(*) AS n FROM panel WHERE code IN (SELECT code FROM k) AND code NOT IN (SELECT code FROM g WHERE code % 2 = 0) GROUP BY code", BARS, NOTICES)
def c04(s, d):
    keep = panels.codes(s, d).where("board IN ('ASIA', 'EUROPE')").select("code")
    flagged = panels.notices(s, d).where("kind = '1-URGENT' AND date >= DATE'1998-01-01' AND code % 2 = 0").select("code").distinct()
    return panel(s, d).join(keep, "code", "left_semi").join(flagged, "code", "left_anti").groupBy("code").agg(F.count("*").alias("n"))


@query("c10_available_session", ", c AS (SELECT DISTINCT CAST(ts AS DATE) AS day FROM ticks) SELECT event_id, (SELECT MAX(day) FROM c WHERE CAST(day AS TIMESTAMP) + INTERVAL 555 MINUTE <= ts) AS session FROM ticks", DUCK_TICKS)
def c10(s, d):
    """The last session whose opening at 09:15 is not after the stamp."""
    t = panels.ticks(s, d).select("event_id", F.col("ts").cast("timestamp").alias("ts"))
    sessions = t.select(F.to_date("ts").alias("session")).distinct()
    opened = sessions.select("session", (F.unix_seconds(F.col("session").cast("timestamp")) + 555 * 60).alias("at"))
    # Each day is served by one session, so a day's stamps need the session of that day and the one before.
    marks = opened.select("session", "at", F.lag("session").over(Window.orderBy("session")).alias("before"))
    j = t.join(F.broadcast(marks), F.to_date("ts") == F.col("session"))
    return j.select("event_id", F.when(F.unix_micros("ts") >= F.col("at") * 1_000_000, F.col("session")).otherwise(F.col("before")).cast("string").alias("session"))


ORACLE_SQL["c10_available_session"] = ORACLE_SQL["c10_available_session"].replace("<= ts) AS session", "<= ts)::VARCHAR AS session")
PATH = {"max10": (10, "MAX(high)"), "max20": (20, "MAX(high)"), "max30": (30, "MAX(high)"), "min20": (20, "MIN(low)")}


@query("c14_path_after_event", RET + f", q AS (SELECT *, ROW_NUMBER() OVER ({BY}) AS i FROM p), e AS (SELECT a.code, a.date, a.close, b.i - a.i AS k, b.high, b.low FROM q a JOIN q b ON b.code = a.code AND b.i > a.i AND b.i <= a.i + 30 WHERE a.r >= 0.08) SELECT code, date, COUNT(*) AS n, " + ", ".join(r6(f"{'MAX(high)' if c != 'min20' else 'MIN(low)'} FILTER (k <= {k}) / close - 1", c) for c, (k, _) in PATH.items()) + ", CAST(COALESCE(MIN(k) FILTER (high / close - 1 >= 0.3), 99) AS BIGINT) AS day30 FROM e GROUP BY code, date, close")
def c14(s, d):
    q = returns(s, d).withColumn("i", F.row_number().over(w.by_code()))
    frame = lambda k: w.by_code().rowsBetween(1, k)
    path = [(F.max("high").over(frame(k)) / F.col("close") - 1).alias(c) if c != "min20" else (F.min("low").over(frame(k)) / F.col("close") - 1).alias(c) for c, (k, _) in PATH.items()]
    ahead30 = F.collect_list("high").over(frame(30))
    first = F.array_position(F.transform(ahead30, lambda h: h / F.col("close") - 1 >= 0.3), True)
    out = q.select("code", "date", "r", F.count("*").over(frame(30)).alias("n"), *path, F.when(first > 0, first).otherwise(99).alias("day30"))
    return rounded(out.where("r >= 0.08 AND n > 0"), list(PATH), ("code", "date", "n", "day30"))


@query("c17_dense_grid", ", days AS (SELECT DISTINCT date FROM panel WHERE date >= DATE '1998-01-01' AND date < DATE '1999-01-01'), e AS (SELECT code, date, COUNT(*) AS n FROM notices GROUP BY 1, 2), g AS (SELECT c.code, d.date, COALESCE(e.n, 0) AS n, e.n AS raw FROM codes c CROSS JOIN days d LEFT JOIN e ON e.code = c.code AND e.date = d.date) SELECT code, date, CAST(SUM(n) OVER (PARTITION BY code ORDER BY date ROWS BETWEEN 19 PRECEDING AND CURRENT ROW) AS BIGINT) AS n20, CAST(COALESCE(LAST_VALUE(raw IGNORE NULLS) OVER (PARTITION BY code ORDER BY date), 0) AS BIGINT) AS last FROM g", BARS, NOTICES)
def c17(s, d):
    """Every code on every date of a year: the grid grows with codes times dates, both dimensions."""
    days = panel(s, d).where("date >= DATE'1998-01-01' AND date < DATE'1999-01-01'").select("date").distinct()
    e = panels.notices(s, d).groupBy("code", "date").agg(F.count("*").alias("raw"))
    g = panels.codes(s, d).select("code").crossJoin(F.broadcast(days)).join(e, ["code", "date"], "left")
    last = F.last("raw", ignorenulls=True).over(w.by_code().rowsBetween(Window.unboundedPreceding, 0))
    return g.select("code", "date", F.sum(F.coalesce("raw", F.lit(0))).over(w.last_n(20)).alias("n20"), F.coalesce(last, F.lit(0)).alias("last"))


@query("c18_aligned_series", RET + ", s AS (SELECT board, date, AVG(r) AS x FROM p WHERE r IS NOT NULL GROUP BY 1, 2), b AS (SELECT DISTINCT board FROM s), c AS (SELECT DISTINCT date FROM panel) SELECT b.board, c.date, " + r6("s.x", "x") + " FROM b CROSS JOIN c LEFT JOIN s ON s.board = b.board AND s.date = c.date")
def c18(s, d):
    r = returns(s, d)
    x = r.where("r IS NOT NULL").groupBy("board", "date").agg(F.avg("r").alias("x"))
    every = r.select("date").distinct().crossJoin(F.broadcast(panels.codes(s, d).select("board").distinct().join(x.select("board").distinct(), "board", "left_semi")))
    return rounded(every.join(x, ["board", "date"], "left"), ["x"], ("board", "date"))


# --- aggregates -----------------------------------------------------------------------------------


@query("d03_limit_day_environment", FLAGS + ", g AS (SELECT date, CAST(SUM(lu) AS BIGINT) AS n_lu, CAST(SUM(zb) AS BIGINT) AS n_zb, CAST(SUM(ld) AS BIGINT) AS n_ld, SUM(amount) AS a FROM f GROUP BY date)" + rounded_sql({"zb_rate": "n_zb / NULLIF(CAST(n_lu + n_zb AS DOUBLE), 0)", "amount_ratio": "CASE WHEN COUNT(a) OVER v >= 20 THEN a / AVG(a) OVER v END"}, "g WINDOW v AS (ORDER BY date ROWS BETWEEN 60 PRECEDING AND 1 PRECEDING)", "date, n_lu, n_zb, n_ld"))
def d03(s, d):
    g = families.limit_flags(panel(s, d)).groupBy("date").agg(F.sum("lu").alias("n_lu"), F.sum("zb").alias("n_zb"), F.sum("ld").alias("n_ld"), F.sum("amount").alias("a"))
    v = Window.orderBy("date").rowsBetween(-60, -1)  # a row per date
    rate = F.col("n_zb") / F.nullif((F.col("n_lu") + F.col("n_zb")).cast("double"), F.lit(0.0))
    return rounded(g.select("date", "n_lu", "n_zb", "n_ld", rate.alias("zb_rate"), F.when(F.count("a").over(v) >= 20, F.col("a") / F.avg("a").over(v)).alias("amount_ratio")), ["zb_rate", "amount_ratio"], ("date", "n_lu", "n_zb", "n_ld"))


@query("d07_score_calibration", RET + LABELS + f", k AS (SELECT y, CAST(LEAST(FLOOR(({tied('r20')}) * 10), 9) AS BIGINT) AS band FROM u), g AS (SELECT band, COUNT(*) AS n, AVG(y) AS hit, SUM(y) AS k FROM k WHERE y IS NOT NULL AND band IS NOT NULL GROUP BY band)" + rounded_sql({"hit": "hit", "lift": "hit / (SUM(k) OVER () / SUM(n) OVER ())"}, "g", "band, n, COALESCE(hit >= LAG(hit) OVER (ORDER BY band), TRUE) AS rising"))
def d07(s, d):
    k = labelled(s, d).select("y", F.least(F.floor(cs.pct_rank("r20", "date") * 10), F.lit(9)).cast("long").alias("band")).where("y IS NOT NULL AND band IS NOT NULL")
    g = k.groupBy("band").agg(F.count("*").alias("n"), F.avg("y").alias("hit"), F.sum("y").alias("k"))  # ten rows
    whole = Window.partitionBy()
    lift = F.col("hit") / (F.sum("k").over(whole) / F.sum("n").over(whole))
    return rounded(g.select("band", "n", F.coalesce(F.col("hit") >= F.lag("hit").over(Window.orderBy("band")), F.lit(True)).alias("rising"), "hit", lift.alias("lift")), ["hit", "lift"], ("band", "n", "rising"))


@query("d09_event_history", FLAGS + f", g AS (SELECT board, lu, CASE WHEN COUNT(high) {ahead(20)} = 20 THEN LAST(close) {ahead(20)} / close - 1 END AS x FROM f), n AS (SELECT COUNT(DISTINCT date) AS days FROM panel) SELECT board, CAST(SUM(lu) AS BIGINT) AS events, " + r6("SUM(lu) * 21.0 / (SELECT days FROM n)", "per_month") + ", " + r6("QUANTILE_CONT(CASE WHEN lu = 1 THEN x END, 0.5)", "median") + ", " + r6("AVG(CASE WHEN lu = 1 AND x IS NOT NULL THEN CAST(x > 0 AS DOUBLE) END)", "up") + " FROM g GROUP BY board")
def d09(s, d):
    p = panel(s, d)
    after = F.when(F.count("high").over(w.ahead(20)) == 20, F.last("close").over(w.ahead(20)) / F.col("close") - 1)
    g = families.limit_flags(p).select("board", "lu", F.when(F.col("lu") == 1, after).alias("x"))
    n = p.select("date").distinct().agg(F.count("*").alias("days"))
    out = g.groupBy("board").agg(F.sum("lu").alias("events"), F.percentile("x", F.lit(0.5)).alias("median"), F.avg((F.col("x") > 0).cast("double")).alias("up")).crossJoin(F.broadcast(n))
    return rounded(out.withColumn("per_month", F.col("events") * 21.0 / F.col("days")), ["per_month", "median", "up"], ("board", "events"))


@query("d12_percentile_vector", RET + ", q AS (SELECT QUANTILE_CONT(r20, [" + ", ".join(f"{i / 100}" for i in range(101)) + "]) AS q FROM p) SELECT CAST(i - 1 AS INTEGER) AS k, " + r6("q[i]", "value") + " FROM q, (SELECT UNNEST(range(1, 102)) AS i)")
def d12(s, d):
    q = returns(s, d).agg(F.percentile("r20", F.array(*(F.lit(i / 100) for i in range(101)))).alias("q"))
    return rounded(q.select(F.posexplode("q").alias("k", "value")), ["value"], ("k",))


CORR = ("r", "r20", "r60", "turnover", "volume")


@query("d16_correlation_matrix", RET + ", " + ", ".join(f"m{i}{j} AS (SELECT '{a}' AS a, '{b}' AS b, ABS(CORR({a}, {b})) AS c FROM p)" for i, a in enumerate(CORR) for j, b in enumerate(CORR) if i < j) + " SELECT a, b, " + r6("c", "c") + " FROM (" + " UNION ALL ".join(f"SELECT * FROM m{i}{j}" for i in range(5) for j in range(5) if i < j) + ")")
def d16(s, d):
    pairs = [(a, b) for i, a in enumerate(CORR) for b in CORR[i + 1 :]]
    one = returns(s, d).agg(*(F.abs(F.corr(a, b)).alias(f"{a}|{b}") for a, b in pairs))
    rows = F.explode(F.array(*(F.struct(F.lit(a).alias("a"), F.lit(b).alias("b"), F.col(f"{a}|{b}").alias("c")) for a, b in pairs))).alias("x")
    return rounded(one.select(rows).select("x.*"), ["c"], ("a", "b"))


@query("d21_name_share", RET + PICKS + ", l AS (SELECT CAST(date_trunc('month', date) AS DATE) AS month, code, COUNT(*) AS n FROM k WHERE rank <= 10 GROUP BY 1, 2), f AS (SELECT code, MIN(month) AS first FROM l GROUP BY code) SELECT l.month, COUNT(*) AS names, CAST(SUM(n) AS BIGINT) AS picks, " + r6("MAX(n) / SUM(n)", "top_share") + ", " + r6("SUM(CASE WHEN month = first THEN n ELSE 0 END) / SUM(n)", "new_share") + " FROM l JOIN f ON f.code = l.code GROUP BY l.month")
def d21(s, d):
    l = picks(s, d, 10).groupBy(F.trunc("date", "month").alias("month"), "code").agg(F.count("*").alias("n"))
    l = l.withColumn("first", F.min("month").over(Window.partitionBy("code")))
    new = F.sum(F.when(F.col("month") == F.col("first"), F.col("n")).otherwise(0))
    return rounded(l.groupBy("month").agg(F.count("*").alias("names"), F.sum("n").alias("picks"), (F.max("n") / F.sum("n")).alias("top_share"), (new / F.sum("n")).alias("new_share")), ["top_share", "new_share"], ("month", "names", "picks"))


# --- families -------------------------------------------------------------------------------------

CELL = "LN(100) / 359"
CHIPS = f""", p AS (SELECT *, ROW_NUMBER() OVER ({BY}) AS i, LEAST(GREATEST(turnover, 0), 1) AS k, LN(high) AS h, LN(low) AS l, LN(close) AS c, FIRST(LN(close)) OVER ({BY}) - LN(10) AS o FROM panel),
barz AS (SELECT *, SUM(LN(1 - k)) OVER ({BY}) AS decay, GREATEST((h - l) / 2, {CELL}) AS half, (h + l + c) / 3 AS mid FROM p),
cells AS (SELECT code, i, decay, k, o, j, GREATEST(0, 1 - ABS(o + j * {CELL} - mid) / half) AS tri FROM (SELECT *, UNNEST(range(CAST(CEIL((l - {CELL} - o) / ({CELL})) AS BIGINT), CAST(FLOOR((h + {CELL} - o) / ({CELL})) AS BIGINT) + 1)) AS j FROM barz)),
bought AS (SELECT code, i, j, k * tri / SUM(tri) OVER (PARTITION BY code, i) AS m, decay FROM cells),
begun AS (SELECT code, j, MIN(i) AS i0 FROM bought WHERE m > 0 GROUP BY code, j),
held AS (SELECT t.code, t.i, n.j, t.c, t.o, EXP(t.decay) * SUM(COALESCE(b.m * EXP(-b.decay), 0)) OVER (PARTITION BY t.code, n.j ORDER BY t.i) AS m
         FROM begun n JOIN barz t ON t.code = n.code AND t.i >= n.i0 LEFT JOIN bought b ON b.code = t.code AND b.i = t.i AND b.j = n.j),
share AS (SELECT *, m / SUM(m) OVER (PARTITION BY code, i) AS s FROM held),
ends AS (SELECT *, EXP(o + j * {CELL}) AS price, SUM(s) OVER (PARTITION BY code, i ORDER BY j) AS below, MAX(s) OVER (PARTITION BY code, i) AS most FROM share),
one AS (SELECT code, i, SUM(s * price) AS avg_cost, SUM(CASE WHEN o + j * {CELL} <= c THEN s ELSE 0 END) AS winners,
               MIN(CASE WHEN below >= 0.05 THEN price END) AS p05, COALESCE(MIN(CASE WHEN below >= 0.95 THEN price END), MAX(price)) AS p95, MIN(CASE WHEN s >= most * (1 - 1e-9) THEN price END) AS peak FROM ends GROUP BY code, i),
basis AS (SELECT barz.code, barz.date, close, avg_cost, winners, (p95 - p05) / avg_cost AS width90, peak / close - 1 AS peak_gap FROM barz LEFT JOIN one ON one.code = barz.code AND one.i = barz.i)
"""


@query("e09_cost_basis", CHIPS + rounded_sql({"avg_cost": "avg_cost", "winners": "winners", "deviation": "close / avg_cost - 1"}, "basis", digits=4))
def e09(s, d):
    return rounded(costbasis.cost_basis(panel(s, d)), ["avg_cost", "winners", "deviation"], digits=4)


@query("e10_cost_basis_change", CHIPS + rounded_sql({"width90": "width90", "peak_gap": "peak_gap", "width_change20": f"width90 - {lag('width90', 20)}"}, "basis", digits=4))
def e10(s, d):
    return rounded(costbasis.cost_basis(panel(s, d)), ["width90", "peak_gap", "width_change20"], digits=4)


@query("e16_count_jumps", ", q AS (SELECT code, period, holders, ABS(holders / CAST(LAG(holders) OVER (PARTITION BY code ORDER BY period) AS DOUBLE) - 1) AS x FROM reports) SELECT code, period, COALESCE(x > 0.2, FALSE) AS jump FROM q", DUCK_DISCLOSURES)
def e16(s, d):
    before = F.lag("holders").over(Window.partitionBy("code").orderBy("period"))
    return panels.disclosures(s, d).select("code", "period", F.coalesce(F.abs(F.col("holders") / before - 1) > 0.2, F.lit(False)).alias("jump"))


def corr_sql(x: str, y: str, n: int) -> str:
    v = win(n)
    return f"CASE WHEN COUNT({x}) {v} = {n} AND COUNT({y}) {v} = {n} THEN COVAR_POP({x}, {y}) {v} / NULLIF(STDDEV_POP({x}) {v} * STDDEV_POP({y}) {v}, 0) END"


@query("e30_price_and_turnover", RET + f", q AS (SELECT *, ABS(r) AS ar, LN(turnover / {lag('turnover')}) AS dt, {lag('turnover')} AS t1 FROM p)" + rounded_sql({"r_dturn": corr_sql("r", "dt", 20), "abs_turn": corr_sql("ar", "turnover", 20), "r_turn1": corr_sql("r", "t1", 20)}, "q", digits=5))
def e30(s, d):
    q = returns(s, d).select("*", F.abs("r").alias("ar"), F.log(F.col("turnover") / w.lag("turnover")).alias("dt"), w.lag("turnover").alias("t1"))
    v = w.last_n(20)
    both = lambda x, y: F.when((F.count(x).over(v) == 20) & (F.count(y).over(v) == 20), w.safe_corr(F.col(x), F.col(y), v))
    return rounded(q.select("code", "date", both("r", "dt").alias("r_dturn"), both("ar", "turnover").alias("abs_turn"), both("r", "t1").alias("r_turn1")), ["r_dturn", "abs_turn", "r_turn1"], digits=5)


@query("e32_size_price_age", rounded_sql({"log_price": "LN(amount / volume)", "log_size": "LN(shares * close)", "age": f"LEAST(ROW_NUMBER() OVER ({BY}), 750)"}, "panel"))
def e32(s, d):
    p = panel(s, d)
    return rounded(p.select("code", "date", F.log(F.col("amount") / F.col("volume")).alias("log_price"), F.log(F.col("shares") * F.col("close")).alias("log_size"), F.least(F.row_number().over(w.by_code()), F.lit(750)).alias("age")), ["log_price", "log_size", "age"])


POOL = {
    "vol20": full("STDDEV_SAMP(r)", "r", 20),
    "amp20": mean("(high - low) / close", 20),
    "turn5": mean("turnover", 5),
    "to_high20": f"close / ({full('MAX(high)', 'close', 20)}) - 1",
    "to_high60": f"close / ({full('MAX(high)', 'close', 60)}) - 1",
    "pos20": f"(close - ({full('MIN(low)', 'close', 20)})) / NULLIF(({full('MAX(high)', 'close', 20)}) - ({full('MIN(low)', 'close', 20)}), 0)",
    "up20": full("SUM(CASE WHEN r > 0 THEN 1 ELSE 0 END)", "r", 20),
    "max1_20": full("MAX(r)", "r", 20),
    "amount_ratio": f"amount / {mean('amount', 20)}",
    "gap1": f"open / {lag('close')} - 1",
    "large20": full("SUM(CASE WHEN r >= 0.045 THEN 1 ELSE 0 END)", "r", 20),
    "ret_norm20": f"(close / {lag('close', 20)} - 1) / NULLIF(({full('STDDEV_SAMP(r)', 'r', 20)}), 0)",
}


@query("e34_pool_features", RET + rounded_sql(POOL, "p", digits=5))
def e34(s, d):
    p, r, c = returns(s, d), F.col("r"), F.col("close")
    over = lambda agg, x, n=20: w.full(agg, x, n, w.last_n(n))
    high20, low20 = over(F.max("high"), c), over(F.min("low"), c)
    out = {
        "vol20": over(F.stddev_samp(r), r),
        "amp20": w.mean((F.col("high") - F.col("low")) / c, 20),
        "turn5": w.mean("turnover", 5),
        "to_high20": c / high20 - 1,
        "to_high60": c / over(F.max("high"), c, 60) - 1,
        "pos20": (c - low20) / F.nullif(high20 - low20, F.lit(0.0)),
        "up20": over(F.sum(F.when(r > 0, 1).otherwise(0)), r),
        "max1_20": over(F.max(r), r),
        "amount_ratio": F.col("amount") / w.mean("amount", 20),
        "gap1": F.col("open") / w.lag("close") - 1,
        "large20": over(F.sum(F.when(r >= 0.045, 1).otherwise(0)), r),
        "ret_norm20": w.gain(20) / F.nullif(over(F.stddev_samp(r), r), F.lit(0.0)),
    }
    return rounded(p.select("code", "date", *(x.alias(k) for k, x in out.items())), list(out), digits=5)


# --- lists ----------------------------------------------------------------------------------------


@query("f01_pick_last_day", RET + PICKS + " SELECT date, code, rank FROM k WHERE date = (SELECT MAX(date) FROM k) AND rank <= 10")
def f01(s, d):
    p = returns(s, d).where("r20 IS NOT NULL")
    last = p.agg(F.max("date").alias("date"))
    return cs.top(p.join(F.broadcast(last), "date"), 10, [F.round("r20", 9).desc(), F.col("code")], "date").select("date", "code", "rank")


NUMBERED = ", c AS (SELECT date, ROW_NUMBER() OVER (ORDER BY date) AS day FROM (SELECT DISTINCT date FROM panel))"
MEMBERS = RET + PICKS + NUMBERED + ", l AS (SELECT k.code, k.date, c.day FROM k JOIN c ON c.date = k.date WHERE rank <= 10), m AS (SELECT *, COUNT(*) OVER (PARTITION BY code ORDER BY day RANGE BETWEEN 4 PRECEDING AND CURRENT ROW) AS hits, day - ROW_NUMBER() OVER (PARTITION BY code ORDER BY day) AS g FROM l), n AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY code, g ORDER BY day) AS streak FROM m)"


@query("f10_window_membership", MEMBERS + " SELECT date, COUNT(*) FILTER (hits >= 2) AS w1, COUNT(*) FILTER (streak >= 2) AS w2, COUNT(*) AS n FROM n GROUP BY date")
def f10(s, d):
    m = lists.membership(picks(s, d, 10).select("code", "date"), lists.day_numbers(panel(s, d)))
    return m.groupBy("date").agg(F.count_if(F.col("hits") >= 2).alias("w1"), F.count_if(F.col("streak") >= 2).alias("w2"), F.count("*").alias("n"))


@query("f11_listing_streaks", MEMBERS + " SELECT code, date, streak FROM n")
def f11(s, d):
    return lists.membership(picks(s, d, 10).select("code", "date"), lists.day_numbers(panel(s, d))).select("code", "date", F.col("streak").cast("long").alias("streak"))


RULES = {"momentum": {"a": 0.7, "b": 0.3}, "quiet": {"a": 0.5, "c": -0.5}}


@query("f12_weighted_rank_rules", RET + f", k AS (SELECT code, date, {tied('r20')} AS a, {tied('r60')} AS b, {tied('turnover')} AS c FROM p), s AS (SELECT 'momentum' AS rule, code, date, ROUND(0.7 * a + 0.3 * b, 9) AS score FROM k UNION ALL SELECT 'quiet', code, date, ROUND(0.5 * a - 0.5 * c, 9) FROM k), t AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY rule, date ORDER BY score DESC, code) AS rank FROM s WHERE score IS NOT NULL) SELECT rule, date, code, rank FROM t WHERE rank <= 3")
def f12(s, d):
    k = cs.pct_ranks(returns(s, d).select("code", "date", F.col("r20").alias("a"), F.col("r60").alias("b"), F.col("turnover").alias("c")), ["a", "b", "c"], "date")
    return cs.top(lists.rank_sums(k, RULES), 3, [F.round("score", 9).desc(), F.col("code")], "rule", "date").select("rule", "date", "code", "rank")


CUTS = [50, 60, 70, 80, 90]


@query("f13_threshold_from_the_past", RET + LABELS + f", k AS (SELECT CAST(date_trunc('month', date) AS DATE) AS month, FLOOR(({tied('r20')}) * 100) AS score, y FROM u), c AS (SELECT UNNEST({CUTS}) AS cut), m AS (SELECT DISTINCT month FROM k), g AS (SELECT m.month, c.cut, COUNT(k.y) AS n, SUM(k.y) AS k FROM m CROSS JOIN c LEFT JOIN k ON k.month < m.month AND k.score >= c.cut AND k.y IS NOT NULL GROUP BY 1, 2) SELECT month, CAST(MIN(CASE WHEN n >= 100 AND k >= 0.04 * n THEN cut END) AS DOUBLE) AS cut FROM g GROUP BY month")
def f13(s, d):
    k = labelled(s, d).select(F.trunc("date", "month").alias("month"), F.floor(cs.pct_rank("r20", "date") * 100).alias("score"), "y")
    return lists.past_threshold(k, CUTS, 0.04, 100).select("month", F.col("cut").cast("double").alias("cut"))


# --- truth and patterns ---------------------------------------------------------------------------


@query("h09_intraday_label", ", m AS (SELECT code, CAST(ts AS DATE) AS date, (MIN(ROW(ts, event_id, price)))[3] AS o, (MAX(ROW(ts, event_id, price)))[3] AS c, MAX(price) AS h, MIN(price) AS l FROM ticks GROUP BY 1, 2)" + rounded_sql({"r": "CASE WHEN h > l THEN c / o - 1 END"}, "m", "code, date, h = l AS dirty"), DUCK_TICKS)
def h09(s, d):
    order = F.struct("ts", "event_id")
    m = panels.ticks(s, d).groupBy("code", F.to_date("ts").alias("date")).agg(F.min_by("price", order).alias("o"), F.max_by("price", order).alias("c"), F.max("price").alias("h"), F.min("price").alias("l"))
    return rounded(m.select("code", "date", (F.col("h") == F.col("l")).alias("dirty"), F.when(F.col("h") > F.col("l"), F.col("c") / F.col("o") - 1).alias("r")), ["r"], ("code", "date", "dirty"))


@query("h10_truth_of_lists", RET + PICKS + f", f AS (SELECT code, date, COUNT(high) {ahead(20)} AS n, MAX(high) {ahead(20)} / close - 1 AS x FROM panel), g AS (SELECT *, COALESCE(CAST(x > 0.3 AS INT), 0) AS hit, CASE WHEN n = 20 THEN COALESCE(CAST(x > 0.3 AS INT), 0) END AS final FROM f), b AS (SELECT date, AVG(final) AS base FROM g GROUP BY date) SELECT k.date, COUNT(*) AS n, CAST(SUM(hit) AS BIGINT) AS hits, CAST(COALESCE(SUM(final), -1) AS BIGINT) AS final_hits, " + r6("MAX(x)", "best") + ", " + r6("ANY_VALUE(base)", "base") + " FROM k JOIN g ON g.code = k.code AND g.date = k.date JOIN b ON b.date = k.date WHERE rank <= 10 GROUP BY k.date")
def h10(s, d):
    t = lists.truth(picks(s, d, 10), panel(s, d)).withColumn("final_hits", F.coalesce("final_hits", F.lit(-1)))
    return rounded(t, ["best", "base"], ("date", "n", "hits", "final_hits"))


@query("i05_base_run", PREPARED + ", e AS (SELECT code, pos FROM p WHERE big), j AS (SELECT a.code, a.pos AS start, a.pos - b.pos AS k, b.close FROM e a JOIN p b ON a.code = b.code AND b.pos < a.pos), h AS (SELECT *, MAX(close) OVER v / MIN(close) OVER v - 1 > 0.3 AS out FROM j WINDOW v AS (PARTITION BY code, start ORDER BY k)) SELECT code, start, COALESCE(MIN(CASE WHEN out THEN k END) - 1, MAX(k)) AS run, NOT bool_or(out) AS to_the_end FROM h GROUP BY code, start")
def i05(s, d):
    bars = patterns.prepared(panel(s, d))
    return costbasis.base_runs(bars, bars.where("big").select("code", "pos"))


@query("i08_peaks_after_listing", RET + PICKS + f", f AS (SELECT code, MIN(date) AS first FROM k WHERE rank <= 3 AND date >= DATE '2001-03-01' GROUP BY code), q AS (SELECT p.code, p.close, f.first, ROW_NUMBER() OVER (PARTITION BY p.code ORDER BY p.date) AS i FROM panel p JOIN f ON f.code = p.code AND p.date >= f.first), g AS (SELECT code, first, COUNT(*) AS n, arg_min(close, i) AS s, arg_max(close, i) AS c, MIN(ROW(-close, i)) AS m FROM q GROUP BY code, first)" + rounded_sql({"rise": "-m[1] / s - 1", "drop": "c / -m[1] - 1"}, "g WHERE n >= 7 AND -m[1] / s - 1 >= 0.1 AND c / -m[1] - 1 > -0.2 AND c / -m[1] - 1 < -0.02 AND n - m[2] <= 30", "code, first"))
def i08(s, d):
    first = picks(s, d, 3).where("date >= DATE'2001-03-01'").groupBy("code").agg(F.min("date").alias("date"))
    return rounded(lists.peaks_after_listing(first, panel(s, d), 0.1, -0.2, -0.02, 30), ["rise", "drop"], ("code", "first"))


OPEN = """, b AS (SELECT *, COUNT(close) {w} AS n, MAX(close) {w} / MIN(close) {w} - 1 AS amp, AVG(volume) {w} AS bv FROM p), l AS (SELECT * FROM b WHERE n = 20 AND amp <= 0.6 AND big AND volume >= 1.2 * bv),
ends AS (SELECT code, MAX(pos) AS last, arg_max(close, pos) AS now FROM p GROUP BY code),
a AS (SELECT l.code, l.date AS launch_date, l.pos AS start, l.high AS lh, l.low AS ll, l.volume AS lv, ends.last, ends.now FROM l JOIN ends ON ends.code = l.code WHERE ends.last - l.pos BETWEEN 1 AND 10),
s AS (SELECT a.*, p.low, p.close, p.volume FROM a JOIN p ON p.code = a.code AND p.pos > a.start)
SELECT code, launch_date, COUNT(*) AS adjust_days, CAST(11 - COUNT(*) AS BIGINT) AS wait_left, COUNT(*) >= 2 AND AVG(volume) <= 0.8 * ANY_VALUE(lv) AS b_ok, """.format(w=win(20, 1))


@query("i03_open_patterns", PREPARED + OPEN + r6("100 * (ANY_VALUE(lh) / ANY_VALUE(now) - 1)", "to_high_pct") + " FROM s GROUP BY code, launch_date HAVING NOT bool_or(low < ll OR close > lh OR volume >= lv)")
def i03(s, d):
    return rounded(patterns.open_patterns(panel(s, d)), ["to_high_pct"], ("code", "launch_date", "adjust_days", "wait_left", "b_ok"))


# --- learning by sums -----------------------------------------------------------------------------


@query("k03_negative_weights", RET + LABELS + ", v AS (SELECT CAST(date_trunc('month', date) AS DATE) AS month, SUM(y) AS pos, COUNT(*) - SUM(y) AS neg FROM u WHERE y IS NOT NULL GROUP BY 1)" + rounded_sql({"weight": "LEAST(1, 12 * pos / CAST(NULLIF(neg, 0) AS DOUBLE))"}, "v", "month"))
def k03(s, d):
    v = labelled(s, d).where("y IS NOT NULL").groupBy(F.trunc("date", "month").alias("month")).agg(F.sum("y").alias("pos"), (F.count("*") - F.sum("y")).alias("neg"))
    return rounded(v.select("month", F.when(F.col("neg") > 0, F.least(F.lit(1.0), 12 * F.col("pos") / F.col("neg"))).otherwise(1.0).alias("weight")), ["weight"], ("month",))


@query("k17_segment_factors", RET + LABELS + ", g AS (SELECT CAST(date_trunc('month', date) AS DATE) AS month, board, COUNT(*) AS n, SUM(y) AS k FROM u WHERE y IS NOT NULL GROUP BY 1, 2), c AS (SELECT month, board, COALESCE(SUM(n) OVER v, 0) AS n, COALESCE(SUM(k) OVER v, 0) AS k FROM g WINDOW v AS (PARTITION BY board ORDER BY month ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)), p AS (SELECT *, SUM(k) OVER (PARTITION BY month) / NULLIF(SUM(n) OVER (PARTITION BY month), 0) AS p FROM c)".replace(", p AS (SELECT *, SUM(k)", ", q AS (SELECT *, SUM(k)") + rounded_sql({"factor": "COALESCE(LEAST(GREATEST((k + 50 * p) / (n + 50) / NULLIF(p, 0), 0.6), 1.4), 1)"}, "q", "month, board, CAST(n AS BIGINT) AS n, CAST(k AS BIGINT) AS k"))
def k17(s, d):
    rows = labelled(s, d).withColumn("month", F.trunc("date", "month"))
    return rounded(lists.shrunk_factors(rows, "board", "y"), ["factor"], ("month", "board", "n", "k"))


GRID = [(a, b) for a in (0.0, 0.1, 0.2) for b in (15.0, 30.0)]


@query("k23_parameter_grid", RET + LABELS + ", g(gain_min, volume_min) AS (VALUES " + ", ".join(f"(CAST({a} AS DOUBLE), CAST({b} AS DOUBLE))" for a, b in GRID) + ") SELECT gain_min, volume_min, COUNT(y) AS n, " + r6("AVG(y)", "rate") + " FROM u, g WHERE r20 >= gain_min AND volume >= volume_min GROUP BY 1, 2")
def k23(s, d):
    keep = (F.col("r20") >= F.col("gain_min")) & (F.col("volume") >= F.col("volume_min"))
    return rounded(lists.grid(labelled(s, d), GRID, "gain_min double, volume_min double", keep, "y"), ["rate"], ("gain_min", "volume_min", "n"))


@query("k24_view_of_a_code", RET + PICKS + " SELECT date, " + r6("r20", "r20") + ", rank, CAST(SUM(CASE WHEN rank <= 10 THEN 1 ELSE 0 END) OVER (ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS BIGINT) AS listed FROM k WHERE code = 7")
def k24(s, d):
    """One code's rank of each day among all codes, and how often it was listed so far."""
    ranked = cs.top(returns(s, d).where("r20 IS NOT NULL"), 1 << 30, [F.round("r20", 9).desc(), F.col("code")], "date").where("code = 7")
    listed = F.sum((F.col("rank") <= 10).cast("long")).over(w.by_code().rowsBetween(Window.unboundedPreceding, 0))
    return rounded(ranked.select("code", "date", "rank", listed.alias("listed"), "r20"), ["r20"], ("date", "rank", "listed"))


# --- evaluation -----------------------------------------------------------------------------------


@query("l17_conditional_hits", RET + LABELS + f", k AS (SELECT date, y, {tied('turnover')} AS a FROM u WHERE y IS NOT NULL), g AS (SELECT date, AVG(CASE WHEN a > CAST(2 AS DOUBLE) / 3 THEN y END) - AVG(CASE WHEN a <= CAST(1 AS DOUBLE) / 3 THEN y END) AS d FROM k GROUP BY date) SELECT COUNT(d) AS n, " + r6("AVG(d)", "diff") + ", " + r6("AVG(CAST(d > 0 AS DOUBLE))", "positive") + " FROM g WHERE d IS NOT NULL")
def l17(s, d):
    k = labelled(s, d).where("y IS NOT NULL").select("date", "y", cs.terciles("turnover", "date").alias("third"))
    g = k.groupBy("date").agg((F.avg(F.when(F.col("third") == "hi", F.col("y"))) - F.avg(F.when(F.col("third") == "lo", F.col("y")))).alias("d")).where("d IS NOT NULL")
    return rounded(g.agg(F.count("*").alias("n"), F.avg("d").alias("diff"), F.avg((F.col("d") > 0).cast("double")).alias("positive")), ["diff", "positive"], ("n",))


@query("l18_effect_of_a_notice_class", RET + LABELS + ", e AS (SELECT DISTINCT code, date, kind FROM notices), b AS (SELECT date, AVG(y) AS base FROM u WHERE y IS NOT NULL GROUP BY date), j AS (SELECT e.kind, u.y, b.base FROM u JOIN e ON e.code = u.code AND e.date = u.date JOIN b ON b.date = u.date WHERE u.y IS NOT NULL) SELECT kind, COUNT(*) AS n, " + r6("AVG(y)", "hit") + ", " + r6("AVG(base)", "base") + ", " + r6("AVG(y - base)", "diff") + ", " + r6("SUM(y) / CAST((SELECT SUM(y) FROM u) AS DOUBLE)", "recall") + " FROM j GROUP BY kind", BARS, NOTICES)
def l18(s, d):
    u = labelled(s, d).where("y IS NOT NULL").select("code", "date", "y", F.avg("y").over(Window.partitionBy("date")).alias("base"))
    e = panels.notices(s, d).select("code", "date", "kind").distinct()
    whole = u.agg(F.sum("y").alias("all"))
    g = u.join(e, ["code", "date"]).groupBy("kind").agg(F.count("*").alias("n"), F.avg("y").alias("hit"), F.avg("base").alias("base"), F.avg(F.col("y") - F.col("base")).alias("diff"), F.sum("y").alias("k"))
    return rounded(g.crossJoin(F.broadcast(whole)).withColumn("recall", F.col("k") / F.col("all")), ["hit", "base", "diff", "recall"], ("kind", "n"))


# --- alternative data -----------------------------------------------------------------------------


def signed_notices(s, d):
    side = F.when(F.col("kind").isin("1-URGENT", "2-HIGH"), 1.0).when(F.col("kind") == "5-LOW", -1.0).otherwise(0.0)
    return panels.notices(s, d).groupBy("code", "date").agg(F.sum(F.col("size") * side).alias("net"), F.sum("size").alias("total"), F.count_if(F.col("size") > 200000).alias("blocks"))


SIGNED = ", e AS (SELECT code, date, SUM(size * CASE WHEN kind IN ('1-URGENT', '2-HIGH') THEN 1 WHEN kind = '5-LOW' THEN -1 ELSE 0 END) AS net, SUM(size) AS total, COUNT(*) FILTER (size > 200000) AS blocks FROM notices GROUP BY 1, 2), q AS (SELECT p.code, p.date, p.amount, COALESCE(net, 0) AS net, COALESCE(total, 0) AS total, COALESCE(blocks, 0) AS blocks FROM panel p LEFT JOIN e ON e.code = p.code AND e.date = p.date)"


@query("m02_net_of_seats", SIGNED + rounded_sql({"net5": f"SUM(net) {win(5)} / SUM(amount) {win(5)}", "net20": f"SUM(net) {win(20)} / SUM(amount) {win(20)}"}, "q", digits=4), BARS, NOTICES)
def m02(s, d):
    q = panel(s, d).join(signed_notices(s, d), ["code", "date"], "left").fillna(0, ["net"])
    return rounded(q.select("code", "date", *((F.sum("net").over(w.last_n(n)) / F.sum("amount").over(w.last_n(n))).alias(f"net{n}") for n in (5, 20))), ["net5", "net20"], digits=4)


@query("m05_block_counts", SIGNED + f" SELECT code, date, CAST(SUM(blocks) {win(5)} AS BIGINT) AS n5, CAST(SUM(blocks) {win(20)} AS BIGINT) AS n20 FROM q", BARS, NOTICES)
def m05(s, d):
    q = panel(s, d).join(signed_notices(s, d), ["code", "date"], "left").fillna(0, ["blocks"])
    return q.select("code", "date", *(F.sum("blocks").over(w.last_n(n)).alias(f"n{n}") for n in (5, 20)))


HOLDERS = ", h AS (SELECT *, holders / CAST(LAG(holders) OVER v AS DOUBLE) - 1 AS chg1, holders / CAST(LAG(holders, 3) OVER v AS DOUBLE) - 1 AS chg3 FROM reports WINDOW v AS (PARTITION BY code ORDER BY period)), j AS (SELECT p.code, p.date, (SELECT MAX(ROW(notice, period, chg1, chg3)) FROM h WHERE h.code = p.code AND h.notice <= p.date) AS m FROM panel p)"


@query("m06_holder_changes", HOLDERS + rounded_sql({"chg1": "m[3]", "chg3": "m[4]", "stale": "date - m[1]"}, "j"), BARS, DUCK_DISCLOSURES)
def m06(s, d):
    v = Window.partitionBy("code").orderBy("period")
    h = panels.disclosures(s, d).select("*", *((F.col("holders") / F.lag("holders", k).over(v) - 1).alias(f"chg{k}") for k in (1, 3)))
    return rounded(joins.as_of(panel(s, d), h, "notice", ["chg1", "chg3"], "period").withColumnRenamed("age", "stale"), ["chg1", "chg3", "stale"])


@query("m07_visits", ", e AS (SELECT code, date, COUNT(*) AS n FROM notices WHERE kind = '3-MEDIUM' GROUP BY 1, 2), q AS (SELECT p.code, p.date, COALESCE(n, 0) AS n FROM panel p LEFT JOIN e ON e.code = p.code AND e.date = p.date)" + f" SELECT code, date, CAST(SUM(n) {win(21)} AS BIGINT) AS n21, CAST(SUM(n) {win(63)} AS BIGINT) AS n63 FROM q", BARS, NOTICES)
def m07(s, d):
    e = panels.notices(s, d).where("kind = '3-MEDIUM'").groupBy("code", "date").agg(F.count("*").alias("n"))
    q = panel(s, d).join(e, ["code", "date"], "left").fillna(0, ["n"])
    return q.select("code", "date", *(F.sum("n").over(w.last_n(n)).alias(f"n{n}") for n in (21, 63)))


@query("m08_ratio_change", ", j AS (SELECT p.code, p.date, (SELECT MAX(ROW(notice + 3, period, holders)) FROM reports h WHERE h.code = p.code AND h.notice + 3 <= p.date) AS m FROM panel p), q AS (SELECT code, date, CAST(m[3] AS DOUBLE) AS x FROM j)" + rounded_sql({"x": "x", "change65": f"x - {lag('x', 65)}"}, "q"), BARS, DUCK_DISCLOSURES)
def m08(s, d):
    h = panels.disclosures(s, d).withColumn("known", F.date_add("notice", 3)).withColumn("x", F.col("holders").cast("double"))
    q = joins.as_of(panel(s, d).select("code", "date"), h, "known", ["x"], "period")
    return rounded(q.withColumn("change65", F.col("x") - w.lag("x", 65)), ["x", "change65"])


# --- intraday -------------------------------------------------------------------------------------


@query("n01_day_checks", ", m AS (SELECT code, CAST(ts AS DATE) AS date, COUNT(*) AS n, COUNT(DISTINCT time_bucket(INTERVAL 60 minutes, ts)) AS hours, SUM(value) AS v FROM ticks GROUP BY 1, 2) SELECT code, date, n, hours, hours >= 2 AND v > 0 AS complete FROM m", DUCK_TICKS)
def n01(s, d):
    m = panels.ticks(s, d).groupBy("code", F.to_date("ts").alias("date")).agg(F.count("*").alias("n"), F.countDistinct(F.date_trunc("hour", "ts")).alias("hours"), F.sum("value").alias("v"))
    return m.select("code", "date", "n", "hours", ((F.col("hours") >= 2) & (F.col("v") > 0)).alias("complete"))


@query("n03_volume_shape", ", m AS (SELECT code, CAST(ts AS DATE) AS date, value, CASE WHEN hour(ts) < 12 THEN value ELSE 0 END AS am, ROW_NUMBER() OVER (PARTITION BY code, CAST(ts AS DATE) ORDER BY value DESC, event_id) AS i FROM ticks)" + rounded_sql({"am_share": "SUM(am) / NULLIF(SUM(value), 0)", "top_share": "SUM(CASE WHEN i <= 3 THEN value ELSE 0 END) / NULLIF(SUM(value), 0)"}, "m GROUP BY code, date", "code, date"), DUCK_TICKS)
def n03(s, d):
    t = panels.ticks(s, d).withColumn("date", F.to_date("ts"))
    t = t.withColumn("i", F.row_number().over(Window.partitionBy("code", "date").orderBy(F.col("value").desc(), "event_id")))
    whole = F.nullif(F.sum("value"), F.lit(0.0))
    g = t.groupBy("code", "date").agg((F.sum(F.when(F.hour("ts") < 12, F.col("value")).otherwise(0.0)) / whole).alias("am_share"), (F.sum(F.when(F.col("i") <= 3, F.col("value")).otherwise(0.0)) / whole).alias("top_share"))
    return rounded(g, ["am_share", "top_share"])


@query("n05_signed_flow", ", m AS (SELECT code, CAST(ts AS DATE) AS date, SUM(CASE WHEN side > 0 THEN value ELSE 0 END) AS b, SUM(CASE WHEN side < 0 THEN value ELSE 0 END) AS s, SUM(value) AS v, COUNT(*) FILTER (value >= 150) AS large FROM ticks GROUP BY 1, 2)" + rounded_sql({"net": "(b - s) / NULLIF(v, 0)"}, "m", "code, date, large"), DUCK_TICKS)
def n05(s, d):
    signed = lambda k: F.sum(F.when(F.signum("side") == k, F.col("value")).otherwise(0.0))
    g = panels.ticks(s, d).groupBy("code", F.to_date("ts").alias("date")).agg(((signed(1) - signed(-1)) / F.nullif(F.sum("value"), F.lit(0.0))).alias("net"), F.count_if(F.col("value") >= 150).alias("large"))
    return rounded(g, ["net"], ("code", "date", "large"))


@query("p02_curve_scores", RET + f", q AS (SELECT code, date, open / {lag('close')} - 1 AS gap, volume / {lag('volume')} AS vr, (close - low) / NULLIF(high - low, 0) AS pos FROM p)" + rounded_sql({"gap_score": "CASE WHEN gap <= -0.05 OR gap >= 0.15 THEN 0 WHEN gap <= 0.03 THEN (gap + 0.05) / 0.08 ELSE (0.15 - gap) / 0.12 END", "volume_score": "CASE WHEN vr IS NOT NULL THEN LEAST(GREATEST(LN(vr) / LN(5), 0), 1) END", "place_score": "CASE WHEN pos > 0.8 THEN 1 WHEN pos > 0.5 THEN 0.5 WHEN pos IS NOT NULL THEN 0 END"}, "q"))
def p02(s, d):
    q = panel(s, d).select("code", "date", (F.col("open") / w.lag("close") - 1).alias("gap"), (F.col("volume") / w.lag("volume")).alias("vr"), ((F.col("close") - F.col("low")) / F.nullif(F.col("high") - F.col("low"), F.lit(0.0))).alias("pos"))
    volume = F.when(F.col("vr").isNotNull(), scalars.clip(F.log("vr") / F.log(F.lit(5.0)), 0.0, 1.0))
    place = F.when(F.col("pos") > 0.8, 1.0).when(F.col("pos") > 0.5, 0.5).when(F.col("pos").isNotNull(), 0.0)
    gap = F.when(F.col("gap").isNotNull(), scalars.tent(F.col("gap"), -0.05, 0.15, 0.03))
    return rounded(q.select("code", "date", gap.alias("gap_score"), volume.alias("volume_score"), place.alias("place_score")), ["gap_score", "volume_score", "place_score"])


@query("u02_custom_kernel", RET + rounded_sql({"worst3": f"CASE WHEN COUNT(r) {win(10)} = 10 THEN list_sum(list_sort(LIST(r) {win(10)})[1:3]) END"}, "p"))
def u02(s, d):
    """Any function of a window's values as a higher-order expression, here the sum of the three lowest."""
    kernel = lambda values: F.aggregate(F.slice(F.sort_array(values), 1, 3), F.lit(0.0), lambda a, x: a + x)
    r = F.col("r")
    return rounded(returns(s, d).select("code", "date", F.when(F.count(r).over(w.last_n(10)) == 10, kernel(F.collect_list(r).over(w.last_n(10)))).alias("worst3")), ["worst3"])


@query("u07_months_between", " SELECT code, CAST(UNNEST(generate_series(date_trunc('month', MIN(date)), date_trunc('month', MAX(date)), INTERVAL 1 MONTH)) AS DATE) AS month FROM panel GROUP BY code")
def u07(s, d):
    span = panel(s, d).groupBy("code").agg(F.trunc(F.min("date"), "month").alias("a"), F.trunc(F.max("date"), "month").alias("b"))
    return span.select("code", F.explode(F.expr("sequence(a, b, INTERVAL 1 MONTH)")).alias("month"))
