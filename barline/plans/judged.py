"""Queries of amplitude, robust days, buyers, holders, peers, titles, and of scores and rules judged by what followed."""

from __future__ import annotations

from pyspark.sql import functions as F

from barline.functions import titles
from barline.operators import crosssection as cs
from barline.operators import families, holders, peers, selection
from barline.operators import windows as w
from barline.plans.helpers import BY, lag, rounded, rounded_sql, win
from barline.plans.panels import LABELS, RET, labelled, returns
from barline.sources.panels import BARS, dealt, duck, panel

QUERIES: dict = {}
ORACLE_SQL: dict = {}


def query(name: str, sql: str, *parts: str):
    """Registers the decorated function with its SQL over the derivations named."""

    def register(function):
        QUERIES[name] = function
        ORACLE_SQL[name] = duck(*(parts or (BARS,))) + sql
        return function

    return register


AMPLITUDE = f""", a AS (SELECT *, high / low - 1 AS amp, {lag('close')} AS before, close / {lag('close')} - 1 AS r FROM panel),
b AS (SELECT *, list_sort(LIST({{'c': close, 'v': amp}}) {win(20)}) AS s20, list_sort(LIST({{'c': amp, 'v': r}}) {win(120)}) AS s120,
             COUNT(amp) {win(20)} AS n20, COUNT(r) {win(120)} AS n120, COUNT(before) {win(20)} AS nb FROM a)"""


def _ends(s: str, k: int) -> tuple[str, str]:
    return f"list_sum(list_transform({s}[1:{k}], lambda x: x.v))", f"list_sum(list_transform({s}[-{k}:], lambda x: x.v))"


_LOW, _HIGH = _ends("s20", 5)
_CALM, _WILD = _ends("s120", 36)


@query("e33_amplitude", AMPLITUDE + rounded_sql({
    "ideal20": f"CASE WHEN n20 = 20 THEN ({_HIGH} - {_LOW}) / 5 END",
    "cut120": f"CASE WHEN n120 = 120 THEN {_CALM} - {_WILD} END",
    "push20": f"CASE WHEN n20 = 20 THEN SUM(high - open) {win(20)} / (SUM(open - low) {win(20)} + 1e-9) END",
    "range20": f"CASE WHEN nb = 20 THEN SUM(GREATEST(high - before, 0)) {win(20)} / (SUM(GREATEST(before - low, 0)) {win(20)} + 1e-9) END",
}, "b"))
def e33(s, d):
    return rounded(families.amplitude(panel(s, d)), ["ideal20", "cut120", "push20", "range20"])


def _huber_sql(steps: int = 10, c: float = 1.345) -> str:
    held = f"(CASE WHEN ABS(x.x - m) <= {c} * s THEN x.w ELSE x.w * {c} * s / ABS(x.x - m) END)"
    step = "h{} AS (SELECT date, v, s, list_sum(list_transform(v, lambda x: x.x * {})) / NULLIF(list_sum(list_transform(v, lambda x: {})), 0) AS m FROM h{})"
    return ", ".join(step.format(k, held, held, k - 1) for k in range(1, steps + 1))


@query("d18_robust_location", RET + f""", q AS (SELECT date, code, r AS x, turnover AS w FROM p WHERE r IS NOT NULL AND turnover > 0),
c AS (SELECT *, SUM(w) OVER (PARTITION BY date ORDER BY x, w, code ROWS UNBOUNDED PRECEDING) AS run, SUM(w) OVER (PARTITION BY date) / 2 AS half FROM q),
wm AS (SELECT date, MIN(x) AS middle, ANY_VALUE(half) AS half FROM c WHERE run >= half GROUP BY date),
g0 AS (SELECT date, LIST({{'x': x, 'w': w}} ORDER BY x, w) AS v, MEDIAN(x) AS m FROM q GROUP BY date),
h0 AS (SELECT date, v, m, CAST(1.4826 AS DOUBLE) * list_aggregate(list_transform(v, lambda x: ABS(x.x - m)), 'median') AS s FROM g0), {_huber_sql()},
o AS (SELECT h10.date, CAST(len(v) AS BIGINT) AS n, CASE WHEN s > 0 THEN m ELSE middle END AS location FROM h10 JOIN wm ON wm.date = h10.date)""" + rounded_sql({"location": "location"}, "o", "date, n"))
def d18(s, d):
    return rounded(cs.huber_location(returns(s, d), "r", "turnover", "date"), ["location"], ("date", "n"))


BUYERS = """
b AS (SELECT l_orderkey, l_linenumber, o_custkey AS buyer, CAST(l_shipdate AS DATE) - DATE '1990-01-01' AS day, l_suppkey AS code,
             CASE WHEN l_returnflag = 'N' THEN NULL ELSE CAST(l_returnflag = 'R' AS INT) END AS y
      FROM lineitem JOIN orders ON o_orderkey = l_orderkey)
"""


def _buyers(s, d):
    o = s.read.parquet(f"{d}/orders.parquet").select("o_orderkey", F.col("o_custkey").alias("buyer"))
    rows = s.read.parquet(f"{d}/lineitem.parquet").select("l_orderkey", "l_linenumber", "l_suppkey", "l_shipdate", "l_returnflag")
    outcome = F.when(F.col("l_returnflag") != "N", (F.col("l_returnflag") == "R").cast("int"))
    day = F.datediff(F.to_date("l_shipdate"), F.lit("1990-01-01")).cast("long")
    b = dealt(rows, "l_orderkey").join(o, F.col("o_orderkey") == F.col("l_orderkey")).select("l_orderkey", "l_linenumber", "buyer", day.alias("day"), F.col("l_suppkey").alias("code"), outcome.alias("y"))
    return families.buyer_history(dealt(b, "buyer", table=rows), "buyer", "day", "y")


HISTORY = """, h AS (SELECT *, COUNT(*) OVER (PARTITION BY buyer ORDER BY day RANGE BETWEEN 249 PRECEDING AND CURRENT ROW) AS n250,
  COUNT(y) OVER (PARTITION BY buyer ORDER BY day RANGE BETWEEN 271 PRECEDING AND 21 PRECEDING) AS hit_n,
  SUM(y) OVER (PARTITION BY buyer ORDER BY day RANGE BETWEEN 271 PRECEDING AND 21 PRECEDING) AS hits FROM b),
hr AS (SELECT *, (COALESCE(hits, 0) + CAST(0.8 AS DOUBLE)) / (hit_n + 10) AS hit_rate FROM h)"""


@query("m09_buyer_history", HISTORY + rounded_sql({"hit_rate": "hit_rate"}, "hr", "l_orderkey, l_linenumber, buyer, day, n250, hit_n"), BUYERS)
def m09(s, d):
    return rounded(_buyers(s, d), ["hit_rate"], ("l_orderkey", "l_linenumber", "buyer", "day", "n250", "hit_n"))


@query("m10_buyers_of_a_day", HISTORY + rounded_sql({"hit": "SUM(hit_rate * n250) / SUM(n250)"}, "hr GROUP BY code, day", "code, day, COUNT(*) AS n, COUNT(DISTINCT buyer) AS buyers, MAX(n250) AS most, CAST(SUM(n250) AS BIGINT) AS total"), BUYERS)
def m10(s, d):
    rows = dealt(_buyers(s, d).select("code", "day", "buyer", "n250", "hit_rate"), "code", "day", table=s.read.parquet(f"{d}/lineitem.parquet"))
    g = rows.groupBy("code", "day").agg(F.count("*").alias("n"), F.countDistinct("buyer").alias("buyers"), F.max("n250").alias("most"), F.sum("n250").alias("total"), (F.sum(F.col("hit_rate") * F.col("n250")) / F.sum("n250")).alias("hit"))
    return rounded(g, ["hit"], ("code", "day", "n", "buyers", "most", "total"))


@query("c16_peers", RET + """, q AS (SELECT date, CAST(date_trunc('month', date) AS DATE) AS month, year(date) * 12 + month(date) AS mon, sector, code, r FROM p WHERE r IS NOT NULL),
m AS (SELECT a.code, b.code AS peer, a.month, a.mon, COUNT(*) AS n, SUM(a.r) AS sx, SUM(b.r) AS sy, SUM(a.r * a.r) AS sxx, SUM(b.r * b.r) AS syy, SUM(a.r * b.r) AS sxy
      FROM q a JOIN q b ON a.sector = b.sector AND a.date = b.date AND a.code <> b.code GROUP BY 1, 2, 3, 4),
t AS (SELECT month, code, peer, """ + ", ".join(f"SUM({c}) OVER (PARTITION BY code, peer ORDER BY mon RANGE BETWEEN 12 PRECEDING AND 1 PRECEDING) AS {c}" for c in ("n", "sx", "sy", "sxx", "syy", "sxy")) + """ FROM m),
u AS (SELECT month, code, peer, ROUND((n * sxy - sx * sy) / NULLIF(SQRT(GREATEST(n * sxx - sx * sx, 0)) * SQRT(GREATEST(n * syy - sy * sy, 0)), 0), 9) AS corr FROM t WHERE n >= 10),
k AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY month, code ORDER BY corr DESC, peer) AS place FROM u WHERE corr IS NOT NULL),
j AS (SELECT a.code, a.date, a.r AS own, b.r AS theirs, corr FROM q a JOIN k ON k.month = a.month AND k.code = a.code AND place <= 20 JOIN q b ON b.date = a.date AND b.code = k.peer)""" + rounded_sql({"peer_r": "AVG(theirs)", "rest": "ANY_VALUE(own) - AVG(theirs)", "corr": "AVG(corr)"}, "j GROUP BY code, date", "code, date, COUNT(*) AS n"))
def c16(s, d):
    return rounded(peers.beside_peers(returns(s, d), "sector"), ["peer_r", "rest", "corr"], ("code", "date", "n"))


@query("k16_cumulative_precision", RET + LABELS + f""", v AS (SELECT date, CAST(date_trunc('month', date) AS DATE) AS month, ROUND(r20, 3) AS score, y, LEAD(date, 20) OVER ({BY}) AS closed FROM u),
kn AS (SELECT date, score, y, CAST(month + to_months(i) AS DATE) AS month FROM (SELECT *, UNNEST(generate_series(1, 12)) AS i FROM v WHERE score IS NOT NULL AND y IS NOT NULL AND closed IS NOT NULL) WHERE closed < CAST(month + to_months(i) AS DATE)),
sc AS (SELECT month, score, COUNT(*) AS k, SUM(y) AS hits FROM kn GROUP BY 1, 2),
dy AS (SELECT month, score, COUNT(*) AS days FROM (SELECT month, date, MAX(score) AS score FROM kn GROUP BY 1, 2) GROUP BY 1, 2),
ca AS (SELECT sc.*, SUM(k) OVER w AS rk, SUM(hits) OVER w AS rh, SUM(COALESCE(days, 0)) OVER w AS rd FROM sc LEFT JOIN dy ON dy.month = sc.month AND dy.score = sc.score WINDOW w AS (PARTITION BY sc.month ORDER BY sc.score DESC)),
wa AS (SELECT month, score, COUNT(*) AS n FROM v WHERE score IS NOT NULL AND month IN (SELECT month FROM ca) GROUP BY 1, 2),
an AS (SELECT wa.*, CASE WHEN rk >= 200 AND rd >= 20 THEN rh / rk ELSE 0 END AS p FROM wa ASOF LEFT JOIN ca ON ca.month = wa.month AND ca.score >= wa.score)""" + rounded_sql({"score": "score", "p": "COALESCE(p, 0)"}, "an", "month, n"))
def k16(s, d):
    rows = labelled(s, d).withColumn("closed", F.lead("date", 20).over(w.by_code()))
    return rounded(selection.cumulative_precision(rows, "r20", "y", "closed"), ["score", "p"], ("month", "n"))


#: Names of the predicates, with their SQL; the same text serves both engines.
PREDICATES = {"rose20": "r20 > 0.1", "fell20": "r20 < -0.1", "rose60": "r60 > 0.2", "fell60": "r60 < -0.2", "busy": "turnover > 0.01", "up": "close > open", "strong": "r > 0.01", "wide": "high > 1.02 * low"}


@query("k19_conjunctions", RET + LABELS + ", q AS (SELECT y, date >= DATE '1999-01-01' AS later, " + " + ".join(f"CASE WHEN {p} THEN {1 << i} ELSE 0 END" for i, p in enumerate(PREDICATES.values())) + """ AS mask FROM u WHERE y IS NOT NULL),
g AS (SELECT rule, COUNT(*) FILTER (NOT later) AS n_fit, CAST(COALESCE(SUM(y) FILTER (NOT later), 0) AS BIGINT) AS k_fit, COUNT(*) FILTER (later) AS n_confirm, CAST(COALESCE(SUM(y) FILTER (later), 0) AS BIGINT) AS k_confirm
      FROM (SELECT CAST(UNNEST(generate_series(1, 255)) AS INTEGER) AS rule) JOIN q ON rule & mask = rule AND bit_count(rule) <= 3 GROUP BY rule)
SELECT *, n_fit >= 100 AND k_fit >= CAST(0.15 AS DOUBLE) * n_fit AND n_confirm >= 100 AND k_confirm >= CAST(0.15 AS DOUBLE) * n_confirm AS kept FROM g""")
def k19(s, d):
    return selection.conjunctions(labelled(s, d), [F.expr(p) for p in PREDICATES.values()], "y", F.col("date") >= F.lit("1999-01-01").cast("date"))


@query("l20_future_invariance", f""", c AS (SELECT MIN(date) + CAST((MAX(date) - MIN(date)) // 2 AS INTEGER) AS cut FROM panel),
a AS (SELECT panel.*, cut FROM panel, c), z1 AS (SELECT code, date, cut, close FROM a), z2 AS (SELECT code, date, cut, CASE WHEN date > cut THEN close * (1 + (code % 7 + 1) / CAST(100 AS DOUBLE)) ELSE close END AS close FROM a),
f1 AS (SELECT code, date, cut, ROUND(close / {lag('close', 5)} - 1, 9) AS past, ROUND(LEAD(close, 5) OVER ({BY}) / close - 1, 9) AS ahead FROM z1),
f2 AS (SELECT code, date, cut, ROUND(close / {lag('close', 5)} - 1, 9) AS past, ROUND(LEAD(close, 5) OVER ({BY}) / close - 1, 9) AS ahead FROM z2)
SELECT f1.code, COUNT(*) AS n, COUNT(*) FILTER (f2.code IS NULL) AS missing, COUNT(*) FILTER (f1.past IS DISTINCT FROM f2.past) AS past_changed, COUNT(*) FILTER (f1.ahead IS DISTINCT FROM f2.ahead) AS ahead_changed
FROM f1 LEFT JOIN f2 ON f1.code = f2.code AND f1.date = f2.date WHERE f1.date <= f1.cut GROUP BY f1.code""")
def l20(s, d):
    """A feature of the past and a label of the future, computed twice: the label changes before the cut, the feature doesn't."""
    bars = panel(s, d).select("code", "date", "close")
    cut = bars.agg(F.expr("date_add(min(date), cast(floor(datediff(max(date), min(date)) / 2) as int))").alias("cut"))
    dated = bars.join(F.broadcast(cut))  # one row
    features = lambda df: df.select("code", "date", "cut", F.round(F.col("close") / w.lag("close", 5) - 1, 9).alias("past"), F.round(F.lead("close", 5).over(w.by_code()) / F.col("close") - 1, 9).alias("ahead")).where("date <= cut").drop("cut")
    changed = F.when(F.col("date") > F.col("cut"), F.col("close") * (1 + (F.col("code") % 7 + 1) / 100)).otherwise(F.col("close"))
    return selection.future_changes(features(dated), features(dated.withColumn("close", changed)), ["past", "ahead"])


TITLES = "t AS (SELECT p_partkey AS id, p_brand AS code, p_brand || ': about ' || p_name || ' ' || p_type || ' notice' AS title FROM part)"


def _titles(s, d):
    title = F.concat("p_brand", F.lit(": about "), "p_name", F.lit(" "), "p_type", F.lit(" notice"))
    return s.read.parquet(f"{d}/part.parquet").select(F.col("p_partkey").alias("id"), F.col("p_brand").alias("code"), title.alias("title"))


@query("b16_announced", " SELECT id, regexp_replace(regexp_replace(regexp_replace(title, '^[^:]*:', ''), '^.*?about ', ''), ' notice$', '')[1:12] AS short FROM t WHERE contains(title, 'ring') AND NOT contains(title, 'small') AND NOT regexp_matches(title, 'ECONOMY|PROMO')", TITLES)
def b16(s, d):
    t = F.col("title")
    return _titles(s, d).where(titles.announces(t, "ring", ("small",), "ECONOMY|PROMO")).select("id", titles.shortened(t, 12, "^[^:]*:", "^.*?about ", " notice$").alias("short"))


#: Name of a class: prefix of the code, pattern of the title, pattern that excludes.
CLASSES = {"ring": ("", "ring|band", "small"), "first": ("Brand#1", "", ""), "cheap": ("Brand#2", "ECONOMY|STANDARD", "red|blue"), "large": ("", "large|big|jumbo", "")}


@query("b17_title_classes", " SELECT id, class FROM (" + " UNION ALL ".join(f"SELECT id, '{n}' AS class FROM t WHERE ({' OR '.join([f'starts_with(code, {chr(39)}{p}{chr(39)})'] * bool(p) + [f'regexp_matches(title, {chr(39)}{q}{chr(39)})'] * bool(q))})" + f" AND NOT regexp_matches(title, '{x}')" * bool(x) for n, (p, q, x) in CLASSES.items()) + ")", TITLES)
def b17(s, d):
    return _titles(s, d).select("id", F.explode(titles.classes(F.col("title"), F.col("code"), CLASSES)).alias("class"))


@query("m13_top_holders", """, h AS (SELECT code, period, holder, SUM(size) AS size FROM hr GROUP BY 1, 2, 3),
k AS (SELECT * FROM (SELECT *, SUM(size) OVER (PARTITION BY code, period) AS whole, ROW_NUMBER() OVER (PARTITION BY code, period ORDER BY size DESC, holder) AS place FROM h) WHERE place <= 10),
g AS (SELECT code, period, COUNT(*) AS n, SUM(size) / ANY_VALUE(whole) AS ratio, MAX(size) / ANY_VALUE(whole) AS largest FROM k GROUP BY 1, 2),
q AS (SELECT *, LAG(period) OVER v AS before, ratio - LAG(ratio) OVER v AS change FROM g WINDOW v AS (PARTITION BY code ORDER BY period)),
o AS (SELECT q.code, q.period, ANY_VALUE(q.n) AS n, COUNT(*) FILTER (q.before IS NOT NULL AND b.holder IS NULL) AS n_new, COUNT(*) FILTER (k.size > b.size) AS n_up, ANY_VALUE(ratio) AS ratio, ANY_VALUE(change) AS change, ANY_VALUE(largest) AS largest
      FROM q JOIN k ON k.code = q.code AND k.period = q.period LEFT JOIN k b ON b.code = q.code AND b.period = q.before AND b.holder = k.holder GROUP BY 1, 2)""" + rounded_sql({"ratio": "ratio", "change": "change", "largest": "largest"}, "o", "code, period, n, n_new, n_up"), "hr AS (SELECT l_suppkey AS code, CAST(date_trunc('quarter', l_shipdate) AS DATE) AS period, o_custkey AS holder, l_quantity AS size FROM lineitem JOIN orders ON o_orderkey = l_orderkey)")
def m13(s, d):
    o = s.read.parquet(f"{d}/orders.parquet").select("o_orderkey", F.col("o_custkey").alias("holder"))
    rows = s.read.parquet(f"{d}/lineitem.parquet").select("l_orderkey", F.col("l_suppkey").alias("code"), F.to_date(F.date_trunc("quarter", "l_shipdate")).alias("period"), F.col("l_quantity").alias("size"))
    out = holders.top_holders(rows.join(o, F.col("o_orderkey") == F.col("l_orderkey")), "holder", "size")
    return rounded(out, ["ratio", "change", "largest"], ("code", "period", "n", "n_new", "n_up"))
