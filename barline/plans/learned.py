"""Queries of fitted models over months: boosted trees, linear models, calibration, and what judges them."""

from __future__ import annotations

import datetime

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from barline.operators import boosting, calibration, judging, learning, linear, lists
from barline.operators import windows as w
from barline.plans.helpers import BY, lag, rounded, rounded_sql, win
from barline.plans.panels import LABELS, RET, labelled, r6
from barline.sources import panels
from barline.sources.panels import BARS, duck
from barline.sources.roundtrips import written

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


# --- boosted trees --------------------------------------------------------------------------------

#: Months that are evaluated, each by a model of the rows before it.
MONTHS = [datetime.date(1997, m, 1) for m in range(1, 13)]
FEATURES = ["r20", "r60", "r", "turnover", "spread", "above", "busy", "amount"]
FEATURE_SQL = {"spread": "(high - low) / close", "above": f"CASE WHEN COUNT(close) {win(20)} >= 20 THEN close / AVG(close) {win(20)} - 1 END", "busy": f"CASE WHEN COUNT(volume) {win(20)} >= 20 THEN AVG(volume) {win(5)} / AVG(volume) {win(20)} END"}
P = boosting.Boosting()


def featured(s, d):
    """Labelled rows with the features of the learners, rounded so that equal ones rank alike in any engine."""
    rows = labelled(s, d).withColumns({"spread": (F.col("high") - F.col("low")) / F.col("close"), "above": F.col("close") / w.mean("close", 20) - 1, "busy": F.avg("volume").over(w.last_n(5)) / w.mean("volume", 20)})
    return rows.select("code", "date", "board", "y", *(F.round(F.col(f).cast("double"), 9).alias(f) for f in FEATURES))


FEATURED = f""", feat0 AS (SELECT *, {", ".join(f"{e} AS {n}" for n, e in FEATURE_SQL.items())}, LEAD(date, {P.gap}) OVER ({BY}) AS closed FROM u),
feat AS (SELECT code, date, board, y, closed, CAST(date_trunc('month', date) AS DATE) AS month, {", ".join(f"ROUND(CAST({f} AS DOUBLE), 9) AS {f}" for f in FEATURES)} FROM feat0)"""


def boosting_sql(p: boosting.Boosting) -> str:
    """The whole learner in SQL: bins, slices, sampling, weights, and every level of every tree; tables ``scored`` and ``grown``."""
    n = len(FEATURES)
    rank = lambda f: f"CASE WHEN {f} IS NULL THEN {p.bins} ELSE (RANK() OVER (PARTITION BY date ORDER BY {f} NULLS LAST) - 1) * {p.bins} // COUNT({f}) OVER (PARTITION BY date) END"
    cols = ", ".join(f"b{k}" for k in range(n))
    bs = f"[{cols}]"
    out = [
        f"bn AS MATERIALIZED (SELECT code, date, board, month, closed, y, (code * 7919 + CAST(date - DATE '1970-01-01' AS BIGINT) * 104729) % {boosting.DRAWS} AS u, {', '.join(f'{rank(f)} AS b{k}' for k, f in enumerate(FEATURES))} FROM feat)",
        "mo(model, mon) AS (VALUES " + ", ".join(f"({k}, DATE '{m}')" for k, m in enumerate(MONTHS)) + ")",
        "sh AS (SELECT month, SUM(y) AS pos, SUM(1 - y) AS neg FROM bn WHERE y IS NOT NULL AND closed IS NOT NULL GROUP BY month)",
        f"tr0 AS (SELECT model, bn.*, {bs} AS x FROM bn JOIN sh ON sh.month = bn.month JOIN mo ON bn.closed < mon AND bn.date >= mon - INTERVAL {p.months_back} MONTH WHERE y IS NOT NULL AND closed IS NOT NULL AND (y = 1 OR u * neg < {p.per_positive} * pos * {boosting.DRAWS}))",
        "sz AS (SELECT model, month, COUNT(*) AS k, SUM(COUNT(*)) OVER (PARTITION BY model) AS total, COUNT(*) OVER (PARTITION BY model) AS months FROM tr0 GROUP BY model, month)",
        "tr AS MATERIALIZED (SELECT tr0.model, row_number() OVER () AS id, y, u, x, total / CAST(months AS DOUBLE) / k AS w FROM tr0 JOIN sz ON sz.model = tr0.model AND sz.month = tr0.month)",
        "bs AS MATERIALIZED (SELECT model, ROUND(LN(q / (1 - q)), 9) AS base FROM (SELECT model, LEAST(GREATEST(SUM(w * y) / SUM(w), 1e-6), 1 - 1e-6) AS q FROM tr GROUP BY model))",
        "m0 AS (SELECT tr.*, base AS margin FROM tr JOIN bs ON bs.model = tr.model)",
        f"s0 AS (SELECT bn.code, bn.date, bn.board, bn.month, bn.y, mo.model, {bs} AS x, COALESCE(base, 0) AS margin FROM bn JOIN mo ON mo.mon = bn.month LEFT JOIN bs ON bs.model = mo.model)",
    ]
    grown = []
    for t in range(p.trees):
        out.append(f"t{t}l0 AS MATERIALIZED (SELECT *, 1 AS node, w * (1 / (1 + EXP(-margin)) - y) AS g, w / (1 + EXP(-margin)) * (1 - 1 / (1 + EXP(-margin))) AS h, u * {p.step(t)} % {boosting.DRAWS} % 10 < {p.rows} AS seen FROM m{t})")
        out.append(f"c{t}l0 AS (SELECT *, 1 AS node FROM s{t})")
        seen = [f for f in range(n) if p.sees(t, f)]
        for lv in range(p.depth):
            out += [
                f"h{t}l{lv} AS (SELECT model, node, f, x[f + 1] AS b, SUM(g) AS g, SUM(h) AS h FROM t{t}l{lv}, (SELECT UNNEST({seen}) AS f) WHERE seen AND node >= {1 << lv} GROUP BY ALL)",
                f"q{t}l{lv} AS (SELECT *, SUM(g) OVER c AS gl, SUM(h) OVER c AS hl, SUM(g) OVER a AS gw, SUM(h) OVER a AS hw FROM h{t}l{lv} WINDOW c AS (PARTITION BY model, node, f ORDER BY b), a AS (PARTITION BY model, node, f))",
                f"g{t}l{lv} AS (SELECT *, ROUND(gl * gl / (hl + {p.l2}) + (gw - gl) * (gw - gl) / (hw - hl + {p.l2}) - gw * gw / (hw + {p.l2}), 7) AS gain FROM q{t}l{lv} WHERE hl >= {p.least} AND hw - hl >= {p.least})",
                f"b{t}l{lv} AS MATERIALIZED (SELECT model, node, f, b FROM g{t}l{lv} WHERE gain > 0 QUALIFY ROW_NUMBER() OVER (PARTITION BY model, node ORDER BY gain DESC, f, b) = 1)",
            ]
            for name in ("t", "c"):
                out.append(f"{name}{t}l{lv + 1} AS MATERIALIZED (SELECT r.* REPLACE (CASE WHEN s.f IS NULL THEN r.node ELSE 2 * r.node + CAST(r.x[s.f + 1] > s.b AS INT) END AS node) FROM {name}{t}l{lv} r LEFT JOIN b{t}l{lv} s ON s.model = r.model AND s.node = r.node)")
        leaf = f"t{t}l{p.depth}"
        out += [
            f"v{t} AS MATERIALIZED (SELECT model, node, COUNT(*) AS n, SUM(g) AS g, SUM(h) AS h, -{p.rate} * SUM(g) / (SUM(h) + {p.l2}) AS value FROM {leaf} WHERE seen GROUP BY model, node)",
            f"m{t + 1} AS MATERIALIZED (SELECT r.model, id, y, u, x, w, margin + COALESCE(value, 0) AS margin FROM {leaf} r LEFT JOIN v{t} v ON v.model = r.model AND v.node = r.node)",
            f"s{t + 1} AS MATERIALIZED (SELECT r.code, r.date, r.board, r.month, r.y, r.model, x, margin + COALESCE(value, 0) AS margin FROM c{t}l{p.depth} r LEFT JOIN v{t} v ON v.model = r.model AND v.node = r.node)",
        ]
        grown.append(f"SELECT model, {t} AS tree, * EXCLUDE (model) FROM v{t}")
    out += ["grown AS (" + " UNION ALL ".join(grown) + ")", f"scored AS (SELECT * EXCLUDE (x), ROUND(margin, 9) AS p FROM s{p.trees})"]
    return ", " + ",\n".join(out)


@query(
    "k07_boosted_trees",
    RET + LABELS + FEATURED + boosting_sql(P) + f""",
fold AS (SELECT model, COUNT(*) AS trained, SUM(y) AS positives FROM tr GROUP BY model),
pk AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY date ORDER BY p DESC, code) <= 3 AS pick FROM scored WHERE y IS NOT NULL)
SELECT month, trained, CAST(positives AS BIGINT) AS positives, COUNT(*) AS rows, CAST(SUM(CAST(pick AS INT)) AS BIGINT) AS picks, {r6("AVG(y)", "base")}, {r6("AVG(CASE WHEN pick THEN y END)", "hit")}, {r6("AVG(CASE WHEN pick THEN y END) / NULLIF(AVG(y), 0)", "lift")}
FROM pk JOIN fold ON fold.model = pk.model GROUP BY month, trained, positives""",
)
def k07(s, d):
    """Twelve months, each picked by trees of the months before: training rows, positives, picks of three codes a day, hit, base and lift."""
    scored, _, table = boosting.walk_forward(featured(s, d), FEATURES, MONTHS, P)
    fold = table.groupBy("model").agg(F.count("*").alias("trained"), F.sum("y").alias("positives"))
    place = F.row_number().over(Window.partitionBy("date").orderBy(F.col("margin").desc(), "code"))
    picked = scored.where("y IS NOT NULL").withColumn("pick", place <= 3).join(F.broadcast(fold), "model")
    hit, base = F.avg(F.when(F.col("pick"), F.col("y"))), F.avg("y")
    out = picked.groupBy("month", "trained", "positives").agg(F.count("*").alias("rows"), F.sum(F.col("pick").cast("int")).alias("picks"), base.alias("base"), hit.alias("hit"), (hit / F.nullif(base, F.lit(0.0))).alias("lift"))
    return rounded(out, ["base", "hit", "lift"], ("month", "trained", "positives", "rows", "picks"))


@query("k07_leaves", RET + LABELS + FEATURED + boosting_sql(P) + rounded_sql({"g": "g", "h": "h", "value": "value"}, "grown JOIN mo ON mo.model = grown.model", "mon AS month, tree, CAST(node AS INT) AS node, n", 5))
def k07_leaves(s, d):
    """Every leaf of every tree: the rows it saw, their sums of gradient and curvature, and its value."""
    _, forest, _ = boosting.walk_forward(featured(s, d), FEATURES, MONTHS, P)
    return rounded(boosting.nodes(forest, MONTHS, s).where("feature < 0"), ["g", "h", "value"], ("month", "tree", "node", "n"), 5)


def averaged_sql(arms: list[boosting.Boosting]) -> str:
    """Each arm's whole learner as a query of its own, and the mean of their margins."""
    own = ", ".join(f"arm{k} AS MATERIALIZED (WITH {boosting_sql(p)[2:]} SELECT code, date, month, y, p FROM scored WHERE y IS NOT NULL)" for k, p in enumerate(arms))
    every = " UNION ALL ".join(f"SELECT * FROM arm{k}" for k in range(len(arms)))
    return f""", {own}, av AS (SELECT code, date, month, y, ROUND(AVG(p), 8) AS p FROM ({every}) GROUP BY code, date, month, y), pk AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY date ORDER BY p DESC, code) <= 3 AS pick FROM av)
SELECT month, COUNT(*) AS rows, CAST(SUM(CAST(pick AS INT)) AS BIGINT) AS picks, {r6("AVG(y)", "base")}, {r6("AVG(CASE WHEN pick THEN y END)", "hit")}, {r6("AVG(p)", "margin")} FROM pk GROUP BY month"""


def averaged(s, d, arms: list[boosting.Boosting]):
    """Months picked by the mean margin of several learners."""
    alike: dict = {}  # arms of the same bins and gap share a table
    for p in arms:
        alike.setdefault((p.bins, p.gap), []).append(p)
    every = None
    for own in alike.values():
        ready = boosting.prepared(featured(s, d), FEATURES, own[0])
        scored = boosting.walk(ready, MONTHS, own)[0].where("y IS NOT NULL").select("code", "date", "month", "y", "margin").withColumn("_arms", F.lit(len(own)))
        every = scored if every is None else every.unionByName(scored)
    if len(alike) > 1:
        every = every.groupBy("code", "date", "month", "y").agg((F.sum(F.col("margin") * F.col("_arms")) / F.sum("_arms")).alias("margin"))
    mean = every.withColumn("margin", F.round("margin", 8))
    place = F.row_number().over(Window.partitionBy("date").orderBy(F.col("margin").desc(), "code"))
    g = mean.withColumn("pick", place <= 3).groupBy("month").agg(F.count("*").alias("rows"), F.sum(F.col("pick").cast("int")).alias("picks"), F.avg("y").alias("base"), F.avg(F.when(F.col("pick"), F.col("y"))).alias("hit"), F.avg("margin").alias("margin"))
    return rounded(g, ["base", "hit", "margin"], ("month", "rows", "picks"))


@query(
    "k09_acceptance",
    RET + LABELS + FEATURED + boosting_sql(P) + f""", pk AS (SELECT * FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY date ORDER BY p DESC, code) AS k FROM scored WHERE y IS NOT NULL) WHERE k <= 3),
bd AS (SELECT board, AVG(y) AS r, COUNT(*) AS n FROM pk GROUP BY board HAVING COUNT(*) >= 20),
ck AS (SELECT 'hit' AS test, AVG(y) AS value, CAST(0.15 AS DOUBLE) AS "limit", AVG(y) >= 0.15 AS ok FROM pk
UNION ALL SELECT 'months without a hit', COUNT(*), 1, COUNT(*) <= 1 FROM (SELECT month FROM pk GROUP BY month HAVING SUM(y) = 0)
UNION ALL SELECT 'best board over worst', MAX(r) / GREATEST(MIN(r), 1e-9), 3, MAX(r) / GREATEST(MIN(r), 1e-9) <= 3 FROM bd HAVING COUNT(*) >= 2)
SELECT test, {r6("value", "value")}, "limit", ok FROM ck""",
)
def k09(s, d):
    """Whether the boosted trees may go live: share of hits, months without any, and how far boards lie apart."""
    scored = boosting.walk_forward(featured(s, d), FEATURES, MONTHS, P)[0].where("y IS NOT NULL")
    place = F.row_number().over(Window.partitionBy("date").orderBy(F.col("margin").desc(), "code"))
    picks = scored.withColumn("_k", place).where("_k <= 3").join(F.broadcast(panels.codes(s, d).select("code", "board")), "code")
    out = judging.acceptance(picks.select("month", "board", "y"), s.createDataFrame([(m,) for m in MONTHS], "month date"))
    return rounded(out, ["value"], ("test", "limit", "ok"))


SEEDS = [boosting.Boosting(trees=4, seed=k) for k in range(3)]
WINDOWS = [boosting.Boosting(trees=4, months_back=k) for k in (12, 24, 48)]


@query("k11_seed_bagging", RET + LABELS + FEATURED + averaged_sql(SEEDS))
def k11(s, d):
    """The mean of three boosted models that see other rows and features."""
    return averaged(s, d, SEEDS)


@query("k12_window_ensemble", RET + LABELS + FEATURED + averaged_sql(WINDOWS))
def k12(s, d):
    """The mean of models of the last 12, 24 and 48 months."""
    return averaged(s, d, WINDOWS)


# --- linear models --------------------------------------------------------------------------------

#: Every month that has both months before it to learn from and labels of its own.
EVERY = [datetime.date(y, m, 1) for y in range(1993, 1999) for m in range(1, 13)]
LEAST = 10
L1 = 20.0
DATED = ["date", *FEATURES]
SLICE = f""", sl AS (SELECT month, SUM(y) AS pos, SUM(1 - y) AS neg FROM feat WHERE y IS NOT NULL AND closed IS NOT NULL GROUP BY month),
sk AS (SELECT *, (code * 7919 + CAST(date - DATE '1970-01-01' AS BIGINT) * 104729) % {boosting.DRAWS} AS u FROM feat WHERE y IS NOT NULL AND closed IS NOT NULL),
ev(mon) AS (VALUES {", ".join(f"(DATE '{m}')" for m in EVERY)}),
tn AS (SELECT mon, sk.* FROM sk JOIN sl ON sl.month = sk.month JOIN ev ON sk.closed < mon AND sk.date >= mon - INTERVAL {P.months_back} MONTH WHERE y = 1 OR u * neg < {P.per_positive} * pos * {boosting.DRAWS}),
fo AS (SELECT mon, COUNT(*) AS trained, SUM(y) AS positives, MIN(date) AS first, MAX(date) AS last FROM tn GROUP BY mon HAVING SUM(y) >= {LEAST} AND SUM(1 - y) >= {LEAST})"""


def sliced(s, d, features=tuple(FEATURES), source=None):
    """Rows with features, written once as they are read four times, the written training table of all months, and its folds."""
    rows = written(boosting.closing(featured(s, d) if source is None else source, P), "features")
    table = written(boosting.slices(rows, EVERY, P, keep=["date", *features]).sortWithinPartitions("model"), "slices")
    fold = table.groupBy("model").agg(F.count("*").alias("trained"), F.sum("y").alias("positives"), F.sum(1 - F.col("y")).alias("_neg"), F.min("date").alias("first"), F.max("date").alias("last"))
    return rows, table, fold.where((F.col("positives") >= LEAST) & (F.col("_neg") >= LEAST)).drop("_neg")


def monthed(fold, s):
    """Folds with the month of their model."""
    return fold.join(F.broadcast(s.createDataFrame(list(enumerate(EVERY)), "model int, month date")), "model")


def sound(fitted, s):
    """Whether each model meets its optimality conditions, by model."""
    return s.createDataFrame([(k, bool(v <= 1e-7)) for k, v in enumerate(fitted.violation.tolist())], "model int, optimal boolean")


def evaluated(s, d):
    """Scored rows of every month by a sparse logistic model of the months before, and the folds."""
    rows, table, fold = sliced(s, d)
    kept = table.join(F.broadcast(fold.select("model")), "model")  # a row a month
    fitted = linear.fit(kept, FEATURES, len(EVERY), l1=L1)
    tested = boosting.of_months(rows.where("y IS NOT NULL"), EVERY).join(F.broadcast(fold.select("model")), "model")
    p = linear.scored(tested.select("code", "date", "month", "y", "model", *FEATURES), fitted.predict, FEATURES)
    place = F.row_number().over(Window.partitionBy("date").orderBy(F.round("p", 9).desc(), "code"))
    return p.withColumn("pick", place <= 10), fold, fitted


@query(
    "k05_walk_forward",
    RET + LABELS + FEATURED + SLICE + f""", pk AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY date ORDER BY code) <= 10 AS pick FROM feat WHERE y IS NOT NULL)
SELECT mon AS month, trained, CAST(positives AS BIGINT) AS positives, first, last, COUNT(*) AS rows, CAST(SUM(CAST(pick AS INT)) AS BIGINT) AS picks, TRUE AS optimal, {r6("AVG(y)", "base")} FROM fo JOIN pk ON pk.month = mon GROUP BY mon, trained, positives, first, last""",
)
def k05(s, d):
    """Every month by a sparse logistic model on eight features: training rows, positives and their dates, rows, base and picks; and that each model is optimal."""
    scored, fold, fitted = evaluated(s, d)
    out = scored.groupBy("month", "model").agg(F.count("*").alias("rows"), F.sum(F.col("pick").cast("int")).alias("picks"), F.avg("y").alias("base"))
    out = out.join(F.broadcast(fold), "model").join(F.broadcast(sound(fitted, s)), "model")
    return rounded(out, ["base"], ("month", "trained", "positives", "first", "last", "rows", "picks", "optimal"))


@query("k05_hits", None)
def k05_hits(s, d):
    """What k05's picks hit, beside the base of all codes, by month."""
    scored, _, _ = evaluated(s, d)
    hit, base = F.avg(F.when(F.col("pick"), F.col("y"))), F.avg("y")
    return scored.groupBy("month").agg(hit.alias("hit"), base.alias("base"), (hit / F.nullif(base, F.lit(0.0))).alias("lift"))


@query("k06_sparse_logistic", RET + LABELS + FEATURED + SLICE + " SELECT mon AS month, trained, CAST(positives AS BIGINT) AS positives, TRUE AS optimal, TRUE AS sparse FROM fo")
def k06(s, d):
    """Sparse logistic models on standardised features: optimal under an absolute penalty of 20, with no more than the eight coefficients."""
    _, table, fold = sliced(s, d)
    fitted = linear.fit(table.join(F.broadcast(fold.select("model")), "model"), FEATURES, len(EVERY), l1=L1)
    left = s.createDataFrame([(k, int((b[:-1] != 0).sum()) <= len(FEATURES)) for k, b in enumerate(fitted.beta)], "model int, sparse boolean")
    return monthed(fold.drop("first", "last"), s).join(F.broadcast(sound(fitted, s)), "model").join(F.broadcast(left), "model").drop("model")


#: Inputs whose coefficients may not be negative, and the dummies of boards beside them.
MONOTONE = ["r20", "r60", "busy", "turnover"]
BOARDS = ["AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"]


@query("k14_monotone_logistic", RET + LABELS + FEATURED + SLICE + ", nm(name) AS (VALUES " + ", ".join(f"('{n}')" for n in MONOTONE) + ") SELECT mon AS month, trained, CAST(positives AS BIGINT) AS positives, name, TRUE AS optimal, TRUE AS not_negative FROM fo, nm")
def k14(s, d):
    """Logistic models with four coefficients of 0 or more, board dummies and a ridge: every month meets its optimality conditions."""
    dummies = {f"is_{b.split()[0].lower()}": (F.col("board") == b).cast("double") for b in BOARDS}
    names = [*MONOTONE, *dummies]
    _, table, fold = sliced(s, d, tuple(names), featured(s, d).withColumns(dummies))
    fitted = linear.fit(table.join(F.broadcast(fold.select("model")), "model"), names, len(EVERY), l2=1e-3, at_least_zero=tuple(MONOTONE))
    values = linear.coefficients(fitted, EVERY, s).where(F.col("name").isin(MONOTONE)).select("month", "name", (F.col("value") >= 0).alias("not_negative"))
    return monthed(fold.drop("first", "last"), s).join(F.broadcast(sound(fitted, s)), "model").join(values, "month").select("month", "trained", "positives", "name", "optimal", "not_negative")


#: Any scorer will do; this one's weights are fixed.
WEIGHTS = {"r20": 1.5, "r60": -0.5, "busy": 0.25, "turnover": 2.0}


def fixed_scorer(model, x):
    """A scorer of any origin: features in, probabilities out; a null counts as 0."""
    import numpy as np

    return 1 / (1 + np.exp(-(np.nan_to_num(x, nan=0.0) @ np.array(list(WEIGHTS.values())) - 2.0)))


@query("u05_any_scorer", RET + LABELS + FEATURED + rounded_sql({"p": "1 / (1 + EXP(2.0" + "".join(f" - {w} * COALESCE({n}, 0)" for n, w in WEIGHTS.items()) + "))"}, "feat"))
def u05(s, d):
    rows = featured(s, d).select("code", "date", F.lit(0).alias("model"), *WEIGHTS)
    return rounded(linear.scored(rows, fixed_scorer, list(WEIGHTS)), ["p"])


def by_board(train, test):
    """A learner of its own: the rate of the board, shrunk to the whole by 20 rows."""
    return _rates(train, test, F.col("board")).withColumn("arm", F.lit("board"))


def by_gain(train, test):
    """Another: the rate of the fifth of the 20-row return within the day."""
    return _rates(train, test, F.coalesce(F.floor(F.col("r20") * 10), F.lit(-99))).withColumn("arm", F.lit("gain"))


def _rates(train, test, key):
    whole = train.agg(F.avg("y").alias("_all"))
    rates = train.groupBy(key.alias("_k")).agg(F.sum("y").alias("_s"), F.count("*").alias("_n"))
    d = test.withColumn("_k", key).join(rates, "_k", "left").crossJoin(whole)
    return d.select("code", "date", "y", ((F.coalesce("_s", F.lit(0)) + 20 * F.col("_all")) / (F.coalesce("_n", F.lit(0)) + 20)).alias("p"))


def _callback_sql(arm: str, key: str) -> str:
    return f"""SELECT '{arm}' AS arm, te.mon AS month, te.y, (COALESCE(ra.s, 0) + 20 * al.q) / (COALESCE(ra.n, 0) + 20) AS p FROM (SELECT month AS mon, y, {key} AS k FROM feat WHERE y IS NOT NULL AND month IN (SELECT mon FROM mo)) te
JOIN (SELECT mon, AVG(y) AS q FROM cb GROUP BY mon) al ON al.mon = te.mon LEFT JOIN (SELECT mon, {key} AS k, SUM(y) AS s, COUNT(*) AS n FROM cb GROUP BY 1, 2) ra ON ra.mon = te.mon AND ra.k = te.k"""


@query(
    "u03_fit_predict_callback",
    RET + LABELS + FEATURED + ", mo(mon) AS (VALUES " + ", ".join(f"(DATE '{m}')" for m in MONTHS) + f"), cb AS (SELECT mon, feat.* FROM feat JOIN mo ON closed < mon AND date >= mon - INTERVAL {P.months_back} MONTH WHERE y IS NOT NULL), pr AS (" + _callback_sql("board", "board") + " UNION ALL " + _callback_sql("gain", "COALESCE(FLOOR(r20 * 10), -99)") + ")"
    + rounded_sql({"mean": "AVG(p)", "brier": "AVG((p - y) * (p - y))"}, "pr GROUP BY arm, month", "arm, month, COUNT(*) AS n"),
)
def u03(s, d):
    """Two learners given as callbacks, fitted and judged month by month on purged slices."""
    rows = written(featured(s, d), "featured")
    out = learning.walk_forward(rows, MONTHS, [by_board, by_gain], months_back=P.months_back, gap=P.gap)
    return rounded(out.groupBy("arm", "month").agg(F.count("*").alias("n"), F.avg("p").alias("mean"), F.avg((F.col("p") - F.col("y")) * (F.col("p") - F.col("y"))).alias("brier")), ["mean", "brier"], ("arm", "month", "n"))


# --- calibration ----------------------------------------------------------------------------------

#: Scores are the hundredth of the day that a code's 20-row return falls into.
SCORED = ", sc AS (SELECT code, date, month, closed, y, CASE WHEN r20 IS NOT NULL THEN CAST((RANK() OVER (PARTITION BY date ORDER BY r20 NULLS LAST) - 1) * 100 // COUNT(r20) OVER (PARTITION BY date) AS DOUBLE) END AS score FROM feat)"
ISOTONIC = (
    SCORED + ", ca AS (SELECT CAST(UNNEST(generate_series(date_trunc('month', closed) + INTERVAL 1 MONTH, month + INTERVAL 12 MONTH, INTERVAL 1 MONTH)) AS DATE) AS mon, month, score, y FROM sc WHERE closed IS NOT NULL AND y IS NOT NULL AND score IS NOT NULL)"
    + ", cg AS (SELECT mon FROM ca GROUP BY mon HAVING COUNT(DISTINCT month) >= 6), cs AS (SELECT ca.mon, score, SUM(y) AS s, COUNT(*) AS n FROM ca JOIN cg ON cg.mon = ca.mon GROUP BY ca.mon, score)"
    + ", cu AS (SELECT *, SUM(s) OVER w AS cs, SUM(n) OVER w AS cn FROM cs WINDOW w AS (PARTITION BY mon ORDER BY score))"
    + ", pa AS (SELECT a.mon, a.score AS i, b.score AS j, (b.cs - a.cs + a.s) / CAST(b.cn - a.cn + a.n AS DOUBLE) AS m FROM cu a JOIN cu b ON b.mon = a.mon AND b.score >= a.score)"
    + ", lo AS (SELECT mon, i, j AS k, MIN(m) OVER (PARTITION BY mon, i ORDER BY j DESC) AS m FROM pa), iso AS (SELECT mon, k AS x, MAX(m) AS v FROM lo GROUP BY mon, k)"
)


ASKED = (
    ", asked AS (SELECT DISTINCT month AS mon, score AS x FROM sc WHERE score IS NOT NULL), nx AS (SELECT a.mon, a.x, (SELECT MAX(ROW(i.x, i.v)) FROM iso i WHERE i.mon = a.mon AND i.x <= a.x) AS lo, (SELECT MIN(ROW(i.x, i.v)) FROM iso i WHERE i.mon = a.mon AND i.x >= a.x) AS hi FROM asked a)"
    + ", pv AS (SELECT mon, x, CASE WHEN lo IS NULL THEN hi[2] WHEN hi IS NULL THEN lo[2] WHEN hi[1] > lo[1] THEN lo[2] + (x - lo[1]) / (hi[1] - lo[1]) * (hi[2] - lo[2]) ELSE lo[2] END AS p FROM nx)"
)


@query(
    "k15_isotonic_calibration",
    RET + LABELS + FEATURED + ISOTONIC + ASKED
    + rounded_sql({"p": "p"}, "sc LEFT JOIN pv ON pv.mon = sc.month AND pv.x = sc.score GROUP BY month, score, p", "month, score, COUNT(*) AS n"),
)
def k15(s, d):
    """Every month's scores turned into probabilities by the twelve months before: one row per month and score."""
    return rounded(probabilities(s, d).groupBy("month", "score", "p").agg(F.count("*").alias("n")), ["p"], ("month", "score", "n"))


def probabilities(s, d):
    """Rows with the hundredth of the day that the 20-row return falls into, and its calibrated probability."""
    day = Window.partitionBy("date")
    score = F.floor((F.rank().over(day.orderBy(F.col("r20").asc_nulls_last())) - 1) * 100 / F.count("r20").over(day)).cast("double")
    rows = featured(s, d).select("code", "date", "board", "y", F.when(F.col("r20").isNotNull(), score).alias("score"))
    return calibration.monthly(rows, "score", "y")[0]


@query(
    "k18_rescored_by_factors",
    RET + LABELS + FEATURED + ISOTONIC + ASKED + ", fg AS (SELECT month, board, COUNT(*) AS n, SUM(y) AS k FROM feat WHERE y IS NOT NULL GROUP BY 1, 2), fc AS (SELECT month, board, COALESCE(SUM(n) OVER v, 0) AS n, COALESCE(SUM(k) OVER v, 0) AS k FROM fg WINDOW v AS (PARTITION BY board ORDER BY month ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)), fq AS (SELECT *, SUM(k) OVER (PARTITION BY month) / NULLIF(SUM(n) OVER (PARTITION BY month), 0) AS q FROM fc), fa AS (SELECT month, board, COALESCE(LEAST(GREATEST((k + 50 * q) / (n + 50) / NULLIF(q, 0), 0.6), 1.4), 1) AS factor FROM fq)"
    + ", rw AS (SELECT sc.code, sc.date, sc.month, sc.y, p, ROUND(p * COALESCE(factor, 1), 9) AS q FROM sc JOIN feat ON feat.code = sc.code AND feat.date = sc.date JOIN pv ON pv.mon = sc.month AND pv.x = sc.score LEFT JOIN fa ON fa.month = sc.month AND fa.board = feat.board WHERE p IS NOT NULL AND sc.y IS NOT NULL), rr AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY date ORDER BY ROUND(p, 9) DESC, code) AS a, ROW_NUMBER() OVER (PARTITION BY date ORDER BY q DESC, code) AS b FROM rw)"
    + rounded_sql({"before": "AVG(CASE WHEN a <= 5 THEN y END)", "after": "AVG(CASE WHEN b <= 5 THEN y END)"}, "rr GROUP BY month", "month, CAST(SUM(CAST(b <= 5 AS INT)) AS BIGINT) AS n"),
)
def k18(s, d):
    """Calibrated probabilities times the shrunk factors of boards: hits of each day's first five, before and after."""
    rows = probabilities(s, d).where("y IS NOT NULL")
    factors = lists.shrunk_factors(featured(s, d).withColumn("month", F.trunc("date", "month")), "board", "y")
    return rounded(judging.rescored(rows, factors, 5), ["before", "after"], ("month", "n"))
