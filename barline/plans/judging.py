"""Queries of thresholds with overrides, matched baselines, lower bounds of precision, power, and exits."""

from __future__ import annotations

from pyspark.sql import functions as F

from barline.operators import judging, series
from barline.operators import windows as w
from barline.plans.helpers import BY, rounded, rounded_sql
from barline.plans.panels import DAYS, RET, day_series, r6, returns
from barline.plans.resampled import HITS, NUMBERED, NW, ranked, reps_sql
from barline.sources.panels import BARS, duck

QUERIES: dict = {}
ORACLE_SQL: dict = {}


def query(name: str, sql: str):
    def register(function):
        QUERIES[name], ORACLE_SQL[name] = function, duck(BARS) + sql
        return function

    return register


DEFAULTS = {"gain": ("r20", 0.05), "busy": ("turnover", 0.01), "price": ("close", 20.0)}
OVERRIDES = {"ASIA": {"gain": 0.1}, "EUROPE": {"price": 50.0, "busy": 0.008}}


def _limit(rule: str) -> str:
    column, least = DEFAULTS[rule]
    cases = " ".join(f"WHEN '{b}' THEN {own[rule]}" for b, own in OVERRIDES.items() if rule in own)
    return f"CASE WHEN NOT COALESCE({column} >= " + (f"CASE board {cases} ELSE {least} END" if cases else str(least)) + f", FALSE) THEN '{rule}' END"


@query("b15_thresholds_with_overrides", RET + ", f AS (SELECT board, concat_ws(',', " + ", ".join(_limit(r) for r in DEFAULTS) + ") AS failed FROM p) SELECT board, failed, COUNT(*) AS n FROM f GROUP BY board, failed")
def b15(s, d):
    """How many rows break which of three rules, whose limits two boards override."""
    return judging.threshold_rules(returns(s, d), DEFAULTS, OVERRIDES, "board").groupBy("board", "failed").agg(F.count("*").alias("n"))


@query(
    "l12_matched_baseline",
    HITS + ", dy AS (SELECT DISTINCT date FROM tk), ow AS (SELECT date, COUNT(*) AS n, SUM(y) AS h FROM tk WHERE rank <= 50 AND r60 > 0.1 GROUP BY date), vo AS (SELECT COALESCE(SUM(n), 0) AS volume, LEAST(COALESCE(SUM(n), 0) / CAST(COUNT(*) AS DOUBLE), 50) AS k FROM dy LEFT JOIN ow ON ow.date = dy.date)"
    + ", ba AS (SELECT date, SUM(GREATEST(0, LEAST(1, k - rank + 1)) * y) AS b FROM tk, vo WHERE rank <= 51 GROUP BY date), uu AS (SELECT dy.date, COALESCE(h, 0) AS h, COALESCE(b, 0) AS b FROM dy LEFT JOIN ow ON ow.date = dy.date LEFT JOIN ba ON ba.date = dy.date)"
    + ", ce AS (SELECT *, (h - b) - AVG(h - b) OVER () AS e FROM uu), ga AS (SELECT h - b AS d, e * e + " + " + ".join(f"{2 * (1 - k / 21)} * COALESCE(e * LAG(e, {k}) OVER (ORDER BY date), 0)" for k in range(1, 21)) + " AS g FROM ce), tt AS (SELECT CASE WHEN COUNT(*) >= 23 AND SUM(g) > 0 THEN AVG(d) / (SQRT(SUM(g)) / COUNT(*)) END AS t FROM ga), sm AS (SELECT SUM(h) AS h, SUM(b) AS b FROM uu)"
    + rounded_sql({"k": "k", "precision": "h / CAST(NULLIF(volume, 0) AS DOUBLE)", "base": "b / NULLIF(volume, 0)", "lead": "(h - b) / NULLIF(volume, 0)", "t": "t"}, "vo, sm, tt", "CAST(volume AS BIGINT) AS volume"),
)
def l12(s, d):
    """Hits of the rows that also rose by a tenth in 60 rows, beside the first ranks of the same volume."""
    rows = ranked(s, d).withColumn("hit", F.col("y"))
    out = judging.matched_baseline(rows, (F.col("rank") <= 50) & (F.col("r60") > 0.1), rows.select("date").distinct())
    return rounded(out, ["k", "precision", "base", "lead", "t"], ("volume",))


@query(
    "l14_power",
    RET + DAYS + ", " + NW + ", ln AS (SELECT s.series, COUNT(*) AS n, AVG(d) AS mean, se FROM s JOIN nw ON nw.series = s.series GROUP BY s.series, se)"
    + rounded_sql({"se": "se", "mde25": "3.3416212335729143 * se", "mde28": "3.6416212335729143 * se", "years": "n / 250.0 * POWER(3.3416212335729143 * se / ABS(mean), 2)"}, "ln", "series, n"),
)
def l14(s, d):
    """The least daily mean of each board that shows at t 2.5 and 2.8 with a chance of 80 %, and the years that its own mean would take."""
    z = 0.8416212335729143
    nw = series.newey_west(day_series(s, d)).where("se IS NOT NULL")
    need = [((2.5 + z) * F.col("se")).alias("mde25"), ((2.8 + z) * F.col("se")).alias("mde28"), (F.col("n") / 250.0 * F.pow((2.5 + z) * F.col("se") / F.abs("mean"), 2)).alias("years")]
    return rounded(nw.select("series", "n", "se", *need), ["se", "mde25", "mde28", "years"], ("series", "n"))


_W = "1.6448536269514722"


@query(
    "l16_precision_bounds",
    HITS + ", s AS (SELECT 'first ' || c AS series, date, SUM(y) AS k, COUNT(*) AS m FROM tk, (SELECT UNNEST([1, 3, 5, 10]) AS c) WHERE rank <= c GROUP BY 1, 2)" + NUMBERED + reps_sql("nb", ["k", "m"], 1000, 20, 17)
    + ", sp AS (SELECT series, QUANTILE_CONT(x, 0.05) AS low5, QUANTILE_CONT(x, 0.025) AS low25, VAR_POP(x) AS v FROM (SELECT series, k / CAST(NULLIF(m, 0) AS DOUBLE) AS x FROM reps) GROUP BY series), wh AS (SELECT series, SUM(m) AS m, SUM(k) / CAST(SUM(m) AS DOUBLE) AS q FROM s GROUP BY series)"
    + ", ef AS (SELECT wh.series, m, q, low5, low25, v / NULLIF(q * (1 - q) / m, 0) AS effect FROM wh JOIN sp ON sp.series = wh.series), en AS (SELECT *, m / NULLIF(effect, 0) AS n FROM ef)"
    + rounded_sql({"precision": "q", "low5": "low5", "low25": "low25", "effect": "effect", "effective": "n", "wilson": f"(q + {_W} * {_W} / (2 * n) - {_W} * SQRT(q * (1 - q) / n + {_W} * {_W} / (4 * n * n))) / (1 + {_W} * {_W} / n)"}, "en", "series, CAST(m AS BIGINT) AS volume", 5),
)
def l16(s, d):
    """What precision the first 1, 3, 5 and 10 ranks can promise, rows counted by what blocks of days are worth."""
    rows = ranked(s, d).select("date", "rank", "y", F.explode(F.array(*map(F.lit, (1, 3, 5, 10)))).alias("c")).where("rank <= c")
    days = rows.groupBy(F.concat(F.lit("first "), F.col("c").cast("string")).alias("series"), "date").agg(F.sum("y").alias("k"), F.count("*").alias("n_rows"))
    return rounded(judging.precision_bounds(days), ["precision", "low5", "low25", "effect", "effective", "wilson"], ("series", "volume"), 5)


EXITS = {"open 1": "open", "close 1": "close", "close 3": "close", "close 5": "close", "close 20": "close"}


@query(
    "n07_exit_curve",
    RET + ", ex AS (SELECT code, date, ROUND(r20, 9) AS s, close AS e, " + ", ".join(f"LEAD({x}, {n.split()[1]}) OVER ({BY}) AS x{k}" for k, (n, x) in enumerate(EXITS.items())) + " FROM p), st AS (" + " UNION ALL ".join(f"SELECT '{n}' AS exit, code, date, s, ROUND(x{k} / e - 1, 9) AS r FROM ex WHERE x{k} > 0 AND e > 0 AND s IS NOT NULL" for k, n in enumerate(EXITS)) + ")"
    + ", rk AS (SELECT *, " + ", ".join(f"RANK() OVER (PARTITION BY exit, date ORDER BY {c}) + (COUNT(*) OVER (PARTITION BY exit, date, {c}) - 1) / 2.0 AS {a}" for c, a in (("s", "a"), ("r", "b"))) + ", ROW_NUMBER() OVER (PARTITION BY exit, date ORDER BY s DESC, code) AS k FROM st)"
    + ", dd AS (SELECT exit, date, CASE WHEN STDDEV_POP(a) > 0 AND STDDEV_POP(b) > 0 THEN COVAR_POP(a, b) / (STDDEV_POP(a) * STDDEV_POP(b)) END AS ic, AVG(CASE WHEN k <= 3 THEN r END) - QUANTILE_CONT(r, 0.5) AS x FROM rk GROUP BY exit, date HAVING COUNT(*) >= 5)"
    + rounded_sql({"ic": "AVG(ic)", "icir": "CASE WHEN STDDEV_SAMP(ic) > 0 THEN AVG(ic) / STDDEV_SAMP(ic) END", "excess": "AVG(x)"}, "dd GROUP BY exit", "exit, COUNT(*) AS days"),
)
def n07(s, d):
    """What the 20-row return tells about leaving at the next open, and after 1, 3, 5 and 20 closes."""
    exits = {n: F.lead(x, int(n.split()[1])).over(w.by_code()) for n, x in EXITS.items()}
    return rounded(judging.exit_curve(returns(s, d), "r20", exits, F.col("close"), top=3, least=5), ["ic", "icir", "excess"], ("exit", "days"))
