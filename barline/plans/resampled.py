"""Queries of resampling: family thresholds, bootstraps, permutations, and splits that show overfitting."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.window import Window

from barline.operators import crosssection as cs
from barline.operators import resampling, series
from barline.plans.helpers import rounded, rounded_sql
from barline.plans.panels import DAYS, LABELS, RET, day_series, labelled, r6, returns
from barline.sources.panels import BARS, duck
from barline.sources.roundtrips import written

QUERIES: dict = {}
ORACLE_SQL: dict = {}


def query(name: str, sql: str):
    def register(function):
        QUERIES[name], ORACLE_SQL[name] = function, duck(BARS) + sql
        return function

    return register


def reps_sql(source: str, values: list[str], replicates: int, block: int, seed: int, shared: bool = False, by: str = "series") -> str:
    """Sums by replicate, every drawn day spelt out; ``source`` has by, i, n and the values."""
    own = "" if shared else f"{by}, "
    join = "" if shared else f"v.{by} = d.{by} AND "
    return f""", reps_n AS (SELECT DISTINCT {own}n FROM {source}),
reps_d AS (SELECT {own}n, rep, b, {resampling.draw_sql(seed, "rep", "b", f"(n - {block} + 1)")} AS start FROM reps_n, (SELECT UNNEST(range(1, {replicates + 1})) AS rep), LATERAL (SELECT UNNEST(range(1, CAST(CEIL(n / CAST({block} AS DOUBLE)) AS BIGINT) + 1)) AS b) WHERE n >= {2 * block}),
reps_i AS (SELECT {own}rep, start + o AS i FROM reps_d, (SELECT UNNEST(range(0, {block})) AS o) WHERE (b - 1) * {block} + o < n),
reps AS (SELECT v.{by}, rep, {", ".join(f"SUM({x}) AS {x}" for x in values)} FROM reps_i d JOIN {source} v ON {join}v.i = d.i GROUP BY v.{by}, rep)"""


NUMBERED = ", nb AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY series ORDER BY date) - 1 AS i, COUNT(*) OVER (PARTITION BY series) AS n FROM s)"


@query(
    "l03_block_bootstrap",
    RET + DAYS + NUMBERED + reps_sql("nb", ["d"], 1000, 20, 7) + ", mm AS (SELECT series, AVG(d) AS mean, COUNT(*) AS n FROM s GROUP BY series), rr AS (SELECT reps.series, d / n AS m, mean FROM reps JOIN mm ON mm.series = reps.series)" + rounded_sql({"mean": "mean", "low": "QUANTILE_CONT(m, 0.025)", "high": "QUANTILE_CONT(m, 0.975)", "p": "AVG(CASE WHEN ROUND(ABS(m - mean), 12) >= ROUND(ABS(mean), 12) THEN 1 ELSE 0 END)"}, "rr GROUP BY series, mean", "series"),
)
def l03(s, d):
    return rounded(series.block_bootstrap(day_series(s, d)), ["mean", "low", "high", "p"], ("series",))


#: Trials of the family without a series of their own.
UNSEEN = 20
NW = "nm AS (SELECT *, d - AVG(d) OVER (PARTITION BY series) AS e FROM s), ng AS (SELECT series, d, e * e + " + " + ".join(f"{2 * (1 - k / 21)} * COALESCE(e * LAG(e, {k}) OVER (PARTITION BY series ORDER BY date), 0)" for k in range(1, 21)) + " AS g FROM nm), nw AS (SELECT series, SQRT(SUM(g)) / COUNT(*) AS se FROM ng GROUP BY series HAVING COUNT(*) >= 23 AND SUM(g) > 0)"
MAXT = (
    RET + DAYS + ", " + NW + ", gr AS (SELECT a.date, b.series FROM (SELECT DISTINCT date FROM s) a, (SELECT DISTINCT series FROM s) b), al0 AS (SELECT gr.series, gr.date, COALESCE(d - AVG(d) OVER (PARTITION BY gr.series), 0) AS e, CAST(d IS NOT NULL AS INT) AS has FROM gr LEFT JOIN s ON s.series = gr.series AND s.date = gr.date), al AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY series ORDER BY date) - 1 AS i, COUNT(*) OVER (PARTITION BY series) AS n FROM al0)"
    + reps_sql("al", ["e", "has"], 1000, 20, 7, shared=True)
    + ", mx AS (SELECT rep, MAX(e / GREATEST(has, 1) / se) AS t FROM reps JOIN nw ON nw.series = reps.series GROUP BY rep)"
)


def largest(s, d):
    days = day_series(s, d)
    return resampling.max_t(days, series.newey_west(days).where("se IS NOT NULL"))


@query("l08_max_t_draws", MAXT + rounded_sql({"t": "t"}, "mx", "CAST(rep AS INT) AS rep"))
def l08_draws(s, d):
    """The largest t of each replicate of blocks of days that all series share."""
    return rounded(largest(s, d), ["t"], ("rep",))


def _root_sql(excess: str, name: str) -> str:
    return f"{name}(k, lo, hi) AS (SELECT 0, CAST(0 AS DOUBLE), CAST(8 AS DOUBLE) UNION ALL SELECT k + 1, CASE WHEN x <= 0.05 THEN lo ELSE mid END, CASE WHEN x <= 0.05 THEN mid ELSE hi END FROM (SELECT k, lo, hi, mid, {excess} AS x FROM (SELECT *, (lo + hi) / 2 AS mid FROM {name} WHERE k < {resampling.STEPS})))"


_TAIL = f"(1 - {resampling.normal_cdf_sql('mid')})"


@query(
    "l08_family_threshold",
    MAXT + ", ts AS MATERIALIZED (SELECT LIST(t) AS ts FROM mx), " + _root_sql(f"(SELECT len(list_filter(ts, lambda t: t >= mid)) / CAST(len(ts) AS DOUBLE) FROM ts) + {UNSEEN} * {_TAIL}", "ra") + ", " + _root_sql(f"{UNSEEN + 5} * {_TAIL}", "rb")
    + f" SELECT {r6('a.hi', 'maxt')}, {r6('b.hi', 'bonferroni')}, {r6('GREATEST(2.5, LEAST(a.hi, b.hi))', 'threshold')} FROM ra a, rb b WHERE a.k = {resampling.STEPS} AND b.k = {resampling.STEPS}",
)
def l08(s, d):
    """The t that a family of 25 trials, five of them with series, must reach."""
    return resampling.family_threshold(largest(s, d), UNSEEN, 5).select(*((F.round(F.col(c) + 1.7e-10, 6) + 0.0).alias(c) for c in ("maxt", "bonferroni", "threshold")))


ORACLE_SQL["l08_family_threshold"] = ORACLE_SQL["l08_family_threshold"].replace("WITH ", "WITH RECURSIVE ", 1)

HITS = RET + LABELS + ", tk AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY date ORDER BY ROUND(r20, 9) DESC, code) AS rank FROM u WHERE r20 IS NOT NULL AND y IS NOT NULL)"


def ranked(s, d):
    return cs.top(labelled(s, d).where("r20 IS NOT NULL AND y IS NOT NULL"), 1 << 30, [F.round("r20", 9).desc(), F.col("code")], "date")


@query(
    "l04_ratio_bootstrap",
    HITS + ", s AS (SELECT CASE WHEN rank <= 3 THEN 'first' ELSE 'next' END AS series, date, SUM(y) AS k, COUNT(*) AS m FROM tk WHERE rank <= 10 GROUP BY 1, 2)" + NUMBERED + reps_sql("nb", ["k", "m"], 1000, 20, 11)
    + ", wh AS (SELECT series, SUM(k) / SUM(m) AS ratio FROM s GROUP BY series), rr AS (SELECT series, k / CAST(NULLIF(m, 0) AS DOUBLE) AS x FROM reps)"
    + rounded_sql({"ratio": "MIN(ratio)", "low": "QUANTILE_CONT(x, 0.025)", "high": "QUANTILE_CONT(x, 0.975)"}, "rr JOIN wh ON wh.series = rr.series GROUP BY rr.series", "rr.series"),
)
def l04(s, d):
    """Hits over picks of the first three ranks and of the next seven, with intervals by blocks of days."""
    picks = ranked(s, d).where("rank <= 10").groupBy(F.when(F.col("rank") <= 3, "first").otherwise("next").alias("series"), "date").agg(F.sum("y").alias("k"), F.count("*").alias("n_rows"))
    return rounded(resampling.ratio_bootstrap(picks), ["ratio", "low", "high"], ("series",))


@query(
    "l05_day_bootstrap",
    RET + DAYS + ", pr AS (SELECT a.series, a.date, GREATEST(LEAST(a.d - b.d, 0.05), -0.05) AS d FROM s a JOIN (SELECT date, AVG(r) AS d FROM p WHERE r IS NOT NULL GROUP BY date) b ON b.date = a.date), nb AS (SELECT *, ROW_NUMBER() OVER (PARTITION BY series ORDER BY date) - 1 AS i, COUNT(*) OVER (PARTITION BY series) AS n FROM pr)"
    + f", dr AS (SELECT series, rep, {resampling.draw_sql(13, 'rep', 'b', 'n')} AS i FROM (SELECT DISTINCT series, n FROM nb), (SELECT UNNEST(range(1, 1001)) AS rep), LATERAL (SELECT UNNEST(range(1, n + 1)) AS b)), sm AS (SELECT dr.series, rep, SUM(d) AS s FROM dr JOIN nb ON nb.series = dr.series AND nb.i = dr.i GROUP BY dr.series, rep)"
    + rounded_sql({"better": "AVG(CASE WHEN ROUND(s, 9) > 0 THEN 1 ELSE 0 END)"}, "sm GROUP BY series", "series"),
)
def l05(s, d):
    """How often each board's days, drawn anew, beat the market's on average."""
    market = returns(s, d).where("r IS NOT NULL").groupBy("date").agg(F.avg("r").alias("_m"))
    pairs = day_series(s, d).join(market, "date").select("series", "date", (F.col("d") - F.col("_m")).alias("d"))
    return rounded(resampling.day_bootstrap(pairs), ["better"], ("series",))


@query(
    "l06_block_permutation",
    HITS + ", hh AS (SELECT date, AVG(y) AS h FROM tk WHERE rank <= 10 GROUP BY date), fl AS (SELECT date, AVG(CAST(r > 0 AS DOUBLE)) >= 0.5 AS flag FROM p WHERE r IS NOT NULL GROUP BY date), dd AS (SELECT hh.date, h, flag, ROW_NUMBER() OVER (ORDER BY hh.date) - 1 AS i FROM hh JOIN fl ON fl.date = hh.date), bb AS (SELECT i // 20 AS b, COUNT(*) AS n FROM dd GROUP BY 1)"
    + f", od AS (SELECT b, n, rep, {resampling.draw_sql(3, 'rep', 'b', str(resampling.M))} AS u FROM bb, (SELECT UNNEST(range(1, 501)) AS rep)), oe AS (SELECT *, COALESCE(SUM(n) OVER (PARTITION BY rep ORDER BY u, b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS at FROM od)"
    + ", pf AS (SELECT rep, oe.at + dd.i - dd.b2 * 20 AS i, flag FROM oe JOIN (SELECT *, i // 20 AS b2 FROM dd) dd ON dd.b2 = oe.b), nl AS (SELECT rep, AVG(CASE WHEN pf.flag THEN h END) - AVG(CASE WHEN NOT pf.flag THEN h END) AS x FROM pf JOIN dd ON dd.i = pf.i GROUP BY rep)"
    + f" SELECT {r6('(SELECT QUANTILE_CONT(x, 0.95) FROM nl)', 'null95')}, {r6('AVG(CASE WHEN flag THEN h END) - AVG(CASE WHEN NOT flag THEN h END)', 'actual')} FROM dd",
)
def l06(s, d):
    """Hits on days when most codes rose against other days, beside what the same flags give in any order of their blocks."""
    hits = ranked(s, d).where("rank <= 10").groupBy("date").agg(F.avg("y").alias("h"))
    flags = returns(s, d).where("r IS NOT NULL").groupBy("date").agg((F.avg((F.col("r") > 0).cast("double")) >= 0.5).alias("flag"))
    out = resampling.block_permutation(hits.join(flags, "date"))
    return out.select(*((F.round(F.col(c) + 1.7e-10, 6) + 0.0).alias(c) for c in ("null95", "actual")))


ARMS = {"r": "r", "r20": "r20", "r60": "r60", "turnover": "turnover", "calm": "-r20", "late": "-r60"}
ARM_ROWS = ", ar AS (" + " UNION ALL ".join(f"SELECT '{a}' AS arm, date, AVG(y) AS d FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY date ORDER BY ROUND({x}, 9) DESC, code) AS k FROM u WHERE {x} IS NOT NULL AND y IS NOT NULL) WHERE k <= 5 GROUP BY date" for a, x in ARMS.items()) + ")"


def arm_days(s, d):
    """Share of hits among each arm's five codes of a day: some rows a day, written once, as their users read them several times."""
    arms = F.array(*(F.struct(F.lit(a).alias("arm"), F.round(F.expr(x).cast("double"), 9).alias("x")) for a, x in ARMS.items()))
    rows = labelled(s, d).where("y IS NOT NULL").select("code", "date", "y", F.explode(arms).alias("a")).select("a.*", "code", "date", "y").where("x IS NOT NULL")
    place = F.row_number().over(Window.partitionBy("arm", "date").orderBy(F.col("x").desc(), "code"))
    return written(rows.withColumn("_k", place).where("_k <= 5").groupBy("arm", "date").agg(F.avg("y").alias("d")), "arms")


@query(
    "l10_overfit_splits",
    RET + LABELS + ARM_ROWS + ", ev AS (SELECT * FROM ar QUALIFY COUNT(*) OVER (PARTITION BY date) = 6), dy AS (SELECT date, ROW_NUMBER() OVER (ORDER BY date) - 1 AS i, COUNT(*) OVER () AS t FROM (SELECT DISTINCT date FROM ev)), pt AS (SELECT date, " + " + ".join(f"CAST(i >= t * {p} // 8 AS INT)" for p in range(1, 8)) + " AS part FROM dy)"
    + ", sm AS (SELECT arm, part, SUM(d) AS s, COUNT(*) AS n FROM ev JOIN pt ON pt.date = ev.date GROUP BY arm, part), sp AS (SELECT x AS split FROM (SELECT UNNEST(range(0, 256)) AS x) WHERE bit_count(x) = 4)"
    + ", bo AS (SELECT split, arm, ROUND(SUM(CASE WHEN (split >> part) & 1 = 1 THEN s END) / SUM(CASE WHEN (split >> part) & 1 = 1 THEN n END), 12) AS i, ROUND(SUM(CASE WHEN (split >> part) & 1 = 0 THEN s END) / SUM(CASE WHEN (split >> part) & 1 = 0 THEN n END), 12) AS o FROM sp, sm GROUP BY split, arm)"
    + ", be AS (SELECT * FROM bo QUALIFY ROW_NUMBER() OVER (PARTITION BY split ORDER BY i DESC, arm) = 1), rk AS (SELECT be.split, be.arm, be.i, be.o, SUM(CAST(bo.o < be.o AS INT)) + (SUM(CAST(bo.o = be.o AS INT)) - 1) / 2.0 + 1 AS rank, COUNT(*) AS arms FROM be JOIN bo ON bo.split = be.split GROUP BY ALL)"
    + rounded_sql({"inside": "i", "outside": "o", "rank": "rank", "logit": "LN(rank / (arms + 1) / (1 - rank / (arms + 1)))"}, "rk", "split, arm"),
)
def l10(s, d):
    """All 70 splits of eight stretches of days: the winning arm, its share inside and outside, its rank outside and the logit; overfit where the logit is not above 0."""
    return rounded(resampling.overfit(arm_days(s, d)), ["inside", "outside", "rank", "logit"], ("split", "arm"))
