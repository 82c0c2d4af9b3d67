"""Judging of rules and scores: thresholds with overrides, matched baselines, lower bounds of precision, and when to leave."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from barline.operators.resampling import numbered, resampled
from barline.operators.series import newey_west


def threshold_rules(rows: DataFrame, defaults: dict[str, tuple[str, float]], overrides: dict[str, dict[str, float]], segment: str) -> DataFrame:
    """Adds ``failed``, the names of the rules that a row breaks, in order; an unknown value breaks its rule.

    ``defaults``: rule -> (column, least value).  ``overrides``: segment -> rule -> least value in place of the default.
    """
    unknown = set(r for own in overrides.values() for r in own) - set(defaults)
    if unknown:
        raise ValueError(f"overrides of rules that don't exist: {sorted(unknown)}")
    tests = []
    for rule, (column, least) in defaults.items():
        limit = F.lit(float(least))
        for name, own in overrides.items():
            if rule in own:
                limit = F.when(F.col(segment) == name, F.lit(float(own[rule]))).otherwise(limit)
        tests.append(F.when(~F.coalesce(F.col(column) >= limit, F.lit(False)), F.lit(rule)))
    return rows.withColumn("failed", F.array_join(F.array_compact(F.array(*tests)), ","))


def matched_baseline(ranked: DataFrame, chosen: Column, days: DataFrame, most: int = 50, lags: int = 20) -> DataFrame:
    """Precision of the chosen rows beside a baseline of the same volume; one row.

    ``ranked`` has date, rank and hit.  A day's baseline are its first k ranks, k being the chosen rows a day on average, at most
    ``most``; a broken k takes its share of the next rank.  t is Newey-West's of the daily difference in hits over ``days``.
    """
    own = ranked.where(chosen).groupBy("date").agg(F.count("*").alias("n"), F.sum("hit").alias("h"))
    volume = days.join(own, "date", "left").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("volume"), F.count("*").alias("days")).withColumn("k", F.least(F.col("volume") / F.col("days"), F.lit(float(most))))
    part = F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.col("k") - F.col("rank") + 1))
    base = ranked.where(F.col("rank") <= most + 1).crossJoin(F.broadcast(volume)).groupBy("date").agg(F.sum(part * F.col("hit")).alias("b"))
    u = days.join(own, "date", "left").join(base, "date", "left").select("date", F.coalesce("h", F.lit(0)).alias("h"), F.coalesce("b", F.lit(0.0)).alias("b"))
    t = newey_west(u.select(F.lit("u").alias("series"), "date", (F.col("h") - F.col("b")).alias("d")), lags).select("t")
    sums = u.agg(F.sum("h").alias("h"), F.sum("b").alias("b"))
    whole = volume.crossJoin(sums).crossJoin(t)
    share = lambda x: F.col(x) / F.nullif(F.col("volume").cast("double"), F.lit(0.0))
    return whole.select("volume", "k", share("h").alias("precision"), share("b").alias("base"), (share("h") - share("b")).alias("lead"), "t")


def precision_bounds(days: DataFrame, replicates: int = 1000, block: int = 20, seed: int = 17, z: float = 1.6448536269514722, by: str = "series") -> DataFrame:
    """Lower bounds of hits over rows of (by, date, k, n_rows): of block bootstraps, and Wilson's with as many rows as the bootstrap's variance is worth.

    effect is the variance of the replicates over the binomial one, effective the rows divided by it.
    """
    d = numbered(days.select(by, "date", F.col("k").cast("double").alias("k"), F.col("n_rows").cast("double").alias("m")), [by])
    reps = resampled(d, ["k", "m"], replicates, block, seed, [by]).withColumn("x", F.when(F.col("m") > 0, F.col("k") / F.col("m")))
    spread = reps.groupBy(by).agg(F.percentile("x", F.lit(0.05)).alias("low5"), F.percentile("x", F.lit(0.025)).alias("low25"), F.var_pop("x").alias("_v"))
    p = F.col("k") / F.col("m")
    g = d.groupBy(by).agg(F.sum("k").alias("k"), F.sum("m").alias("m")).join(spread, by).withColumn("precision", p)
    g = g.withColumn("effect", F.col("_v") / F.nullif(p * (1 - p) / F.col("m"), F.lit(0.0))).withColumn("effective", F.col("m") / F.nullif(F.col("effect"), F.lit(0.0)))
    n, q = F.col("effective"), F.col("precision")
    wilson = (q + z * z / (2 * n) - z * F.sqrt(q * (1 - q) / n + z * z / (4 * n * n))) / (1 + z * z / n)
    return g.select(by, F.col("m").cast("long").alias("volume"), "precision", "low5", "low25", "effect", "effective", wilson.alias("wilson"))


def exit_curve(rows: DataFrame, score: str, exits: dict[str, Column], entry: Column, top: int = 10, least: int = 10) -> DataFrame:
    """(exit, days, ic, icir, excess): what a score tells about the way from ``entry`` to each exit, a column a row's code sees ahead.

    Per day with ``least`` codes: rank correlation of the score with the gain, and the first ``top`` codes' mean gain over the day's median.
    """
    d = rows.select("code", "date", F.round(score, 9).alias("_s"), entry.cast("double").alias("_e"), *(x.cast("double").alias(f"_x{k}") for k, x in enumerate(exits.values())))
    stack = F.explode(F.array(*(F.struct(F.lit(n).alias("exit"), F.col(f"_x{k}").alias("px")) for k, n in enumerate(exits))))
    d = d.select("code", "date", "_s", "_e", stack.alias("x")).select("code", "date", "_s", "x.exit", F.when((F.col("x.px") > 0) & (F.col("_e") > 0), F.round(F.col("x.px") / F.col("_e") - 1, 9)).alias("_r")).where("_r IS NOT NULL AND _s IS NOT NULL")
    day = Window.partitionBy("exit", "date")
    rank = lambda c: F.rank().over(day.orderBy(c)) + (F.count("*").over(Window.partitionBy("exit", "date", c)) - 1) / 2
    d = d.select("*", rank("_s").alias("_a"), rank("_r").alias("_b"), F.row_number().over(day.orderBy(F.col("_s").desc(), "code")).alias("_k"))
    g = d.groupBy("exit", "date").agg(F.count("*").alias("n"), F.covar_pop("_a", "_b").alias("c"), F.stddev_pop("_a").alias("sa"), F.stddev_pop("_b").alias("sb"), F.percentile("_r", F.lit(0.5)).alias("mid"), F.avg(F.when(F.col("_k") <= top, F.col("_r"))).alias("best"))
    g = g.where(F.col("n") >= least).select("exit", "date", F.when((F.col("sa") > 0) & (F.col("sb") > 0), F.col("c") / (F.col("sa") * F.col("sb"))).alias("ic"), (F.col("best") - F.col("mid")).alias("x"))
    out = g.groupBy("exit").agg(F.count("*").alias("days"), F.avg("ic").alias("ic"), F.stddev_samp("ic").alias("_sd"), F.avg("x").alias("excess"))
    return out.select("exit", "days", "ic", F.when(F.col("_sd") > 0, F.col("ic") / F.col("_sd")).alias("icir"), "excess")



def acceptance(picks: DataFrame, months: DataFrame, hit: float = 0.15, zero_months: int = 1, ratio: float = 3.0, least: int = 20) -> DataFrame:
    """(test, value, limit, ok) of a model by its picks (month, board, y): share of hits, months with picks and none, best board over worst.

    ``months`` has every month judged: one without picks stood aside and is no month without hits.  Boards count from ``least``
    picks, and are compared only if there are two of them.
    """
    whole = picks.agg(F.avg("y").alias("value")).select(F.lit("hit").alias("test"), "value", F.lit(hit).alias("limit"), (F.col("value") >= hit).alias("ok"))
    by_month = months.join(picks.groupBy("month").agg(F.sum("y").alias("_h")), "month", "left")
    zero = by_month.agg(F.count_if(F.col("_h") == 0).cast("double").alias("value")).select(F.lit("months without a hit").alias("test"), "value", F.lit(float(zero_months)).alias("limit"), (F.col("value") <= zero_months).alias("ok"))
    boards = picks.groupBy("board").agg(F.avg("y").alias("r"), F.count("*").alias("n")).where(F.col("n") >= least)
    spread = boards.agg(F.count("*").alias("_b"), (F.max("r") / F.greatest(F.min("r"), F.lit(1e-9))).alias("value")).where("_b >= 2")
    spread = spread.select(F.lit("best board over worst").alias("test"), "value", F.lit(ratio).alias("limit"), (F.col("value") <= ratio).alias("ok"))
    return whole.unionByName(zero).unionByName(spread)


def rescored(rows: DataFrame, factors: DataFrame, top: int = 10) -> DataFrame:
    """(month, n, before, after): share of hits among each day's first ``top`` codes by p, and by p times the factor of their month and board.

    ``rows`` has code, date, month, board, y and p; a board without a factor keeps its p, rows without p aren't ranked.
    """
    d = rows.where("p IS NOT NULL").join(F.broadcast(factors.select("month", "board", "factor")), ["month", "board"], "left")
    d = d.withColumn("_q", F.round(F.col("p") * F.coalesce("factor", F.lit(1.0)), 9))
    place = lambda c: F.row_number().over(Window.partitionBy("date").orderBy(F.col(c).desc(), "code"))
    d = d.withColumn("_p", F.round("p", 9)).select("*", place("_p").alias("_a"), place("_q").alias("_b"))
    hit = lambda c: F.avg(F.when(F.col(c) <= top, F.col("y")))
    return d.groupBy("month").agg(F.sum((F.col("_b") <= top).cast("int")).alias("n"), hit("_a").alias("before"), hit("_b").alias("after"))
