"""Lists of codes by day: membership, streaks, thresholds from the past, truth, and parameter grids."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from barline.operators.windows import ahead, by_code


def day_numbers(panel: DataFrame) -> DataFrame:
    """date and its number in the calendar of the panel."""
    return panel.select("date").distinct().select("date", F.row_number().over(Window.orderBy("date")).alias("day"))


def membership(lists: DataFrame, calendar: DataFrame, days: int = 5) -> DataFrame:
    """For each listing: how often the code was listed in the last ``days`` market days, and its run of consecutive market days."""
    d = lists.join(calendar, "date")
    by_day = Window.partitionBy("code").orderBy("day")
    hits = F.count("*").over(by_day.rangeBetween(-(days - 1), 0))
    island = F.col("day") - F.row_number().over(by_day)
    d = d.select("*", hits.alias("hits"), island.alias("_island"))
    return d.withColumn("streak", F.row_number().over(Window.partitionBy("code", "_island").orderBy("day"))).drop("_island")


def rank_sums(df: DataFrame, rules: dict[str, dict[str, float]]) -> DataFrame:
    """(rule, code, date, score): the weighted sum of rank columns for every rule; rows with a null part have none."""
    one = lambda name, w: F.struct(F.lit(name).alias("rule"), sum((F.col(c) * x for c, x in w.items()), F.lit(0.0)).alias("score"))
    return df.select("code", "date", F.explode(F.array(*(one(n, w) for n, w in rules.items()))).alias("r")).select("r.rule", "code", "date", "r.score").where("score IS NOT NULL")


def past_threshold(scored: DataFrame, cuts: list[int], least: float, n_least: int, gap: int = 1) -> DataFrame:
    """Per month: the lowest cut whose rows of all months up to ``gap`` months before hit at least ``least``; null if none does.

    ``scored``: month, score, y.  Months are summed once, then accumulated.
    """
    rows = scored.where("y IS NOT NULL").select("month", "score", "y", F.explode(F.array(*map(F.lit, cuts))).alias("cut")).where("score >= cut")
    sums = rows.groupBy("month", "cut").agg(F.count("*").alias("n"), F.sum("y").alias("k"))
    months = scored.select("month").distinct().crossJoin(F.broadcast(scored.sparkSession.createDataFrame([(c,) for c in cuts], "cut int")))
    w = Window.partitionBy("cut").orderBy("month").rowsBetween(Window.unboundedPreceding, -gap)
    d = months.join(sums, ["month", "cut"], "left").select("month", "cut", F.sum("n").over(w).alias("n"), F.sum("k").over(w).alias("k"))
    good = (F.col("n") >= n_least) & (F.col("k") >= least * F.col("n"))
    return d.groupBy("month").agg(F.min(F.when(good, F.col("cut"))).alias("cut"))


def truth(lists: DataFrame, panel: DataFrame, n: int = 20, threshold: float = 0.3) -> DataFrame:
    """Per list day: picks, hits so far and final, and the share of all codes that hit that day."""
    rows = panel.select("code", "date", F.count("high").over(ahead(n)).alias("seen"), (F.max("high").over(ahead(n)) / F.col("close") - 1).alias("rise"))
    hit = F.coalesce((F.col("rise") > threshold).cast("int"), F.lit(0))
    rows = rows.select("code", "date", hit.alias("hit"), F.when(F.col("seen") == n, hit).alias("final"), "rise")
    base = rows.groupBy("date").agg(F.avg("final").alias("base"))
    d = lists.select("code", "date").join(rows, ["code", "date"]).groupBy("date").agg(F.count("*").alias("n"), F.sum("hit").alias("hits"), F.sum("final").alias("final_hits"), F.max("rise").alias("best"))
    return d.join(base, "date")


def peaks_after_listing(first: DataFrame, panel: DataFrame, rise: float = 0.2, low: float = -0.2, high: float = -0.08, recent: int = 10, held: int = 6) -> DataFrame:
    """Codes that rose by ``rise`` since their first listing, and fell from a recent peak by between ``high`` and ``low``."""
    d = panel.select("code", "date", "close").join(first.select("code", F.col("date").alias("first")), "code").where("date >= first")
    d = d.withColumn("i", F.row_number().over(by_code()))
    at_peak = F.min_by(F.struct("i", "close"), F.struct(-F.col("close"), F.col("i")))
    g = d.groupBy("code", "first").agg(F.count("*").alias("n"), F.min_by("close", "i").alias("start"), F.max_by("close", "i").alias("close"), at_peak.alias("p"))
    g = g.select("code", "first", "n", "close", (F.col("p.close") / F.col("start") - 1).alias("rise"), (F.col("close") / F.col("p.close") - 1).alias("drop"), (F.col("n") - F.col("p.i")).alias("since_peak"))
    return g.where((F.col("n") >= held + 1) & (F.col("rise") >= rise) & (F.col("drop") > low) & (F.col("drop") < high) & (F.col("since_peak") <= recent))


def grid(df: DataFrame, parameters: list[tuple], names: str, keep: Column, y: str) -> DataFrame:
    """One row per parameter set: how many rows its condition keeps, and their rate."""
    sets = df.sparkSession.createDataFrame(parameters, names)
    keys = sets.columns
    return df.crossJoin(F.broadcast(sets)).where(keep).groupBy(*keys).agg(F.count(y).alias("n"), F.avg(y).alias("rate"))


def shrunk_factors(rows: DataFrame, group: str, y: str, weight: float = 50.0, low: float = 0.6, high: float = 1.4) -> DataFrame:
    """Per month and group: the group's rate of the months before against the market's, shrunk by ``weight`` rows and clamped."""
    g = rows.where(F.col(y).isNotNull()).groupBy("month", group).agg(F.count("*").alias("n"), F.sum(y).alias("k"))
    own = Window.partitionBy(group).orderBy("month").rowsBetween(Window.unboundedPreceding, -1)
    d = g.select("month", group, F.coalesce(F.sum("n").over(own), F.lit(0)).alias("n"), F.coalesce(F.sum("k").over(own), F.lit(0)).alias("k"))
    whole = Window.partitionBy("month")
    p = F.sum("k").over(whole) / F.nullif(F.sum("n").over(whole).cast("double"), F.lit(0.0))
    rate = (F.col("k") + weight * p) / (F.col("n") + weight)
    return d.select("month", group, "n", "k", F.coalesce(F.least(F.greatest(rate / F.nullif(p, F.lit(0.0)), F.lit(low)), F.lit(high)), F.lit(1.0)).alias("factor"))


def nested_choice(arms: DataFrame, base: str, months_back: int = 12, least: int = 40) -> DataFrame:
    """Per month: the arm of (arm, date, d) with the largest Newey-West t of its daily lead over ``base`` in the months before, and its result.

    An arm needs ``least`` days with both and a t above 0, ties by name; without one the base is taken.
    """
    from barline.operators.series import newey_west

    months = arms.select(F.trunc("date", "month").alias("month")).distinct()
    own = arms.where(F.col("arm") == base).select("date", F.col("d").alias("_b"))
    lead = arms.where(F.col("arm") != base).join(own, "date").select("arm", "date", (F.col("d") - F.col("_b")).alias("d"))
    # A day counts for the months after its own, up to ``months_back`` of them and the one it is still within.
    months = months.select("month", F.add_months("month", -months_back).alias("_from"))
    past = lead.join(F.broadcast(months), (F.col("date") < F.col("month")) & (F.col("date") >= F.col("_from")))
    series = past.select(F.concat_ws("|", F.col("month").cast("string"), "arm").alias("series"), "date", "d")
    t = newey_west(series, 20).where(F.col("n") >= least).select(F.split("series", r"\|")[0].cast("date").alias("month"), F.split("series", r"\|")[1].alias("arm"), F.round("t", 9).alias("t")).where("t > 0")
    best = t.groupBy("month").agg(F.min_by(F.struct("arm", "t"), F.struct(-F.col("t"), "arm")).alias("_c"))
    chosen = months.select("month").join(best, "month", "left").select("month", F.coalesce("_c.arm", F.lit(base)).alias("arm"), F.coalesce("_c.t", F.lit(0.0)).alias("t"))
    days = own.select("date", "_b", F.trunc("date", "month").alias("month")).join(F.broadcast(chosen), "month").join(arms.select("arm", "date", "d"), ["arm", "date"], "left")
    return days.groupBy("month", "arm", "t").agg(F.count("d").alias("days"), F.avg("d").alias("hit"), F.avg("_b").alias("base"))
