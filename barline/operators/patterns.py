"""Multi-stage price and volume patterns, phases and pools, by windows and bounded range joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from barline.operators.windows import by_code, gain, lag, last_n


def prepared(panel: DataFrame, big: float = 0.03) -> DataFrame:
    """Adds pos, prev_close, gain, volume ratio and whether the bar is big."""
    d = panel.select("*", F.row_number().over(by_code()).alias("pos"), lag("close").alias("prev_close"), gain().alias("gain"), (F.col("volume") / lag("volume")).alias("vr"))
    return d.withColumn("big", F.coalesce((F.col("gain") >= big) & (F.col("vr") >= 1.5), F.lit(False)))


def launches(bars: DataFrame, base: int = 20, amplitude: float = 0.6, times: float = 1.2, over_largest: bool = False) -> DataFrame:
    """Big bars after ``base`` bars within an amplitude, with ``times`` their mean volume and, if asked for, more than their largest."""
    w = last_n(base, 1)
    high, low, n = F.max("close").over(w), F.min("close").over(w), F.count("close").over(w)
    calm = (n == base) & (high / low - 1 <= amplitude)
    d = bars.withColumn("calm", calm).withColumn("base_volume", F.avg("volume").over(w)).withColumn("_largest", F.max("volume").over(w))
    fits = F.col("calm") & F.col("big") & (F.col("volume") >= times * F.col("base_volume"))
    return d.where(fits & (F.col("volume") > F.col("_largest")) if over_largest else fits).drop("_largest")


def base_launch_adjust_trigger(panel: DataFrame, most: int = 10, least: int = 2, shrink: float = 0.8, **base) -> DataFrame:
    """One row per launch with the status that decided it; ``base`` holds parameters of ``launches``.

    Bars after a launch stay below its volume, close at most at its high and hold its low,
    until the first close above its high triggers: ``hit`` after ``least`` quiet bars whose mean volume is
    at most ``shrink`` of the launch's (``thick`` if it is more) if that bar is big, else ``weak``.  The first failure
    decides; ``open`` if bars run out.
    """
    bars = prepared(panel)
    start = launches(bars, **base).select("code", F.col("pos").alias("start"), F.col("date").alias("launch_date"), F.col("high").alias("l_high"), F.col("low").alias("l_low"), F.col("volume").alias("l_volume"))
    start = start.select("*", F.explode(F.sequence(F.lit(1), F.lit(most + 1))).alias("step")).withColumn("pos", F.col("start") + F.col("step"))
    steps = start.join(bars.select("code", "pos", "date", "close", "low", "volume", "big"), ["code", "pos"], "left")
    # A launch and its few steps meet; codes with many launches are dealt by launch.
    steps = steps.withColumn("_mean", F.avg("volume").over(Window.partitionBy("code", "launch_date").orderBy("step").rowsBetween(Window.unboundedPreceding, -1)))
    above = F.col("close") > F.col("l_high")
    status = (
        F.when(F.col("date").isNull(), "open")
        .when(F.col("low") < F.col("l_low"), "broken")
        .when(above & (F.col("step") <= least), "early")
        .when(above & ~F.col("big"), "weak")
        .when(above & (F.col("_mean") > shrink * F.col("l_volume")), "thick")
        .when(above, "hit")
        .when(F.col("volume") >= F.col("l_volume"), "heavy")
        .when(F.col("step") > most, "late")
    )
    decided = steps.withColumn("status", status).where(F.col("status").isNotNull())
    return decided.groupBy("code", "launch_date").agg(F.min_by("status", "step").alias("status"), F.min("step").alias("step"), F.min_by("date", "step").alias("date"))


def open_patterns(panel: DataFrame, most: int = 10, least: int = 2, shrink: float = 0.8) -> DataFrame:
    """Launches of each code's last bars that have neither failed nor triggered yet.

    Per launch: quiet bars so far, bars left to wait, whether there are ``least`` of them with a
    mean volume of at most ``shrink`` of the launch's, and how far the launch's high is above the last close.
    """
    bars = prepared(panel)
    last = bars.groupBy("code").agg(F.max("pos").alias("last"), F.max_by("close", "pos").alias("now"))
    start = launches(bars).select("code", F.col("pos").alias("start"), F.col("date").alias("launch_date"), F.col("high").alias("l_high"), F.col("low").alias("l_low"), F.col("volume").alias("l_volume"))
    start = start.join(last, "code").where(F.col("last") - F.col("start") <= most)
    steps = bars.select("code", "pos", "close", "low", "volume").join(start, "code").where(F.col("pos") > F.col("start"))
    ended = (F.col("low") < F.col("l_low")) | (F.col("close") > F.col("l_high")) | (F.col("volume") >= F.col("l_volume"))
    g = steps.groupBy("code", "launch_date", "l_high", "l_volume", "now").agg(F.count("*").alias("adjust_days"), F.bool_or(ended).alias("ended"), F.avg("volume").alias("v")).where(~F.col("ended"))
    b_ok = (F.col("adjust_days") >= least) & (F.col("v") <= shrink * F.col("l_volume"))
    return g.select("code", "launch_date", "adjust_days", (most + 1 - F.col("adjust_days")).alias("wait_left"), b_ok.alias("b_ok"), (100 * (F.col("l_high") / F.col("now") - 1)).alias("to_high_pct"))


def first_quiet_day(panel: DataFrame, most: int = 10, least: int = 2, shrink: float = 0.8) -> DataFrame:
    """For each launch that got so far: the first day with ``least`` quiet bars behind it and a mean volume of at most ``shrink`` of the launch's."""
    bars = prepared(panel)
    start = launches(bars).select("code", F.col("pos").alias("start"), F.col("date").alias("launch_date"), F.col("high").alias("l_high"), F.col("low").alias("l_low"), F.col("volume").alias("l_volume"))
    steps = start.select("*", F.explode(F.sequence(F.lit(1), F.lit(most))).alias("step")).withColumn("pos", F.col("start") + F.col("step"))
    t = steps.join(bars.select("code", "pos", "date", "close", "low", "volume"), ["code", "pos"])
    so_far = Window.partitionBy("code", "launch_date").orderBy("step").rowsBetween(Window.unboundedPreceding, 0)
    bad = (F.col("low") < F.col("l_low")) | (F.col("close") > F.col("l_high")) | (F.col("volume") >= F.col("l_volume"))
    t = t.withColumn("bad", F.max(bad.cast("int")).over(so_far)).withColumn("mean", F.avg("volume").over(so_far))
    return t.where((F.col("bad") == 0) & (F.col("step") >= least) & (F.col("mean") <= shrink * F.col("l_volume"))).groupBy("code", "launch_date").agg(F.min("date").alias("b_date"))


def pool_days(lists: DataFrame, calendar: DataFrame, kept: int = 60) -> DataFrame:
    """Stays of a code in the pool: its listings, until ``kept`` market days and the one after have passed without any.

    ``calendar`` numbers the market days (date, day).  streak is the longest run of consecutive market days of a stay.
    """
    by_day = Window.partitionBy("code").orderBy("day")
    gap = F.col("day") - F.lag("day").over(by_day)
    d = lists.join(calendar, "date").withColumn("_gap", gap).withColumn("stay", F.sum(F.coalesce((F.col("_gap") > kept + 1).cast("int"), F.lit(1))).over(by_day))
    d = d.withColumn("_island", F.sum(F.coalesce((F.col("_gap") != 1).cast("int"), F.lit(1))).over(by_day))
    d = d.withColumn("_run", F.row_number().over(Window.partitionBy("code", "_island").orderBy("day")))
    return d.groupBy("code", "stay").agg(F.min("date").alias("first"), F.max("date").alias("last"), F.count("*").alias("days"), F.min("rank").cast("long").alias("best"), F.max("_run").cast("long").alias("streak"))


def phases(days: DataFrame) -> DataFrame:
    """ice, mania or normal by the share of risers and the number of large gains against its past."""
    w = Window.orderBy("date").rowsBetween(-20, -1)
    d = days.withColumn("usual", F.avg("large").over(w))
    return d.withColumn("phase", F.when(F.col("up") < 0.35, "ice").when((F.col("up") > 0.6) & (F.col("large") > 1.5 * F.col("usual")), "mania").otherwise("normal"))


def drift(days: DataFrame, n: int = 60) -> DataFrame:
    """Days whose count is over 1.5 times the most of the n days before."""
    w = Window.orderBy("date").rowsBetween(-n, -1)
    return days.withColumn("alert", (F.count("n").over(w) >= 20) & (F.col("n") > 1.5 * F.max("n").over(w)))
