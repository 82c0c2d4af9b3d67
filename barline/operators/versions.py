"""Price versions of one factor history, and what the future in a factor tells about features."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def factors(events: DataFrame, step: float = 1.02) -> DataFrame:
    """(code, date, q): the cumulative factor after each day with events, ``step`` for each event."""
    n = F.sum("n").over(Window.partitionBy("code").orderBy("date"))
    return events.groupBy("code", "date").agg(F.count("*").alias("n")).select("code", "date", F.pow(F.lit(step), n).alias("q"))


def versions(bars: DataFrame, history: DataFrame, decimals: int = 2) -> DataFrame:
    """Adds q (the factor known on the day, 1 before any), q_last (the code's last) and three closes.

    forward: adjusted to the last factor and rounded, as a feed that was fetched later has it; it holds the future.
    pit: adjusted by what the day knew, not rounded.  control: forward with the last factor of the next code, so that
    its rounding and scale are alike but its future is another's.
    """
    asof = Window.partitionBy("code").orderBy("date", F.col("_own").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    both = bars.select("code", "date", "close", F.lit(1).alias("_own"), F.lit(None).cast("double").alias("_q")).unionByName(history.select("code", "date", F.lit(None).cast("double").alias("close"), F.lit(None).cast("int").alias("_own"), F.col("q").alias("_q")))
    known = both.withColumn("q", F.coalesce(F.last("_q", True).over(asof), F.lit(1.0))).where("_own = 1").select("code", "date", "close", "q")
    last = history.groupBy("code").agg(F.max_by("q", "date").alias("q_last"))
    codes = bars.select("code").distinct().join(last, "code", "left").select("code", F.coalesce("q_last", F.lit(1.0)).alias("q_last"))
    # A row a code: each takes the last factor of the next one in order, the last one that of the first.
    ring = Window.orderBy("code")
    codes = codes.withColumn("q_other", F.coalesce(F.lead("q_last").over(ring), F.first("q_last").over(ring)))
    adjusted = lambda q: F.round(F.col("close") * F.col("q") / F.col(q) + 1e-9, decimals)
    return known.join(codes, "code").select("code", "date", "close", "q", "q_last", adjusted("q_last").alias("forward"), (F.col("close") * F.col("q")).alias("pit"), adjusted("q_other").alias("control"))


def leak(d: DataFrame, feature, least: int = 5) -> DataFrame:
    """(date, n, leak, control): per day, the rank correlation of the future factor with what a feature gains from prices that hold it.

    ``feature`` makes a column of a price column.  The same for the control, which should show nothing.
    """
    f = d.select("code", "date", F.log(F.col("q_last") / F.col("q")).alias("_ahead"), *(feature(v).alias(f"_{v}") for v in ("forward", "pit", "control")))
    f = f.select("code", "date", F.round("_ahead", 9).alias("_ahead"), *(F.round(F.col(f"_{v}") - F.col("_pit"), 9).alias(v) for v in ("forward", "control"))).dropna()
    day = Window.partitionBy("date")
    rank = lambda c: F.rank().over(day.orderBy(c)) + (F.count("*").over(Window.partitionBy("date", c)) - 1) / 2
    r = f.select("date", rank("_ahead").alias("a"), rank("forward").alias("b"), rank("control").alias("c"))
    g = r.groupBy("date").agg(F.count("*").alias("n"), *(F.covar_pop("a", x).alias(f"cov_{x}") for x in "bc"), *(F.stddev_pop(x).alias(f"sd_{x}") for x in "abc"))
    corr = lambda x: F.when((F.col("sd_a") > 0) & (F.col(f"sd_{x}") > 0), F.col(f"cov_{x}") / (F.col("sd_a") * F.col(f"sd_{x}")))
    return g.where(F.col("n") >= least).select("date", "n", corr("b").alias("leak"), corr("c").alias("control"))
