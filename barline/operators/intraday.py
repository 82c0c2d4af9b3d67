"""Minute bars, day features and samples from ticks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def minute_bars(ticks: DataFrame, every: str = "1 minute", by: tuple[str, ...] = ("code",)) -> DataFrame:
    """Open, high, low, close, ticks and signed flow per window; works on batches and streams."""
    order = F.struct("ts", "event_id")
    g = ticks.groupBy(*by, F.window("ts", every).alias("w")).agg(F.min_by("price", order).alias("open"), F.max("price").alias("high"), F.min("price").alias("low"), F.max_by("price", order).alias("close"), F.count("*").alias("n"), F.sum(F.col("side") * F.col("value")).alias("flow"), F.sum("value").alias("volume"))
    return g.select(*by, F.col("w.start").alias("minute"), "open", "high", "low", "close", "n", "flow", "volume")


def day_features(minutes: DataFrame) -> DataFrame:
    """Per code and day: average price gap, drawdown, realised volatility, share of the first hour's volume, minute of the high."""
    day = F.to_date("minute")
    d = minutes.withColumn("date", day)
    w = Window.partitionBy("code", "date").orderBy("minute")
    d = d.withColumn("_peak", F.max("high").over(w.rowsBetween(Window.unboundedPreceding, 0))).withColumn("_r", F.log(F.col("close") / F.lag("close").over(w))).withColumn("_first", F.min("minute").over(Window.partitionBy("code", "date")))
    early = F.when(F.unix_timestamp("minute") < F.unix_timestamp("_first") + 3600, F.col("volume")).otherwise(0.0)
    vwap = F.sum(F.col("close") * F.col("volume")) / F.nullif(F.sum("volume"), F.lit(0.0))
    return d.groupBy("code", "date").agg(F.count("*").alias("minutes"), (F.max_by("close", "minute") / vwap - 1).alias("vwap_gap"), F.min(F.col("low") / F.col("_peak") - 1).alias("drawdown"), F.sqrt(F.sum(F.col("_r") * F.col("_r"))).alias("realised"), (F.sum(early) / F.nullif(F.sum("volume"), F.lit(0.0))).alias("first_hour"), F.min_by("minute", F.struct(-F.col("high"), F.col("minute"))).alias("high_at"))


def samples(ticks: DataFrame, hours: list[int], most_late: int = 1800) -> DataFrame:
    """The first price at or after each hour of the day, at most ``most_late`` seconds late, in columns."""
    point = F.explode(F.array(*map(F.lit, hours))).alias("hour")
    d = ticks.select("code", F.col("ts").cast("timestamp").alias("ts"), "event_id", "price", point).withColumn("date", F.to_date("ts"))
    late = F.unix_micros("ts") / 1e6 - F.unix_timestamp(F.col("date").cast("timestamp")) - F.col("hour") * 3600
    d = d.withColumn("late", late).where((F.col("late") >= 0) & (F.col("late") <= most_late))
    return d.groupBy("code", "date").pivot("hour", hours).agg(F.min_by("price", F.struct("ts", "event_id"))).select("code", "date", *(F.col(f"`{h}`").alias(f"at{h}") for h in hours))
