"""Sampling, weights, purged training slices, and learners given as functions over months."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from barline.operators.windows import by_code


def stratified(df: DataFrame, y: str = "y", per_positive: int = 12, seed: int = 1, by: str = "month") -> DataFrame:
    """All positives and, in each month, up to ``per_positive`` negatives for each, the first by a hash."""
    pos = F.sum(F.when(F.col(y) == 1, 1).otherwise(0)).over(Window.partitionBy(by))
    turn = F.row_number().over(Window.partitionBy(by, y).orderBy(F.xxhash64(F.lit(seed), "code", "date"), "code", "date"))
    return df.where(F.col(y).isNotNull()).withColumn("_p", pos).withColumn("_t", turn).where((F.col(y) == 1) | (F.col("_t") <= per_positive * F.col("_p"))).drop("_p", "_t")


def weights(df: DataFrame, half_life: float = 250.0, by: str = "month") -> DataFrame:
    """Equal weight of months, with mean 1 over the table, and a decay with the age in days, from the table's last date."""
    months = df.groupBy(by).agg(F.count("*").alias("_n"), F.max("date").alias("_m"))
    whole = Window.partitionBy()  # over a row a month
    months = months.select(by, (F.sum("_n").over(whole) / F.count("*").over(whole) / F.col("_n")).alias("w_month"), F.max("_m").over(whole).alias("_last"))
    return df.join(F.broadcast(months), by).withColumn("w_age", F.pow(F.lit(0.5), F.datediff("_last", "date") / half_life)).drop("_last")


def purged(df: DataFrame, month: str, gap: int = 20) -> DataFrame:
    """Rows before ``month`` (its first day) whose label window of ``gap`` rows closed before it."""
    start = F.lit(month).cast("date")
    return df.withColumn("_closed", F.lead("date", gap).over(by_code())).where((F.col("date") < start) & (F.col("_closed") < start)).drop("_closed")


def walk_forward(df: DataFrame, months: list, learners: list, months_back: int = 36, gap: int = 20, y: str = "y") -> DataFrame:
    """Scored rows (code, date, y, p, arm, month) of each month by each learner, which has seen only the purged months before.

    A learner is a function of (train, test) that returns the test rows with ``p`` and its name as ``arm``; it may fit anything.
    Only the months are a driver loop; ``df`` should be a written table, as every month reads it.
    """
    closed = df.withColumn("_closed", F.lead("date", gap).over(by_code())).where(F.col(y).isNotNull())
    out = None
    for m in months:
        start = F.lit(m).cast("date")
        train = closed.where((F.col("_closed") < start) & (F.col("date") >= F.add_months(start, -months_back)))
        test = df.where((F.trunc("date", "month") == start) & F.col(y).isNotNull())
        for learner in learners:
            scored = learner(train.drop("_closed"), test).select("code", "date", y, "p", "arm", start.alias("month"))
            out = scored if out is None else out.unionByName(scored)
    return out
