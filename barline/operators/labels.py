"""Labels and truths that look ahead."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barline.operators.windows import ahead, by_code, lag


def rise_ahead(n: int = 20) -> Column:
    """Highest high of the next n rows over the close, null without n rows."""
    return F.when(F.count("high").over(ahead(n)) == n, F.max("high").over(ahead(n)) / F.col("close") - 1)


def label_up(panel: DataFrame, n: int = 20, threshold: float = 0.3) -> DataFrame:
    return panel.withColumn("rise", rise_ahead(n)).withColumn("y", (F.col("rise") > threshold).cast("int"))


def first_days(labelled: DataFrame) -> DataFrame:
    """Marks the first row of each run of positive labels."""
    return labelled.withColumn("first", ((F.col("y") == 1) & (F.coalesce(lag("y"), F.lit(0)) != 1)).cast("int"))


def label_buyable(panel: DataFrame, n: int = 20, threshold: float = 0.3, limit: float = 0.045) -> DataFrame:
    """Rise from the next open, and positive only if the next day's low leaves room below the limit price."""
    nxt_open, nxt_low = F.lead("open").over(by_code()), F.lead("low").over(by_code())
    whole = F.count("high").over(ahead(n)) == n
    d = panel.withColumn("rise_open", F.when(whole, F.max("high").over(ahead(n)) / nxt_open - 1))
    blocked = nxt_low >= F.col("close") * (1 + limit)
    return d.withColumn("y_open", F.when(F.col("rise_open").isNotNull(), ((F.col("rise_open") > threshold) & ~blocked).cast("int")))


def path_risk(panel: DataFrame, n: int = 20, threshold: float = 0.3, drawdown: float = -0.15) -> DataFrame:
    """Lowest low up to the first highest high of the window over the close; positive if it holds."""
    lows, highs = F.collect_list("low").over(ahead(n)), F.collect_list("high").over(ahead(n))
    d = panel.withColumn("_lows", lows).withColumn("_highs", highs).withColumn("_at", F.array_position("_highs", F.array_max("_highs")))
    fall = F.when(F.size("_highs") == n, F.array_min(F.slice("_lows", F.lit(1), F.col("_at").cast("int"))) / F.col("close") - 1)
    d = d.withColumn("fall", fall)
    return d.withColumn("y_safe", F.when(F.col("fall").isNotNull(), ((F.array_max("_highs") / F.col("close") - 1 > threshold) & (F.col("fall") > drawdown)).cast("int"))).drop("_lows", "_highs", "_at")


def continuation(panel: DataFrame, n: int = 10, threshold: float = 0.15) -> DataFrame:
    nxt = F.lead("open").over(by_code())
    whole = F.count("high").over(ahead(n)) == n
    return panel.withColumn("cont", F.when(whole, (F.max("high").over(ahead(n)) / nxt - 1 >= threshold).cast("int"))).withColumn("next_day", F.lead("close").over(by_code()) / nxt - 1)


def grade(rise: Column, buyable: Column) -> Column:
    return F.when(rise.isNull(), None).when((rise > 0.3) & (buyable == 1), 3).when(rise > 0.2, 2).when(rise > 0.1, 1).otherwise(0)


def forward(events: DataFrame, panel: DataFrame, n: int = 20) -> DataFrame:
    """For each event (code, date): rows after it up to n, best rise and return at the last of them."""
    d = panel.select("code", "date", F.count("high").over(ahead(n)).alias("n_after"), (F.max("high").over(ahead(n)) / F.col("close") - 1).alias("max_up"), (F.last("close").over(ahead(n)) / F.col("close") - 1).alias("ret"))
    return events.join(d, ["code", "date"], "left")
