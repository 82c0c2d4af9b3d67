"""Largest holders of a code by period."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def top_holders(rows: DataFrame, holder: str, size: str, k: int = 10) -> DataFrame:
    """For each code and period: the share of the k largest holders, how many are new or grew since the code's period before, and the share's change.

    ``rows`` holds code, period, a holder and a size; a holder's rows are summed first, so
    the ranking window runs over holders.  Ties go to the smaller holder.
    """
    held = rows.groupBy("code", "period", F.col(holder).alias("holder")).agg(F.sum(size).alias("size"))
    own = Window.partitionBy("code", "period")
    ranked = held.select("*", F.sum("size").over(own).alias("whole"), F.row_number().over(own.orderBy(F.col("size").desc(), "holder")).alias("place")).where(F.col("place") <= k)
    periods = ranked.groupBy("code", "period").agg(F.count("*").alias("n"), F.sum("size").alias("top"), F.first("whole").alias("whole"), F.max("size").alias("most"))
    by = Window.partitionBy("code").orderBy("period")
    periods = periods.withColumns({"before": F.lag("period").over(by), "ratio": F.col("top") / F.nullif(F.col("whole"), F.lit(0))})
    periods = periods.withColumn("change", F.col("ratio") - F.lag("ratio").over(by))
    then = ranked.select("code", F.col("period").alias("before"), "holder", F.col("size").alias("old"))
    dated = ranked.select("code", "period", "holder", "size").join(periods.select("code", "period", "before"), ["code", "period"])
    met = dated.join(then, ["code", "before", "holder"], "left")
    moved = met.groupBy("code", "period").agg(F.count_if(F.col("before").isNotNull() & F.col("old").isNull()).alias("n_new"), F.count_if(F.col("size") > F.col("old")).alias("n_up"))
    return periods.join(moved, ["code", "period"]).select("code", "period", "n", "n_new", "n_up", "ratio", "change", (F.col("most") / F.nullif(F.col("whole"), F.lit(0))).alias("largest"))
