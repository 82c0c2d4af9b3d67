"""Point-in-time and interval joins between a panel and dated events.

Each runs on an equality of the code and sorted rows inside it, so work grows with the
number of rows, and a busy code is one sort among many.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def as_of(panel: DataFrame, events: DataFrame, at: str, values: list[str], tie: str, strict: bool = False) -> DataFrame:
    """The latest event of the code with ``at`` <= date (< if strict); ties go to the larger ``tie``.

    Adds ``values`` and ``age``, the days since; null before the first event.
    """
    fields = list(dict.fromkeys([at, tie, *values]))
    side = panel.select("*", F.lit(None).cast(events.select(F.struct(*fields)).schema[0].dataType).alias("_e"), F.col("date").alias("_at"), F.lit(0 if strict else 1).alias("_side"))
    other = events.select(F.col("code"), F.struct(*fields).alias("_e"), F.col(at).alias("_at"), F.lit(1 if strict else 0).alias("_side"), F.lit(True).alias("_event"))
    both = side.withColumn("_event", F.lit(False)).unionByName(other, allowMissingColumns=True)
    w = Window.partitionBy("code").orderBy("_at", "_side", F.col(f"_e.{tie}").asc_nulls_first()).rowsBetween(Window.unboundedPreceding, 0)
    d = both.withColumn("_last", F.last("_e", ignorenulls=True).over(w)).where(~F.col("_event"))
    return d.select(*panel.columns, *(F.col(f"_last.{v}").alias(v) for v in values), F.datediff("date", F.col(f"_last.{at}")).alias("age"))


def sum_between(panel: DataFrame, events: DataFrame, at: str, value: Column, first: int, last: int, name: str) -> DataFrame:
    """Sum and count of events of the code from ``first`` to ``last`` days after each row's date."""
    day = lambda c: F.datediff(c, F.lit("1970-01-01").cast("date"))
    side = panel.select("*", day(F.col("date")).alias("_day"), F.lit(None).cast("double").alias("_v"), F.lit(False).alias("_event"))
    other = events.select("code", day(F.col(at)).alias("_day"), value.cast("double").alias("_v"), F.lit(True).alias("_event"))
    w = Window.partitionBy("code").orderBy("_day").rangeBetween(first, last)
    d = side.unionByName(other, allowMissingColumns=True).select("*", F.coalesce(F.sum("_v").over(w), F.lit(0.0)).alias(f"{name}_sum"), F.count("_v").over(w).alias(f"{name}_n"))
    return d.where(~F.col("_event")).select(*panel.columns, f"{name}_sum", f"{name}_n")


def next_day(dates: DataFrame, column: str, calendar: DataFrame) -> DataFrame:
    """Adds ``next_day``: the first calendar date at or after ``column``; null after the last."""
    # The calendar is a row per date, so its gaps, of any length, are a row per day of its span.
    ends = calendar.select(F.col("date").alias("_to"), F.coalesce(F.date_add(F.lag("date").over(Window.orderBy("date")), 1), F.col("date")).alias("_from"))
    days = ends.select("_to", F.explode(F.sequence("_from", "_to")).alias("_day"))
    first = calendar.agg(F.min("date").alias("_first"))
    d = dates.join(days, F.col(column) == F.col("_day"), "left").crossJoin(F.broadcast(first))
    return d.withColumn("next_day", F.when(F.col(column) < F.col("_first"), F.col("_first")).otherwise(F.col("_to"))).drop("_day", "_to", "_first")


def days_since(panel: DataFrame, events: DataFrame, at: str, most: int, name: str) -> DataFrame:
    """Days since the latest event of the code, 99 if over ``most`` or none."""
    d = as_of(panel, events.select("code", at).distinct().withColumn("_one", F.lit(1)), at, ["_one"], "_one")
    return d.withColumn(name, F.when(F.col("age") <= most, F.col("age")).otherwise(99)).drop("_one", "age")


def open_processes(events: DataFrame, asof: Column, days: int, starts: list[str], ends: list[str]) -> DataFrame:
    """The latest starting event of each code in ``days`` before ``asof`` that no ending one follows."""
    recent = events.where((F.col("date") <= asof) & (F.col("date") >= F.date_sub(asof, days)))
    last = recent.where(F.col("kind").isin(starts)).groupBy("code").agg(F.max_by("notice_id", F.struct("date", "notice_id")).alias("notice_id"), F.max("date").alias("date"))
    over = recent.where(F.col("kind").isin(ends)).groupBy("code").agg(F.max("date").alias("_over"))
    return last.join(over, "code", "left").where(F.col("_over").isNull() | (F.col("_over") <= F.col("date"))).drop("_over")
