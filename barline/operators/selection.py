"""Scores and rules judged by what followed in months whose outcomes are known."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def cumulative_precision(rows: DataFrame, score: str, y: str, end: str, months: int = 12, least: int = 200, least_days: int = 20, digits: int = 3) -> DataFrame:
    """month, score, n and p: for each month's scores, the hit rate of all earlier rows that scored as much or more.

    A month learns from rows of the ``months`` before it whose outcome, dated ``end``, was
    known by its first day.  Scores are rounded to ``digits``, so windows run over distinct
    scores of a month, not over rows.  Below ``least`` rows or ``least_days`` days p is 0.
    """
    s = rows.select("date", F.trunc("date", "month").alias("month"), F.round(score, digits).alias("score"), F.col(y).cast("long").alias("y"), F.col(end).alias("end")).where("score IS NOT NULL")
    later = F.transform(F.sequence(F.lit(1), F.lit(months)), lambda i: F.add_months(F.col("month"), i))
    known = s.where("y IS NOT NULL AND end IS NOT NULL").select("date", "score", "y", "end", F.explode(later).alias("month")).where(F.col("end") < F.col("month"))
    scores = known.groupBy("month", "score").agg(F.count("*").alias("k"), F.sum("y").alias("hits"))
    days = known.groupBy("month", "date").agg(F.max("score").alias("score")).groupBy("month", "score").agg(F.count("*").alias("days"))
    wanted = s.groupBy("month", "score").agg(F.count("*").alias("n"))
    both = wanted.join(scores, ["month", "score"], "full").join(days, ["month", "score"], "left")
    down = Window.partitionBy("month").orderBy(F.col("score").desc()).rowsBetween(Window.unboundedPreceding, 0)
    run = lambda c: F.sum(F.coalesce(c, F.lit(0))).over(down)
    enough = (run("k") >= least) & (run("days") >= least_days)
    rate = F.when(F.col("k").isNotNull(), F.when(enough, run("hits") / run("k")).otherwise(0.0))
    up = Window.partitionBy("month").orderBy("score").rowsBetween(0, Window.unboundedFollowing)
    top = Window.partitionBy("month")
    out = both.withColumn("_p", rate).withColumn("_any", F.count("k").over(top))
    return out.withColumn("p", F.coalesce(F.first("_p", ignorenulls=True).over(up), F.lit(0.0))).where("n IS NOT NULL AND _any > 0").select("month", "score", "n", "p")


def conjunctions(rows: DataFrame, predicates: list[Column], y: str, confirm: Column, most: int = 3, least: int = 100, precision: float = 0.15) -> DataFrame:
    """Every conjunction of up to ``most`` predicates, as a bit mask, with support and hits before and after ``confirm`` turns true.

    Rows are counted by the mask of predicates that hold, so that rules are spread over at
    most 2^len(predicates) groups and not over rows.
    """
    mask = sum((F.when(p, 1 << i).otherwise(0) for i, p in enumerate(predicates)), F.lit(0))
    groups = rows.where(F.col(y).isNotNull()).groupBy(mask.alias("mask"), F.coalesce(confirm, F.lit(False)).alias("later")).agg(F.count("*").alias("n"), F.sum(y).alias("k"))
    rules = F.filter(F.sequence(F.lit(1), F.lit((1 << len(predicates)) - 1)), lambda r: (r.bitwiseAND(F.col("mask")) == r) & (F.bit_count(r) <= most))
    spread = groups.select(F.explode(rules).alias("rule"), "later", "n", "k")
    total = lambda c, later: F.coalesce(F.sum(F.when(F.col("later") == later, F.col(c))), F.lit(0)).cast("long")
    g = spread.groupBy("rule").agg(total("n", False).alias("n_fit"), total("k", False).alias("k_fit"), total("n", True).alias("n_confirm"), total("k", True).alias("k_confirm"))
    good = lambda part: (F.col(f"n_{part}") >= least) & (F.col(f"k_{part}") >= precision * F.col(f"n_{part}"))
    return g.withColumn("kept", good("fit") & good("confirm"))


def future_changes(before: DataFrame, after: DataFrame, features: list[str], keys: tuple[str, ...] = ("code", "date")) -> DataFrame:
    """For each code, the rows of ``before`` and how many differ in ``after``; features that look ahead show up here.

    Both frames hold the rows up to the day from which ``after``'s source was changed.
    """
    old = before.select(*keys, *(F.col(f).alias(f"{f}_old") for f in features))
    same = [F.col(f"{f}_old").eqNullSafe(F.col(f)) for f in features]
    joined = old.join(after.withColumn("_here", F.lit(True)), list(keys), "left")
    return joined.groupBy(keys[0]).agg(F.count("*").alias("n"), F.count_if(F.col("_here").isNull()).alias("missing"), *(F.count_if(F.col("_here") & ~s).alias(f"{f}_changed") for f, s in zip(features, same)))
