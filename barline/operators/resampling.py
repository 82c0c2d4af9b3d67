"""Resampling by registered draws: blocks of days, permutations and combinations, the same on any engine.

A draw is a number of (seed, replicate, k) by modular arithmetic, so a replicate can be repeated anywhere.
Series are few and have a row a day; block sums come from running sums, so a replicate costs n / block rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from barline.sources.roundtrips import written

#: Modulus and multiplier of the draws.
M, A = 2_147_483_647, 48_271


def draw(seed: int, rep: Column, k: Column, n: Column | int) -> Column:
    """A number from 0 to n - 1.

    Squares break the line that draws of neighbouring replicates and numbers would else lie on; products stay below 2^63.
    """
    x = (F.lit(seed * 40_692 + 12_345).cast("long") + rep.cast("long") * A + k.cast("long") * 69_621) % M
    for _ in range(3):
        x = (x * x + x * A + 12_345) % M
    return x % n


def draw_sql(seed: int, rep: str, k: str, n: str) -> str:
    x = f"(({seed * 40_692 + 12_345} + CAST({rep} AS BIGINT) * {A} + CAST({k} AS BIGINT) * 69621) % {M})"
    # Each step is a list of one number and so named once: spelt out, the text would double with every square.
    out = f"[{x}]"
    for _ in range(3):
        out = f"list_transform({out}, lambda z: (z * z + z * {A} + 12345) % {M})"
    return f"({out}[1] % {n})"


def replicated(size: DataFrame, replicates: int) -> DataFrame:
    """A row for each replicate of each row of ``size``, a row a series: dealt over tasks, as its draws are many from few rows."""
    reps = size.sparkSession.range(1, replicates + 1).withColumnRenamed("id", "rep")
    return reps.crossJoin(F.broadcast(size))


def starts(size: DataFrame, replicates: int, block: int, seed: int) -> DataFrame:
    """(rep, b, i, part) for each row of ``size`` (n): where the blocks of each replicate begin, and whether the block is the last, shorter one.

    A replicate has n days: whole blocks, then what is missing.
    """
    blocks = F.ceil(F.col("n") / block)
    d = replicated(size.where(F.col("n") >= 2 * block), replicates)
    d = d.select("*", F.explode(F.sequence(F.lit(1).cast("long"), blocks)).alias("b"))
    return d.withColumn("i", draw(seed, F.col("rep"), F.col("b"), F.col("n") - block + 1)).withColumn("part", (F.col("b") == blocks) & (F.col("n") % block != 0))


def resampled(series: DataFrame, values: list[str], replicates: int, block: int, seed: int, by: list[str], shared: bool = False) -> DataFrame:
    """Sums of the values in each replicate of each series of (by, i, n, values).

    With ``shared`` all series, which must have the same days, take the same blocks.  The series, a row a day, are
    what is broadcast: draws look as small as the sizes they are made from and would else be it.
    """
    w = Window.partitionBy(*by).orderBy("i")
    run = series.select(*by, "i", "n", *(F.sum(v).over(w.rowsBetween(0, block - 1)).alias(f"{v}_s") for v in values), *(F.sum(v).over(w.rowsBetween(Window.unboundedPreceding, 0)).alias(f"{v}_r") for v in values), *values)
    # The last block of a replicate has n % block days: the running sum there less the one before the start.
    rest = F.col("n") % block
    ends = run.select(*by, F.col("i").alias("_end"), *(F.col(f"{v}_r").alias(f"{v}_e") for v in values))
    sizes = series.select(*([] if shared else by), "n").distinct()
    at = starts(sizes, replicates, block, seed)
    keys = ["i", "n"] if shared else [*by, "i", "n"]
    d = at.join(F.broadcast(run), keys)
    d = d.withColumn("_end", F.col("i") + rest - 1).join(F.broadcast(ends), [*by, "_end"], "left")
    own = lambda v: F.when(F.col("part"), F.col(f"{v}_e") - F.col(f"{v}_r") + F.col(v)).otherwise(F.col(f"{v}_s"))
    return d.groupBy(*by, "rep").agg(*(F.sum(own(v)).alias(v) for v in values))


def numbered(series: DataFrame, by: list[str]) -> DataFrame:
    """Adds i, the day's number from 0, and n, the days of the series."""
    w = Window.partitionBy(*by)
    return series.withColumn("i", F.row_number().over(w.orderBy("date")).cast("long") - 1).withColumn("n", F.count("*").over(w))


def aligned(series: DataFrame, by: str = "series") -> DataFrame:
    """Series of (by, date, d) on their common calendar: i, n, e (d less the series' mean, 0 where it is missing) and has (1 or 0)."""
    days = series.select("date").distinct()
    grid = days.crossJoin(F.broadcast(series.select(by).distinct()))  # few series
    d = grid.join(series.select(by, "date", "d"), [by, "date"], "left")
    e = F.coalesce(F.col("d") - F.avg("d").over(Window.partitionBy(by)), F.lit(0.0))
    return numbered(d.select(by, "date", e.alias("e"), F.col("d").isNotNull().cast("int").alias("has")), [by])


def max_t(series: DataFrame, errors: DataFrame, replicates: int = 1000, block: int = 20, seed: int = 7, by: str = "series") -> DataFrame:
    """(rep, t): the largest t over all series of each replicate, whose blocks of days all series share; ``errors`` has se by series."""
    sums = resampled(aligned(series, by), ["e", "has"], replicates, block, seed, [by], shared=True)
    t = sums.join(errors.select(by, "se"), by).withColumn("t", F.col("e") / F.greatest("has", F.lit(1)) / F.col("se"))
    return t.groupBy("rep").agg(F.max("t").alias("t"))


#: Terms of the series of the normal distribution, and steps of a bisection from 0 to 8.
TERMS, STEPS = 90, 60


def normal_cdf(x: Column) -> Column:
    """By its series around 0, exact to 1e-12 up to 5, in any engine the same operations."""
    out = F.aggregate(F.sequence(F.lit(TERMS), F.lit(1), F.lit(-1)), F.lit(0.0), lambda sum_, k: (sum_ + 1) * x * x / (2 * k + 1))
    return F.lit(0.5) + F.exp(-x * x / 2) * x * (out + 1) * 0.3989422804014327


def normal_cdf_sql(x: str) -> str:
    out = f"list_reduce(range({TERMS}, 0, -1), lambda a, k: (a + 1) * {x} * {x} / (2 * k + 1), CAST(0 AS DOUBLE))"
    return f"(0.5 + EXP(-{x} * {x} / 2) * {x} * ({out} + 1) * 0.3989422804014327)"


def family_threshold(largest: DataFrame, unseen: int, series: int, fwer: float = 0.05, floor: float = 2.5) -> DataFrame:
    """The least t that keeps the family's error: share of replicates at or above it and the normal tails of trials without a series.

    One row: maxt (the root of that sum), bonferroni (the root for normal tails of all trials) and threshold.
    """
    # A replicate's number each, so the list is as long as there are replicates.
    d = largest.agg(F.sort_array(F.collect_list("t")).alias("ts"))
    tail = lambda c: 1 - normal_cdf(c)

    def root(excess) -> Column:
        start = F.struct(F.lit(0.0).alias("lo"), F.lit(8.0).alias("hi"))

        def step(s: Column, _: Column) -> Column:
            mid = (s["lo"] + s["hi"]) / 2
            fits = excess(mid) <= fwer
            return F.struct(F.when(fits, s["lo"]).otherwise(mid).alias("lo"), F.when(fits, mid).otherwise(s["hi"]).alias("hi"))

        return F.aggregate(F.sequence(F.lit(1), F.lit(STEPS)), start, step)["hi"]

    above = lambda c: F.size(F.filter("ts", lambda t: t >= c)) / F.size("ts")
    d = d.withColumn("maxt", root(lambda c: above(c) + unseen * tail(c))).withColumn("bonferroni", root(lambda c: (unseen + series) * tail(c)))
    return d.select("maxt", "bonferroni", F.greatest(F.lit(floor), F.least("maxt", "bonferroni")).alias("threshold"))


def ratio_bootstrap(days: DataFrame, replicates: int = 1000, block: int = 20, seed: int = 11, by: str = "series") -> DataFrame:
    """Sum of hits over sum of rows of (by, date, k, n_rows), and its 95 % interval by blocks of days; without rows a replicate has no ratio."""
    d = numbered(days.select(by, "date", F.col("k").cast("double").alias("k"), F.col("n_rows").cast("double").alias("m")), [by])
    whole = d.groupBy(by).agg((F.sum("k") / F.sum("m")).alias("ratio"))
    reps = resampled(d, ["k", "m"], replicates, block, seed, [by]).withColumn("x", F.when(F.col("m") > 0, F.col("k") / F.col("m")))
    return reps.groupBy(by).agg(F.percentile("x", F.lit(0.025)).alias("low"), F.percentile("x", F.lit(0.975)).alias("high")).join(whole, by)


def day_bootstrap(pairs: DataFrame, replicates: int = 1000, cap: float = 0.05, seed: int = 13, by: str = "series") -> DataFrame:
    """Share of replicates of days in which the mean difference, each day's capped at ``cap`` either way, is above 0.

    The series, a row a day, are written once and broadcast; the draws, as many for each replicate, stay in their tasks.
    """
    d = written(numbered(pairs.select(by, "date", F.greatest(F.least("d", F.lit(cap)), F.lit(-cap)).alias("d")), [by]), "days")
    drawn = replicated(d.select(by, "n").distinct(), replicates).select("*", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n"))).alias("b"))
    drawn = drawn.withColumn("i", draw(seed, F.col("rep"), F.col("b"), F.col("n")))
    sums = drawn.join(F.broadcast(d.select(by, "i", "d")), [by, "i"]).groupBy(by, "rep").agg(F.sum("d").alias("s"))
    return sums.groupBy(by).agg(F.avg((F.round("s", 9) > 0).cast("double")).alias("better"))


def block_permutation(days: DataFrame, replicates: int = 500, block: int = 20, seed: int = 3) -> DataFrame:
    """Difference of the mean of h on flagged and other days of (date, h, flag), and the 95 % quantile of it when the flag's blocks are put in random order."""
    w = Window.orderBy("date")  # a row a day
    d = days.select("date", "h", "flag", (F.row_number().over(w) - 1).cast("long").alias("i")).withColumn("b", F.floor(F.col("i") / block))
    size = d.groupBy("b").agg(F.count("*").alias("n"))
    order = size.select("*", F.explode(F.sequence(F.lit(1), F.lit(replicates))).alias("rep")).withColumn("u", draw(seed, F.col("rep"), F.col("b"), M))
    in_rep = Window.partitionBy("rep").orderBy("u", "b").rowsBetween(Window.unboundedPreceding, -1)
    order = order.withColumn("at", F.coalesce(F.sum("n").over(in_rep), F.lit(0)))
    flags = order.join(F.broadcast(d.select("b", (F.col("i") - F.col("b") * block).alias("o"), "flag")), "b").select("rep", (F.col("at") + F.col("o")).alias("i"), "flag")
    mean = lambda on: F.avg(F.when(F.col("flag") == on, F.col("h")))
    null = flags.join(F.broadcast(d.select("i", "h")), "i").groupBy("rep").agg((mean(True) - mean(False)).alias("x"))
    actual = d.agg((mean(True) - mean(False)).alias("actual"))
    return null.agg(F.percentile("x", F.lit(0.95)).alias("null95")).crossJoin(actual)


def overfit(arms: DataFrame, parts: int = 8) -> DataFrame:
    """Every split of (date, arm, d) into halves of ``parts`` stretches of days: the arm that wins in one half, and the logit of its rank in the other.

    Only days with every arm count.  Ties in the first half go to the arm of the least name.
    """
    n_arms = F.count("*").over(Window.partitionBy("date"))
    every = arms.select("arm").distinct().agg(F.count("*").alias("_arms"))
    d = arms.where("d IS NOT NULL").withColumn("_n", n_arms).crossJoin(F.broadcast(every)).where("_n = _arms").select("date", "arm", "d")
    days = d.select("date").distinct().withColumn("i", F.row_number().over(Window.orderBy("date")) - 1)  # a row a day
    days = days.crossJoin(F.broadcast(days.agg(F.count("*").alias("t"))))
    k = F.expr(f"aggregate(sequence(1, {parts - 1}), 0, (a, p) -> a + IF(i >= t * p DIV {parts}, 1, 0))")
    sums = d.join(days.select("date", k.alias("part")), "date").groupBy("arm", "part").agg(F.sum("d").alias("s"), F.count("*").alias("n"))
    splits = arms.sparkSession.range(1 << parts).where(F.bit_count("id") == parts // 2).withColumnRenamed("id", "split")
    inside = F.expr("shiftright(split, part) & 1") == 1
    both = splits.crossJoin(F.broadcast(sums)).groupBy("split", "arm").agg(
        (F.sum(F.when(inside, F.col("s"))) / F.sum(F.when(inside, F.col("n")))).alias("i"), (F.sum(F.when(~inside, F.col("s"))) / F.sum(F.when(~inside, F.col("n")))).alias("o")
    )
    both = both.select("split", "arm", F.round("i", 12).alias("i"), F.round("o", 12).alias("o"))
    best = both.groupBy("split").agg(F.min_by(F.struct("arm", "i", "o"), F.struct(-F.col("i"), "arm")).alias("w"), F.count("*").alias("arms"))
    r = both.join(best, "split").groupBy("split", "w", "arms").agg((F.sum((F.col("o") < F.col("w.o")).cast("int")) + (F.sum((F.col("o") == F.col("w.o")).cast("int")) - 1) / 2 + 1).alias("rank"))
    share = F.col("rank") / (F.col("arms") + 1)
    return r.select("split", F.col("w.arm").alias("arm"), F.col("w.i").alias("inside"), F.col("w.o").alias("outside"), "rank", F.log(share / (1 - share)).alias("logit"))
