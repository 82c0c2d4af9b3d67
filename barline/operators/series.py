"""Statistics of day series and lists: clustered rates, Newey-West, bootstrap, multiple testing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def clustered(df: DataFrame, y: str, day: str = "date") -> DataFrame:
    """n, k, rate and its standard error with days as clusters."""
    days = df.where(F.col(y).isNotNull()).groupBy(day).agg(F.sum(y).alias("k"), F.count(y).alias("n"))
    s = days.agg(F.sum("n").alias("n"), F.sum("k").alias("k"), F.sum(F.col("k") * F.col("k")).alias("kk"), F.sum(F.col("k") * F.col("n")).alias("kn"), F.sum(F.col("n") * F.col("n")).alias("nn"))
    p = F.col("k") / F.col("n")
    return s.select("n", "k", p.alias("rate"), (F.sqrt(F.greatest(F.col("kk") - 2 * p * F.col("kn") + p * p * F.col("nn"), F.lit(0.0))) / F.col("n")).alias("se"))


def newey_west(series: DataFrame, lags: int = 20, by: str = "series") -> DataFrame:
    """Mean, standard error with Bartlett weights, and t of each series (by, date, d); null under lags + 3 values."""
    w = Window.partitionBy(by).orderBy("date")
    centred = series.withColumn("e", F.col("d") - F.avg("d").over(Window.partitionBy(by)))
    gamma = sum(((1 - k / (lags + 1)) * 2 * F.coalesce(F.col("e") * F.lag("e", k).over(w), F.lit(0.0)) for k in range(1, lags + 1)), F.col("e") * F.col("e"))
    s = centred.select(by, "d", gamma.alias("g")).groupBy(by).agg(F.count("*").alias("n"), F.avg("d").alias("mean"), F.sum("g").alias("lrv"))
    se = F.when((F.col("n") >= lags + 3) & (F.col("lrv") > 0), F.sqrt(F.col("lrv")) / F.col("n"))
    return s.select(by, "n", "mean", se.alias("se"), (F.col("mean") / se).alias("t"))


def autocorrelations(series: DataFrame, most: int = 10, by: str = "series") -> DataFrame:
    """One row per series and lag."""
    w = Window.partitionBy(by).orderBy("date")
    centred = series.withColumn("e", F.col("d") - F.avg("d").over(Window.partitionBy(by)))
    products = centred.select(by, (F.col("e") * F.col("e")).alias("p0"), *((F.col("e") * F.lag("e", k).over(w)).alias(f"p{k}") for k in range(1, most + 1)))
    sums = products.groupBy(by).agg(*(F.sum(f"p{k}").alias(f"p{k}") for k in range(most + 1)))
    rows = F.explode(F.array(*(F.struct(F.lit(k).alias("lag"), (F.col(f"p{k}") / F.nullif(F.col("p0"), F.lit(0.0))).alias("acf")) for k in range(1, most + 1)))).alias("r")
    return sums.select(by, rows).select(by, "r.*")


def block_bootstrap(series: DataFrame, replicates: int = 1000, block: int = 20, seed: int = 7, by: str = "series") -> DataFrame:
    """Interval of the mean of each series and its two-sided p by moving blocks of registered draws."""
    from barline.operators.resampling import numbered, resampled

    d = numbered(series.select(by, "date", "d"), [by])
    whole = d.groupBy(by).agg(F.count("*").alias("n"), F.avg("d").alias("mean"))
    means = resampled(d, ["d"], replicates, block, seed, [by]).join(whole, by).select(by, "mean", (F.col("d") / F.col("n")).alias("m"))
    far = (F.round(F.abs(F.col("m") - F.col("mean")), 12) >= F.round(F.abs("mean"), 12)).cast("double")
    return means.groupBy(by).agg(F.first("mean").alias("mean"), F.percentile("m", F.lit(0.025)).alias("low"), F.percentile("m", F.lit(0.975)).alias("high"), F.avg(far).alias("p"))


def adjusted(tests: DataFrame, p: str = "p", key: str = "name") -> DataFrame:
    """Bonferroni, Holm and Benjamini-Hochberg values of one family of tests."""
    n, order = F.count(F.lit(1)).over(Window.partitionBy()), Window.orderBy(p, key)
    d = tests.withColumn("_r", F.row_number().over(order)).withColumn("_n", n)
    holm = F.max(F.least(F.col(p) * (F.col("_n") - F.col("_r") + 1), F.lit(1.0))).over(order.rowsBetween(Window.unboundedPreceding, 0))
    bh = F.min(F.least(F.col(p) * F.col("_n") / F.col("_r"), F.lit(1.0))).over(order.rowsBetween(0, Window.unboundedFollowing))
    return d.select(key, p, F.least(F.col(p) * F.col("_n"), F.lit(1.0)).alias("bonferroni"), holm.alias("holm"), bh.alias("bh"))


def auc(df: DataFrame, score: str, y: str, by: str) -> DataFrame:
    """Area under the curve per group by rank sums with mean ranks for ties; null with one class only."""
    w = Window.partitionBy(by)
    r = F.rank().over(w.orderBy(score)) + (F.count("*").over(Window.partitionBy(by, score)) - 1) / 2
    g = df.where(F.col(y).isNotNull() & F.col(score).isNotNull()).withColumn("_r", r).groupBy(by).agg(F.sum(F.when(F.col(y) == 1, F.col("_r")).otherwise(0.0)).alias("s"), F.sum(F.col(y).cast("long")).alias("pos"), F.count("*").alias("n"))
    neg = F.col("n") - F.col("pos")
    return g.select(by, "n", "pos", ((F.col("s") - F.col("pos") * (F.col("pos") + 1) / 2) / F.nullif((F.col("pos") * neg).cast("double"), F.lit(0.0))).alias("auc"))


def spearman(df: DataFrame, x: str, y: str, by: str) -> DataFrame:
    from barline.operators.crosssection import pct_rank

    both = df.where(F.col(x).isNotNull() & F.col(y).isNotNull())
    d = both.select(by, pct_rank(x, by).alias("_x"), pct_rank(y, by).alias("_y"))
    g = d.groupBy(by).agg(F.count("*").alias("n"), F.covar_pop("_x", "_y").alias("c"), F.stddev_pop("_x").alias("sx"), F.stddev_pop("_y").alias("sy"))
    return g.select(by, "n", (F.col("c") / F.nullif(F.col("sx") * F.col("sy"), F.lit(0.0))).alias("rho"))


def overlap(lists: DataFrame, key: str = "code", day: str = "date") -> DataFrame:
    """Jaccard similarity of each day's list with the day before's."""
    w = Window.orderBy(day)
    sets = lists.groupBy(day).agg(F.collect_set(key).alias("s")).withColumn("_b", F.lag("s").over(w))
    return sets.where(F.col("_b").isNotNull()).select(day, (F.size(F.array_intersect("s", "_b")) / F.size(F.array_union("s", "_b"))).alias("jaccard"))


def hit_table(df: DataFrame, bucket: Column, y: str) -> DataFrame:
    from barline.functions.scalars import wilson

    g = df.where(F.col(y).isNotNull()).groupBy(bucket.alias("bucket")).agg(F.count("*").alias("n"), F.sum(y).alias("k"))
    low, high = wilson(F.col("k"), F.col("n"))
    return g.select("bucket", "n", "k", (F.col("k") / F.col("n")).alias("rate"), low.alias("low"), high.alias("high"))
