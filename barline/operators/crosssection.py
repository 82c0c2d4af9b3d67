"""Transforms across the codes of a date, and ranks."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def pct_rank(x: str, *by: str) -> Column:
    """Rank in (0, 1] inside a group; ties share their mean rank, nulls stay null and don't count."""
    w = Window.partitionBy(*by)
    r = F.rank().over(w.orderBy(F.col(x).asc_nulls_last()))
    ties = F.count(x).over(Window.partitionBy(*by, x))
    return F.when(F.col(x).isNotNull(), (r + (ties - 1) / 2) / F.count(x).over(w))


def pct_ranks(df: DataFrame, xs: list[str], by: str) -> DataFrame:
    """``df`` with each of ``xs`` replaced by its ``pct_rank`` inside a group.

    Rows are shuffled and sorted by group once for all columns, where a window needs a sort for each; groups are days, of at most one value a code.
    """

    def rank(table: pa.Table) -> pa.Table:
        for x in xs:
            at, there = table.schema.get_field_index(x), table[x].is_valid().to_numpy()
            _, place, count = np.unique(table[x].to_numpy()[there], return_inverse=True, return_counts=True)
            ranks = np.zeros(len(there))
            ranks[there] = (np.cumsum(count) - (count - 1) / 2)[place] / max(there.sum(), 1)
            table = table.set_column(at, x, pa.array(ranks, mask=~there))
        return table

    rows = df.withColumns({x: F.col(x).cast("double") for x in xs})
    return rows.groupBy(by).applyInArrow(rank, rows.schema)


def quantile_bin(x: str, bins: int, *by: str, tie: str = "code") -> Column:
    """0..bins-1 by equal parts of the first-come rank: ceil((r - 1) * bins / (n - 1)) - 1."""
    w = Window.partitionBy(*by)
    r = F.row_number().over(w.orderBy(F.col(x).asc_nulls_last(), tie))
    n = F.count(x).over(w)
    return F.when(F.col(x).isNotNull(), F.greatest(F.ceil((r - 1) * bins / F.nullif(n - 1, F.lit(0))) - 1, F.lit(0)))


def neutral(df: DataFrame, x: str, *by: str) -> DataFrame:
    return df.withColumn(f"{x}_neutral", F.col(x) - F.avg(x).over(Window.partitionBy(*by)))


def eligible_z(df: DataFrame, x: str, eligible: Column, *by: str) -> DataFrame:
    """z-score of every row by mean and deviation of the eligible ones of its group."""
    w, own = Window.partitionBy(*by), F.when(eligible, F.col(x))
    return df.withColumn(f"{x}_z", (F.col(x) - F.avg(own).over(w)) / F.nullif(F.stddev_samp(own).over(w), F.lit(0.0)))


def robust_z(df: DataFrame, x: str, by: str, least: int) -> DataFrame:
    """Centred on the group's median, cut at its 1st and 99th percentile, scaled by 1.4826 MAD; small groups go."""
    stats = df.groupBy(by).agg(F.count(x).alias("_n"), F.percentile(x, F.lit(0.5)).alias("_mid"), F.percentile(x, F.lit(0.01)).alias("_lo"), F.percentile(x, F.lit(0.99)).alias("_hi")).where(F.col("_n") >= least)
    d = df.join(stats, by)
    mad = d.groupBy(by).agg(F.percentile(F.abs(F.col(x) - F.col("_mid")), F.lit(0.5)).alias("_mad"))
    cut = F.least(F.greatest(F.col(x), F.col("_lo")), F.col("_hi"))
    return d.join(mad, by).withColumn(f"{x}_robust", (cut - F.col("_mid")) / F.nullif(1.4826 * F.col("_mad"), F.lit(0.0))).drop("_n", "_mid", "_lo", "_hi", "_mad")


def terciles(x: str, *by: str) -> Column:
    """hi, mid or lo by rank inside the group."""
    r = pct_rank(x, *by)
    return F.when(r > 2 / 3, "hi").when(r <= 1 / 3, "lo").when(r.isNotNull(), "mid")


def top(df: DataFrame, n: int, order: list[Column], *by: str, rank: str = "rank") -> DataFrame:
    """The first n rows of each group in a total order, numbered from 1."""
    return df.withColumn(rank, F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col(rank) <= n)


def last_by(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row of each key, the first in ``order``; unlike dropDuplicates the choice is fixed."""
    return df.withColumn("_n", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_n = 1").drop("_n")


def huber_location(df: DataFrame, x: str, weight: str, by: str, c: float = 1.345, steps: int = 10) -> DataFrame:
    """Weighted Huber location of each group by reweighting, from the median and 1.4826 MAD of rows with a positive weight.

    Where half of a group is equal, so that the MAD is 0, the weighted median.  Groups are days, of at most one value a
    code; all days are shuffled alike and each is worked out as two columns of numbers.
    """

    def locate(key: tuple, table: pa.Table) -> pa.Table:
        v, w = table["x"].to_numpy(), table["w"].to_numpy()
        order = np.lexsort((w, v))
        v, w = v[order], w[order]
        run = np.cumsum(w)
        middle = float(np.median(v))
        s = 1.4826 * float(np.median(np.abs(v - middle)))
        if s > 0:
            m = middle
            for _ in range(steps):
                off = np.abs(v - m)
                held = w * np.where(off <= c * s, 1.0, c * s / np.maximum(off, 1e-300))
                m = float((held * v).sum() / held.sum())
        else:
            m = float(v[np.searchsorted(run, run[-1] / 2)])
        return pa.table({by: pa.array([key[0].as_py()], table.schema.field(by).type), "n": pa.array([len(v)], pa.int64()), "location": pa.array([m])})

    known = df.where(F.col(x).isNotNull() & (F.col(weight) > 0)).select(by, F.col(x).cast("double").alias("x"), F.col(weight).cast("double").alias("w"))
    return known.groupBy(by).applyInArrow(locate, f"{by} {known.schema[by].dataType.simpleString()}, n long, location double")
