"""Isotonic calibration of scores by month, pooled in parallel over ranges of scores."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from barline.sources.roundtrips import written


def pooled(low: np.ndarray, high: np.ndarray, total: np.ndarray, weight: np.ndarray) -> list[np.ndarray]:
    """Neighbouring blocks pooled until means ascend; blocks come in order of score.

    Pooling is the same whether it begins with single scores or with blocks that were pooled before, so parts of
    the scores can be pooled apart and then together.
    """
    stack: list[list[float]] = []
    for block in zip(low.tolist(), high.tolist(), total.tolist(), weight.tolist(), strict=True):
        stack.append(list(block))
        while len(stack) > 1 and stack[-2][2] * stack[-1][3] >= stack[-1][2] * stack[-2][3]:
            _, top, s, n = stack.pop()
            stack[-1][1] = top
            stack[-1][2] += s
            stack[-1][3] += n
    return [np.array(c) for c in zip(*stack, strict=True)] if stack else [np.zeros(0)] * 4


def isotonic(rows: DataFrame, by: str, score: str, y: str) -> DataFrame:
    """(by, low, high, value): the ascending step function of each group that is nearest to ``y`` in squares.

    Rows are summed by score first.  Scores are dealt to tasks by range, each task pools its own, and a group's
    blocks, far fewer than its scores, are pooled once more.
    """
    sums = rows.where(F.col(score).isNotNull() & F.col(y).isNotNull()).groupBy(by, score).agg(F.sum(F.col(y).cast("double")).alias("total"), F.count("*").cast("double").alias("weight"))
    kind = rows.schema[by].dataType.simpleString()
    schema = f"{by} {kind}, low double, high double, total double, weight double"

    def inside(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Runs of one group in a batch are pooled; the rows of a task come in order."""
        for batch in batches:
            d = batch.to_pandas()
            for key, g in d.groupby(by, sort=False):
                s = g[score].to_numpy(float)
                low, high, total, weight = pooled(s, s, g["total"].to_numpy(), g["weight"].to_numpy())
                yield pa.RecordBatch.from_pandas(pd.DataFrame({by: [key] * len(low), "low": low, "high": high, "total": total, "weight": weight}), preserve_index=False)

    def across(d: pd.DataFrame) -> pd.DataFrame:
        d = d.sort_values("low")
        low, high, total, weight = pooled(*(d[c].to_numpy() for c in ("low", "high", "total", "weight")))
        return pd.DataFrame({by: [d[by].iloc[0]] * len(low), "low": low, "high": high, "value": total / weight, "weight": weight})

    parts = sums.repartitionByRange(by, score).sortWithinPartitions(by, score).mapInArrow(inside, schema)
    return parts.groupBy(by).applyInPandas(across, f"{by} {kind}, low double, high double, value double, weight double")


def calibrated(rows: DataFrame, steps: DataFrame, by: str, score: str) -> DataFrame:
    """Adds ``p``: the value of the step that holds the score, on the line between two steps, or of the first or last step outside; null without steps."""
    points = steps.select(by, F.explode(F.array(F.struct(F.col("low").alias("x"), F.col("value").alias("v")), F.struct(F.col("high").alias("x"), F.col("value").alias("v")))).alias("s")).select(by, F.col("s.x").alias("_x"), F.col("s.v").alias("_v")).distinct()
    asked = rows.select(by, F.col(score).cast("double").alias("_x")).distinct()
    both = asked.withColumn("_v", F.lit(None).cast("double")).unionByName(points.select(by, "_x", "_v"))
    point = F.when(F.col("_v").isNotNull(), F.struct("_x", "_v"))
    w = Window.partitionBy(by).orderBy("_x")
    before = F.last(point, True).over(w.rangeBetween(Window.unboundedPreceding, 0))
    after = F.first(point, True).over(w.rangeBetween(0, Window.unboundedFollowing))
    d = both.select(by, "_x", "_v", before.alias("_a"), after.alias("_b")).where("_v IS NULL")
    share = (F.col("_x") - F.col("_a._x")) / (F.col("_b._x") - F.col("_a._x"))
    line = F.when(F.col("_b._x") > F.col("_a._x"), F.col("_a._v") + share * (F.col("_b._v") - F.col("_a._v"))).otherwise(F.col("_a._v"))
    p = F.when(F.col("_a").isNull(), F.col("_b._v")).when(F.col("_b").isNull(), F.col("_a._v")).otherwise(line)
    found = d.select(F.col(by).alias("_by"), "_x", p.alias("p"))
    return rows.join(found, (F.col(by) == F.col("_by")) & (F.col(score).cast("double") == F.col("_x")), "left").drop("_by", "_x")


def monthly(rows: DataFrame, score: str, y: str, months_back: int = 12, least_months: int = 6, gap: int = 20) -> tuple[DataFrame, DataFrame]:
    """Rows with ``p`` and ``month``, and the steps by month: each month is calibrated by the ``months_back`` months before it, by rows whose label had closed.

    A month with fewer than ``least_months`` months of such rows has no calibration.
    """
    from barline.operators.windows import by_code

    d = rows.withColumn("_closed", F.lead("date", gap).over(by_code())).withColumn("_own", F.trunc("date", "month"))
    d = d.select("*", F.col("_own").alias("month"))
    closed = d.where(F.col("_closed").isNotNull() & F.col(y).isNotNull() & F.col(score).isNotNull())
    after = F.expr("sequence(add_months(trunc(_closed, 'month'), 1), add_months(_own, %d), interval 1 month)" % months_back)
    able = closed.where(F.add_months(F.trunc("_closed", "month"), 1) <= F.add_months("_own", months_back))
    train = able.select(F.explode(after).alias("month"), "_own", F.col(score), F.col(y))
    good = train.groupBy("month").agg(F.count_distinct("_own").alias("_n")).where(F.col("_n") >= least_months).select("month")
    steps = written(isotonic(train.join(F.broadcast(good), "month"), "month", score, y), "steps")  # a row a month
    return calibrated(d.drop("_closed", "_own"), steps, "month", score), steps
