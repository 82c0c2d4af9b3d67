"""Selection of features: strength and stability of their monthly rank correlation with the label, then pruning of near duplicates."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


#: Rows of a task that are packed at once.
PACKED = 100_000


def _merged(a: tuple | None, b: tuple) -> tuple:
    """Count, means and sums of products about the means of two sets of rows together."""
    if a is None or not a[0]:
        return b
    if not b[0]:
        return a
    n, step = a[0] + b[0], b[1] - a[1]
    return n, a[1] + step * (b[0] / n), a[2] + b[2] + np.outer(step, step) * (a[0] * b[0] / n)


def _rank_correlation(x: np.ndarray, y: np.ndarray, least: int) -> float | None:
    n = len(x)
    if n < least:
        return None
    _, place, count = np.unique(x, return_inverse=True, return_counts=True)
    rank = (np.cumsum(count) - (count - 1) / 2)[place]
    r, v = rank - rank.mean(), y - y.mean()
    a, b = np.sqrt(r @ r / n), np.sqrt(v @ v / n)
    return float(r @ v / n / (a * b)) if a > 0 and b > 0 else None


def summaries(rows: DataFrame, features: list[str], y: str = "y", least: int = 30) -> tuple[DataFrame, np.ndarray]:
    """(feature, month, n, ic) as ``monthly_ic`` has it, and the correlation matrix over rows that have every feature, from one pass.

    A task packs the values of a feature and month, some ten thousand rows at once, so that a shuffled row holds many of them; those
    of one feature and month meet in one group, as a window over them would need.  Of the matrix, a task sends one small row.
    """
    k = len(features)

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        moments, held, size = None, [], 0

        def chunks() -> Iterator[pa.RecordBatch]:
            table = pa.Table.from_batches(held)
            known = table.filter(pc.and_(pc.is_valid(table["y"]), pc.is_valid(table["month"])))
            month, label = known["month"].to_numpy(), known["y"].to_numpy()
            order = np.argsort(month, kind="stable")
            months, start = np.unique(month[order], return_index=True)
            out = []
            for j in range(k):
                column = known.column(j + 2)
                x, there = column.to_numpy()[order], column.is_valid().to_numpy()[order]
                for m, lo, hi in zip(months, start, [*start[1:], len(order)], strict=True):
                    own = there[lo:hi]
                    out.append((j, m, x[lo:hi][own].tobytes(), label[order[lo:hi]][own].tobytes()))
            yield pa.RecordBatch.from_arrays([pa.array([r[0] for r in out], pa.int32()), pa.array([r[1] for r in out], pa.int32()), pa.array([r[2] for r in out], pa.binary()), pa.array([r[3] for r in out], pa.binary())], names=["feature", "month", "x", "y"])

        for batch in batches:
            whole = pa.Table.from_batches([batch]).select(range(2, 2 + k)).drop_null()
            if len(whole):
                x = np.stack([c.to_numpy() for c in whole.columns], axis=1)
                centred = x - x.mean(axis=0)
                moments = _merged(moments, (float(len(x)), x.mean(axis=0), centred.T @ centred))
            held.append(batch)
            size += batch.num_rows
            if size >= PACKED:
                yield from chunks()
                held, size = [], 0
        if size:
            yield from chunks()
        if moments is not None:
            data = np.concatenate([[moments[0]], moments[1], moments[2].ravel()]).tobytes()
            yield pa.RecordBatch.from_arrays([pa.array([-1], pa.int32()), pa.array([None], pa.int32()), pa.array([data], pa.binary()), pa.array([b""], pa.binary())], names=["feature", "month", "x", "y"])

    def judge(key: tuple, table: pa.Table) -> pa.Table:
        n = ic = data = None
        if key[0].as_py() < 0:
            total = None
            for part in table["x"]:
                v = np.frombuffer(part.as_buffer())
                total = _merged(total, (v[0], v[1 : k + 1], v[k + 1 :].reshape(k, k)))
            data = total[2].tobytes()
        else:
            x, label = (np.concatenate([np.frombuffer(part.as_buffer()) for part in table[c]]) for c in "xy")
            n, ic = len(x), _rank_correlation(x, label, least)
        return pa.table({"feature": pa.array([key[0].as_py()], pa.int32()), "month": pa.array([key[1].as_py()], pa.int32()), "n": pa.array([n], pa.int64()), "ic": pa.array([ic], pa.float64()), "data": pa.array([data], pa.binary())})

    values = rows.select(F.unix_date(F.trunc("date", "month")).alias("month"), F.col(y).cast("double").alias("y"), *(F.col(f).cast("double").alias(f) for f in features))
    packed = values.mapInArrow(pack, "feature int, month int, x binary, y binary")
    got = packed.groupBy("feature", "month").applyInArrow(judge, "feature int, month int, n long, ic double, data binary").collect()
    out = next((np.frombuffer(bytes(r["data"])).reshape(k, k) for r in got if r["feature"] < 0), np.zeros((k, k)))
    scale = np.sqrt(np.maximum(np.diag(out), 1e-300))
    ics = rows.sparkSession.createDataFrame([(features[r["feature"]], r["month"], r["n"], r["ic"]) for r in got if r["feature"] >= 0 and r["n"]], "feature string, month int, n long, ic double")
    return ics.select("feature", F.date_from_unix_date("month").alias("month"), "n", F.round("ic", 12).alias("ic")), out / np.outer(scale, scale)


def monthly_ic(rows: DataFrame, features: list[str], y: str = "y", least: int = 30) -> DataFrame:
    """(feature, month, n, ic): Spearman correlation with a 0/1 label, ties by mean rank; null where there are fewer than ``least`` rows or one class.

    Ranks of a label of two values are its values, moved and stretched, so the label itself is correlated.
    """
    return summaries(rows, features, y, least)[0]


def stability(ics: DataFrame, least_months: int = 3) -> DataFrame:
    """(feature, ic, flips, months): mean over months, and the share of months whose sign differs from the mean's; months without a value, or 0, don't count."""
    d = ics.where("ic IS NOT NULL AND ic <> 0")
    mean = d.groupBy("feature").agg(F.avg("ic").alias("ic"), F.count("*").alias("months"))
    flips = d.join(mean.select("feature", F.col("ic").alias("_m")), "feature").groupBy("feature").agg(F.avg((F.signum("ic") != F.when(F.round("_m", 12) == 0, 1.0).otherwise(F.signum("_m"))).cast("double")).alias("flips"))
    enough = F.col("months") >= least_months
    return mean.join(flips, "feature").select("feature", F.when(enough, F.col("ic")).otherwise(0.0).alias("ic"), F.when(enough, F.col("flips")).otherwise(1.0).alias("flips"), "months")


def correlations(rows: DataFrame, features: list[str]) -> np.ndarray:
    """The correlation matrix over rows that have every feature."""
    return summaries(rows.withColumn("y", F.lit(None).cast("double")), features)[1]


def funnel(rows: DataFrame, features: list[str], y: str = "y", weakest: float = 0.005, flips: float = 0.4, clash: float = 0.85, least: int = 30) -> DataFrame:
    """(feature, ic, flips, status): weak, unstable, clash (with a stronger one that is kept) or kept.

    Features that are neither weak nor unstable are taken from the strongest down, ties by name; one that correlates
    beyond ``clash`` with one already kept clashes.  The loop is over the small matrix alone.
    """
    ics, matrix = summaries(rows, features, y, least)
    stats, place = {r["feature"]: r for r in stability(ics).collect()}, {f: k for k, f in enumerate(features)}
    out, kept = [], []
    for f in sorted(features, key=lambda f: (-round(abs(stats[f]["ic"]), 9) if f in stats else 0.0, f)):
        ic, flip = (stats[f]["ic"], stats[f]["flips"]) if f in stats else (0.0, 1.0)
        if abs(ic) < weakest:
            status = "weak"
        elif flip > flips:
            status = "unstable"
        elif any(abs(matrix[place[f], place[g]]) > clash for g in kept):
            status = "clash"
        else:
            status = "kept"
            kept.append(f)
        out.append((f, float(ic), float(flip), status))
    return rows.sparkSession.createDataFrame(out, "feature string, ic double, flips double, status string")
