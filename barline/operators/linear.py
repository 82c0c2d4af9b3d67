"""Logistic models of many months at once: sparse (L1), ridge (L2), and with coefficients held at 0 or above.

All months are fitted together by proximal Newton steps.  A pass over the training table sums loss,
gradient and curvature by model inside tasks; the sums, a small matrix a model, meet in a shuffle of bounded
size, and the driver solves each model's quadratic problem by coordinate descent.  Rows never leave their tasks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass
class Models:
    """Coefficients by model, the last one the intercept, for features standardised by their training rows; null counts as 0."""

    names: list[str]
    mean: np.ndarray
    scale: np.ndarray
    beta: np.ndarray
    #: What is left of the optimality conditions, as a share of the rows' weight.
    violation: np.ndarray
    passes: int

    def design(self, model: np.ndarray, x: np.ndarray) -> np.ndarray:
        z = (np.nan_to_num(x, nan=0.0) - self.mean[model]) / self.scale[model]
        return np.concatenate([z, np.ones((len(z), 1))], axis=1)

    def predict(self, model: np.ndarray, x: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-(self.design(model, x) * self.beta[model]).sum(1)))


def _columns(batch: pa.RecordBatch, names: list[str]) -> np.ndarray:
    return np.stack([batch.column(n).cast(pa.float64()).fill_null(float("nan")).to_numpy(zero_copy_only=False) for n in names], axis=1)


def _solve(g: np.ndarray, h: np.ndarray, beta: np.ndarray, l1: float, l2: float, free: np.ndarray) -> np.ndarray:
    """The step of the quadratic model with its penalties, by coordinate descent; the last coordinate has none."""
    k, d = len(beta), np.zeros(len(beta))
    h = h + np.diag([2 * l2] * (k - 1) + [0.0]) + np.eye(k) * 1e-9 * np.trace(h)
    g = g + np.append(2 * l2 * beta[:-1], 0)
    for _ in range(500):
        before = d.copy()
        for j in range(k):
            slope = g[j] + h[j] @ d - h[j, j] * d[j]
            at = beta[j] - slope / h[j, j]
            if j < k - 1:
                cut = l1 / h[j, j]
                at = np.sign(at) * max(abs(at) - cut, 0.0) if free[j] else max(at - cut, 0.0)
            d[j] = at - beta[j]
        if np.abs(d - before).max() < 1e-12:
            break
    return d


def _violation(g: np.ndarray, beta: np.ndarray, l1: float, l2: float, free: np.ndarray) -> float:
    """The largest breach of the optimality conditions."""
    out = abs(g[-1])
    for j, b in enumerate(beta[:-1]):
        s = g[j] + 2 * l2 * b
        if b != 0:
            out = max(out, abs(s + l1 * np.sign(b)))
        else:
            out = max(out, abs(s) - l1 if free[j] else -s - l1)
    return out


def fit(table: DataFrame, names: list[str], models: int, l1: float = 0.0, l2: float = 0.0, at_least_zero: tuple[str, ...] = (), tolerance: float = 1e-9, most: int = 40) -> Models:
    """Models of a table of (model, y, w, features): the sum of w times the loss, l1 times the coefficients and l2 times their squares is least.

    ``table`` is read once a pass and should be a written one, best in runs of a model; weights are scaled to mean 1 by
    model.  A model that is done costs a pass no more than the reading of its rows.
    """
    k = len(names)
    stats = {r[0]: r for r in table.groupBy("model").agg(F.avg("w"), *(F.avg(F.coalesce(F.col(n), F.lit(0.0))) for n in names), *(F.stddev_pop(F.coalesce(F.col(n), F.lit(0.0))) for n in names), F.avg("y"), F.count("*")).collect()}
    pick = lambda f, default: np.array([f(stats[m]) if m in stats else default for m in range(models)])
    share = np.clip(pick(lambda r: r[2 * k + 2], 0.5), 1e-4, 0.9999)
    rows, weight = pick(lambda r: r[2 * k + 3], 1.0), pick(lambda r: r[1], 1.0)
    fitted = Models(names, pick(lambda r: r[2 : k + 2], [0.0] * k).astype(float), pick(lambda r: r[k + 2 : 2 * k + 2], [1.0] * k).astype(float) + 1e-9, np.zeros((models, k + 1)), np.full(models, np.inf), 0)
    fitted.beta[:, -1] = np.log(share / (1 - share))
    free = np.array([n not in at_least_zero for n in names])
    size = 1 + (k + 1) + (k + 1) ** 2

    def sums(left: np.ndarray) -> np.ndarray:
        """Loss, gradient and curvature of the models that are ``left``."""

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros((models, size))
            for batch in batches:
                model = batch.column("model").to_numpy(zero_copy_only=False).astype(np.int64)
                own = left[model]
                if not own.all():
                    batch, model = batch.filter(pa.array(own)), model[own]
                if not len(model):
                    continue
                if (np.diff(model) < 0).any():
                    order = np.argsort(model, kind="stable")
                    batch, model = batch.take(pa.array(order)), model[order]
                y, w = (batch.column(c).cast(pa.float64()).to_numpy(zero_copy_only=False) for c in ("y", "w"))
                z = fitted.design(model, _columns(batch, names))
                w = w / weight[model]
                s = (z * fitted.beta[model]).sum(1)
                p = 1 / (1 + np.exp(-s))
                loss, slope, bend = w * (np.logaddexp(0, s) - y * s), w * (p - y), w * p * (1 - p)
                cuts = (np.flatnonzero(np.diff(model)) + 1).tolist()
                for top, end in zip([0, *cuts], [*cuts, len(model)], strict=True):
                    m, own = int(model[top]), slice(top, end)
                    total[m] += np.concatenate([[loss[own].sum()], z[own].T @ slope[own], ((z[own].T * bend[own]) @ z[own]).ravel()])
            m, at = np.nonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(m), pa.array(at), pa.array(total[m, at])], names=["m", "at", "x"])

        out = np.zeros((models, size))
        for m, at, x in table.select("model", "y", "w", *names).mapInArrow(run, "m long, at long, x double").groupBy("m", "at").agg(F.sum("x")).collect():
            out[m, at] = x
        return out

    penalty = lambda b: l1 * np.abs(b[:-1]).sum() + l2 * (b[:-1] ** 2).sum()
    held, step, reached = fitted.beta.copy(), np.zeros_like(fitted.beta), np.full(models, np.inf)
    part, left = np.ones(models), np.array([m in stats for m in range(models)])
    fitted.violation[~left] = 0.0
    for turn in range(most):
        now, fitted.passes = sums(left), turn + 1
        for m in np.flatnonzero(left).tolist():
            worth = now[m, 0] + penalty(fitted.beta[m])
            if worth > reached[m] + 1e-9 * abs(reached[m]) and part[m] > 1e-4:  # too far: half the step
                part[m] /= 2
                fitted.beta[m] = held[m] + part[m] * step[m]
                continue
            g, h = now[m, 1 : k + 2], now[m, k + 2 :].reshape(k + 1, k + 1)
            fitted.violation[m] = _violation(g, fitted.beta[m], l1, l2, free) / max(rows[m], 1.0)
            if fitted.violation[m] <= tolerance:
                left[m] = False
                continue
            held[m], reached[m], part[m] = fitted.beta[m].copy(), worth, 1.0
            step[m] = _solve(g, h, fitted.beta[m], l1, l2, free)
            fitted.beta[m] = held[m] + step[m]
        if not left.any():
            break
    return fitted


def scored(rows: DataFrame, predict, names: list[str], column: str = "p") -> DataFrame:
    """Adds ``column`` by any ``predict(model numbers, features)`` to rows of (model, features); features that are null arrive as NaN.

    Whatever the model is, only its ``predict`` travels to the tasks, and a batch of rows is one call.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            p = predict(batch.column("model").to_numpy(zero_copy_only=False).astype(np.int64), _columns(batch, names))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.asarray(p, np.float64))], names=[*batch.schema.names, column])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInArrow(run, f"{schema}, `{column}` double")


def coefficients(models: Models, months: list, spark) -> DataFrame:
    """month, name, value for every coefficient, the intercept's name is null."""
    rows = [(months[m], n, float(b)) for m in range(len(months)) for n, b in zip([*models.names, None], models.beta[m], strict=True)]
    return spark.createDataFrame(rows, "month date, name string, value double")
