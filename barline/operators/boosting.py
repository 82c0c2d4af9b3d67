"""Histogram gradient boosting of many monthly models at once.

A model a month is fitted on the rows whose labels closed before it.  All models grow together:
a pass over the training table sums gradients and curvatures by (model, node, feature, bin)
inside tasks, the sums meet in a shuffle of bounded size, and the driver picks the splits, so a
level of a tree is one pass whatever the number of models.  Tables hold bins, a byte each;
only trees and histograms, both bounded by the parameters, pass through the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from barline.operators.windows import by_code
from barline.sources.roundtrips import written

#: Rows draw a number below this prime by their code and day.
DRAWS = 1_000_003


@dataclass(frozen=True)
class Boosting:
    """Parameters; a tree sees the rows and features whose draw falls into its shares."""

    trees: int = 8
    depth: int = 3
    bins: int = 16
    rate: float = 0.3
    l2: float = 5.0
    least: float = 1.0
    rows: int = 8
    columns: int = 7
    per_positive: int = 4
    months_back: int = 36
    gap: int = 20
    #: Another seed lets trees see other rows and features.
    seed: int = 0
    #: Trees after which the training table is written anew with its margins.
    refresh: int = 25

    def sees(self, tree: int, feature: int) -> bool:
        return (feature * 5 + (tree + self.seed) * 3) % 10 < self.columns

    def step(self, tree: int) -> int:
        return 2 * (tree + 50 * self.seed) + 3


def draw(code: str = "code", date: str = "date") -> Column:
    """A number below ``DRAWS`` that any engine gets alike."""
    return (F.col(code) * 7919 + F.datediff(F.col(date), F.lit("1970-01-01").cast("date")).cast("long") * 104_729) % DRAWS


def binned(df: DataFrame, features: list[str], bins: int, keep: list[str] | None = None) -> DataFrame:
    """Adds a bin for each feature by its rank within the day; a row without the feature has the bin ``bins``.

    ``keep`` names the columns that stay besides the bins, all if it is left out.  A day's rows meet once for all features, as a group of as many rows as there are codes.
    """

    keep = df.columns if keep is None else keep

    def run(whole: pa.Table) -> pa.Table:
        day = whole.select(keep)
        for k, f in enumerate(features):
            x = whole.column(f).combine_chunks()
            known, own = x.is_valid().to_numpy(zero_copy_only=False), x.drop_null().to_numpy(zero_copy_only=False)
            place = np.full(len(day), bins, np.int8)
            place[known] = np.searchsorted(np.sort(own), own) * bins // max(len(own), 1)
            day = day.append_column(f"b{k}", pa.array(place))
        return day

    schema = ", ".join([*(f"`{f}` {df.schema[f].dataType.simpleString()}" for f in keep), *(f"b{k} byte" for k in range(len(features)))])
    return df.groupBy("date").applyInArrow(run, schema)


def closing(rows: DataFrame, p: Boosting) -> DataFrame:
    """Adds ``_closed``, the day on which a row's label is known."""
    return rows.withColumn("_closed", F.lead("date", p.gap).over(by_code()))


def slices(rows: DataFrame, months: list, p: Boosting, y: str = "y", keep: list[str] | None = None) -> DataFrame:
    """Training rows by model: label closed before the month, ``months_back`` months at most, all positives and a share of the negatives.

    The share of a month's negatives is the one that leaves ``per_positive`` for a positive; a row is in it by its
    draw, so no month is sorted.  Weights give every month of a slice the same.  ``keep`` names the columns that
    stay, the bins if it is left out.  The rows are read three times; written ones of ``closing`` aren't worked out anew.
    """
    d = (rows if "_closed" in rows.columns else closing(rows, p)).where(F.col(y).isNotNull() & F.col("_closed").isNotNull())
    d = d.withColumn("_month", F.trunc("date", "month")).withColumn("u", draw())
    share = d.groupBy("_month").agg(F.sum(y).alias("_pos"), F.sum(1 - F.col(y)).alias("_neg"))
    d = d.join(F.broadcast(share), "_month").where((F.col(y) == 1) | (F.col("u") * F.col("_neg") < p.per_positive * F.col("_pos") * DRAWS))  # a row per month
    models = F.array(*(F.struct(F.lit(k).alias("model"), F.lit(m).cast("date").alias("month")) for k, m in enumerate(months)))
    own = F.filter(models, lambda m: (F.col("_closed") < m["month"]) & (F.add_months(m["month"], -p.months_back) <= F.col("date")))
    d = d.select("*", F.explode(own).alias("_m")).withColumn("model", F.col("_m.model"))
    size = d.groupBy("model", "_month").agg(F.count("*").alias("_n"))
    of_model = Window.partitionBy("model")
    size = size.withColumn("w", F.sum("_n").over(of_model) / F.count("*").over(of_model) / F.col("_n")).drop("_n")
    keep = [c for c in d.columns if c[0] == "b" and c[1:].isdigit()] if keep is None else keep
    return d.join(F.broadcast(size), ["model", "_month"]).select("model", F.col(y).cast("byte").alias("y"), "w", F.col("u").cast("int").alias("u"), *keep)  # a row per model and month


@dataclass
class Forest:
    """Splits and values of the trees of every model, by heap number of the node; a feature of -1 is a leaf."""

    base: np.ndarray
    feature: list[np.ndarray] = field(default_factory=list)
    cut: list[np.ndarray] = field(default_factory=list)
    value: list[np.ndarray] = field(default_factory=list)
    sums: list[np.ndarray] = field(default_factory=list)

    def nodes(self, tree: int, model: np.ndarray, x: np.ndarray, levels: int) -> np.ndarray:
        node = np.ones(len(model), np.int64)
        rows = np.arange(len(model))
        for _ in range(levels):
            f = self.feature[tree][model, node]
            node = np.where(f >= 0, 2 * node + (x[rows, np.maximum(f, 0)] > self.cut[tree][model, node]), node)
        return node

    def margin(self, model: np.ndarray, x: np.ndarray, depth: int, first: int = 0) -> np.ndarray:
        """Sum of the values of the trees from ``first`` on, and of the base for the first."""
        out = self.base[model].copy() if first == 0 else np.zeros(len(model))
        for t in range(first, len(self.value)):
            out += self.value[t][model, self.nodes(t, model, x, depth)]
        return out


def _arrays(batch: pa.RecordBatch, bins: list[str]) -> tuple[np.ndarray, np.ndarray]:
    return batch.column("model").to_numpy(zero_copy_only=False).astype(np.int64), np.stack([batch.column(b).to_numpy(zero_copy_only=False) for b in bins], axis=1)


#: Columns of a packed table and the type of their numbers; x has a row's bins, margin a number for each learner and row.
PACKED = {"model": "<i4", "y": "<i1", "w": "<f8", "u": "<i4", "x": "<i1", "margin": "<f8"}


def packed(table: DataFrame) -> DataFrame:
    """The written table of blocks of rows, each column's numbers as bytes: handing a row's cells over costs more than summing them."""
    bins = [c for c in table.columns if c[0] == "b" and c[1:].isdigit()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            model, x = _arrays(batch, bins)
            own = {"model": model, "x": x} | {c: batch.column(c).to_numpy(zero_copy_only=False) for c in ("y", "w", "u")}
            yield pa.RecordBatch.from_pydict({c: pa.array([None if c == "margin" else own[c].astype(of).tobytes()], pa.binary()) for c, of in PACKED.items()})

    return written(table.mapInArrow(run, ", ".join(f"{c} binary" for c in PACKED)), "packed")


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, np.ndarray | None]]:
    """The blocks of batches of a packed table, a row of x for each row; without margins None stands for them."""
    for batch in batches:
        for i in range(batch.num_rows):
            block = {c: None if (v := batch.column(c)[i].as_py()) is None else np.frombuffer(v, of) for c, of in PACKED.items()}
            block["model"] = block["model"].astype(np.int64)
            block["x"] = block["x"].reshape(len(block["model"]), -1)
            if block["margin"] is not None:
                block["margin"] = block["margin"].reshape(-1, len(block["model"]))
            yield block


def fit(table: DataFrame, models: int, p: Boosting) -> Forest:
    """The trees of all models from a table of (model, y, w, u, b0, b1, ...)."""
    return fit_arms(table, models, [p])[0]


def fit_arms(table: DataFrame, models: int, arms: list[Boosting]) -> list[Forest]:
    """The trees of all models of each of several learners, which share bins and ``refresh``, from a table of (model, y, w, u, b0, b1, ...).

    The table is read once and packed; the packed one is read once a level for all learners together.
    """
    n_f, n_b = sum(c[0] == "b" and c[1:].isdigit() for c in table.columns), arms[0].bins + 1
    start = {r[0]: r[1] for r in table.groupBy("model").agg(F.sum(F.col("w") * F.col("y")) / F.sum("w")).collect()}
    share = np.clip([start.get(m, 0.5) for m in range(models)], 1e-6, 1 - 1e-6)
    forests = [Forest(np.round(np.log(share / (1 - share)), 9)) for _ in arms]
    blocks, first = packed(table), 0

    def histogram(tree: int, level: int, first: int, live: list[int]) -> np.ndarray:
        """Sums of gradient, curvature and rows by live learner, model, node of the level, feature and bin."""
        size = (models << level) * n_f * n_b

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = np.zeros((len(live), size, 3))
            for block in _blocks(batches):
                for at, k in enumerate(live):
                    p, forest = arms[k], forests[k]
                    seen = block["u"].astype(np.int64) * p.step(tree) % DRAWS % 10 < p.rows
                    model, x, y, w = (block[c][seen] for c in ("model", "x", "y", "w"))
                    margin = forest.margin(model, x, p.depth, first) + (block["margin"][k, seen] if first else 0)
                    node = forest.nodes(tree, model, x, level) - (1 << level)
                    open_ = node >= 0
                    q = 1 / (1 + np.exp(-margin[open_]))
                    g, h = w[open_] * (q - y[open_]), w[open_] * q * (1 - q)
                    cell = (((model[open_] << level | node[open_])[:, None] * n_f + np.arange(n_f)) * n_b + x[open_]).ravel()
                    total[at] += np.stack([*(np.bincount(cell, np.repeat(v, n_f), size) for v in (g, h)), np.bincount(cell, minlength=size)], axis=1)
            total = total.reshape(-1, 3)
            if len(at := np.flatnonzero(total[:, 2])):
                yield pa.RecordBatch.from_arrays([pa.array(at), *(pa.array(total[at, k]) for k in range(3))], names=["cell", "g", "h", "n"])

        out = np.zeros((len(live) * size, 3))
        for r in blocks.mapInArrow(run, "cell long, g double, h double, n double").groupBy("cell").agg(F.sum("g"), F.sum("h"), F.sum("n")).collect():
            out[r[0]] = r[1], r[2], r[3]
        return out.reshape(len(live), models, 1 << level, n_f, n_b, 3)

    last = max(p.trees for p in arms)
    for tree in range(last):
        growing = [k for k, p in enumerate(arms) if tree < p.trees]
        sums = {}
        for k in growing:
            width = 2 << arms[k].depth
            forests[k].feature.append(np.full((models, width), -1))
            forests[k].cut.append(np.zeros((models, width), np.int64))
            sums[k] = np.zeros((models, width, 3))
        # A tree's values join its forest when it is grown.
        live = growing
        for level in range(max(arms[k].depth for k in growing)):
            live = [k for k in live if level < arms[k].depth]
            if not live:
                break
            for k, cells in zip(live, histogram(tree, level, first, live), strict=True):
                _split(cells, forests[k], tree, level, sums[k], arms[k])
            live = [k for k in live if (forests[k].feature[tree][:, 1 << level : 2 << level] >= 0).any()]
        for k in growing:
            grown, value = sums[k][..., 2] > 0, np.zeros(sums[k].shape[:2])
            value[grown] = -arms[k].rate * sums[k][grown][:, 0] / (sums[k][grown][:, 1] + arms[k].l2)
            forests[k].value.append(value)
            forests[k].sums.append(sums[k])
        if (tree + 1) % arms[0].refresh == 0 and tree + 1 < last:
            blocks, first = _with_margins(blocks, forests, arms, first), tree + 1
    return forests


def _split(cells: np.ndarray, forest: Forest, tree: int, level: int, sums: np.ndarray, p: Boosting) -> None:
    """Writes the best split of each node of a level, ties by feature and bin, and the sums of the nodes it makes."""
    whole = cells[:, :, 0].sum(2)  # model, node, sum
    left = cells.cumsum(3)
    right = whole[:, :, None, None] - left
    worth = lambda s: s[..., 0] ** 2 / (s[..., 1] + p.l2)
    gain = worth(left) + worth(right) - worth(whole)[:, :, None, None]
    fits = (left[..., 1] >= p.least) & (right[..., 1] >= p.least) & np.array([p.sees(tree, f) for f in range(cells.shape[2])])[:, None]
    gain = np.where(fits, np.round(gain, 7), 0.0)
    best = gain.reshape(*gain.shape[:2], -1).argmax(2)
    for m in range(cells.shape[0]):
        for k in range(cells.shape[1]):
            node = (1 << level) + k
            if whole[m, k, 2] > 0:
                sums[m, node] = whole[m, k]
            f, b = divmod(int(best[m, k]), cells.shape[3])
            if gain[m, k, f, b] > 0:
                forest.feature[tree][m, node], forest.cut[tree][m, node] = f, b
                sums[m, 2 * node], sums[m, 2 * node + 1] = left[m, k, f, b], right[m, k, f, b]


def _with_margins(blocks: DataFrame, forests: list[Forest], arms: list[Boosting], first: int) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            margins = []
            for block in _blocks([batch]):
                own = np.stack([f.margin(block["model"], block["x"], p.depth, first) for f, p in zip(forests, arms, strict=True)])
                margins.append((own + block["margin"] if first else own).tobytes())
            yield batch.set_column(batch.schema.get_field_index("margin"), "margin", pa.array(margins, pa.binary()))

    return written(blocks.mapInArrow(run, blocks.schema), "margins")


def score(rows: DataFrame, forest: Forest, p: Boosting) -> DataFrame:
    """Adds ``margin`` to rows of (model, b0, b1, ...)."""
    return score_arms(rows, [forest], [p])


def score_arms(rows: DataFrame, forests: list[Forest], arms: list[Boosting]) -> DataFrame:
    """Adds ``margin``, the mean of those of several learners, to rows of (model, b0, b1, ...)."""
    bins = [c for c in rows.columns if c[0] == "b" and c[1:].isdigit()]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            model, x = _arrays(batch, bins)
            margin = sum(np.round(f.margin(model, x, p.depth), 9) for f, p in zip(forests, arms, strict=True)) / len(arms)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(margin)], names=[*batch.schema.names, "margin"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema)
    return rows.mapInArrow(run, f"{schema}, margin double")


def nodes(forest: Forest, months: list, spark) -> DataFrame:
    """A row per node of every tree: its split, its sums, and its value where it is a leaf."""
    out = []
    for t in range(len(forest.value)):
        for m, k in zip(*np.nonzero(forest.sums[t][..., 2]), strict=True):
            f, (g, h, n) = int(forest.feature[t][m, k]), forest.sums[t][m, k].tolist()
            out.append((months[m], t, int(k), f, int(forest.cut[t][m, k]) if f >= 0 else -1, int(n), g, h, float(forest.value[t][m, k]) if f < 0 else 0.0))
    return spark.createDataFrame(out, "month date, tree int, node int, feature int, cut int, n long, g double, h double, value double")


def of_months(rows: DataFrame, months: list) -> DataFrame:
    """The rows of ``months``, with month and the number of its model."""
    number = F.create_map(*(F.lit(x) for k, m in enumerate(months) for x in (str(m), k)))
    return rows.withColumn("month", F.trunc("date", "month")).withColumn("model", number[F.col("month").cast("string")]).where("model IS NOT NULL")


def prepared(rows: DataFrame, features: list[str], p: Boosting) -> DataFrame:
    """The written table of (code, date, y, _closed, b0, b1, ...) that learners of the same bins and gap share."""
    keep = ["code", "date", "y", "_closed"]
    return written(binned(closing(rows, p).select(*keep, *features), features, p.bins, keep), "binned")


def walk_forward(rows: DataFrame, features: list[str], months: list, p: Boosting = Boosting(), y: str = "y") -> tuple[DataFrame, Forest, DataFrame]:
    """Scored rows of ``months`` (with model and margin), the forest, and the training table, from rows of (code, date, y, features)."""
    return walk(prepared(rows.withColumnRenamed(y, "y"), features, p), months, p)


def walk(ready: DataFrame, months: list, p: Boosting | list[Boosting] = Boosting()) -> tuple[DataFrame, Forest | list[Forest], DataFrame | list[DataFrame]]:
    """``walk_forward`` on a table of ``prepared``; of several learners the mean margin, and lists of forests and of training tables.

    Learners of the same slices share their training table and grow in the same passes, and all score in one.
    """
    bins = [c for c in ready.columns if c[0] == "b" and c[1:].isdigit()]
    arms = p if isinstance(p, list) else [p]
    shared, tables, forests = {}, [None] * len(arms), [None] * len(arms)
    for k, arm in enumerate(arms):
        shared.setdefault((arm.per_positive, arm.months_back, arm.refresh), []).append(k)
    for own in shared.values():
        table = written(slices(ready, months, arms[own[0]]), "training")
        for k, forest in zip(own, fit_arms(table, len(months), [arms[k] for k in own]), strict=True):
            tables[k], forests[k] = table, forest
    tested = of_months(ready, months).select("code", "date", "month", "y", "model", *bins)
    scored = score_arms(tested, forests, arms)
    return (scored, forests, tables) if isinstance(p, list) else (scored, forests[0], tables[0])
