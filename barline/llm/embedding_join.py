"""Near-duplicate embeddings: an exact metric range join.

Vectors of one label are compared on the unit sphere, where cosine >= t is a distance
of at most r = sqrt(2 - 2t).  Equal vectors are one class.  Pivots partition each label: a
vector's home is the nearest pivot.  Two vectors within r whose homes i < j differ meet in
cell i, because the later one is replicated to every cell i that it can't be shown to be
further than r away from: its distance to the plane between the pivots
(d(y,i)^2 - d(y,j)^2) / 2 d(i,j) is at most r, and by the triangle inequality d(y,i) is at
most r plus the cell's radius.  Cells join independently; a large cell is cut into tiles of
two blocks.  A tile returns link counts and the links of a spanning forest, never its pairs.

Pivots come from a bounded sample of all classes, so a label has them in proportion to its
size; one of under 1 / PIVOTS of all vectors has none and is a single cell.  A label gets
as many pivots as leave a vector in at most ``CELLS`` cells on average, measured on the rest of
the sample: many where vectors lie in clusters, few where all are about equally far apart.

Cosines are taken in double precision from the column's own type.  Vectors that are null,
zero, or hold null or non-finite components, and null labels, link with nothing; vectors of
different lengths don't either.  Repeated rows are vectors of their own, linked with each
other; a null vec_id stays null and names no component unless it is alone.  Equal vectors are
told by 128 bits of hash.  Other columns are not read; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barline.llm.components import components
from barline.llm.shared import groups, local_roots, materialise, tiles

#: Vectors of a block, sampled classes, classes of a label that has pivots, and cells of a vector on average.
BLOCK, PIVOTS, WORTH, CELLS = 2048, 4096, 100, 3.0


def _unit(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Vectors of length 1, in double precision."""
    if isinstance(column, pa.ChunkedArray):
        column = pa.concat_arrays(column.chunks)
    x = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)
    x = x / np.abs(x).max(1)[:, None]  # squares of very large or small components stay finite
    return x / np.sqrt((x * x).sum(1))[:, None]


def _to_cells(x: np.ndarray, p: np.ndarray, r: float, reach: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which cells each vector goes to, its home, and its distance from it."""
    d = np.sqrt(np.maximum(0, 2 - 2 * x @ p.T))
    home = d.argmin(1)
    own = d[np.arange(len(x)), home]
    apart = np.sqrt(np.maximum(0, 2 - 2 * p @ p.T))[home]
    with np.errstate(divide="ignore", invalid="ignore"):
        plane = np.where(apart > 1e-9, (d * d - (own * own)[:, None]) / (2 * apart), 0)
    to = (np.arange(len(p)) < home[:, None]) & (plane <= r + 1e-9)
    if reach is not None:
        to &= d <= reach + r + 1e-9
    to[np.arange(len(x)), home] = True
    return to, home, own


def choose_pivots(sample: np.ndarray, r: float, classes: float) -> np.ndarray | None:
    """The most pivots, up to the root of the label's classes, that leave vectors in few cells."""
    best, k = None, 2
    while classes >= WORTH and k <= min(len(sample) // 4, math.sqrt(classes)):
        if _to_cells(sample[k:], sample[:k], r)[0].sum(1).mean() <= CELLS:
            best = sample[:k]
        k *= 2
    return best


def embedding_links(vectors: DataFrame, threshold: float = 0.93) -> DataFrame:
    """vec_id, n_links, component_id, kept for every row of (vec_id, embedding, label)."""
    r = math.sqrt(2 - 2 * threshold)
    kind = vectors.schema["embedding"].dataType.simpleString()
    kind = kind if kind in ("array<float>", "array<double>") else "array<double>"
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast(kind).alias("embedding"), F.col("label").cast("string").alias("label"))
    sound = F.col("label").isNotNull() & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("embedding", lambda x: x != 0)
    rows = rows.withColumn("ok", F.coalesce(sound, F.lit(False)))
    hashes = [F.when(F.col("ok"), F.xxhash64(F.lit(k), "label", "embedding")).alias(name) for k, name in ((1, "id"), (2, "id2"))]
    rows = rows.select("*", *hashes)
    classes = materialise(rows.where("ok").groupBy("id", "id2").agg(F.min("vec_id").alias("rep"), F.count("*").alias("n"), F.first("label").alias("label"), F.first("embedding").alias("embedding")), "classes")
    n_classes = classes.count()
    sample = classes.orderBy("id").limit(PIVOTS).select("label", "embedding").collect()
    pivots: dict[tuple[str, int], np.ndarray] = {}
    for label, dim in {(p["label"], len(p["embedding"])) for p in sample}:
        x = [p["embedding"] for p in sample if p["label"] == label and len(p["embedding"]) == dim]
        chosen = choose_pivots(_unit(pa.array(x, pa.list_(pa.float64()))), r, n_classes * len(x) / len(sample))
        if chosen is not None:
            pivots[label, dim] = chosen

    schema = f"label string, cell int, dim int, home int, id long, n long, embedding {kind}"

    def deal(batches: Iterator[pa.RecordBatch], radius: dict[tuple[str, int, int], float] | None) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = np.array([len(e) for e in batch.column("embedding")])
            labels = np.array(batch.column("label").to_pylist(), object)
            for label, dim in {*zip(labels.tolist(), dims.tolist(), strict=True)}:
                at = np.flatnonzero((labels == label) & (dims == dim))
                part = batch.take(pa.array(at))
                p = pivots.get((label, dim))
                if p is None:
                    to, home, own = np.ones((len(at), 1), bool), np.zeros(len(at), int), np.zeros(len(at))
                else:
                    reach = None if radius is None else np.array([radius.get((label, dim, i), 0.0) for i in range(len(p))])
                    to, home, own = _to_cells(_unit(part.column("embedding")), p, r, reach)
                if radius is None:
                    best = np.zeros(to.shape[1])
                    np.maximum.at(best, home, own)
                    yield pa.RecordBatch.from_arrays([pa.array([label] * len(best)), pa.array([dim] * len(best), pa.int32()), pa.array(range(len(best)), pa.int32()), pa.array(best)], names=["label", "dim", "cell", "radius"])
                    continue
                row, cell = np.nonzero(to)
                sent = part.take(pa.array(row))
                yield pa.RecordBatch.from_arrays(
                    [sent.column("label"), pa.array(cell, pa.int32()), pa.array(np.full(len(row), dim), pa.int32()), pa.array(home[row], pa.int32()), sent.column("id"), sent.column("n"), sent.column("embedding")],
                    names=["label", "cell", "dim", "home", "id", "n", "embedding"],
                )

    found = classes.mapInArrow(lambda b: deal(b, None), "label string, dim int, cell int, radius double").groupBy("label", "dim", "cell").agg(F.max("radius").alias("radius"))
    radius = {(x["label"], x["dim"], x["cell"]): x["radius"] for x in found.where(F.col("label").isin(sorted({a for a, _ in pivots}))).collect()} if pivots else {}  # one row per pivot
    cell = ["label", "dim", "cell"]
    dealt = materialise(classes.mapInArrow(lambda b: deal(b, radius), schema), "cells")
    placed = tiles(dealt, cell, dealt.groupBy(*cell).agg(F.count("*").alias("n")), BLOCK, "id")
    keys = [*cell, "tile_a", "tile_b"]

    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (_, _, here, a, b), table in groups(batches, keys):
            home, block, ids, n = (table.column(c).to_numpy() for c in ("home", "block", "id", "n"))
            x = _unit(table.column("embedding"))
            left, right = np.flatnonzero(block == a), np.flatnonzero(block == b)
            links, li, ri = np.zeros(len(ids), np.int64), [], []
            for at in range(0, len(left), 512):
                some = left[at : at + 512]
                near = x[some] @ x[right].T >= threshold
                near &= (home[some] == here)[:, None] | (home[right] == here)
                if a == b:
                    near &= some[:, None] < right
                i, j = np.nonzero(near)
                np.add.at(links, some[i], n[right[j]])
                np.add.at(links, right[j], n[some[i]])
                li.append(some[i])
                ri.append(right[j])
            hit = np.flatnonzero(links)
            if len(hit):
                root = local_roots(len(ids), np.concatenate(li), np.concatenate(ri), ids)
                yield pa.RecordBatch.from_pydict({"id": ids[hit], "links": links[hit], "root": root[hit]})

    partial = materialise(placed.repartition(*keys).sortWithinPartitions(*keys).mapInArrow(join, "id long, links long, root long"), "links")
    links = partial.groupBy("id").agg(F.sum("links").alias("links"))
    member = components(partial.select(F.col("id").alias("a"), F.col("root").alias("b")))
    own = classes.select("id", "id2", "rep", "n")
    linked = own.join(member, "id").join(links, "id")
    named = linked.join(linked.groupBy("component_id").agg(F.min("rep").alias("least")), "component_id").select("id", "links", "least")
    known = own.join(named, "id", "left").select("id", "id2", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links"), F.coalesce("least", "rep").alias("component_id"))
    # Vectors stay where they are: only ids and hashes meet the classes.
    out = rows.select("vec_id", "id", "id2").join(known, ["id", "id2"], "left")
    component = F.coalesce("component_id", "vec_id")
    return out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), component.alias("component_id"), F.col("vec_id").eqNullSafe(component).alias("kept"))
