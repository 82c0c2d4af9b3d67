"""Connected components of an edge table, by alternating star contractions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barline.llm.shared import materialise


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


def components(edges: DataFrame) -> DataFrame:
    """(id, component_id) for every id in ``edges`` (a, b); component_id is the smallest id reachable.

    Rows with a = b name an id without links.  Each turn is written to the shared folder;
    a star with very many leaves is split by Spark's skew join like any other hot key.
    """
    alone = edges.where(F.col("a") == F.col("b")).select(F.col("a").alias("id"))
    now = materialise(edges.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    state = _state(now)
    while state[0]:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.where(F.col("b") > F.col("a")).join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).where(F.col("a") != F.col("b")).distinct()
        small = large.groupBy("a").agg(F.min("b").alias("m"))
        linked = large.join(small, "a").where(F.col("b") != F.col("m")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        now = materialise(linked.unionByName(small.select("a", F.col("m").alias("b"))).distinct(), "edges")
        before, state = state, _state(now)
        if state == before:
            break
    stars = now.select(F.col("a").alias("id"), F.col("b").alias("component_id"))
    roots = now.select(F.col("b").alias("id"), F.col("b").alias("component_id"))
    lone = alone.select("id", F.col("id").alias("component_id"))
    return stars.unionByName(roots).unionByName(lone).groupBy("id").agg(F.min("component_id").alias("component_id"))
