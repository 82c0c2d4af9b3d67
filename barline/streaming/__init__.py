"""Structured Streaming versions of the incremental operators."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barline.operators.intraday import minute_bars


def tick_stream(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    return spark.readStream.schema(schema).parquet(folder)


def minute_stream(ticks: DataFrame, late: str = "10 minutes") -> DataFrame:
    """Tumbling minute bars with a watermark; later ticks are dropped."""
    return minute_bars(ticks.withWatermark("ts", late))


def sliding_counts(events: DataFrame, key: str, size: str = "1 hour", slide: str = "15 minutes", late: str = "10 minutes") -> DataFrame:
    g = events.withWatermark("ts", late).groupBy(F.window("ts", size, slide).alias("w"), key).agg(F.count("*").alias("n"), F.approx_count_distinct("code").alias("codes"))
    return g.select(F.col("w.start").alias("start"), key, "n", "codes")


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "10 minutes") -> DataFrame:
    g = events.withWatermark("ts", late).groupBy("code", F.session_window("ts", gap).alias("w")).agg(F.count("*").alias("n"))
    return g.select("code", F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n")


def enriched(quotes: DataFrame, static: DataFrame, on: str = "code") -> DataFrame:
    """Stream-static join; codes without a static row stay."""
    return quotes.join(static, on, "left")


def late_counts(ticks: DataFrame, key: str, seconds: int) -> DataFrame:
    """Rows by key, and how many of them came after a newer one by more than ``seconds``; ``event_id`` is the order of arrival.

    The newest stamp before each row comes from blocks of arrivals: inside a block by a
    window, before it from the blocks' own newest stamps, a row each.
    """
    from pyspark.sql.window import Window

    block = (F.col("event_id") / 100_000).cast("long")
    t = ticks.withColumn("_b", block)
    inside = F.max("at").over(Window.partitionBy("_b").orderBy("event_id").rowsBetween(Window.unboundedPreceding, -1))
    newest = t.groupBy("_b").agg(F.max("at").alias("m"))
    before = newest.select("_b", F.max("m").over(Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)).alias("_m"))
    seen = t.withColumn("_i", inside).join(before, "_b").withColumn("_seen", F.greatest("_i", "_m"))
    return seen.groupBy(key).agg(F.count("*").alias("n"), F.count_if(F.col("at") < F.col("_seen") - seconds * 1_000_000).alias("late"))


def upsert_into(path: str, keys: list[str], order: list[str]):
    """A foreachBatch function: the last row of each key wins over the table at ``path``.

    A replayed batch gives the same table.  Each turn writes a new version beside the old
    one and then names it in ``path/_current``, so readers see a whole table.
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        from pyspark.sql.window import Window

        spark = batch.sparkSession
        try:
            versions = spark.read.schema("version string").json(f"{path}/_current")
        except AnalysisException:  # nothing is written there yet, whatever the batch's number
            versions = None
        # A replayed batch builds on the version before its own.
        latest = versions.where(F.col("version") < f"v{batch_id:09d}").agg(F.max("version")).first()[0] if versions is not None else None
        both = batch.withColumn("_new", F.lit(1))
        if latest:
            both = both.unionByName(spark.read.parquet(f"{path}/{latest}").withColumn("_new", F.lit(0)))
        w = Window.partitionBy(*keys).orderBy(F.col("_new").desc(), *(F.col(c).desc() for c in order))
        name = f"v{batch_id:09d}"
        both.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n", "_new").write.mode("overwrite").parquet(f"{path}/{name}")
        spark.createDataFrame([(name,)], "version string").write.mode("append").json(f"{path}/_current")

    return apply
