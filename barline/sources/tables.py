"""Sources and sinks: pruned scans, shards with authority, keyed upserts, archives and lists."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window


def scan(spark: SparkSession, path: str, columns: list[str], where: Column | None = None, floats: list[str] = ()) -> DataFrame:
    """Named columns, the filter first so that it reaches the files, and a narrower type for wide tables."""
    df = spark.read.parquet(path)
    df = df.where(where) if where is not None else df
    return df.select(*(F.col(c).cast("float").alias(c) if c in floats else c for c in columns))


def merge_shards(shards: DataFrame, keys: list[str], shard: str) -> DataFrame:
    """A later shard replaces the code as a whole; then one row per key, the last shard's."""
    newest = shards.groupBy(keys[0]).agg(F.max(shard).alias("_newest"))
    kept = shards.join(newest, keys[0]).where(F.col(shard) == F.col("_newest")).drop("_newest")
    others = [c for c in shards.columns if c not in keys]
    w = Window.partitionBy(*keys).orderBy(*(F.col(c).desc_nulls_last() for c in (shard, *others)))
    return kept.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def upsert(old: DataFrame, new: DataFrame, keys: list[str], last_wins: bool = True) -> DataFrame:
    both = old.withColumn("_p", F.lit(0)).unionByName(new.withColumn("_p", F.lit(1)))
    w = Window.partitionBy(*keys).orderBy(F.col("_p").desc() if last_wins else F.col("_p").asc())
    return both.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n", "_p")


def classify(snapshot: DataFrame, last: DataFrame, tolerance: float = 0.006) -> DataFrame:
    """row, stale, new, or refetch if the previous close moved; against the last bar of each code."""
    d = snapshot.join(last.select("code", F.col("date").alias("_date"), F.col("close").alias("_close")), "code", "left")
    status = F.when(F.col("_date").isNull(), "new").when(F.col("date") <= F.col("_date"), "stale").when(F.abs(F.col("prev_close") - F.col("_close")) > tolerance, "refetch").otherwise("row")
    return d.withColumn("status", status).drop("_date", "_close")


def coverage(panel: DataFrame, share: float = 0.97, days: int = 5) -> DataFrame:
    """n of each date, and whether it reaches ``share`` of the median of the days before."""
    n = panel.groupBy("date").agg(F.count("*").alias("n"))
    mid = F.percentile("n", F.lit(0.5)).over(Window.orderBy("date").rowsBetween(-days, -1))
    return n.withColumn("usual", mid).withColumn("complete", F.coalesce(F.col("n") >= share * F.col("usual"), F.lit(True)))


def compare_sources(a: DataFrame, b: DataFrame, value: str, tolerance: float) -> DataFrame:
    """Per code: rows in both, share within a tolerance, coverage by each source."""
    x = a.select("code", "date", F.col(value).alias("_a")).join(b.select("code", "date", F.col(value).alias("_b")), ["code", "date"], "outer")
    both = F.col("_a").isNotNull() & F.col("_b").isNotNull()
    return x.groupBy("code").agg(F.count("*").alias("n"), F.sum(both.cast("long")).alias("both"), F.avg(F.when(both, (F.abs(F.col("_a") - F.col("_b")) <= tolerance).cast("double"))).alias("agree"))


def write_archive(lists: DataFrame, path: str) -> None:
    """One folder per month and date; a repeated day replaces its own folder only."""
    lists.withColumn("month", F.date_format("date", "yyyy-MM")).write.partitionBy("month", "date").option("partitionOverwriteMode", "dynamic").mode("overwrite").parquet(path)


def write_code_list(codes: DataFrame, path: str) -> None:
    """One code per line with CRLF; codes are ASCII, so every legacy encoding reads them."""
    codes.select(F.lpad(F.col("code").cast("string"), 6, "0")).write.option("lineSep", "\r\n").mode("overwrite").csv(path)


def read_last_json(spark: SparkSession, path: str, schema: str, key: str, order: str) -> DataFrame:
    """JSON lines, those that don't parse dropped, the last record of each key."""
    rows = spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path)
    w = Window.partitionBy(key).orderBy(F.col(order).desc())
    return rows.withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")


def parse_quotes(lines: DataFrame) -> DataFrame:
    """``v_<market><code>="a~b~c"`` lines to typed columns; short lines go."""
    body = F.split(F.regexp_extract("value", '="([^"]*)"', 1), "~")
    d = lines.select(F.regexp_extract("value", r"v_[a-z]+(\d+)=", 1).alias("code"), body.alias("f")).where(F.size("f") >= 5)
    return d.select("code", F.col("f")[1].alias("name"), F.expr("try_cast(f[3] AS DOUBLE)").alias("price"), F.expr("try_cast(f[4] AS DOUBLE)").alias("prev_close"))
