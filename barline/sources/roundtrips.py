"""Tables that are written to the session's shared folder and read back through a source."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barline.sources import tables


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder that driver and executors share; a local session that names none gets a temporary one."""
    at = spark.conf.get("spark.checkpoint.dir", None)
    if not at:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        at = tempfile.mkdtemp(prefix="spark-")
        spark.conf.set("spark.checkpoint.dir", at)
    return f"{at.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, *by: str) -> DataFrame:
    """``df`` as a written table: its lineage is cut, and lost executors cost no more than a reread."""
    path = scratch(df.sparkSession, name)
    df.write.partitionBy(*by).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def archive(lists: DataFrame) -> DataFrame:
    """A day's list per folder, read back by a glob over months; the date comes from the folder's name."""
    path = scratch(lists.sparkSession, "archive")
    tables.write_archive(lists, path)
    back = lists.sparkSession.read.parquet(f"{path}/month=*/date=*")
    return back.withColumn("date", F.regexp_extract(F.col("_metadata.file_path"), r"date=(\d{4}-\d{2}-\d{2})", 1).cast("date"))


def json_documents(events: DataFrame) -> DataFrame:
    """One compressed JSON document per date with arrays of codes, read back and exploded to a row per event and code."""
    spark, path = events.sparkSession, scratch(events.sparkSession, "documents")
    items = F.collect_list(F.struct("notice_id", F.array("code").alias("codes"), "kind"))
    events.groupBy(F.col("date").cast("string").alias("day")).agg(items.alias("ann")).write.option("compression", "gzip").json(path)
    schema = "day string, ann array<struct<notice_id:bigint,codes:array<bigint>,kind:string>>"
    back = spark.read.schema(schema).json(path).select("day", F.explode("ann").alias("a"))
    return back.select(F.col("day").cast("date").alias("date"), "a.notice_id", F.explode("a.codes").alias("code"), "a.kind")


def json_records(lists: DataFrame, private: tuple[str, ...] = ()) -> DataFrame:
    """A ranked list as JSON records without its private columns, read back."""
    path = scratch(lists.sparkSession, "records")
    public = lists.drop(*private)
    public.write.json(path)
    return lists.sparkSession.read.schema(public.schema).json(path)


def csv_dimension(dimension: DataFrame) -> DataFrame:
    """A dimension as delimited text with a header, read back by its schema."""
    path = scratch(dimension.sparkSession, "dimension")
    dimension.write.option("header", True).csv(path)
    return dimension.sparkSession.read.schema(dimension.schema).option("header", True).csv(path)


def quote_lines(panel: DataFrame) -> DataFrame:
    """Vendor lines of quotes as text, parsed back."""
    path = scratch(panel.sparkSession, "quotes")
    line = F.concat(F.lit("v_sh"), F.lpad(F.col("code").cast("string"), 6, "0"), F.lit('="1~'), "sector", F.lit("~"), F.lpad(F.col("code").cast("string"), 6, "0"), F.lit("~"), F.col("close").cast("string"), F.lit("~"), F.col("open").cast("string"), F.lit('~x"'))
    panel.select(line.alias("value")).write.text(path)
    return tables.parse_quotes(panel.sparkSession.read.text(path))


def code_list(codes: DataFrame) -> DataFrame:
    """A list of codes as lines, read back."""
    path = scratch(codes.sparkSession, "codes")
    tables.write_code_list(codes, path)
    return codes.sparkSession.read.option("lineSep", "\r\n").text(path).select(F.col("value").alias("code6"))


def json_lines_with_noise(rows: DataFrame, key: str, order: str) -> DataFrame:
    """JSON lines among lines that don't parse; the last record of each key comes back."""
    path = scratch(rows.sparkSession, "lines")
    noisy = rows.select(F.to_json(F.struct(*rows.columns)).alias("value")).unionByName(rows.select(F.lit("{broken").alias("value")))
    noisy.write.text(path)
    return tables.read_last_json(rows.sparkSession, path, rows.schema.simpleString()[7:-1].replace(":", " "), key, order)


def compacted(shards: DataFrame, shard: str, by: list[str]) -> tuple[DataFrame, DataFrame]:
    """Shards as many folders, and the same rows rewritten in order as few files; both read back."""
    spark, path = shards.sparkSession, scratch(shards.sparkSession, "shards")
    shards.write.partitionBy(shard).parquet(path + "/many")
    many = spark.read.parquet(path + "/many")
    many.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), *by).sortWithinPartitions(*by).write.parquet(path + "/few")
    return many, spark.read.parquet(path + "/few")
