"""Panels that the queries run on, derived from the star-schema tables.

``panel``: daily bars by code with segment, sector, shares, turnover and amount.
``disclosures``: one quarterly report per code with period, notice date and holder count.
``notices``: dated announcements by code with a class.
``ticks``: prices by user and time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Days in SQL that both engines read alike; prices are whole cents.
BARS = """
x AS (SELECT l_suppkey AS code, CAST(l_shipdate AS DATE) AS date, SUM(CAST(ROUND(l_discount * 100) AS BIGINT)) AS d,
             COUNT(*) AS n, SUM(CAST(ROUND(l_tax * 100) AS BIGINT)) AS t, SUM(l_quantity) AS volume FROM {lineitem} GROUP BY 1, 2),
y AS (SELECT code, date, volume, t, n, CAST(ROUND((CAST(d AS DOUBLE) / n - 5) * 1000) AS BIGINT) AS r,
             SUM(CAST(ROUND((CAST(d AS DOUBLE) / n - 5) * 1000) AS BIGINT)) OVER (PARTITION BY code ORDER BY date) AS s FROM x),
z AS (SELECT code, date, volume, t, n, CAST(ROUND(10000 * EXP((s - r) / CAST(100000 AS DOUBLE)) * (1 + CAST(0.002 AS DOUBLE) * (CAST(t AS DOUBLE) / n - 4))) AS BIGINT) AS oc,
             CAST(ROUND(10000 * EXP(s / CAST(100000 AS DOUBLE))) AS BIGINT) AS cc FROM y),
bars AS (SELECT code, date, CAST(oc AS DOUBLE) / 100 AS open, CAST(cc AS DOUBLE) / 100 AS close, volume,
             CAST(GREATEST(oc, cc) + CAST(FLOOR(CAST(GREATEST(oc, cc) * t AS DOUBLE) / (400 * n)) AS BIGINT) AS DOUBLE) / 100 AS high,
             CAST(LEAST(oc, cc) - CAST(FLOOR(CAST(LEAST(oc, cc) * t AS DOUBLE) / (400 * n)) AS BIGINT) AS DOUBLE) / 100 AS low FROM z),
codes AS (SELECT s_suppkey AS code, r_name AS board, n_name AS sector, 1000000 + 1000 * s_suppkey AS shares
          FROM {supplier} JOIN {nation} ON s_nationkey = n_nationkey JOIN {region} ON n_regionkey = r_regionkey),
panel AS (SELECT bars.*, board, sector, shares, LEAST(volume * 400 / shares, CAST(0.6 AS DOUBLE)) AS turnover, volume * close AS amount
          FROM bars JOIN codes ON bars.code = codes.code)
"""

DISCLOSURES = """
disclosures AS (
  SELECT o_custkey % (SELECT COUNT(*) FROM {supplier}) + 1 AS code, CAST(date_trunc('quarter', o_orderdate) AS DATE) AS period,
         COUNT(*) AS holders, 15 + MIN(o_orderkey) % 101 AS lag_days FROM {orders} GROUP BY 1, 2)
"""

NOTICES = """
notices AS (
  SELECT o_orderkey AS notice_id, o_custkey % (SELECT COUNT(*) FROM {supplier}) + 1 AS code, CAST(o_orderdate AS DATE) AS date, o_orderpriority AS kind, o_totalprice AS size FROM {orders})
"""

#: Rows of lineitem that a task takes, so that its memory stays the same however many there are.
ROWS = 250_000
TABLES = "lineitem supplier nation region orders customer part events".split()


def duck(*parts: str) -> str:
    """The derivation as a WITH clause over tables by their own names."""
    return "WITH " + ",".join(p.format(**{t: t for t in TABLES}) for p in parts)


def _run(spark: SparkSession, sf_dir: str, parts: tuple[str, ...], select: str) -> DataFrame:
    text = "WITH " + ",".join(parts) + f" SELECT {select}"
    used = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in TABLES if "{" + t + "}" in text}
    if "lineitem" in used and "FROM panel" in text:
        # A code's rows are dealt once, for the sums of its days and the windows over them alike.
        used["lineitem"] = dealt(used["lineitem"].select("l_suppkey", "l_shipdate", "l_discount", "l_tax", "l_quantity"), "l_suppkey")
    return spark.sql(text, **used)


def dealt(rows: DataFrame, *by: str, table: DataFrame | None = None) -> DataFrame:
    """Rows of a table in parts by key: as many as shuffles have, or more, so that a part has some ``ROWS`` of them.

    Rows that are derived name the read ``table`` they come from, whose count costs no work.
    """
    n = (rows if table is None else table).count()
    return rows.repartition(max(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-n // ROWS)), *by)


def panel(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run(spark, sf_dir, (BARS,), "* FROM panel")


def codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run(spark, sf_dir, (BARS,), "* FROM codes")


def disclosures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """code, period, notice, holders; notice is the period's start and 15 to 115 days."""
    return _run(spark, sf_dir, (DISCLOSURES,), "* FROM disclosures").select("code", "period", F.date_add("period", F.col("lag_days").cast("int")).alias("notice"), "holders")


def notices(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run(spark, sf_dir, (NOTICES,), "* FROM notices")


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """code, ts, price, side (1 bought, -1 sold, 0 neither) and size."""
    side = F.when(F.col("event_type") == "purchase", 1).when(F.col("event_type") == "error", -1).otherwise(0)
    return spark.read.parquet(f"{sf_dir}/events.parquet").select(F.col("user_id").alias("code"), "ts", (100 + F.col("value") / 10).alias("price"), side.alias("side"), "value", "event_type", "event_id")


DUCK_DISCLOSURES = DISCLOSURES + ", reports AS (SELECT code, period, CAST(period + CAST(lag_days AS INTEGER) AS DATE) AS notice, holders FROM disclosures)"
DUCK_TICKS = """
ticks AS (SELECT user_id AS code, ts, 100 + value / 10 AS price, CASE event_type WHEN 'purchase' THEN 1 WHEN 'error' THEN -1 ELSE 0 END AS side, value, event_type, event_id FROM events)
"""
