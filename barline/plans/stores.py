"""Queries of sources and sinks: tables written and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from barline.operators import crosssection as cs
from barline.plans.helpers import rounded, rounded_sql
from barline.plans.panels import PICKS, RET, picks
from barline.plans.rows import query as _query
from barline.sources import panels, roundtrips, tables
from barline.sources.panels import BARS, NOTICES, panel

QUERIES: dict = {}
ORACLE_SQL: dict = {}


def query(name: str, sql: str, *parts: str):
    def register(function):
        from barline.plans import rows

        _query(name, sql, *parts)(function)
        QUERIES[name], ORACLE_SQL[name] = rows.QUERIES.pop(name), rows.ORACLE_SQL.pop(name)
        return function

    return register


@query("a01_pruned_scan", " SELECT kind, COUNT(*) AS n, MIN(code) AS least FROM notices GROUP BY kind", NOTICES)
def a01(s, d):
    orders = tables.scan(s, f"{d}/orders.parquet", ["o_orderkey", "o_custkey", "o_orderpriority"])
    codes = s.read.parquet(f"{d}/supplier.parquet").agg(F.count("*").alias("n"))
    rows = orders.crossJoin(F.broadcast(codes)).select(F.col("o_orderpriority").alias("kind"), (F.col("o_custkey") % F.col("n") + 1).alias("code"))
    return rows.groupBy("kind").agg(F.count("*").alias("n"), F.min("code").alias("least"))


@query("a02_filtered_scan", " SELECT l_suppkey AS code, COUNT(*) AS n FROM lineitem WHERE l_quantity >= 30 AND l_shipdate < TIMESTAMP '1997-01-01' GROUP BY 1", NOTICES)
def a02(s, d):
    where = (F.col("l_quantity") >= 30) & (F.col("l_shipdate") < F.lit("1997-01-01").cast("timestamp"))
    return tables.scan(s, f"{d}/lineitem.parquet", ["l_suppkey"], where).groupBy(F.col("l_suppkey").alias("code")).agg(F.count("*").alias("n"))


LISTED = RET + PICKS + ", l AS (SELECT date, code, rank FROM k WHERE rank <= 3 AND date >= DATE '2001-06-01')"


def listed(s, d):
    return picks(s, d, 3).where("date >= DATE'2001-06-01'").select("date", "code", "rank")


@query("a03_archive_glob", LISTED + " SELECT date, code, rank FROM l")
def a03(s, d):
    return roundtrips.archive(listed(s, d)).select("date", "code", "rank")


@query("a04_narrow_types", " SELECT l_suppkey AS code, COUNT(*) AS n, CAST(SUM(CAST(CAST(l_quantity AS FLOAT) AS DOUBLE)) AS DOUBLE) AS quantity FROM lineitem WHERE l_shipdate >= TIMESTAMP '1997-01-01' GROUP BY 1", NOTICES)
def a04(s, d):
    where = F.col("l_shipdate") >= F.lit("1997-01-01").cast("timestamp")
    rows = tables.scan(s, f"{d}/lineitem.parquet", ["l_suppkey", "l_quantity"], where, ["l_quantity"])
    return rows.groupBy(F.col("l_suppkey").alias("code")).agg(F.count("*").alias("n"), F.sum(F.col("l_quantity").cast("double")).alias("quantity"))


@query("a05_tolerant_json_lines", " SELECT code, MAX(notice_id) AS notice_id FROM notices GROUP BY code", NOTICES)
def a05(s, d):
    return roundtrips.json_lines_with_noise(panels.notices(s, d).select("code", "notice_id"), "code", "notice_id")


@query("a06_nested_json", " SELECT date, code, kind, COUNT(*) AS n, MIN(notice_id) AS first FROM notices GROUP BY 1, 2, 3", NOTICES)
def a06(s, d):
    return roundtrips.json_documents(panels.notices(s, d)).groupBy("date", "code", "kind").agg(F.count("*").alias("n"), F.min("notice_id").alias("first"))


@query("a07_quote_lines", ", l AS (SELECT code, arg_max(sector, date) AS name, arg_max(close, date) AS price, arg_max(open, date) AS prev_close FROM panel GROUP BY code)" + rounded_sql({"price": "price", "prev_close": "prev_close"}, "l", "lpad(CAST(code AS VARCHAR), 6, '0') AS code, name"))
def a07(s, d):
    last = cs.top(panel(s, d), 1, [F.col("date").desc()], "code")
    return rounded(roundtrips.quote_lines(last), ["price", "prev_close"], ("code", "name"))


@query("a08_csv_dimension", " SELECT code, board, sector, shares FROM codes")
def a08(s, d):
    return roundtrips.csv_dimension(panels.codes(s, d)).select("code", "board", "sector", "shares")


@query("a09_flattened_pools", ", q AS (SELECT props, event_type AS pool, CAST(ts AS DATE) AS date, user_id AS code FROM events) SELECT pool, date, code, COUNT(*) AS n, CAST(SUM(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS BIGINT) AS k FROM q GROUP BY 1, 2, 3", NOTICES)
def a09(s, d):
    e = s.read.parquet(f"{d}/events.parquet").select(F.col("event_type").alias("pool"), F.to_date("ts").alias("date"), F.col("user_id").alias("code"), F.from_json("props", "k long").alias("p"))
    return e.groupBy("pool", "date", "code").agg(F.count("*").alias("n"), F.sum("p.k").alias("k"))


@query("a13_reconciliation", ", e AS (SELECT DISTINCT code FROM panel), m AS (SELECT MAX(date) - 30 AS day FROM panel), a AS (SELECT DISTINCT code FROM panel, m WHERE date >= day) SELECT (SELECT COUNT(*) FROM e) AS expected, COUNT(*) AS lost, COUNT(*) > GREATEST(5, 0.01 * (SELECT COUNT(*) FROM e)) AS alarm FROM e WHERE code NOT IN (SELECT code FROM a)")
def a13(s, d):
    p = panel(s, d).select("code", "date")
    expected = p.select("code").distinct()
    recent = p.crossJoin(F.broadcast(p.agg(F.date_sub(F.max("date"), 30).alias("day")))).where("date >= day").select("code").distinct()
    lost = expected.join(recent, "code", "left_anti").agg(F.count("*").alias("lost"))
    out = expected.agg(F.count("*").alias("expected")).crossJoin(lost)
    return out.select("expected", "lost", (F.col("lost") > F.greatest(F.lit(5.0), 0.01 * F.col("expected"))).alias("alarm"))


@query("a15_compaction", " SELECT YEAR(date) AS year, COUNT(*) AS n, COUNT(*) AS kept FROM notices GROUP BY 1", NOTICES)
def a15(s, d):
    many, few = roundtrips.compacted(panels.notices(s, d).withColumn("year", F.year("date")), "year", ["code", "date"])
    count = lambda t, name: t.groupBy("year").agg(F.count("*").alias(name))
    return count(many, "n").join(count(few, "kept"), "year")


@query("a18_first_wins", " SELECT code, COUNT(*) AS n, SUM(CASE WHEN volume < 30 THEN volume ELSE volume + 1 END) AS volume FROM panel WHERE volume < 30 OR volume > 20 GROUP BY code")
def a18(s, d):
    p = panel(s, d).select("code", "date", "volume")
    new = p.where("volume > 20").withColumn("volume", F.col("volume") + 1)
    return tables.upsert(p.where("volume < 30"), new, ["code", "date"], last_wins=False).groupBy("code").agg(F.count("*").alias("n"), F.sum("volume").alias("volume"))


@query("a19_json_list", LISTED + " SELECT date, code, rank FROM l")
def a19(s, d):
    return roundtrips.json_records(listed(s, d).withColumn("_secret", F.lit(1)), ("_secret",))


@query("a20_dated_archive", LISTED + " SELECT strftime(date, '%Y-%m') AS month, COUNT(*) AS n, COUNT(DISTINCT date) AS days FROM l GROUP BY 1")
def a20(s, d):
    return roundtrips.archive(listed(s, d)).groupBy(F.date_format("date", "yyyy-MM").alias("month")).agg(F.count("*").alias("n"), F.countDistinct("date").alias("days"))


@query("a21_code_lines", " SELECT lpad(CAST(code AS VARCHAR), 6, '0') AS code6 FROM codes", BARS)
def a21(s, d):
    return roundtrips.code_list(panels.codes(s, d).select("code"))
