import datetime as dt

from barline import plans
from barline.functions import scalars
from barline.operators import crosssection, joins, learning, series, windows
from barline.sources import tables
from conftest import SF
from pyspark.sql import functions as F

DAY = dt.date(2024, 1, 1)


def bars(spark, closes, code=1):
    rows = [(code, DAY + dt.timedelta(days=k), c, c, c * 1.01, c * 0.99, 100.0) for k, c in enumerate(closes)]
    return spark.createDataFrame(rows, "code long, date date, open double, close double, high double, low double, volume double")


def test_segments_limits_and_curves(spark):
    d = spark.createDataFrame([("688001", "X", 10.0), ("300001", "X", 10.0), ("430001", "X", 9.99), ("000001", "ST Y", 10.05), ("600001", "Y", 10.05)], "code string, name string, c double")
    board = scalars.board_of(F.col("code"))
    out = d.select(board.alias("b"), scalars.limit_price(F.col("c"), scalars.limit_pct(board, F.col("name")), board).alias("p"), scalars.is_flagged(F.col("name")).alias("f"), scalars.tent(F.col("c"), 9.0, 12.0, 10.0).alias("t")).collect()
    assert [r.b for r in out] == ["star", "chinext", "bj", "main", "main"]
    assert [r.p for r in out] == [12.0, 12.0, 12.98, 10.55, 11.06] and [r.f for r in out] == [False, False, False, True, False]


def test_windows_are_null_until_full(spark):
    d = windows.alignment(bars(spark, [float(k) for k in range(10, 75)])).orderBy("date").collect()
    assert [r.aligned for r in d][:59] == [None] * 59 and d[59].aligned == 3
    run = windows.run_length(bars(spark, [1.0, 2.0, 3.0, 1.0, 2.0]), windows.gain() > 0, "up").orderBy("date").collect()
    assert [r.up for r in run] == [0, 1, 2, 0, 1]


def test_future_does_not_change_the_past(spark):
    base = [10.0 + (k * 7 % 11) for k in range(90)]
    other = base[:70] + [99.0] * 20
    cut = DAY + dt.timedelta(days=69)
    for op in (windows.returns, windows.range_position, windows.trend, windows.extremes, windows.tails, windows.previous_day):
        a, b = (op(bars(spark, x).withColumn("amount", F.col("volume") * F.col("close"))).where(F.col("date") <= cut) for x in (base, other))
        assert a.exceptAll(b).count() == 0


def test_as_of_takes_the_later_period_on_ties(spark):
    panel = bars(spark, [1.0] * 5)
    events = spark.createDataFrame([(1, DAY + dt.timedelta(days=2), 1, "a"), (1, DAY + dt.timedelta(days=2), 2, "b"), (2, DAY, 9, "z")], "code long, at date, period int, v string")
    loose = [r.v for r in joins.as_of(panel, events, "at", ["v"], "period").orderBy("date").collect()]
    strict = [r.v for r in joins.as_of(panel, events, "at", ["v"], "period", strict=True).orderBy("date").collect()]
    assert loose == [None, None, "b", "b", "b"] and strict == [None, None, None, "b", "b"]


def test_ranks_share_ties_and_skip_nulls(spark):
    d = spark.createDataFrame([(1, 1.0), (1, 1.0), (1, None), (1, 3.0)], "g int, x double")
    assert sorted(r.k for r in d.select(crosssection.pct_rank("x", "g").alias("k")).collect() if r.k) == [0.5, 0.5, 1.0]


def test_newey_west_and_adjustment(spark):
    d = spark.createDataFrame([("s", DAY + dt.timedelta(days=k), float(k % 5)) for k in range(100)] + [("short", DAY, 1.0)], "series string, date date, d double")
    out = {r.series: r for r in series.newey_west(d).collect()}
    assert out["short"].t is None and abs(out["s"].mean - 2) < 1e-9
    p = series.adjusted(spark.createDataFrame([("a", 0.01), ("b", 0.04), ("c", 0.03)], "name string, p double")).collect()
    assert {r.name: (round(r.holm, 6), round(r.bh, 6)) for r in p} == {"a": (0.03, 0.03), "b": (0.06, 0.04), "c": (0.06, 0.04)}


def test_bootstrap_repeats_and_brackets_the_mean(spark):
    d = spark.createDataFrame([("s", DAY + dt.timedelta(days=k), float(k % 7) - 2) for k in range(200)], "series string, date date, d double")
    a, b = (series.block_bootstrap(d, 200).first() for _ in range(2))
    assert a == b and a.low < a.mean < a.high and a.p < 0.05


def test_sampling_keeps_all_positives(spark):
    d = spark.createDataFrame([(k, DAY, "m", int(k < 3)) for k in range(100)], "code long, date date, month string, y int")
    n = {r.y: r["count"] for r in learning.stratified(d).groupBy("y").count().collect()}
    assert n == {1: 3, 0: 36}


def test_sources_and_sinks(spark, tmp_path):
    (tmp_path / "l.json").write_text('{"k": "a", "t": 1}\nnot json\n{"k": "a", "t": 3}\n')
    assert [r.t for r in tables.read_last_json(spark, str(tmp_path / "l.json"), "k string, t int", "k", "t").where("k IS NOT NULL").collect()] == [3]
    quotes = spark.createDataFrame([('v_sh600000="1~NAME~x~10.5~10.4~z";',), ("junk",), ('v_sz000001="1~B~x~bad~9";',)], "value string")
    assert [(r.code, r.price, r.prev_close) for r in tables.parse_quotes(quotes).collect()] == [("600000", 10.5, 10.4), ("000001", None, 9.0)]
    lists = bars(spark, [1.0, 2.0])
    tables.write_archive(lists, str(tmp_path / "a"))
    tables.write_archive(lists.where(F.col("date") > DAY).withColumn("close", F.lit(5.0)), str(tmp_path / "a"))
    assert sorted(r.close for r in spark.read.parquet(str(tmp_path / "a")).collect()) == [1.0, 5.0]
    tables.write_code_list(lists.select("code").distinct(), str(tmp_path / "c"))
    assert b"".join(p.read_bytes() for p in (tmp_path / "c").glob("part*")) == b"000001\r\n"
    old, new = lists, lists.withColumn("close", F.lit(7.0))
    assert {r.close for r in tables.upsert(old, new, ["code", "date"]).collect()} == {7.0}
    assert {r.close for r in tables.upsert(old, new, ["code", "date"], last_wins=False).collect()} == {1.0, 2.0}


def test_filter_and_columns_reach_the_scan(spark):
    df = tables.scan(spark, f"{SF}/lineitem.parquet", ["l_orderkey", "l_tax"], F.col("l_quantity") > 40, ["l_tax"])
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(l_quantity,40.0)" in plan and "l_comment" not in plan and dict(df.dtypes)["l_tax"] == "float"


def test_a_close_at_its_average_is_not_above_it(spark):
    """Sums of doubles put the average of equal closes above or below them by chance."""
    import datetime as dt

    from barline.operators import windows

    rows = [(k, dt.date(2020, 1, 1) + dt.timedelta(days=i), (1001 + k) / 100) for k in range(40) for i in range(70)]
    out = windows.above_average(spark.createDataFrame(rows, "code int, date date, close double"))
    assert {r.days_above for r in out.where("date >= '2020-03-01'").collect()} == {0}


def test_ranks_of_several_columns_share_a_sort(spark):
    """Ties, nulls and a day of nulls alone rank as one column at a time does; days are sorted once for all columns."""
    rows = [(i, i % 3, None if i % 7 == 0 or i % 3 == 2 else float(i * 5 % 11), float(i % 4), -0.0 if i % 2 else 0.0) for i in range(60)]
    df = spark.createDataFrame(rows, "code int, date int, a double, b double, c double")
    got = crosssection.pct_ranks(df, ["a", "b", "c"], "date")
    want = df.select("code", "date", *(crosssection.pct_rank(x, "date").alias(x) for x in "abc"))
    as_rows = lambda d: sorted((r.code, r.date, *(None if r[x] is None else round(r[x], 12) for x in "abc")) for r in d.collect())
    assert as_rows(got) == as_rows(want)
    for name in ("b22_reweighted_score", "f12_weighted_rank_rules"):
        plan = plans.QUERIES[name](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
        assert "windowspecdefinition(date" not in plan, name
