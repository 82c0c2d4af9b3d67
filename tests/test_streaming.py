import datetime as dt

from barline import streaming
from barline.operators import intraday

SCHEMA = "code long, ts timestamp, price double, side int, value double, event_type string, event_id long"
T0 = dt.datetime(2024, 1, 1, 9, 30)


def ticks(spark, rows):
    return spark.createDataFrame([(c, T0 + dt.timedelta(seconds=s), p, 1, 2.0, "view", k) for k, (c, s, p) in enumerate(rows)], SCHEMA)


def run(spark, frame, tmp_path, name, mode="complete"):
    q = frame.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", str(tmp_path / name)).trigger(availableNow=True).start()
    q.awaitTermination(120)
    return spark.table(name)


def test_minute_stream_equals_batch(spark, tmp_path):
    batch = ticks(spark, [(1, 0, 10.0), (1, 20, 12.0), (1, 59, 11.0), (1, 61, 9.0), (2, 5, 1.0)])
    batch.write.parquet(str(tmp_path / "in"))
    out = run(spark, streaming.minute_stream(streaming.tick_stream(spark, str(tmp_path / "in"), SCHEMA)), tmp_path, "minutes")
    assert out.exceptAll(intraday.minute_bars(batch)).count() == 0 and out.count() == 3


def test_sessions_and_sliding_counts(spark, tmp_path):
    ticks(spark, [(1, 0, 1.0), (1, 600, 1.0), (1, 7200, 1.0)]).write.parquet(str(tmp_path / "in"))
    stream = lambda: streaming.tick_stream(spark, str(tmp_path / "in"), SCHEMA)
    assert sorted(r.n for r in run(spark, streaming.sessions(stream()), tmp_path, "sess").collect()) == [1, 2]
    assert sum(r.n for r in run(spark, streaming.sliding_counts(stream(), "event_type"), tmp_path, "slide").collect()) == 12


def test_upsert_is_idempotent(spark, tmp_path):
    put = streaming.upsert_into(str(tmp_path / "t"), ["code"], ["ts"])
    put(ticks(spark, [(1, 0, 1.0), (2, 0, 2.0)]), 0)
    for _ in range(2):
        put(ticks(spark, [(1, 5, 9.0)]), 1)
    rows = spark.read.parquet(str(tmp_path / "t" / "v000000001")).collect()
    assert {r.code: r.price for r in rows} == {1: 9.0, 2: 2.0}
