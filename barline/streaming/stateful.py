"""Operators that carry a code's state from one micro-batch to the next.

State lives in the query's checkpoint, so a restarted query goes on where it stopped; every output equals the one of
the batch operator over all rows so far.
"""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from barline.operators.costbasis import COLUMNS, Holdings
from barline.sources.roundtrips import scratch, written

STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def state_store(spark: SparkSession):
    """The store that states of any type need, for the queries started inside; the session's own one comes back."""
    before = spark.conf.get(STORE, None)
    spark.conf.set(STORE, ROCKS)
    try:
        yield
    finally:
        spark.conf.unset(STORE) if before is None else spark.conf.set(STORE, before)


class _Carried(StatefulProcessor):
    """Holdings and run of market days of one code."""

    def __init__(self, cells: int):
        self.cells = cells

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.held = handle.getValueState("held", "data binary, last date, day long, run long")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802
        bars = pd.concat(list(rows))
        data, last, day, run = self.held.get() if self.held.exists() else (None, None, None, 0)
        if last is not None:  # what came already, or too late, is left out
            bars = bars[bars["date"] > last]
        bars = bars[(bars[["high", "low", "close"]] > 0).all(axis=1)].sort_values("date").drop_duplicates("date", keep="last")
        if not len(bars):
            return
        holdings = Holdings(self.cells) if data is None else Holdings.unpacked(self.cells, bytes(data))
        out = pd.DataFrame(holdings.advance(*(bars[c].to_numpy() for c in ("high", "low", "close", "turnover"))), columns=COLUMNS)
        runs = []
        for n in bars["day"].tolist():
            run = run + 1 if day is not None and n == day + 1 else 1
            day = n
            runs.append(run)
        out.insert(0, "code", key[0])
        out.insert(1, "date", bars["date"].to_numpy())
        out["run"] = runs
        self.held.update((holdings.packed(), bars["date"].iloc[-1], int(day), int(run)))
        yield out

    def close(self) -> None:
        pass


def carried(bars: DataFrame, cells: int = 360) -> DataFrame:
    """Cost basis and run of consecutive market days of each bar (code, date, day, high, low, close, turnover), from the code's state.

    Bars of a code must come in order of date from batch to batch; one not later than the code's last is left out.
    Repeated bars of a date inside a batch count once, the last of them.
    """
    schema = "code long, date date, " + ", ".join(f"{c} double" for c in COLUMNS) + ", run long"
    rows = bars.select(F.col("code").cast("long").alias("code"), "date", F.col("day").cast("long").alias("day"), "high", "low", "close", "turnover")
    out = rows.groupBy("code").transformWithStateInPandas(_Carried(cells), outputStructType=schema, outputMode="Append", timeMode="None")
    return out.select("code", "date", *(F.nanvl(c, F.lit(None)).alias(c) for c in COLUMNS), "run")


#: A market day as event time: so many milliseconds for each day's number, from 0, and one more, as a clock's first reading is 0.
DAY_MS = 86_400_000
STAY = "code long, stay long, first date, last date, days long, best long, streak long, expired boolean"


class _Pool(StatefulProcessor):
    """The stays of one code; a stay ends by a timer of market days."""

    def __init__(self, kept: int):
        self.kept = kept

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.stay = handle.getValueState("stay", "stay long, first date, last date, day long, days long, best long, run long, streak long, open boolean")

    def _row(self, key, s: list, expired: bool) -> tuple:
        return key[0], s[0], s[1], s[2], s[4], s[5], s[7], expired

    def _due(self, day: int) -> int:
        return (day + self.kept + 3) * DAY_MS

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N802
        s = list(self.stay.get()) if self.stay.exists() else None
        before, out = (s[3] if s and s[8] else None), []
        listed = pd.concat(list(rows)).dropna(subset=["rank"]).sort_values("day")
        for date, day, rank in zip(listed["date"], listed["day"].tolist(), listed["rank"].tolist(), strict=True):
            if s and s[8] and day <= s[3]:
                s[5] = min(s[5], int(rank)) if day == s[3] else s[5]
                continue
            if s and s[8] and day - s[3] > self.kept + 1:
                out.append(self._row(key, s, True))
                s[8] = False
            if not s or not s[8]:
                s = [(s[0] if s else 0) + 1, date, date, day, 1, int(rank), 1, 1, True]
            else:
                run = s[6] + 1 if day == s[3] + 1 else 1
                s = [s[0], s[1], date, day, s[4] + 1, min(s[5], int(rank)), run, max(s[7], run), True]
        if len(listed) and s:
            out.append(self._row(key, s, False))
            if before is not None and before != s[3]:
                self.handle.deleteTimer(self._due(before))
            if before != s[3]:
                self.handle.registerTimer(self._due(s[3]))
            self.stay.update(tuple(s))
        if out:
            yield pd.DataFrame(out, columns=[c.split()[0] for c in STAY.split(", ")])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N802
        s = list(self.stay.get()) if self.stay.exists() else None
        if s and s[8] and self._due(s[3]) <= expiredTimerInfo.getExpiryTimeInMs():
            s[8] = False
            self.stay.update(tuple(s))
            yield pd.DataFrame([self._row(key, s, True)], columns=[c.split()[0] for c in STAY.split(", ")])

    def close(self) -> None:
        pass


def pool(lists: DataFrame, kept: int = 60) -> DataFrame:
    """Stays of codes in the pool, from listings (code, date, day, rank): a row for each change, and one when a stay expires.

    A stay outlives its last listing by ``kept`` market days and is removed at the end of the one after, so a
    listing on that day still belongs to it.  The clock is the market day's number; rows without a rank only move it, so
    that days without listings can be told.  Listings of days that the clock has passed are dropped.
    """
    rows = lists.select(F.col("code").cast("long").alias("code"), "date", F.col("day").cast("long").alias("day"), F.col("rank").cast("double").alias("rank"), F.timestamp_millis((F.col("day").cast("long") + 1) * DAY_MS).alias("at"))
    return rows.withWatermark("at", "0 seconds").groupBy("code").transformWithStateInPandas(_Pool(kept), outputStructType=STAY, outputMode="Append", timeMode="EventTime")


def newest(changes: DataFrame) -> DataFrame:
    """The latest row of each stay."""
    return changes.groupBy("code", "stay").agg(F.max_by(F.struct("first", "last", "days", "best", "streak", "expired"), F.struct("days", F.col("expired").cast("int"), -F.col("best"))).alias("s")).select("code", "stay", "s.*")


def _ranges(frame: DataFrame, cuts: list[str], folder: str) -> Iterator[None]:
    """Hands ``frame`` in to ``folder``/in by ranges of dates between ``cuts``, each by as many tasks as it has parts.

    The frame is worked out once and written by range; rows without a date belong to no range.
    """
    place = sum(((F.col("date") >= F.lit(c).cast("date")).cast("int") for c in cuts), F.lit(0))
    rows = frame.where(F.col("date").isNotNull()) if cuts else frame
    rows = written(rows.withColumn("_range", place), "ranges", "_range")
    for k in range(len(cuts) + 1):
        rows.where(F.col("_range") == k).drop("_range").write.mode("append").parquet(f"{folder}/in")
        yield


def replay(frame: DataFrame, operator, cuts: list[str], folder: str | None = None) -> DataFrame:
    """What ``operator`` of a stream gives for ``frame``, handed in by ranges of dates between ``cuts``.

    Every range is a micro-batch of its own, for which the query goes on from its checkpoint; the result is the file sink's table.
    """
    spark = frame.sparkSession
    at = folder or scratch(spark, "replay")
    with state_store(spark):
        for _ in _ranges(frame, cuts, at):
            stream = operator(spark.readStream.schema(frame.schema).parquet(f"{at}/in"))
            stream.writeStream.format("parquet").option("path", f"{at}/out").option("checkpointLocation", f"{at}/state").trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{at}/out")


def upserted(frame: DataFrame, keys: list[str], order: list[str], cuts: list[str]) -> DataFrame:
    """The table that ``upsert_into`` leaves after ``frame`` came in by ranges of dates."""
    from barline.streaming import upsert_into

    spark, at = frame.sparkSession, scratch(frame.sparkSession, "upserted")
    for _ in _ranges(frame, cuts, at):
        stream = spark.readStream.schema(frame.schema).parquet(f"{at}/in")
        stream.writeStream.foreachBatch(upsert_into(f"{at}/table", keys, order)).option("checkpointLocation", f"{at}/state").trigger(availableNow=True).start().awaitTermination()
    newest = spark.read.schema("version string").json(f"{at}/table/_current").agg(F.max("version")).first()[0]
    return spark.read.schema(frame.schema).parquet(f"{at}/table/{newest}")
