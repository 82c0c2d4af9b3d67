"""Removal of repeated windows of bytes: a depth-limited radix sort of suffixes, distributed.

Every byte is removed that lies in a window of ``width`` bytes which also starts earlier,
in a smaller doc_id or further ahead in the same document.  Equal suffixes up to the width
are exactly the repeated windows, so suffixes are ordered by most-significant-digit passes
through that depth only:

1.  The first digit is an anchor: the window's least hashed ``GRAM``-byte string.  Equal
    windows have equal anchors, and neighbouring windows mostly share one, so a *run* of
    windows with the same anchor is one record (anchor, 128-bit digest of the run's bytes,
    place).  Of equal runs in a batch of documents all but the first are repeats already, so
    a passage of every document sends one record of each batch, not of each document.
2.  Runs are partitioned by anchor.  An anchor that occurs once leaves.  Of equal runs all
    but the first are repeats.  The first ones stay only if their anchor has other runs.
3.  Those runs, few beside the text, are read again with their bytes.  Their windows go
    through the remaining digits, eight bytes a pass; a group of one leaves after each pass.
    What is left after the last pass is equal, and all but the first window are repeats.
4.  Documents receive their repeats and cut them out.

Runs are equal if their digests are, which for unlike bytes happens once in 10^38 pairs; all
other windows are compared byte by byte.  A row is known by its doc_id and a 128-bit digest of its text, two
64-bit hashes.  Null text counts as empty.  Rows that repeat a doc_id
are judged alike by (doc_id, start): a window at the same start of another row with the same
doc_id isn't earlier.  Rows without doc_id are such rows too, of one id before all others.
Texts of any length are read whole; other columns are not read; an empty table gives an empty one.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from barline.llm.shared import groups, materialise, text_or_empty

GRAM = 20
#: First runs of one anchor beyond which their windows are dealt one by one to many tasks.
HOT_RUNS = 20_000
#: Windows that are sorted at once.
SORTED_AT_ONCE = 200_000
#: Stands for a null doc_id inside arrays.
NO_ID = -(1 << 63)
_P = 0x9E3779B97F4A7C15


_POW = [np.uint64(pow(_P, k, 1 << 64)) for k in range(17)]


def anchor_runs(data: bytes, width: int = 100) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchor hash, first window and end of windows of each run."""
    a = np.frombuffer(data, np.uint8).astype(np.uint64) + np.uint64(1)
    h1 = a
    h2 = h1[:-1] * _POW[1] + h1[1:]
    h4 = h2[:-2] * _POW[2] + h2[2:]
    h8 = h4[:-4] * _POW[4] + h4[4:]
    h16 = h8[:-8] * _POW[8] + h8[8:]
    n = len(a) - GRAM + 1
    x = h16[:n] * _POW[4] + h4[16 : 16 + n]
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(32)
    span, reach, least = width - GRAM + 1, 1, x
    while reach * 2 <= span:
        least = np.minimum(least[:-reach], least[reach:])
        reach *= 2
    windows = len(a) - width + 1
    least = np.minimum(least[:windows], least[span - reach : span - reach + windows])
    # A run also ends where its anchor leaves on the left, so no two windows of a run are equal.
    cut = np.flatnonzero((least[1:] != least[:-1]) | (x[: windows - 1] == least[:-1])) + 1
    start = np.concatenate([[0], cut])
    return least[start], start, np.concatenate([cut, [windows]])


def _merged(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted intervals with those that touch joined."""
    if not len(start):
        return start, end
    order = np.argsort(start, kind="stable")
    start, end = start[order], np.maximum.accumulate(end[order])
    first = np.concatenate([[True], start[1:] > end[:-1]])
    return start[first], end[np.concatenate([first[1:], [True]])]


def repeated_windows(digits: np.ndarray, place: np.ndarray, width: int) -> np.ndarray:
    """Passes of eight bytes over the windows at ``place``; the group of each, -1 if nothing equals it.

    ``digits`` holds the eight bytes that begin at each place of the buffer.
    """
    live, group = np.arange(len(place)), np.zeros(len(place), np.int64)
    for depth in [*range(0, width - 8, 8), width - 8]:
        digit = digits[place[live] + depth]
        order = np.lexsort((digit, group))
        g, d = group[order], digit[order]
        new = np.concatenate([[True], (g[1:] != g[:-1]) | (d[1:] != d[:-1])])
        number = np.cumsum(new) - 1
        several = np.bincount(number)[number] > 1
        live, group = live[order[several]], number[several]
        if not len(live):
            break
    out = np.full(len(place), -1, np.int64)
    out[live] = group
    return out


def _sort_runs(tables: list[pa.Table], width: int) -> pa.RecordBatch | None:
    """Repeats among the windows of whole anchor groups, as (doc_id, th, tl, start, end)."""
    table = pa.concat_tables(tables)
    doc = pc.fill_null(table.column("doc_id"), NO_ID).to_numpy()
    th, tl, start = (table.column(c).to_numpy() for c in ("th", "tl", "start"))
    pieces = table.column("piece").to_pylist()
    size = np.array([len(p) for p in pieces])
    buffer = np.frombuffer(b"".join(pieces) + b"\0" * 8, np.uint8).astype(np.uint64)
    digits = np.zeros(len(buffer) - 7, np.uint64)
    for k in range(8):
        digits = digits << np.uint64(8) | buffer[k : len(buffer) - 7 + k]
    count = size - width + 1
    at = np.concatenate([[0], np.cumsum(size)[:-1]])
    owner = np.repeat(np.arange(len(size)), count)
    inside = np.arange(count.sum()) - np.repeat(np.concatenate([[0], np.cumsum(count)[:-1]]), count)
    group = repeated_windows(digits, at[owner] + inside, width)
    hit = np.flatnonzero(group >= 0)
    if not len(hit):
        return None
    g, d, s = group[hit], doc[owner[hit]], start[owner[hit]] + inside[hit]
    order = np.lexsort((s, d, g))
    g, d, s, hit = g[order], d[order], s[order], hit[order]
    lead = np.concatenate([[True], g[1:] != g[:-1]])
    first = np.maximum.accumulate(np.where(lead, np.arange(len(g)), 0))
    later = (d != d[first]) | (s != s[first])
    whose = owner[hit[later]]
    return _spans(d[later], th[whose], tl[whose], s[later]) if later.any() else None


def _spans(d: np.ndarray, t: np.ndarray, u: np.ndarray, s: np.ndarray) -> pa.RecordBatch:
    """Windows of documents as (doc_id, th, tl, start, end), neighbours joined."""
    order = np.lexsort((s, u, t, d))
    d, t, u, s = d[order], t[order], u[order], s[order]
    new = np.concatenate([[True], (d[1:] != d[:-1]) | (t[1:] != t[:-1]) | (u[1:] != u[:-1]) | (s[1:] > s[:-1] + 1)])
    last = np.concatenate([new[1:], [True]])
    return pa.RecordBatch.from_arrays([pa.array(d[new], pa.int64(), mask=d[new] == NO_ID), pa.array(t[new]), pa.array(u[new]), pa.array(s[new], pa.int32()), pa.array(s[last] + 1, pa.int32())], names=["doc_id", "th", "tl", "start", "end"])


def first_runs(batch: pa.RecordBatch, width: int) -> pa.RecordBatch | None:
    """The runs of a batch of documents: the first of each digest, and the others merged, without anchor and digest."""
    ids = pc.fill_null(batch.column("doc_id"), NO_ID).to_numpy()
    anchors, digests, owners, starts, ends = [], [], [], [], []
    for k, data in enumerate(batch.column("data")):
        data = data.as_py()
        if len(data) < width:
            continue
        anchor, start, end = anchor_runs(data, width)
        view = memoryview(data)
        digests += [xxhash.xxh3_128_digest(view[i : j + width - 1]) for i, j in zip(start.tolist(), end.tolist(), strict=True)]
        anchors.append(anchor)
        owners.append(np.full(len(start), k))
        starts.append(start)
        ends.append(end)
    if not anchors:
        return None
    anchor, owner, start, end = (np.concatenate(x) for x in (anchors, owners, starts, ends))
    digest = np.frombuffer(b"".join(digests), "<u8").reshape(-1, 2)
    order = np.lexsort((start, ids[owner], digest[:, 0], digest[:, 1]))
    d, o, s = digest[order], ids[owner[order]], start[order]
    new = np.concatenate([[True], (d[1:] != d[:-1]).any(1)])
    lead = np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))
    again = np.zeros(len(order), bool)
    again[order] = (o != o[lead]) | (s != s[lead])
    first = np.flatnonzero(~again)
    repeat_owner, repeat_start, repeat_end = [], [], []
    at = np.flatnonzero(again)
    cuts = np.searchsorted(owner[at], np.arange(batch.num_rows + 1))
    for k in np.flatnonzero(np.diff(cuts)):
        part = at[cuts[k] : cuts[k + 1]]
        a, b = _merged(start[part], end[part])
        repeat_owner.append(np.full(len(a), k))
        repeat_start.append(a)
        repeat_end.append(b)
    m = sum(map(len, repeat_owner))
    rows = np.concatenate([owner[first], *repeat_owner])
    return pa.RecordBatch.from_arrays(
        [
            pa.concat_arrays([pa.array(anchor[first].view(np.int64)), pa.nulls(m, pa.int64())]),
            pa.concat_arrays([pa.array([digests[k] for k in first], pa.binary()), pa.nulls(m, pa.binary())]),
            batch.column("doc_id").take(pa.array(rows)),
            *(batch.column(c).take(pa.array(rows)) for c in ("th", "tl")),
            pa.array(np.concatenate([start[first], *repeat_start]), pa.int32()),
            pa.array(np.concatenate([end[first], *repeat_end]), pa.int32()),
        ],
        names=["anchor", "digest", "doc_id", "th", "tl", "start", "end"],
    )


def remove_repeats(docs: DataFrame, width: int = 100) -> DataFrame:
    """doc_id, n_bytes, spans (array of start and end of removed runs), kept (binary) for each row of (doc_id, text)."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().cast("binary").alias("data")).select("doc_id", F.xxhash64("data").alias("th"), F.xxhash64(F.lit(1), "data").alias("tl"), "data")

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 2000):
                if (out := first_runs(batch.slice(at, 2000), width)) is not None:
                    yield out

    place = "doc_id long, th long, tl long, start int, end int"
    runs = rows.mapInArrow(find, f"anchor long, digest binary, {place}")
    equal, same_anchor = Window.partitionBy("anchor", "digest"), Window.partitionBy("anchor")
    lead = F.col("doc_id").eqNullSafe(F.col("_first.doc_id")) & (F.col("start") == F.col("_first.start"))
    judged = (
        runs.withColumn("anchor", F.coalesce("anchor", F.xxhash64("doc_id", "th", "start")))  # repeats, without digest, needn't meet
        .withColumn("_first", F.min(F.struct("doc_id", "start")).over(equal))
        .withColumn("_lead", lead)
        .withColumn("_several", F.coalesce(F.min("digest").over(same_anchor) != F.max("digest").over(same_anchor), F.lit(False)))
        .withColumn("_leads", F.sum(F.col("_lead").cast("int")).over(same_anchor))
    )
    repeat = F.col("digest").isNull() | ~F.col("_lead")
    found = materialise(
        judged.where(repeat | F.col("_several")).select(repeat.alias("repeat"), "anchor", (F.col("_leads") > HOT_RUNS).alias("hot"), "doc_id", "th", "tl", "start", "end"),
        "runs",
    )
    key = ["doc_id", "th", "tl"]
    opened = found.where(~F.col("repeat")).groupBy(*key).agg(F.collect_set(F.struct("anchor", "hot", "start", "end")).alias("open"))

    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out, hot = [], {}
            for doc, th, tl, data, open_ in zip(*(batch.column(c) for c in ("doc_id", "th", "tl", "data", "open")), strict=True):
                if not open_.is_valid:
                    continue
                doc, th, tl, data = doc.as_py(), th.as_py(), tl.as_py(), data.as_py()
                for r in open_.as_py():
                    if r["hot"]:
                        for s in range(r["start"], r["end"]):
                            hot.setdefault((r["anchor"], data[s : s + width]), []).append((NO_ID if doc is None else doc, s, th, tl))
                    else:
                        out.append((r["anchor"], 0, doc, th, tl, r["start"], data[r["start"] : r["end"] + width - 1]))
            # Of a hot window's places in the batch all but the first are repeats already and needn't meet the others.
            for (anchor, piece), places in hot.items():
                first = min(places)[:2]
                lead = [p for p in places if p[:2] == first]
                part = xxhash.xxh3_64_intdigest(piece) % 1024
                ids = lambda d: None if d == NO_ID else d
                out += [(anchor, part, ids(d), th, tl, s, piece) for d, s, th, tl in lead]
                out += [(xxhash.xxh3_64_intdigest(f"{d} {s}") - (1 << 63), -1, ids(d), th, tl, s, None) for d, s, th, tl in places if (d, s) != first]
            if out:
                anchor, part, doc, th, tl, start, piece = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(anchor, pa.int64()), pa.array(part, pa.int32()), *(pa.array(c, pa.int64()) for c in (doc, th, tl)), pa.array(start, pa.int32()), pa.array(piece, pa.binary())],
                    names=["anchor", "part", "doc_id", "th", "tl", "start", "piece"],
                )

    def told(batches: Iterator[pa.RecordBatch], found: list) -> Iterator[pa.RecordBatch]:
        """The batches without repeats that are known as such, which go to ``found``."""
        for batch in batches:
            known = pc.is_null(batch.column("piece"))
            if pc.any(known).as_py():
                some = batch.filter(known)
                ids = pc.fill_null(some.column("doc_id"), NO_ID).to_numpy()
                found.append(_spans(ids, *(some.column(c).to_numpy() for c in ("th", "tl")), some.column("start").to_numpy().astype(np.int64)))
                batch = batch.filter(pc.invert(known))
            yield batch

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, windows, known = [], 0, []
        for _, table in groups(told(batches, known), ["anchor", "part"]):
            while known:
                yield known.pop()
            if table.num_rows > 1:
                held.append(table)
                windows += table.num_rows * (width - GRAM + 1)
            if windows > SORTED_AT_ONCE:
                if (out := _sort_runs(held, width)) is not None:
                    yield out
                held, windows = [], 0
        yield from known
        if held and (out := _sort_runs(held, width)) is not None:
            yield out

    def joined(part: DataFrame) -> DataFrame:
        """The rows with the lists of ``part`` by key, which may be absent."""
        ids = part.select(*(F.col(c).alias(f"_{c}") for c in key), *(c for c in part.columns if c not in key))
        return rows.join(ids, F.col("doc_id").eqNullSafe(F.col("_doc_id")) & (F.col("th") == F.col("_th")) & (F.col("tl") == F.col("_tl")), "left")

    fetched = joined(opened).select(*key, "data", "open").mapInArrow(fetch, "anchor long, part int, doc_id long, th long, tl long, start int, piece binary")
    sorted_ = fetched.repartition("anchor", "part").sortWithinPartitions("anchor", "part").mapInArrow(sort, place)
    repeats = found.where("repeat").select(*key, "start", "end").unionByName(sorted_).groupBy(*key).agg(F.collect_set(F.struct("start", "end")).alias("repeats"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes, spans, kept = [], [], []
            for data, repeats in zip(batch.column("data"), batch.column("repeats"), strict=True):
                data = data.as_py()
                sizes.append(len(data))
                if not repeats.is_valid:
                    spans.append([])
                    kept.append(data)
                    continue
                flat = repeats.values
                start, end = _merged(flat.field("start").to_numpy().astype(np.int64), flat.field("end").to_numpy().astype(np.int64) + width - 1)
                gone = [{"start": i, "end": j} for i, j in zip(start.tolist(), end.tolist(), strict=True)]
                spans.append(gone)
                kept.append(b"".join(data[i:j] for i, j in zip([0, *(x["end"] for x in gone)], [*(x["start"] for x in gone), len(data)], strict=True)))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(sizes, pa.int64()), pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))), pa.array(kept, pa.binary())],
                names=["doc_id", "n_bytes", "spans", "kept"],
            )

    return joined(repeats).select("doc_id", "data", "repeats").mapInArrow(cut, "doc_id long, n_bytes long, spans array<struct<start:int,end:int>>, kept binary")
