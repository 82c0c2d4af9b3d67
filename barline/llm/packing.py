"""Packing of token pieces into sequences of a fixed capacity, with few sequences.

1.  Each document's ids are counted inside tasks; a document over the capacity is
    cut into pieces of exactly the capacity, the last may be shorter.
2.  The histogram of piece lengths, at most ``capacity`` rows whatever the corpus,
    goes to the driver.  The configuration linear program (a configuration is a
    multiset of lengths that fits one sequence; every length is covered as often as
    it occurs, with as few configurations as possible) is solved by multiplicative
    weights: a length's weight falls as it is covered, and the next configuration is
    the best one under the weights, found by a knapsack dynamic program.
3.  Steps are rounded to whole sequences; the last few pieces are priced one sequence
    at a time, with what is left as bounds.
4.  Every piece gets its number among the pieces of its length, and the configuration
    table, whose size is bounded by the capacity too, turns length and number into
    sequence and offset by arithmetic.

Numbers are dealt by (length, salt) with the salt from the document's id, so a
length that holds most pieces is still numbered by many tasks.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from barline.llm.shared import materialise, text_or_empty

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def token_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = 2048, end_id: int = 0) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32.

    Null text counts as empty: its only token is ``end_id``.  Repeated rows give
    repeated pieces.  Texts of any length are tokenised whole.  Other columns are not read;
    a null doc_id stays null.  An empty table gives an empty one.
    """
    end = end_id.to_bytes(4, "little")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from barline.llm.tokens import piece_cache

        cache = piece_cache(tokenizer_path)
        for batch in batches:
            rows = []
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                ids = cache.encode(text.as_py()) + end
                for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                    part = ids[at : at + 4 * capacity]
                    rows.append((doc, k, at // 4, len(part) // 4, zlib.crc32(part)))
            doc, piece, start, length, crc = zip(*rows, strict=True) if rows else ((),) * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(doc, pa.int64()), pa.array(piece, pa.int32()), pa.array(start, pa.int64()), pa.array(length, pa.int64()), pa.array(crc, pa.int64())],
                names=["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")).mapInArrow(cut, PIECES)


class _Pricing:
    """The knapsack dynamic program: a dearest multiset of lengths for every room up to the capacity.

    Contents take no more of a length than ``most``; the best content of a room is extended
    from the best ones of smaller rooms, so with tight bounds it is good rather than best.
    """

    def __init__(self, price: np.ndarray, lengths: np.ndarray, most: np.ndarray, capacity: int):
        self.lengths, self.value = lengths, np.zeros(capacity + 1)
        self.choice = np.full(capacity + 1, -1)
        most = np.minimum(most, 255).astype(np.uint8)
        used = np.zeros((capacity + 1, len(lengths)), np.uint8)
        fits = np.searchsorted(lengths, np.arange(capacity + 1), "right")
        every = np.arange(len(lengths))
        for room in range(int(lengths[0]) if len(lengths) else capacity + 1, capacity + 1):
            k = fits[room]
            rest = room - lengths[:k]
            gain = np.where(used[rest, every[:k]] < most[:k], self.value[rest] + price[:k], -1.0)
            best = int(gain.argmax())
            if gain[best] > self.value[room - 1]:
                self.value[room], self.choice[room] = gain[best], best
                used[room] = used[rest[best]]
                used[room, best] += 1
            else:
                self.value[room], self.choice[room] = self.value[room - 1], -2
                used[room] = used[room - 1]

    def content(self, room: int) -> dict[int, int]:
        """Numbers by length index of the content of ``room``."""
        out: dict[int, int] = {}
        while room > 0 and (i := int(self.choice[room])) != -1:
            if i == -2:
                room -= 1
            else:
                out[i] = out.get(i, 0) + 1
                room -= int(self.lengths[i])
        return out


#: Prices computed anew within a round, at most.
PASSES = 60


def _bounded(left: np.ndarray, lengths: np.ndarray, capacity: int) -> dict[int, int]:
    """The longest length left with the dearest content of the rest of its sequence, from what is left.

    The knapsack takes no more of a length than is left; prices are the lengths themselves, the
    dual solution whose bound is the volume.
    """
    live = np.flatnonzero(left)
    first = int(live[-1])
    room = capacity - int(lengths[first])
    out = {first: 1}
    fit = live[lengths[live] <= room][::-1]
    if not room or not len(fit):
        return out
    most = np.minimum(left[fit] - (fit == first), room // lengths[fit])
    pool = np.repeat(fit, most)
    # Which rooms can be filled exactly is one set of bits for each prefix of the pool.
    reach, sets = 1, [1]
    mask = (1 << (room + 1)) - 1
    for n in lengths[pool].tolist():
        reach |= (reach << n) & mask
        sets.append(reach)
        if reach >> room:
            break
    at = reach.bit_length() - 1
    for k in range(len(sets) - 1, 0, -1):
        if not sets[k - 1] >> at & 1:
            i = int(pool[k - 1])
            out[i] = out.get(i, 0) + 1
            at -= int(lengths[i])
    return out


def configurations(lengths: np.ndarray, counts: np.ndarray, capacity: int, rounds: int = 8, eta: float = 4.0, report: dict | None = None) -> list[tuple[dict[int, int], int]]:
    """Configurations (numbers by length index) and how many sequences take each; every piece has just one place.

    ``lengths`` ascend and are below ``capacity``.  Multiplicative weights on the covering
    constraints: a round raises the covered share of every length to the round's goal by the
    dearest configuration that holds it, a length's weight falls as it is covered, and lengths
    that would run ahead by more than a round are spared.  Steps are rounded to whole sequences
    as they are taken, and the next weights come from what was really covered, so rounding
    leaves no error behind.  What the rounds leave is covered anew, whatever its size, until a round
    places nothing; the sequences of what is left then are priced one by one with it as bounds.

    ``report`` receives the numbers of pieces, those that rounds placed, those priced one by
    one, the sequences, and the dual bound on them: prices in proportion to the lengths are
    dual feasible, and in all cases tried no other prices gave more.
    """
    left = counts.astype(np.int64).copy()
    out: list[tuple[dict[int, int], int]] = []
    note = {"pieces": int(left.sum()), "rounds": 0, "singly": 0, "sequences": 0, "bound": float(counts @ lengths) / capacity}

    def take(config: dict[int, int], times: int) -> None:
        out.append((config, times))
        note["sequences"] += times
        for i, n in config.items():
            left[i] -= n * times

    def cover() -> None:
        start = left.copy()
        turns = int(np.clip(start.sum() / np.count_nonzero(start) / 8, 1, rounds))
        for k in range(turns):
            floor = np.ceil(start * (1 - (k + 1) / turns)).astype(np.int64)  # left at the round's goal
            spare = np.floor(start * max(0.0, 1 - (k + 2) / turns)).astype(np.int64)
            for _ in range(PASSES):
                needy, live = np.flatnonzero(left > floor), np.flatnonzero(left > spare)
                if not len(needy):
                    break
                covered = 1 - left[live] / start[live]
                weight = lengths[live] / capacity * np.exp(-eta * (covered - covered.min()))
                pricing = _Pricing(weight, lengths[live], left[live] - spare[live], capacity)
                gone = 0
                for i in needy[::-1].tolist():
                    need = int(left[i] - floor[i])
                    if need <= 0:
                        continue
                    config = {int(live[j]): n for j, n in pricing.content(capacity - int(lengths[i])).items()}
                    config[i] = config.get(i, 0) + 1
                    times = min(-(-need // config[i]), min(int(left[j] - spare[j]) // n for j, n in config.items()))
                    if times > 0:
                        take(config, times)
                        gone += times
                if not gone or (k < turns - 1 and gone * 50 < len(needy)):
                    break

    before = -1
    while left.any() and before != left.sum():  # until rounds place no more
        before = int(left.sum())
        cover()
        note["rounds"] += before - int(left.sum())
    while left.any():
        config = _bounded(left, lengths, capacity)
        times = min(int(left[i]) // n for i, n in config.items())
        take(config, times)
        note["singly"] += times * sum(config.values())
    if report is not None:
        report.update(note)
    return out


def pack(pieces: DataFrame, capacity: int = 2048, salts: int | None = None) -> DataFrame:
    """Adds sequence_id and offset to a table of pieces (doc_id, piece, length, ...).

    ``pieces`` is read twice and should be a written table.  An empty table gives an
    empty one.  Which of several pieces of one length takes which place is free (ties go by
    doc_id and piece inside a salt); the sequences and their number don't depend on it.
    """
    spark = pieces.sparkSession
    salts = salts or 4 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    salted = pieces.withColumn("_salt", F.pmod(F.xxhash64("doc_id", "piece"), F.lit(salts)).cast("int"))
    by_salt = salted.groupBy("length", "_salt").count()
    histogram = by_salt.groupBy("length").agg(F.sum("count").alias("n")).orderBy("length").collect()  # at most `capacity` rows

    part = [r for r in histogram if r["length"] < capacity]
    full = sum(r["n"] for r in histogram if r["length"] == capacity)
    lengths, counts = (np.array([r[k] for r in part], np.int64) for k in ("length", "n"))
    slots, first, used = [], full, np.zeros(len(lengths), np.int64)
    for config, times in configurations(lengths, counts, capacity):
        offset = 0
        for i, a in sorted(config.items(), reverse=True):
            n = int(lengths[i])
            slots.append((n, int(used[i]), a, first, offset))
            used[i] += a * times
            offset += a * n
        first += times
    if full:
        slots.append((capacity, 0, 1, 0, 0))
    slots.sort()
    slot_length, slot_from, slot_per, slot_sequence, slot_offset = (np.array(c, np.int64) for c in zip(*slots, strict=True)) if slots else (np.zeros(0, np.int64),) * 5
    bounds = slot_length * (1 << 44) + slot_from

    before = Window.partitionBy("length").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    base = by_salt.withColumn("_base", F.coalesce(F.sum("count").over(before), F.lit(0))).drop("count")
    numbered = (
        salted.withColumn("_in_salt", F.row_number().over(Window.partitionBy("length", "_salt").orderBy("doc_id", "piece")) - 1)
        .join(base, ["length", "_salt"])
        .withColumn("_number", F.col("_base") + F.col("_in_salt"))
    )

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, number = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("length", "_number"))
            k = np.searchsorted(bounds, length * (1 << 44) + number, "right") - 1
            own = number - slot_from[k]
            table = batch.drop_columns(["_number"])
            yield pa.RecordBatch.from_arrays([*table.columns, pa.array(slot_sequence[k] + own // slot_per[k]), pa.array(slot_offset[k] + own % slot_per[k] * length)], names=[*table.schema.names, "sequence_id", "offset"])

    kept = numbered.select(*pieces.columns, "_number")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in pieces.schema) + ", sequence_id long, offset long"
    return kept.mapInArrow(place, schema)


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = 2048, end_id: int = 0) -> DataFrame:
    """Pieces of all documents with their places; see ``token_pieces`` and ``pack``."""
    return pack(materialise(token_pieces(docs, tokenizer_path, capacity, end_id), "pieces"), capacity)
