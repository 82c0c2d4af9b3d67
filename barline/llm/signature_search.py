"""Ranked lexical search by bit-sliced Bloom signatures, with exact rescoring of what they can't exclude.

Index, one pass over the texts:

1.  A document's signature is a Bloom filter of its terms and of how often they occur: a term is
    entered once for each of ``LEVELS`` that its number reaches.
2.  Documents of like size are gathered into blocks with filters of one width, and a block's
    filters are stored by slice: slice i is the bitmap of the documents whose bit i is set.
3.  The task's dictionary, each term's documents and greatest number in one text, is stored beside.

Search, for a bounded number of queries at a time (``QUERIES_AT_ONCE``):

4.  Document frequencies, the number of documents and their length are summed over all dictionaries
    and blocks.
5.  For a block, the slices of a term at a level, combined by AND, are the bitmap of documents
    that may hold it so often; none that does is missing.  Sums of these bitmaps, weighted by
    the score that the level allows, bound every document's score from above.
6.  The documents of the highest bounds are scored exactly; a query's ``k``-th best such score
    excludes all documents with a smaller bound.  All others are scored exactly too, from their whole
    texts.

Nothing that isn't provably outside the first ``k`` is excluded: of documents with the same
terms in the same order all but the ``k`` of least id in a block, documents whose bound is below the ``k``-th
exact score, and those that at best reach it with a greater id.

Null and empty texts have no terms: as documents they count nowhere, as queries they have no rows.
Rows that repeat a doc_id are documents of their own; so are those without, which come first among
equal scores.  Rows that repeat an item are answered each; a null item_id stays.  Texts of any length are read whole,
a single long one makes a block of its own.  Other columns are not read.  Without documents or
queries there are no rows.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from barline.llm.shared import materialise, text_or_empty

#: Numbers of occurrences that a signature tells apart.
LEVELS = np.array(sorted({1, 2, 3, *(b << s for s in range(1, 30) for b in (2, 3))}), np.int64)
#: Bits of a filter for each of its entries at least, and hashes of an entry.
BITS, HASHES = 10, 3
#: Documents of a block, and bits of a block, at most.
BLOCK_DOCS, BLOCK_BITS = 1024, 1 << 25
#: Terms of a task's dictionary before it is handed out.
DICTIONARY = 200_000
#: Queries that are answered together, and numbers of bounds that are held at once.
QUERIES_AT_ONCE, AT_ONCE = 4096, 1 << 22
#: Stands for a null doc_id in arrays.
NO_ID = -(1 << 63)

#: ASCII letters are lowered; other ASCII characters but digits part terms.
_TERM_BYTES = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or 48 <= b <= 57 or 97 <= b <= 122 else 32 for b in range(256))


def terms(text: str) -> list[bytes]:
    return text.encode().translate(_TERM_BYTES).split()


def _places(hashes: np.ndarray, level: int, width: int) -> np.ndarray:
    """The bits of each entry, by double hashing of a mixed hash."""
    x = hashes + np.uint64((level + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1)
    for shift, factor in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ x >> np.uint64(shift)) * np.uint64(factor)
    x ^= x >> np.uint64(31)
    step = (x >> np.uint64(32)) | np.uint64(1)
    return ((x[:, None] + step[:, None] * np.arange(HASHES, dtype=np.uint64)) & np.uint64(width - 1)).astype(np.int64)


def _hashes(words: list[bytes]) -> np.ndarray:
    return np.array([xxhash.xxh3_64_intdigest(w) for w in words], np.uint64)


def _width(entries: int) -> int:
    return 1 << max(6, (BITS * entries - 1).bit_length())


def sliced(docs: list[tuple[list[bytes], np.ndarray]], width: int) -> tuple[np.ndarray, list[bytes], np.ndarray, np.ndarray]:
    """Slices of the filters of ``docs`` (distinct terms and their numbers), and the terms with their documents and greatest numbers."""
    known: dict[bytes, int] = {}
    at = np.array([known.setdefault(t, len(known)) for own, _ in docs for t in own], np.int64)
    number = np.concatenate([n for _, n in docs])
    doc = np.repeat(np.arange(len(docs)), [len(n) for _, n in docs])
    words = list(known)
    hashes = _hashes(words)
    bits = np.zeros((width, len(docs)), bool)
    for level, least in enumerate(LEVELS.tolist()):
        reach = number >= least
        if not reach.any():
            break
        bits[_places(hashes, level, width)[at[reach]].T, doc[reach]] = True
    most = np.zeros(len(words), np.int64)
    np.maximum.at(most, at, number)
    return np.packbits(bits, axis=1), words, np.bincount(at, minlength=len(words)), most


_INDEX = pa.schema([("width", pa.int32()), ("slices", pa.binary()), *((c, pa.list_(pa.int64())) for c in ("ids", "lengths", "digests")), ("terms", pa.list_(pa.binary())), ("df", pa.list_(pa.int64())), ("most", pa.list_(pa.int64()))])
_INDEX_SQL = "width int, slices binary, ids array<long>, lengths array<long>, digests array<long>, terms array<binary>, df array<long>, most array<long>"


def index(docs: DataFrame) -> DataFrame:
    """Blocks of signatures and dictionaries of (doc_id, text), as a written table."""

    def row(**values) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([values.get(f.name)], f.type) for f in _INDEX], schema=_INDEX)

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list] = {}
        dictionary: dict[bytes, tuple[int, int]] = {}

        def block(width: int) -> pa.RecordBatch:
            rows = held.pop(width)
            slices, words, df, most = sliced([r[3:] for r in rows], width)
            for w, n, m in zip(words, df.tolist(), most.tolist(), strict=True):
                d = dictionary.get(w, (0, 0))
                dictionary[w] = (d[0] + n, max(d[1], m))
            ids, lengths, digests, _, _ = zip(*rows, strict=True)
            return row(width=width, slices=slices.tobytes(), ids=ids, lengths=lengths, digests=np.frombuffer(b"".join(digests), "<i8"))

        def words() -> pa.RecordBatch:
            df, most = zip(*dictionary.values(), strict=True)
            out = row(terms=list(dictionary), df=df, most=most)
            dictionary.clear()
            return out

        for batch in batches:
            for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                found = terms(text.as_py())
                if not found:
                    continue
                count = Counter(found)
                number = np.fromiter(count.values(), np.int64, len(count))
                width = _width(int(np.searchsorted(LEVELS, number, "right").sum()))
                rows = held.setdefault(width, [])
                rows.append((doc, len(found), xxhash.xxh3_128_digest(b" ".join(found)), list(count), number))
                if len(rows) >= min(BLOCK_DOCS, max(1, BLOCK_BITS // width)):
                    yield block(width)
                    if len(dictionary) > DICTIONARY:
                        yield words()
        for width in list(held):
            yield block(width)
        if dictionary:
            yield words()

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    return materialise(rows.mapInArrow(build, _INDEX_SQL), "signatures")


class Query:
    """Queries numbered from 0, with the weights of their terms, as tasks need them."""

    def __init__(self, texts: list[str], n_docs: int, length: int, df: dict[bytes, tuple[int, int]]):
        self.n_docs, self.length = n_docs, length
        known: dict[bytes, int] = {}
        own = [[known.setdefault(t, len(known)) for t in terms(x) if t in df] for x in texts]
        self.number = [i for i, t in enumerate(own) if t]
        self.flat = np.array([t for x in own for t in x], np.int64)
        self.start = np.cumsum([0, *(len(x) for x in own if x)])
        self.words = list(known)
        self.hashes = _hashes(self.words)
        self.weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t][0] + 1))) for t in self.words], np.int64)
        self.most = np.array([df[t][1] for t in self.words], np.int64)

    def scale(self, lengths: np.ndarray) -> np.ndarray:
        """A document's m: three quarters and its share of the average length, in hundredths."""
        return np.array([75 + 25 * n * self.n_docs // self.length for n in lengths.tolist()], np.int64)

    def bounds(self, slices: np.ndarray, m: np.ndarray) -> np.ndarray:
        """An upper bound for each query and document of a block, from its slices."""
        alive = np.full((len(self.words), slices.shape[1]), 255, np.uint8)
        level = np.zeros((len(self.words), 8 * slices.shape[1]), np.int8)
        for k, least in enumerate(LEVELS.tolist()):
            live = np.flatnonzero(self.most >= least)
            if not len(live):
                break
            alive[live] &= np.bitwise_and.reduce(slices[_places(self.hashes[live], k, len(slices))], axis=1)
            level[live] += np.unpackbits(alive[live], axis=1).view(np.int8)
        most = np.minimum(np.append(LEVELS, 1 << 40)[level[:, : len(m)]] - 1, self.most[:, None])
        worth = self.weight[:, None] * (1_000_000_000 * most // (1000 * most + 12 * m))
        return np.stack([worth[self.flat[i:j]].sum(0) for i, j in zip(self.start, self.start[1:], strict=False)])

    def score(self, count: dict[bytes, int], m: int, q: int) -> int:
        """The exact score of a document for the q-th query."""
        own = self.flat[self.start[q] : self.start[q + 1]].tolist()
        return sum(int(self.weight[t]) * (1_000_000_000 * tf // (1000 * tf + 12 * m)) for t in own if (tf := count.get(self.words[t])))


def _blocks(batch: pa.RecordBatch, k: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """ids, lengths, slices and, for documents of the same terms, which are the first ``k`` by id."""
    for width, slices, ids, lengths, digests in zip(*(batch.column(c) for c in ("width", "slices", "ids", "lengths", "digests")), strict=True):
        ids = ids.values.fill_null(NO_ID).to_numpy()
        a, b = digests.values.to_numpy().reshape(-1, 2).T
        order = np.lexsort((ids, a, b))
        new = np.append(True, (a[order][1:] != a[order][:-1]) | (b[order][1:] != b[order][:-1]))
        place = np.arange(len(ids)) - np.maximum.accumulate(np.where(new, np.arange(len(ids)), 0))
        first = np.empty(len(ids), bool)
        first[order] = place < k
        packed = np.frombuffer(slices.as_buffer(), np.uint8).reshape(width.as_py(), -1)
        yield ids, lengths.values.to_numpy(), packed, first


def _pairs(query: Query, bounds_of: DataFrame, k: int, least: list[tuple[int, int]] | None) -> DataFrame:
    """(q, doc_id) of the highest bounds of each task, or with ``least`` of all documents that (score, id) don't exclude."""

    def rows(q: np.ndarray, ids: np.ndarray, bound: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(q, pa.int64()), pa.array(ids, pa.int64(), mask=ids == NO_ID), pa.array(bound, pa.int64())], names=["q", "doc_id", "bound"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n = len(query.number)
        q = np.arange(n)[:, None]
        best, whose = np.zeros((n, 0), np.int64), np.zeros((n, 0), np.int64)
        if least is not None:
            score, last = np.array(least, np.int64).T[:, :, None]
        # Documents are taken some at a time, so that the bounds' terms fit the memory.
        step = max(8, AT_ONCE // max(1, len(query.words)) // 8 * 8)
        for batch in batches:
            for ids, lengths, slices, first in _blocks(batch, k):
                for at in range(0, len(ids), step):
                    own, some = ids[at : at + step], first[at : at + step]
                    bound = np.where(some, query.bounds(slices[:, at // 8 : (at + step) // 8], query.scale(lengths[at : at + step])), 0)
                    if least is None:
                        best, whose = np.hstack([best, bound]), np.hstack([whose, np.broadcast_to(own, bound.shape)])
                        if best.shape[1] > k:
                            top = np.argpartition(-best, k - 1, axis=1)[:, :k]
                            best, whose = best[q, top], whose[q, top]
                    else:
                        i, j = np.nonzero((bound > score) | (bound == score) & (bound > 0) & (own <= last))
                        yield rows(i, own[j], bound[i, j])
        if least is None:
            i, j = np.nonzero(best)
            yield rows(i, whose[i, j], best[i, j])

    return bounds_of.mapInArrow(run, "q long, doc_id long, bound long")


def _rescored(query: Query, pairs: DataFrame, docs: DataFrame, name: str) -> DataFrame:
    """Exact scores above 0 of the documents of (q, doc_id), from their whole texts."""
    asked = materialise(pairs.groupBy("doc_id").agg(F.collect_set("q").alias("qs")), name).withColumnRenamed("doc_id", "_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for doc, text, qs in zip(batch.column("doc_id").to_pylist(), batch.column("text"), batch.column("qs").to_pylist(), strict=True):
                found = terms(text.as_py())
                count, m = Counter(found), int(query.scale(np.array([len(found)]))[0])
                out += [(q, doc, s) for q in qs if (s := query.score(count, m, q))]
            q, doc, score = zip(*out, strict=True) if out else ((),) * 3
            yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (q, doc, score)], names=["q", "doc_id", "score"])

    joined = docs.join(asked, F.col("doc_id").eqNullSafe(F.col("_id"))).select("doc_id", "text", "qs")
    return joined.mapInArrow(run, "q long, doc_id long, score long")


def _first(scored: DataFrame, k: int, by: str) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy("q").orderBy(F.col(by).desc(), "doc_id"))
    return scored.withColumn("rank", rank).where(F.col("rank") <= k)


def search(docs: DataFrame, items: DataFrame, k: int = 20, indexed: DataFrame | None = None, report: dict | None = None) -> DataFrame:
    """The ``k`` best documents of (doc_id, text) for each row of (item_id, text): item_id, rank, doc_id, score.

    ``indexed`` is a table of ``index`` of the same documents, made where it is absent.  ``report``
    receives the numbers of seeds and candidates.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))
    indexed = index(docs) if indexed is None else indexed
    blocks = indexed.where(F.col("ids").isNotNull()).select("width", "slices", "ids", "lengths", "digests")
    size = blocks.agg(F.sum(F.size("ids")), F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda a, n: a + n))).first()
    asked = items.select("item_id", text_or_empty().alias("_text"))
    texts = asked.select("_text").distinct()
    parts = -(-texts.count() // QUERIES_AT_ONCE)
    out = []
    for part in range(parts if size[0] else 0):
        own = [r[0] for r in texts.where(F.pmod(F.xxhash64("_text"), F.lit(parts)) == part).collect()]
        words = sorted({t for x in own for t in terms(x)})
        if not words:
            continue
        known = spark.createDataFrame([(bytearray(w),) for w in words], "term binary")
        found = indexed.where(F.col("terms").isNotNull()).select(F.inline(F.arrays_zip("terms", "df", "most"))).join(known, F.col("terms") == F.col("term"))
        df = {bytes(r[0]): (r[1], r[2]) for r in found.groupBy("term").agg(F.sum("df"), F.max("most")).collect()}  # a row for each term of these queries at most
        query = Query(own, size[0], size[1], df)
        if not query.number:
            continue
        seeds = _first(_pairs(query, blocks, k, None), k, "bound")
        best = _first(_rescored(query, seeds, docs, "seeds"), k, "score").groupBy("q").agg(F.count("*"), F.max_by(F.struct("score", "doc_id"), "rank")).collect()
        reached = {r[0]: (r[2][0], NO_ID if r[2][1] is None else r[2][1]) for r in best if r[1] == k}
        least = [reached.get(q, (0, NO_ID)) for q in range(len(query.number))]
        pairs = materialise(_pairs(query, blocks, k, least), "candidates")
        if report is not None:
            report["candidates"] = report.get("candidates", 0) + pairs.count()
        numbered = spark.createDataFrame([(q, own[i]) for q, i in enumerate(query.number)], "q long, _text string")
        out.append(_first(_rescored(query, pairs, docs, "rescored"), k, "score").join(numbered, "q"))
    if not out:
        return spark.createDataFrame([], f"item_id {items.schema['item_id'].dataType.simpleString()}, rank int, doc_id long, score long")
    ranked = out[0]
    for more in out[1:]:
        ranked = ranked.unionByName(more)
    return asked.join(ranked, "_text").select("item_id", "rank", "doc_id", "score")
