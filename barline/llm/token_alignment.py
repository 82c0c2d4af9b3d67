"""Alignment of the tokens of two tokenizers over the bytes of each text, by merge-path partitioning.

1.  A text's tokens end at ascending byte offsets, one list for A and one for B.  Merging
    the two lists is a walk through a grid; the walk's crossing of every ``piece``-th diagonal
    is found by a binary search, so a long text is cut into pieces of equal work that know
    nothing of one another.  An end shared by A and B is never parted.
2.  Each piece is overlapped on its own: shared ends cut its tokens into groups, a group's A and
    B tokens are linked.  What lies before a piece's first and behind its last shared end is
    handed out as it is, and these boundaries are stitched into groups in the text's order.
    A text of one piece is overlapped where it was encoded; pieces of longer texts are dealt to
    tasks.
3.  Links are kept as distinct id pairs with their number, each group's ids counted first, so a
    group with many equal tokens costs its distinct pairs.  Texts are taken in batches of
    bounded bytes; a batch's distinct pairs are counted over the corpus and come back to the
    batch once, not to each of its texts.

Tokens are checked: where the bytes of A or B, joined, aren't a space and the text, the text
has no tokens and all its numbers are zero.  So have null and empty texts.  Rows that repeat a
doc_id, or have none, are documents of their own and each counts.  Texts of any length are
encoded whole by one call of the libraries; other columns are not read; an empty table
gives an empty one.
"""

from __future__ import annotations

import hashlib
import json
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from barline.llm.shared import materialise, text_or_empty
from barline.llm.tokens import BYTE_CHARS, PRINTABLE

#: Bytes of text, and documents, of one batch.
BATCH_BYTES, BATCH_DOCS = 8 << 20, (1 << 20) - 2
#: Steps of the merge in one piece.
PIECE = 1 << 15


class ByteTokenizer:
    """Side A: a byte-level BPE file of ``tokenizers``.

    Ids in the order of the merges are ranks, which ``tiktoken`` encodes by, several times
    faster; any other file, and any text that it refuses, goes through ``tokenizers``.
    """

    PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"

    def __init__(self, path: str):
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.slow = Tokenizer.from_file(path)
        self.slow.encode_special_tokens = True
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        letters = {chr(BYTE_CHARS.get(b, b)): b for b in range(256)}
        spelt = {i: t for t, i in self.slow.get_vocab(with_added_tokens=True).items()}
        special = {t["id"] for t in spec["added_tokens"]}
        own = lambda i, t: t.encode() if i in special or any(c not in letters for c in t) else bytes(letters[c] for c in t)
        self.bytes = [own(i, spelt[i]) if i in spelt else b"" for i in range(max(spelt) + 1)]
        self.fast = self._ranked(spec, special)

    def _ranked(self, spec: dict, special: set[int]):
        import tiktoken

        model, cut = spec["model"], spec.get("pre_tokenizer") or {}
        merged = [model["vocab"]["".join(m) if isinstance(m, list) else m.replace(" ", "", 1)] for m in model["merges"]]
        first = [i for t, i in model["vocab"].items() if len(t) == 1]
        plain = spec.get("normalizer") is None and cut.get("type") == "ByteLevel" and cut.get("use_regex", True) and not cut.get("add_prefix_space")
        if not plain or merged != sorted(merged) or max(first) >= merged[0] or len(first) != 256 or model.get("ignore_merges"):
            return None
        ranks = {self.bytes[i]: i for i in model["vocab"].values() if i not in special}
        return tiktoken.Encoding("a", pat_str=self.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def encode(self, text: str) -> list[int]:
        if self.fast is not None:
            try:
                return self.fast.encode_ordinary(text)
            except ValueError:
                pass
        return self.slow.encode(text, add_special_tokens=False).ids


class PieceTokenizer:
    """Side B: a SentencePiece model."""

    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        n = self.model.get_piece_size()
        byte = lambda i: bytes([int(self.model.id_to_piece(i)[3:5], 16)])
        self.bytes = [byte(i) if self.model.is_byte(i) else self.model.id_to_piece(i).replace("▁", " ").encode() for i in range(n)]

    def encode(self, text: str) -> list[int]:
        return self.model.encode(text)


class Side:
    """Ids with their bytes, for many tokens at once."""

    def __init__(self, tokenizer):
        self.encode = tokenizer.encode
        self.table = pa.array(tokenizer.bytes, pa.large_binary())
        self.sizes = np.array([len(b) for b in tokenizer.bytes], np.int64)

    def spells(self, ids: np.ndarray, data: bytes) -> bool:
        """Whether the tokens, each of a byte or more, are the bytes ``data``."""
        sizes = self.sizes[ids]
        return bool(len(ids)) and sizes.min() > 0 and int(sizes.sum()) == len(data) and joined(self.table, ids) == data


def joined(table: pa.Array, at: np.ndarray) -> bytes:
    """The entries of ``table`` at these places, as one string: they lie side by side in the taken array."""
    if not len(at):
        return b""
    taken = table.take(pa.array(at))
    ends = np.frombuffer(taken.buffers()[1], np.int64, len(at) + 1, 0)
    return taken.buffers()[2][int(ends[0]) : int(ends[-1])].to_pybytes()


_SIDES: dict[str, Side] = {}


def _side(path: str) -> Side:
    """This worker's tokenizer for a file."""
    if path not in _SIDES:
        _SIDES[path] = Side((ByteTokenizer if path.endswith(".json") else PieceTokenizer)(path))
    return _SIDES[path]


def merge_path(a: np.ndarray, b: np.ndarray, piece: int) -> list[tuple[int, int]]:
    """Where the merge of ascending ``a`` and ``b`` crosses every ``piece``-th diagonal: how many of each lie before.

    All diagonals are searched at once.  Equal ends go together, so a crossing may lie one
    step behind its diagonal.
    """
    d = np.arange(piece, len(a) + len(b), piece)
    low, high = np.maximum(0, d - len(b)), np.minimum(d, len(a))
    a_, b_ = (np.append(x, np.iinfo(np.int64).max) for x in (a, b))
    while (open_ := low < high).any():
        mid = (low + high) // 2
        before = open_ & (a_[mid] <= b_[np.maximum(d - 1 - mid, 0)])
        low, high = np.where(before, mid + 1, low), np.where(open_ & ~before, mid, high)
    i, j = low, d - low
    pair = (i > 0) & (j < len(b)) & (a_[np.maximum(i - 1, 0)] == b_[j])
    return list(dict.fromkeys([(0, 0), *zip(i.tolist(), (j + pair).tolist(), strict=True), (len(a), len(b))]))


_MARKS: list[pa.Array] = []


def groups_text(a: np.ndarray, ga: np.ndarray, b: np.ndarray, gb: np.ndarray) -> bytes:
    """``a1,a2|b1;`` for each group in order; ga and gb ascend."""
    top = int(max(a.max(initial=0), b.max(initial=0))) + 1
    if not _MARKS or len(_MARKS[0]) < 3 * top:
        _MARKS[:] = [pa.array([f"{i}{s}".encode() for i in range(max(top, 1 << 16)) for s in ",|;"], pa.large_binary())]
    code = np.empty(len(a) + len(b), np.int64)
    last = lambda g: np.append(g[1:] != g[:-1], True)
    code[np.arange(len(a)) + np.searchsorted(gb, ga, "left")] = 3 * a + last(ga)
    code[np.arange(len(b)) + np.searchsorted(ga, gb, "right")] = 3 * b + 2 * last(gb)
    return joined(_MARKS[0], code)


def linked_pairs(a: np.ndarray, ga: np.ndarray, b: np.ndarray, gb: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct id pairs, packed, and the number of links of each."""
    ka, ca = np.unique(ga << 32 | a, return_counts=True)
    kb, cb = np.unique(gb << 32 | b, return_counts=True)
    first, end = (np.searchsorted(kb >> 32, ka >> 32, side) for side in ("left", "right"))
    n = end - first
    left = np.repeat(np.arange(len(ka)), n)
    right = np.arange(len(left)) - np.repeat(np.cumsum(n) - n, n) + first[left]
    return summed((ka[left] & 0xFFFFFFFF) << 32 | kb[right] & 0xFFFFFFFF, ca[left] * cb[right])


def summed(keys: np.ndarray, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, ascending, and the sum of the numbers of each."""
    if not len(keys):
        return keys, numbers
    order = np.argsort(keys, kind="stable")
    keys, numbers = keys[order], numbers[order]
    new = np.flatnonzero(np.append(True, keys[1:] != keys[:-1]))
    return keys[new], np.add.reduceat(numbers, new)


class Piece:
    """A piece overlapped on its own: what lies before its first shared end, its inner groups, and what lies behind the last."""

    def __init__(self, a: np.ndarray, a_end: np.ndarray, b: np.ndarray, b_end: np.ndarray, whole: bool):
        shared = np.intersect1d(a_end, b_end, assume_unique=True)
        ga, gb = np.searchsorted(shared, a_end), np.searchsorted(shared, b_end)
        n, skip = len(shared), 0 if whole else 1
        cut = lambda ids, g: (ids[g < skip], ids[(g >= skip) & (g < n)], ids[g >= max(n, skip)])
        self.closed = n > 0
        head, inner, tail = zip(cut(a, ga), cut(b, gb), strict=True)
        self.head, self.tail = (head, tail) if n else ((a, b), (a[:0], b[:0]))
        self.n_groups = max(0, n - skip)
        g = [x[(x >= skip) & (x < n)] for x in (ga, gb)]
        self.text = groups_text(inner[0], g[0], inner[1], g[1]) if self.n_groups else b""
        self.keys, self.numbers = linked_pairs(inner[0], g[0], inner[1], g[1]) if self.n_groups else (np.zeros(0, np.int64),) * 2


class Batch:
    """Documents with their pairs until a batch is full."""

    def __init__(self, number: int):
        self.number, self.docs, self.bytes = number, [], 0

    def add(self, doc_id, n_a: int, n_b: int, n_groups: int, text: bytes, keys: np.ndarray, numbers: np.ndarray, n_bytes: int) -> None:
        sha = hashlib.sha256(text[:-1]).hexdigest() if text else ""
        self.docs.append((doc_id, n_a, n_b, n_groups, sha, keys, numbers))
        self.bytes += n_bytes

    def full(self) -> bool:
        return self.bytes >= BATCH_BYTES or len(self.docs) >= BATCH_DOCS

    def rows(self) -> pa.RecordBatch:
        """A row per document, whose pairs are places in the batch's list of keys, and one with that list and the number of documents that hold each."""
        doc_id, n_a, n_b, n_groups, sha, keys, numbers = zip(*self.docs, strict=True)
        every, held = np.unique(np.concatenate(keys), return_counts=True)
        n, none = len(self.docs), np.zeros(0, np.int64)
        return pa.RecordBatch.from_arrays(
            [
                pa.array(np.full(n + 1, self.number)),
                pa.array([*doc_id, None], pa.int64()),
                *(pa.array([*x, 0], pa.int64()) for x in (n_a, n_b, n_groups)),
                pa.array([*sha, ""], pa.string()),
                _lists([np.searchsorted(every, k) for k in keys] + [none], pa.int32()),
                _lists([*numbers, none], pa.int64()),
                _lists([none] * n + [every], pa.int64()),
                _lists([none] * n + [held], pa.int64()),
                pa.array([False] * n + [True]),
            ],
            names=_ROW_NAMES,
        )


def _lists(parts: list[np.ndarray], of: pa.DataType) -> pa.Array:
    ends = np.cumsum([0, *map(len, parts)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(parts).astype(np.int64)).cast(of))


_ROW = "batch long, doc_id long, n_a long, n_b long, n_groups long, groups_sha256 string, places array<int>, numbers array<long>, keys array<long>, held array<long>, listed boolean"
_ROW_NAMES = [c.split()[0] for c in _ROW.split(", ")]
_CUT = pa.schema([("batch", pa.int64()), ("doc_id", pa.int64()), ("piece", pa.int32()), ("a", pa.binary()), ("a_from", pa.int64()), ("b", pa.binary()), ("b_from", pa.int64())])
_OVERLAP = pa.schema(
    [("batch", pa.int64()), ("doc_id", pa.int64()), ("piece", pa.int32()), ("n_a", pa.int64()), ("n_b", pa.int64()), ("closed", pa.bool_()), ("n_groups", pa.int64()), ("text", pa.binary())]
    + [(c, pa.binary()) for c in ("head_a", "head_b", "tail_a", "tail_b")]
    + [("keys", pa.list_(pa.int64())), ("numbers", pa.list_(pa.int64()))]
)
_OVERLAP_SQL = "batch long, doc_id long, piece int, n_a long, n_b long, closed boolean, n_groups long, text binary, head_a binary, head_b binary, tail_a binary, tail_b binary, keys array<long>, numbers array<long>"
RESULT = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"

packed = lambda ids: ids.astype("<i4").tobytes()
unpacked = lambda data: np.frombuffer(data, "<i4").astype(np.int64)


def encoded(docs: DataFrame, a_path: str, b_path: str, piece: int = PIECE) -> DataFrame:
    """Texts of one piece as rows of batches, the pieces of others with ``piece`` set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        a_side, b_side = _side(a_path), _side(b_path)
        none, here = np.zeros(0, np.int64), TaskContext.get().partitionId() << 32
        made, batch = 0, Batch(here)
        for rows in batches:
            for doc, text in zip(rows.column("doc_id").to_pylist(), rows.column("text"), strict=True):
                text = text.as_py()
                data = b" " + text.encode()
                a, b = (np.array(s.encode(t) if text else [], np.int64) for s, t in ((a_side, " " + text), (b_side, text)))
                if not (a_side.spells(a, data) and b_side.spells(b, data)):
                    batch.add(doc, 0, 0, 0, b"", none, none, len(data))
                elif len(cuts := merge_path(a_end := np.cumsum(a_side.sizes[a]), b_end := np.cumsum(b_side.sizes[b]), piece)) == 2:
                    whole = Piece(a, a_end, b, b_end, True)
                    batch.add(doc, len(a), len(b), whole.n_groups, whole.text, whole.keys, whole.numbers, len(data))
                else:
                    made += 1
                    for k, ((i, j), (m, n)) in enumerate(zip(cuts, cuts[1:], strict=False)):
                        start = [int(e[x - 1]) if x else 0 for e, x in ((a_end, i), (b_end, j))]
                        yield _both(cut=[here + made, doc, k, packed(a[i:m]), start[0], packed(b[j:n]), start[1]])
                if batch.full():
                    yield _both(rows=batch.rows())
                    made += 1
                    batch = Batch(here + made)
        if batch.docs:
            yield _both(rows=batch.rows())

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")).mapInArrow(run, f"{_ROW}, piece int, a binary, a_from long, b binary, b_from long")


def _both(rows: pa.RecordBatch | None = None, cut: list | None = None) -> pa.RecordBatch:
    """Rows of a batch without a piece, or a piece without the columns of a batch's rows."""
    if rows is not None:
        empty = [pa.nulls(rows.num_rows, f.type) for f in list(_CUT)[2:]]
        return pa.RecordBatch.from_arrays([*rows.columns, *empty], names=[*_ROW_NAMES, *_CUT.names[2:]])
    lists = {"places": pa.int32(), "numbers": pa.int64(), "keys": pa.int64(), "held": pa.int64()}
    kinds = {"groups_sha256": pa.string(), "listed": pa.bool_()} | {c: pa.list_(t) for c, t in lists.items()}
    blank = [pa.nulls(1, kinds.get(c, pa.int64())) for c in _ROW_NAMES[2:]]
    own = [pa.array([v], f.type) for v, f in zip(cut, _CUT, strict=True)]
    return pa.RecordBatch.from_arrays([*own[:2], *blank, *own[2:]], names=[*_ROW_NAMES, *_CUT.names[2:]])


def overlapped(pieces: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """Each piece with its inner groups and its open ends; it needs no other piece."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes = [_side(p).sizes for p in (a_path, b_path)]
        for rows in batches:
            for r in rows.to_pylist():
                a, b = unpacked(r["a"]), unpacked(r["b"])
                p = Piece(a, r["a_from"] + np.cumsum(sizes[0][a]), b, r["b_from"] + np.cumsum(sizes[1][b]), False)
                own = [r["batch"], r["doc_id"], r["piece"], len(a), len(b), p.closed, p.n_groups, p.text, *map(packed, (*p.head, *p.tail)), p.keys, p.numbers]
                yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(own, _OVERLAP, strict=True)], schema=_OVERLAP)

    return pieces.repartition("batch", "piece").mapInArrow(run, _OVERLAP_SQL)


def stitched(overlaps: DataFrame) -> DataFrame:
    """Texts of several pieces as batches of their own: an open end and the next piece's head make one group."""

    def stitch(table: pa.Table) -> pa.Table:
        parts = table.sort_by("piece").to_pylist()
        texts, keys, numbers, n_groups = [], [], [], 0
        held_a, held_b = [], []
        for p in parts:
            held_a.append(unpacked(p["head_a"]))
            held_b.append(unpacked(p["head_b"]))
            if p["closed"]:
                a, b = np.concatenate(held_a), np.concatenate(held_b)
                ga, gb = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
                k, n = linked_pairs(a, ga, b, gb)
                texts += [groups_text(a, ga, b, gb), p["text"]]
                keys += [k, np.array(p["keys"], np.int64)]
                numbers += [n, np.array(p["numbers"], np.int64)]
                n_groups += 1 + p["n_groups"]
                held_a, held_b = [unpacked(p["tail_a"])], [unpacked(p["tail_b"])]
        batch = Batch(parts[0]["batch"])
        total = [sum(p[c] for p in parts) for c in ("n_a", "n_b")]
        batch.add(parts[0]["doc_id"], *total, n_groups, b"".join(texts), *summed(np.concatenate(keys), np.concatenate(numbers)), 0)
        return pa.Table.from_batches([batch.rows()])

    return overlaps.groupBy("batch").applyInArrow(stitch, _ROW)


def align(docs: DataFrame, a_path: str, b_path: str, piece: int = PIECE) -> DataFrame:
    """One row per row of (doc_id, text): numbers of tokens, groups and links, and the links' counts over the corpus.

    A pair's count is the number of documents that hold it linked.  n_best counts the links
    whose count is the highest of their A id, ties included; count_sum sums counts over links.
    groups_sha256 is the digest of the groups in order, ``a1,a2|b1;a3|b2,b3``; '' without tokens.
    """
    out = materialise(encoded(docs, a_path, b_path, piece), "encoded")
    long = materialise(stitched(overlapped(out.where(F.col("piece").isNotNull()).select(*_CUT.names), a_path, b_path)), "stitched")
    rows = out.where(F.col("piece").isNull()).select(*_ROW_NAMES).unionByName(long)
    lists = rows.where("listed")
    counts = lists.select(F.inline(F.arrays_zip("keys", "held"))).groupBy("keys").agg(F.sum("held").alias("n"))
    of_a = Window.partitionBy(F.shiftright("keys", 32))
    counts = counts.select(F.col("keys").alias("key"), "n", (F.col("n") == F.max("n").over(of_a)).alias("best"))
    priced = lists.select(F.col("batch").alias("of"), F.posexplode("keys").alias("place", "key")).join(counts, "key").select("of", "place", "n", "best")

    def price(own: pa.Table, prices: pa.Table) -> pa.Table:
        place, n, best = (prices.column(c).to_numpy() for c in ("place", "n", "best"))
        counted, leading = np.zeros(len(place), np.int64), np.zeros(len(place), np.int64)
        counted[place], leading[place] = n, best
        places, numbers = (own.column(c).combine_chunks() for c in ("places", "numbers"))
        of = np.repeat(np.arange(len(places)), places.value_lengths().to_numpy())
        at, times = places.flatten().to_numpy(), numbers.flatten().to_numpy()
        sums = []
        for value in (times, times * leading[at], times * counted[at]):
            total = np.zeros(len(places), np.int64)
            np.add.at(total, of, value)
            sums.append(pa.array(total))
        return pa.Table.from_arrays([*(own.column(c) for c in ("doc_id", "n_a", "n_b", "n_groups")), *sums, own.column("groups_sha256")], names=[c.split()[0] for c in RESULT.split(", ")])

    texts = rows.where(~F.col("listed")).select("batch", "doc_id", "n_a", "n_b", "n_groups", "groups_sha256", "places", "numbers")
    return texts.groupBy("batch").cogroup(priced.groupBy("of")).applyInArrow(price, RESULT)
