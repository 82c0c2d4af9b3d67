"""SentencePiece encoding and decoding with a batched numpy Viterbi.

Texts are cut at spaces into words (a ``▁`` and what follows it), each worker keeps the ids
of words it met, and new words of equal length advance together through one lattice.
The hash of every substring, from prefix hashes, probes the sorted keys of the pieces.  For
each end position the best arc is a vectorised maximum, and its start the backpointer.

*Unigram models*: an arc's value is its start's value plus the piece's score.
*BPE models*: merging yields exactly one segmentation, the only one in which every piece
is what merging makes of its own letters and every two neighbours stay apart when their
letters are merged together.  So an arc is admitted if its piece and the piece that its
start ends with stay apart, which unwinding both pieces' merges tells, and the admitted arc
is picked; what was told of a pair is kept in a table of fixed size.  A word whose last position no arc reaches, or that begins with several
spaces (those pieces tie in rank), is merged step by step.

Letters without a piece become byte pieces.  Null text counts as empty; an empty text has no ids.
"""

from __future__ import annotations

import heapq
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barline.llm.shared import text_or_empty

SPACE = "▁"
_B = np.uint64(0x100000001B3 * 0x9E3779B1 % (1 << 64) | 1)
#: Spreads letters over all bits, so that the first bits of short pieces' hashes differ as well.
_C = np.uint64(0x9E3779B97F4A7C15)
#: Pairs of pieces of which a worker knows whether they stay apart: a power of 2.
PAIRS = 1 << 20
#: Words of a generation of the cache: the younger one holds what was used since it began, the older one what was used before.
CACHE_WORDS = 400_000
NEVER = 1 << 40
#: Documents whose words or ids are held as Python objects at once.
SLICE = 250


class Pieces:
    """The pieces of a model file, their keys, merges, and the words met so far."""

    def __init__(self, path: str, bpe: bool = True):
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        n = sp.get_piece_size()
        self.bpe = bpe
        self.bytes_of = [b""] * n
        self.byte_id = {}
        self.score: dict[str, float] = {}
        self.id: dict[str, int] = {}
        for i in range(n):
            piece = sp.id_to_piece(i)
            if sp.is_byte(i):
                self.byte_id[int(piece[3:5], 16)] = i
                self.bytes_of[i] = bytes([int(piece[3:5], 16)])
            elif not sp.is_control(i) and not sp.is_unknown(i):
                self.bytes_of[i] = piece.replace(SPACE, " ").encode()
                self.id[piece] = i
                self.score[piece] = sp.get_score(i)
        self.unknown = sp.unk_id()
        ranks = {s: r for r, s in enumerate(sorted(set(self.score.values()), reverse=True))}
        self.rank = np.full(n + 1, -1, np.int64)
        for piece, i in self.id.items():
            if len(piece) > 1:
                self.rank[i] = ranks[self.score[piece]]
        self.longest = max(map(len, self.id))
        if bpe:
            self._learn_merges(n)
        usable = [p for p, i in self.id.items() if not bpe or len(p) == 1 or self.left[i] >= 0]
        self.keys = np.array([self._key(p) for p in usable], np.uint64)
        order = np.argsort(self.keys)
        self.keys, self.key_ids = self.keys[order], np.array([self.id[p] for p in usable], np.int64)[order]
        self.maybe = np.zeros(1 << 20, bool)  # by a hash's first 20 bits: whether any piece begins so
        self.maybe[self.keys >> np.uint64(44)] = True
        self.first = np.searchsorted(self.keys, np.arange(1 << 20, dtype=np.uint64) << np.uint64(44)).astype(np.int32)  # the first key that begins so
        self.known_pairs = np.full(PAIRS, -1, np.int64)  # by a pair's hash: the pair, and in the last bit whether it stays apart
        self.value = np.zeros(n + 1)
        for piece, i in self.id.items():
            self.value[i] = self.score[piece]
        self.value[n] = min(self.score.values()) - 10
        self.n = n
        self.words: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    @staticmethod
    def _key(piece: str) -> int:
        h = 0
        for c in piece:
            h = (h * int(_B) + (ord(c) + 1) * int(_C)) % (1 << 64)
        return h

    def _learn_merges(self, n: int) -> None:
        """The last merge of each piece that merging makes of its letters, and what every two pieces join to."""
        self.left, self.right = np.full(n + 1, -1, np.int64), np.full(n + 1, -1, np.int64)
        pairs: dict[int, int] = {}
        for piece, i in self.id.items():
            for k in range(1, len(piece)):
                a, b = self.id.get(piece[:k]), self.id.get(piece[k:])
                if a is not None and b is not None:
                    pairs[a << 20 | b] = i
            if len(piece) > 1:
                made = self.merged(piece, history := [])
                if len(made) == 1 and history:
                    self.left[i], self.right[i] = self.id[history[-1][0]], self.id[history[-1][1]]
        self.pair_keys = np.array(sorted(pairs), np.int64)
        self.pair_rank = self.rank[np.array([pairs[k] for k in sorted(pairs)], np.int64)]

    def merged(self, word: str, history: list | None = None) -> list[str]:
        """The pieces of a word by merging step by step: the best score first, then the leftmost."""
        symbols = list(word)
        after, before = list(range(1, len(symbols) + 1)), list(range(-1, len(symbols) - 1))
        heap: list[tuple[float, int, int, str]] = []

        def offer(i: int) -> None:
            if 0 <= i and after[i] < len(symbols):
                both = symbols[i] + symbols[after[i]]
                if both in self.score:
                    heapq.heappush(heap, (-self.score[both], i, after[i], both))

        for i in range(len(symbols) - 1):
            offer(i)
        while heap:
            _, i, j, both = heapq.heappop(heap)
            if after[i] != j or symbols[i] is None or symbols[j] is None or symbols[i] + symbols[j] != both:
                continue
            if history is not None:
                history.append((symbols[i], symbols[j]))
            symbols[i], symbols[j], after[i] = both, None, after[j]
            if after[j] < len(symbols):
                before[after[j]] = i
            offer(before[i])
            offer(i)
        return [s for s in symbols if s is not None]

    def apart(self, u: np.ndarray, v: np.ndarray) -> np.ndarray:
        """Whether pieces u and v stay apart when the letters of both are merged."""
        u, v = u.copy(), v.copy()
        limit = np.full(len(u), NEVER, np.int64)
        out, live = np.ones(len(u), bool), np.arange(len(u))
        while len(live):
            key = u[live] << 20 | v[live]
            k = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
            joins = (self.pair_keys[k] == key) & (self.pair_rank[k] < limit[live])
            out[live[joins]] = False
            live = live[~joins]
            ru, rv = self.rank[u[live]], self.rank[v[live]]
            go_on = (ru >= 0) | (rv >= 0)
            live, ru, rv = live[go_on], ru[go_on], rv[go_on]
            first = ru > rv  # the piece made last is unwound; of equal ones the right one was
            a, b = live[first], live[~first]
            limit[a], limit[b] = ru[first], rv[~first] + 1
            u[a], v[b] = self.right[u[a]], self.left[v[b]]
        return out

    def stay_apart(self, u: np.ndarray, v: np.ndarray) -> np.ndarray:
        """``apart``, worked out once for a pair as long as no other pair takes its place."""
        pair = u << 20 | v
        place = (pair * 0x2545F4914F6CDD1D >> 40) & (PAIRS - 1)
        known = self.known_pairs[place]
        miss = np.flatnonzero(known >> 1 != pair)
        if len(miss):
            new, back = np.unique(pair[miss], return_inverse=True)
            told = new << 1 | self.apart(new >> 20, new & ((1 << 20) - 1))
            known[miss] = told[back]
            self.known_pairs[place[miss]] = known[miss]
        return (known & 1).astype(bool)

    def _found(self, hashes: np.ndarray) -> np.ndarray:
        """The pieces of these hashes, -1 where there is none."""
        at = np.minimum(self.first[hashes >> np.uint64(44)], len(self.keys) - 1)
        miss = np.flatnonzero(self.keys[at] != hashes)  # another piece's, or several begin so
        at[miss] = np.minimum(np.searchsorted(self.keys, hashes[miss]), len(self.keys) - 1)
        return np.where(self.keys[at] == hashes, self.key_ids[at], -1)

    def lattice(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """For words of one length, by end position and word: the last piece there and its start; -1 at the words' start, -2 where no arc ends."""
        length, count = len(words[0]), len(words)
        code = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32).reshape(count, length).T.astype(np.uint64)
        code = (code + np.uint64(1)) * _C
        prefix = np.zeros((length + 1, count), np.uint64)
        for j in range(length):
            prefix[j + 1] = prefix[j] * _B + code[j]
        power = np.array([pow(int(_B), k, 1 << 64) for k in range(self.longest, 0, -1)], np.uint64)[:, None]
        best = np.full((length + 1, count), -np.inf)
        best[0] = 0
        last, back = np.full((length + 1, count), -2, np.int64), np.zeros((length + 1, count), np.int32)
        last[0] = -1
        for j in range(1, length + 1):
            low = max(0, j - self.longest)
            h = prefix[j] - prefix[low:j] * power[low - j :]
            at = np.flatnonzero(self.maybe[h >> np.uint64(44)])
            piece = self._found(h.ravel()[at])
            at, piece = at[piece >= 0], piece[piece >= 0]
            bare = np.ones(count, bool)  # words whose letter here has no piece
            bare[at[np.searchsorted(at, (j - 1 - low) * count) :] - (j - 1 - low) * count] = False
            bare = np.flatnonzero(bare)
            at, piece = np.concatenate([at, bare + (j - 1 - low) * count]), np.concatenate([piece, np.full(len(bare), self.n)])
            before = last[low:j].ravel()[at]
            there = before > -2
            if self.bpe:
                check = (before >= 0) & (before < self.n) & (piece < self.n)
                there[check] = self.stay_apart(before[check], piece[check])
                at, piece = at[there][::-1], piece[there][::-1]  # the longest piece is written last
                word = at % count
            else:
                at, piece = at[there], piece[there]
                value = np.full((j - low, count), -np.inf)
                value.ravel()[at] = best[low:j].ravel()[at] + self.value[piece]
                taken = value.argmax(0)
                best[j] = value[taken, np.arange(count)]
                chosen = taken[at % count] == at // count
                at, piece = at[chosen], piece[chosen]
                word = at % count
            last[j, word], back[j, word] = piece, at // count + low
        return last, back

    def coded(self, words: list[str]) -> list[bytes]:
        """Ids of words of one length, as 32-bit integers."""
        length, count = len(words[0]), len(words)
        last, back = self.lattice(words)
        whole = last[length] > -2
        ids, steps = np.full((count, length), -1, np.int32), np.zeros(count, np.int64)
        live, at = np.flatnonzero(whole), np.full(whole.sum(), length)
        for k in range(length - 1, -1, -1):  # from the right, as the last piece is met first
            if not len(live):
                break
            ids[live, k] = last[at, live]
            steps[live] += 1
            at = back[at, live]
            live, at = live[at > 0], at[at > 0]
        bare = (ids == self.n).any(1)
        flat, ends = ids.tobytes(), np.arange(1, count + 1) * (4 * length)
        out = [flat[a:b] for a, b in zip((ends - 4 * steps).tolist(), ends.tolist(), strict=True)]
        for r in np.flatnonzero(~whole):
            out[r] = array("i", self._ids(self.merged(words[r]))).tobytes()
        for r in np.flatnonzero(bare):
            own: list[int] = []
            j = length
            while j:
                i, start = int(last[j, r]), int(back[j, r])
                own += [i] if i < self.n else self._ids([words[r][j - 1]])[::-1]
                j = start
            out[r] = array("i", own[::-1]).tobytes()
        return out

    def viterbi(self, words: list[str]) -> list[list[int]]:
        """Ids of words of one length."""
        return [array("i", ids).tolist() for ids in self.coded(words)]

    def _ids(self, pieces: list[str]) -> list[int]:
        return [i for p in pieces for i in ([self.id[p]] if p in self.id else [self.byte_id[b] for b in p.encode()] if self.byte_id else [self.unknown])]

    def learn(self, words: list[str]) -> None:
        by_length: dict[int, list[str]] = {}
        for w in words:
            if self.bpe and w[:1] == SPACE:
                self.words[w] = array("i", self._ids(self.merged(SPACE + w))).tobytes()
            else:
                by_length.setdefault(len(w), []).append(w)
        for some in by_length.values():
            step = max(1, 1_600_000 // (len(some[0]) + 1) // self.longest)
            for at in range(0, len(some), step):
                part = some[at : at + step]
                self.words.update(zip(part, self.coded([SPACE + w for w in part]), strict=True))

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text, as 32-bit integers."""
        cut = [_words(t) for t in texts]
        if len(self.words) > CACHE_WORDS:
            self.older, self.words = self.words, {}
        known, older = self.words, self.older
        new = [w for w in set().union(*cut) if w not in known]
        known.update((w, older[w]) for w in new if w in older)
        self.learn([w for w in new if w not in known])
        return [b"".join(map(known.__getitem__, words)) for words in cut]

    def decode(self, ids: list[int]) -> str:
        text = b"".join(map(self.bytes_of.__getitem__, ids))
        return (text[1:] if text[:1] == b" " else text).decode("utf-8", "replace")


def _words(text: str) -> list[str]:
    """The words of a text; what a word's own mark doesn't need of several spaces stands before it as marks."""
    if not text:
        return []
    words = text.split(" ")
    if "" not in words:
        return words
    out, marks = [], 0
    for k, w in enumerate(words):
        if not w and k < len(words) - 1:
            marks += 1
        else:
            out.append(SPACE * marks + w)
            marks = 0
    return out


_LOADED: dict[tuple[str, bool], Pieces] = {}


def pieces(path: str, bpe: bool = True) -> Pieces:
    """This worker's pieces of a model file."""
    if (path, bpe) not in _LOADED:
        _LOADED[path, bpe] = Pieces(path, bpe)
    return _LOADED[path, bpe]


def _own(df: DataFrame, *drop: str) -> tuple[list[str], str]:
    own = [c for c in df.columns if c not in drop]
    return own, ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema if f.name in own)


def encode(docs: DataFrame, model_path: str, bpe: bool = True) -> DataFrame:
    """The columns of ``docs`` and ids, the pieces of the whole text."""
    docs = docs.withColumn("text", text_or_empty())
    own, schema = _own(docs, "ids")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pieces(model_path, bpe)
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                flat = model.encode(part.column("text").to_pylist())
                ends = np.cumsum([0, *(len(x) // 4 for x in flat)])
                ids = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(flat), np.int32)))
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in own), ids], names=[*own, "ids"])

    return docs.select(*own).mapInArrow(run, f"{schema}, ids array<int>")


def decode(encoded: DataFrame, model_path: str, into: str = "decoded") -> DataFrame:
    """The columns of ``encoded`` and the text that its ids stand for."""
    own, schema = _own(encoded, into)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = pieces(model_path)
        for batch in batches:
            for at in range(0, batch.num_rows, SLICE):
                part = batch.slice(at, SLICE)
                texts = [model.decode(ids.values.to_numpy(zero_copy_only=False).tolist() if ids.is_valid else []) for ids in part.column("ids")]
                yield pa.RecordBatch.from_arrays([*(part.column(c) for c in own), pa.array(texts, pa.string())], names=[*own, into])

    return encoded.select(*own).mapInArrow(run, f"{schema}, {into} string")
