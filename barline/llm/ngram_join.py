"""Join of texts whose word n-grams have a Jaccard similarity of at least a threshold.

1.  Each text's set of hashed word n-grams gives ``TREES`` signatures of ``DEPTH`` MinHash
    values: an LSH forest.  Each tree is a trie of its signatures, held as sorted prefixes.
2.  How far prefixes are shortened is measured: a bounded sample of texts is compared with
    all others by whole signatures, and the depth falls from ``DEPTH`` until the share of
    the sample's pairs that meet in some tree reaches the target recall.  It falls at least
    to the depth at which a pair exactly at the threshold reaches the target, whatever the sample.
3.  Texts that share the shortest prefix of a tree are one subtrie.  It is climbed from its
    leaves: texts with the longest common prefix are compared first, by whole signatures;
    a prefix is shortened only while its texts are not yet one component.  Since the share of
    differing values is a metric, a text too far from a component's pivot for its radius is
    not compared with the members, so a dense group costs its size, not its square.
4.  A subtrie of over ``BLOCK`` texts is cut into blocks that are climbed alone; only if that
    leaves it in several components, its blocks meet in pairs.
5.  Connected candidates are a cluster.  Clusters are verified exactly on the sets of
    n-grams, in tiles of bounded numbers of n-grams; tiles return link counts and spanning
    links, not pairs.

Words are lower-cased runs of word characters; texts of any length are read whole.  A text
of fewer than n words has one n-gram, all its words; a text without words, null or empty,
links with nothing.  Equal texts are one class with several documents, each linked with all
others.  Rows that repeat a doc_id are documents of their own.  A row without doc_id links
like any other; class_id is null, and ``kept`` true, only where no document of the class has
an id.  Other columns are not read.  An empty table gives an empty result.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barline.llm.components import components
from barline.llm.shared import BITS, bit_set, groups, in_bit_set, local_roots, materialise, text_or_empty, tiles

WORD = re.compile(r"\w+")
TREES, DEPTH = 16, 8
#: Texts of a block of signatures; texts and n-grams of a block of sets.
BLOCK, SET_BLOCK, SET_GRAMS = 1024, 512, 400_000
#: Texts of the sample on which recall is measured.
SAMPLE = 256
#: Standard deviations that a signature's estimate may lie below the threshold.
SLACK = 4.5
#: Words whose hashes a worker keeps.
KEPT_WORDS = 1 << 17


class _Words(dict):
    """Hashes of words, kept by a worker up to a bound."""

    def __missing__(self, word: str) -> int:
        h = xxhash.xxh3_64_intdigest(word)
        if len(word) <= 32:
            if len(self) >= KEPT_WORDS:
                self.clear()
            self[word] = h
        return h


_WORDS = _Words()


def shingles(text: str, n: int = 5) -> np.ndarray:
    """The sorted set of hashed word n-grams."""
    words = WORD.findall(text.lower())
    if not words:
        return np.zeros(0, np.uint64)
    h = np.fromiter(map(_WORDS.__getitem__, words), np.uint64, len(words))
    k = min(n, len(h))
    out = np.zeros(len(h) - k + 1, np.uint64)
    for i in range(k):
        out = (out ^ h[i : len(h) - k + 1 + i]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(29)
    return np.unique(out)


def _multipliers(count: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(20240501)
    return rng.integers(1, 1 << 63, count, np.uint64) * np.uint64(2) + np.uint64(1), rng.integers(0, 1 << 63, count, np.uint64)


def signature(grams: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The least 32 high bits of each hash function over the set."""
    best = np.full(len(a), 0xFFFFFFFF, np.uint64)
    for at in range(0, len(grams), 2048):
        best = np.minimum(best, ((grams[at : at + 2048, None] * a + b) >> np.uint64(32)).min(0))
    return best.astype(np.uint32)


def _signatures(column) -> np.ndarray:
    """Rows of values, from the binary column of a batch or table."""
    return np.frombuffer(b"".join(column.to_pylist()), "<u4").reshape(-1, TREES * DEPTH)


def shared_depth(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For pairs of signatures: the longest prefix that they share in some tree."""
    same = (a == b).reshape(len(a), TREES, DEPTH)
    return np.logical_and.accumulate(same, axis=2).sum(2).max(1)


def stop_depth(threshold: float, target: float, pairs_by_depth: dict[int, int]) -> int:
    """The depth at which shortening ends.

    ``pairs_by_depth`` counts sampled pairs by the longest prefix that they share.  The depth
    falls while the measured recall, or the chance of a pair at the threshold, is below the target.
    """
    total = sum(pairs_by_depth.values())
    d = DEPTH
    while d > 1:
        measured = sum(n for k, n in pairs_by_depth.items() if k >= d) / total if total else 1.0
        if measured >= target and 1 - (1 - threshold**d) ** TREES >= target:
            break
        d -= 1
    return d


def sampled_pairs(own: DataFrame, threshold: float, sample: int = SAMPLE) -> dict[int, int]:
    """Pairs of a bounded sample with all texts, at the threshold by their signatures, counted by the prefix they share."""
    drawn = own.orderBy("id").limit(sample).select("id", "sig").collect()
    if not drawn:
        return {}
    ids, sigs = np.array([r["id"] for r in drawn]), _signatures(pa.array([bytes(r["sig"]) for r in drawn]))

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            mine, sig = batch.column("id").to_numpy(), _signatures(batch.column("sig"))
            found = np.zeros(DEPTH + 1, np.int64)
            for at in range(0, len(sig), 1024):
                part = sig[at : at + 1024]
                # Two of 16 values first: a pair at 0.8 has fewer once in 10^9.
                i, j = np.nonzero((part[:, None, :16] == sigs[:, :16]).sum(2, dtype=np.uint8) >= 2)
                i, j = i[mine[at + i] != ids[j]], j[mine[at + i] != ids[j]]
                near = (part[i] == sigs[j]).mean(1) >= threshold
                found += np.bincount(shared_depth(part[i[near]], sigs[j[near]]), minlength=DEPTH + 1)
            yield pa.RecordBatch.from_pydict({"depth": np.arange(DEPTH + 1), "n": found})

    counts = own.select("id", "sig").mapInArrow(meet, "depth long, n long").groupBy("depth").agg(F.sum("n").alias("n")).where("n > 0")
    return {r["depth"]: r["n"] for r in counts.collect()}


def _join_near(label: np.ndarray, sig: np.ndarray, rows: np.ndarray, far: float) -> None:
    """Joins in ``label`` the components of ``rows`` that a pair with at most ``far`` differing values connects."""
    todo = rows
    while len(todo):
        mine = label[todo] == label[todo[0]]
        inside, outside = todo[mine], todo[~mine]
        if not len(outside):
            return
        pivot = sig[inside[0]]
        to_in, to_out = (sig[inside] != pivot).mean(1), (sig[outside] != pivot).mean(1)
        grown = False
        direct = outside[to_out <= far]
        if len(direct):
            for other in np.unique(label[direct]):
                label[label == other] = label[todo[0]]
            grown = True
        else:
            for x, d in zip(outside[to_out <= far + to_in.max()], to_out[to_out <= far + to_in.max()], strict=True):
                near = inside[np.abs(to_in - d) <= far]
                if len(near) and ((sig[near] != sig[x]).mean(1) <= far).any():
                    label[label == label[x]] = label[todo[0]]
                    grown = True
                    break
        if not grown:
            todo = outside


def climb(sig: np.ndarray, tree: int, depth: int, far: float) -> np.ndarray:
    """Component number of each text of a subtrie, whose prefixes are shortened down to ``depth``."""
    label = np.arange(len(sig))
    own = sig[:, tree * DEPTH : (tree + 1) * DEPTH]
    order = np.lexsort(own.T[::-1])
    shared = np.logical_and.accumulate(own[order[1:]] == own[order[:-1]], axis=1).sum(1)
    for d in range(DEPTH, depth - 1, -1):
        starts = np.concatenate([[0], np.flatnonzero(shared < d) + 1, [len(order)]])
        for a, b in zip(starts[:-1], starts[1:], strict=True):
            if b - a > 1 and (label[order[a:b]] != label[order[a]]).any():
                _join_near(label, sig, order[a:b], far)
    return label


def _spanning(ids: np.ndarray, label: np.ndarray) -> pa.RecordBatch | None:
    """Links of each component's texts with its first."""
    lead = ids[label]
    hit = np.bincount(label, minlength=len(ids))[label] > 1
    return pa.RecordBatch.from_pydict({"a": ids[hit], "b": lead[hit]}) if hit.any() else None


def candidates(own: DataFrame, depth: int, far: float) -> DataFrame:
    """(a, b): links that span the candidates among texts (id, sig)."""

    def roots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sig = _signatures(batch.column("sig")).reshape(-1, TREES, DEPTH)[:, :, :depth]
            key = np.arange(TREES, dtype=np.uint64) + np.zeros((len(sig), 1), np.uint64)
            for k in range(depth):
                key = (key ^ sig[:, :, k]) * np.uint64(0x9E3779B97F4A7C15)
                key ^= key >> np.uint64(32)
            ids = np.repeat(batch.column("id").to_numpy(), TREES)
            trees = np.tile(np.arange(TREES, dtype=np.int32), len(sig))
            yield pa.RecordBatch.from_pydict({"id": ids, "tree": trees, "root": key.reshape(-1).view(np.int64)})

    entries = own.select("id", "sig").mapInArrow(roots, "id long, tree int, root long")
    size = materialise(entries.groupBy("tree", "root").agg(F.count("*").alias("n")).where("n > 1"), "roots")
    blocks = F.ceil(F.col("n") / BLOCK).cast("int")
    placed = entries.join(size.select("tree", "root", blocks.alias("blocks")), ["tree", "root"])
    placed = materialise(placed.withColumn("block", F.pmod(F.xxhash64(F.lit(7), "id"), "blocks").cast("int")), "subtries")
    keys = ["tree", "root", "block"]

    def alone(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (tree, _, _), table in groups(batches, keys):
            if (out := _spanning(table.column("id").to_numpy(), climb(_signatures(table.column("sig")), tree, depth, far))) is not None:
                yield out

    signed = own.select("id", "sig")
    dealt = placed.drop("blocks").join(signed, "id").repartition(*keys).sortWithinPartitions(*keys)
    links = materialise(dealt.mapInArrow(alone, "a long, b long").distinct(), "candidates")
    # Subtries of several blocks: their blocks meet only if they are still several components.
    many = placed.where("blocks > 1")
    if not many.isEmpty():
        known = many.join(components(links).withColumnRenamed("component_id", "c"), "id", "left").withColumn("c", F.coalesce("c", "id"))
        open_ = known.groupBy("tree", "root").agg(F.count("*").alias("n"), F.min("c").alias("low"), F.max("c").alias("high")).where("low <> high")
        open_ = materialise(open_.select("tree", "root", "n"), "open-subtries")
        tile = ["tree", "root", "tile_a", "tile_b"]
        paired = tiles(many.select("tree", "root", "id").join(open_.select("tree", "root"), ["tree", "root"]), ["tree", "root"], open_, BLOCK, "id")

        def together(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for (tree, _, _, _), table in groups(batches, tile):
                if (out := _spanning(table.column("id").to_numpy(), climb(_signatures(table.column("sig")), tree, depth, far))) is not None:
                    yield out

        met = paired.where("tile_a <> tile_b").drop("block").join(signed, "id").repartition(*tile).sortWithinPartitions(*tile)
        links = links.unionByName(met.mapInArrow(together, "a long, b long"))
    return links


def ngram_links(docs: DataFrame, threshold: float = 0.8, n: int = 5, target: float = 0.9995) -> DataFrame:
    """doc_id, class_id, n_links, kept for every row of (doc_id, text).

    class_id is the smallest doc_id reachable by links; kept marks its document.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text")).withColumn("text_key", F.unhex(F.md5(F.encode("text", "UTF-8"))))
    a, b = _multipliers(TREES * DEPTH)

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1000):
                part = batch.slice(at, 1000)
                sig, counts = [], []
                for text in part.column("text"):
                    grams = shingles(text.as_py(), n)
                    counts.append(len(grams))
                    sig.append(signature(grams, a, b).astype("<u4").tobytes() if len(grams) else None)
                yield pa.RecordBatch.from_arrays([part.column("doc_id"), part.column("text_key"), pa.array(counts, pa.int64()), pa.array(sig, pa.binary())], names=["doc_id", "text_key", "n_grams", "sig"])

    signed = materialise(rows.mapInArrow(sign, "doc_id long, text_key binary, n_grams long, sig binary"), "signatures")
    # Equal texts are one class: all of their columns but the id are equal.
    classes = signed.where("n_grams > 0").groupBy("text_key").agg(F.min("doc_id").alias("rep"), F.count("*").alias("copies"), F.first("n_grams").alias("n_grams"), F.first("sig").alias("sig"))
    own = materialise(classes.withColumn("id", F.xxhash64("text_key")), "classes")

    far = 1 - threshold + SLACK * math.sqrt(threshold * (1 - threshold) / (TREES * DEPTH))
    depth = stop_depth(threshold, target, sampled_pairs(own, threshold))
    cluster = components(materialise(candidates(own, depth, far), "candidate-links")).withColumnRenamed("component_id", "cluster")
    members = materialise(own.select("id", "text_key", "copies", "n_grams").join(cluster, "id"), "clusters")
    blocks = F.greatest(F.ceil(F.count("*") / SET_BLOCK), F.ceil(F.sum("n_grams") / SET_GRAMS))
    several = members.groupBy("cluster").agg(blocks.alias("n"))
    # Only the first document of a class is read again.  While the members are few for a bit set of fixed
    # size, it picks their rows where they are; beyond that they are joined. Either way the join below decides.
    wanted = members.join(own.select("id", "rep"), "id").select(F.xxhash64("text_key", "rep").alias("h"))
    bits = bit_set(wanted, "h") if wanted.count() <= BITS // 8 else None
    again = rows.withColumn("h", F.xxhash64("text_key", "doc_id"))
    if bits is None:
        again = again.join(wanted.distinct(), "h", "left_semi")

    def sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pick = np.arange(batch.num_rows) if bits is None else np.flatnonzero(in_bit_set(batch.column("h").to_numpy(), bits))
            for at in range(0, len(pick), 500):
                part = batch.take(pa.array(pick[at : at + 500]))
                grams = [shingles(t.as_py(), n).astype("<u8").tobytes() for t in part.column("text")]
                yield pa.RecordBatch.from_arrays([part.column("text_key"), pa.array(grams, pa.binary())], names=["text_key", "grams"])

    found = again.select("h", "text_key", "text").mapInArrow(sets, "text_key binary, grams binary")
    read = found.join(members.select("text_key", "id", "copies", "cluster"), "text_key").dropDuplicates(["id"]).select("cluster", "id", "copies", "grams")
    read = materialise(read, "grams")
    keys = ["cluster", "tile_a", "tile_b"]
    dealt = tiles(read, ["cluster"], several, 1, "id").repartition(*keys).sortWithinPartitions(*keys)

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (_, ta, tb), table in groups(batches, keys):
            block, ids, copies = (table.column(c).to_numpy() for c in ("block", "id", "copies"))
            i, j = near_pairs([np.frombuffer(g, "<u8") for g in table.column("grams").to_pylist()], threshold)
            meet = ((block[i] == ta) & (block[j] == tb)) | ((block[i] == tb) & (block[j] == ta))
            i, j = i[meet], j[meet]
            links = np.zeros(len(ids), np.int64)
            np.add.at(links, i, copies[j])
            np.add.at(links, j, copies[i])
            hit = np.flatnonzero(links)
            if len(hit):
                root = local_roots(len(ids), i, j, ids)
                yield pa.RecordBatch.from_pydict({"id": ids[hit], "links": links[hit], "root": root[hit]})

    partial = materialise(dealt.mapInArrow(verify, "id long, links long, root long"), "links")
    total = partial.groupBy("id").agg(F.sum("links").alias("links"))
    member = components(partial.select(F.col("id").alias("a"), F.col("root").alias("b")))
    linked = own.select("id", "rep").join(member, "id").join(total, "id")
    named = linked.join(linked.groupBy("component_id").agg(F.min("rep").alias("class_id")), "component_id").select("id", "links", "class_id")
    known = own.select("id", "text_key", "copies", "rep").join(named, "id", "left").select("text_key", "copies", "links", F.coalesce("class_id", "rep").alias("class_id"))
    out = signed.select("doc_id", "text_key").join(known, "text_key", "left")
    class_id = F.coalesce("class_id", "doc_id")
    n_links = F.coalesce(F.col("copies") - 1 + F.coalesce("links", F.lit(0)), F.lit(0)).cast("long")
    return out.select("doc_id", class_id.alias("class_id"), n_links.alias("n_links"), F.col("doc_id").eqNullSafe(class_id).alias("kept"))


def near_pairs(grams: list[np.ndarray], threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """The pairs i < j of sorted sets with a Jaccard similarity of at least ``threshold``, by products of incidence matrices."""
    size = np.array([len(g) for g in grams])
    _, inverse, often = np.unique(np.concatenate(grams), return_inverse=True, return_counts=True)
    rank = np.cumsum(often > 1) - 1  # only n-grams of several texts count
    shared = often[inverse] > 1
    row, col = np.repeat(np.arange(len(size)), size)[shared], rank[inverse[shared]]
    del inverse, often, shared
    both = np.zeros((len(size), len(size)), np.float32)
    order = np.argsort(col, kind="stable")
    row, col = row[order], col[order]
    width = max(256, 2_000_000 // len(size))
    for at in range(0, int(col[-1]) + 1 if len(col) else 0, width):
        lo, hi = np.searchsorted(col, [at, at + width])
        m = np.zeros((len(size), width), np.float32)
        m[row[lo:hi], col[lo:hi] - at] = 1
        both += m @ m.T
    near = both.astype(np.float64) >= threshold * (size[:, None] + size - both) - 1e-9
    return np.nonzero(np.triu(near, 1))
