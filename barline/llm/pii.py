"""Personal data: patterns, and terms that disclose what the patterns found.

The protected entities are the values that the patterns find (email, ip, card, phone, and
secrets: long keys assigned to a name such as ``token``).  A term is a word among the
``REACH`` words on each side of a mention.  Over the whole corpus, with p the share of
documents, IC(e) = -log2 p(e) and PMI(t, e) = log2 p(t, e) / (p(t) p(e)); t discloses e if

- PMI(t, e) >= ``share`` * IC(e): who reads t learns that share of e's information, and
- at least ``confidence`` of the documents that hold t hold it near e, and
- t stands near e in at least ``support`` documents: what is known of t and e in one document
  comes from another one.  A copy is such a document: whoever looks for t finds e there.

All counts are of documents (rows), copies included: those that hold t near e, those that
hold e, and those that hold t anywhere.  A disclosing term is marked wherever it occurs; in
``sanitise`` it is generalised, the more it discloses the further: to its first letter and
kind, to its kind, and from ``REMOVE`` on to nothing.

Words are found by one pattern on every path.  Which terms a document holds is first narrowed
by a bit set of fixed size, then joined exactly; how many terms there are changes no result.

Null text counts as empty.  Every row is judged by its own text, repeated rows and rows
without doc_id alike; texts of any length are read whole.  Where mentions overlap, each kind
keeps its own.  An empty table gives an empty result; other columns pass through.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barline.llm.shared import BITS, bit_set, in_bit_set, materialise, text_or_empty

#: The kinds whose patterns are fixed; ``secret`` is a kind of this method.
KINDS = ("email", "ip", "card", "phone")
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(?:\.[0-9]+)(?:\.[0-9]+)(?:\.[0-9]+)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
ANY = re.compile(r"[0-9@]")
LONG = re.compile(r"[0-9][\x20-]?[0-9][\x20-]?[0-9]")
WORD = re.compile(r"[^\W\d_]{3,}")
SECRET = re.compile(r"(?i)\b(?:token|secret|passw(?:or)?d|(?:api|access|private)[_-]?key)\b[\"']?\s{0,4}[=:]\s{0,4}[\"']?([A-Za-z0-9+/_=-]{16,})")
#: Words on each side of a mention, documents at least, share of the information, share of the term's documents, and where a term goes altogether.
REACH, SUPPORT, SHARE, CONFIDENCE, REMOVE = 10, 2, 0.8, 0.5, 0.97
Span = tuple[str, int, int]


def _luhn(digits: str) -> bool:
    odd = sum(map(int, digits[-1::-2]))
    return (odd + sum(d // 10 + d % 10 for d in (2 * int(c) for c in digits[-2::-2]))) % 10 == 0


def base_spans(text: str) -> list[Span]:
    """Kind, start and end of what the patterns find, by kind and start."""
    if not ANY.search(text):
        return []
    out: list[Span] = []
    if "@" in text:
        out += [("email", *m.span()) for m in EMAIL.finditer(text)]
    if "." in text:
        out += [("ip", *m.span()) for m in IP.finditer(text) if all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in m[0].split("."))]
    if LONG.search(text):
        for m in CARD.finditer(text):
            if m.end() - m.start() >= 16:
                digits = re.sub(r"[^0-9]", "", m[0])
                if 16 <= len(digits) <= 19 and _luhn(digits):
                    out.append(("card", *m.span()))
    if "+" in text:
        out += [("phone", *m.span()) for m in PHONE.finditer(text) if 8 <= sum(c.isdigit() for c in m[0]) <= 15]
    return out


def all_spans(text: str) -> list[Span]:
    """``base_spans`` and the secrets."""
    out = base_spans(text)
    if "=" in text or ":" in text:
        out += [("secret", *m.span(1)) for m in SECRET.finditer(text)]
    return out


def _value(kind: str, text: str) -> str:
    return f"{kind}:{text.lower() if kind == 'email' else text if kind in ('ip', 'secret') else re.sub('[^0-9]', '', text)}"


def near_words(text: str, spans: list[Span]) -> list[list[str]]:
    """For each span: the words on both sides, those of findings left out."""
    words = [(m.start(), m[0].lower()) for m in WORD.finditer(text)]
    starts = np.array([a for a, _ in words], np.int64)
    covered = np.zeros(len(words), bool)
    for _, a, b in spans:
        covered[np.searchsorted(starts, a) : np.searchsorted(starts, b)] = True
    free = np.flatnonzero(~covered)
    out = []
    for _, a, b in spans:
        lo, hi = np.searchsorted(starts[free], [a, b])
        out.append([words[k][1] for k in (*free[max(0, lo - REACH) : lo], *free[hi : hi + REACH])])
    return out


def mentions(docs: DataFrame) -> DataFrame:
    """entity and the terms near it, for each document and entity."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for text in batch.column("text"):
                text = text.as_py()
                if not (spans := all_spans(text)):
                    continue
                near: dict[str, set[str]] = {}
                for (kind, a, b), words in zip(spans, near_words(text, spans), strict=True):
                    near.setdefault(_value(kind, text[a:b]), set()).update(words)
                rows += [(entity, sorted(terms)) for entity, terms in near.items()]
            if rows:
                entity, terms = zip(*rows, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(entity), pa.array(terms, pa.list_(pa.string()))], names=["entity", "terms"])

    return docs.select("text").mapInArrow(run, "entity string, terms array<string>")


def _bits_of(terms: DataFrame) -> np.ndarray:
    return bit_set(terms.select(F.xxhash64("term").alias("h")), "h", BITS)


def _held(words: set[str], bits: np.ndarray) -> list[str]:
    """The words whose bit is set."""
    words = sorted(words)
    hashes = np.fromiter((xxhash.xxh64_intdigest(w.encode(), 42) for w in words), np.uint64, len(words))
    return [words[k] for k in np.flatnonzero(in_bit_set(hashes, bits))]


def documents_with(docs: DataFrame, terms: DataFrame) -> DataFrame:
    """(term, n): how many documents hold each of ``terms``."""
    bits = _bits_of(terms)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n: dict[str, int] = {}
            for text in batch.column("text"):
                for t in set(WORD.findall(text.as_py().lower())):
                    n[t] = n.get(t, 0) + 1
            kept = _held(set(n), bits)
            if kept:
                yield pa.RecordBatch.from_arrays([pa.array(kept, pa.string()), pa.array([n[t] for t in kept], pa.int64())], names=["term", "n"])

    counts = docs.select("text").mapInArrow(count, "term string, n long").groupBy("term").agg(F.sum("n").alias("n"))
    return counts.join(terms, "term", "left_semi")


def disclosing_terms(docs: DataFrame, support: int = SUPPORT, share: float = SHARE, confidence: float = CONFIDENCE) -> DataFrame:
    """(term, disclosed): terms that disclose some entity, with the largest share of its information."""
    n_docs = float(max(1, docs.count()))
    found = materialise(mentions(docs), "mentions")
    of_entity = found.groupBy("entity").agg(F.count("*").alias("n_entity"))
    pairs = found.select("entity", F.explode("terms").alias("term")).groupBy("entity", "term").agg(F.count("*").alias("n_both"))
    pairs = materialise(pairs.where(F.col("n_both") >= support).join(of_entity, "entity"), "term-pairs")
    of_term = documents_with(docs, pairs.select("term").distinct())
    ic = -F.log2(F.col("n_entity") / n_docs)
    pmi = F.log2(F.col("n_both") * n_docs / (F.col("n") * F.col("n_entity")))
    known = pairs.join(of_term, "term").where((ic > 0) & (F.col("n_both") >= confidence * F.col("n"))).withColumn("disclosed", F.least(pmi / ic, F.lit(1.0)))
    return known.where(F.col("disclosed") >= share).groupBy("term").agg(F.max("disclosed").alias("disclosed"))


def generalised(word: str, disclosed: float) -> str:
    """What stands for a term: the more it discloses, the less."""
    kind = "name" if word[:1].isupper() and not word.isupper() else "acronym" if word.isupper() else "word"
    return "" if disclosed >= REMOVE else f"[{kind}]" if disclosed >= 0.9 else f"[{word[0]} {kind}]"


def find(docs: DataFrame, text_too: bool = False) -> DataFrame:
    """The columns of ``docs`` with spans: kind, start, end (code points) by kind and start.

    ``text_too`` sets text to the sanitised text.
    """
    rows = docs.withColumn("text", text_or_empty())
    own = [c for c in rows.columns if c not in ("spans", "_terms", "_key", "_doc")]
    rows = rows.select(*own)
    terms = materialise(disclosing_terms(rows), "terms")
    bits = _bits_of(terms)

    def held(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, words = [], []
            for key, text in zip(batch.column("_key").to_pylist(), batch.column("text"), strict=True):
                here = _held(set(WORD.findall(text.as_py().lower())), bits)
                keys += [key] * len(here)
                words += here
            if keys:
                yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(words, pa.string())], names=["_key", "term"])

    key = F.xxhash64("text")  # equal keys: equal texts, or a term more to look for, which the text doesn't hold
    # The side of terms by document is small beside the texts; Spark broadcasts it only if its written size allows.
    by_key = materialise(rows.select(key.alias("_key"), "text").mapInArrow(held, "_key long, term string").join(terms, "term").distinct(), "held-terms")
    by_key = by_key.groupBy("_key").agg(F.map_from_entries(F.collect_list(F.struct("term", "disclosed"))).alias("_terms"))
    rows = rows.withColumn("_key", key).join(by_key, "_key", "left")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found, texts = [], []
            for text, held in zip(batch.column("text"), batch.column("_terms"), strict=True):
                text = text.as_py()
                spans = all_spans(text)
                here = dict(held.as_py() or [])
                if here:
                    spans += [("term", *m.span()) for m in WORD.finditer(text) if m[0].lower() in here]
                found.append([{"kind": k, "start": a, "end": b} for k, a, b in spans])
                if text_too and spans:
                    out, at = [], 0
                    for k, a, b in sorted(spans, key=lambda s: (s[1], -s[2])):
                        if a >= at:
                            out += [text[at:a], generalised(text[a:b], here[text[a:b].lower()]) if k == "term" else f"[{k.upper()}]"]
                        at = max(at, b)
                    text = "".join([*out, text[at:]])
                if text_too:
                    texts.append(text)
            kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
            columns = [pa.array(texts, pa.string()) if c == "text" and text_too else batch.column(c) for c in own]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(found, kind)], names=[*own, "spans"])

    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema if f.name in own), "spans array<struct<kind:string,start:bigint,end:bigint>>"])
    return rows.select(*own, "_terms").mapInArrow(run, schema)


def sanitise(docs: DataFrame) -> DataFrame:
    """``docs`` with findings replaced by their kind, and disclosing terms generalised or removed."""
    return find(docs, text_too=True).drop("spans")
