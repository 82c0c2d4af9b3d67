"""Quality rules with a ledger of failure bits.

Every rule is evaluated once for each document; the ledger keeps the measurements and
one bit for each failed rule.  A policy is a version number and a mask of the rules it
enforces, so policies are changed, compared and ablated from the ledger by bitwise
aggregation, without reading texts again.

Null text counts as no words, an empty text likewise; both fail ``few_words``.  Texts
of any length are read whole.  Repeated rows give equal rows.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barline.llm.shared import materialise, text_or_empty

WORD = re.compile(r"[^\x20\x09-\x0D]+")
SYMBOL = re.compile(r"[#*$%&|<>]")
UPPER = re.compile(r"[A-ZÀ-ÖØ-Þ]")
LOWER = re.compile(r"[a-zà-öø-ÿß]")
MARKS = str.maketrans("", "", "!?.,;:\"'()[]{}-_/\\#*$%&|<>")

MEASURES = ("n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines", "n_repeat_words", "n_upper", "n_lower", "n_markers", "n_bare")


def _ratio(part: str, whole: str, percent: int) -> Column:
    """Whether ``part`` is over ``percent`` of ``whole``, in integers."""
    return 100 * F.col(part) > percent * F.col(whole)




def rules() -> dict[str, Column]:
    """The failure conditions, in the order of their bits."""
    return {
        "few_words": F.col("n_words") < 50,
        "repeated_windows": _ratio("n_repeat_words", "n_words", 50),
        "symbols": _ratio("n_symbols", "n_words", 40),
        "duplicate_lines": _ratio("n_dup_lines", "n_lines", 50),
        "word_length": (F.col("word_chars") < 2 * F.col("n_words")) | (F.col("word_chars") > 15 * F.col("n_words")),
        "upper_case": 100 * F.col("n_upper") > 50 * (F.col("n_upper") + F.col("n_lower")),
        "bare_words": _ratio("n_bare", "n_words", 30),
        "markers": _ratio("n_markers", "n_words", 40),
    }


#: Version -> the rules it enforces.
POLICIES: dict[int, tuple[str, ...]] = {
    1: ("few_words", "repeated_windows"),
    2: ("few_words", "repeated_windows", "symbols", "duplicate_lines", "word_length", "upper_case", "bare_words", "markers"),
}
CURRENT = 2


def mask_of(version: int) -> int:
    names = list(rules())
    return sum(1 << names.index(n) for n in POLICIES[version])


def _repeat_words(words: list[str]) -> int:
    windows = list(zip(words, words[1:], words[2:], strict=False))
    if len(set(windows)) == len(windows):
        return 0
    often = Counter(windows)
    covered = bytearray(len(words))
    for at, window in enumerate(windows):
        if often[window] > 1:
            covered[at : at + 3] = b"\1\1\1"
    return sum(covered)


def _measure(text: str) -> tuple[int, ...]:
    words = WORD.findall(text)
    seen: set[str] = set()
    dup = lines = 0
    for line in text.split("\n"):
        if WORD.search(line):
            lines += 1
            dup += line in seen
            seen.add(line)
    markers = bare = 0
    for w in words:
        if w[-2:] in ("!!", "**", "$$", "%%", "&&", "##"):
            markers += 1
        elif not w.translate(MARKS):
            bare += 1
    return (len(words), sum(map(len, words)), len(SYMBOL.findall(text)), lines, dup, _repeat_words(words), len(UPPER.findall(text)), len(LOWER.findall(text)), markers, bare)


def measure(docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` with the measurements behind them; text becomes the empty string where null."""
    own = [c for c in docs.columns if c not in MEASURES]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema if f.name in own), *(f"{m} long" for m in MEASURES)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [_measure(t.as_py() or "") for t in batch.column("text")]
            columns = list(zip(*rows, strict=True)) if rows else [()] * len(MEASURES)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in own), *(pa.array(c, pa.int64()) for c in columns)], names=[*own, *MEASURES])

    return docs.select(*own).mapInArrow(run, schema)


def ledger(docs: DataFrame) -> DataFrame:
    """``measure`` with ``failed``: bit i is set if rule i failed."""
    bits = [F.when(F.coalesce(cond, F.lit(False)), F.lit(1 << i).cast("long")).otherwise(F.lit(0).cast("long")) for i, cond in enumerate(rules().values())]
    failed = bits[0]
    for b in bits[1:]:
        failed = failed.bitwiseOR(b)
    return measure(docs).withColumn("failed", failed)


def apply_policy(book: DataFrame, version: int = CURRENT) -> DataFrame:
    """Adds ``kept``: no rule of the policy failed."""
    return book.withColumn("kept", F.col("failed").bitwiseAND(F.lit(mask_of(version)).cast("long")) == 0)


def ablations(book: DataFrame, version: int = CURRENT) -> DataFrame:
    """For each rule of a policy: how many documents fail it, fail it alone, and would be kept without it."""
    mask, names = mask_of(version), list(rules())
    hit = F.col("failed").bitwiseAND(F.lit(mask).cast("long"))
    counts = book.groupBy(hit.alias("hit")).agg(F.count("*").alias("n"))  # at most 2 ** rules groups
    inside = F.explode(F.array(*(F.struct(F.lit(n).alias("rule"), F.lit(1 << names.index(n)).cast("long").alias("bit")) for n in POLICIES[version]))).alias("r")
    spread = counts.select("hit", "n", inside).select("hit", "n", "r.*")
    return spread.groupBy("rule", "bit").agg(
        F.sum(F.when(F.col("hit").bitwiseAND(F.col("bit")) != 0, F.col("n")).otherwise(0)).alias("n_failed"),
        F.sum(F.when(F.col("hit") == F.col("bit"), F.col("n")).otherwise(0)).alias("n_failed_alone"),
    )


def text_quality(docs: DataFrame, version: int = CURRENT) -> DataFrame:
    """One row per document, from one stored ledger: measurements, failure bits, each policy's share of them, and the verdict.

    ``n_failed_alike_alone`` tells, for a document that the policy rejects by one rule only,
    how many documents would return without that rule; 0 for all others.
    """
    book = materialise(ledger(docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_or_empty().alias("text"))).drop("text"), "quality-ledger")
    masked = lambda v: F.col("failed").bitwiseAND(F.lit(mask_of(v)).cast("long"))
    alone = ablations(book, version).select(F.col("bit").alias("_bit"), F.col("n_failed_alone").alias("_alone"))  # one row per rule
    judged = apply_policy(book, version).withColumn("_hit", masked(version)).join(F.broadcast(alone), F.col("_hit") == F.col("_bit"), "left")
    base = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    by_policy = [masked(v).alias(f"failed_v{v}") for v in POLICIES]
    return judged.select("doc_id", *MEASURES, "failed", *by_policy, F.coalesce("_alone", F.lit(0)).cast("long").alias("n_failed_alike_alone"), base.alias("base_failed"), (F.col("kept") & ~base).alias("kept"))
