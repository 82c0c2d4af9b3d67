"""Line deduplication by a fixed-depth log-template tree, in DataFrame expressions.

A line's tokens are its space-separated pieces; a token with a digit is a variable field
and reads ``<*>``.  The tree's levels are the number of tokens and the leading tokens; at a
leaf the other tokens are three thirds.  A line belongs to its full template, and, if it is
long enough, to the three templates that generalise one third.  A template recurs if at least
``min_docs`` documents have it.  A line goes if one of its templates recurs and a document with
a smaller id has that template; so the first document keeps its line.  A line whose variable
fields are more than half of its tokens, such as a row of numbers, is compared as it is, or
unlike rows of a listing would share a template.

Templates are compared by 64-bit hashes.  Lines of fewer than ``MIN_TOKENS`` tokens are never
dropped: marks such as a brace or a rule recur by nature.  Lines of two to nine documents stay;
most of them belong to copies, which later stages take as a whole.  Null text counts as empty.  If a
doc_id repeats, its rows are one document for the counts, and lines go from each; rows without
doc_id count as one document and keep their lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barline.llm.shared import materialise, text_or_empty

LEAD, MIN_TOKENS, GENERALISED_FROM, MIN_DOCS = 3, 4, 12, 10


def masked(line: Column) -> Column:
    """The line with variable fields generalised."""
    line = F.trim(line)
    return F.when(line.rlike("[0-9]"), F.regexp_replace(line, "[^ ]*[0-9][^ ]*", "<*>")).otherwise(line)


def with_templates(lines: DataFrame) -> DataFrame:
    """The columns of ``lines`` but line, and key: a row for each template of a line, none, one or four.

    Each step is a projection of its own, so that nothing is evaluated twice.  The levels
    of the tree are cut out of the line by counting spaces.
    """
    own = [c for c in lines.columns if c != "line"]
    tokens = F.length("_m") - F.length(F.translate("_m", " ", "")) + 1
    counted = lines.select(*own, F.trim("line").alias("_plain_line"), masked(F.col("line")).alias("_m")).select("*", tokens.alias("_n")).where(F.col("_n") >= MIN_TOKENS)
    fields = (F.length("_m") - F.length(F.replace("_m", F.lit("<*>"), F.lit("")))) / 3
    counted = counted.withColumn("_fixed", 2 * fields <= F.col("_n"))
    third = F.ceil((F.col("_n") - LEAD) / 3).cast("int")
    cut = counted.select("*", third.alias("_h"))
    cut = cut.select(*own, "_n", "_m", "_fixed", "_plain_line", F.expr(f"substring_index(_m, ' ', {LEAD})").alias("_lead"), F.expr(f"substring_index(_m, ' ', {LEAD} + _h)").alias("_a"), F.expr(f"substring_index(_m, ' ', {LEAD} + 2 * _h)").alias("_ab"), F.expr(f"substring_index(_m, ' ', {LEAD} + _h - _n)").alias("_bc"), F.expr(f"substring_index(_m, ' ', {LEAD} + 2 * _h - _n)").alias("_c"))
    full = F.xxhash64(F.lit(0), F.when(F.col("_fixed"), F.col("_m")).otherwise(F.col("_plain_line")))
    open_ = (F.xxhash64(F.lit(1), "_n", "_lead", "_bc"), F.xxhash64(F.lit(2), "_n", "_a", "_c"), F.xxhash64(F.lit(3), "_n", "_ab"))
    return cut.select(*own, F.explode(F.when((F.col("_n") < GENERALISED_FROM) | ~F.col("_fixed"), F.array(full)).otherwise(F.array(full, *open_))).alias("key"))


def drop_recurring_lines(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """The columns of ``docs`` with recurring lines taken out of text, and n_lines and n_dropped."""
    own = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    # Rows that repeat a doc_id are told apart by their text.
    lines = docs.select(F.col("doc_id").alias("_doc"), F.xxhash64(text_or_empty()).alias("_text"), F.posexplode(F.split(text_or_empty(), "\n")).alias("_line", "line"))
    entries = materialise(with_templates(lines), "line-templates")
    recurring = entries.select("key", "_doc").distinct().groupBy("key").agg(F.count("*").alias("n"), F.min("_doc").alias("_first")).where(F.col("n") >= min_docs)
    dropped = entries.join(recurring.select("key", "_first"), "key").where(F.col("_doc") > F.col("_first")).groupBy("_doc", "_text").agg(F.collect_set("_line").alias("_drop"))
    rows = docs.select(F.struct(*(c for c in own if c != "text")).alias("_own"), text_or_empty().alias("_plain"), F.col("doc_id").alias("_id")).withColumn("_hash", F.xxhash64("_plain"))
    joined = rows.join(dropped, (F.col("_id") == F.col("_doc")) & (F.col("_hash") == F.col("_text")), "left")

    def without(x: Column) -> Column:
        """The lines between those dropped; x holds the lines and the sorted places to drop."""
        part = lambda i: F.slice(x["lines"], F.when(i == 0, 1).otherwise(x["drop"][i - 1] + 2), F.when(i == F.size(x["drop"]), F.size(x["lines"])).otherwise(x["drop"][i]) - F.when(i == 0, 0).otherwise(x["drop"][i - 1] + 1))
        return F.array_join(F.flatten(F.transform(F.sequence(F.lit(0), F.size(x["drop"])), part)), "\n")

    # One element, bound as a variable, so that the text is split once.
    held = F.array(F.struct(F.split("_plain", "\n").alias("lines"), F.array_sort("_drop").alias("drop")))
    kept = F.when(F.col("_drop").isNull(), F.col("_plain")).otherwise(F.transform(held, without)[0])
    n_lines = F.length("_plain") - F.length(F.translate("_plain", "\n", "")) + 1
    return joined.select(*(kept.alias("text") if c == "text" else F.col("_own")[c].alias(c) for c in own), n_lines.cast("long").alias("n_lines"), F.when(F.col("_drop").isNull(), 0).otherwise(F.size("_drop")).cast("long").alias("n_dropped"))
