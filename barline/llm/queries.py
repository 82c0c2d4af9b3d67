"""Queries of the corpus operators: each applies one to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from barline.llm import chat_format, embedding_join, html_extraction, licenses, line_dedup, ngram_join, packing, pii, quality, sentence_pieces, signature_search, suffix_dedup, token_alignment
from barline.llm.shared import documents

def tokenizer_file(name: str, folder: str | None = None) -> str:
    """A public tokenizer file, from the installed package or from a folder of the same files."""
    if folder is not None:
        return f"{folder}/{name}"
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_embedding_neardup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_join.embedding_links(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), 0.93)


OP1_SQL = r"""
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[64]) AS e FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x <> 0)) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0
), l AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE array_cosine_similarity(a.e, b.e) >= 0.93
), r AS (
  SELECT a, b FROM l UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a
), c AS (
  SELECT a, least(a, min(b)) AS component_id FROM r GROUP BY a
), n AS (SELECT a, count(*) AS n FROM l GROUP BY a)
SELECT vec_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_links, coalesce(c.component_id, vec_id) AS component_id,
       vec_id = coalesce(c.component_id, vec_id) AS kept
FROM embeddings LEFT JOIN n ON n.a = vec_id LEFT JOIN c ON c.a = vec_id
"""


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = tokenizer_file("piece_bpe_32k.model")
    encoded = sentence_pieces.encode(documents(spark, sf_dir).select("doc_id", "text"), model)
    return sentence_pieces.decode(encoded, model).select("doc_id", F.size("ids").cast("long").alias("n_tokens"), F.xxhash64("ids").alias("ids_hash"), (F.col("decoded") == F.col("text")).alias("round_trip"))


def op3_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.ngram_links(documents(spark, sf_dir), 0.8, 5)


def op4_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = "struct<conv_id:bigint,turn:bigint,role:string,text:string>"
    extra = spark.range(1).select(F.explode(F.array(*(F.struct(F.lit(-7).alias("conv_id"), F.lit(k).alias("turn"), F.lit(role).alias("role"), F.lit("</s>[INST] ok [/INST]").alias("text")).cast(own) for k, role in enumerate(("user", "assistant"))))).alias("r")).select("r.*")
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").unionByName(extra)
    return chat_digest(rows)


def typed_parts() -> Column:
    """Content parts of a turn of the table: its text, and attachments that follow from its place and length.

    The table has texts only, so every third turn gets an image, a document or an audio
    part, told by the turn and the text's length; conversation -7 stays as it is.
    """
    length = F.length(F.coalesce("text", F.lit("")))
    ref = F.concat_ws("-", F.lit("part"), F.col("conv_id").cast("string"), F.col("turn").cast("string"))
    units = (length % 7 + 1).cast("int")
    typed = [F.when((length % 3 == 0) & (F.col("turn") % 3 == k), F.array(chat_format.part(kind, None, ref, units))).otherwise(F.array().cast(f"array<{chat_format.PART}>")) for k, kind in enumerate(("image", "document", "audio"))]
    text = F.array(chat_format.part("text", F.coalesce(F.col("text"), F.lit(""))))
    return F.when(F.col("conv_id") == -7, text).otherwise(F.concat(typed[0], text, typed[1], typed[2]))


def chat_digest(rows: DataFrame) -> DataFrame:
    back = chat_format.read_back(chat_format.format_chats(rows.select("conv_id", "turn", "role", typed_parts().alias("parts"))))
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    listed = F.array_join(F.transform("attachments", lambda a: F.concat_ws(":", a["number"].cast("string"), a["kind"], a["ref"], a["tokens"].cast("string"))), ",")
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.encode(said, "UTF-8"), 256).alias("turns_sha256"),
        F.length("loss_text").cast("long").alias("loss_chars"),
        F.sha2(F.encode("loss_text", "UTF-8"), 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
        listed.alias("attachments"),
    )


OP4_SQL = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), k AS (
  SELECT *, CASE WHEN conv_id = -7 OR length(text) % 3 <> 0 OR turn IS NULL THEN NULL WHEN turn % 3 = 0 THEN 'image' WHEN turn % 3 = 1 THEN 'document' ELSE 'audio' END AS kind FROM c
), n AS (
  SELECT *, count(kind) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text ROWS UNBOUNDED PRECEDING) AS number,
         (length(text) % 7 + 1) * CASE kind WHEN 'image' THEN 256 WHEN 'audio' THEN 25 ELSE 512 END AS tokens FROM k
), g AS (
  SELECT conv_id, count(*) AS n_turns,
         string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS said,
         coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, '' ORDER BY turn NULLS FIRST, role, text), '') AS loss,
         coalesce(string_agg(CASE WHEN kind IS NOT NULL THEN number || ':' || kind || ':part-' || conv_id || '-' || turn || ':' || tokens END, ',' ORDER BY number), '') AS attachments,
         sum(16 + length(role) + length(text)
             + length(role) - length(replace(replace(role, '<', ''), '[', ''))
             + length(text) - length(replace(replace(text, '<', ''), '[', ''))
             + CASE WHEN kind IS NULL THEN 0 ELSE 5 + length(kind) + length(CAST(number AS VARCHAR)) END) AS chars
  FROM n GROUP BY conv_id
)
SELECT conv_id, CAST(n_turns AS BIGINT) AS n_turns, sha256(said) AS turns_sha256, CAST(length(loss) AS BIGINT) AS loss_chars,
       sha256(loss) AS loss_sha256, CAST(chars AS BIGINT) AS formatted_chars, attachments
FROM g
"""


def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup.remove_repeats(documents(spark, sf_dir), width=100)
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return out.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op6_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(documents(spark, sf_dir), tokenizer_file("word_bpe_49k.json"), capacity=2048)


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.text_quality(documents(spark, sf_dir))


def _bits_sql() -> str:
    """The failure conditions in SQL, by bit."""
    ratio = lambda part, whole, percent: f"100 * {part} > {percent} * {whole}"
    tests = ["n_words < 50", ratio("n_repeat_words", "n_words", 50), ratio("n_symbols", "n_words", 40), ratio("n_dup_lines", "n_lines", 50), "word_chars < 2 * n_words OR word_chars > 15 * n_words", "100 * n_upper > 50 * (n_upper + n_lower)", ratio("n_bare", "n_words", 30), ratio("n_markers", "n_words", 40)]
    return " + ".join(f"CASE WHEN {t} THEN {1 << k} ELSE 0 END" for k, t in enumerate(tests))


OP9_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text FROM documents),
s AS (SELECT *, regexp_extract_all(text, '[^ 	-
]+') AS words, list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^ 	-
]')) AS lines FROM d),
w AS (SELECT rid, unnest(words) AS w, generate_subscripts(words, 1) AS k FROM s),
g AS (SELECT rid, w, k, lead(w, 1) OVER v AS w2, lead(w, 2) OVER v AS w3 FROM w WINDOW v AS (PARTITION BY rid ORDER BY k)),
r AS (SELECT rid, w, k, CASE WHEN w3 IS NOT NULL AND count(*) OVER (PARTITION BY rid, w, w2, w3) > 1 THEN 1 ELSE 0 END AS again FROM g),
c AS (SELECT *, max(again) OVER (PARTITION BY rid ORDER BY k ROWS BETWEEN 2 PRECEDING AND CURRENT ROW) AS covered, right(w, 2) IN ('!!', '**', '$$', '%%', '&&', '##') AS marker,
             regexp_full_match(w, '[!?.,;:"''()\[\]{{}}\-_/\#*$%&|<>]+') AS bare FROM r),
p AS (SELECT rid, sum(length(w)) AS word_chars, sum(covered) AS n_repeat_words, sum(CAST(marker AS INT)) AS n_markers, sum(CAST(bare AND NOT marker AS INT)) AS n_bare FROM c GROUP BY rid),
m AS (
  SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(coalesce(word_chars, 0) AS BIGINT) AS word_chars,
         CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols, CAST(len(lines) AS BIGINT) AS n_lines,
         CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines, CAST(coalesce(n_repeat_words, 0) AS BIGINT) AS n_repeat_words,
         CAST(length(text) - length(regexp_replace(text, '[A-ZÀ-ÖØ-Þ]', '', 'g')) AS BIGINT) AS n_upper, CAST(length(text) - length(regexp_replace(text, '[a-zà-öø-ÿß]', '', 'g')) AS BIGINT) AS n_lower,
         CAST(coalesce(n_markers, 0) AS BIGINT) AS n_markers, CAST(coalesce(n_bare, 0) AS BIGINT) AS n_bare
  FROM s LEFT JOIN p ON p.rid = s.rid
),
f AS (SELECT *, CAST({_bits_sql()} AS BIGINT) AS failed, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM m),
a AS (SELECT failed, count(*) AS n FROM f WHERE bit_count(failed) = 1 GROUP BY failed)
SELECT doc_id, n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words, n_upper, n_lower, n_markers, n_bare, f.failed, f.failed & 3 AS failed_v1, f.failed AS failed_v2,
       CAST(coalesce(a.n, 0) AS BIGINT) AS n_failed_alike_alone, base_failed, NOT base_failed AND f.failed = 0 AS kept
FROM f LEFT JOIN a ON a.failed = f.failed
"""


def op7_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(documents(spark, sf_dir).select("doc_id", "text"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = line_dedup.drop_recurring_lines(documents(spark, sf_dir).select("doc_id", "text"))
    return out.select("doc_id", "n_lines", "n_dropped", F.length("text").cast("long").alias("kept_chars"), F.sha2(F.encode("text", "UTF-8"), 256).alias("kept_sha256"))


OP8_SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
l AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS k FROM d),
m0 AS (SELECT doc_id, k, trim(line, ' ') AS plain, regexp_replace(trim(line, ' '), '[^ ]*[0-9][^ ]*', '<*>', 'g') AS m FROM l),
m AS (SELECT *, string_split(m, ' ') AS t FROM m0),
n0 AS (SELECT *, len(t) AS n, CAST(ceil((len(t) - 3) / 3.0) AS BIGINT) AS h, 2 * (length(m) - length(replace(m, '<*>', ''))) / 3.0 <= len(t) AS fixed FROM m),
n AS (SELECT * FROM n0 WHERE fixed),
x AS (
  SELECT doc_id, k, '0' || CASE WHEN fixed THEN m ELSE plain END AS key FROM n0 WHERE n >= 4
  UNION ALL SELECT doc_id, k, '1 ' || n || ' ' || array_to_string(t[1:3], ' ') || chr(10) || array_to_string(t[4+h:3+2*h], ' ') || chr(10) || array_to_string(t[4+2*h:], ' ') FROM n WHERE n >= 12
  UNION ALL SELECT doc_id, k, '2 ' || n || ' ' || array_to_string(t[1:3], ' ') || chr(10) || array_to_string(t[4:3+h], ' ') || chr(10) || array_to_string(t[4+2*h:], ' ') FROM n WHERE n >= 12
  UNION ALL SELECT doc_id, k, '3 ' || n || ' ' || array_to_string(t[1:3], ' ') || chr(10) || array_to_string(t[4:3+h], ' ') || chr(10) || array_to_string(t[4+h:3+2*h], ' ') FROM n WHERE n >= 12
),
r AS (SELECT key, min(doc_id) AS first FROM x GROUP BY key HAVING count(DISTINCT doc_id) >= 10),
g AS (SELECT DISTINCT doc_id, k FROM x JOIN r USING (key) WHERE doc_id > first),
o AS (
  SELECT l.doc_id, count(*) AS n_lines, count(g.k) AS n_dropped,
         coalesce(string_agg(CASE WHEN g.k IS NULL THEN line END, chr(10) ORDER BY l.k), '') AS kept
  FROM l LEFT JOIN g ON g.doc_id = l.doc_id AND g.k = l.k GROUP BY l.doc_id
)
SELECT doc_id, CAST(n_lines AS BIGINT) AS n_lines, CAST(n_dropped AS BIGINT) AS n_dropped, CAST(length(kept) AS BIGINT) AS kept_chars, sha256(kept) AS kept_sha256 FROM o
"""


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(documents(spark, sf_dir).select(F.col("doc_id").cast("long").alias("doc_id"), "text"))
    joined = lambda spans: F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")
    base = F.filter("spans", lambda s: s["kind"].isin(*pii.KINDS))
    n_spans = F.size("spans").cast("long").alias("n_spans")
    return found.select("doc_id", *(count(k) for k in pii.KINDS), F.sha2(F.encode(joined(base), "UTF-8"), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"), n_spans, count("secret"), count("term"))


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.align(documents(spark, sf_dir), tokenizer_file("byte_bpe_50k.json"), tokenizer_file("piece_bpe_32k.model"))


def op12_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extraction.extract(spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html"))


def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return signature_search.search(documents(spark, sf_dir), spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text"), k=20)


OP13_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM documents),
q AS (SELECT row_number() OVER () AS iid, item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS terms FROM benchmark),
c AS (SELECT count(*) AS n_docs, CAST(sum(len(terms)) AS BIGINT) AS l FROM d WHERE len(terms) > 0),
i AS (SELECT iid, unnest(terms) AS term FROM q),
p AS (SELECT iid, term, count(*) AS times FROM i GROUP BY iid, term),
t AS (SELECT rid, unnest(terms) AS term FROM d),
f AS (SELECT rid, term, count(*) AS tf FROM t WHERE term IN (SELECT term FROM p) GROUP BY rid, term),
w AS (SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / CAST(2 * count(*) + 1 AS DOUBLE))) AS BIGINT) AS w FROM f, c GROUP BY term, n_docs),
m AS (SELECT rid, doc_id, 100 - 25 + ((25 * len(terms) * n_docs) // l) AS m FROM d, c WHERE len(terms) > 0),
s AS (SELECT iid, rid, CAST(sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * m))) AS BIGINT) AS score
      FROM p JOIN w USING (term) JOIN f USING (term) JOIN m USING (rid) GROUP BY iid, rid),
r AS (SELECT iid, doc_id, score, row_number() OVER (PARTITION BY iid ORDER BY score DESC, doc_id NULLS FIRST) AS rank FROM s JOIN m USING (rid) WHERE score > 0)
SELECT item_id, CAST(rank AS INT) AS rank, doc_id, score FROM r JOIN q USING (iid) WHERE rank <= 20
"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_embedding_neardup": op1_embedding_neardup,
    "op2_sentencepiece": op2_sentencepiece,
    "op3_ngram_jaccard": op3_ngram_jaccard,
    "op4_chat_format": op4_chat_format,
    "op5_suffix_dedup": op5_suffix_dedup,
    "op6_best_fit_packing": op6_best_fit_packing,
    "op7_license_scan": op7_license_scan,
    "op8_line_dedup": op8_line_dedup,
    "op9_quality_rules": op9_quality_rules,
    "op10_pii": op10_pii,
    "op11_token_alignment": op11_token_alignment,
    "op12_html_extraction": op12_html_extraction,
    "op13_ranked_search": op13_ranked_search,
}

ORACLE_SQL: dict[str, str] = {"op1_embedding_neardup": OP1_SQL, "op4_chat_format": OP4_SQL, "op8_line_dedup": OP8_SQL, "op9_quality_rules": OP9_SQL, "op13_ranked_search": OP13_SQL}
