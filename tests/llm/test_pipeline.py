import corpus_pipeline
from barline.llm import quality
from conftest import SF


def test_stages_take_effect(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, kept = docs.columns, docs.count()
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        before = docs
        stage(spark, docs, SF).write.parquet(str(tmp_path / str(k)))
        docs = spark.read.parquet(str(tmp_path / str(k)))
        if k < len(corpus_pipeline.STAGES) - 1:
            assert docs.columns == columns and 0 < docs.count() <= kept, name
            kept = docs.count()
        if name == "quality rules":
            assert not [r for r in quality.text_quality(docs).collect() if not r.kept]
        if name == "PII":
            assert not docs.where("text rlike '[a-z0-9]@mail'").count()
    pieces = docs.groupBy("doc_id").count().count()
    assert pieces == before.count()


def test_an_empty_table_passes_every_stage(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).count() == 0


def test_clashing_names_and_odd_rows_pass_every_stage(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (3, "a b c " * 9000), (None, "some words of a text " * 4), (5, " ".join(f"w{i}x" for i in range(90))), (5, " ".join(f"w{i}x" for i in range(90)))], "doc_id long, text string")
    docs = docs.selectExpr("*", "1 AS spans", "'k' AS kept", "2 AS failed", "3 AS n_words", "4 AS key", "5 AS _keys", "6 AS _gone", "7 AS _doc", "8 AS n_lines", "9 AS _terms", "10 AS ids", "11 AS length")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        if name != corpus_pipeline.STAGES[-1][0]:
            assert out.columns == docs.columns, name
            assert {(r.spans, r.kept, r.key, r._gone, r.length) for r in out.collect()} == {(1, "k", 4, 6, 11)}, name
        else:
            assert out.count() > docs.count()
