import corpus_pipeline
from tidemark.llm.queries import ORACLE, QUERIES


def test_every_operator_is_registered():
    assert [sum(name.startswith(f"op{n}_") for name in QUERIES) for n in range(1, 14)] == [1] * 13
    assert "pipeline" in QUERIES and set(ORACLE) <= set(QUERIES)


def test_stages_keep_columns_and_take_effect(spark, small_dir):
    docs = corpus_pipeline.documents(spark, small_dir)
    counts = [docs.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = corpus_pipeline.written(stage(spark, docs, small_dir), name)
        assert out.schema.simpleString() == docs.schema.simpleString()
        assert out.join(docs, "doc_id", "left_anti").isEmpty()
        counts.append(out.count())
        docs = out
    assert counts[1] < counts[0] and counts[2] < counts[1] and counts[3] < counts[2]
    assert counts[4] == counts[3]
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, small_dir)
    assert packed.select("doc_id").distinct().count() == counts[4]
