"""The stages of the corpus pipeline, each on what the stage before it kept."""

import corpus_pipeline
from siltstone.llm.common import stored
from siltstone.llm.queries import QUERIES, SQL


def test_every_stage_works_on_what_the_last_one_kept(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    columns, before = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stored(stage(spark, docs, sf), name)
        assert docs.columns == columns
        after = docs.count()
        assert 0 < after <= before
        before = after
    packed = corpus_pipeline.packing(spark, docs, sf)
    assert packed.where("piece = 0").count() == after
    assert corpus_pipeline.run(spark, sf).where("piece = 0").count() == after


def test_stages_stand_odd_rows(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").limit(40)
    odd = spark.createDataFrame([(None, None, None, None, None), (10**6, "", "en", "s", 0), (10**6 + 1, "a\nb", None, None, 3)], docs.schema)
    docs = docs.union(odd).union(odd)
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, sf)
        assert out.columns == docs.columns
        assert {None, 10**6} <= {r.doc_id for r in out.collect()}
        assert stage(spark, docs.limit(0), sf).count() == 0


def test_each_operator_has_one_query():
    names = [n for n in QUERIES if n != "pipeline"]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))
    assert set(SQL) <= set(QUERIES) and corpus_pipeline.ORACLE_SQL is None
