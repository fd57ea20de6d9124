"""The pipeline's stages on given and on odd documents."""

import corpus_pipeline
from tallywatch.llm import decontaminate, simhash
from tests.llm import edge
from tests.llm.test_mixing import n_words

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns = docs.columns
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, corpus_pipeline.materialise(stage(spark, docs, SF), name)
        seen[name] = docs
        if name != "sharding":
            assert docs.columns == columns
        if name == "near_duplicates":
            found = simhash.near_duplicates(before).collect()
            assert sorted(r["doc_id"] for r in docs.collect()) == sorted({r["component_id"] for r in found})
        if name == "decontamination":
            blocks = decontaminate.fit(before, spark.read.parquet(f"{SF}/benchmark.parquet"))
            assert decontaminate.matches(docs, blocks).count() == 0
    words = lambda df: sum(n_words(r["text"]) for r in df.select("text").collect())
    assert abs(words(seen["mixing"]) / words(seen["decontamination"]) - 1.5) < 0.02
    out = seen["sharding"]
    assert out.count() == seen["mixing"].count() and {"shard", "n_bytes", "depth", "shard_bytes"} <= set(out.columns)


def test_odd_rows_and_no_rows(spark):
    for docs in (edge.docs(spark), edge.empty(spark)):
        n = docs.count()
        for name, stage in corpus_pipeline.STAGES:
            docs = corpus_pipeline.materialise(stage(spark, docs, SF), name)
        assert (docs.count() > 0) == (n > 0)
