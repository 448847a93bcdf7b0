"""The pipeline, stage by stage, each against a plain version on its own input."""

import re

import corpus_pipeline
from floodmark.llm import mixing, quality
from floodmark.llm.common import written
from tests.llm.test_brute_force import components


def test_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns = docs.columns
    for k, (name, stage) in enumerate(corpus_pipeline.STAGES):
        out = written(stage(spark, docs, sf_dir), f"test-{k}")
        before = {r.doc_id: r.text for r in docs.collect()}
        if k < 4:
            assert out.columns == columns
        after = [r.doc_id for r in out.collect()]
        if name == "quality classifier":
            model = quality.fit_model(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
            scores = model.tails(quality.Scorer(model).scores(list(before.values())))[:, -1].round(6)
            assert sorted(after) == sorted(i for i, s in zip(before, scores, strict=True) if s >= quality.ACCEPT)
        elif name == "exact dedup":
            first = {}
            for i in sorted(before):
                first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", before[i]), i)
            assert sorted(after) == sorted(first.values())
        elif name == "n-gram Jaccard join":
            assert sorted(after) == sorted(i for i, _, c in components(sorted(before.items())) if i == c)
        elif name == "mixing sources to target weights":
            assert sorted(after) == sorted(r.doc_id for r in mixing.mix_documents(docs).filter("sampled").collect())
        else:
            assert set(after) == set(before)
        docs = out


def test_run_equals_its_stages(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
        docs = written(stage(spark, docs, sf_dir), f"run-{k}")
    key = lambda df: sorted((r.doc_id, r.piece, r.length, r.ids_crc32) for r in df.collect())
    assert key(corpus_pipeline.run(spark, sf_dir)) == key(docs)
