from pyspark.sql import functions as F

import corpus_pipeline
from meterline.llm import decontamination, packing, tokens
from meterline.llm.common import written
from tests.llm.inputs import SMALL, awkward, documents
from tests.llm.test_near_duplicates import brute
from tests.llm.test_personal_data import base

import public_tokenizers


def test_stages_take_effect(spark):
    docs, before = documents(spark), None
    for name, stage in corpus_pipeline.STAGES:
        out = written(stage(spark, docs, SMALL), name)
        have, had = {r["doc_id"]: r for r in out.collect()}, {r["doc_id"]: r for r in docs.collect()}
        if name != "packing":
            assert out.columns == docs.columns and have.keys() <= had.keys() and out.count() == len(have)
        if name == "toxicity":
            labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{SMALL}/labels.parquet").collect()}
            clean = [i for i, x in labels.items() if not x]
            assert sum(i in have for i in clean) >= 0.97 * len(clean)
        if name == "near_duplicates":
            want = brute([(i, r["text"]) for i, r in had.items()], 5, 80)
            assert have.keys() == {i for i, (_, c) in want.items() if i == c}
        if name == "decontamination":
            items = [decontamination.normal(r["text"]) for r in spark.read.parquet(f"{SMALL}/benchmark.parquet").collect()]
            dirty = {i for i, r in had.items() if any(
                decontamination.myers(x, decontamination.normal(r["text"]), decontamination.budget(len(x)))[0]
                <= decontamination.budget(len(x)) for x in items)}
            assert dirty and have.keys() == had.keys() - dirty
        if name == "personal_data":
            assert have.keys() == had.keys()
            for i, r in have.items():
                assert not base(r["text"]) and r["n_chars"] == len(r["text"])
                assert r["text"] == had[i]["text"] or base(had[i]["text"]) or "[context]" in r["text"]
        if name == "packing":
            path = public_tokenizers.path("byte_bpe_50k.json")
            total = sum(len(tokens.library(path).encode(r["text"]).ids) + 1 for r in had.values())
            assert out.agg(F.sum("length")).first()[0] == total
        docs, before = out, have
    assert before
    run = corpus_pipeline.run(spark, SMALL)
    assert run.select("doc_id", "start", "length", "ids_crc32").exceptAll(
        docs.select("doc_id", "start", "length", "ids_crc32")).count() == 0
    assert run.count() == docs.count()


def test_awkward_documents_pass_every_stage(spark):
    docs = awkward(spark)
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = written(stage(spark, docs, SMALL), name)
        assert out.columns == docs.columns
        assert stage(spark, docs.limit(0), SMALL).count() == 0
        docs = out
    assert sorted((r["doc_id"] for r in docs.collect()), key=repr) == sorted(
        [1, 3, 4, 5, 6, 8, 10, 11, 12, None, None], key=repr)
    assert packing.pack(docs).select("doc_id").distinct().count() == 10
