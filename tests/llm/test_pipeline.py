import json
import os
import threading
import zlib
from types import SimpleNamespace

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from tidemark.llm import common, jaccard, pii, queries, toxicity

from . import test_jaccard, test_passages

SF = "/root/testdata/sf0.001"


def test_stages_equal_plain_versions(spark):
    """Each stage on all that its predecessor kept, against brute force."""
    docs = common.documents(spark, SF)
    model = toxicity.fit(docs, common.documents(spark, SF, "labels"))
    rows = [r.asDict() for r in docs.orderBy("doc_id").collect()]
    rows = [r for r in rows if model.score(r["text"]) < 0.5]
    stage = corpus_pipeline.STAGES[0][1](spark, docs, SF)
    assert stage.columns == docs.columns and sorted(r.doc_id for r in stage.collect()) == [r["doc_id"] for r in rows]

    component = test_jaccard.brute([r["text"] for r in rows])
    rows = [r for k, r in enumerate(rows) if component[k][1] == k]
    left = test_passages.brute_words([r["text"] for r in rows])
    anchors, coder = pii.automaton(), Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    stages, kept = [common.written(stage)], None
    for _, f in corpus_pipeline.STAGES[1:4]:
        stages.append(common.written(f(spark, stages[-1], SF)))
        assert stages[-1].columns == docs.columns
    assert [r.doc_id for r in stages[1].orderBy("doc_id").collect()] == [r["doc_id"] for r in rows]
    kept = {r.doc_id: r for r in stages[2].collect()}
    for r, text in zip(rows, left, strict=True):
        assert (kept[r["doc_id"]].text or "") == text and kept[r["doc_id"]].n_chars == len(text)
    final = {r.doc_id: r.text for r in stages[3].collect()}
    assert all(final[i] == pii.redact(r.text, pii.find(anchors, r.text)) for i, r in kept.items())

    pieces = corpus_pipeline.run(spark, SF).collect()
    assert {p.doc_id for p in pieces} == set(final)
    for p in pieces:
        ids = [*coder.encode(final[p.doc_id], add_special_tokens=False).ids, 0]
        assert p.doc_tokens == len(ids) and p.ids_crc32 == zlib.crc32(np.array(ids[p.start : p.start + p.length], "<u4").tobytes())


def test_run_leaves_only_its_result(spark):
    """Tables of the stages go, the pieces stay readable."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    before = set(os.listdir(folder))
    pieces = corpus_pipeline.run(spark, SF)
    new = set(os.listdir(folder)) - before
    assert len(new) <= 1 and pieces.agg(F.sum("length")).first()[0] == pieces.dropDuplicates(["doc_id"]).agg(F.sum("doc_tokens")).first()[0]


def test_blocks_of_two_threads(spark):
    """A block that ends in one thread leaves another thread's tables alone."""
    with common.scratch(spark):
        mine = common.written(spark.range(5))

        def other():
            with common.scratch(spark) as paths:
                common.written(spark.range(3))
                assert len(paths) == 1

        t = threading.Thread(target=other)
        t.start()
        t.join()
        assert mine.count() == 5 and len(common.SCRATCH.open) == 1


def test_edges_pass_all_stages(spark, edge, empty):
    for df in (edge, empty, common.documents(spark, SF).limit(0)):
        for _, f in corpus_pipeline.STAGES:
            if "text" in df.columns:
                before, df = df, common.written(f(spark, df, SF))
        # the last stage's pieces hold each document that the stage before kept, whole
        pieces = df.groupBy("doc_id").agg(F.sum("length").alias("n"), F.sum("doc_tokens").alias("all"), F.count("*").alias("pieces")).collect()
        kept = [r.doc_id for r in before.select("doc_id").collect()]
        assert {r.doc_id for r in pieces} == set(kept) and sum(r.n for r in pieces if r.pieces == 1) == sum(r["all"] for r in pieces if r.pieces == 1)
        assert len(kept) > 5 if df.count() else kept == []


def test_one_row_that_is_a_third_of_all(spark):
    """Repeats fold where they are read: nothing numbers their rows, and one of them stays."""
    rows = [(7, "one two three four five six seven " * 3, "en", None, 1)] * 300 + [(100 + k, f"w{k} " * 9 + f"x{k} y{k} z{k} a{k} b{k}", "en", "s", 1) for k in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    kept = jaccard.one_of_each(docs)
    assert sorted(r.doc_id for r in kept.collect()) == [7, *range(100, 160)]
    assert "Window" not in kept._jdf.queryExecution().executedPlan().toString()


def test_registered_names():
    names = list(queries.queries())
    assert json.dumps([n.split("_")[0] for n in names]) == json.dumps([f"op{k}" for k in range(1, 14)])


def test_a_cluster_must_name_its_shared_folder():
    for master, fine in (("local[4]", True), ("local", True), ("local-cluster[2,1,1024]", False), ("spark://host:7077", False), ("yarn", False)):
        context = SimpleNamespace(master=master, applicationId="none", getConf=lambda: SimpleNamespace(get=lambda k: None))
        spark = SimpleNamespace(sparkContext=context, conf=SimpleNamespace(get=lambda k, d=None: "/tmp/warehouse" if "warehouse" in k else None))
        if fine:
            assert common.shared_folder(spark)
        else:
            with pytest.raises(ValueError):
                common.shared_folder(spark)
