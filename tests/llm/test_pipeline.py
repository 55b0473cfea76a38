import zlib

import numpy as np
import pytest
import test_pii
import test_simhash
from pyspark.sql import functions as F

import __spark_entry__
import corpus_pipeline
from tablegauge.llm import catalog, decontaminate, quality
from tablegauge.llm.tokens import TextEncoder

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark):
    """Each stage's rows on sf0.01, each stage fed with its predecessor's."""
    out = [("documents", spark.read.parquet(f"{SF}/documents.parquet").collect())]
    schema = spark.read.parquet(f"{SF}/documents.parquet").schema
    for name, fn in corpus_pipeline.STAGES:
        df = fn(spark, spark.createDataFrame(out[-1][1], schema), SF)
        if name != "packing":
            assert df.columns == schema.names
        out.append((name, df.collect()))
    return dict(out)


def test_quality_stage_keeps_what_the_model_accepts(spark, stages):
    kept = {r.doc_id for r in stages["quality_classifier"]}
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    good = [i in kept for i, q in labels.items() if q == 1]
    bad = [i in kept for i, q in labels.items() if q == 0]
    assert np.mean(good) > .98 and np.mean(bad) < .15
    want = {r.doc_id for r in catalog.op2_quality_classifier(spark, SF).collect() if r.predicted == 1}
    assert kept == want


def test_near_dedup_stage(stages):
    rows = stages["quality_classifier"]
    fps = {r.doc_id: test_simhash.brute_fingerprint(r.text) for r in rows}
    comp = test_simhash.brute_components(set(fps.values()), 2)
    first = {}
    for i in sorted(fps):
        first.setdefault(comp[fps[i]], i)
    assert sorted(r.doc_id for r in stages["simhash_near_dedup"]) == sorted(first.values())
    assert len(first) < len(rows)


def test_decontamination_stage(spark, stages):
    items = [decontaminate.normalise(r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    exact = {r.doc_id for r in stages["simhash_near_dedup"] if any(s in decontaminate.normalise(r.text) for s in items)}
    before, after = ({r.doc_id: r.text for r in stages[k]} for k in ("simhash_near_dedup", "benchmark_decontamination"))
    assert exact and not exact & after.keys() and len(before) - len(after) < len(exact) + 5
    assert all(before[i] == t for i, t in after.items())


def test_pii_stage(stages):
    before = {r.doc_id: r for r in stages["benchmark_decontamination"]}
    after = {r.doc_id: r for r in stages["pii"]}
    assert before.keys() == after.keys()
    changed = 0
    for i, r in after.items():
        assert test_pii.brute(r.text) == [] and r.n_chars == len(r.text)
        found = test_pii.brute(before[i].text)
        assert bool(found) == (r.text != before[i].text)
        changed += bool(found)
    assert changed > 10


def test_packing_stage(stages, tokenizer):
    enc = TextEncoder(tokenizer)
    by_doc = {}
    for r in stages["packing"]:
        by_doc.setdefault(r.doc_id, []).append(r)
    assert by_doc.keys() == {r.doc_id for r in stages["pii"]}
    for r in stages["pii"]:
        ids = np.append(enc.encode([r.text])[0], 1).astype("<u4")
        at = 0
        for p in sorted(by_doc[r.doc_id], key=lambda p: p.start):
            assert p.start == at and p.ids_crc32 == zlib.crc32(ids[at:at + p.length].tobytes())
            at += p.length
        assert at == len(ids)


def test_run_and_registration(spark, stages):
    q = __spark_entry__.queries()
    assert q["pipeline"] is corpus_pipeline.run and {n.split("_")[0] for n in q if n.startswith("op")} >= {f"op{i}" for i in range(1, 11)}
    got = corpus_pipeline.run(spark, SF)
    total = lambda rows: (len({r.doc_id for r in rows}), sum(r.length for r in rows))
    assert total(got.collect()) == total(stages["packing"])


def test_empty_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, SF)
        assert out.collect() == []


def test_odd_documents(spark):
    from conftest_llm import ODD
    rows = [(i, t, None, None, None) for i, t in enumerate(ODD)] + [(None, "no id", None, None, None)]
    docs = spark.createDataFrame(rows, spark.read.parquet(f"{SF}/documents.parquet").schema)
    again = [(3, "a", None, None, None)] * 2 + [(None, "a", None, None, None)] * 2 + [(None, "lonely words", None, None, None)] * 2
    kept = corpus_pipeline.near_dedup_stage(spark, spark.createDataFrame(again, docs.schema), SF).collect()
    assert sorted((r.doc_id or -1, r.text) for r in kept) == [(-1, "lonely words"), (3, "a")]
    for _, stage in corpus_pipeline.STAGES[1:]:
        docs = stage(spark, docs, SF)
    assert docs.agg(F.count("*")).first()[0] > 0
