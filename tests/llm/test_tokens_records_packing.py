import zlib

import numpy as np
import pytest
from conftest_llm import ODD
from pyspark.sql import functions as F

from tablegauge.llm import packing, records
from tablegauge.llm.tokens import TextEncoder


@pytest.fixture(scope="module")
def plain(tokenizer):
    from tokenizers import Tokenizer
    t = Tokenizer.from_file(tokenizer)
    t.encode_special_tokens = True
    return lambda text: t.encode(text or "", add_special_tokens=False).ids


def test_encoder_equals_library(spark, tokenizer, plain):
    texts = [t or "" for t in ODD] + [r[0] for r in spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
                                      .select("text").collect()]
    for keep in (0, 400_000):
        enc = TextEncoder(tokenizer, keep_words=keep)
        for _ in range(2):
            assert [a.tolist() for a in enc.encode(texts)] == [plain(t) for t in texts]


@pytest.mark.parametrize("blank", [" ", "\n", "  ", " \n", "\n ", "\n\n", "\t", " \t ", "\n \n", "\xa0", " ", "   "])
def test_encoder_blanks(tokenizer, plain, blank):
    enc = TextEncoder(tokenizer)
    for t in (f"a{blank}b", f"{blank}a", f"a{blank}", f"a.{blank}'s{blank}3", blank):
        assert enc.encode([t])[0].tolist() == plain(t)


def _want_records(rows, plain, end):
    at, out = 0, []
    for key, text in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")):
        ids = np.array(plain(text) + [end], dtype="<u4")
        out.append((key, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    return out


def test_records_round_trip(spark, docs, tokenizer, plain):
    rows = list(enumerate(ODD)) + [(None, "no id"), (3, "again"), (3, "again")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("id", F.lit("clash")).withColumn("path", F.lit(1))
    got = [tuple(r) for r in records.token_records(df, tokenizer, 2).collect()]
    assert sorted(got, key=lambda r: r[1]) == _want_records(rows, plain, 2)


def test_records_index_and_checksums(spark, tokenizer, plain, tmp_path):
    df = spark.createDataFrame(list(enumerate(ODD)), "doc_id long, text string")
    m = records.write_records(df, str(tmp_path / "r"), tokenizer, 2, file_bytes=2000).collect()
    assert len(m) > 1 and sum(r.n_docs for r in m) == len(ODD)
    for r in m:
        order = list(reversed(range(r.n_docs)))
        for key, ids in records.fetch(r.path, order):
            assert ids.tolist() == plain(ODD[key]) + [2]
    path = m[0].path
    raw = bytearray(open(path, "rb").read())
    raw[-6] ^= 1
    open(path, "wb").write(raw)
    with open(path, "rb") as f, pytest.raises(ValueError):
        while records.read_frame(f) is not None:
            pass


def test_records_are_read_by_as_many_tasks_as_their_bytes_ask_for(spark, tokenizer, tmp_path, monkeypatch):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    m = records.write_records(docs, str(tmp_path / "r"), tokenizer, 2, file_bytes=3000)
    files, tokens = m.count(), m.agg(F.sum("n_tokens")).first()[0]
    assert files > 8
    whole = sorted(tuple(r) for r in records.read_records(m).collect())
    for size, tasks in ((tokens, 4), (1, files), (1 << 40, 1)):
        monkeypatch.setattr(records, "READ_BYTES", size)
        out = records.read_records(m)
        assert out.rdd.getNumPartitions() == tasks
        assert sorted(tuple(r) for r in out.collect()) == whole


def test_record_folders(spark, tokenizer, tmp_path, monkeypatch):
    assert records.shared_folder(spark, str(tmp_path)) == str(tmp_path)
    assert records.shared_folder(spark, f"file://{tmp_path}") == f"file:{tmp_path}"
    assert records.shared_folder(spark, "s3a://bucket/a") == "s3://bucket/a"
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    kept = conf.get("fs.defaultFS")
    conf.set("fs.defaultFS", "viewfs://elsewhere/")      # a folder without a scheme is not the executor's own
    conf.set("fs.viewfs.mounttable.elsewhere.link./a", f"file://{tmp_path}")
    try:
        assert records.shared_folder(spark, "/a/b") == "viewfs://elsewhere/a/b"
    finally:
        conf.set("fs.defaultFS", kept)
    with pytest.raises(ValueError, match="ftp"):
        records.write_records(spark.createDataFrame([(1, "a")], "doc_id long, text string"), "ftp://host/a", tokenizer, 2)


def test_records_empty_table(spark, tokenizer):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert records.token_records(df, tokenizer, 2).collect() == []


def _check_packing(rows, out, plain, limits):
    by_doc, by_seq = {}, {}
    for r in out:
        by_doc.setdefault(r.doc_id, []).append(r)
        by_seq.setdefault(r.sequence_id, []).append(r)
    for key, text in rows:
        ids = np.array(plain(text) + [1], dtype="<u4")
        at = 0
        for r in sorted(by_doc[key], key=lambda r: r.start):
            assert r.start == at and r.doc_tokens == len(ids)
            assert r.ids_crc32 == zlib.crc32(ids[at:at + r.length].tobytes())
            at += r.length
        assert at == len(ids)
    for seq in by_seq.values():
        at = 0
        for k, r in enumerate(sorted(seq, key=lambda r: r.offset)):
            assert r.offset == at and r.segment == k
            at += r.length
        assert at <= limits.tokens and len(seq) <= limits.segments and sum(r.loss_tokens for r in seq) <= limits.loss_tokens


@pytest.mark.parametrize("limits", [packing.Limits(), packing.Limits(64, 3, 40), packing.Limits(7, 100, 1)])
def test_packing_places_every_id_once(spark, tokenizer, plain, limits):
    rows = list(enumerate(ODD * 2))
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("share", F.lit("x"))
    out = packing.pack(df, tokenizer, 1, limits, loss_share=F.lit(0.5)).collect()
    _check_packing(rows, out, plain, limits)


def test_packing_little_padding(spark, tokenizer):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").coalesce(1)
    p = packing.padding(packing.pack(df, tokenizer, 1)).first()
    assert p.padding < 2048 and p.tokens > 100_000


def test_packing_empty_table(spark, tokenizer):
    assert packing.pack(spark.createDataFrame([], "doc_id long, text string"), tokenizer, 1).collect() == []


def test_dot_product_prefers_the_dimension_with_room():
    placed = []
    p = packing.Packer(packing.Limits(10, 10, 4), lambda *a: placed.append(a))
    p.add([("loss", 4, 4), ("plain", 5, 0), ("mixed", 6, 2)])
    p.finish()
    first = [a[0] for a in placed if a[4] == 0]
    assert sum(a[2] for a in placed) == 15 and first[0] == "loss" and "mixed" in first
