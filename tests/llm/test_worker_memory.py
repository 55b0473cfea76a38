"""Python workers give back what a task has freed before they wait for the next."""

import re
import subprocess
import sys

import pyarrow as pa
import pytest

from tablegauge.llm import common, decontaminate, packing, quality, simhash

MEASURE = """
import re, sys
sys.path.insert(0, {root!r})
import numpy as np
import pyarrow as pa
from tablegauge.llm.common import trimmed
def mb():
    return sum(map(int, re.findall(r"Pss_Anon:\\s+(\\d+)", open("/proc/self/smaps_rollup").read()))) / 1024
held = []
def run(batches):
    for b in batches:
        rows = [np.ones(2000) for _ in range(10000)]    # 160 MB
        held.extend(rows[::50])                          # freed memory lies between what is kept
        yield b
before = mb()
for _ in {run}(iter([pa.RecordBatch.from_pydict({{"a": [1]}})])):
    pass
print(mb() - before)
"""


def grown(run):
    code = MEASURE.format(root=common.__file__.rsplit("/", 3)[0], run=run)
    out = subprocess.run([sys.executable, "-c", code], capture_output=True, text=True, timeout=120, check=True).stdout
    return float(re.search(r"[-0-9.]+$", out.strip()).group())


@pytest.mark.skipif(not sys.platform.startswith("linux"), reason="reads /proc")
def test_freed_memory_leaves_the_worker():
    assert grown("run") > 100       # what a plain pass leaves
    assert grown("trimmed(run)") < 40


def test_python_stages_of_the_pipeline_give_back(docs, spark, tokenizer, monkeypatch):
    texts = ["some words of a text", None, "", "other words of another text that is longer"]
    rows = docs(texts)
    items = spark.createDataFrame([(1, "an item that no text here holds, long enough")], "item_id long, text string")
    model = quality.Model(quality.np.zeros(quality.N_FEATURES), quality.np.ones(quality.N_FEATURES), None)
    passes, ended = [], []
    through = type(rows).mapInArrow

    def caught(self, func, *a, **b):
        passes.append((self, func))
        return through(self, func, *a, **b)
    monkeypatch.setattr(type(rows), "mapInArrow", caught)
    monkeypatch.setattr(common, "give_back", lambda: ended.append(1))
    quality.keep(rows, model)
    quality.fit(rows.selectExpr("text", "1 as label"))
    simhash.fingerprints(rows)
    decontaminate.clean(rows, items)
    packing.pack(rows, tokenizer, end_id=1)
    assert len(passes) == 5
    task = type("Task", (), {"partitionId": lambda self: 0})
    monkeypatch.setattr("pyspark.TaskContext.get", staticmethod(task))
    for n, (df, func) in enumerate(passes, 1):
        batches = pa.Table.from_pylist([r.asDict() for r in df.collect()], _schema(df)).to_batches()
        ended.clear()
        common.KEPT["other"] = common.KEPT["encoders"] = {}
        assert list(func(iter(batches))) and ended
        assert set(common.KEPT) == ({"encoders"} if n == 5 else set())      # packing's words don't wait through other stages


def _schema(df):
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "double": pa.float64(), "string": pa.string(), "binary": pa.binary()}
    return pa.schema([(n, kinds[t]) for n, t in df.dtypes])
