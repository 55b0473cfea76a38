"""Helpers shared by the operators: words, shared folders, Arrow passes."""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tablegauge.session import ensure_checkpoint_dir, scratch_path

#: A word is a run of anything but the ASCII blanks; the SQL form of bytes.split().
WORD_BREAK = r"[\x20\x09-\x0D]+"

#: Bytes of text that a Python task handles at a time.
BLOCK_BYTES = 8 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def sql_words(text: Column) -> Column:
    """The words of a text as an array; null and blank texts have none."""
    parts = F.split(F.coalesce(text, F.lit("")), WORD_BREAK)
    return F.filter(parts, lambda w: w != "")


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, each with underscores added until no column of ``df`` has it."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        out.append(name)
    return out


def cut_lineage(df: DataFrame) -> DataFrame:
    """A checkpoint in the folder that the cluster shares, so a lost
    executor costs a read and not a recomputation."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def write_shared(df: DataFrame, name: str) -> str:
    """Write a table below the shared checkpoint folder and return its path."""
    path = scratch_path(df.sparkSession, name)
    df.write.mode("error").parquet(path)
    return path


def give_back() -> None:
    """Return memory that this process has freed to the system."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)      # glibc has it
    if trim:
        trim(0)


#: What a Python worker keeps from task to task, by name.
KEPT: dict[str, object] = {}


def trimmed(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], keeps: str | None = None) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The pass ``run``, which at its end gives back what it has freed.  Spark
    keeps a Python worker for later tasks, and what it holds meanwhile is
    missing to the executor's stages without Python.  Of what earlier passes
    left in ``KEPT`` only ``keeps`` stays."""
    @functools.wraps(run)
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for name in KEPT.keys() - {keeps}:
            del KEPT[name]
        yield from run(batches)
        give_back()         # here the variables of run are gone
    return task


def blocks(batches: Iterable[pa.RecordBatch], text_col: str, size: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the Arrow batches with about ``size`` bytes of text each, so
    that long texts don't pile up in a task."""
    for batch in batches:
        n = batch.num_rows
        if not n:
            continue
        sizes = pc.binary_length(batch.column(text_col)).to_pylist()
        start = held = 0
        for i, b in enumerate(sizes):
            if held and held + (b or 0) > size:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += b or 0
        yield batch.slice(start, n - start)
