"""Token-ID / binary output: length-delimited records with masked checksums
and a separate offset index.

A data file is a run of frames, little-endian::

    uint64 n | uint32 masked crc of those 8 bytes | n bytes | uint32 masked crc of the n bytes

The n bytes are ``uint8 has_id | int64 id | uint8 bytes per token | token
ids``; ids take 2 bytes when the vocabulary fits, else 4.  Beside
``x.rec`` lies ``x.idx``: one ``int64 id | uint64 position | uint32 frame
bytes | uint32 tokens`` for each frame, so readers can fetch any record, in
any order, without scanning.  A checksum is CRC-32, rotated right by 15
bits plus a constant, as usual for files that may hold checksums themselves.

The rows are range-partitioned by id and sorted inside; each task streams
its rows into files of bounded size in a shared folder and reports them in
a manifest.  A task that runs twice writes files of other names, and only
those of the attempt that Spark keeps are in the manifest.

Edge cases: a null text is an empty text (only the end id); null ids come
first and are kept as null; repeated ids are all kept, in the order of
their texts; an empty table gives no file and no row; other columns are
not read.
"""

from __future__ import annotations

import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tablegauge.llm.common import blocks
from tablegauge.llm.tokens import encoder
from tablegauge.session import default_parallelism, scratch_path

_MASK_DELTA = 0xA282EAD8
_HEAD = struct.Struct("<QI")
_ID = struct.Struct("<BqB")
_INDEX = struct.Struct("<qQII")

#: Token bytes (four a token at most) that a reading task is given.
READ_BYTES = 8 << 20

MANIFEST = "part int, file int, path string, n_docs long, n_tokens long"


def masked_crc(data: bytes) -> int:
    c = zlib.crc32(data)
    return ((c >> 15 | c << 17) + _MASK_DELTA) & 0xFFFFFFFF


def frame(payload: bytes) -> bytes:
    head = struct.pack("<Q", len(payload))
    return head + struct.pack("<I", masked_crc(head)) + payload + struct.pack("<I", masked_crc(payload))


def read_frame(f) -> bytes | None:
    """The next payload of a data file, None at its end; ValueError if a checksum is wrong."""
    head = f.read(_HEAD.size)
    if not head:
        return None
    if len(head) < _HEAD.size:
        raise ValueError("a record's length is cut short")
    n, crc = _HEAD.unpack(head)
    if masked_crc(head[:8]) != crc:
        raise ValueError("a record's length has a wrong checksum")
    body = f.read(n + 4)
    if len(body) < n + 4 or struct.unpack("<I", body[n:])[0] != masked_crc(body[:n]):
        raise ValueError("a record has a wrong checksum")
    return body[:n]


def parse(payload: bytes) -> tuple[int | None, np.ndarray]:
    has_id, key, width = _ID.unpack_from(payload)
    ids = np.frombuffer(payload, dtype=f"<u{width}", offset=_ID.size)
    return (key if has_id else None), ids


#: Schemes of Hadoop's file systems and what Arrow calls them.
SCHEMES = {"file": "file", "hdfs": "hdfs", "viewfs": "viewfs", "s3": "s3", "s3a": "s3", "s3n": "s3", "gs": "gs",
           "abfs": "abfs", "abfss": "abfss"}


def shared_folder(spark: SparkSession, folder: str) -> str:
    """The folder as Arrow names it.  A path without a scheme is one of the
    session's default file system, as everywhere in Spark, and not of each
    executor's own disk; a file system that Arrow lacks is refused here,
    before any task runs."""
    sc = spark.sparkContext
    path = sc._jvm.org.apache.hadoop.fs.Path(folder)
    if path.toUri().getScheme() is None:
        path = path.getFileSystem(sc._jsc.hadoopConfiguration()).makeQualified(path)
        if path.toUri().getScheme() == "file":
            return folder
    scheme, _, rest = path.toString().partition(":")
    if scheme not in SCHEMES:
        raise ValueError(f"records can't be written to {scheme}: folders, only to {', '.join(sorted(SCHEMES))}")
    return f"{SCHEMES[scheme]}:{rest}"


def open_fs(path: str):
    """File system and inner path, for local paths and whatever URI Arrow knows."""
    from pyarrow import fs
    if "://" not in path and not path.startswith("file:"):
        return fs.LocalFileSystem(), path
    if path.startswith("file:"):
        return fs.LocalFileSystem(), "/" + path[5:].lstrip("/")
    return fs.FileSystem.from_uri(path)


class _Writer:
    """Streams frames into one data file and its index."""

    def __init__(self, folder: str, part: int, number: int):
        fs, inner = open_fs(folder)
        fs.create_dir(inner, recursive=True)
        name = f"part-{part:06d}-{number:04d}-{uuid.uuid4().hex[:12]}"
        self.path = f"{folder.rstrip('/')}/{name}.rec"
        self.data = fs.open_output_stream(f"{inner.rstrip('/')}/{name}.rec")
        self.index = fs.open_output_stream(f"{inner.rstrip('/')}/{name}.idx")
        self.number, self.size, self.docs, self.tokens = number, 0, 0, 0

    def add(self, key: int | None, ids: np.ndarray, width: int) -> None:
        out = frame(_ID.pack(key is not None, key or 0, width) + ids.astype(f"<u{width}").tobytes())
        self.data.write(out)
        self.index.write(_INDEX.pack(key or 0, self.size, len(out), len(ids)))
        self.size += len(out)
        self.docs += 1
        self.tokens += len(ids)

    def close(self) -> None:
        self.data.close()
        self.index.close()


def write_records(df: DataFrame, folder: str, tokenizer: str, end_id: int, id_col: str = "doc_id",
                  text_col: str = "text", file_bytes: int = 64 << 20) -> DataFrame:
    """Write every row's token ids plus ``end_id`` in ascending id order.

    :param folder: a folder that all executors share (see :func:`shared_folder`)
    :param file_bytes: a data file is closed when it reaches this size
    :return: the manifest, one row per data file, read from ``folder``
    """
    spark = df.sparkSession
    given, folder = folder, shared_folder(spark, folder)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext
        enc, part = encoder(tokenizer), TaskContext.get().partitionId()
        width = 2 if max(enc.vocab_size - 1, end_id) < 1 << 16 else 4
        end = np.array([end_id], dtype=np.uint32)
        out, done = None, []
        for b in blocks(batches, "text"):
            texts = [t or "" for t in b.column("text").to_pylist()]
            for key, ids in zip(b.column("id").to_pylist(), enc.encode(texts)):
                if out is None:
                    out = _Writer(folder, part, len(done))
                out.add(key, np.concatenate([ids, end]), width)
                if out.size >= file_bytes:
                    out.close()
                    done.append(out)
                    out = None
        if out is not None:
            out.close()
            done.append(out)
        if done:
            yield pa.RecordBatch.from_pydict({
                "part": pa.array([part] * len(done), pa.int32()), "file": pa.array([w.number for w in done], pa.int32()),
                "path": pa.array([w.path for w in done]), "n_docs": pa.array([w.docs for w in done], pa.int64()),
                "n_tokens": pa.array([w.tokens for w in done], pa.int64())})

    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    ordered = rows.repartitionByRange(default_parallelism(spark), F.col("id").asc_nulls_first()) \
        .sortWithinPartitions(F.col("id").asc_nulls_first(), "text")
    path = f"{given.rstrip('/')}/manifest"
    ordered.mapInArrow(write, MANIFEST).write.mode("error").parquet(path)
    return spark.read.schema(MANIFEST).parquet(path)


def read_records(manifest: DataFrame) -> DataFrame:
    """One row per record of the files in the manifest: its id, the tokens
    before it in the whole set, its token count and the CRC-32 of its ids
    as 32-bit integers.  Every checksum is verified.  The files are dealt to
    as many tasks as their bytes ask for."""
    per_part = manifest.groupBy("part").agg(F.sum("n_tokens").alias("t"))
    # one row per writing task, so the running sum over them is small
    before = per_part.select("part", (F.sum("t").over(Window.orderBy("part")) - F.col("t")).alias("before"))
    inside = F.sum("n_tokens").over(Window.partitionBy("part").orderBy("file")) - F.col("n_tokens")
    todo = manifest.withColumn("inside", inside).join(before, "part") \
        .select("path", (F.col("before") + F.col("inside")).alias("start"))

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for path, at in zip(b.column("path").to_pylist(), b.column("start").to_pylist()):
                fs, inner = open_fs(path)
                with fs.open_input_stream(inner, buffer_size=1 << 20) as f:
                    rows: list[tuple] = []
                    while (payload := read_frame(f)) is not None:
                        key, ids = parse(payload)
                        rows.append((key, at, len(ids), zlib.crc32(ids.astype("<u4").tobytes())))
                        at += len(ids)
                        if len(rows) == 20_000:
                            yield _table(rows)
                            rows = []
                    if rows:
                        yield _table(rows)

    # a number that the planner keeps: the manifest's own few bytes would end in one task
    size = manifest.agg(F.count("*"), F.sum("n_tokens")).first()
    tasks = max(1, min(size[0], -(-4 * (size[1] or 0) // READ_BYTES)))
    return todo.repartition(tasks).mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def _table(rows: list[tuple]) -> pa.RecordBatch:
    cols = list(zip(*rows))
    return pa.RecordBatch.from_pydict({n: pa.array(c, pa.int64()) for n, c in zip(
        ("doc_id", "start", "n_tokens", "ids_crc32"), cols)})


def fetch(path: str, positions: list[int]) -> list[tuple[int | None, np.ndarray]]:
    """Records at the given places of one file's index, in that order."""
    fs, inner = open_fs(path)
    with fs.open_input_file(inner[:-4] + ".idx") as f:
        index = f.read()
    out = []
    with fs.open_input_file(inner) as f:
        for i in positions:
            _, at, _, _ = _INDEX.unpack_from(index, i * _INDEX.size)
            f.seek(at)
            out.append(parse(read_frame(f)))
    return out


def token_records(df: DataFrame, tokenizer: str, end_id: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Write the rows below the shared checkpoint folder and read them back."""
    folder = scratch_path(df.sparkSession, "records")
    return read_records(write_records(df, folder, tokenizer, end_id, id_col, text_col))
