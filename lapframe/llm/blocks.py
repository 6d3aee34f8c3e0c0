"""Blocks of documents as rows, and arrays as binary columns.

Spark moves and stores the blocks; the work inside a block is done on arrays. A block holds
about ``block_bytes`` of text (a longer document is a block of its own), so a task's memory does
not depend on the size of the corpus.
"""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Collection, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lapframe.session import materialize

BLOCK_BYTES = 2 << 20


def pack(table: pa.Table) -> bytes:
    sink = pa.BufferOutputStream()
    options = pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", 6))
    with pa.ipc.new_stream(sink, table.schema, options=options) as out:
        out.write_table(table)
    return sink.getvalue().to_pybytes()


def release() -> None:
    """Give memory that the last block or batch has left back to the system.

    A Python worker lives on from task to task, and would else keep the most it ever needed.
    """
    pa.default_memory_pool().release_unused()
    if _trim is not None:
        _trim(0)


_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)


def released(batches: Iterator, work: Callable) -> Iterator:
    """The results of ``work`` on each batch, with memory given back after each."""
    for batch in batches:
        yield work(batch)
        release()


def unpack(blob: bytes | pa.Buffer) -> pa.Table:
    release()
    return pa.ipc.open_stream(pa.py_buffer(blob)).read_all()


def array(value: pa.Scalar, dtype: type) -> np.ndarray:
    """The array that a binary value holds."""
    return np.frombuffer(value.as_buffer(), dtype) if value.is_valid else np.zeros(0, dtype)


def squeezed(values: np.ndarray) -> bytes:
    """Numbers that mostly grow by little, in few bytes: steps, byte by byte of all, compressed."""
    if not len(values):
        return b""
    steps = np.diff(values, prepend=values.dtype.type(0))
    planes = steps.view(np.uint8).reshape(len(values), -1).T.tobytes()
    return len(values).to_bytes(4, "little") + pa.compress(planes, "zstd", asbytes=True)


def unsqueezed(blob: bytes, dtype: type) -> np.ndarray:
    if not len(blob):
        return np.zeros(0, dtype)
    n, width = int.from_bytes(blob[:4], "little"), np.dtype(dtype).itemsize
    planes = np.frombuffer(pa.decompress(blob[4:], n * width, "zstd"), np.uint8)
    return np.cumsum(np.ascontiguousarray(planes.reshape(width, n).T).view(dtype).ravel(), dtype=dtype)


def joined(column: pa.ChunkedArray, dtype: type, squeeze: bool = False) -> np.ndarray:
    """The arrays of all rows, one after another."""
    if squeeze:
        parts = [unsqueezed(v.as_py(), dtype) for v in column if v.is_valid]
    else:
        parts = [array(v, dtype) for v in column]
    return np.concatenate(parts) if parts else np.zeros(0, dtype)


def partitions(df: DataFrame) -> int:
    """How many shares a shuffle of this session is cut into."""
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def slices(batch: pa.RecordBatch | pa.Table, text: str, limit: int) -> Iterator[pa.Table]:
    """Consecutive rows of about ``limit`` bytes of text each."""
    sizes = np.asarray(pc.fill_null(pc.binary_length(batch.column(text)), 0))
    begin, held = 0, 0
    for i, size in enumerate(sizes):
        held += int(size) + 16
        if held >= limit:
            yield _table(batch, begin, i + 1)
            begin, held = i + 1, 0
    if begin < batch.num_rows:
        yield _table(batch, begin, batch.num_rows)


def _table(batch: pa.RecordBatch | pa.Table, begin: int, end: int) -> pa.Table:
    part = batch.slice(begin, end - begin)
    return pa.Table.from_batches([part]) if isinstance(part, pa.RecordBatch) else part


def document_blocks(docs: DataFrame, id_col: Column, text_col: Column, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Write documents as rows ``block long, docs binary``; ``docs`` unpacks to ``doc_id, th, text``,
    ``th`` being a hash of the text.

    The table is written to the shared folder, so that a block keeps its number when it is read again.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", block_bytes):
                yield pa.RecordBatch.from_pydict(
                    {"block": [uuid.uuid4().int >> 65], "docs": [pack(part)]},
                    pa.schema([("block", pa.int64()), ("docs", pa.binary())]),
                )

    rows = docs.select(id_col.cast("long").alias("doc_id"), F.xxhash64(text_col).alias("th"), text_col.cast("string").alias("text"))
    return materialize(rows.mapInArrow(run, "block long, docs binary"), "blocks")


def routed(
    share: np.ndarray, n_shares: int, columns: dict[str, np.ndarray], fixed: dict, squeeze: Collection[str] = ()
) -> pa.RecordBatch:
    """One row per share that has entries: ``share``, the fixed values, and each array as binary, squeezed where named."""
    order = np.argsort(share, kind="stable")
    ends = np.searchsorted(share[order], np.arange(n_shares + 1))
    full = np.flatnonzero(np.diff(ends))
    out: dict[str, pa.Array] = {"share": pa.array(full.astype(np.int32))}
    for name, value in fixed.items():
        out[name] = pa.array(np.full(len(full), value, np.int64))
    for name, values in columns.items():
        values = np.ascontiguousarray(values[order])
        put = squeezed if name in squeeze else np.ndarray.tobytes
        out[name] = pa.array([put(values[ends[s] : ends[s + 1]]) for s in full], pa.binary())
    return pa.RecordBatch.from_pydict(out)

