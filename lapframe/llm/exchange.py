"""Shares whose number follows the data, and rows of several tables brought together by a key."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapframe.llm.blocks import BLOCK_BYTES, pack, partitions, release, slices
from lapframe.session import materialize

#: Text behind one share of a shuffle, so that a share stays small however large the corpus is.
SHARE_BYTES = 16 << 20


def shares(blocks: DataFrame, block_bytes: int = BLOCK_BYTES, share_bytes: int = SHARE_BYTES) -> int:
    """How many shares the text of the written blocks needs: at least the session's own number."""
    return max(partitions(blocks), -(-blocks.count() * block_bytes // share_bytes))


def arrow_schema(ddl: str) -> pa.Schema:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary(), "string": pa.string(), "double": pa.float64()}
    return pa.schema([(n, kinds[k]) for n, k in (c.split() for c in ddl.split(", "))])


def together(parts: list[tuple[DataFrame, str]], key: str, work: Callable[..., pa.Table], result: str, n: int | None = None) -> DataFrame:
    """Call ``work`` once for each value of ``key``, with one Arrow table for each part.

    ``parts`` are tables with the columns that their schema names, all of them with the key.
    """
    columns = {c: k for _, ddl in parts for c, k in (x.split() for x in ddl.split(", "))}
    names = [[c.split()[0] for c in ddl.split(", ")] for _, ddl in parts]

    def shaped(i: int, df: DataFrame) -> DataFrame:
        own = [(F.col(c) if c in names[i] else F.lit(None).cast(k)).alias(c) for c, k in columns.items()]
        return df.select(F.lit(i).alias("part"), *own)

    rows = shaped(0, parts[0][0])
    for i, (df, _) in enumerate(parts[1:], 1):
        rows = rows.unionAll(shaped(i, df))
    if n:
        rows = rows.repartition(n, key)

    def run(table: pa.Table) -> pa.Table:
        part = np.asarray(table["part"])
        out = work(*[table.filter(pa.array(part == i)).select(own) for i, own in enumerate(names)])
        release()
        return out

    return rows.groupBy(key).applyInArrow(run, result)


def text_blocks(rows: DataFrame, text: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Write rows as blocks ``block long, docs binary`` of about ``block_bytes`` of text, with all their columns.

    The table is written to the shared folder, so that a block keeps its number when it is read again.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, text, block_bytes):
                yield pa.RecordBatch.from_pydict(
                    {"block": [uuid.uuid4().int >> 65], "docs": [pack(part)]}, arrow_schema("block long, docs binary")
                )

    return materialize(rows.mapInArrow(run, "block long, docs binary"), "blocks")
