"""Substring dedup by relative Lempel-Ziv parsing over distributed reference blocks.

Every block of documents is a reference. A document is parsed from left to right into factors: a factor
begins at the first word whose next ``min_words`` words also stand at an earlier place of some block, takes the
earliest such place as its source, and runs on as long as the earliest place of the next words is the next place of that source.
The next factor begins after it, so factors never overlap. At a factor's end the windows that lie over the end are
looked up too, so a repeat that straddles two factors is found as well. Factors and these straddling windows
are what is removed. (A later source may match longer than the earliest one; then the parse has two factors where one would do, and
removes the same words.)

The steps, each linear in the text:

1. Documents are written as blocks. In each window of ``min_words`` words the least hash of its
   short word runs is its anchor; a block's distinct anchors (about one for seven words) go to
   the share that owns the hash, and those that two blocks have, or one block twice, stay.
2. Only windows under such an anchor can repeat. Their 64-bit hashes go to the share that owns
   them, one entry for each block (the earliest there), so a passage that a third of all
   documents share costs one entry a block. The share names the earliest place of all.
3. Every block takes back its repeated windows with their sources, and forms factors.

"Earlier" compares (doc_id, start); rows that share a doc_id are compared by start. A null id comes
after all others. Null and empty texts have no words; an empty table gives an empty one. A very long text is a block
of its own. Other columns are not read. Equal windows are told by 64 hash bits
and the share; there are as many shares as the written blocks need, so a share does not grow with the corpus.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapframe.llm.blocks import BLOCK_BYTES, array, document_blocks, joined, routed, squeezed, unpack
from lapframe.llm.exchange import shares
from lapframe.llm.words import Words, grams, mix, sliding_argmin, utf8, whole

MIN_WORDS = 20
U64 = np.uint64
NO_ID = np.iinfo(np.int64).max

ANCHORS = "share int, block long, hash binary, number binary"
WANTED = "block long, number binary"
WINDOWS = "share int, block long, hash binary, doc binary, start binary, at binary"
REPEATS = "block long, at binary, doc binary, start binary"
PARSED = (
    "doc_id long, n_words long, n_removed long, kept string, "
    "factors array<struct<start:int,length:int,source_doc:long,source_start:int>>"
)


class Block:
    """The words, windows and anchors of one block."""

    def __init__(self, blob, min_words: int):
        self.table = unpack(blob)
        ids = self.table["doc_id"].combine_chunks()
        self.ids = np.asarray(ids.fill_null(NO_ID)).astype(np.int64)
        self.words = Words(*utf8(self.table["text"]))
        self.h = self.words.hashes()
        #: Places where a window begins, and the anchor of each.
        self.begins = np.flatnonzero(whole(self.words.first, len(self.h), min_words))
        run = max(1, min_words * 2 // 5)
        short = grams(self.h, run)
        self.site = sliding_argmin(short, min_words - run + 1)[self.begins]
        self.anchor = short[self.site]

    def repeated_anchors(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Distinct anchors, which of them stand at two places of the block, and each window's."""
        new = np.ones(len(self.site), bool)
        new[1:] = self.site[1:] != self.site[:-1]
        anchors, counts = np.unique(self.anchor[new], return_counts=True)
        return anchors, counts > 1, np.searchsorted(anchors, self.anchor)


def _anchors(min_words: int, n_shares: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for block, blob in zip(batch["block"], batch["docs"]):
                anchors, twice, _ = Block(blob.as_buffer(), min_words).repeated_anchors()
                number = np.flatnonzero(~twice).astype(np.uint32)
                own = anchors[number]
                share = ((own >> U64(32)) % U64(n_shares)).astype(np.int64)
                # What one block has twice is known to repeat; others must hear of it all the same.
                more = anchors[twice]
                number = np.concatenate([number, np.flatnonzero(twice).astype(np.uint32)])
                share = np.concatenate([share, ((more >> U64(32)) % U64(n_shares)).astype(np.int64)])
                low = np.concatenate([own, more]).astype(np.uint32)
                yield routed(share, n_shares, {"hash": low, "number": number}, {"block": block.as_py()}, ["number"])

    return run


def _common(table: pa.Table) -> pa.Table:
    """Of one share: the anchors that two blocks have, by block."""
    h = joined(table["hash"], np.uint32)
    number = joined(table["number"], np.uint32, True)
    sizes = [len(v.as_buffer()) // 4 for v in table["hash"]]
    source = np.repeat(np.arange(table.num_rows), sizes)
    order = np.argsort(h, kind="stable")
    same = h[order][1:] == h[order][:-1]
    twice = np.zeros(len(h), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    ends = np.searchsorted(source[twice], np.arange(table.num_rows + 1))
    number = number[twice]
    return pa.table(
        {
            "block": table["block"].combine_chunks(),
            "number": pa.array([squeezed(number[a:b]) for a, b in zip(ends, ends[1:])], pa.binary()),
        }
    )


def _windows(min_words: int, n_shares: int):
    def run(blocks: pa.Table, wanted: pa.Table) -> pa.Table:
        parts = []
        for block, blob in zip(blocks["block"], blocks["docs"]):
            b = Block(blob.as_buffer(), min_words)
            _, keep, own = b.repeated_anchors()
            keep[joined(wanted["number"], np.uint32, True)] = True
            at = b.begins[keep[own]]
            h = grams(b.h, min_words)[at]
            text = np.repeat(np.arange(len(b.ids)), b.words.counts)[at]
            doc, start = b.ids[text], (at - b.words.first[text]).astype(np.int64)
            order = np.lexsort((start, doc, h))
            first = np.ones(len(order), bool)
            first[1:] = h[order][1:] != h[order][:-1]
            at, h, doc, start = (x[order][first] for x in (at, h, doc, start))
            order = np.argsort(at)
            at, h, doc, start = (x[order] for x in (at, h, doc, start))
            share = (mix(h) % U64(n_shares)).astype(np.int64)
            columns = {"hash": h, "doc": doc, "start": start.astype(np.uint32), "at": at.astype(np.uint32)}
            parts.append(routed(share, n_shares, columns, {"block": block.as_py()}, ["doc", "start", "at"]))
        return pa.Table.from_batches(parts, _schema(WINDOWS))

    return run


def _schema(ddl: str) -> pa.Schema:
    kinds = {"int": pa.int32(), "long": pa.int64(), "binary": pa.binary()}
    return pa.schema([(n, kinds[k]) for n, k in (c.split() for c in ddl.split(", "))])


def _earliest(table: pa.Table) -> pa.Table:
    """Of one share: windows that stand at an earlier place too, by block, with that place."""
    h, doc = joined(table["hash"], np.uint64), joined(table["doc"], np.int64, True)
    start, at = joined(table["start"], np.uint32, True), joined(table["at"], np.uint32, True)
    source = np.repeat(np.arange(table.num_rows), [len(v.as_buffer()) // 8 for v in table["hash"]])
    order = np.lexsort((start, doc, h))
    new = np.ones(len(order), bool)
    new[1:] = h[order][1:] != h[order][:-1]
    head = order[np.flatnonzero(new)[np.cumsum(new) - 1]] if len(order) else order
    # A window of the head's own block is there once; other rows with its id and start are equals.
    mine, theirs = order[~new], head[~new]
    by = np.lexsort((at[mine], source[mine]))
    mine, theirs = mine[by], theirs[by]
    ends = np.searchsorted(source[mine], np.arange(table.num_rows + 1))
    rows = [slice(a, b) for a, b in zip(ends, ends[1:])]
    return pa.table(
        {
            "block": table["block"].combine_chunks(),
            "at": pa.array([squeezed(at[mine[r]]) for r in rows], pa.binary()),
            "doc": pa.array([squeezed(doc[theirs[r]]) for r in rows], pa.binary()),
            "start": pa.array([squeezed(start[theirs[r]]) for r in rows], pa.binary()),
        }
    )


def _parse(min_words: int):
    def run(blocks: pa.Table, wanted: pa.Table, repeats: pa.Table) -> pa.Table:
        """Factors of every document of a block from its repeated windows."""
        out = [_parsed(Block(blob.as_buffer(), min_words), min_words, wanted, repeats) for blob in blocks["docs"]]
        return pa.concat_tables(out) if out else PARSED_SCHEMA.empty_table()

    return run


PARSED_SCHEMA = pa.schema(
    [
        ("doc_id", pa.int64()),
        ("n_words", pa.int64()),
        ("n_removed", pa.int64()),
        ("kept", pa.string()),
        (
            "factors",
            pa.list_(pa.struct([("start", pa.int32()), ("length", pa.int32()), ("source_doc", pa.int64()), ("source_start", pa.int32())])),
        ),
    ]
)


def _factors(
    at: np.ndarray, source_doc: np.ndarray, source_start: np.ndarray, text_of: np.ndarray, min_words: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Parse from left to right, given the windows (by place) that have an earlier source.

    A factor begins at the first such window that is not before the last factor's end, and takes all that its source goes on
    with. Returned are the factors' places, lengths and first windows, and the windows that lie over a factor's end.
    """
    goes_on = np.zeros(len(at), bool)
    goes_on[1:] = (np.diff(at) == 1) & (np.diff(source_start) == 1) & (source_doc[1:] == source_doc[:-1])
    goes_on[1:] &= text_of[at[1:]] == text_of[at[:-1]]
    heads = np.flatnonzero(~goes_on)
    if not len(at):
        return at, at, at, at
    # Of each window: the last one that its source goes on to.
    last = np.repeat(np.append(heads[1:], len(at)) - 1, np.diff(np.append(heads, len(at))))
    chosen, ends, i = [], [], 0
    while i < len(at):
        end = int(at[last[i]]) + min_words
        chosen.append(i)
        ends.append(end)
        i = int(np.searchsorted(at, end))
    first, end = np.array(chosen, np.int64), np.array(ends, np.int64)
    # What begins inside a factor and is not over with it.
    own = np.searchsorted(first, np.arange(len(at)), "right") - 1
    over = at + min_words > end[own]
    return at[first], end - at[first], first, at[over]


def _parsed(b: Block, min_words: int, wanted: pa.Table, repeats: pa.Table) -> pa.Table:
    n = len(b.h)
    text_of = b.words.texts_of()
    start_of = np.arange(n) - b.words.first[text_of] if n else np.zeros(0, np.int64)
    # The earliest place of each repeated window: in this block, unless another block has an earlier one.
    _, keep, own = b.repeated_anchors()
    keep[joined(wanted["number"], np.uint32, True)] = True
    at = b.begins[keep[own]]
    h = grams(b.h, min_words)[at]
    doc, start = b.ids[text_of[at]], start_of[at]
    order = np.lexsort((start, doc, h))
    new = np.ones(len(order), bool)
    new[1:] = h[order][1:] != h[order][:-1]
    group = np.cumsum(new) - 1
    head = order[new]
    source_doc, source_start = doc[head], start[head]
    other = np.searchsorted(at, joined(repeats["at"], np.uint32, True).astype(np.int64))
    rank = np.empty(len(order), np.int64)
    rank[order] = group
    theirs_doc, theirs_start = joined(repeats["doc"], np.int64, True), joined(repeats["start"], np.uint32, True).astype(np.int64)
    source_doc[rank[other]], source_start[rank[other]] = theirs_doc, theirs_start
    source_doc, source_start = source_doc[rank], source_start[rank]
    earlier = (source_doc < doc) | ((source_doc == doc) & (source_start < start))
    at, source_doc, source_start = at[earlier], source_doc[earlier], source_start[earlier]

    begin, length, chosen, straddling = _factors(at, source_doc, source_start, text_of, min_words)
    steps = np.zeros(n + 1, np.int64)
    np.add.at(steps, np.concatenate([begin, straddling]), 1)
    np.add.at(steps, np.concatenate([begin + length, straddling + min_words]), -1)
    gone = np.cumsum(steps)[:n] > 0

    factor_text = text_of[begin]
    ends = np.searchsorted(factor_text, np.arange(len(b.ids) + 1))
    factors = pa.StructArray.from_arrays(
        [
            pa.array(start_of[begin].astype(np.int32)),
            pa.array(length.astype(np.int32)),
            pa.array(source_doc[chosen], mask=source_doc[chosen] == NO_ID),
            pa.array(source_start[chosen].astype(np.int32)),
        ],
        ["start", "length", "source_doc", "source_start"],
    )
    removed = np.add.reduceat(np.append(gone, False).astype(np.int64), np.minimum(b.words.first[:-1], n)) if len(b.ids) else np.zeros(0, np.int64)
    removed[b.words.counts == 0] = 0
    data, edges = b.words.data.tobytes(), b.words.offsets
    kept = []
    for i, some in enumerate(removed):
        if not some:
            kept.append(b" ".join(data[edges[i] : edges[i + 1]].split()))
        elif some == b.words.counts[i]:
            kept.append(b"")
        else:
            own = slice(b.words.first[i], b.words.first[i + 1])
            stay = ~gone[own]
            kept.append(b" ".join([data[x:y] for x, y in zip(b.words.starts[own][stay].tolist(), b.words.ends[own][stay].tolist())]))
    return pa.table(
        {
            "doc_id": b.table["doc_id"].combine_chunks(),
            "n_words": pa.array(b.words.counts.astype(np.int64)),
            "n_removed": pa.array(removed),
            "kept": pa.array(kept, pa.binary()).cast(pa.string()),
            "factors": pa.ListArray.from_arrays(pa.array(ends.astype(np.int32)), factors),
        },
        PARSED_SCHEMA,
    )


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = MIN_WORDS, block_bytes: int = BLOCK_BYTES
) -> DataFrame:
    """Per document its kept words (joined by one space) and its factors with their sources."""
    blocks = document_blocks(docs, F.col(id_col), F.col(text_col), block_bytes)
    n = shares(blocks, block_bytes)
    wanted = blocks.mapInArrow(_anchors(min_words, n), ANCHORS).groupBy("share").applyInArrow(_common, WANTED)
    wanted = wanted.filter(F.length("number") > 0)
    # Rows of one block, whatever they are: its documents, its wanted anchors, its repeated windows.
    found = together(blocks, wanted, _two(_windows(min_words, n)), WINDOWS)
    repeats = found.groupBy("share").applyInArrow(_earliest, REPEATS).filter(F.length("at") > 0)
    return together(blocks, wanted, _three(_parse(min_words)), PARSED, repeats)


ROW = "block long, docs binary, number binary, at binary, doc binary, start binary"


def together(blocks: DataFrame, wanted: DataFrame, work, result: str, repeats: DataFrame | None = None) -> DataFrame:
    """Bring the rows of each block into one call."""

    def shaped(df: DataFrame) -> DataFrame:
        have = set(df.columns)
        return df.select([(F.col(n) if n in have else F.lit(None)).cast(k if k == "binary" else "long").alias(n) for n, k in (c.split() for c in ROW.split(", "))])

    rows = shaped(blocks).unionAll(shaped(wanted))
    if repeats is not None:
        rows = rows.unionAll(shaped(repeats))
    return rows.groupBy("block").applyInArrow(work, result)


def _two(work):
    def run(table: pa.Table) -> pa.Table:
        return work(table.filter(table["docs"].is_valid()), table.filter(table["number"].is_valid()))

    return run


def _three(work):
    def run(table: pa.Table) -> pa.Table:
        return work(table.filter(table["docs"].is_valid()), table.filter(table["number"].is_valid()), table.filter(table["at"].is_valid()))

    return run


def query(spark, sf_dir: str) -> DataFrame:
    parsed = remove_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return parsed.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


ORACLE = r"""
WITH word AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
win AS (SELECT doc_id, s, sha256(array_to_string(w[s:s + 19], ' ')) AS k FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS s FROM word WHERE len(w) >= 20)),
ranked AS (SELECT doc_id, s, row_number() OVER (PARTITION BY k ORDER BY doc_id, s) AS r FROM win),
gone AS (SELECT DISTINCT doc_id, unnest(range(s, s + 20)) AS p FROM ranked WHERE r > 1),
flat AS (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS p FROM word),
kept AS (SELECT f.doc_id, count(g.p) AS n_removed, string_agg(f.x, ' ' ORDER BY f.p) FILTER (WHERE g.p IS NULL) AS t
  FROM flat f LEFT JOIN gone g ON f.doc_id = g.doc_id AND f.p = g.p GROUP BY f.doc_id)
SELECT w.doc_id, CAST(len(w.w) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM word w LEFT JOIN kept USING (doc_id)
"""
