"""Ranked lexical search by Block-Max MaxScore over shards of an inverted index.

``build_index`` writes one row per shard of documents: the terms with their document counts, the posting lists in blocks
of 128 postings, and for each block its bounds. Documents of a shard are numbered by length, so the postings of
a block come from documents of similar length, and a block's highest frequency and least length bound its
scores closely. The bounds need no corpus statistics, so an index can be built before they are known.

``search`` sums up the statistics, sends the queries to the tasks, and evaluates each query shard by shard:

* A list's bound is its highest block bound. Lists are sorted by bound; those whose bounds together stay below the
  score needed are non-essential. Only documents of the other, essential, lists are candidates.
* Candidates are looked up in the non-essential lists, the highest bound first. The bound of the block that would hold a candidate
  rejects it before the block is decompressed.
* The score needed is that of the ``k``-th best found so far, in the shards before and among the partial scores.

A task keeps one heap of ``k`` per query; heaps are merged by Spark in two steps. Every rejected document has a lower
score than ``k`` others, so the results are those of scoring everything.

Scores follow a fixed integer formula (``weight``, ``norm`` and ``impact``). Null and empty texts have no terms and are no documents
for the statistics. Repeated rows are documents of their own. Equal scores are ranked by id, a null id last. Every row of the items is
a query of its own, also with a repeated or null id; an item without terms, or whose terms nothing holds, has no rows. A very long text
is a shard of its own. Empty tables give empty results. Extra columns are not read. Terms are compared as strings.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lapframe.llm.blocks import pack, partitions, release, slices, unpack
from lapframe.llm.words import LETTERS, Words, strings, utf8
from lapframe.session import materialize

K = 10
POSTINGS = 128
SHARD_BYTES = 8 << 20
PASS_WORDS = 2_000_000

INDEX = "n_docs long, n_words long, docs binary, terms binary, heads binary, postings binary"
FOUND = "query long, doc_id long, score long"


def weight(n_docs: int, df: int) -> int:
    """How much a term counts. The formula is given."""
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def norm(length: int, n_docs: int, n_words: int) -> int:
    """What a document's length takes away. The formula is given."""
    return 10 + 90 * length * n_docs // n_words


def impact(tf: np.ndarray, norms: np.ndarray) -> np.ndarray:
    """What occurrences are worth; grows with ``tf`` and falls with the norm. The formula is given."""
    return 1_000_000_000 * tf // (1000 * tf + 8 * norms)


def _widths(largest: np.ndarray) -> np.ndarray:
    return np.where(largest < 1 << 8, 1, np.where(largest < 1 << 16, 2, 4))


def _put(out: np.ndarray, at: np.ndarray, values: np.ndarray, width: np.ndarray) -> None:
    for b in range(4):
        some = width > b
        out[at[some] + b] = (values[some] >> (8 * b)) & 0xFF


def build_shard(table: pa.Table, block: int = POSTINGS) -> dict[str, object]:
    """The index of one shard, from ``doc_id`` and ``text``."""
    words = Words(*utf8(table["text"]), LETTERS)
    order = np.argsort(words.counts, kind="stable")
    order = order[words.counts[order] > 0]
    number = np.empty(len(words.counts), np.int64)
    number[order] = np.arange(len(order))
    length = words.counts[order].astype(np.int64)
    spelled = strings(words).dictionary_encode()
    n = max(1, len(order))
    pairs, tf = np.unique(np.asarray(spelled.indices).astype(np.int64) * n + number[words.texts_of()], return_counts=True)
    term, doc = pairs // n, pairs % n
    df = np.bincount(term, minlength=len(spelled.dictionary)) if len(term) else np.zeros(0, np.int64)
    n_blocks = -(-df // block)
    first_block = np.cumsum(n_blocks) - n_blocks
    begin = np.repeat(np.cumsum(df) - df, n_blocks) + block * (np.arange(n_blocks.sum()) - np.repeat(first_block, n_blocks))
    size = np.diff(np.append(begin, len(doc)))
    end = begin + size - 1
    low, high = doc[begin], doc[end]
    most = np.maximum.reduceat(tf, begin) if len(begin) else tf
    doc_width, tf_width = _widths(high - low), _widths(most)
    place = np.cumsum(size * (doc_width + tf_width)) - size * (doc_width + tf_width)
    inner = np.arange(len(doc)) - np.repeat(begin, size)
    out = np.zeros(int((size * (doc_width + tf_width)).sum()), np.uint8)
    wide = np.repeat(doc_width, size)
    _put(out, np.repeat(place, size) + inner * wide, doc - np.repeat(low, size), wide)
    wide = np.repeat(tf_width, size)
    _put(out, np.repeat(place + size * doc_width, size) + inner * wide, tf, wide)
    heads = {"low": low, "high": high, "most": most, "size": size, "doc_width": doc_width, "tf_width": tf_width}
    return {
        "n_docs": len(order),
        "n_words": int(length.sum()),
        "docs": pack(pa.table({"doc_id": table["doc_id"].combine_chunks().take(pa.array(order)), "length": length})),
        "terms": pack(pa.table({"term": spelled.dictionary, "df": df})),
        "heads": pack(pa.table({c: v.astype(np.int32) for c, v in heads.items()})),
        "postings": out.tobytes(),
    }


def build_index(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shard_bytes: int = SHARD_BYTES, block: int = POSTINGS
) -> DataFrame:
    """The inverted index of the documents, one row per shard, written to the shared folder."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for part in slices(batch, "text", shard_bytes):
                held.append(part)
                size += part["text"].nbytes
                if size >= shard_bytes:
                    yield _row(held, block)
                    held, size = [], 0
                    release()
        if held:
            yield _row(held, block)
            release()

    rows = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    return materialize(rows.mapInArrow(run, INDEX), "lexical-index")


def _row(parts: list[pa.Table], block: int) -> pa.RecordBatch:
    shard = build_shard(pa.concat_tables(parts).combine_chunks(), block)
    kinds = [(c, pa.int64() if isinstance(v, int) else pa.binary()) for c, v in shard.items()]
    return pa.RecordBatch.from_pydict({c: [v] for c, v in shard.items()}, pa.schema(kinds))


@dataclass
class Queries:
    """Queries over numbered terms."""

    numbers: list[int]
    terms: pa.Array
    wanted: list[np.ndarray]


def encode(items: list[tuple[int, str | None]]) -> Queries:
    """The distinct terms of each query."""
    words = Words(*utf8(pa.array([t for _, t in items], pa.string())), LETTERS)
    spelled = strings(words).dictionary_encode()
    code = np.asarray(spelled.indices)
    return Queries([n for n, _ in items], spelled.dictionary, [np.unique(code[a:b]) for a, b in zip(words.first, words.first[1:])])


class Shard:
    """One row of the index, with what the queries need of it."""

    def __init__(self, row: dict[str, pa.Scalar], queries: Queries, weights: np.ndarray, n_docs: int, n_words: int):
        docs, terms, heads = (unpack(row[c].as_buffer()) for c in ("docs", "terms", "heads"))
        self.ids = docs["doc_id"].combine_chunks()
        lengths, place = np.unique(np.asarray(docs["length"]), return_inverse=True)
        self.norms = np.array([norm(int(x), n_docs, n_words) for x in lengths], np.int64)[place]
        self.postings = row["postings"].as_buffer()
        head = {c: np.asarray(heads[c]).astype(np.int64) for c in heads.column_names}
        self.low, self.high, self.size = head["low"], head["high"], head["size"]
        self.doc_width, self.tf_width = head["doc_width"], head["tf_width"]
        bytes_ = self.size * (self.doc_width + self.tf_width)
        self.place = np.cumsum(bytes_) - bytes_
        block_ends = list_ends(np.asarray(terms["df"]), self.size)
        at = pc.index_in(queries.terms, value_set=terms["term"].combine_chunks())
        self.there = np.asarray(at.is_valid()) & (weights > 0)
        at = np.asarray(at.fill_null(0)).astype(np.int64)
        self.end = np.where(self.there, block_ends[at] if len(block_ends) else 0, 0)
        self.begin = np.where(self.there, np.append(0, block_ends)[at], 0)
        self.weights = weights
        #: The highest score that a posting of a block can give, for the blocks of the queries' terms.
        self.bound = np.zeros(len(self.size), np.int64)
        self.best = np.zeros(len(weights), np.int64)
        own = np.flatnonzero(self.there)
        n = (self.end - self.begin)[own]
        blocks = np.repeat(self.begin[own] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        # Documents are numbered by length: the first of a block has the least norm.
        self.bound[blocks] = np.repeat(weights[own], n) * impact(head["most"][blocks], self.norms[self.low[blocks]])
        if len(own):
            self.best[own] = np.maximum.reduceat(self.bound[blocks], np.cumsum(n) - n)
        self.cache: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        #: How many blocks were decompressed.
        self.opened = 0

    def block(self, term: int, b: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents of a block, and what the term adds to each."""
        found = self.cache.get(b)
        if found is None:
            self.opened += 1
            n, wide, narrow, at = int(self.size[b]), int(self.doc_width[b]), int(self.tf_width[b]), int(self.place[b])
            doc = np.frombuffer(self.postings, f"<u{wide}", n, at).astype(np.int64) + self.low[b]
            tf = np.frombuffer(self.postings, f"<u{narrow}", n, at + n * wide).astype(np.int64)
            found = self.cache[b] = doc, self.weights[term] * impact(tf, self.norms[doc])
        return found

    def blocks(self, term: int, numbers: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        parts = [self.block(term, b) for b in numbers.tolist()]
        return parts[0] if len(parts) == 1 else tuple(np.concatenate(x) for x in zip(*parts))

    def search(self, wanted: np.ndarray, least: int, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents that may be among the ``k`` best, with their scores; a score below ``least`` is not needed."""
        terms = wanted[self.there[wanted]]
        terms = terms[np.argsort(self.best[terms], kind="stable")]
        reach = np.cumsum(self.best[terms])
        split = int(np.searchsorted(reach, least))
        score = np.zeros(len(self.ids), np.int64)
        for t in terms[split:]:
            doc, more = self.blocks(t, np.arange(self.begin[t], self.end[t]))
            score[doc] += more
        doc = np.flatnonzero(score)
        for i in range(split - 1, -1, -1):
            if len(doc) > k:
                least = max(least, int(np.partition(score[doc], len(doc) - k)[len(doc) - k]))
            doc = doc[score[doc] + reach[i] >= least]
            t = terms[i]
            b = self.begin[t] + np.searchsorted(self.high[self.begin[t] : self.end[t]], doc)
            inside = b < self.end[t]
            inside[inside] = self.low[b[inside]] <= doc[inside]
            limit = np.where(inside, self.bound[np.minimum(b, len(self.bound) - 1)], 0)
            able = score[doc] + limit + (reach[i - 1] if i else 0) >= least
            doc, b, inside = doc[able], b[able], inside[able]
            if inside.any():
                held, more = self.blocks(t, np.unique(b[inside]))
                look = doc[inside]
                at = np.minimum(np.searchsorted(held, look), len(held) - 1)
                score[look] += np.where(held[at] == look, more[at], 0)
        if len(doc) > k:
            least = max(least, int(np.partition(score[doc], len(doc) - k)[len(doc) - k]))
        doc = doc[score[doc] >= max(least, 1)]
        return doc, score[doc]


def list_ends(df: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The block after each list's last: lists follow one another, and a block never runs over a list's end."""
    return np.searchsorted(np.cumsum(sizes), np.cumsum(df)) + 1


class Heap:
    """The ``k`` best documents of a query."""

    def __init__(self, k: int):
        self.k, self.score, self.null, self.ids = k, np.zeros(0, np.int64), np.zeros(0, bool), np.zeros(0, np.int64)

    @property
    def least(self) -> int:
        return int(self.score[-1]) if len(self.score) == self.k else 1

    def add(self, score: np.ndarray, ids: pa.Array) -> None:
        score = np.append(self.score, score)
        null = np.append(self.null, np.asarray(ids.is_null()))
        ids = np.append(self.ids, np.asarray(ids.fill_null(0)).astype(np.int64))
        order = np.lexsort((ids, null, -score))[: self.k]
        self.score, self.null, self.ids = score[order], null[order], ids[order]


def document_counts(index: DataFrame, terms: pa.Array) -> np.ndarray:
    """In how many documents each term occurs."""
    sent = index.sparkSession.sparkContext.broadcast(terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(sent.value), np.int64)
        for batch in batches:
            for blob in batch["terms"]:
                own = unpack(blob.as_buffer())
                at = pc.index_in(sent.value, value_set=own["term"].combine_chunks())
                there = np.flatnonzero(np.asarray(at.is_valid()))
                total[there] += np.asarray(own["df"])[np.asarray(at.fill_null(0))[there]]
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_pydict({"term": some, "n": total[some]})

    found = index.select("terms").mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    sent.destroy()
    out = np.zeros(len(terms), np.int64)
    out[np.asarray(found["term"])] = np.asarray(found["n"])
    return out


def _search(index: DataFrame, queries: Queries, n_docs: int, n_words: int, k: int) -> DataFrame:
    df = document_counts(index, queries.terms)
    weights = np.array([weight(n_docs, int(x)) if x else 0 for x in df], np.int64)
    sent = index.sparkSession.sparkContext.broadcast((queries, weights))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, heavy = sent.value
        heaps = [Heap(k) for _ in own.wanted]
        for batch in batches:
            for i in range(batch.num_rows):
                shard = Shard({c: batch[c][i] for c in batch.schema.names}, own, heavy, n_docs, n_words)
                for wanted, heap in zip(own.wanted, heaps):
                    doc, score = shard.search(wanted, heap.least, k)
                    if len(doc):
                        heap.add(score, shard.ids.take(pa.array(doc)))
                release()
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(np.array(own.numbers, np.int64), [len(h.score) for h in heaps])),
                pa.concat_arrays([pa.array(h.ids, pa.int64(), mask=h.null) for h in heaps] + [pa.array([], pa.int64())]),
                pa.array(np.concatenate([h.score for h in heaps] + [np.zeros(0, np.int64)])),
            ],
            ["query", "doc_id", "score"],
        )

    return index.drop("n_docs", "n_words").mapInArrow(run, FOUND)


def search(
    index: DataFrame, items: DataFrame, item_col: str = "item_id", text_col: str = "text", k: int = K, pass_words: int = PASS_WORDS
) -> DataFrame:
    """The ``k`` best documents of every row of ``items``: its id as ``item_id``, ``rank, doc_id, score``.

    The items are sent to the tasks in parts of about ``pass_words`` words, so their size is bounded.
    """
    numbered = items.select(
        F.monotonically_increasing_id().alias("query"), F.col(f"`{item_col}`").alias("item_id"), F.col(f"`{text_col}`").cast("string").alias("text")
    )
    numbered = materialize(numbered, "queries")
    totals = index.agg(F.sum("n_docs"), F.sum("n_words")).first()
    n_docs, n_words = int(totals[0] or 0), int(totals[1] or 0)
    size = numbered.agg(F.sum(F.length("text"))).first()[0] or 0
    n = max(1, -(-int(size) // (6 * pass_words)))
    found = None
    for i in range(n):
        part = numbered if n == 1 else numbered.filter(F.pmod(F.xxhash64("query"), F.lit(n)) == i)
        queries = encode([(r.query, r.text) for r in part.select("query", "text").collect()])
        one = _search(index, queries, n_docs, n_words, k)
        found = one if found is None else found.unionAll(one)
    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    salt = F.pmod(F.xxhash64("doc_id"), F.lit(partitions(index)))
    for window in (Window.partitionBy("query", salt), Window.partitionBy("query")):
        found = found.withColumn("rank", F.row_number().over(window.orderBy(*order))).filter(F.col("rank") <= k)
    return found.join(numbered.select("query", "item_id"), "query").select("item_id", "rank", "doc_id", "score")


def query(spark, sf_dir: str) -> DataFrame:
    index = build_index(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return search(index, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


ORACLE = r"""
WITH doc AS (SELECT row_number() OVER () AS d, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
item AS (SELECT row_number() OVER () AS q, item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM benchmark),
total AS (SELECT count(*) AS nd, CAST(sum(len(w)) AS BIGINT) AS nw FROM doc WHERE len(w) > 0),
term AS (SELECT DISTINCT q, unnest(w) AS t FROM item),
posting AS (SELECT d, t, count(*) AS tf FROM (SELECT d, unnest(w) AS t FROM doc) WHERE t IN (SELECT t FROM term) GROUP BY d, t),
weighted AS (SELECT t, CAST(floor(1000 * ln((2 * nd + 2)::DOUBLE / (2 * df + 1)::DOUBLE)) AS BIGINT) AS w FROM (SELECT t, count(*) AS df FROM posting GROUP BY t), total),
normed AS (SELECT d, doc_id, 10 + (90 * len(w) * nd) // nw AS m FROM doc, total),
scored AS (SELECT q, doc_id, d, CAST(sum(w.w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
  FROM term JOIN posting USING (t) JOIN weighted w USING (t) JOIN normed USING (d) GROUP BY q, d, doc_id),
ranked AS (SELECT q, doc_id, score, row_number() OVER (PARTITION BY q ORDER BY score DESC, doc_id NULLS LAST) AS rank FROM scored WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked JOIN item USING (q) WHERE rank <= 10
"""
