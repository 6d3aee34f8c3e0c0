"""Benchmark decontamination with a distributed positional inverted index.

``build_index`` stores, block by block, the postings of every training word: the sorted word
hashes, and for each the places where it stands. ``search`` counts how often the words of the
test items occur in the corpus, and for every ten-word window starts from the postings of its
rarest word and intersects them with the postings of the others, shifted by their offsets, the
rarer first. What remains are exact phrase matches. ``near`` finds proximity matches instead.

The work grows with the index; nothing is shuffled but word counts. The test items are sent to
the tasks in parts of at most ``pass_words`` words, so that their size is bounded too.

Nulls and empty texts have no words and no hits. Equal rows get equal results. Item ids are
compared as strings; a null id is the string "null". Extra columns are not read.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapframe.llm.blocks import BLOCK_BYTES, array, release, slices
from lapframe.llm.words import LETTERS, Words, utf8
from lapframe.session import materialize, new_path

WINDOW = 10
PASS_WORDS = 2_000_000
#: Places that are followed at once, beside those of one window's rarest word.
CANDIDATES = 1 << 18
U64 = np.uint64

INDEX = "block long, docs binary, n_words binary, terms binary, counts binary, places binary"
HITS = "block long, row int, doc_id long, th long, n_words long, marks binary, items array<string>"


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Postings of every word, one row per block of documents, written to the shared folder.

    ``terms`` are sorted word hashes, ``counts`` how many places each has, ``places`` all places in
    that order. A place numbers the words of the block with a gap after each document, so that no
    phrase runs from one document into the next.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, "text", block_bytes):
                words = Words(*utf8(part["text"]), LETTERS)
                h = words.hashes(lower=True)
                place = (np.arange(len(words)) + words.texts_of()).astype(np.uint32)
                order = np.argsort(h, kind="stable")
                terms, counts = np.unique(h, return_counts=True)
                yield pa.RecordBatch.from_pydict(
                    {
                        "block": [uuid.uuid4().int >> 65],
                        "docs": [_ids(part)],
                        "n_words": [words.counts.astype(np.int64).tobytes()],
                        "terms": [terms.tobytes()],
                        "counts": [counts.astype(np.uint32).tobytes()],
                        "places": [place[order].tobytes()],
                    },
                    pa.schema([("block", pa.int64())] + [(c, pa.binary()) for c in "docs n_words terms counts places".split()]),
                )
                del words, h, place, order, terms, counts
                release()

    text = F.col(text_col)
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("th"), text.cast("string").alias("text"))
    return _written(rows.mapInArrow(run, INDEX), "postings")


#: How tables of rows of some megabytes are written: pages of a row or two and row groups of a few. Parquet would else
#: look at its buffers only every 100 rows, and hold as many, in memory that executors keep.
LARGE_ROWS = {
    "parquet.page.size.row.check.min": "1",
    "parquet.block.size.row.check.min": "1",
    "parquet.block.size": str(16 << 20),
}


def _written(df: DataFrame, name: str) -> DataFrame:
    path = new_path(df.sparkSession, name)
    df.write.options(**LARGE_ROWS).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _ids(part: pa.Table) -> bytes:
    """Of each document whether its id is null, its id, and the hash of its text."""
    ids = part["doc_id"].combine_chunks()
    null = np.asarray(ids.is_null()).astype(np.int64)
    return np.stack([null, np.asarray(ids.fill_null(0)).astype(np.int64), np.asarray(part["th"])]).tobytes()


@dataclass
class Queries:
    """Windows of test items over numbered terms."""

    terms: np.ndarray  # sorted hashes of the words
    windows: list[np.ndarray]  # by length: rows of term numbers
    owners: list[list[list[int]]]  # by length and row: items that have the window
    names: list[str]


def encode(items: list[tuple[str, str | None]], window: int = WINDOW) -> Queries:
    """The distinct windows of the items; an item with fewer words is one window."""
    column = pa.array([t for _, t in items], pa.string())
    words = Words(*utf8(column), LETTERS)
    terms, number = np.unique(words.hashes(lower=True), return_inverse=True)
    by_size: dict[int, dict[bytes, list[int]]] = {}
    for i in range(len(items)):
        own = number[words.first[i] : words.first[i + 1]].astype(np.int32)
        size = min(window, len(own))
        for s in range(len(own) - size + 1 if size else 0):
            owners = by_size.setdefault(size, {}).setdefault(own[s : s + size].tobytes(), [])
            if not owners or owners[-1] != i:
                owners.append(i)
    windows = [np.frombuffer(b"".join(x), np.int32).reshape(len(x), k) for k, x in by_size.items()]
    return Queries(terms, windows, [list(x.values()) for x in by_size.values()], [n for n, _ in items])


class Postings:
    """The postings of the query terms in one block."""

    def __init__(self, row: dict, wanted: np.ndarray):
        terms, counts = array(row["terms"], np.uint64), array(row["counts"], np.uint32)
        ends = np.concatenate([[0], np.cumsum(counts, dtype=np.int64)])
        at = np.searchsorted(terms, wanted)
        there = np.zeros(len(wanted), bool)
        inside = at < len(terms)
        there[inside] = terms[at[inside]] == wanted[inside]
        self.begin, self.end = np.zeros(len(wanted), np.int64), np.zeros(len(wanted), np.int64)
        self.begin[there], self.end[there] = ends[at[there]], ends[at[there] + 1]
        self.places = array(row["places"], np.uint32)
        sizes = self.end - self.begin
        #: Sorted (term, place) pairs of the query terms.
        self.pairs = (np.repeat(np.arange(len(wanted)), sizes).astype(np.uint64) << U64(32)) | self.places[
            _ranges(self.begin, sizes)
        ].astype(np.uint64)
        self.sizes = sizes

    def at(self, term: np.ndarray, place: np.ndarray) -> np.ndarray:
        """Which of the terms stand at the places."""
        key = (term.astype(np.uint64) << U64(32)) | place.astype(np.uint64)
        i = np.searchsorted(self.pairs, key)
        out = np.zeros(len(key), bool)
        out[i < len(self.pairs)] = self.pairs[i[i < len(self.pairs)]] == key[i < len(self.pairs)]
        return out & (place >= 0)


def _ranges(begin: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All numbers from begin on, size many, for each pair."""
    total = int(sizes.sum())
    skip = np.repeat(np.cumsum(sizes) - sizes, sizes)
    return np.repeat(begin, sizes) + np.arange(total) - skip


def phrases(postings: Postings, windows: np.ndarray, rarity: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Places where windows stand, and the window's number, a bounded number of candidates at a time."""
    order = np.argsort(rarity[windows], axis=1, kind="stable")
    rows = np.arange(len(windows))
    sizes = postings.sizes[windows]
    rows = rows[(sizes > 0).all(axis=1)]
    first = windows[rows, order[rows, 0]]
    cuts = np.searchsorted(np.cumsum(postings.sizes[first]), np.arange(CANDIDATES, postings.sizes[first].sum() + CANDIDATES, CANDIDATES))
    for part in np.split(np.arange(len(rows)), np.unique(cuts[cuts < len(rows)])):
        if not len(part):
            continue
        own, term = rows[part], first[part]
        n = postings.sizes[term]
        window = np.repeat(own, n)
        place = postings.places[_ranges(postings.begin[term], n)].astype(np.int64) - order[window, 0]
        for k in range(1, windows.shape[1]):
            offset = order[window, k]
            stands = postings.at(windows[window, offset], place + offset)
            window, place = window[stands], place[stands]
        yield place, window


def near(postings: Postings, window: np.ndarray, rarity: np.ndarray, within: int) -> np.ndarray:
    """Places of the rarest word around which every word of the window stands within so many words."""
    terms = np.unique(window)
    terms = terms[np.argsort(rarity[terms], kind="stable")]
    place = postings.places[postings.begin[terms[0]] : postings.end[terms[0]]].astype(np.int64)
    for t in terms[1:]:
        own = postings.places[postings.begin[t] : postings.end[t]].astype(np.int64)
        place = place[np.searchsorted(own, place + within, "right") > np.searchsorted(own, place - within)]
    return place


def corpus_counts(index: DataFrame, terms: np.ndarray) -> np.ndarray:
    """How often each term occurs in the corpus. Reads no places."""
    sent = index.sparkSession.sparkContext.broadcast(terms)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for own, counts in zip(batch["terms"], batch["counts"]):
                own, counts = array(own, np.uint64), array(counts, np.uint32)
                at = np.flatnonzero(np.isin(own, sent.value, assume_unique=True))
                yield pa.RecordBatch.from_pydict(
                    {"term": np.searchsorted(sent.value, own[at]), "n": counts[at].astype(np.int64)}
                )
                release()

    found = index.select("terms", "counts").mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    table = found.toArrow()
    out = np.zeros(len(terms), np.int64)
    out[np.asarray(table["term"])] = np.asarray(table["n"])
    return out


def search(index: DataFrame, queries: Queries, within: int | None = None, finish=None, schema: str = "") -> DataFrame:
    """Exact phrase matches, or with ``within`` proximity matches, of every document.

    Returns a row per document: ``marks`` has a bit per word, ``items`` the matching items. ``finish``
    turns the batches into others of ``schema`` in the same worker.
    """
    rarity = corpus_counts(index, queries.terms)
    sent = index.sparkSession.sparkContext.broadcast((queries, rarity))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q, rare = sent.value
        for batch in batches:
            for row in ({c: batch[c][i] for c in batch.schema.names} for i in range(batch.num_rows)):
                null, ids, th = array(row["docs"], np.int64).reshape(3, -1)
                n_words = array(row["n_words"], np.int64)
                first = np.concatenate([[0], np.cumsum(n_words + 1)])
                steps = np.zeros(int(first[-1]) + 1, np.int32)
                found: list[set[int]] = [set() for _ in ids]
                postings = Postings(row, q.terms)
                for windows, owners in zip(q.windows, q.owners):
                    size = windows.shape[1]
                    if within is None:
                        parts = phrases(postings, windows, rare)
                    else:
                        size = 1
                        parts = ((p := near(postings, w, rare, within), np.full(len(p), i)) for i, w in enumerate(windows))
                    for place, window in parts:
                        np.add.at(steps, place, 1)
                        np.add.at(steps, place + size, -1)
                        pairs = np.unique(np.stack([np.searchsorted(first, place, "right") - 1, window]), axis=1)
                        for d, w in pairs.T:
                            found[d].update(owners[w])
                hit = np.cumsum(steps) > 0
                yield pa.RecordBatch.from_pydict(
                    {
                        "block": pa.array([row["block"].as_py()] * len(ids), pa.int64()),
                        "row": pa.array(np.arange(len(ids), dtype=np.int32)),
                        "doc_id": pa.array(ids, mask=null.astype(bool)),
                        "th": pa.array(th),
                        "n_words": pa.array(n_words),
                        "marks": pa.array([np.packbits(hit[a : a + n]).tobytes() for a, n in zip(first, n_words)], pa.binary()),
                        "items": pa.array([sorted({q.names[i] for i in f}) for f in found], pa.list_(pa.string())),
                    }
                )
                del postings, steps, hit, found, row
                release()

    if finish is None:
        return index.mapInArrow(run, HITS)
    return index.mapInArrow(lambda batches: finish(run(batches)), schema)


def passes(items: DataFrame, id_col: str, text_col: str, pass_words: int) -> Iterator[tuple[list[tuple[str, str | None]], int]]:
    """The test items in parts of bounded size, each read on its own, and how many parts there are."""
    named = items.select(
        F.coalesce(F.col(id_col).cast("string"), F.lit("null")).alias("name"), F.col(text_col).cast("string").alias("text")
    )
    total = named.agg(F.sum(F.length("text"))).first()[0] or 0
    n = max(1, -(-int(total) // (6 * pass_words)))
    for k in range(n):
        part = named if n == 1 else named.filter(F.pmod(F.xxhash64("name", "text"), F.lit(n)) == k)
        yield [(r.name, r.text) for r in part.collect()], n


def find_contamination(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    within: int | None = None,
    pass_words: int = PASS_WORDS,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Per document: ``doc_id, th, n_words, n_hit, items, items_sha256, marks``; ``th`` is a hash of its text."""
    index = build_index(docs, id_col, text_col, block_bytes)
    parts = passes(items, item_col, item_text_col, pass_words)
    part, n_parts = next(parts)
    if n_parts == 1:
        return search(index, encode(part, window), within, _counted, COUNTED)
    union = search(index, encode(part, window), within)
    for part, _ in parts:
        union = union.unionAll(search(index, encode(part, window), within))
    merged = union.groupBy("block", "row").agg(
        F.first("doc_id").alias("doc_id"),
        F.first("th").alias("th"),
        F.first("n_words").alias("n_words"),
        F.collect_list("marks").alias("parts"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
    )
    return merged.mapInArrow(_counted, COUNTED)


COUNTED = "doc_id long, th long, n_words long, n_hit long, items array<string>, items_sha256 string, marks binary"


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        if "parts" in batch.schema.names:
            marks = [np.bitwise_or.reduce([np.frombuffer(m, np.uint8) for m in p]).tobytes() for p in batch["parts"].to_pylist()]
        else:
            marks = batch["marks"].to_pylist()
        items = batch["items"].to_pylist()
        yield pa.RecordBatch.from_pydict(
            {
                "doc_id": batch["doc_id"],
                "th": batch["th"],
                "n_words": batch["n_words"],
                "n_hit": pa.array([int.from_bytes(m, "big").bit_count() for m in marks], pa.int64()),
                "items": pa.array(items, pa.list_(pa.string())),
                "items_sha256": pa.array([hashlib.sha256(",".join(i).encode()).hexdigest() for i in items]),
                "marks": pa.array(marks, pa.binary()),
            }
        )


def drop_contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """The documents without hits, with all their columns."""
    last = F.lit((1 << 63) - 1)
    hit = find_contamination(docs, items, id_col, text_col, **settings).filter("n_hit > 0")
    hit = materialize(hit.select(F.coalesce("doc_id", last).alias("id"), "th").distinct(), "contaminated")
    keyed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.coalesce(F.col(f"`{id_col}`").cast("long"), last).alias("id"),
        F.xxhash64(F.col(f"`{text_col}`").cast("string")).alias("th"),
    )
    return keyed.join(hit, ["id", "th"], "left_anti").select("row.*")


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = find_contamination(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), "items_sha256", (F.col("n_hit") > 0).alias("contaminated")
    )


ORACLE = r"""
WITH word AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
bench AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
item_window AS (
  SELECT DISTINCT item_id, least(10, len(w)) AS k, array_to_string(w[s:s + least(10, len(w)) - 1], ' ') AS win
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS s FROM bench WHERE len(w) > 0)),
doc_window AS (
  SELECT doc_id, s, k, array_to_string(w[s:s + k - 1], ' ') AS win
  FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS s FROM word, (SELECT DISTINCT k FROM item_window))),
match AS (SELECT d.doc_id, d.s, d.k, i.item_id FROM doc_window d JOIN item_window i ON d.k = i.k AND d.win = i.win),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + k)) AS p FROM match) GROUP BY doc_id),
item AS (SELECT doc_id, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS i FROM match) GROUP BY doc_id)
SELECT w.doc_id, CAST(len(w.w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM word w LEFT JOIN hit USING (doc_id) LEFT JOIN item USING (doc_id)
"""
