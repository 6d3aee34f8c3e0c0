"""SimHash near-dedup with a Gray-order hierarchical index.

A document's fingerprint holds, for each of 64 bits, whether more than half of its word
shingles' hashes have it. Fingerprints link when they differ in at most ``distance`` bits.

The index works on distinct fingerprints. Its top level is a set of masks: the 64 bits are cut into
``distance + 2`` segments, and two linked fingerprints agree in at least two of them, so each pair
of segments is a mask and fingerprints with equal masked bits meet in a node. Inside a node the
fingerprints are sorted by Gray rank, and consecutive ones are factored into nodes of a tree by
the bits that they share (a mask and a pattern). Two nodes are compared by the bits both share:
if those already differ in more than ``distance``, everything below is pruned at once, and a node whose
free bits are no more than ``distance`` is linked as a whole.

A top node with more than ``node_rows`` fingerprints is cut into salted parts that meet in pairs,
so no task holds more than two parts. Links come back as spanning trees, and components are
found by joins.

Null and empty texts have fingerprint zero and link like any other. Equal rows are copies. A
null id comes after all others; a component of null ids only has a null component id. Extra
columns are not read by ``fingerprints``; ``near_duplicates`` returns the ids.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import accumulate, combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapframe.llm.blocks import joined, partitions, released, routed
from lapframe.llm.graph import components, local_components, merge
from lapframe.llm.words import mix
from lapframe.session import materialize

SHINGLE = 4
DISTANCE = 4
SEED = 42
NODE_ROWS = 50_000
#: Leaves of a node of the tree.
FANOUT = 16
SECTION = 1 << 22
LAST = 9223372036854775807
U64 = np.uint64
GOLDEN = 0x9E3779B97F4A7C15
_LANES = U64(0x0101010101010101)
_SPACE = re.compile(rb"[\x20\x09-\x0D]")


def shingle_hashes(text: bytes, size: int = SHINGLE) -> np.ndarray:
    """XXH64 of every run of ``size`` lower-cased words; of all words if there are fewer."""
    parts, tail, at = [], [], 0
    while at < len(text):
        cut = _SPACE.search(text, at + SECTION)
        end = cut.start() if cut else len(text)
        words = tail + text[at:end].lower().split()
        at, tail = end, words
        if len(words) >= size:
            line = b" ".join(words)
            ends = list(accumulate(map(len, words), lambda a, n: a + 1 + n))
            starts = [0, *(e + 1 for e in ends)]
            digest = xxhash.xxh64_intdigest
            parts.append(np.array([digest(line[a:b], SEED) for a, b in zip(starts, ends[size - 1 :])], np.uint64))
            tail = words[len(words) - size + 1 :]
    if not parts and tail:
        return np.array([xxhash.xxh64_intdigest(b" ".join(tail), SEED)], np.uint64)
    return np.concatenate(parts) if parts else np.zeros(0, np.uint64)


def majority(h: np.ndarray) -> int:
    """The bits set in more than half of the hashes."""
    if not len(h):
        return 0
    cuts = np.arange(0, len(h), 255)
    counts = np.zeros((8, 8), np.int64)
    for bit in range(8):
        lanes = np.add.reduceat((h >> U64(bit)) & _LANES, cuts)
        counts[:, bit] = lanes.view(np.uint8).reshape(-1, 8).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(counts.ravel() * 2 > len(h), bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """``doc_id, th, fp``: a hash of the text and the fingerprint, as signed longs. One pass, no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def one(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = batch["text"].cast(pa.large_binary())
            fp = [majority(shingle_hashes(t.as_py() or b"", shingle)) for t in texts]
            return pa.RecordBatch.from_pydict(
                {"doc_id": batch["doc_id"], "th": batch["th"], "fp": pa.array(np.array(fp, np.uint64).view(np.int64))}
            )

        return released(batches, one)

    rows = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.xxhash64(f"`{text_col}`").alias("th"), F.col(f"`{text_col}`").cast("string").alias("text")
    )
    return rows.mapInArrow(run, "doc_id long, th long, fp long")


def masks(distance: int) -> list[int]:
    """Two of ``distance + 2`` segments each; linked fingerprints agree under one at least."""
    n = distance + 2
    cuts = [round(64 * i / n) for i in range(n + 1)]
    segment = [((1 << (b - a)) - 1) << a for a, b in zip(cuts, cuts[1:])]
    return [x | y for x, y in combinations(segment, 2)]


def gray_rank(x: np.ndarray) -> np.ndarray:
    """The place of each value in the reflected Gray order."""
    for shift in (1, 2, 4, 8, 16, 32):
        x = x ^ (x >> U64(shift))
    return x


class Tree:
    """Fingerprints in Gray order, factored into nodes by the bits that they share."""

    def __init__(self, fp: np.ndarray):
        self.levels = [(fp, np.full(len(fp), ~U64(0)))]
        while len(self.levels[-1][0]) > FANOUT:
            bits, shared = self.levels[-1]
            cuts = np.arange(0, len(bits), FANOUT)
            ones = np.bitwise_and.reduceat(bits | ~shared, cuts)
            some = np.bitwise_or.reduceat(bits & shared, cuts)
            both = np.bitwise_and.reduceat(shared, cuts) & ~(ones ^ some)
            self.levels.append((ones & both, both))

    def links(self, distance: int) -> np.ndarray:
        """Components of all links, as the least index of each."""
        n = len(self.levels[0][0])
        label = np.arange(n)
        for depth in range(1, len(self.levels)):  # nodes of which any two members link
            whole = np.flatnonzero(np.bitwise_count(~self.levels[depth][1]) <= distance)
            width = FANOUT**depth
            member = (whole[:, None] * width + np.arange(width)).ravel()
            head = np.repeat(whole * width, width)
            merge(label, head[member < n], member[member < n])
        top = len(self.levels[-1][0])
        a, b = np.triu_indices(top)
        work = [(len(self.levels) - 1, a, b)]
        while work:
            depth, a, b = work.pop()
            for i in range(0, len(a), 1 << 16):
                x, y = self._near(depth, a[i : i + (1 << 16)], b[i : i + (1 << 16)], distance)
                if depth == 0:
                    merge(label, x, y)
                elif len(x):
                    x, y = self._apart(label, depth, x, y)
                    work.append((depth - 1, *self._children(depth - 1, x, y)))
                    if i + (1 << 16) < len(a):
                        work.insert(len(work) - 1, (depth, a[i + (1 << 16) :], b[i + (1 << 16) :]))
                        break
        return label

    def _near(self, depth, a, b, distance):
        bits, shared = self.levels[depth]
        differ = np.bitwise_count((bits[a] ^ bits[b]) & shared[a] & shared[b])
        keep = differ <= distance
        return a[keep], b[keep]

    def _apart(self, label, depth, a, b):
        """Without node pairs whose members are all in one component already."""
        width = FANOUT**depth
        cuts = np.arange(0, len(label), width)
        low, high = np.minimum.reduceat(label, cuts), np.maximum.reduceat(label, cuts)
        keep = (low[a] != high[a]) | (low[b] != high[b]) | (low[a] != low[b])
        return a[keep], b[keep]

    def _children(self, depth, a, b):
        n = len(self.levels[depth][0])
        i, j = np.divmod(np.arange(FANOUT * FANOUT), FANOUT)
        x = (a[:, None] * FANOUT + i).ravel()
        y = (b[:, None] * FANOUT + j).ravel()
        keep = (x < n) & (y < n) & (x <= y)
        return x[keep], y[keep]


def _nodes(mask_values: list[int], n_shares: int, crowded):
    """Send each fingerprint to the share of every top node that it is in."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hot_node, hot_parts = crowded.value
        for batch in batches:
            fp = np.asarray(batch["fp"]).view(np.uint64)
            nodes, members = [], []
            for i, mask in enumerate(mask_values):
                node = mix((fp & U64(mask)) + U64((i + 1) * GOLDEN % (1 << 64)))
                at = np.minimum(np.searchsorted(hot_node, node), max(0, len(hot_node) - 1))
                hot = hot_node[at] == node if len(hot_node) else np.zeros(len(fp), bool)
                nodes.append(node[~hot])
                members.append(fp[~hot])
                parts = hot_parts[at[hot]] if hot.any() else np.zeros(0, np.int64)
                own = (mix(fp[hot]) % np.maximum(parts, 1).astype(np.uint64)).astype(np.int64)
                for other in range(int(parts.max(initial=0))):
                    meets = other < parts
                    low, high = np.minimum(own, other)[meets], np.maximum(own, other)[meets]
                    nodes.append(mix(node[hot][meets] ^ mix((low * 1_000_003 + high).astype(np.uint64))))
                    members.append(fp[hot][meets])
            node, member = np.concatenate(nodes), np.concatenate(members)
            yield routed((mix(node) % U64(n_shares)).astype(np.int64), n_shares, {"node": node, "member": member}, {})

    return run


def _linked(distance: int):
    def run(table: pa.Table) -> pa.Table:
        """Spanning trees of the links in all nodes of one share."""
        node, fp = joined(table["node"], np.uint64), joined(table["member"], np.uint64)
        order = np.lexsort((gray_rank(fp), node))
        node, fp = node[order], fp[order]
        begin = np.flatnonzero(np.append(True, node[1:] != node[:-1])) if len(node) else np.zeros(0, np.int64)
        size = np.diff(np.append(begin, len(node)))
        some, number = np.unique(fp, return_inverse=True)
        a, b = [], []
        small = np.repeat(size <= FANOUT, size)
        for step in range(1, FANOUT):
            i = np.flatnonzero((node[step:] == node[:-step]) & small[step:]) if step < len(node) else np.zeros(0, np.int64)
            i = i[np.bitwise_count(fp[i] ^ fp[i + step]) <= distance]
            a.append(number[i])
            b.append(number[i + step])
        for x, n in zip(begin[size > FANOUT], size[size > FANOUT]):
            label = Tree(fp[x : x + n]).links(distance)
            a.append(number[x : x + n])
            b.append(number[x + label])
        label = local_components(np.concatenate(a), np.concatenate(b), len(some)) if a else np.zeros(0, np.int64)
        moved = label != np.arange(len(some))
        return pa.table({"a": some[moved].view(np.int64), "b": some[label[moved]].view(np.int64)})

    return run


def linked_fingerprints(distinct: DataFrame, distance: int = DISTANCE, node_rows: int = NODE_ROWS) -> DataFrame:
    """``a long, b long``: links that connect the same fingerprints as all links do. ``distinct`` has ``fp``."""
    spark, n = distinct.sparkSession, partitions(distinct)
    values = masks(distance)
    signed = [m - (1 << 64) if m >> 63 else m for m in values]
    total = distinct.count()
    node_rows = max(node_rows, len(values) * total // 1_000_000)  # so that at most a million nodes are named
    # pre-aggregated: how many fingerprints a top node has
    pairs = F.explode(F.array([F.struct(F.lit(i).alias("i"), F.col("fp").bitwiseAND(F.lit(m)).alias("key")) for i, m in enumerate(signed)]))
    crowded = distinct.select(pairs.alias("p")).groupBy("p.i", "p.key").count().filter(F.col("count") > node_rows).collect()
    named = sorted(
        (int(mix(np.array([(r["key"] % (1 << 64) + (r["i"] + 1) * GOLDEN) % (1 << 64)], np.uint64))[0]), -(-r["count"] // node_rows))
        for r in crowded
    )
    sent = spark.sparkContext.broadcast((np.array([k for k, _ in named], np.uint64), np.array([c for _, c in named], np.int64)))
    routed_rows = distinct.select("fp").mapInArrow(_nodes(values, n, sent), "share int, node binary, member binary")
    return routed_rows.groupBy("share").applyInArrow(_linked(distance), "a long, b long")


def components_of(prints: DataFrame, distance: int = DISTANCE, node_rows: int = NODE_ROWS) -> DataFrame:
    """``fp, id, th`` for every distinct fingerprint: the first document of its component.

    ``prints`` is what ``fingerprints`` gives, written. The first has the least id (null ids last), then the
    least hash of its text.
    """
    who = F.struct(F.coalesce("doc_id", F.lit(LAST)).alias("id"), "th")
    distinct = materialize(prints.groupBy("fp").agg(F.min(who).alias("least")), "distinct")
    roots = components(linked_fingerprints(distinct, distance, node_rows))
    named = distinct.join(roots, distinct["fp"] == roots["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    lowest = named.groupBy("root").agg(F.min("least").alias("first"))
    return named.join(lowest, "root").select("fp", "first.id", "first.th")


def near_duplicates(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE,
    distance: int = DISTANCE,
    node_rows: int = NODE_ROWS,
) -> DataFrame:
    """``doc_id, fp, component_id``: the least id that links reach, one row per document."""
    prints = materialize(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    first = components_of(prints, distance, node_rows).select("fp", F.nullif("id", F.lit(LAST)).alias("component_id"))
    return prints.join(first, "fp").select("doc_id", "fp", "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **settings) -> DataFrame:
    """The first document of every component, with all its columns; of rows that repeat id and text, one."""
    shingle = settings.pop("shingle", SHINGLE)
    prints = materialize(fingerprints(docs, id_col, text_col, shingle), "fingerprints")
    first = materialize(components_of(prints, **settings).select("id", "th").distinct(), "first")
    keyed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
        F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(LAST)).alias("id"),
        F.xxhash64(f"`{text_col}`").alias("th"),
    )
    return keyed.join(first, ["id", "th"], "left_semi").dropDuplicates(["id", "th"]).select("row.*")


def query(spark, sf_dir: str) -> DataFrame:
    found = near_duplicates(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")
