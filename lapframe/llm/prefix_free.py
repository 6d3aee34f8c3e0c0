"""Substring dedup of bytes by prefix-free parsing and the suffix order that it gives.

A byte goes when a string of ``min_bytes`` bytes over it starts at two places or more of the corpus,
inside documents. All copies go, the first one too.

A suffix array of the whole corpus would be one huge sort. Instead the corpus order is made in pieces
that cannot share a string of ``min_bytes`` bytes:

1. Documents are written as blocks. The least rolling hash inside a window of ``min_bytes`` bytes is its
   anchor; consecutive windows under one anchor form a segment. Equal windows have equal anchors.
   Every block sends its distinct segments (two hashes each, however often it has them) to the share that
   owns the anchor. An anchor that stands once needs nothing more. Equal segments repeat as a whole.
2. Where the segments of an anchor differ, one block sends the bytes of each. The share parses them:
   a rolling hash triggers the ends of phrases; phrases overlap by the trigger. The suffix array of
   the dictionary of distinct phrases and that of the parse (the phrases' ranks), combined, sort all
   suffixes. Neighbours in this order whose first ``min_bytes`` bytes agree, byte by byte, repeat.
3. Every block takes back which of its windows repeat and cuts what they cover.

The dictionary holds each repeated phrase once, so the sorting follows the distinct text. An anchor with
more than ``hot_segments`` different segments (the edge of a passage that a third of all documents share)
would be one large group; its windows go by their own hashes instead, each distinct one once a block, to
shares of their own. Segments that are equal as a whole and the windows of such anchors are told by
128 hash bits (the anchor's or another 64, and 64 of the content); all other matches by their bytes.

Null and empty texts have no bytes. Texts shorter than ``min_bytes`` stay whole. Ids only name the rows: repeated
ids and null ids are rows like others, and repeated rows are copies. A very long text is a block of its
own and is cut into spans while it is hashed; the spans meet without a gap. An empty table gives an empty result. Extra
columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lapframe.llm.blocks import BLOCK_BYTES, document_blocks, joined, released, routed, squeezed, unpack
from lapframe.llm.exchange import arrow_schema, shares, together
from lapframe.llm.words import mix, utf8, whole

MIN_BYTES = 200
#: Bytes of a trigger, and of how many hashes one is a trigger.
TRIGGER, RATE = 8, 32
#: Different segments of one anchor that are sorted in one task.
HOT_SEGMENTS = 4_000
#: Bytes of segments that are sorted at once.
SORTED_BYTES = 2 << 20
#: Windows hashed at once.
SPAN = 1 << 18
U64 = np.uint64
HIGH, LOW = U64(0xFFFFFFFF00000000), U64(0xFFFFFFFF)
#: What a share says of a segment.
WHOLE, SEND, HOT = 1, 2, 4

_random = np.random.Generator(np.random.PCG64(977))
_BYTE = _random.integers(1, 1 << 63, 256, dtype=np.uint64) * U64(2) + U64(1)
_BASE = 0x9E3779B97F4A7C15
_TURN = _random.integers(1, 1 << 63, 2, dtype=np.uint64) * U64(2) + U64(1)

DOCS = "block long, docs binary"
SEGMENTS = "share int, block long, anchor binary, content binary, number binary"
VERDICTS = "block long, verdict binary"
SENT = "share int, block long, anchor binary, content binary, number binary, bytes binary"
RUNS = "block long, number binary, start binary, windows binary"
CUT = "doc_id long, n_bytes long, n_removed long, kept binary, spans array<struct<start:long,length:long>>"


def rolling(data: np.ndarray, width: int) -> np.ndarray:
    """A hash of every ``width`` consecutive bytes."""
    if len(data) < width:
        return np.zeros(0, U64)
    part, size, out, have = _BYTE[data], 1, None, 0
    while True:
        if width & size:
            if out is None:
                out = part
            else:
                n = min(len(out), len(part) - have)
                out = out[:n] * U64(pow(_BASE, size, 1 << 64)) + part[have : have + n]
            have += size
        if size * 2 > width:
            return mix(out)
        part = part[:-size] * U64(pow(_BASE, size, 1 << 64)) + part[size:]
        size *= 2


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    have = 1
    while have * 2 <= width:
        x = np.minimum(x[:-have], x[have:])
        have *= 2
    return np.minimum(x[: len(x) - (width - have)], x[width - have :]) if width > have else x


def run_hash(h: np.ndarray, start: np.ndarray, length: np.ndarray, gram: int, turn: int = 0) -> np.ndarray:
    """A hash of the bytes from start on, from the hashes of the grams that cover them."""
    out = mix(length.astype(U64) * _TURN[turn])
    for j in range(0, int(length.max(initial=0)), gram):
        out = mix((out ^ h[start + np.minimum(j, length - gram)]) * _TURN[turn])
    return out


class Block:
    """The segments of one block of documents.

    ``start`` and ``windows`` are where a segment begins and how many windows it has. ``group`` numbers
    the distinct segments of the block; ``first`` has a member of each and ``often`` how many there are.
    """

    def __init__(self, blob, k: int):
        self.table, self.k, self.gram = unpack(blob), k, max(1, k * 4 // 25)
        self.data, self.offsets = utf8(self.table["text"])
        found = [np.zeros(0, t) for t in (np.int64, np.int64, U64, U64)], *self._spans()
        self.start, self.windows, anchor, content = (np.concatenate(x) for x in zip(*found))
        order = np.lexsort((content, anchor))
        new = np.ones(len(order), bool)
        a, c = anchor[order], content[order]
        new[1:] = (a[1:] != a[:-1]) | (c[1:] != c[:-1])
        self.group = np.empty(len(order), np.int64)
        self.group[order] = np.cumsum(new) - 1
        self.first, self.anchor, self.content = order[new], a[new], c[new]
        self.often = np.diff(np.append(np.flatnonzero(new), len(order)))

    def _spans(self) -> Iterator[tuple[np.ndarray, ...]]:
        k, gram, n = self.k, self.gram, len(self.data)
        inside = whole(self.offsets, n, k)
        for i in range(0, len(inside), SPAN):
            own = np.flatnonzero(inside[i : i + SPAN])
            if not len(own):
                continue
            h = rolling(self.data[i : i + SPAN + k - 1], gram)
            least = sliding_min((h & HIGH) | np.arange(len(h), dtype=U64), k - gram + 1)
            site = (least[own] & LOW).astype(np.int64)
            new = np.ones(len(own), bool)
            new[1:] = (site[1:] != site[:-1]) | (np.diff(own) != 1)
            begin = np.flatnonzero(new)
            windows = np.diff(np.append(begin, len(own)))
            start = own[begin]
            yield start + i, windows, h[site[begin]], run_hash(h, start, windows + k - 1, gram)

    def single_windows(self, segments: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Where each window of the segments starts, and two hashes of its bytes."""
        n = self.windows[segments]
        at = np.repeat(self.start[segments] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        out = [np.zeros((2, 0), U64)]
        for part in np.array_split(at, len(at) // SPAN + 1):
            if len(part):
                covered, place = np.unique(part[:, None] + _covering(self.k, self.gram), return_inverse=True)
                h = rolling(self.data[covered[:, None] + np.arange(self.gram)].ravel(), self.gram)[:: self.gram]
                own = h[place.reshape(len(part), -1)]
                out.append(np.stack([_folded(own, 0), _folded(own, 1)]))
        return at, *np.concatenate(out, axis=1)


def _covering(k: int, gram: int) -> np.ndarray:
    return np.minimum(np.arange(0, k, gram), k - gram)


def _folded(grams: np.ndarray, turn: int) -> np.ndarray:
    out = np.full(len(grams), _TURN[turn])
    for column in grams.T:
        out = mix((out ^ column) * _TURN[turn])
    return out


def _segments(k: int, n_shares: int):
    def one(block: pa.Scalar, blob: pa.Scalar) -> pa.RecordBatch:
        b = Block(blob.as_buffer(), k)
        number = (np.arange(len(b.first)) << 1 | (b.often > 1)).astype(np.uint32)
        share = (mix(b.anchor) % U64(n_shares)).astype(np.int64)
        columns = {"anchor": b.anchor, "content": b.content, "number": number}
        return routed(share, n_shares, columns, {"block": block.as_py()}, ["number"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from released(zip(batch["block"], batch["docs"]), lambda row: one(*row))

    return run


def _verdicts(hot: int):
    def run(table: pa.Table) -> pa.Table:
        """Of one share: which segments stand twice, and which must be sent to be compared with others."""
        anchor, content = joined(table["anchor"], U64), joined(table["content"], U64)
        number = joined(table["number"], np.uint32, True)
        source = np.repeat(np.arange(table.num_rows), [len(v.as_buffer()) // 8 for v in table["anchor"]])
        order = np.lexsort((content, anchor))
        a, c = anchor[order], content[order]
        new_anchor, new = np.ones(len(order), bool), np.ones(len(order), bool)
        new_anchor[1:] = a[1:] != a[:-1]
        new[1:] = new_anchor[1:] | (c[1:] != c[:-1])
        group, anchor_of = np.cumsum(new) - 1, np.cumsum(new_anchor) - 1
        entries = np.bincount(group) if len(group) else group
        local = np.bincount(group, number[order] & 1) if len(group) else group
        kinds = np.bincount(anchor_of, new) if len(group) else group
        several = kinds[anchor_of] > 1
        verdict = np.where((entries[group] > 1) | (local[group] > 0), WHOLE, 0)
        verdict += np.where(new & several, np.where(kinds[anchor_of] > hot, SEND | HOT, SEND), 0)
        said = np.flatnonzero(verdict)
        told = (number[order[said]].astype(np.int64) >> 1) << 3 | verdict[said]
        whose = source[order[said]]
        by = np.lexsort((told, whose))
        ends = np.searchsorted(whose[by], np.arange(table.num_rows + 1))
        told = told[by]
        return pa.table(
            [table["block"].combine_chunks(), pa.array([squeezed(told[x:y]) for x, y in zip(ends, ends[1:])], pa.binary())],
            ["block", "verdict"],
        )

    return run


def _sent(k: int, n_shares: int):
    def run(blocks: pa.Table, verdicts: pa.Table) -> pa.Table:
        """The bytes of the segments that were asked for, and the windows of hot anchors."""
        said = joined(verdicts["verdict"], np.int64, True)
        parts = [arrow_schema(SENT).empty_table()]
        for block, blob in zip(blocks["block"], blocks["docs"]):
            b = Block(blob.as_buffer(), k)
            asked = said[(said & SEND) > 0]
            cold = asked[(asked & HOT) == 0]
            group = cold >> 3
            share = (mix(b.anchor[group]) % U64(n_shares)).astype(np.int64)
            order = np.argsort(share, kind="stable")
            group, share, cold = group[order], share[order], cold[order]
            start, size = b.start[b.first[group]], b.windows[b.first[group]] + k - 1
            ends = np.searchsorted(share, np.arange(n_shares + 1))
            whole_bytes = b.data.tobytes()
            rows: dict[str, list] = {c.split()[0]: [] for c in SENT.split(", ")}
            for s in np.flatnonzero(np.diff(ends)):
                own = slice(ends[s], ends[s + 1])
                text = b"".join([whole_bytes[x : x + y] for x, y in zip(start[own].tolist(), size[own].tolist())])
                rows["share"].append(s)
                rows["block"].append(block.as_py())
                rows["anchor"].append(b.anchor[group[own]].tobytes())
                rows["content"].append(squeezed(size[own]))
                rows["number"].append(squeezed(cold[own]))
                rows["bytes"].append(len(text).to_bytes(8, "little") + pa.compress(text, "zstd", asbytes=True))
            parts.append(pa.table(rows, arrow_schema(SENT)))
            parts.append(_hot_windows(b, asked, block.as_py(), n_shares))
        return pa.concat_tables(parts)

    return run


def _hot_windows(b: Block, asked: np.ndarray, block: int, n_shares: int) -> pa.Table:
    segments = b.first[asked[(asked & HOT) > 0] >> 3]
    at, one, two = b.single_windows(segments)
    order = np.lexsort((at, two, one))
    new = np.ones(len(order), bool)
    new[1:] = (one[order][1:] != one[order][:-1]) | (two[order][1:] != two[order][:-1])
    head = order[new]
    columns = {"anchor": one[head], "content": two[head], "number": at[head]}
    share = (one[head] % U64(n_shares)).astype(np.int64)
    rows = routed(share, n_shares, columns, {"block": block}, ["number"])
    rows = rows.append_column("bytes", pa.nulls(rows.num_rows, pa.binary()))
    return pa.Table.from_batches([rows]).select(arrow_schema(SENT).names).cast(arrow_schema(SENT))


def _ordered(k: int, sorted_bytes: int):
    def run(table: pa.Table) -> pa.Table:
        """Of one share: the windows that repeat, by block, as runs inside the segments."""
        texts = table["bytes"].is_valid()
        found = _sorted_segments(table.filter(texts), k, sorted_bytes), _equal_windows(table.filter(pa.compute.invert(texts)))
        return pa.concat_tables(found)

    return run


def _by_block(block: np.ndarray, source: np.ndarray, *columns: np.ndarray) -> pa.Table:
    order = np.argsort(source, kind="stable")
    ends = np.searchsorted(source[order], np.arange(len(block) + 1))
    full = np.flatnonzero(np.diff(ends))
    out = [pa.array(block[full])]
    for values in columns:
        values = values[order].astype(np.int64)
        out.append(pa.array([squeezed(values[ends[i] : ends[i + 1]]) for i in full], pa.binary()))
    return pa.table(out, ["block", "number", "start", "windows"])


def _equal_windows(table: pa.Table) -> pa.Table:
    one, two, at = joined(table["anchor"], U64), joined(table["content"], U64), joined(table["number"], np.int64, True)
    source = np.repeat(np.arange(table.num_rows), [len(v.as_buffer()) // 8 for v in table["anchor"]])
    order = np.lexsort((two, one))
    same = (one[order][1:] == one[order][:-1]) & (two[order][1:] == two[order][:-1])
    twice = np.zeros(len(order), bool)
    twice[order[1:][same]] = twice[order[:-1][same]] = True
    own = at[twice]
    return _by_block(np.asarray(table["block"]), source[twice], np.full(len(own), -1), own, np.ones(len(own), np.int64))


def _sorted_segments(table: pa.Table, k: int, sorted_bytes: int) -> pa.Table:
    anchor, told = joined(table["anchor"], U64), joined(table["number"], np.int64, True)
    size = joined(table["content"], np.int64, True)
    source = np.repeat(np.arange(table.num_rows), [len(v.as_buffer()) // 8 for v in table["anchor"]])
    data = [np.frombuffer(pa.decompress(v[8:], int.from_bytes(v[:8], "little"), "zstd", asbytes=True), np.uint8) for v in table["bytes"].to_pylist()]
    data = np.concatenate(data) if data else np.zeros(0, np.uint8)
    begin = np.cumsum(size) - size
    order = np.argsort(anchor, kind="stable")
    new = np.flatnonzero(np.append(True, np.diff(anchor[order].view(np.int64)) != 0)) if len(order) else order
    # Batches end where an anchor ends, the first after every ``sorted_bytes`` bytes.
    filled = np.cumsum(size[order]) // sorted_bytes
    cuts = new[np.flatnonzero(np.diff(filled[new], prepend=-1))] if len(order) else new
    owner, start, windows = [], [], []
    for part in np.split(order, cuts[cuts > 0]):
        edges = np.concatenate([[0], np.cumsum(size[part])])
        spread = np.repeat(begin[part] - edges[:-1], size[part]) + np.arange(edges[-1])
        hit = repeated_starts(data[spread], edges, k)
        first = np.flatnonzero(hit & ~np.append(False, hit[:-1]))
        last = np.flatnonzero(hit & ~np.append(hit[1:], False))
        which = np.searchsorted(edges, first, "right") - 1
        single = (told[part[which]] & WHOLE) == 0
        owner.append(part[which[single]])
        start.append((first - edges[which])[single])
        windows.append((last - first + 1)[single])
    owner, start, windows = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (owner, start, windows))
    return _by_block(np.asarray(table["block"]), source[owner], told[owner] >> 3, start, windows)


def refined(rank: np.ndarray, following, depth: int, limit: int) -> np.ndarray:
    """Suffix ranks by doubling the compared depth; equal suffixes keep one rank.

    ``rank`` orders by the first ``depth`` symbols; ``following(rank, at, depth)`` is the rank of what comes
    ``depth`` symbols after the places ``at``, or 0 past the end. Only ties are sorted again.
    """
    order = np.argsort(rank, kind="stable")
    new = np.append(True, np.diff(rank[order]) != 0)[: len(order)]
    rank = rank.copy()
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(len(order)), 0)) + 1
    tied = order[~(new & np.append(new[1:], True)[: len(new)])]
    while len(tied) and depth < limit:
        key = rank[tied] << 32 | following(rank, tied, depth)
        by = np.argsort(key, kind="stable")
        tied, key = tied[by], key[by]
        place = np.arange(len(tied))
        new_rank, new = np.ones(len(tied), bool), np.ones(len(tied), bool)
        new_rank[1:], new[1:] = (key[1:] >> 32) != (key[:-1] >> 32), key[1:] != key[:-1]
        rank[tied] += np.maximum.accumulate(np.where(new, place, 0)) - np.maximum.accumulate(np.where(new_rank, place, 0))
        tied = tied[~(new & np.append(new[1:], True))]
        depth *= 2
    return rank


def dictionary_order(phrases: list[bytes], k: int) -> tuple[np.ndarray, np.ndarray]:
    """Where each phrase begins in the dictionary, and the rank of every suffix of every phrase."""
    size = np.array([len(p) for p in phrases], np.int64)
    begin = np.cumsum(size) - size
    data = np.frombuffer(b"".join(phrases), np.uint8).astype(np.int64) + 1
    left = np.repeat(begin + size, size) - np.arange(len(data))
    key = np.zeros(len(data), np.int64)
    for j in range(7):
        own = np.zeros(len(data), np.int64)
        own[: len(data) - j] = data[j:]
        key = key << 9 | np.where(left > j, own, 0)

    def following(rank: np.ndarray, at: np.ndarray, depth: int) -> np.ndarray:
        inside = left[at] > depth
        return np.where(inside, rank[np.where(inside, at + depth, 0)], 0)

    return begin, refined(key, following, 7, min(k, int(size.max(initial=0))))


def parse_order(symbols: np.ndarray, ends: np.ndarray, limit: int) -> np.ndarray:
    """The rank of every suffix of the parse; ``ends`` is where each phrase's text ends in it."""

    def following(rank: np.ndarray, at: np.ndarray, depth: int) -> np.ndarray:
        inside = at + depth < ends[at]
        return np.where(inside, rank[np.where(inside, at + depth, 0)], 0)

    return refined(symbols, following, 1, limit)


def parsed(data: np.ndarray, edges: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where the phrases of the texts begin and end, and which text each is in."""
    h = rolling(data, TRIGGER)
    trigger = np.flatnonzero(((h >> U64(40)) % U64(RATE) == 0) & whole(edges, len(data), TRIGGER))
    begin = np.union1d(edges[:-1][np.diff(edges) > 0], trigger)
    text = np.searchsorted(edges, begin, "right") - 1
    end = edges[text + 1].copy()
    more = np.flatnonzero(text[1:] == text[:-1])
    end[more] = begin[more + 1] + TRIGGER
    return begin, end, text


def repeated_starts(data: np.ndarray, edges: np.ndarray, k: int) -> np.ndarray:
    """Which bytes start a string of k bytes, inside a text, that starts at another byte too."""
    hit = np.zeros(len(data), bool)
    if len(data) < k:
        return hit
    begin, end, text = parsed(data, edges)
    blob = data.tobytes()
    spelled = [blob[a:b] for a, b in zip(begin.tolist(), end.tolist())]
    dictionary = sorted(set(spelled))
    number = {p: i for i, p in enumerate(dictionary)}
    symbol = np.array([number[p] for p in spelled], np.int64)
    place, suffix = dictionary_order(dictionary, k)
    ends = np.searchsorted(text, text, "right")
    rest = parse_order(symbol + 1, ends, k)
    after = np.append(rest[1:], 0)
    after[ends - 1] = 0
    # The corpus order: by what is left of the phrase, then by the parse after it.
    at = np.flatnonzero(whole(edges, len(data), k))
    phrase = np.searchsorted(begin, at, "right") - 1
    order = np.argsort(suffix[place[symbol[phrase]] + at - begin[phrase]] << 32 | after[phrase], kind="stable")
    one, two = at[order[:-1]], at[order[1:]]
    width = 8 if k >= 8 else 1
    wide = np.lib.stride_tricks.sliding_window_view(data, width)
    wide = np.ascontiguousarray(wide).view(np.uint64 if width == 8 else np.uint8).ravel()
    same = np.arange(len(one))
    for j in [*range(0, k - width, width), k - width]:
        same = same[wide[one[same] + j] == wide[two[same] + j]]
    hit[one[same]] = hit[two[same]] = True
    return hit


def _cut(k: int):
    def run(blocks: pa.Table, verdicts: pa.Table, runs: pa.Table) -> pa.Table:
        said = joined(verdicts["verdict"], np.int64, True)
        told = [joined(runs[c], np.int64, True) for c in ("number", "start", "windows")]
        parts = [_cut_block(Block(blob.as_buffer(), k), said, *told) for blob in blocks["docs"]]
        return pa.concat_tables(parts) if parts else CUT_SCHEMA.empty_table()

    return run


CUT_SCHEMA = pa.schema(
    [("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("kept", pa.binary()),
     ("spans", pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64())])))]
)


def _cut_block(b: Block, said: np.ndarray, number: np.ndarray, start: np.ndarray, windows: np.ndarray) -> pa.Table:
    k, n = b.k, len(b.data)
    equal = np.zeros(len(b.first), bool)
    equal[said[(said & WHOLE) > 0] >> 3] = True
    segments = np.flatnonzero(equal[b.group]) if len(b.group) else b.group
    inside = number >= 0
    first = np.concatenate([b.start[segments], b.start[b.first[number[inside]]] + start[inside], start[~inside]])
    n_bytes = np.concatenate([b.windows[segments], windows[inside], windows[~inside]]) + k - 1
    # Windows of hot anchors that stand twice in this block alone.
    hot = said[(said & HOT) > 0] >> 3
    if len(hot):
        at, one, two = b.single_windows(b.first[hot])
        order = np.lexsort((two, one))
        same = (one[order][1:] == one[order][:-1]) & (two[order][1:] == two[order][:-1])
        told = np.zeros(len(at), bool)
        told[order[1:][same]] = told[order[:-1][same]] = True
        first, n_bytes = np.append(first, at[told]), np.append(n_bytes, np.full(told.sum(), k))
    steps = np.zeros(n + 1, np.int64)
    np.add.at(steps, first, 1)
    np.add.at(steps, first + n_bytes, -1)
    gone = np.cumsum(steps)[:n] > 0
    begins = gone.copy()
    begins[1:] &= ~gone[:-1]
    edges = b.offsets[:-1][(np.diff(b.offsets) > 0)]
    begins[edges] = gone[edges]
    ends = gone.copy()
    ends[:-1] &= ~gone[1:]
    ends[edges[1:] - 1] = gone[edges[1:] - 1]
    begin, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    whose = np.searchsorted(b.offsets, begin, "right") - 1
    spans = pa.StructArray.from_arrays([pa.array(begin - b.offsets[whose]), pa.array(end - begin)], ["start", "length"])
    span_ends = np.searchsorted(whose, np.arange(len(b.offsets)))
    total = np.append(0, np.cumsum(gone))
    removed = np.diff(total[b.offsets])
    kept_ends = b.offsets - total[b.offsets]
    kept = pa.LargeBinaryArray.from_buffers(
        pa.large_binary(), len(b.offsets) - 1, [None, pa.py_buffer(kept_ends.astype(np.int64).tobytes()), pa.py_buffer(b.data[~gone].tobytes())]
    )
    return pa.table(
        [b.table["doc_id"].combine_chunks(), pa.array(np.diff(b.offsets)), pa.array(removed), kept.cast(pa.binary()),
         pa.ListArray.from_arrays(pa.array(span_ends.astype(np.int32)), spans)],
        schema=CUT_SCHEMA,
    )


def remove_repeated_bytes(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_bytes: int = MIN_BYTES,
    block_bytes: int = BLOCK_BYTES,
    hot_segments: int = HOT_SEGMENTS,
    sorted_bytes: int = SORTED_BYTES,
) -> DataFrame:
    """Per document ``doc_id, n_bytes, n_removed, kept, spans``: the bytes that stay, and the maximal runs that go."""
    if min_bytes < 1:
        raise ValueError(f"min_bytes is {min_bytes}; it must be at least 1")
    blocks = document_blocks(docs, F.col(f"`{id_col}`"), F.col(f"`{text_col}`"), block_bytes)
    n = shares(blocks, block_bytes)
    found = blocks.mapInArrow(_segments(min_bytes, n), SEGMENTS)
    verdicts = found.groupBy("share").applyInArrow(_verdicts(hot_segments), VERDICTS).filter(F.length("verdict") > 0)
    sent = together([(blocks, DOCS), (verdicts, VERDICTS)], "block", _sent(min_bytes, n), SENT)
    runs = sent.groupBy("share").applyInArrow(_ordered(min_bytes, sorted_bytes), RUNS)
    return together([(blocks, DOCS), (verdicts, VERDICTS), (runs, RUNS)], "block", _cut(min_bytes), CUT)


def query(spark, sf_dir: str) -> DataFrame:
    cut = remove_repeated_bytes(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return cut.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


ORACLE = """
WITH raw AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
win AS (SELECT r, s, md5(substr(x, 2 * s + 1, 400)) AS k FROM (SELECT r, x, unnest(range(0, len(x) // 2 - 199)) AS s FROM raw WHERE len(x) >= 400)),
hit AS (SELECT r, s FROM (SELECT r, s, count(*) OVER (PARTITION BY k) AS n FROM win) WHERE n > 1),
island AS (SELECT r, s, sum(fresh) OVER (PARTITION BY r ORDER BY s) AS g
  FROM (SELECT r, s, CASE WHEN s - lag(s) OVER (PARTITION BY r ORDER BY s) <= 200 THEN 0 ELSE 1 END AS fresh FROM hit)),
span AS (SELECT r, min(s) AS a, max(s) + 200 AS b FROM island GROUP BY r, g),
gap AS (SELECT r, lag(b, 1, 0) OVER (PARTITION BY r ORDER BY a) AS a, a AS b FROM span UNION ALL SELECT r, max(b), NULL FROM span GROUP BY r),
kept AS (SELECT r, string_agg(CASE WHEN b IS NULL THEN substr(x, 2 * a + 1) ELSE substr(x, 2 * a + 1, 2 * (b - a)) END, '' ORDER BY a) AS x
  FROM gap JOIN raw USING (r) GROUP BY r),
total AS (SELECT r, sum(b - a) AS n_removed, count(*) AS n_spans FROM span GROUP BY r)
SELECT doc_id, CAST(len(raw.x) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
  CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans, sha256(unhex(coalesce(kept.x, raw.x))) AS kept_sha256
FROM raw LEFT JOIN kept USING (r) LEFT JOIN total USING (r)
"""
