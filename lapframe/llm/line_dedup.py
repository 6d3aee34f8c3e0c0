"""Line dedup by aligning each document with the earlier ones that it overlaps.

1. Runs. Each line that is not blank begins one shortest run of at least ``block_words`` words and ends another. A run's
   hash (128 bits) is that of its lines: single lines may be common, runs are rare.
2. Pairs. A run's home is the first document that has it. A document is paired with the homes of its runs, never with
   all documents that share a run, so a passage of a third of all documents gives one pair for each of them. A pair
   carries the runs that both have, each with its places on either side.
3. Alignment. A patience diff of the two sides pairs runs that are unique in both, in their longest common order, then those
   that are unique in the gaps, then runs by their occurrence in a gap. What is left over stands in another order, or
   more often than at home: it is aligned along its neighbours' shift, else with the run's first place, until nothing is left.
4. Aligned runs of one shift make a common block. Its lines are deleted from the later document.

So all runs of consecutive lines with ``block_words`` words go that an earlier document has too, as consecutive
lines: every line of such a block lies in a shortest run inside it, and every run is aligned with its home.

"Earlier" is the smaller id; rows that share an id are told apart by a hash of their text, and equal
rows count as one document (each gets that document's result). A null id comes after all others.
A null text stays null and has no lines, an empty table gives an empty one. A very long text is one row, and its work grows
with its lines: a line that stands very often on both sides is one run with two lists of places. Lines are compared without white
space around them. In scripts that write no spaces, words are counted by characters. Blank lines match nothing, do not break a
block, and stay. Other columns are kept as they are. The first document of a line always keeps it.
"""

from __future__ import annotations

import re
from array import array
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator, Mapping

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lapframe.llm.blocks import released
from lapframe.session import materialize

BLOCK_WORDS = 8
#: Characters of scripts that write no spaces between words, and how many make about a word: Chinese and Japanese; Thai, Lao,
#: Tibetan, Burmese, Khmer.
SPACELESS = (
    (re.compile("[\u2e80-\u312f\u3190-\u9fff\uf900-\ufaff\uff66-\uff9d\U00020000-\U0003ffff]"), 2),
    (re.compile("[\u0e00-\u109f\u1780-\u17ff\u19e0-\u19ff\ua9e0-\ua9ff\uaa60-\uaa7f]"), 4),
)
LAST = 9223372036854775807

#: Gaps within gaps that the patience diff looks into; what lies deeper is aligned along its neighbours.
DEPTH = 24

#: What stands at each place of a document; places are sorted.
Side = Mapping


def increasing(values: list[int]) -> list[int]:
    """Indices of a longest increasing subsequence."""
    tails, at, before = [], [], []
    for i, v in enumerate(values):
        k = bisect_left(tails, v)
        tails[k : k + 1] = [v]
        at[k : k + 1] = [i]
        before.append(at[k - 1] if k else -1)
    out = []
    i = at[-1] if at else -1
    while i >= 0:
        out.append(i)
        i = before[i]
    return out[::-1]


def _anchors(a: list, b: list) -> list[tuple[int, int]]:
    """Pairs of indices in order: of values that are unique in both, or else of equal occurrences of a value."""
    n_a, n_b = Counter(a), Counter(b)
    where = {v: j for j, v in enumerate(b) if n_b[v] == 1}
    pairs = [(i, where[v]) for i, v in enumerate(a) if n_a[v] == 1 and v in where]
    if not pairs:
        seen, where = Counter(), {}
        for j, v in enumerate(b):
            where[v, seen[v]] = j
            seen[v] += 1
        seen = Counter()
        for i, v in enumerate(a):
            if (v, seen[v]) in where:
                pairs.append((i, where[v, seen[v]]))
            seen[v] += 1
    return [pairs[k] for k in increasing([j for _, j in pairs])]


def patience(a: Side, b: Side) -> list[tuple]:
    """Aligned places of two documents, in order on both sides, given what both have by place."""
    places_a, places_b = sorted(a), sorted(b)
    line_a, line_b = [a[i] for i in places_a], [b[j] for j in places_b]
    out, work = [], [(0, len(line_a), 0, len(line_b), 0)]
    while work:
        a0, a1, b0, b1, depth = work.pop()
        while a0 < a1 and b0 < b1 and line_a[a0] == line_b[b0]:
            out.append((a0, b0))
            a0, b0 = a0 + 1, b0 + 1
        while a0 < a1 and b0 < b1 and line_a[a1 - 1] == line_b[b1 - 1]:
            a1, b1 = a1 - 1, b1 - 1
            out.append((a1, b1))
        if a0 == a1 or b0 == b1 or depth > DEPTH:
            continue
        low_a, low_b = a0, b0
        anchors = [(a0 + i, b0 + j) for i, j in _anchors(line_a[a0:a1], line_b[b0:b1])]
        out += anchors
        for i, j in [*anchors, (a1, b1)] if anchors else ():
            work.append((low_a, i, low_b, j, depth + 1))
            low_a, low_b = i + 1, j + 1
    return sorted((places_a[i], places_b[j]) for i, j in out)


def common_blocks(later: Side, home: Side) -> list[tuple[int, int, int]]:
    """Blocks (first line, lines, first line at home) that hold every run of ``later``.

    A place is a run's first line and its number of lines; every run of ``later`` stands in ``home`` too.
    """
    shift = {i: i[0] - j[0] for i, j in patience(later, home)}
    there = {(at, run) for (at, _), run in home.items()}
    places = sorted(later)
    for order in (places, places[::-1]):
        own = None
        for i in order:
            if i in shift:
                own = shift[i]
            elif own is not None and (i[0] - own, later[i]) in there:
                shift[i] = own
            else:
                own = None
    if len(shift) < len(places):
        first: dict = {}
        for at, run in sorted(there, reverse=True):
            first[run] = at
        own = None
        for i in places:
            if i in shift:
                own = shift[i]
                continue
            if own is None or (i[0] - own, later[i]) not in there:
                own = i[0] - first[later[i]]
            shift[i] = own
    out: list[tuple[int, int, int]] = []
    begin = end = own = None
    for by, at, n in sorted((shift[i], *i) for i in places):
        if by != own or at > end:
            if own is not None:
                out.append((begin, end - begin, begin - own))
            begin, end, own = at, at + n, by
        end = max(end, at + n)
    if own is not None:
        out.append((begin, end - begin, begin - own))
    return sorted(out)


def n_words(line: bytes) -> int:
    """Words between white space; characters of scripts without spaces count by their number."""
    if line.isascii():
        return len(line.split())
    text, more = line.decode("utf-8", "replace"), 0
    for script, per_word in SPACELESS:
        text, n = script.subn(" ", text)
        more += -(-n // per_word)
    return len(text.encode().split()) + more


def shortest_runs(words: list[int], least: int) -> list[tuple[int, int]]:
    """Begin and end of the shortest run of lines with at least ``least`` words that each line begins, and that each line ends."""
    out, begin, held = set(), 0, 0
    for end, n in enumerate(words):
        held += n
        while held >= least and begin <= end:
            out.add((begin, end + 1))  # the shortest that ``begin`` begins
            held -= words[begin]
            begin += 1
        if begin:
            out.add((begin - 1, end + 1))  # the shortest that ``end`` ends
    return sorted(out)


RUNS = "array<struct<hi:bigint,lo:bigint,n:int,at:array<int>>>"
BLOCKS = "array<struct<start:int,lines:int,source_doc:bigint,source_start:int>>"
HALF = 1 << 64


def _runs(block_words: int):
    """The shortest runs of each document, each once: hash, number of lines, first lines of its places."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        import xxhash

        hi, lo, sizes, at, ends, offsets = array("Q"), array("Q"), array("i"), array("i"), array("i", [0]), array("i", [0])
        for text in batch["text"].cast(pa.large_binary()):
            own = [x for x in (line.strip() for line in (text.as_py() or b"").split(b"\n")) if x]
            digests = [xxhash.xxh3_128_digest(x) for x in own]
            found: dict[int, tuple[int, list[int]]] = {}
            for begin, end in shortest_runs([n_words(x) for x in own], block_words):
                run = xxhash.xxh3_128_intdigest(b"".join(digests[begin:end]))
                found.setdefault(run, (end - begin, []))[1].append(begin)
            for run, (n, places) in found.items():
                hi.append(run // HALF)
                lo.append(run % HALF)
                sizes.append(n)
                at.extend(places)
                ends.append(len(at))
            offsets.append(len(hi))
        places = pa.ListArray.from_arrays(_ints(ends), _ints(at))
        parts = [*(pa.array(np.frombuffer(v, np.uint64).view(np.int64)) for v in (hi, lo)), _ints(sizes), places]
        runs = pa.ListArray.from_arrays(_ints(offsets), pa.StructArray.from_arrays(parts, ["hi", "lo", "n", "at"]))
        return pa.RecordBatch.from_pydict({"id": batch["id"], "th": batch["th"], "runs": runs})

    return lambda batches: released(batches, work)


def _ints(values: array) -> pa.Array:
    return pa.array(np.frombuffer(values, np.int32))


def shared_runs(keyed: DataFrame, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``id, th, found``: the runs of each document that an earlier one has too, with their places here and in their home.

    ``keyed`` has ``id, th, text``.
    """
    sheets = keyed.filter("text is not null").mapInArrow(_runs(block_words), f"id long, th long, runs {RUNS}")
    runs = materialize(sheets, "runs").select("id", "th", F.explode("runs").alias("r")).select("id", "th", "r.*")
    holder = runs.groupBy("hi", "lo").agg(F.min(F.struct("id", "th", "at")).alias("home"), F.max(F.struct("id", "th")).alias("last"))
    homes = materialize(holder.filter("home.id <> last.id or home.th <> last.th").select("hi", "lo", "home"), "homes")
    later = runs.join(homes, ["hi", "lo"]).filter("id <> home.id or th <> home.th")
    return later.groupBy("id", "th").agg(F.collect_set(F.struct("hi", "lo", "n", "at", "home")).alias("found"))


def _lists(column: pa.Array) -> list[list]:
    """The rows of a list column; null is empty."""
    ends = np.cumsum(np.concatenate([[0], np.asarray(pc.fill_null(column.value_lengths(), 0))]))
    values = column.flatten().to_pylist()
    return [values[a:b] for a, b in zip(ends, ends[1:])]


def _pairs(column: pa.Array) -> Iterator[dict[tuple[int, int], tuple[dict, dict]]]:
    """For each document: its runs by place and its home's, for each home."""
    ends = np.cumsum(np.concatenate([[0], np.asarray(pc.fill_null(column.value_lengths(), 0))]))
    hi, lo, n, at, home = column.flatten().flatten()
    home_id, home_th, home_at = home.flatten()
    rows = list(zip(zip(hi.to_pylist(), lo.to_pylist()), n.to_pylist(), _lists(at), zip(home_id.to_pylist(), home_th.to_pylist()), _lists(home_at)))
    for a, b in zip(ends, ends[1:]):
        out: dict = {}
        for run, size, own, source, theirs in rows[a:b]:
            mine, other = out.setdefault(source, ({}, {}))
            mine.update(((i, size), run) for i in own)
            other.update(((j, size), run) for j in theirs)
        yield out


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    return released(batches, _cut_batch)


def _cut_batch(batch: pa.RecordBatch) -> pa.RecordBatch:
    texts, n_lines, n_removed, blocks = [], [], [], []
    for text, pairs in zip(batch["text"].to_pylist(), _pairs(batch["found"])):
        own = [
            {"start": start, "lines": n, "source_doc": None if source[0] == LAST else source[0], "source_start": there}
            for source in sorted(pairs)
            for start, n, there in common_blocks(*pairs[source])
        ]
        blocks.append(own)
        if text is None:
            texts.append(None)
            n_lines.append(0)
            n_removed.append(0)
            continue
        drop, number, kept = {i for x in own for i in range(x["start"], x["start"] + x["lines"])}, -1, []
        for line in text.split("\n"):
            full = bool(line.strip(_BLANK))
            number += full
            if not (full and number in drop):
                kept.append(line)
        texts.append("\n".join(kept) if drop else text)
        n_lines.append(number + 1)
        n_removed.append(len(drop))
    return pa.RecordBatch.from_pydict(
        {
            "rest": batch["rest"],
            "text": pa.array(texts, pa.string()),
            "n_lines": pa.array(n_lines, pa.int64()),
            "n_removed": pa.array(n_removed, pa.int64()),
            "blocks": pa.array(blocks, _BLOCKS),
        }
    )


_BLOCKS = pa.list_(pa.struct([("start", pa.int32()), ("lines", pa.int32()), ("source_doc", pa.int64()), ("source_start", pa.int32())]))
_BLANK = " \t\n\r\x0b\x0c"


def dedup_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_words: int = BLOCK_WORDS) -> DataFrame:
    """The documents with common blocks deleted: one struct column ``row`` of all given columns (the text
    cut), ``n_lines``, ``n_removed``, and the aligned ``blocks`` with their sources; lines that are not blank count."""
    keyed = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in docs.columns if c != text_col]).alias("rest") if len(docs.columns) > 1 else F.struct(F.lit(1)).alias("rest"),
        F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(LAST)).alias("id"),
        F.xxhash64(F.col(f"`{text_col}`")).alias("th"),
        F.col(f"`{text_col}`").cast("string").alias("text"),
    )
    found = shared_runs(keyed.select("id", "th", "text"), block_words)
    joined = keyed.join(found, ["id", "th"], "left").select("rest", "text", "found")
    # A schema of types, not of text: names of extra columns may hold anything.
    counted = T.StructType.fromDDL(f"text string, n_lines long, n_removed long, blocks {BLOCKS}")
    cut = joined.mapInArrow(_cut, T.StructType([joined.schema["rest"], *counted]))
    row = F.struct(*[(F.col("text") if c == text_col else F.col(f"rest.`{c}`")).alias(c) for c in docs.columns])
    return cut.select(row.alias("row"), "n_lines", "n_removed", "blocks")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = dedup_lines(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    return found.select("row.doc_id", "n_lines", "n_removed", F.size("blocks").cast("long").alias("n_blocks"), F.sha2("row.text", 256).alias("text_sha256"))
