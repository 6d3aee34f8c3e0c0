"""Best-fit packing of token sequences under several capacities at once.

Texts become token ids with a public tokenizer, an end id is appended, and only what is longer
than a sequence is cut. Pieces are then packed by vector best-fit, longest first: a bin has
residual capacities for tokens, documents and attention cost (the sum of squared lengths), and of
the bins that can take a piece under every capacity the one is chosen that has the least weighted
norm of what would be left (``rule="norm"``) or the largest weighted dot product of piece and
residual (``rule="dot"``).

Pieces are written with a random ticket; the ticket's remainder is the share in which a piece is
packed. A share has about ``share_pieces`` pieces at any size of the corpus, so shares are packed
on their own and leave one open sequence each.

Null and empty texts are documents of the end id alone. Equal rows are packed one by one. Extra
columns are not read.
"""

from __future__ import annotations

import os
import random
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lapframe.llm.blocks import release, slices
from lapframe.session import materialize

TOKENS = 4096
SHARE_PIECES = 20_000
CACHE_WORDS = 250_000
SLICE_BYTES = 2 << 20

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long, ticket int"


class WordTokenizer:
    """Ids of texts, word by word.

    The tokenizer drops white space and never joins what stands on two sides of it, so the ids of a
    text are those of its chunks between white space. Each distinct chunk of a batch is encoded
    once, and frequent ones are kept for the next batch. Printable Latin chunks are split into the
    tokenizer's own parts, which recur more often; all others go to the tokenizer as they are.
    """

    #: Fixed: the parts into which the tokenizer's file splits text.
    PARTS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")

    def __init__(self, definition: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_str(definition)
        self.model = self.tokenizer.model
        self.chunks: dict[str, bytes] = {}
        self.parts: dict[str, bytes] = {}
        # Fixed: the byte-level alphabet, printable bytes as they are and the rest from 256 on.
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        rest = [b for b in range(256) if b not in plain]
        self.alphabet = {b: chr(b) for b in plain} | {b: chr(256 + i) for i, b in enumerate(rest)}

    def _part(self, part: str) -> bytes:
        found = self.parts.get(part)
        if found is None and not part:
            return b""
        if found is None:
            shown = part if part.isascii() else "".join(self.alphabet[b] for b in part.encode())
            found = np.array([t.id for t in self.model.tokenize(shown)], np.uint32).tobytes()
            if len(self.parts) >= CACHE_WORDS:
                self.parts.clear()
            self.parts[part] = found
        return found

    def chunk(self, chunk: str) -> bytes:
        found = self.chunks.get(chunk)
        if found is None:
            latin = chunk.isascii() or (max(chunk) < "ɐ" and "İ" not in chunk)
            if latin and chunk.isprintable() and "<|" not in chunk:
                found = b"".join([self._part(p) for p in self.PARTS.findall(chunk.lower())])
            else:
                found = np.array(self.tokenizer.encode(chunk, add_special_tokens=False).ids, np.uint32).tobytes()
            if len(self.chunks) >= CACHE_WORDS:
                self.chunks.clear()
            self.chunks[chunk] = found
        return found

    #: Chunks of simple letters (whose lower case and normal form are plain) and then simple marks.
    SIMPLE = (
        r"^(?P<letters>[A-Za-z\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{12F}\x{131}-\x{24F}]*)"
        r"(?P<marks>[!-&(-/:-@\[-`{-~]*)$"
    )

    def encode(self, texts: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
        """All ids, one text after another, and where each text's ids begin."""
        if isinstance(texts, pa.ChunkedArray):
            texts = texts.combine_chunks()
        split = pc.ascii_split_whitespace(pc.fill_null(texts, ""))
        coded = split.flatten().dictionary_encode()
        simple = pc.extract_regex(coded.dictionary, self.SIMPLE)
        plain = np.asarray(simple.is_valid())
        letters = pc.utf8_lower(simple.field("letters").filter(simple.is_valid())).dictionary_encode()
        marks = simple.field("marks").filter(simple.is_valid()).dictionary_encode()
        others = coded.dictionary.filter(pc.invert(simple.is_valid())).to_pylist()
        known = self.parts.get
        ids = [known(p) or self._part(p) for p in letters.dictionary.to_pylist()]
        n_letters = len(ids)
        ids += [self._part(p) for p in marks.dictionary.to_pylist()]
        n_parts = len(ids)
        ids += [self.chunk(c) for c in others]
        # Each distinct chunk is one or two parts: letters and marks, or itself and nothing.
        pair = np.full((len(plain), 2), len(ids), np.int64)
        ids.append(b"")
        pair[plain, 0], pair[plain, 1] = np.asarray(letters.indices), np.asarray(marks.indices) + n_letters
        pair[~plain, 0] = np.arange(len(others)) + n_parts
        flat = np.frombuffer(b"".join(ids), np.uint32)
        sizes = np.array([len(x) // 4 for x in ids], np.int64)
        begins = np.cumsum(sizes) - sizes
        at = pair[np.asarray(coded.indices)].ravel()
        n = sizes[at]
        total = np.concatenate([[0], np.cumsum(n)])
        place = np.arange(total[-1]) + np.repeat(begins[at] - total[:-1], n)
        edges = np.asarray(split.offsets) - (split.offsets[0].as_py() if len(split) else 0)
        return flat[place], total[2 * edges]


def default_tokenizer() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def token_pieces(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    tokenizer_path: str | None = None,
    end_id: int = 1,
    tokens: int = TOKENS,
    keep_ids: bool = False,
) -> DataFrame:
    """Pieces of at most ``tokens`` ids, each with a random ticket. The tokenizer's file is read on the driver."""
    with open(tokenizer_path or default_tokenizer(), encoding="utf-8") as file:
        definition = docs.sparkSession.sparkContext.broadcast(file.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = WordTokenizer(definition.value)  # its cache ends with the task
        for batch in batches:
            for part in slices(batch, "text", SLICE_BYTES):
                ids, first = tokenizer.encode(part["text"])
                rows = {c: [] for c in ("doc_id", "piece", "start", "length", "ids_crc32", "ticket", "ids")}
                for i, doc in enumerate(part["doc_id"].to_pylist()):
                    own = np.append(ids[first[i] : first[i + 1]], np.uint32(end_id)).astype("<u4")
                    for k, s in enumerate(range(0, len(own), tokens)):
                        piece = own[s : s + tokens]
                        rows["doc_id"].append(doc)
                        rows["piece"].append(k)
                        rows["start"].append(s)
                        rows["length"].append(len(piece))
                        rows["ids_crc32"].append(zlib.crc32(piece))
                        rows["ticket"].append(random.getrandbits(31))
                        rows["ids"].append(piece.astype(np.int32) if keep_ids else None)
                schema = [("doc_id", pa.int64()), ("piece", pa.int32()), ("start", pa.int64()), ("length", pa.int64())]
                schema += [("ids_crc32", pa.int64()), ("ticket", pa.int32())] + [("ids", pa.list_(pa.int32()))] * keep_ids
                yield pa.RecordBatch.from_pydict({c: rows[c] for c, _ in schema}, pa.schema(schema))
                del ids, first, rows
                release()
        del tokenizer
        release()

    chosen = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return chosen.mapInArrow(run, PIECES + ", ids array<int>" * keep_ids)


def best_fit(
    lengths: np.ndarray, capacity: tuple[int, int, int], weights: tuple[float, float, float] = (1.0, 0.01, 0.01), rule: str = "norm"
) -> tuple[np.ndarray, np.ndarray]:
    """For each length its bin and its place there; the three capacities are tokens, documents, attention cost."""
    lengths = lengths.astype(np.int64)
    size = np.array(capacity, np.float64)
    if len(lengths) and (lengths.max() > capacity[0] or capacity[1] < 1 or int(lengths.max()) ** 2 > capacity[2]):
        raise ValueError("a piece is larger than a sequence may be")
    scale = np.array(weights) / size**2
    order = np.argsort(-lengths, kind="stable")
    bins, places = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    open_bins = np.zeros(1024, np.int64)
    left = np.zeros((1024, 3))
    n_open = n_bins = 0
    least = int(lengths.min(initial=1))
    for i in order:
        need = np.array([lengths[i], 1.0, float(lengths[i]) ** 2])
        after = left[:n_open] - need
        fits = np.flatnonzero((after >= 0).all(axis=1))
        if len(fits):
            score = (after[fits] ** 2 @ scale) if rule == "norm" else -((left[fits] * need) @ scale)
            at = fits[np.argmin(score)]
        else:
            if n_open == len(open_bins):
                open_bins, left = np.concatenate([open_bins, open_bins * 0]), np.concatenate([left, left * 0])
            at, n_open = n_open, n_open + 1
            open_bins[at], left[at], n_bins = n_bins, size, n_bins + 1
        bins[i], places[i] = open_bins[at], capacity[0] - left[at, 0]
        left[at] -= need
        if left[at, 0] < least or left[at, 1] < 1 or left[at, 2] < least**2:  # full: the last open bin takes its place
            n_open -= 1
            open_bins[at], left[at] = open_bins[n_open], left[n_open]
    return bins, places


def pack_pieces(
    pieces: DataFrame,
    tokens: int = TOKENS,
    documents: int | None = None,
    attention_cost: int | None = None,
    rule: str = "norm",
    share_pieces: int = SHARE_PIECES,
) -> DataFrame:
    """Add ``sequence_id`` and ``offset``. ``pieces`` must be written already, so that tickets stay as they are.

    ``documents`` and ``attention_cost`` bound the pieces of a sequence and the sum of their squared
    lengths; unset, only tokens bind.
    """
    capacity = (tokens, documents or tokens, attention_cost or tokens * tokens)
    n_shares = max(1, -(-pieces.count() // share_pieces))

    def run(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        lengths = np.asarray(table["length"])
        bins, places = best_fit(lengths, capacity, rule=rule)
        share = table["share"][0].as_py()
        table = table.append_column("sequence_id", pa.array((share << 32) + bins))
        return table.append_column("offset", pa.array(places)).drop_columns(["share", "ticket"])

    kept = [c for c in pieces.columns if c != "ticket"]
    kinds = dict(pieces.dtypes)
    schema = ", ".join(f"{c} {kinds[c]}" for c in kept) + ", sequence_id long, offset long"
    shared = pieces.withColumn("share", (F.col("ticket") % n_shares).cast("long"))
    return shared.groupBy("share").applyInArrow(run, schema)


def pack(docs: DataFrame, **settings) -> DataFrame:
    """Tokens of documents in sequences: ``doc_id, piece, start, length, ids_crc32, sequence_id, offset``."""
    own = {k: settings.pop(k) for k in ("id_col", "text_col", "tokenizer_path", "end_id", "keep_ids") if k in settings}
    tokens = settings.get("tokens", TOKENS)
    return pack_pieces(materialize(token_pieces(docs, tokens=tokens, **own), "pieces"), **settings)


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet"))
