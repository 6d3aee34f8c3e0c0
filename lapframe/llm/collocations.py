"""Phrase collocations by the stripes pattern.

A stripe is a prefix with a counter of the words that follow it. Stripes of one prefix are merged by
adding their counters, and one merged structure gives all that the scores need: the extensions (counts of the longer
phrases), the prefix's own total, and the largest extension, which may subsume the prefix.

1. Documents are written as blocks. Every block counts its words per language; the share that owns a word adds them up.
   Words with ``min_count`` occurrences get a number and go back, with their counts, to the blocks that have them:
   no phrase with a rarer word can be a candidate.
2. Every block makes stripes: the prefix is a pair of such words, the counter holds the third word, or 0 where
   the piece ends or a rare word follows. Blocks merge their own stripes before they are sent, as arrays.
   The share that owns a prefix merges the stripes of all blocks.
3. What remains are candidates. Joins bring in the totals of their parts and the largest extension to the left.

A prefix whose words are both very frequent would be one hot group. Its counter is cut into slices by the third
word; totals and largest extensions of the slices are merged afterwards. The number of slices follows from the words' counts
over the whole corpus, so all blocks cut alike. Words are compared as strings, phrases by the words' numbers: no hashes
decide. Scores are computed in 38 digits.

Null and empty texts have no words; a null language is ``und``. Repeated rows count each time. Equal scores are ranked by count,
then by the phrase's bytes. A very long text is a block of its own. An empty table has no phrases. Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lapframe.llm.blocks import joined, pack, partitions, released, routed, squeezed, unpack
from lapframe.llm.exchange import arrow_schema, shares, text_blocks, together
from lapframe.llm.words import Words, mix, strings, utf8
from lapframe.session import materialize

MIN_COUNT = 10
#: A phrase goes if a longer one has this share of its occurrences, in hundredths.
SUBSUMED = 50
TOP = 2_000
BLOCK = 4 << 20
#: Occurrences that a slice of a stripe may stand for.
SLICE = 1 << 20
U64 = np.uint64
SHARE_BITS = 40

#: What parts pieces: . , ; : ! ? and the bytes from line feed to carriage return (fixed values).
PARTING = np.zeros(256, bool)
PARTING[[0x2E, 0x2C, 0x3B, 0x3A, 0x21, 0x3F, 0x0A, 0x0B, 0x0C, 0x0D]] = True
INSIDE = ~PARTING
INSIDE[[0x20, 0x09]] = False

DOCS = "block long, docs binary"
COUNTS = "share int, block long, words binary"
VOCABULARY = "kind int, block long, number binary, id binary, often binary, lang string, word string, word_id long, f long"
KNOWN = "block long, number binary, id binary, often binary"
STRIPES = "share int, block long, one binary, two binary, three binary, n binary, cut binary"
GRAMS = "kind int, one long, two long, three long, n long, most long"
REPLY, WORD, TOTAL = 0, 1, 2
PAIR, TRIPLE = 2, 3


class Block:
    """The words of one block: ``entry`` numbers the distinct (language, word) pairs of the block."""

    def __init__(self, blob):
        table = unpack(blob)
        words = Words(*utf8(table["text"]), INSIDE)
        spelled = strings(words).dictionary_encode()
        langs = table["lang"].combine_chunks().dictionary_encode()
        lang_of = np.repeat(np.asarray(langs.indices), words.counts).astype(np.int64)
        n_langs = max(1, len(langs.dictionary))
        own, self.entry, self.counts = np.unique(
            np.asarray(spelled.indices).astype(np.int64) * n_langs + lang_of, return_inverse=True, return_counts=True
        )
        self.word = spelled.dictionary.take(pa.array(own // n_langs))
        self.lang = langs.dictionary.take(pa.array(own % n_langs))
        parting = np.cumsum(PARTING[words.data])
        #: Whether the next word stands in the same piece.
        self.linked = np.zeros(len(words), bool)
        self.linked[:-1] = parting[words.starts[1:] - 1] == parting[words.ends[:-1] - 1]
        edge = words.first[1:-1] - 1
        self.linked[edge[edge >= 0]] = False


def _counts(n_shares: int):
    def one(block: pa.Scalar, blob: pa.Scalar) -> pa.RecordBatch:
        b = Block(blob.as_buffer())
        hashes = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in b.word.to_pylist()), U64, len(b.word))
        share = (hashes % U64(n_shares)).astype(np.int64)
        order = np.argsort(share, kind="stable")
        ends = np.searchsorted(share[order], np.arange(n_shares + 1))
        full = np.flatnonzero(np.diff(ends))
        table = pa.table({"lang": b.lang, "word": b.word, "n": b.counts, "number": np.arange(len(b.word))}).take(order)
        packed = [pack(table.slice(ends[s], ends[s + 1] - ends[s])) for s in full]
        return pa.RecordBatch.from_arrays(
            [pa.array(full.astype(np.int32)), pa.array([block.as_py()] * len(full), pa.int64()), pa.array(packed, pa.binary())],
            ["share", "block", "words"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield from released(zip(batch["block"], batch["docs"]), lambda row: one(*row))

    return run


def _vocabulary(min_count: int):
    def run(table: pa.Table) -> pa.Table:
        """Of one share: the frequent words, what each block needs to know of them, and how many words each language has."""
        share = table["share"][0].as_py()
        parts = [unpack(v.as_buffer()) for v in table["words"]]
        sizes = [p.num_rows for p in parts]
        whole = pa.concat_tables(parts).combine_chunks()
        word, lang = (whole[c].combine_chunks().dictionary_encode() for c in ("word", "lang"))
        n_langs = len(lang.dictionary)
        key = np.asarray(word.indices).astype(np.int64) * n_langs + np.asarray(lang.indices)
        own, place = np.unique(key, return_inverse=True)
        f = np.zeros(len(own), np.int64)
        np.add.at(f, place, np.asarray(whole["n"]))
        frequent = f >= min_count
        # Numbers begin with 1: 0 is the end of a piece or a rare word.
        ids = np.where(frequent, (share << SHARE_BITS) + np.cumsum(frequent), 0)
        number, source = np.asarray(whole["number"]), np.repeat(np.arange(len(parts)), sizes)
        said = np.flatnonzero(frequent[place])
        ends = np.searchsorted(source[said], np.arange(len(parts) + 1))
        told = [said[a:b] for a, b in zip(ends, ends[1:])]
        told = [t[np.argsort(number[t])] for t in told]
        replies = pa.table(
            {
                "kind": np.full(len(parts), REPLY, np.int32),
                "block": table["block"].combine_chunks(),
                "number": pa.array([squeezed(number[t]) for t in told], pa.binary()),
                "id": pa.array([squeezed(ids[place[t]]) for t in told], pa.binary()),
                "often": pa.array([squeezed(f[place[t]]) for t in told], pa.binary()),
            }
        )
        keep = np.flatnonzero(frequent)
        words = pa.table(
            {
                "kind": np.full(len(keep), WORD, np.int32),
                "lang": lang.dictionary.take(pa.array(own[keep] % n_langs)).cast(pa.string()),
                "word": word.dictionary.take(pa.array(own[keep] // n_langs)).cast(pa.string()),
                "word_id": ids[keep],
                "f": f[keep],
            }
        )
        totals = np.bincount(own % n_langs, f, n_langs).astype(np.int64)
        totals = pa.table({"kind": np.full(n_langs, TOTAL, np.int32), "lang": lang.dictionary.cast(pa.string()), "f": totals})
        schema = arrow_schema(VOCABULARY)
        filled = [pa.table({c: t[c] if c in t.column_names else pa.nulls(t.num_rows, schema.field(c).type) for c in schema.names}, schema) for t in (replies, words, totals)]
        return pa.concat_tables(filled)

    return run


def merged(one: np.ndarray, two: np.ndarray, three: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, ...]:
    """Stripes with equal prefixes added element by element, in the order of prefix and next word."""
    order = np.lexsort((three, two, one))
    one, two, three, n = one[order], two[order], three[order], n[order]
    new = np.ones(len(order), bool)
    new[1:] = (one[1:] != one[:-1]) | (two[1:] != two[:-1]) | (three[1:] != three[:-1])
    first = np.flatnonzero(new)
    return one[new], two[new], three[new], np.add.reduceat(n, first) if len(first) else n, order[new]


def _stripes(n_shares: int, slice_words: int):
    def run(blocks: pa.Table, known: pa.Table) -> pa.Table:
        parts = [arrow_schema(STRIPES).empty_table()]
        number, ids, often = (joined(known[c], np.int64, True) for c in ("number", "id", "often"))
        for block, blob in zip(blocks["block"], blocks["docs"]):
            b = Block(blob.as_buffer())
            id_of, f_of = np.zeros((2, len(b.word)), np.int64)
            id_of[number], f_of[number] = ids, often
            word, f = id_of[b.entry], f_of[b.entry]
            at = np.flatnonzero(b.linked[:-1] & (word[:-1] > 0) & (word[1:] > 0)) if len(word) > 1 else np.zeros(0, np.int64)
            after = np.minimum(at + 2, max(len(word) - 1, 0))
            three = np.where(b.linked[at + 1] & (at + 2 < len(word)), word[after], 0) if len(at) else at
            least = np.minimum(f[at], f[at + 1]) if len(at) else at
            one, two, three, n, kept = merged(word[at], word[at + 1] if len(at) else at, three, np.ones(len(at), np.int64))
            slices = -(-least[kept] // slice_words)
            part = (mix(three.astype(U64)) % np.maximum(slices, 1).astype(U64)).astype(U64)
            share = (mix(mix(one.astype(U64)) ^ (two.astype(U64) * U64(0x9E3779B97F4A7C15)) ^ (part << U64(48))) % U64(n_shares)).astype(np.int64)
            columns = {"one": one, "two": two, "three": three, "n": n, "cut": (slices > 1).astype(np.int64)}
            rows = routed(share, n_shares, columns, {"block": block.as_py()}, list(columns))
            parts.append(pa.Table.from_batches([rows]))
        return pa.concat_tables(parts)

    return run


def _grams(min_count: int):
    def run(table: pa.Table) -> pa.Table:
        """Of one share: merged stripes, of which the frequent prefixes and extensions stay."""
        cut = joined(table["cut"], np.int64, True)
        one, two, three, n, kept = merged(*(joined(table[c], np.int64, True) for c in ("one", "two", "three", "n")))
        new = np.ones(len(one), bool)
        new[1:] = (one[1:] != one[:-1]) | (two[1:] != two[:-1])
        first = np.flatnonzero(new)
        extends = (three > 0) & (n >= min_count)
        total = np.add.reduceat(n, first) if len(first) else n
        most = np.maximum.reduceat(np.where(extends, n, 0), first) if len(first) else n
        some = (total >= min_count) | (cut[kept][first] > 0)
        head, ext = first[some], np.flatnonzero(extends)
        none = np.zeros(len(head), np.int64)
        return pa.table(
            [
                np.repeat(np.array([PAIR, TRIPLE], np.int32), [len(head), len(ext)]),
                np.append(one[head], one[ext]),
                np.append(two[head], two[ext]),
                np.append(none, three[ext]),
                np.append(total[some], n[ext]),
                np.append(most[some], np.zeros(len(ext), np.int64)),
            ],
            schema=arrow_schema(GRAMS),
        )

    return run


def count_phrases(
    docs: DataFrame, text_col: str = "text", lang_col: str = "lang", min_count: int = MIN_COUNT, block_bytes: int = BLOCK, slice_words: int = SLICE
) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Words, languages, pairs and triples that occur ``min_count`` times, all of them written tables.

    ``word_id, lang, word, f``; ``lang, n`` (all words count); ``one, two, n, most``, ``most`` being the count of the pair's
    most frequent extension to the right; ``one, two, three, n``.
    """
    rows = docs.select(
        F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("und")).alias("lang"), F.col(f"`{text_col}`").cast("string").alias("text")
    )
    blocks = text_blocks(rows, "text", block_bytes)
    n = shares(blocks, block_bytes)
    counts = blocks.mapInArrow(_counts(n), COUNTS)
    vocabulary = materialize(counts.groupBy("share").applyInArrow(_vocabulary(min_count), VOCABULARY), "vocabulary")
    known = vocabulary.filter(f"kind = {REPLY}").select(*[c.split()[0] for c in KNOWN.split(", ")])
    stripes = together([(blocks, DOCS), (known, KNOWN)], "block", _stripes(n, slice_words), STRIPES)
    grams = materialize(stripes.groupBy("share").applyInArrow(_grams(min_count), GRAMS), "phrases")
    pairs = grams.filter(f"kind = {PAIR}").groupBy("one", "two").agg(F.sum("n").alias("n"), F.max("most").alias("most"))
    return (
        vocabulary.filter(f"kind = {WORD}").select("word_id", "lang", "word", "f"),
        vocabulary.filter(f"kind = {TOTAL}").groupBy("lang").agg(F.sum("f").alias("n")),
        materialize(pairs.filter(F.col("n") >= min_count), "pairs"),
        grams.filter(f"kind = {TRIPLE}").select("one", "two", "three", "n"),
    )


def _score(a: str, left: str, right: str):
    digits = "cast({} as decimal(20, 0))".format
    return F.expr(f"(1000000 * {digits(a)} * {digits(a)}) div ({digits(left)} * {digits(right)})")


def collocations(
    docs: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    min_count: int = MIN_COUNT,
    subsumed: int = SUBSUMED,
    top: int | None = TOP,
    block_bytes: int = BLOCK,
    slice_words: int = SLICE,
) -> DataFrame:
    """Per language the phrases of two and three words by score: ``lang, rank, phrase, a, l, r, n, score``.

    ``top=None`` keeps all candidates.
    """
    words, totals, pairs, triples = count_phrases(docs, text_col, lang_col, min_count, block_bytes, slice_words)

    def word(k: int, name: str) -> DataFrame:
        return words.select(F.col("word_id").alias(name), F.col("word").alias(f"w{k}"), F.col("f").alias(f"f{k}"))

    before = triples.groupBy(F.col("two").alias("one"), F.col("three").alias("two")).agg(F.max("n").alias("before"))
    free = pairs.join(before, ["one", "two"], "left").filter(
        F.lit(100) * F.greatest("most", F.coalesce("before", F.lit(0))) < F.lit(subsumed) * F.col("n")
    )
    two = (
        free.join(word(1, "one"), "one")
        .join(word(2, "two"), "two")
        .select("one", F.concat_ws(" ", "w1", "w2").alias("phrase"), F.col("n").alias("a"), F.col("f1").alias("l"), F.col("f2").alias("r"), _score("n", "f1", "f2").alias("score"))
    )
    front = pairs.select("one", "two", F.col("n").alias("front"))
    back = pairs.select(F.col("one").alias("two"), F.col("two").alias("three"), F.col("n").alias("back"))
    cuts = (
        triples.join(front, ["one", "two"])
        .join(back, ["two", "three"])
        .join(word(1, "one"), "one")
        .join(words.select(F.col("word_id").alias("two"), F.col("word").alias("w2")), "two")
        .join(word(3, "three"), "three")
        .select("*", _score("n", "f1", "back").alias("s1"), _score("n", "front", "f3").alias("s2"))
    )
    early = F.col("s1") <= F.col("s2")
    three = cuts.select(
        "one",
        F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"),
        F.col("n").alias("a"),
        F.when(early, F.col("f1")).otherwise(F.col("front")).alias("l"),
        F.when(early, F.col("back")).otherwise(F.col("f3")).alias("r"),
        F.least("s1", "s2").alias("score"),
    )
    lang = words.select(F.col("word_id").alias("one"), "lang")
    found = two.unionByName(three).join(lang, "one").drop("one")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    if top is not None:
        # A language may hold most rows: its best are found in parts first.
        salt = F.pmod(F.xxhash64("phrase"), F.lit(partitions(docs)))
        part = found.withColumn("salt", salt)
        found = part.withColumn("rank", F.row_number().over(Window.partitionBy("lang", "salt").orderBy(*order)))
        found = found.filter(F.col("rank") <= top).drop("salt", "rank")
    ranked = found.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long"))
    if top is not None:
        ranked = ranked.filter(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def query(spark, sf_dir: str) -> DataFrame:
    return collocations(spark.read.parquet(f"{sf_dir}/documents.parquet"))


ORACLE = r"""
WITH piece AS (SELECT coalesce(lang, 'und') AS lang, regexp_extract_all(p, '[^\x20\x09]+') AS w FROM (
  SELECT lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[.,;:!?\x0A-\x0D]')) AS p FROM documents)),
gram AS (SELECT lang, k, array_to_string(w[s:s + k - 1], ' ') AS phrase, count(*) AS f
  FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS s FROM piece, (SELECT unnest([1, 2, 3]) AS k)) GROUP BY ALL),
total AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM gram WHERE k = 1 GROUP BY lang),
cand AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM gram WHERE k > 1 AND f >= 10),
cut AS (SELECT c.lang, c.phrase, c.a, j, x.f AS l, y.f AS r,
    CAST((1000000::HUGEINT * c.a * c.a) // (x.f::HUGEINT * y.f) AS BIGINT) AS score
  FROM (SELECT *, unnest(range(1, k)) AS j FROM cand) c
  JOIN gram x ON x.lang = c.lang AND x.phrase = array_to_string(c.w[:j], ' ')
  JOIN gram y ON y.lang = c.lang AND y.phrase = array_to_string(c.w[j + 1:], ' ')),
best AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, j) = 1),
inner_phrase AS (SELECT lang, array_to_string(w[1:2], ' ') AS phrase, a FROM cand WHERE k = 3
  UNION ALL SELECT lang, array_to_string(w[2:3], ' '), a FROM cand WHERE k = 3),
longest AS (SELECT lang, phrase, max(a) AS m FROM inner_phrase GROUP BY lang, phrase),
ranked AS (SELECT b.lang, b.phrase, b.a, b.l, b.r, b.score, row_number() OVER (PARTITION BY b.lang ORDER BY b.score DESC, b.a DESC, encode(b.phrase)) AS rank
  FROM best b LEFT JOIN longest g ON b.lang = g.lang AND b.phrase = g.phrase WHERE 100 * coalesce(g.m, 0) < 50 * b.a)
SELECT lang, rank, phrase, a, l, r, n, score FROM ranked JOIN total USING (lang) WHERE rank <= 2000
"""
