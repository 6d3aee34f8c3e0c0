"""Ranked search against scoring every document."""

import math
import random
from collections import Counter

import numpy as np
import plain
import pyarrow as pa
import pytest
from lapframe.llm import ranked_search

DOCS, ITEMS = "doc_id long, text string", "item_id long, text string"


def plain_search(docs, items, k):
    own = [(d, Counter(plain.LETTERS.findall(plain.lower(t or "")))) for d, t in docs]
    own = [(d, c, sum(c.values())) for d, c in own if c]
    n, total = len(own), sum(x for _, _, x in own)
    df = Counter(t for _, c, _ in own for t in c)
    out = []
    for item, text in items:
        rows = []
        for d, c, length in own:
            m = 100 - 90 + (90 * length * n) // total
            score = sum(
                math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((1000000000 * c[t]) // (1000 * c[t] + 8 * m))
                for t in set(plain.LETTERS.findall(plain.lower(text or ""))) if c[t]
            )
            if score > 0:
                rows.append((-score, d is None, d or 0))
        out += [(item, rank, None if null else d, -s) for rank, (s, null, d) in enumerate(sorted(rows)[:k], 1)]
    return sorted(out, key=str)


def found(spark, docs, items, k, shard, block, **settings):
    index = ranked_search.build_index(spark.createDataFrame(docs, DOCS), shard_bytes=shard, block=block)
    got = ranked_search.search(index, spark.createDataFrame(items, ITEMS), k=k, **settings)
    return sorted((tuple(r) for r in got.collect()), key=str)


def random_rows(seed, n=150):
    r = random.Random(seed)
    words = [f"w{i}" for i in range(80)] + ["Été", "字", "a1", "B"]
    weights = [1 / (i + 1) for i in range(len(words))]
    docs = [(i, r.choice([" ", "-", "\n"]).join(r.choices(words, weights, k=r.choice([0, 1, 5, 30, 200])))) for i in range(n)]
    docs += [(n, None), (None, docs[3][1]), (n + 1, ""), (7, docs[7][1]), (n + 2, docs[7][1]), (None, docs[7][1])]
    r.shuffle(docs)
    items = [(i, " ".join(r.choices(words, k=r.randrange(1, 12)))) for i in range(25)] + [(25, None), (26, "none of-these"), (26, "w1 w1 W1"), (None, "w3 字"), (27, "w0")]
    return docs, items


@pytest.mark.parametrize("seed, k, shard, block", [(1, 10, 1 << 20, 128), (2, 3, 2000, 4), (3, 1, 500, 2), (4, 500, 3000, 8), (5, 10, 1, 1)])
def test_search_equals_scoring_everything(sent, seed, k, shard, block):
    docs, items = random_rows(seed)
    want = plain_search(docs, items, k)
    assert len(want) > 20
    assert found(sent, docs, items, k, shard, block) == want


def test_items_in_several_passes(sent):
    docs, items = random_rows(6)
    assert found(sent, docs, items, 5, 3000, 8, pass_words=20) == plain_search(docs, items, 5)


def test_bounds_spare_blocks():
    """A rare term decides; the blocks of the common one are not opened where they cannot matter."""
    r = random.Random(1)
    texts = ["common " * r.randrange(4) + " ".join(f"x{r.randrange(500)}" for _ in range(r.randrange(3, 40))) for _ in range(3000)]
    for i in range(0, 3000, 97):
        texts[i] += " rare rare rare"
    table = pa.table({"doc_id": np.arange(3000), "text": texts})
    row = {c: pa.scalar(v) for c, v in ranked_search.build_shard(table, 16).items()}
    queries = ranked_search.encode([(0, "common rare")])
    n_words = row["n_words"].as_py()
    df = [sum(t in x.split() for x in texts) for t in queries.terms.to_pylist()]
    weights = np.array([ranked_search.weight(3000, x) for x in df])
    shard = ranked_search.Shard(row, queries, weights, 3000, n_words)
    _, scores = shard.search(queries.wanted[0], 1, 10)
    full = ranked_search.Shard(row, queries, weights, 3000, n_words)
    again, same = full.search(queries.wanted[0], int(np.sort(scores)[-10]), 10)
    assert len(again) >= 10 and np.sort(same)[-10:].tolist() == np.sort(scores)[-10:].tolist()
    assert full.opened < 0.2 * int((shard.end - shard.begin).sum())


def test_wide_numbers_and_long_texts(sent):
    docs = [(i, "a " * (70_000 if i == 5 else i % 300) + "b") for i in range(700)]
    items = [(1, "a"), (2, "b a"), (3, "b")]
    assert found(sent, docs, items, 10, 1 << 20, 128) == plain_search(docs, items, 10)


def test_empty_tables_and_more_columns(sent):
    assert found(sent, [], [(1, "a")], 3, 100, 4) == []
    assert found(sent, [(1, "a b")], [], 3, 100, 4) == []
    docs = sent.createDataFrame([(1, "a b", 5, 6)], "`my id` long, `my text` string, query long, score long")
    items = sent.createDataFrame([("x", "b", 1)], "`my item` string, words string, rank long")
    index = ranked_search.build_index(docs, "my id", "my text")
    assert [tuple(r) for r in ranked_search.search(index, items, "my item", "words").select("item_id", "rank", "doc_id").collect()] == [("x", 1, 1)]
