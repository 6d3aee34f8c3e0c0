"""Byte dedup by prefix-free parsing against a plain count of all strings."""

import random
from collections import Counter

import numpy as np
import pytest
from lapframe.llm import prefix_free

DOCS = "doc_id long, text string"


def plain_repeats(texts, k):
    """Of each text (bytes): which bytes start a string of k bytes that starts elsewhere too."""
    counts = Counter(t[i : i + k] for t in texts for i in range(len(t) - k + 1))
    return [[i <= len(t) - k and counts[t[i : i + k]] > 1 for i in range(len(t))] for t in texts]


def plain_cut(docs, k):
    """Per document: n_bytes, n_removed, kept, spans."""
    texts = [(t or "").encode() for _, t in docs]
    out = []
    for (d, _), t, hit in zip(docs, texts, plain_repeats(texts, k)):
        gone = [False] * len(t)
        for i, h in enumerate(hit):
            if h:
                gone[i : i + k] = [True] * k
        spans, i = [], 0
        while i < len(t):
            j = i
            while j < len(t) and gone[j] == gone[i]:
                j += 1
            if gone[i]:
                spans.append((i, j - i))
            i = j
        out.append((d, len(t), sum(gone), bytes(b for b, g in zip(t, gone) if not g), tuple(spans)))
    return sorted(out, key=str)


def cut(spark, docs, k, **settings):
    got = prefix_free.remove_repeated_bytes(spark.createDataFrame(docs, DOCS), min_bytes=k, **settings).collect()
    return sorted(((r["doc_id"], r["n_bytes"], r["n_removed"], bytes(r["kept"]), tuple(tuple(s) for s in r["spans"])) for r in got), key=str)


def random_docs(seed, n=70):
    r = random.Random(seed)
    letters = r.choice(["ab", "abcdefgh", "aé\x00 字"])
    passage = "".join(r.choice(letters) for _ in range(400))
    docs = []
    for i in range(n):
        text = "".join(r.choice(letters) for _ in range(r.choice([0, 1, 7, 40, 150])))
        if r.random() < 0.6:
            a = r.randrange(300)
            text += passage[a : a + r.randrange(5, 200)] + "".join(r.choice(letters) for _ in range(r.randrange(40)))
        docs.append((i, text))
    docs += [(n, docs[3][1]), (n, docs[3][1]), (n + 1, None), (None, docs[5][1]), (n + 2, ""), (n + 3, "a" * 300), (None, "b" * 40)]
    r.shuffle(docs)
    return docs


@pytest.mark.parametrize(
    "seed, k, block, hot, batch",
    [(1, 12, 1 << 20, 4000, 1 << 20), (2, 25, 600, 4000, 2000), (3, 9, 500, 2, 1 << 20), (4, 30, 900, 1, 700), (5, 60, 700, 3, 500), (6, 1, 800, 2, 300)],
)
def test_cut_equals_plain(sent, seed, k, block, hot, batch):
    docs = random_docs(seed)
    got = cut(sent, docs, k, block_bytes=block, hot_segments=hot, sorted_bytes=batch)
    assert got == plain_cut(docs, k)


@pytest.mark.parametrize("seed", range(40))
def test_corpus_order_finds_all_repeats(seed):
    r = random.Random(seed)
    k = r.choice([1, 2, 5, 9, 16, 30, 200])
    letters = r.choice([b"a", b"ab", b"\x00a", bytes(range(256))])
    passage = bytes(r.choice(letters) for _ in range(500))
    texts = []
    for _ in range(r.randrange(1, 20)):
        a = r.randrange(400)
        texts.append(bytes(r.choice(letters) for _ in range(r.randrange(60))) + passage[a : a + r.randrange(300)] + bytes(r.choice(letters) for _ in range(r.randrange(60))))
    edges = np.cumsum([0] + [len(t) for t in texts])
    got = prefix_free.repeated_starts(np.frombuffer(b"".join(texts), np.uint8), edges, k)
    assert got.tolist() == sum(plain_repeats(texts, k), [])


def test_phrases_are_prefix_free_and_the_order_is_that_of_the_suffixes():
    r = random.Random(9)
    texts = [bytes(r.choice(b"abc") for _ in range(r.randrange(50, 400))) for _ in range(12)]
    data, edges = np.frombuffer(b"".join(texts), np.uint8), np.cumsum([0] + [len(t) for t in texts])
    begin, end, text = prefix_free.parsed(data, edges)
    blob = data.tobytes()
    inner = {blob[a:b] for a, b, x, y in zip(begin, end, text, np.append(text[1:], -1)) if x == y}
    suffixes = {p[i:] for p in inner for i in range(len(p) - prefix_free.TRIGGER)}
    assert len(inner) > 20
    assert not any(a != b and b.startswith(a) for a in suffixes for b in suffixes)
    phrases = sorted({blob[a:b] for a, b in zip(begin, end)})
    place, rank = prefix_free.dictionary_order(phrases, 1000)
    every = [(p[i:], rank[place[n] + i]) for n, p in enumerate(phrases) for i in range(len(p))]
    every.sort()
    for (s, x), (t, y) in zip(every, every[1:]):
        assert x == y if s == t else x < y


def test_two_hundred_bytes_and_very_long_texts(sent):
    r = random.Random(3)
    passage = "".join(r.choice("abcdefgh ") for _ in range(199))
    long = "".join(r.choice("abcdefghijklmnop ") for _ in range(700_000))
    docs = [(1, "x" + passage), (2, "y" + passage), (3, "z" + passage + "!"), (4, "w" + passage + "!"), (5, long + passage), (6, long[300_000:300_250])]
    got = {d: removed for d, _, removed, _, _ in cut(sent, docs, 200)}
    assert got == {1: 0, 2: 0, 3: 200, 4: 200, 5: 250, 6: 250}


def test_empty_tables_and_more_columns(sent):
    assert cut(sent, [], 200) == []
    docs = sent.createDataFrame([(1, "ab" * 200, 5, 6)], "`my id` long, `my text` string, block long, share int")
    got = prefix_free.remove_repeated_bytes(docs, "my id", "my text").collect()
    assert [(r["doc_id"], r["n_bytes"], r["n_removed"]) for r in got] == [(1, 400, 400)]
