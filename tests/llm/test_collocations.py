"""Collocations by stripes against plain counting."""

import random
import re
from collections import Counter

import numpy as np
import plain
import pytest
from lapframe.llm import collocations

DOCS = "doc_id long, text string, lang string"


def plain_collocations(docs, least, subsumed, top):
    counts, total = {}, Counter()
    for _, text, lang in docs:
        own = counts.setdefault(lang or ("und" if lang is None else lang), Counter())
        for piece in re.split("[.,;:!?\x0a-\x0d]", plain.lower(text or "")):
            w = re.findall("[^\x20\x09]+", piece)
            total["und" if lang is None else lang] += len(w)
            for k in (1, 2, 3):
                own.update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, own in counts.items():
        cands = {p: a for p, a in own.items() if len(p) > 1 and a >= least}
        rows = []
        for p, a in cands.items():
            if any(100 * b >= subsumed * a for q, b in cands.items() if len(q) > len(p) and any(q[i : i + len(p)] == p for i in range(2))):
                continue
            score, k = min((1000000 * a * a // (own[p[:k]] * own[p[k:]]), k) for k in range(1, len(p)))
            rows.append((-score, -a, " ".join(p).encode(), own[p[:k]], own[p[k:]]))
        for rank, (score, a, phrase, left, right) in enumerate(sorted(rows)[:top], 1):
            out.append((lang, rank, phrase.decode(), -a, left, right, total[lang], -score))
    return sorted(out)


def random_docs(seed, n=120):
    r = random.Random(seed)
    words = r.choice([["a", "b"], "a b c d é ff Gg 'x (y) -".split(), [f"w{i}" for i in range(60)]])
    docs = []
    for i in range(n):
        parts = []
        for _ in range(r.choice([0, 1, 8, 40])):
            parts.append(r.choice(words) if r.random() < 0.7 else "new York City")
            parts.append(r.choice([" ", " ", " ", "  ", "\t", ". ", ",", "\n", " ! ", "\x0b"]))
        docs.append((i, "".join(parts), r.choice(["en", "fr", None, "und"])))
    return docs + [(n, None, "en"), (n, "", None), (None, docs[4][1], "de"), (n, docs[4][1], "de"), (n, docs[4][1], "de")]


def mined(spark, docs, least, subsumed, top, **settings):
    got = collocations.collocations(spark.createDataFrame(docs, DOCS), min_count=least, subsumed=subsumed, top=top, **settings)
    return sorted(tuple(r) for r in got.collect())


@pytest.mark.parametrize("seed, least, subsumed, top, block, cut", [(1, 2, 50, 50, 1 << 20, 1 << 20), (2, 3, 50, 1000, 300, 5), (3, 1, 80, 7, 500, 2), (4, 10, 50, 2000, 200, 1)])
def test_collocations_equal_plain(sent, seed, least, subsumed, top, block, cut):
    docs = random_docs(seed)
    want = plain_collocations(docs, least, subsumed, top)
    assert want
    assert mined(sent, docs, least, subsumed, top, block_bytes=block, slice_words=cut) == want


def test_merged_stripes_add_element_by_element():
    one, two, three, n, first = collocations.merged(*(np.array(x) for x in ([1, 1, 1, 2], [5, 5, 5, 5], [7, 0, 7, 7], [1, 2, 3, 4])))
    assert list(zip(one, two, three, n)) == [(1, 5, 0, 2), (1, 5, 7, 4), (2, 5, 7, 4)]
    assert first[0] == 1 and first[2] == 3


def test_one_pair_in_a_third_of_all_rows_and_long_texts(sent):
    r = random.Random(2)
    docs = [(i, "hot pair " + f"w{r.randrange(30)}" + (" x" * 300 if i % 3 else ""), "en") for i in range(300)]
    docs.append((300, "long " * 60_000 + "\n" + "z" * 200_000, "en"))
    assert mined(sent, docs, 10, 50, 100, block_bytes=2000, slice_words=20) == plain_collocations(docs, 10, 50, 100)


def test_empty_tables_and_more_columns(sent):
    assert mined(sent, [], 1, 50, 10) == []
    assert mined(sent, [(1, None, None)], 1, 50, 10) == []
    docs = sent.createDataFrame([("a b. a b", "en", 1, 2, 3)], "`my text` string, `my lang` string, word_id long, one long, rank long")
    got = collocations.collocations(docs, "my text", "my lang", min_count=2).collect()
    assert [tuple(r) for r in got] == [("en", 1, "a b", 2, 2, 2, 4, 1000000)]
