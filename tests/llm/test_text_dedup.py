"""Substring dedup, SimHash groups, line dedup and decontamination against plain versions."""

import random

import numpy as np
import plain
import pytest
from lapframe.llm import decontaminate, graph, line_dedup, simhash, substring_dedup
from lapframe.llm.words import LETTERS, Words, sliding_argmin, utf8

DOCS = "doc_id long, text string"


def rows_of(df, *columns):
    return sorted((tuple(r[c] for c in columns) for r in df.collect()), key=str)


def random_docs(seed, n=60, words="a b c d e f gg hh".split(), shared=True):
    r = random.Random(seed)
    passage = [r.choice(words) for _ in range(40)]
    out = []
    for i in range(n):
        w = [r.choice(words) for _ in range(r.choice([0, 1, 5, 19, 20, 60]))]
        if shared and r.random() < 0.5:
            a = r.randrange(20)
            w[len(w) // 2 : len(w) // 2] = passage[a : a + r.randrange(5, 20)]
        out.append((i, r.choice([" ", "\n", "  \t"]).join(w)))
    out += [(n, out[3][1]), (n + 1, out[40][1] + " " + out[41][1]), (n + 2, None), (None, out[5][1]), (n + 3, " \n "), (n + 4, "é " * 50), (n + 4, "é " * 50)]
    r.shuffle(out)
    return out


@pytest.mark.parametrize("seed, k, block", [(1, 4, 1 << 20), (2, 6, 300), (3, 20, 100), (4, 1, 200), (5, 2, 150)])
def test_substring_dedup_equals_plain(sent, seed, k, block):
    docs = random_docs(seed)
    got = substring_dedup.remove_repeats(sent.createDataFrame(docs, DOCS), min_words=k, block_bytes=block)
    assert rows_of(got, "doc_id", "n_words", "n_removed", "kept") == sorted(plain.substring(docs, k), key=str)


def test_factors_point_to_equal_earlier_words(sent):
    docs = [(d, t) for d, t in random_docs(7) if d is not None and d < 60]
    words = {d: plain.WORD.findall(t or "") for d, t in docs}
    got = substring_dedup.remove_repeats(sent.createDataFrame(docs, DOCS), min_words=5, block_bytes=300).collect()
    assert sum(len(r["factors"]) for r in got) > 10
    for r in got:
        for f in r["factors"]:
            assert (f["source_doc"], f["source_start"]) < (r["doc_id"], f["start"])
            own = words[r["doc_id"]][f["start"] : f["start"] + f["length"]]
            assert own == words[f["source_doc"]][f["source_start"] : f["source_start"] + f["length"]]
            assert f["length"] >= 5


def test_words_and_minima():
    import pyarrow as pa

    texts = ["a bbé c", None, "", " x", "y ", "z-1 2", "\x1cq r"]
    w = Words(*utf8(pa.array(texts)[0:7]))
    flat = [w.data[a:b].tobytes().decode() for a, b in zip(w.starts, w.ends)]
    assert [flat[a:b] for a, b in zip(w.first, w.first[1:])] == [plain.WORD.findall(t or "") for t in texts]
    w = Words(*utf8(pa.array(texts).slice(2)), LETTERS)
    assert [int(n) for n in w.counts] == [len(plain.LETTERS.findall(t or "")) for t in texts[2:]]
    x = np.array([3, 1, 2, 1, 5, 0, 0], np.uint64)
    for width in range(1, 8):
        assert sliding_argmin(x, width).tolist() == [i + int(np.argmin(x[i : i + width])) for i in range(8 - width)]


def simhash_docs(seed):
    r = random.Random(seed)
    base = [f"w{r.randrange(400)}" for _ in range(200)]
    docs = []
    for i in range(80):
        w = list(base) if i % 2 else [f"w{r.randrange(400)}" for _ in range(r.randrange(0, 60))]
        for _ in range(r.randrange(3)):
            if w:
                w[r.randrange(len(w))] = f"W{r.randrange(400)}"
        docs.append((i, " ".join(w)))
    return docs + [(80, None), (81, ""), (82, "one two"), (83, "ONE  two"), (None, docs[7][1]), (7, docs[7][1])]


@pytest.mark.parametrize("seed, node_rows", [(1, 50_000), (2, 6)])
def test_simhash_equals_plain(sent, seed, node_rows):
    docs = simhash_docs(seed)
    prints = [plain.fingerprint(t) for _, t in docs]
    label = plain.groups(len(docs), lambda i, j: (prints[i] ^ prints[j]).bit_count() <= 4)
    least = {}
    for (d, _), g in zip(docs, label):
        least[g] = min(least.get(g, plain.LAST), plain.LAST if d is None else d)
    want = [(d, p - (1 << 64) if p >> 63 else p, least[g]) for (d, _), p, g in zip(docs, prints, label)]
    got = simhash.near_duplicates(sent.createDataFrame(docs, DOCS), node_rows=node_rows)
    assert rows_of(got, "doc_id", "fp", "component_id") == sorted(want, key=str)
    assert len(set(label)) < len(docs) - 10


def test_simhash_keeps_one_of_each_group(sent):
    docs = [(d, t, f"x{i}") for i, (d, t) in enumerate(simhash_docs(3))]
    frame = sent.createDataFrame(docs, "doc_id long, text string, th string")
    kept = simhash.keep_one(frame).collect()
    prints = [plain.fingerprint(t) for _, t, _ in docs]
    label = plain.groups(len(docs), lambda i, j: (prints[i] ^ prints[j]).bit_count() <= 4)
    assert len(kept) == len(set(label))
    by_text = {t: g for (_, t, _), g in zip(docs, label)}
    assert len({by_text[r["text"]] for r in kept}) == len(kept)
    assert frame.columns == simhash.keep_one(frame).columns


@pytest.mark.parametrize("seed", range(4))
def test_tree_links_like_all_pairs(seed):
    r = np.random.default_rng(seed)
    center = r.integers(0, 1 << 63, 4, dtype=np.uint64)
    fp = center[r.integers(0, 4, 700)]
    for _ in range(seed * 3 + 2):
        fp = fp ^ (np.uint64(1) << r.integers(0, 64, 700).astype(np.uint64))
    fp = np.unique(np.concatenate([fp, r.integers(0, 1 << 63, 100, dtype=np.uint64)]))
    fp = fp[np.argsort(simhash.gray_rank(fp))]
    got = simhash.Tree(fp).links(4)
    near = np.bitwise_count(fp[:, None] ^ fp[None, :]) <= 4
    a, b = np.nonzero(near)
    assert np.array_equal(got, graph.local_components(a, b, len(fp)))


def test_any_two_near_fingerprints_share_a_mask():
    r = random.Random(5)
    for _ in range(500):
        flips = sum(1 << b for b in r.sample(range(64), 4))
        assert any(not flips & m for m in simhash.masks(4))


def test_gray_ranks_of_neighbours_differ_in_one_bit():
    code = np.arange(256, dtype=np.uint64) ^ (np.arange(256, dtype=np.uint64) >> np.uint64(1))
    assert simhash.gray_rank(code).tolist() == list(range(256))


def test_components_of_chains_and_stars(sent):
    edges = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 150)] + [(-5, 140), (7, 7)]
    got = dict((r["node"], r["root"]) for r in graph.components(sent.createDataFrame(edges, "a long, b long")).collect())
    assert {got[i] for i in range(41)} == {0}
    assert {got[i] for i in range(100, 150)} | {got[-5]} == {-5}
    assert graph.components(sent.createDataFrame([], "a long, b long")).count() == 0


def bench_docs(seed):
    r = random.Random(seed)
    words = [f"w{i}" for i in range(12)] + ["The", "THE", "été"]
    items = [(i, " ".join(r.choice(words) for _ in range(r.choice([0, 2, 3, 8, 14])))) for i in range(12)] + [(3, "the the the"), (None, "w1 w2 w3 w4"), (99, None)]
    docs = []
    for i in range(50):
        w = " ".join(r.choice(words) for _ in range(r.choice([0, 1, 10, 40])))
        docs.append((i, f"{w}-{r.choice(items)[1] or ''}" if r.random() < 0.3 else w))
    return docs + [(60, None), (60, ""), (None, "w1, w2; w3. w4"), (5, docs[5][1])], items


@pytest.mark.parametrize("seed, block, pass_words", [(1, 1 << 20, 10_000), (2, 200, 10_000), (3, 300, 10)])
def test_decontamination_equals_plain(sent, seed, block, pass_words):
    docs, items = bench_docs(seed)
    got = decontaminate.find_contamination(
        sent.createDataFrame(docs, DOCS), sent.createDataFrame(items, "item_id long, text string"), window=4, block_bytes=block, pass_words=pass_words
    )
    got = [(r["doc_id"], r["n_words"], r["n_hit"], len(r["items"]), r["items_sha256"]) for r in got.collect()]
    want = plain.contamination(docs, items, 4)
    assert sorted(got, key=str) == sorted(want, key=str)
    assert any(w[2] for w in want)


def test_proximity_matches(sent):
    docs = [(1, "alpha x x beta y gamma"), (2, "alpha " + "z " * 30 + "beta gamma"), (3, "gamma beta alpha"), (4, "alpha beta")]
    items = sent.createDataFrame([(7, "alpha beta gamma")], "item_id long, text string")
    found = decontaminate.find_contamination(sent.createDataFrame(docs, DOCS), items, window=3, within=6)
    assert {r["doc_id"]: r["items"] for r in found.collect()} == {1: ["7"], 2: [], 3: ["7"], 4: []}
    exact = decontaminate.find_contamination(sent.createDataFrame(docs, DOCS), items, window=3)
    assert not any(r["items"] for r in exact.collect())


def test_contaminated_documents_go(sent):
    docs = sent.createDataFrame([(1, "a b c", 5), (1, "x y z", 6), (None, "a b c", 7), (2, None, 8)], "doc_id long, text string, id int")
    items = sent.createDataFrame([(1, "A, b!")], "item_id long, text string")
    left = decontaminate.drop_contaminated(docs, items)
    assert left.columns == docs.columns
    assert sorted(r["id"] for r in left.collect()) == [6, 8]


LINE = "the {} line of the {} text goes on for quite a while"


def test_line_blocks_go_from_later_documents(sent):
    block = [LINE.format(i, "shared") for i in range(5)]
    own = lambda d: [LINE.format(i, f"own{d}") for i in range(3)]
    docs = [
        (1, "\n".join(own(1) + block + own("1b"))),
        (2, "\n".join(own(2) + block[:2] + ["", "  "] + block[2:])),
        (3, "\n".join([block[4]] + own(3) + ["The."])),
        (4, "\n".join(own(1) + block + own("1b"))),
        (5, "The.\nThe."),
        (6, None),
        (7, ""),
        (None, block[0]),
        (2, block[3]),
    ]
    frame = sent.createDataFrame([(d, t, 1) for d, t in docs], "doc_id long, text string, rest int")
    got = {(r["row"]["doc_id"], i): r for i, r in enumerate(line_dedup.dedup_lines(frame).collect())}
    texts = sorted(((r["row"]["doc_id"], r["row"]["text"], r["n_removed"]) for r in got.values()), key=str)
    want = [
        (1, docs[0][1], 0),
        (2, "\n".join(own(2) + ["", "  "]), 5),
        (3, "\n".join(own(3) + ["The."]), 1),
        (4, "", 11),
        (5, "The.\nThe.", 0),
        (6, None, 0),
        (7, "", 0),
        (None, "", 1),
        (2, "", 1),
    ]
    assert texts == sorted(want, key=str)


def test_patience_aligns_unique_lines_in_order():
    a = dict(enumerate([1, 2, 9, 3, 4, 9, 5]))
    b = dict(enumerate([7, 1, 2, 9, 4, 3, 9, 5]))
    pairs = line_dedup.patience(a, b)
    assert all(a[i] == b[j] for i, j in pairs)
    assert all(x < y and u < v for (x, u), (y, v) in zip(pairs, pairs[1:]))
    assert (0, 1) in pairs and (6, 7) in pairs and (2, 3) in pairs
    assert line_dedup.increasing([3, 1, 2, 5, 4]) in ([1, 2, 3], [1, 2, 4])
    r = random.Random(3)
    for _ in range(200):
        a = {i: r.randrange(9) for i in r.sample(range(12), 8)}
        b = {i: r.randrange(9) for i in r.sample(range(12), 8)}
        pairs = line_dedup.patience(a, b)
        assert all(a[i] == b[j] for i, j in pairs)
        assert all(x < y and u < v for (x, u), (y, v) in zip(pairs, pairs[1:]))


def test_first_copy_of_every_long_line_stays(sent):
    r = random.Random(11)
    lines = [LINE.format(i, "t") for i in range(30)] + ["so.", "on."]
    docs = [(i, "\n".join(r.choice(lines) for _ in range(r.randrange(12)))) for i in range(80)]
    got = line_dedup.dedup_lines(sent.createDataFrame(docs, DOCS)).collect()
    after = {r["row"]["doc_id"]: (r["row"]["text"] or "").split("\n") for r in got}
    for line in lines:
        home = min((d for d, t in docs if line in t.split("\n")), default=None)
        if home is not None:
            assert line in after[home]


@pytest.mark.parametrize("dtype", [np.uint32, np.int64, np.uint64])
def test_squeezed_numbers_come_back(dtype):
    from lapframe.llm.blocks import squeezed, unsqueezed

    r = np.random.default_rng(2)
    info = np.iinfo(dtype)
    for values in ([], [0], [info.max, info.min, 5], np.sort(r.integers(0, 1 << 30, 1000)), r.integers(info.min, info.max, 50, dtype=dtype)):
        values = np.array(values, dtype)
        assert np.array_equal(unsqueezed(squeezed(values), dtype), values)


def removed_lines(sent, docs, **settings):
    got = line_dedup.dedup_lines(sent.createDataFrame(docs, DOCS), **settings).collect()
    return {r["row"]["doc_id"]: ([x for x in r["row"]["text"].split("\n") if x.strip()], r["n_removed"]) for r in got}


def kept_by_plain(docs, **settings):
    gone = plain.common_lines(docs, **settings)
    lines = {d: [x for x in t.split("\n") if x.strip()] for d, t in docs}
    return {d: ([x for i, x in enumerate(own) if i not in gone[d]], len(gone[d])) for d, own in lines.items()}


def test_repeated_and_reordered_passages_go(sent):
    one, two = [[LINE.format(i, name) for i in range(2)] for name in "ab"]
    docs = [
        (1, "\n".join(one + two + one)),  # the first holder has it twice
        (2, "\n".join(["x", *two, "y", *one, "z"])),  # in another order
        (3, "\n".join(["u", *one, "v", *one, "w", *one])),  # a later copy has it three times
    ]
    got = removed_lines(sent, docs)
    assert got == kept_by_plain(docs)
    assert got[2] == (["x", "y", "z"], 4) and got[3] == (["u", "v", "w"], 6)


def test_common_lines_as_brute_force_finds_them(sent):
    r = random.Random(5)
    lines = ["a", "b c", "d e f", "g h i j k", "l m n o p q r s", "t u v w x y z 1 2"]
    docs = [(i, "\n".join(r.choice([*lines, ""]) for _ in range(r.randrange(14)))) for i in range(60)]
    docs += [(100 + i, "\n".join(r.choice(lines[:3]) + str(r.randrange(3)) for _ in range(r.randrange(20)))) for i in range(30)]
    assert removed_lines(sent, docs) == kept_by_plain(docs)


def test_blocks_of_short_lines_first_seen_elsewhere_go(sent):
    verse = ["so long", "and thanks", "for all", "the fish", "we said"]
    docs = [(i, f"{line}\nown {i}") for i, line in enumerate(verse)]  # each line has another home
    docs += [(10, "\n".join(["begin", *verse, "end"])), (11, "\n".join(["top", *verse, "bottom"]))]
    docs += [(20, "f(x)\n{\n  a;\n  b;\n  c;\n  d;\n}\nreturn;"), (21, "g(x)\n{\n  a;\n  b;\n  c;\n  d;\n}\nreturn;\nf(x)\n{")]
    got = removed_lines(sent, docs)
    assert got == kept_by_plain(docs)
    assert got[10][1] == 0 and got[11] == (["top", "bottom"], 5)


def test_scripts_without_spaces_are_measured_in_characters(sent):
    long = ["昨夜河水上涨到早晨低处的道路已经封闭", "夜のうちに川が増水して朝には道が閉ざされていた", "แม่น้ำเอ่อล้นในตอนกลางคืนและถนนสายล่างก็ปิดแล้ว"]
    short = "河水上涨"
    docs = [(1, "\n".join([*long, "甲", short])), (2, "乙\n" + long[0]), (3, f"{long[1]}\n丙"), (4, f"丁\n{long[2]}\n戊"), (5, f"{short}\n己")]
    got = removed_lines(sent, docs)
    assert got == {1: ([*long, "甲", short], 0), 2: (["乙"], 1), 3: (["丙"], 1), 4: (["丁", "戊"], 1), 5: ([short, "己"], 0)}
    assert [line_dedup.n_words(x.encode()) for x in ("two words", "zwei Wörter", "河水 rose", "한국어 문장")] == [2, 2, 2, 2]


def test_lines_repeated_very_often_in_two_documents(sent):
    n = 20_000
    log = "\n".join(["it went on so"] * n)
    sources = [(100 + i, "\n".join(LINE.format(j, f"s{i}") for j in range(3))) for i in range(300)]
    docs = [(1, "first log\n" + log), (2, log + "\nlast log"), *sources, (900, "\n".join(t for _, t in sources) + "\nthe end")]
    got = removed_lines(sent, docs)
    assert got[1][1] == 0 and got[2] == (["last log"], n)
    assert got[900] == (["the end"], 900)


def block_cases():
    r = random.Random(8)
    for _ in range(300):
        home = {(i, 1): r.randrange(7) for i in range(r.randrange(1, 25))}
        have = sorted(set(home.values()))
        yield {(i, 1): r.choice(have) for i in r.sample(range(30), r.randrange(1, 25))}, home


def test_blocks_hold_every_run_at_its_place_and_at_home():
    for later, home in block_cases():
        blocks = line_dedup.common_blocks(later, home)
        covered = {i for start, n, _ in blocks for i in range(start, start + n)}
        assert covered == {i for i, _ in later}
        for start, n, there in blocks:
            assert all(later[start + k, 1] == home[there + k, 1] for k in range(n))


def test_alignment_prefers_order_and_finds_moved_blocks():
    def side(text):
        return {(i, 1): x for i, x in enumerate(text)}

    assert line_dedup.common_blocks(side("abcdef"), side("xabcdefy")) == [(0, 6, 1)]
    assert line_dedup.common_blocks(side("defabc"), side("abcdef")) == [(0, 3, 3), (3, 3, 0)]
    assert line_dedup.common_blocks(side("abab"), side("ab")) == [(0, 2, 0), (2, 2, 0)]
    # A repeated run goes with the neighbours that it stands next to, not with its first place.
    assert line_dedup.common_blocks(side("pzq"), side("zzpzq")) == [(0, 3, 2)]


def test_blocks_name_the_source(sent):
    one = [LINE.format(i, "src") for i in range(4)]
    docs = [(1, "\n".join(["top", *one])), (2, "\n".join(["", *one[2:], "mid", *one[:2]])), (None, one[0]), (3, one[0])]
    got = {r["row"]["doc_id"]: [tuple(b) for b in r["blocks"]] for r in line_dedup.dedup_lines(sent.createDataFrame(docs, DOCS)).collect()}
    assert got == {1: [], 2: [(0, 2, 1, 3), (3, 2, 1, 1)], 3: [(0, 1, 1, 1)], None: [(0, 1, 1, 1)]}


def test_patience_is_fast_where_runs_repeat():
    n = 20_000
    later, home = {(i, 1): i % 2 for i in range(n)}, {(i, 1): i % 3 % 2 for i in range(n)}
    assert sum(n for _, n, _ in line_dedup.common_blocks(later, home)) >= n
    assert line_dedup.common_blocks({(i, 1): 0 for i in range(n)}, {(0, 1): 0})[-1] == (n - 1, 1, 0)


@pytest.mark.parametrize("seed, k, block", [(6, 4, 300), (7, 3, 100), (8, 1, 200), (9, 20, 1 << 20)])
def test_factors_are_a_parse(sent, seed, k, block):
    docs = [d for d in random_docs(seed) if d[0] is not None and d[0] < 64]
    first = {}
    for d, t in sorted(docs, key=lambda x: x[0]):
        w = plain.WORD.findall(t or "")
        for s in range(len(w) - k + 1):
            first.setdefault(tuple(w[s : s + k]), (d, s))
    got = substring_dedup.remove_repeats(sent.createDataFrame(docs, DOCS), min_words=k, block_bytes=block).collect()
    texts = {d: plain.WORD.findall(t or "") for d, t in docs}
    for row in got:
        w, want, end = texts[row["doc_id"]], [], 0
        for s in range(len(w) - k + 1):
            source = first[tuple(w[s : s + k])]
            if s < end or source == (row["doc_id"], s):
                continue
            end = s + k
            while end < len(w) and first[tuple(w[end - k + 1 : end + 1])] == (source[0], source[1] + end - s - k + 1):
                end += 1
            want.append((s, end - s, *source))
        assert [tuple(f) for f in row["factors"]] == want


def test_factors_of_a_longer_later_source_do_not_overlap(sent):
    w = [f"w{i}" for i in range(60)]
    docs = [(1, " ".join(w[:25])), (2, " ".join(w)), (3, " ".join(w))]
    got = {r["doc_id"]: r for r in substring_dedup.remove_repeats(sent.createDataFrame(docs, DOCS)).collect()}
    assert [tuple(f) for f in got[3]["factors"]] == [(0, 25, 1, 0), (25, 35, 2, 25)] and got[3]["n_removed"] == 60
    assert [tuple(f) for f in got[2]["factors"]] == [(0, 25, 1, 0)] and got[2]["kept"] == " ".join(w[25:])
