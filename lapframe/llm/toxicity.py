"""Toxicity scores from a learned lexicon, matched with Levenshtein automata, in context.

Training, on at most ``train_rows`` labelled rows (a documented bound; the rows with the least hash
of their id): words, and beginnings of words, that toxic documents have and clean ones lack
become the lexicon, if chance would hardly bring that about (a binomial test, so rare words
stay however many labels there are), and a logistic regression weighs what was matched.

Matching: the lexicon is a trie. A Levenshtein automaton walks it together with the word: a state
is the set of trie nodes still within reach and their least edits, and states are made on demand
and kept, so a word costs one look-up a letter and most words die after a few. Terms allow no
edits below five letters, one from five and two from nine on; terms that are beginnings of words
match any ending, with the edits of their own length. Words that a beginning covers are terms too.

Context: a match within a few words of quotation marks or a verb of saying counts as quoted, one
near a word of address counts as aimed at somebody; both have their own weights.

Words are what stands between white space, of any length; scripts without spaces are read in overlapping pieces of two to
four characters. Null and empty texts have no matches and score as such; an empty table gives an empty one; a very long text is read as
a whole, in one row. Equal rows get equal scores. Labels that
occur twice for an id count twice; null labels and ids are not learned from. With labels of one
kind only, or none, every score is that kind's share (0 without labels). Extra columns are kept out.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lapframe.llm.blocks import released
from lapframe.llm.line_dedup import SPACELESS

TRAIN_ROWS = 20_000
FOLDS = 5
#: A term has at least so many toxic documents, and by chance so rarely as many.
LEAST, CHANCE = 4, 1e-3
CONTEXT_WORDS = 5
BEGINNINGS = (4, 5, 6, 7, 8)
CACHE_WORDS = 100_000

#: Marks and verbs of quotation, words of address.
QUOTES = "\"“”„«»‘’`"
SAYING = frozenset("said says say called calls wrote quote quoted quotes word words dijo dice dicho escribió sagte sagt schrieb zitat dit écrit".split())
ADDRESS = frozenset("you your yours yourself youre u tú tu usted vosotros eres du dich dir ihr euch sie vous toi ton es".split())

#: Runs of scripts that write no spaces are read in overlapping pieces of so many characters.
PIECES = (2, 3, 4)
#: Longer chunks are matched anew each time, so that the cache stays small.
CACHE_LETTERS = 64

_CHUNK = regex.compile(r"\S+")
_SPACELESS = re.compile("(?:" + "|".join(script.pattern for script, _ in SPACELESS) + ")+")
_EDGE = regex.compile(r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$")


def held_out(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string")) % FOLDS == 0


def core(chunk: str) -> str:
    """A chunk's word: lower case, without marks around it."""
    return _EDGE.sub("", chunk.lower())


def pieces(run: str) -> list[str]:
    """The overlapping pieces of a run of characters without spaces, by place; a single character is one."""
    return [run[i : i + n] for i in range(len(run) - 1) for n in PIECES if i + n <= len(run)] or [run]


def chunks_of(text: str) -> list[str]:
    """What stands between white space, and the pieces of runs in scripts without spaces."""
    chunks = _CHUNK.findall(text)
    if text.isascii() or not _SPACELESS.search(text):
        return chunks
    out = []
    for chunk in chunks:
        at = 0
        for run in _SPACELESS.finditer(chunk):
            out += [chunk[at : run.start()]] * (run.start() > at) + pieces(run[0])
            at = run.end()
        out += [chunk[at:]] * (at < len(chunk))
    return out


def terms_of(text: str | None) -> set[str]:
    """Words, and beginnings of longer words marked with a star."""
    out = {core(c) for c in set(chunks_of(text or ""))} - {""}
    return out | {w[:n] + "*" for w in out for n in BEGINNINGS if len(w) > n}


def _counted(wanted):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: Counter[str] = Counter()
        keep = wanted.value if wanted else None
        for batch in batches:
            for text in batch["text"]:
                terms = terms_of(text.as_py())
                found.update(terms & keep if keep is not None else terms)
        yield pa.RecordBatch.from_pydict({"term": pa.array(found.keys(), pa.string()), "n": pa.array(found.values(), pa.int64())})

    return run


def by_chance(toxic: int, clean: int, share: float) -> float:
    """How probable at least ``toxic`` of all a term's documents are if each is toxic with probability ``share``."""
    n = toxic + clean
    each = math.lgamma(n + 1) - math.lgamma(toxic + 1) - math.lgamma(clean + 1) + toxic * math.log(share) + clean * math.log1p(-share)
    part, total = math.exp(each), 0.0
    for k in range(toxic, n + 1):
        total += part
        part *= (n - k) / (k + 1) * share / (1 - share)
    return min(total, 1.0)


def choose_lexicon(toxic: dict[str, int], clean: dict[str, int], n_toxic: int, n_clean: int, strength: float = 3.0) -> list[str]:
    """Terms whose odds of toxicity are high, and not by chance; a beginning stands for the longer beginnings it covers."""

    def odds(t: str) -> float:
        return math.log((toxic[t] + 0.5) / (n_toxic + 1)) - math.log((clean.get(t, 0) + 0.5) / (n_clean + 1))

    share = n_toxic / (n_toxic + n_clean)
    strong = (t for t in toxic if odds(t) >= strength and by_chance(toxic[t], clean.get(t, 0), share) <= CHANCE)
    strong = sorted(strong, key=lambda t: (len(t.rstrip("*")), "*" not in t, t))
    chosen: dict[str, int] = {}
    for t in strong:
        stem = t.rstrip("*")
        covers = max((chosen[stem[:k] + "*"] for k in range(1, len(stem) + 1) if stem[:k] + "*" in chosen), default=0)
        if not covers:
            chosen[t] = toxic[t]
    # A beginning that one word makes up is that word.
    for t in [t for t in chosen if t.endswith("*")]:
        same = [w for w in toxic if not w.endswith("*") and w.startswith(t[:-1]) and toxic[w] >= 0.9 * toxic[t]]
        if same:
            del chosen[t]
            chosen[max(same, key=lambda w: (toxic[w], w))] = toxic[t]
    # Misspellings are near to words, so the words that a beginning covers stay.
    chosen |= {t: toxic[t] for t in strong if not t.endswith("*")}
    return sorted(chosen, key=lambda t: (-chosen[t], t))


@dataclass
class Automaton:
    """The lexicon's trie walked by Levenshtein automata of its terms.

    A state maps trie nodes to the least edits that reach them. ``step`` takes a letter: it may stand
    for a trie letter (no edit, or one if it differs), be inserted (one edit), and trie letters
    may be skipped (one edit each). With ``near_beginnings``, beginnings too may be some edits away.
    """

    terms: list[str]
    near_beginnings: bool = False
    children: list[dict[str, int]] = field(default_factory=lambda: [{}])
    limit: list[int] = field(default_factory=lambda: [0])
    ends: dict[int, tuple[int, bool]] = field(default_factory=dict)

    def __post_init__(self):
        for number, term in enumerate(self.terms):
            stem, open_end = term.rstrip("*"), term.endswith("*")
            edits = self._edits(term)
            node = 0
            self.limit[0] = max(self.limit[0], edits)
            for letter in stem:
                if letter not in self.children[node]:
                    self.children[node][letter] = len(self.children)
                    self.children.append({})
                    self.limit.append(0)
                node = self.children[node][letter]
                self.limit[node] = max(self.limit[node], edits)
            self.ends[node] = (number, open_end)
        self.edits = [self._edits(t) for t in self.terms]
        self.states: list[dict[int, int]] = []
        self.names: dict[tuple, int] = {}
        self.moves: list[dict[str, int]] = []
        self.results: list[tuple[int, int] | None] = []  # what a word that ends here matches
        self.final: list[tuple[int, int] | None] = []  # what any word that gets here matches
        self.start = self._name(self._closed({0: 0}))

    def _edits(self, term: str) -> int:
        size = len(term.rstrip("*"))
        return 0 if size < 5 or term.endswith("*") and not self.near_beginnings else 1 if size < 9 else 2

    def _closed(self, state: dict[int, int]) -> dict[int, int]:
        """Add nodes reached by skipping trie letters."""
        work = list(state)
        while work:
            node = work.pop()
            for child in self.children[node].values():
                cost = state[node] + 1
                if cost <= self.limit[child] and cost < state.get(child, 99):
                    state[child] = cost
                    work.append(child)
        return state

    def _name(self, state: dict[int, int]) -> int:
        key = tuple(sorted(state.items()))
        if key not in self.names:
            self.names[key] = len(self.states)
            self.states.append(state)
            self.moves.append({})
            found = [(cost, *self.ends[node]) for node, cost in state.items() if node in self.ends and cost <= self.edits[self.ends[node][0]]]
            self.results.append(min(((n, c) for c, n, _ in found), key=lambda x: (x[1], x[0]), default=None))
            self.final.append(min(((n, c) for c, n, o in found if o), key=lambda x: (x[1], x[0]), default=None))
        return self.names[key]

    def step(self, state: int, letter: str) -> int:
        """The next state, or -1 when nothing is in reach."""
        to = self.moves[state].get(letter)
        if to is None:
            after: dict[int, int] = {}
            for node, cost in self.states[state].items():
                if cost < self.limit[node]:
                    after[node] = min(after.get(node, 99), cost + 1)
                for own, child in self.children[node].items():
                    new = cost + (own != letter)
                    if new <= self.limit[child]:
                        after[child] = min(after.get(child, 99), new)
            to = self._name(self._closed(after)) if after else -1
            self.moves[state][letter] = to
        return to

    def match(self, word: str) -> tuple[int, int] | None:
        """The number of the nearest term within its edits, and the edits."""
        state, best = self.start, None
        moves, final = self.moves, self.final
        for letter in word:
            to = moves[state].get(letter)
            state = to if to is not None else self.step(state, letter)
            if state < 0:
                return best
            if final[state] and (best is None or final[state][1] < best[1]):
                best = final[state]
        end = self.results[state]
        return end if end and (best is None or end[1] < best[1]) else best


FEATURES = 8


def features(text: str | None, automaton: Automaton, cache: dict) -> np.ndarray:
    """What was matched: exact and near, plain, quoted and aimed; distinct terms; density."""
    out = np.zeros(FEATURES)
    if not text or not automaton.terms:
        return out
    chunks = chunks_of(text)
    hits = []
    for i, chunk in enumerate(chunks):
        found = cache.get(chunk, 0)
        if found == 0:
            found = automaton.match(core(chunk))
            if len(chunk) <= CACHE_LETTERS:
                if len(cache) > CACHE_WORDS:
                    cache.clear()
                cache[chunk] = found
        if found:
            hits.append((i, *found))
    if not hits:
        return out
    distinct = set()
    for i, term, edits in hits:
        around = chunks[max(0, i - CONTEXT_WORDS) : i + CONTEXT_WORDS + 1]
        marks = sum(any(q in c for q in QUOTES) for c in around)
        quoted = marks >= 2 or any(core(c) in SAYING for c in around)
        aimed = any(core(c) in ADDRESS for c in around)
        out[0 if edits == 0 else 1] += not quoted
        out[2] += quoted
        out[3] += aimed and not quoted
        if edits == 0:
            distinct.add(term)
    n = len(hits)
    out[:4] = np.log1p(out[:4])
    out[4] = math.log1p(len(distinct))
    out[5] = math.log1p(100 * n / len(chunks))
    out[6] = len(distinct) >= 2
    out[7] = any(e == 0 for _, _, e in hits)
    return out


@dataclass
class Model:
    lexicon: list[str]
    weights: np.ndarray  # the last is the constant


def _featured(lexicon: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton, cache = Automaton(lexicon, near_beginnings=True), {}
        for batch in batches:
            rows = [features(t.as_py(), automaton, cache) for t in batch["text"]]
            yield pa.RecordBatch.from_pydict({"toxic": batch["toxic"], "x": pa.array([r.tolist() for r in rows], pa.list_(pa.float64()))})

    return run


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 0.1, rounds: int = 60) -> np.ndarray:
    """Weights of a ridge logistic regression by Newton steps, the constant last and free."""
    x = np.hstack([x, np.ones((len(x), 1))])
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-6
    w = np.zeros(x.shape[1])
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - y) + penalty * w
        step = np.linalg.solve((x * (p * (1 - p) + 1e-9)[:, None]).T @ x + np.diag(penalty), gradient)
        w = w - step * min(1.0, 5 / (np.abs(step).max() + 1e-12))
        if np.abs(step).max() < 1e-8:
            break
    return w


def train(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    train_rows: int = TRAIN_ROWS,
) -> Model:
    """Learn from labelled rows that are not held out, at most ``train_rows`` of them."""
    known = labels.select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("int").alias("toxic")).dropna()
    known = known.filter(~held_out(F.col("id"))).orderBy(F.xxhash64("id"), "toxic").limit(train_rows)
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").alias("text"))
    # The sent side has at most train_rows rows.
    rows = texts.join(F.broadcast(known), "id").select("toxic", "text")
    rows = rows.persist()
    try:
        n = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
        n_toxic, n_clean = n.get(1, 0), n.get(0, 0)
        if not n_toxic or not n_clean:
            share = n_toxic / max(1, n_toxic + n_clean)
            return Model([], np.array([0.0] * FEATURES + [math.log((share + 1e-9) / (1 - share + 1e-9))]))
        schema = "term string, n long"
        own = rows.filter("toxic = 1").select("text").mapInArrow(_counted(None), schema).groupBy("term").agg(F.sum("n").alias("n"))
        # As many as at most train_rows documents have several times.
        toxic = {r["term"]: r["n"] for r in own.filter(F.col("n") >= LEAST).collect()}
        sent = docs.sparkSession.sparkContext.broadcast(frozenset(toxic))
        other = rows.filter("toxic = 0").select("text").mapInArrow(_counted(sent), schema).groupBy("term").agg(F.sum("n").alias("n"))
        clean = {r["term"]: r["n"] for r in other.collect()}
        lexicon = choose_lexicon(toxic, clean, n_toxic, n_clean)
        table = rows.select("toxic", "text").mapInArrow(_featured(lexicon), "toxic int, x array<double>").toArrow()
    finally:
        rows.unpersist()
    x = np.array(table["x"].to_pylist()).reshape(-1, FEATURES)
    order = np.lexsort(x.T)
    return Model(lexicon, logistic(x[order], np.asarray(table["toxic"]).astype(float)[order]))


def score(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """All columns in a struct ``row``, with ``score`` and ``predicted``. One pass, no shuffle."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        automaton, cache = Automaton(model.lexicon, near_beginnings=True), {}

        def one(batch: pa.RecordBatch) -> pa.RecordBatch:
            x = np.array([features(t.as_py(), automaton, cache) for t in batch["text"]]).reshape(-1, FEATURES)
            p = 1 / (1 + np.exp(-np.clip(x @ model.weights[:-1] + model.weights[-1], -30, 30)))
            return pa.RecordBatch.from_pydict({"row": batch["row"], "score": pa.array(p), "predicted": pa.array((p >= 0.5).astype(np.int32))})

        yield from released(batches, one)

    both = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"), F.col(f"`{text_col}`").cast("string").alias("text"))
    scored = T.StructType.fromDDL("score double, predicted int")
    return both.mapInArrow(run, T.StructType([both.schema["row"], *scored]))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    model = train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    # A row without an id was never learned from, and has no remainder that is 0.
    keyed = docs.select("doc_id", "text", F.coalesce(held_out(F.col("doc_id")), F.lit(False)).alias("held_out"))
    return score(keyed, model).select("row.doc_id", "row.held_out", "score", "predicted")
