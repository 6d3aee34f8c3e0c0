"""Histogram gradient boosting of squared errors with best-first growth, and forests of the same trees.

Values are put into quantile bins once, and the binned rows are written as blocks. A tree starts as one leaf; the leaf
whose best split gains most is split next, until there are ``max_leaves`` leaves or nothing gains. Depth has no limit
unless one is set. Splits are found in histograms: residuals and rows per bin, for each open leaf, added up over blocks
by partial aggregates. Of two siblings only the smaller is counted; the other is the parent's histogram less it.

Each pass over the blocks splits every open leaf that may still be reached, so a tree needs about as many passes as it is deep
rather than as it has leaves. The order of splits is then replayed from the exact gains, so the tree is the one
that splitting leaf by leaf gives. Where one block holds all rows, its histograms are the whole ones, and its task
grows the trees by the same code without further jobs.

Residuals are counted in fixed steps (a power of two that keeps every sum exact), so trees do not depend on
how rows are partitioned. Ties go to the earlier leaf, the earlier column and the lower value.

A forest has the same trees, each grown on a bootstrap of the rows and of the target itself; they share no state, so
where one block holds all rows, tasks grow them side by side.

Text columns come as codes. Each level is a split of its own against the rest, as one-hot columns would give, but without
a column for each. The best level of a leaf is found by Spark, so levels may be many.
"""

from __future__ import annotations

import base64
import heapq
import json
import math
import zlib
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field, replace

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import DoubleType

from lapframe.session import discard, materialize
from lapframe.workers import send_package

#: The last bin of a column is for missing values.
WIDTH, MISSING = 256, 255
#: Binned values of one block.
BLOCK_VALUES = 1 << 22
#: Trees after which the residuals of the blocks are written anew.
WRITE_EVERY = 10
#: A gain below this is rounding.
LEAST_GAIN = 1e-9
#: The target's own steps, by which its mean is exact.
MEAN_STEPS = 1 << 20


@dataclass(frozen=True)
class Settings:
    max_iter: int = 400
    learning_rate: float = 0.08
    min_samples_leaf: int = 20
    max_leaf_nodes: int | None = 31
    max_depth: int | None = None
    l2_regularization: float = 0.0
    max_bins: int = 255
    feature_fraction: float = 1.0
    bagging_fraction: float = 1.0
    #: A new bag of rows is drawn after so many trees.
    bagging_freq: int = 1
    seed: int = 42
    #: Trees of the target, each on a bootstrap of the rows, averaged; not of what the trees before leave.
    forest: bool = False

    def __post_init__(self):
        for name in ("feature_fraction", "bagging_fraction"):
            if not 0 < getattr(self, name) <= 1:
                raise ValueError(f"{name} is {getattr(self, name)}; it must be above 0 and at most 1")
        if not 2 <= self.max_bins <= MISSING:
            raise ValueError(f"max_bins is {self.max_bins}; it must be from 2 to {MISSING}")


@dataclass
class Split:
    """A leaf's best split: up to and with ``bin`` of a column, or ``level`` of a text column, goes left."""

    node: int
    column: int
    bin: int
    text: bool
    missing_left: bool
    gain: float
    left_rows: int
    left_sum: int
    rows: int
    sum: int
    left: int = 0
    right: int = 0


@dataclass
class Tree:
    """Splits in the order of growth, and what each leaf adds. Split i has the children 2i + 1 and 2i + 2."""

    splits: list[Split] = field(default_factory=list)
    values: dict[int, float] = field(default_factory=dict)

    def to_text(self) -> str:
        leaves = sorted(self.values)
        parts = [
            np.array([[s.node, s.column, s.bin, s.text, s.missing_left] for s in self.splits], np.int32).reshape(-1, 5),
            np.array([[s.left_rows, s.left_sum, s.rows, s.sum] for s in self.splits], np.int64).reshape(-1, 4),
            np.array([s.gain for s in self.splits]),
            np.array(leaves, np.int32),
            np.array([self.values[leaf] for leaf in leaves]),
        ]
        return base64.b64encode(zlib.compress(len(self.splits).to_bytes(4, "little") + b"".join(p.T.tobytes() for p in parts))).decode()

    @classmethod
    def from_text(cls, text: str) -> Tree:
        blob = zlib.decompress(base64.b64decode(text))
        n, at = int.from_bytes(blob[:4], "little"), 4

        def take(dtype: type, width: int, size: int) -> list:
            nonlocal at
            out = np.frombuffer(blob, dtype, width * size, at)
            at += out.nbytes
            return out.reshape(width, size).T.tolist()

        small, large, gain = take(np.int32, 5, n), take(np.int64, 4, n), take(np.float64, 1, n)
        leaves, values = take(np.int32, 1, n + 1), take(np.float64, 1, n + 1)
        splits = [
            Split(node, column, bin_, bool(text), bool(missing), g, *sizes, 2 * i + 1, 2 * i + 2)
            for i, ((node, column, bin_, text, missing), sizes, (g,)) in enumerate(zip(small, large, gain))
        ]
        return cls(splits, {leaf: value for (leaf,), (value,) in zip(leaves, values)})


# Bins


def distinct_values(frame: DataFrame, names: Sequence[str], most: int) -> dict[str, np.ndarray]:
    """The sorted values of each column that has at most ``most`` of them; missing is no value.

    A task sends at most ``most + 1`` values of a column.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = {n: np.zeros(0) for n in names}
        for batch in batches:
            for n in names:
                if len(held[n]) <= most:
                    own = np.asarray(batch[n].cast(pa.float64()).drop_null())
                    held[n] = np.union1d(held[n], own[~np.isnan(own)])[: most + 1]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(np.arange(len(names), dtype=np.int32), [len(v) for v in held.values()])), pa.array(np.concatenate([*held.values(), np.zeros(0)]))],
            ["column", "value"],
        )

    found = frame.select(*[F.col(f"`{n}`").cast("double").alias(n) for n in names]).mapInArrow(run, "column int, value double").distinct()
    few = found.groupBy("column").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") <= most).select("column")
    table = found.join(few, "column", "left_semi").toArrow()
    column, value = np.asarray(table["column"]), np.asarray(table["value"])
    sizes = {r["column"] for r in few.collect()}
    empty = set(range(len(names))) - set(np.asarray(found.select("column").distinct().toArrow()["column"]).tolist())
    return {n: np.sort(value[column == i]) for i, n in enumerate(names) if i in sizes or i in empty}


def bin_edges(frame: DataFrame, names: Sequence[str], max_bins: int = MISSING) -> list[np.ndarray]:
    """Between which values each column is cut: between all its values if they are few, else at quantiles."""
    few = distinct_values(frame, names, max_bins)
    many = [n for n in names if n not in few]
    steps = [i / max_bins for i in range(1, max_bins)]
    cuts = {}
    if many:
        asked = [F.percentile_approx(F.nanvl(F.col(f"`{n}`").cast("double"), F.lit(None)), steps, 10_000) for n in many]
        cuts = dict(zip(many, frame.agg(*asked).first()))
    out = []
    for n in names:
        if n in few:
            out.append((few[n][1:] + few[n][:-1]) / 2)
        else:
            out.append(np.unique(np.array(cuts[n], np.float64)))
    return out


def binned(x: np.ndarray, edges: np.ndarray) -> np.ndarray:
    """Bin b holds the values up to and with edge b."""
    return np.where(np.isnan(x), MISSING, np.searchsorted(edges, x, "left")).astype(np.uint8)


# Rows

#: A number that the rows' hashes are mixed with, and the share that is drawn; no share is a bootstrap, none at all is every row.
Bag = tuple[int, float | None] | None


class Rows:
    """The binned rows of one block, their residuals, and which leaf of the growing tree each is in."""

    def __init__(self, bins: np.ndarray, codes: np.ndarray, residual: np.ndarray, key: np.ndarray | None = None):
        self.bins, self.codes, self.residual, self.key = bins, codes, residual, key
        self.slots = (np.arange(len(bins), dtype=np.int32) * WIDTH)[:, None]

    @classmethod
    def read(cls, row: dict[str, pa.Scalar], columns: int, texts: int) -> Rows:
        bins, codes, residual, key = (row[c].as_buffer() for c in ("bins", "codes", "residual", "key"))
        residual = np.frombuffer(residual, np.float64).copy()
        n = len(residual)
        return cls(
            np.frombuffer(bins, np.uint8).reshape(columns, n), np.frombuffer(codes, np.int32).reshape(texts, n), residual, np.frombuffer(key, np.uint64)
        )

    def write(self) -> pa.RecordBatch:
        held = {"bins": self.bins, "codes": self.codes, "residual": self.residual, "key": self.key}
        return pa.RecordBatch.from_pydict({c: [v.tobytes()] for c, v in held.items()}, pa.schema([(c, pa.binary()) for c in held]))

    def start(self, steps: float, bag: Bag = None) -> None:
        """Begin a tree: on all rows, on those that the bag's number and share draw, or on a bootstrap."""
        self.counted = np.rint(self.residual * steps)
        if bag is None:
            self.at = {0: np.arange(len(self.residual))}
        elif bag[1] is None:
            # A bootstrap: each row as often as a Poisson number of mean 1 says.
            drawn = _scattered(self.key ^ np.uint64(bag[0])) / 2.0**64
            self.at = {0: np.repeat(np.arange(len(self.residual)), np.searchsorted(_POISSON, drawn, "right"))}
        else:
            number, share = bag
            drawn = _scattered(self.key ^ np.uint64(number)) < np.uint64(min(int(share * 2.0**64), (1 << 64) - 1))
            self.at = {0: np.flatnonzero(drawn)}

    def totals(self) -> tuple[int, int]:
        rows = self.at[0]
        return len(rows), int(self.counted[rows].sum())

    def split(self, s: Split) -> None:
        rows = self.at.pop(s.node)
        left = goes_left(s, self.codes[s.column, rows] if s.text else self.bins[s.column, rows])
        self.at[s.left], self.at[s.right] = rows[left], rows[~left]

    def histogram(self, node: int) -> tuple[np.ndarray, np.ndarray]:
        """Rows and residual steps of each bin of each column."""
        rows = self.at[node]
        place = (self.bins[:, rows] + self.slots).ravel()
        size = len(self.bins) * WIDTH
        n = np.bincount(place, minlength=size)
        s = np.bincount(place, np.tile(self.counted[rows], len(self.bins)), size)
        return n.astype(np.int64), s.astype(np.int64)

    def levels(self, node: int, column: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Level codes of a text column with their rows and residual steps; no code is negative."""
        rows = self.at[node]
        code, place = np.unique(self.codes[column, rows], return_inverse=True)
        n, s = np.bincount(place, minlength=len(code)), np.bincount(place, self.counted[rows], len(code))
        some = code >= 0
        return code[some], n[some].astype(np.int64), s[some].astype(np.int64)

    def add(self, tree: Tree) -> None:
        """Take a whole tree off the residuals."""
        self.at = {0: np.arange(len(self.residual))}
        for s in tree.splits:
            self.split(s)
        for leaf, value in tree.values.items():
            self.residual[self.at[leaf]] -= value


_POISSON = np.cumsum([math.exp(-1) / math.factorial(k) for k in range(16)])


def _scattered(x: np.ndarray) -> np.ndarray:
    for shift, factor in ((33, 0xFF51AFD7ED558CCD), (33, 0xC4CEB9FE1A85EC53)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(33))


def bag_of(tree: int, settings: Settings) -> Bag:
    """The bag of a tree. Rows are drawn by a hash of their values, so equal rows are drawn together."""
    if settings.forest:
        return int(np.random.default_rng([settings.seed, 1, tree]).integers(1 << 63)), None
    if settings.bagging_fraction == 1:
        return None
    number = np.random.default_rng([settings.seed, 1, tree // max(1, settings.bagging_freq)]).integers(1 << 63)
    return int(number), settings.bagging_fraction


def columns_of(tree: int, n: int, settings: Settings) -> np.ndarray:
    """Which of the columns a tree may use."""
    use = np.ones(n, bool)
    if settings.feature_fraction < 1 and n:
        use[:] = False
        take = max(1, round(settings.feature_fraction * n))
        use[np.random.default_rng([settings.seed, 2, tree]).permutation(n)[:take]] = True
    return use


def goes_left(s: Split, values: np.ndarray) -> np.ndarray:
    if s.text:
        return values == s.bin
    left = values <= s.bin
    return left | (values == MISSING) if s.missing_left else left & (values != MISSING)


# Growth

#: Of a node: its histogram, and for each text column the best level as (gain, code, rows, steps), if any.
Found = tuple[np.ndarray, np.ndarray, list[tuple[float, int, int, int] | None]]
#: Splits that are new, and nodes to count (with their text columns only, if the flag is off).
Count = Callable[[list[Split], list[tuple[int, bool]], dict[int, tuple[int, int]]], dict[int, Found]]


def gains(n: np.ndarray, s: np.ndarray, rows: int, total: int, steps: float, settings: Settings) -> np.ndarray:
    """What it gains to put n rows with s steps to one side and the others to the other; minus infinity if too few."""
    l2, least = settings.l2_regularization, settings.min_samples_leaf
    m, left, all_ = rows - n, s / steps, total / steps
    right = (total - s) / steps
    with np.errstate(divide="ignore", invalid="ignore"):
        gain = left * left / (n + l2) + right * right / (m + l2) - all_ * all_ / (rows + l2)
    return np.where((n >= max(least, 1)) & (m >= max(least, 1)), gain, -np.inf)


def best_level(code: np.ndarray, n: np.ndarray, s: np.ndarray, rows: int, total: int, steps: float, settings: Settings) -> tuple[float, int, int, int] | None:
    if not len(code):
        return None
    gain = gains(n, s, rows, total, steps, settings)
    i = int(np.argmax(gain))
    return float(gain[i]), int(code[i]), int(n[i]), int(s[i])


def best_split(node: int, found: Found, rows: int, total: int, steps: float, settings: Settings, use: np.ndarray | None = None) -> Split | None:
    """The split that gains most, of the columns in use; none if nothing gains."""
    n, s, texts = found
    best = None
    use = np.ones(len(n) // WIDTH + len(texts), bool) if use is None else use
    if len(n):
        n, s = n.reshape(-1, WIDTH), s.reshape(-1, WIDTH)
        left_n, left_s = np.cumsum(n[:, :MISSING], axis=1), np.cumsum(s[:, :MISSING], axis=1)
        gain = np.stack([gains(left_n, left_s, rows, total, steps, settings), np.full(left_n.shape, -np.inf)], axis=2)
        lacking = n[:, MISSING] > 0
        if lacking.any():
            more_n, more_s = left_n[lacking] + n[lacking, MISSING, None], left_s[lacking] + s[lacking, MISSING, None]
            gain[lacking, :, 1] = gains(more_n, more_s, rows, total, steps, settings)
        gain[~use[: len(n)]] = -np.inf
        at = int(np.argmax(gain))
        column, bin_, side = at // (MISSING * 2), at // 2 % MISSING, at % 2
        best = Split(node, column, bin_, False, bool(side), float(gain[column, bin_, side]), 0, 0, rows, total)
        best.left_rows = int(left_n[column, bin_] + side * n[column, MISSING])
        best.left_sum = int(left_s[column, bin_] + side * s[column, MISSING])
    for column, level in enumerate(texts):
        if level is not None and use[len(use) - len(texts) + column] and (best is None or level[0] > best.gain):
            best = Split(node, column, level[1], True, False, level[0], level[2], level[3], rows, total)
    return best if best is not None and best.gain > LEAST_GAIN else None


class Growth:
    """A tree that grows: what is known of its leaves, and their best splits."""

    def __init__(self, count: Count, rows: int, total: int, steps: float, settings: Settings, use: np.ndarray | None):
        self.count, self.rows, self.total, self.steps, self.settings, self.use = count, rows, total, steps, settings, use
        self.most = settings.max_leaf_nodes or rows
        self.found = count([], [(0, True)], {0: (rows, total)})
        self.open = {0: best_split(0, self.found[0], rows, total, steps, settings, use)}
        self.depth, self.fresh = {0: 0}, 1

    def split(self, chosen: list[Split]) -> None:
        """Split leaves, and find the best splits of their children."""
        wanted, sizes, heavy = [], {}, {}
        for s in chosen:
            s.left, s.right = self.fresh, self.fresh + 1
            self.fresh += 2
            small, large = (s.left, s.right) if 2 * s.left_rows <= s.rows else (s.right, s.left)
            heavy[large] = (s.node, small)
            wanted += [(small, True), (large, False)]
            sizes[s.left], sizes[s.right] = (s.left_rows, s.left_sum), (s.rows - s.left_rows, s.sum - s.left_sum)
            self.depth[s.left] = self.depth[s.right] = self.depth[s.node] + 1
        got = self.count(chosen, wanted, sizes)
        for large, (parent, small) in heavy.items():
            n, total, _ = self.found.pop(parent)
            got[large] = n - got[small][0], total - got[small][1], got[large][2]
        for node, own in got.items():
            deep = self.settings.max_depth is not None and self.depth[node] >= self.settings.max_depth
            self.open[node] = None if deep else best_split(node, own, *sizes[node], self.steps, self.settings, self.use)
            if self.open[node]:
                self.found[node] = own


def grow(count: Count, rows: int, total: int, steps: float, settings: Settings, ahead: bool, use: np.ndarray | None = None) -> Tree:
    """One tree. ``ahead`` splits all leaves that may be reached at once, not only the next one."""
    growth = Growth(count, rows, total, steps, settings, use)
    order: list[Split] = []
    if ahead:
        applied: dict[int, Split] = {}
        while True:
            order, waiting = replay(growth.open, applied, growth.most)
            room = growth.most - 1 - len(order)
            able = sorted((s for s in waiting if s.node not in applied), key=lambda s: (-s.gain, s.node))[:room]
            if room <= 0 or not able:
                break
            growth.split(able)
            applied.update((s.node, s) for s in able)
    else:
        heap = [(-growth.open[0].gain, 0, 0)] if growth.open[0] else []
        while heap and len(order) < growth.most - 1:
            s = growth.open[heapq.heappop(heap)[2]]
            growth.split([s])
            order.append(s)
            for rank, child in enumerate((s.left, s.right), 2 * len(order) - 1):
                if growth.open[child]:
                    heapq.heappush(heap, (-growth.open[child].gain, rank, child))
    return finished(order, rows, total, steps, settings)


def replay(open_: dict[int, Split | None], applied: dict[int, Split], most: int) -> tuple[list[Split], list[Split]]:
    """The splits that best-first growth makes as far as they are known, and all that are still open after them."""
    order: list[Split] = []
    heap = [(-open_[0].gain, 0, 0)] if open_[0] else []
    rank = 1
    while heap and len(order) < most - 1:
        if heap[0][2] not in applied:
            break
        _, _, node = heapq.heappop(heap)
        s = applied[node]
        order.append(s)
        for child in (s.left, s.right):
            if open_.get(child):
                heapq.heappush(heap, (-open_[child].gain, rank, child))
            rank += 1
    # Children of splits made ahead are open too.
    waiting = [open_[node] for _, _, node in heap]
    below = [c for s in waiting if s.node in applied for c in (s.left, s.right)]
    while below:
        some = [open_[c] for c in below if open_.get(c)]
        waiting += some
        below = [c for s in some if s.node in applied for c in (s.left, s.right)]
    return order, waiting


def finished(order: list[Split], rows: int, total: int, steps: float, settings: Settings) -> Tree:
    """The tree with its nodes numbered in the order of growth."""
    number, sizes, tree = {0: 0}, {0: (rows, total)}, Tree()
    for i, s in enumerate(order):
        number[s.left], number[s.right] = 2 * i + 1, 2 * i + 2
        own = replace(s, node=number[s.node], left=2 * i + 1, right=2 * i + 2)
        sizes.pop(own.node)
        sizes[own.left], sizes[own.right] = (s.left_rows, s.left_sum), (s.rows - s.left_rows, s.sum - s.left_sum)
        tree.splits.append(own)
    rate, l2 = settings.learning_rate, settings.l2_regularization
    tree.values = {leaf: rate * (s / steps) / (n + l2) for leaf, (n, s) in sizes.items()}
    return tree


def counted_here(rows: Rows, texts: int, steps: float, settings: Settings) -> Count:
    """Count in one block that holds all rows."""

    def count(made: list[Split], wanted: list[tuple[int, bool]], sizes: dict[int, tuple[int, int]]) -> dict[int, Found]:
        for s in made:
            rows.split(s)
        none = np.zeros(0, np.int64), np.zeros(0, np.int64)
        return {
            node: (*(rows.histogram(node) if whole else none), [best_level(*rows.levels(node, c), *sizes[node], steps, settings) for c in range(texts)])
            for node, whole in wanted
        }

    return count


# Fitting


@dataclass
class Fitted:
    """What scoring needs: the mean, the bin edges and the trees."""

    start: float
    edges: list[np.ndarray]
    trees: list[Tree]

    def to_json(self) -> str:
        return json.dumps({"start": self.start, "edges": [e.tolist() for e in self.edges], "trees": [t.to_text() for t in self.trees]})

    @classmethod
    def from_json(cls, text: str) -> Fitted:
        held = json.loads(text)
        return cls(held["start"], [np.array(e) for e in held["edges"]], [Tree.from_text(t) for t in held["trees"]])

    def predict(self, columns: list[np.ndarray], codes: list[np.ndarray]) -> np.ndarray:
        n = len((columns or codes)[0]) if columns or codes else 0
        bins = np.stack([binned(x, e) for x, e in zip(columns, self.edges)]) if columns else np.zeros((0, n), np.uint8)
        rows = Rows(bins, np.stack(codes).astype(np.int32) if codes else np.zeros((0, n), np.int32), np.zeros(n))
        for tree in self.trees:
            if len(tree.splits) <= LISTED:
                rows.add(tree)
            else:
                rows.residual -= walked(rows, tree)
        return self.start - rows.residual


#: Splits up to which rows are dealt split by split; with more of them they go down level by level.
LISTED = 64


def walked(rows: Rows, tree: Tree) -> np.ndarray:
    """What a tree adds to each row."""
    size = 2 * len(tree.splits) + 1
    column, bin_, text, missing = np.full(size, -1), np.zeros(size, np.int64), np.zeros(size, bool), np.zeros(size, bool)
    child, value = np.zeros(size, np.int64), np.zeros(size)
    for i, s in enumerate(tree.splits):
        column[s.node], bin_[s.node], text[s.node], missing[s.node] = s.column + (len(rows.bins) if s.text else 0), s.bin, s.text, s.missing_left
        child[s.node] = 2 * i + 1
    value[list(tree.values)] = list(tree.values.values())
    values = np.concatenate([rows.bins.astype(np.int32), rows.codes])
    node, going = np.zeros(values.shape[1], np.int64), np.arange(values.shape[1])
    while len(going):
        at = node[going]
        inner = column[at] >= 0
        going, at = going[inner], at[inner]
        v = values[column[at], going]
        left = np.where(text[at], v == bin_[at], np.where(v == MISSING, missing[at], v <= bin_[at]))
        node[going] = child[at] + ~left
    return value[node]


BLOCKS = "bins binary, codes binary, residual binary, key binary"


def write_blocks(
    frame: DataFrame, names: Sequence[str], codes: Sequence[str], target: str, edges: list[np.ndarray], start: float, block_rows: int
) -> DataFrame:
    """The binned rows as blocks, in the shared folder."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) >= block_rows:
                yield block(held)
                held = []
        if sum(b.num_rows for b in held):
            yield block(held)

    def block(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
        table = pa.Table.from_batches(batches)
        n = table.num_rows
        bins = [binned(np.asarray(table[f"x{i}"].combine_chunks().fill_null(np.nan)), e) for i, e in enumerate(edges)]
        own = [np.asarray(table[f"c{i}"].combine_chunks().fill_null(-1)).astype(np.int32) for i in range(len(codes))]
        key = np.asarray(table["key"].combine_chunks()).astype(np.int64).view(np.uint64)
        return Rows(
            np.stack(bins) if bins else np.zeros((0, n), np.uint8), np.stack(own) if own else np.zeros((0, n), np.int32), np.asarray(table["y"].combine_chunks()) - start, key
        ).write()

    used = [F.col(f"`{n}`").cast("double").alias(f"x{i}") for i, n in enumerate(names)]
    used += [F.col(f"`{c}`").cast("int").alias(f"c{i}") for i, c in enumerate(codes)]
    used.append(F.col(f"`{target}`").cast("double").alias("y"))
    rows = frame.select(*used, F.xxhash64(*used).alias("key"))
    return materialize(rows.mapInArrow(run, BLOCKS), "boosting")


def fit(
    frame: DataFrame, names: Sequence[str], codes: Sequence[str], target: str, settings: Settings, block_rows: int | None = None
) -> Fitted:
    """Boost, or grow a forest, on all rows of the frame that have a target. ``codes`` are columns of level codes; a null is no level."""
    send_package(frame.sparkSession)
    block_rows = block_rows or max(1 << 16, BLOCK_VALUES // max(1, len(names) + len(codes)))
    if settings.forest:
        settings = replace(settings, learning_rate=1 / settings.max_iter)
    frame = frame.where(F.col(f"`{target}`").isNotNull() & ~F.isnan(F.col(f"`{target}`").cast("double")))
    y = F.col(f"`{target}`").cast("double")
    n, steps, low, high = frame.agg(F.count(F.lit(1)), F.sum(F.round(y * MEAN_STEPS).cast("decimal(38,0)")), F.min(y), F.max(y)).first()
    if not n:
        raise ValueError(f"no row has a {target}")
    start = int(steps) / n / MEAN_STEPS
    # Residuals stay within the target's range and some; sums over all rows and within a block stay exact.
    reach = math.log2(max(high - low, 1e-9)) + 1
    step = 2.0 ** min(30, math.floor(61 - reach - math.log2(n)), math.floor(51 - reach - math.log2(min(n, block_rows))))
    edges = bin_edges(frame, names, settings.max_bins)
    if n <= block_rows:
        frame = frame.coalesce(1)
    blocks = write_blocks(frame, names, codes, target, edges, start, block_rows)
    grown = _fit_in_tasks if blocks.count() == 1 else _fit_by_passes
    return Fitted(start, edges, grown(blocks, len(names), len(codes), step, settings))


def _fit_in_tasks(blocks: DataFrame, columns: int, texts: int, steps: float, settings: Settings) -> list[Tree]:
    """All trees from the one block: boosting in one task, a forest in many, each with the block."""
    context = blocks.sparkSession.sparkContext
    tasks = min(settings.max_iter, 4 * context.defaultParallelism) if settings.forest else 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                rows = Rows.read({c: batch[c][k] for c in batch.schema.names}, columns, texts)
                for i in range(batch["part"][k].as_py(), settings.max_iter, tasks):
                    rows.start(steps, bag_of(i, settings))
                    count = counted_here(rows, texts, steps, settings)
                    tree = grow(count, *rows.totals(), steps, settings, False, columns_of(i, columns + texts, settings))
                    if not settings.forest:
                        rows.add(tree)
                    yield pa.RecordBatch.from_pydict({"i": [i], "tree": [tree.to_text()]})

    shares = blocks.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(tasks - 1))))
    if tasks > 1:
        shares = shares.repartition(tasks, "part")
    grown = shares.mapInArrow(run, "i long, tree string").toArrow()
    return [Tree.from_text(t) for _, t in sorted(zip(grown["i"].to_pylist(), grown["tree"].to_pylist()))]


def _fit_by_passes(blocks: DataFrame, columns: int, texts: int, steps: float, settings: Settings) -> list[Tree]:
    trees: list[Tree] = []
    pending: list[Tree] = []
    for i in range(settings.max_iter):
        if len(pending) == WRITE_EVERY:
            blocks, pending = _without(blocks, pending, columns, texts), []
        bag = bag_of(i, settings)
        n, s = _totals(blocks, pending, columns, texts, steps, bag)
        count = _counted_by_spark(blocks, pending, columns, texts, steps, settings, bag)
        tree = grow(count, n, s, steps, settings, True, columns_of(i, columns + texts, settings))
        trees.append(tree)
        if not settings.forest:
            pending.append(tree)
    return trees


def _states(batches: Iterator[pa.RecordBatch], columns: int, texts: int, pending: list[Tree]) -> Iterator[Rows]:
    for batch in batches:
        for i in range(batch.num_rows):
            rows = Rows.read({c: batch[c][i] for c in batch.schema.names}, columns, texts)
            for tree in pending:
                rows.add(tree)
            yield rows


def _without(blocks: DataFrame, pending: list[Tree], columns: int, texts: int) -> DataFrame:
    """The blocks with the residuals that the trees leave."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _states(batches, columns, texts, pending):
            yield rows.write()

    after = materialize(blocks.mapInArrow(run, BLOCKS), "boosting")
    discard(blocks)
    return after


def _totals(blocks: DataFrame, pending: list[Tree], columns: int, texts: int, steps: float, bag: Bag) -> tuple[int, int]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in _states(batches, columns, texts, pending):
            rows.start(steps, bag)
            n, s = rows.totals()
            yield pa.RecordBatch.from_pydict({"n": [n], "s": [s]})

    row = blocks.mapInArrow(run, "n long, s long").agg(F.sum("n"), F.sum("s")).first()
    return row[0], row[1]


def _counted_by_spark(
    blocks: DataFrame, pending: list[Tree], columns: int, texts: int, steps: float, settings: Settings, bag: Bag
) -> Count:
    """Count by a pass over all blocks: partial sums by task, added up by node and slot."""
    spark = blocks.sparkSession
    made_so_far: list[Split] = []
    size = columns * WIDTH

    def count(made: list[Split], wanted: list[tuple[int, bool]], sizes: dict[int, tuple[int, int]]) -> dict[int, Found]:
        made_so_far.extend(made)
        sent = spark.sparkContext.broadcast((pending, list(made_so_far), wanted))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            trees, splits, nodes = sent.value
            whole = [node for node, all_ in nodes if all_]
            n, s = np.zeros((2, len(whole), size), np.int64)
            for rows in _states(batches, columns, texts, trees):
                rows.start(steps, bag)
                for split in splits:
                    rows.split(split)
                for i, node in enumerate(whole):
                    more = rows.histogram(node)
                    n[i] += more[0]
                    s[i] += more[1]
                for node, _ in nodes:
                    for c in range(texts):
                        yield counted(np.full(1, node), c, *rows.levels(node, c))
            for i, node in enumerate(whole):
                some = np.flatnonzero(n[i])
                yield counted(np.full(1, node), -1, some, n[i][some], s[i][some])

        def counted(node, column, slot, n, s) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(node, len(slot)), pa.int32()), pa.array(np.full(len(slot), column), pa.int32()), pa.array(slot, pa.int32()), pa.array(n, pa.int64()), pa.array(s, pa.int64())],
                ["node", "text", "slot", "n", "s"],
            )

        summed = blocks.mapInArrow(run, "node int, text int, slot int, n long, s long").groupBy("node", "text", "slot").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
        result = summed.where("text < 0").select("node", "text", "slot", "n", "s", F.lit(0.0).alias("gain"))
        if texts:
            result = result.unionAll(_best_levels(summed.where("text >= 0"), sizes, steps, settings))
        table = result.toArrow()
        sent.destroy()
        node, text, slot, n, s, gain = (np.asarray(table[c]) for c in table.column_names)
        out = {}
        for number, _ in wanted:
            own = node == number
            bins = own & (text < 0)
            hist_n, hist_s = np.zeros((2, size), np.int64)
            hist_n[slot[bins]], hist_s[slot[bins]] = n[bins], s[bins]
            best: list = [None] * texts
            for i in np.flatnonzero(own & (text >= 0)):
                best[text[i]] = float(gain[i]), int(slot[i]), int(n[i]), int(s[i])
            out[number] = hist_n, hist_s, best
        return out

    return count


def _best_levels(summed: DataFrame, sizes: dict[int, tuple[int, int]], steps: float, settings: Settings) -> DataFrame:
    """For each node and text column the level that gains most against the rest, the lower code of equals."""
    known = F.create_map(*[F.lit(v) for node, (n, s) in sizes.items() for v in (node, json.dumps([n, s]))])
    pair = F.from_json(known[F.col("node")], "array<bigint>")
    rows = summed.withColumns({"rows": pair[0], "total": pair[1]})
    l2, least = F.lit(float(settings.l2_regularization)), max(settings.min_samples_leaf, 1)
    left, right, whole = F.col("s") / steps, (F.col("total") - F.col("s")) / steps, F.col("total") / steps
    others = F.col("rows") - F.col("n")
    gain = left * left / (F.col("n") + l2) + right * right / (others + l2) - whole * whole / (F.col("rows") + l2)
    enough = rows.where((F.col("n") >= least) & (others >= least)).withColumn("gain", gain)
    best = F.max_by(F.struct("slot", "n", "s", "gain"), F.struct("gain", -F.col("slot"))).alias("best")
    return enough.groupBy("node", "text").agg(best).select("node", "text", "best.slot", "best.n", "best.s", "best.gain")


# As stages of a pipeline


class HistogramBoosting(Estimator):
    """Boosting as a pipeline stage, on numeric columns and columns of level codes."""

    def __init__(self, names: Sequence[str], codes: Sequence[str], target: str, prediction: str, settings: Settings):
        super().__init__()
        self.names, self.codes, self.target, self.prediction, self.settings = list(names), list(codes), target, prediction, settings

    def _fit(self, dataset: DataFrame) -> HistogramBoostingModel:
        fitted = fit(dataset, self.names, self.codes, self.target, self.settings)
        return HistogramBoostingModel.of(fitted, self.names, self.codes, self.prediction, self.settings.forest)


class HistogramBoostingModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    """The trees. Scores with one Arrow function over the columns that they use."""

    fitted = Param(Params._dummy(), "fitted", "mean, bin edges and trees", TypeConverters.toString)
    names = Param(Params._dummy(), "names", "numeric columns", TypeConverters.toListString)
    codes = Param(Params._dummy(), "codes", "columns of level codes", TypeConverters.toListString)
    prediction = Param(Params._dummy(), "prediction", "column of the prediction", TypeConverters.toString)
    forest = Param(Params._dummy(), "forest", "whether the trees are a forest", TypeConverters.toBoolean)

    @classmethod
    def of(cls, fitted: Fitted, names: Sequence[str], codes: Sequence[str], prediction: str, forest: bool) -> HistogramBoostingModel:
        model = cls()
        model._set(fitted=fitted.to_json(), names=list(names), codes=list(codes), prediction=prediction, forest=forest)
        return model

    def is_forest(self) -> bool:
        return self.getOrDefault(self.forest)

    def trees(self) -> list[Tree]:
        return Fitted.from_json(self.getOrDefault(self.fitted)).trees

    def gains(self) -> dict[str, float]:
        """What the splits of each column gained, as a share of all."""
        names, codes = self.getOrDefault(self.names), self.getOrDefault(self.codes)
        total = dict.fromkeys([*names, *codes], 0.0)
        for tree in self.trees():
            for s in tree.splits:
                total[(codes if s.text else names)[s.column]] += s.gain
        whole = sum(total.values()) or 1.0
        return {n: v / whole for n, v in total.items()}

    def _transform(self, dataset: DataFrame) -> DataFrame:
        send_package(dataset.sparkSession)
        sent = dataset.sparkSession.sparkContext.broadcast(Fitted.from_json(self.getOrDefault(self.fitted)))
        names, codes = self.getOrDefault(self.names), self.getOrDefault(self.codes)
        width = len(names)

        @F.pandas_udf(DoubleType())
        def predicted(*columns: pd.Series) -> pd.Series:
            values = [c.to_numpy(np.float64, na_value=np.nan) for c in columns[:width]]
            levels = [c.fillna(-1).to_numpy(np.int32) for c in columns[width:]]
            return pd.Series(sent.value.predict(values, levels))

        used = [F.col(f"`{n}`").cast("double") for n in names] + [F.col(f"`{c}`").cast("int") for c in codes]
        if not used:
            return dataset.withColumn(self.getOrDefault(self.prediction), F.lit(sent.value.start + sum(sum(t.values.values()) for t in sent.value.trees)))
        return dataset.withColumn(self.getOrDefault(self.prediction), predicted(*used))
