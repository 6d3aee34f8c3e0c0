"""Chat formatting: a hidden Markov model recovers roles from transcript lines.

States are a role and whether a line begins its turn or goes on with it. A line is seen as a symbol: the kind
of speaker marker it starts with, whether a blank line stands before it, and how long it is.
Transitions and emissions are counted on labelled transcripts. Viterbi gives the most probable
states, and turns are rendered in one canonical form.

A transcript of any length is decoded exactly in blocks of ``block_turns`` rows, whatever their order values, spread over
all tasks: a block is first summed up as a table of the best score from every state before it to every
state at its end, the tables of a transcript are chained to find the states at block borders,
and each block is then decoded between its borders. Tables are chained in a tree: ``fan`` neighbours make one table of the same
size, level by level, and borders are found from the top down, so no more than ``fan`` tables of a transcript meet at once.

Inside a turn, blank lines between two others become one, whatever their number.
Rows of a transcript are ordered by the order column, nulls last, then by text. Rows with a null
conversation are one transcript. Null texts count as empty, empty rows are blank lines, and a
transcript of blank lines has no turns. Extra columns are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lapframe.llm.blocks import partitions
from lapframe.operators.ordered import row_numbers, running_sum
from lapframe.session import materialize, max_group_rows

ROLES = ("system", "user", "assistant")
BEGINS = (0, 2, 4)  # states by number: role * 2, plus one for a line that goes on
STATES = 6
START = STATES
BLOCK_TURNS = 500
#: Blocks of a transcript that one task may number; a longer transcript is numbered in parts.
TASK_BLOCKS = 200
#: Neighbouring tables that are chained at once.
FAN = 1000
LAST = 9223372036854775807

#: Names of speakers.
NAMES = {
    "system": "system instructions instruction context prompt note",
    "user": "user human customer question q me prompter",
    "assistant": "assistant ai bot answer a model agent gpt",
}
_KIND = {n: i for i, r in enumerate(ROLES) for n in NAMES[r].split()}
_MARKER = re.compile(
    r"^\s*(?:<\|(?P<a>[a-z_]+)\|>|\[(?P<b>[a-z]+)\]|#{1,4}\s*(?P<c>[a-z]+)\s*:?\s*$|\*\*(?P<d>[a-z]+)\s*:?\*\*:?|(?P<e>[a-z]+)\s*[:>](?=\s|$))\s*",
    re.I,
)
SYMBOLS = 4 * 2 * 3


def marker(line: str) -> tuple[int, str]:
    """The role that a line's marker names (0 none, else role number + 1), and what follows it."""
    m = _MARKER.match(line)
    name = m and next(g for g in m.groups() if g is not None).lower()
    return (_KIND[name] + 1, line[m.end() :]) if m and name in _KIND else (0, line)


def symbols(lines: list[str], blank: bool) -> tuple[list[int], list[int]]:
    """Symbols of the lines that are not blank, and their places. ``blank``: a blank line stands before the first."""
    out, at = [], []
    for i, line in enumerate(lines):
        if not line.strip():
            blank = True
            continue
        words = len(line.split())
        out.append(marker(line)[0] * 6 + blank * 3 + (words > 8) + (words > 25))
        at.append(i)
        blank = False
    return out, at


@dataclass
class Model:
    """Log probabilities: from each state (the last: none yet) to each, and of each symbol in each state."""

    steps: np.ndarray
    seen: np.ndarray


def from_counts(steps: np.ndarray, seen: np.ndarray) -> Model:
    """Smoothed log probabilities. A turn never begins by going on, nor goes on in another role."""
    allowed = np.zeros((STATES + 1, STATES), bool)
    allowed[:, BEGINS] = True
    for r in BEGINS:
        allowed[[r, r + 1], r + 1] = True
    steps = np.where(allowed, steps + 0.5, 0.0)
    with np.errstate(divide="ignore"):
        steps = np.log(steps / steps.sum(axis=1, keepdims=True))
    seen = seen + 0.05
    return Model(steps, np.log(seen / seen.sum(axis=1, keepdims=True)))


def table(model: Model, observed: list[int]) -> np.ndarray:
    """The best score from each state before the lines to each state at the last."""
    best = model.steps + model.seen[:, observed[0]]
    for o in observed[1:]:
        best = (best[:, :, None] + model.steps[None, :STATES]).max(axis=1) + model.seen[:, o]
    return best


def chained(tables: list[tuple[np.ndarray | None, bool]]) -> tuple[np.ndarray | None, bool]:
    """The table of neighbouring blocks from theirs, and whether they end on a blank line.

    A table has two forms, for no and for a blank line before it; a block of blank lines has none.
    """
    out: list[np.ndarray] = []
    for blank in (False, True):
        whole = None
        for best, ends_blank in tables:
            if best is not None:
                own = best[int(blank)]
                whole = own if whole is None else (whole[:, :, None] + own[None, :STATES]).max(axis=1)
            blank = ends_blank
        if whole is not None:
            out.append(whole)
    return (np.stack(out) if out else None), tables[-1][1]


def borders(
    tables: list[tuple[np.ndarray | None, bool]], before: int = START, end: int | None = None, blank: bool = False
) -> list[tuple[int, int, int, bool]]:
    """For each block with a table its number here, the best states before it and at its end, and whether a blank line stands before it."""
    score, back, held = None, [], []
    for i, (best, ends_blank) in enumerate(tables):
        if best is not None:
            own = best[int(blank)]
            paths = own[before][None] if score is None else score[:, None] + own[:STATES]
            back.append(paths.argmax(axis=0))
            score = paths.max(axis=0)
            held.append((i, blank))
        blank = ends_blank
    if not held:
        return []
    state = int(score.argmax()) if end is None else end
    out = []
    for k in range(len(held) - 1, -1, -1):
        earlier = int(back[k][state]) if k else before
        out.append((held[k][0], earlier, state, held[k][1]))
        state = earlier
    return out[::-1]


def viterbi(model: Model, observed: list[int], before: int = START, end: int | None = None) -> list[int]:
    """The best states, given the state before and, if named, the last one."""
    score = model.steps[before] + model.seen[:, observed[0]]
    back = []
    for o in observed[1:]:
        paths = score[:, None] + model.steps[:STATES]
        back.append(paths.argmax(axis=0))
        score = paths.max(axis=0) + model.seen[:, o]
    states = [int(score.argmax()) if end is None else end]
    for b in reversed(back):
        states.append(int(b[states[-1]]))
    return states[::-1]


def _parts(t: pa.Table) -> Iterator[tuple[tuple, list[dict]]]:
    """The blocks of one share, each with its rows in order."""
    rows = sorted(t.to_pylist(), key=lambda r: (r["conv"] is None, r["conv"] or 0, r["block"], r["place"], r["text"]))
    begin = 0
    for i in range(1, len(rows) + 1):
        if i == len(rows) or (rows[i]["conv"], rows[i]["block"]) != (rows[begin]["conv"], rows[begin]["block"]):
            yield (rows[begin]["conv"], rows[begin]["block"]), rows[begin:i]
            begin = i


def _lines(rows: list[dict]) -> list[str]:
    return "\n".join(r["text"] for r in rows).split("\n")


def learn(transcripts: DataFrame) -> Model:
    """Counts over all labelled rows of ``conv, place, text, block, share, role``; a row is one turn."""

    def run(t: pa.Table) -> pa.Table:
        found: Counter[tuple[int, int, int]] = Counter()
        for (_, block), rows in _parts(t):
            last, blank = START if block == 0 else None, False
            for row in rows:
                if row["role"] not in ROLES:
                    continue
                begin = ROLES.index(row["role"]) * 2
                lines = row["text"].split("\n")
                observed, _ = symbols(lines, blank)
                for k, o in enumerate(observed):
                    state = begin + (k > 0)
                    if last is not None:
                        found[0, last, state] += 1
                    found[1, state, o] += 1
                    last = state
                blank = not lines[-1].strip()
        keys = sorted(found)
        return pa.table(
            {
                "kind": pa.array([k[0] for k in keys], pa.int32()),
                "i": pa.array([k[1] for k in keys], pa.int32()),
                "j": pa.array([k[2] for k in keys], pa.int32()),
                "n": pa.array([found[k] for k in keys], pa.int64()),
            }
        )

    counted = transcripts.groupBy("share").applyInArrow(run, "kind int, i int, j int, n long").groupBy("kind", "i", "j").agg(F.sum("n").alias("n"))
    steps, seen = np.zeros((STATES + 1, STATES)), np.zeros((STATES, SYMBOLS))
    for r in counted.collect():  # at most one row for each pair of states, or of state and symbol
        (seen if r["kind"] else steps)[r["i"], r["j"]] = r["n"]
    return from_counts(steps, seen)


def prepared(rows: DataFrame, conv_col: str, order_col: str, text_col: str, block_turns: int, *more: str) -> DataFrame:
    """``conv, place, block, share, text`` (and more columns): a share holds many whole blocks.

    ``place`` is a row's number in its transcript, from 0.
    """
    place = F.coalesce(F.col(order_col).cast("long"), F.lit(LAST))
    out = rows.select(F.col(conv_col).cast("long").alias("conv"), place.alias("place"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"), *more)
    most = min(max_group_rows(rows.sparkSession), TASK_BLOCKS * block_turns)
    out = row_numbers(out, ["conv"], ["place", "text", *more], "number", most)
    out = out.withColumn("place", F.col("number") - 1).drop("number")
    out = out.withColumn("block", F.expr(f"place div {block_turns}"))
    return out.withColumn("share", F.pmod(F.xxhash64("conv", "block"), F.lit(4 * partitions(rows))).cast("int"))


TABLES = "conv long, block long, best binary, blank boolean"
BORDERS = "conv long, block long, before int, after int, blank boolean"


def _siblings(t: pa.Table) -> Iterator[tuple[list[dict], list[tuple[np.ndarray | None, bool]]]]:
    """The blocks below each parent in order, and their tables."""
    rows = sorted(t.to_pylist(), key=lambda r: (r["conv"] is None, r["conv"] or 0, r["parent"], r["block"]))
    begin = 0
    for i in range(1, len(rows) + 1):
        if i == len(rows) or (rows[i]["conv"], rows[i]["parent"]) != (rows[begin]["conv"], rows[begin]["parent"]):
            own = rows[begin:i]
            yield own, [(None if r["best"] is None else np.frombuffer(r["best"]).reshape(2, STATES + 1, STATES), r["blank"]) for r in own]
            begin = i


def block_borders(tables: DataFrame, shares: int, fan: int = FAN) -> DataFrame:
    """``conv, block, before, after, blank`` of each block that has a table: the states at its borders.

    ``tables`` is written; a transcript's blocks are numbered from 0.
    """

    def join_up(t: pa.Table) -> pa.Table:
        out = []
        for own, below in _siblings(t):
            best, blank = chained(below)
            out.append((own[0]["conv"], own[0]["parent"], None if best is None else best.tobytes(), blank))
        kinds = {"conv": pa.int64(), "block": pa.int64(), "best": pa.binary(), "blank": pa.bool_()}
        return pa.table({n: pa.array([r[i] for r in out], k) for i, (n, k) in enumerate(kinds.items())})

    def go_down(t: pa.Table) -> pa.Table:
        out = []
        for own, below in _siblings(t):
            for i, *found in borders(below, own[0]["state_before"], own[0]["state_after"], own[0]["blank_before"]):
                out.append((own[i]["conv"], own[i]["block"], *found))
        kinds = {"conv": pa.int64(), "block": pa.int64(), "before": pa.int32(), "after": pa.int32(), "blank": pa.bool_()}
        return pa.table({n: pa.array([r[i] for r in out], k) for i, (n, k) in enumerate(kinds.items())})

    share = F.pmod(F.xxhash64("conv", "parent"), F.lit(shares))
    levels = [tables]
    most = (tables.agg(F.max("block")).first()[0] or 0) + 1
    while most > fan:
        below = levels[-1].withColumn("parent", F.expr(f"block div {fan}"))
        levels.append(materialize(below.withColumn("share", share).groupBy("share").applyInArrow(join_up, TABLES), "tables"))
        most = -(-most // fan)
    found = None
    for level in reversed(levels):
        if found is None:  # all that is left of a transcript hangs on its begin
            below = level.withColumn("parent", F.lit(0).cast("long")).withColumns(
                {"state_before": F.lit(START), "state_after": F.lit(None).cast("int"), "blank_before": F.lit(False)}
            )
        else:
            below = level.withColumn("parent", F.expr(f"block div {fan}")).alias("l").join(
                found.alias("f"), F.expr("l.conv <=> f.conv and l.parent = f.block")
            ).selectExpr("l.*", "f.before AS state_before", "f.after AS state_after", "f.blank AS blank_before")
        found = below.withColumn("share", share).groupBy("share").applyInArrow(go_down, BORDERS)
    return found


def format_chats(
    rows: DataFrame,
    model: Model,
    conv_col: str = "conv_id",
    order_col: str = "turn",
    text_col: str = "text",
    block_turns: int = BLOCK_TURNS,
    fan: int = FAN,
) -> DataFrame:
    """Recovered turns: ``conv_id, turn, role, text`` (markers gone), ``rendered``."""
    ready = prepared(rows, conv_col, order_col, text_col, block_turns)

    def sum_up(t: pa.Table) -> pa.Table:
        out: dict[str, list] = {"conv": [], "block": [], "best": [], "blank": []}
        for (conv, block), own in _parts(t):
            lines = _lines(own)
            ways = [symbols(lines, blank)[0] for blank in (False, True)]  # what stands before is not known yet
            best = b"".join(table(model, o).tobytes() for o in ways) if ways[0] else None
            for name, value in zip(out, (conv, block, best, not lines[-1].strip())):
                out[name].append(value)
        kinds = {"conv": pa.int64(), "block": pa.int64(), "best": pa.binary(), "blank": pa.bool_()}
        return pa.table({n: pa.array(v, kinds[n]) for n, v in out.items()})

    def decode(t: pa.Table) -> pa.Table:
        out: dict[str, list] = {"conv": [], "block": [], "number": [], "goes_on": [], "role": [], "text": []}
        for (conv, block), own in _parts(t):
            lines = _lines(own)
            observed, at = symbols(lines, own[0]["blank"])
            if not observed:
                continue
            states = viterbi(model, observed, own[0]["before"], own[0]["after"])
            turns: list[tuple[bool, int, list[str]]] = []
            for i, state, o in zip(at, states, observed):
                begins = state in BEGINS
                if begins or not turns:
                    turns.append((begins, state // 2, []))
                    kept = [] if begins or o % 6 < 3 else [""]
                    turns[-1][2].extend([*kept, marker(lines[i])[1] if begins else lines[i]])
                else:
                    turns[-1][2].extend(["", lines[i]] if o % 6 >= 3 else [lines[i]])
            for number, (begins, role, kept) in enumerate(turns):
                row = (conv, block, number, not begins, ROLES[role], "\n".join(kept))
                for name, value in zip(out, row):
                    out[name].append(value)
        kinds = {"conv": pa.int64(), "block": pa.int64(), "number": pa.int32(), "goes_on": pa.bool_(), "role": pa.string(), "text": pa.string()}
        return pa.table({n: pa.array(v, kinds[n]) for n, v in out.items()})

    tables = ready.groupBy("share").applyInArrow(sum_up, TABLES)
    found = block_borders(materialize(tables, "tables"), 4 * partitions(rows), fan)
    joined = ready.alias("r").join(found.alias("b"), F.expr("r.conv <=> b.conv and r.block = b.block"))
    pieces = joined.select("r.*", "b.before", "b.after", "b.blank").groupBy("share").applyInArrow(
        decode, "conv long, block long, number int, goes_on boolean, role string, text string"
    )
    pieces = materialize(pieces, "turns")
    # A turn's number: turns begun in earlier blocks of the transcript and before it in its own.
    begun = pieces.groupBy("conv", "block").agg(F.sum(F.when(F.col("goes_on"), 0).otherwise(1)).alias("n"), F.max(F.col("goes_on").cast("int")).alias("open"))
    begun = running_sum(begun, ["conv"], ["block"], "n", "upto").withColumn("earlier", F.col("upto") - F.col("n"))
    numbered = pieces.alias("p").join(begun.alias("g"), F.expr("p.conv <=> g.conv and p.block = g.block"))
    turn = (F.col("g.earlier") + F.col("p.number") - F.col("g.open")).cast("long")
    numbered = numbered.select(F.col("p.conv").alias("conv_id"), turn.alias("turn"), "p.block", "p.role", "p.text")
    turns = numbered.groupBy("conv_id", "turn").agg(
        F.min(F.struct("block", "role"))["role"].alias("role"), F.array_sort(F.collect_list(F.struct("block", "text"))).alias("parts")
    )
    text = F.btrim(F.array_join(F.col("parts.text"), "\n"), F.lit("\n"))
    turns = turns.select("conv_id", "turn", "role", text.alias("text"))
    return turns.withColumn("rendered", F.concat(F.lit("<|"), "role", F.lit("|>\n"), "text", F.lit("\n<|end|>\n")))


#: How the transcripts of the query write their markers: system, user, assistant.
STYLES = (
    ("System: ", "User: ", "Assistant: "),
    ("Instructions: ", "Human: ", "AI: "),
    ("### System\n", "### User\n", "### Assistant\n"),
    ("[system] ", "[user] ", "[assistant] "),
    ("<|system|>\n", "<|user|>\n", "<|assistant|>\n"),
    ("Note: ", "Q: ", "A: "),
)


def raw_transcripts(turns: DataFrame) -> DataFrame:
    """Turns as they stand in raw transcripts: ``conv_id, turn, role, text``, a style for each conversation, one marker of eight missing."""
    style = F.pmod(F.xxhash64("conv_id"), F.lit(len(STYLES)))
    word = F.element_at(F.array([F.create_map([F.lit(x) for pair in zip(ROLES, s) for x in pair]) for s in STYLES]), (style + 1).cast("int"))
    lost = F.pmod(F.xxhash64("conv_id", "turn"), F.lit(8)) == 0
    shown = F.concat(F.when(lost, F.lit("")).otherwise(F.coalesce(word[F.col("role")], F.lit(""))), F.coalesce("text", F.lit("")), F.lit("\n"))
    return turns.select("conv_id", "turn", "role", shown.alias("text"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw transcripts made of all conversations, decoded by a model learned from those whose id's hash is even."""
    raw = raw_transcripts(spark.read.parquet(f"{sf_dir}/conversations.parquet"))
    ready = prepared(raw, "conv_id", "turn", "text", BLOCK_TURNS, "role")
    model = learn(ready.filter(F.xxhash64("conv") % 2 == 0))
    return format_chats(raw.drop("role"), model).select("conv_id", "turn", "role", "text", F.sha2("rendered", 256).alias("rendered_sha256"))
