"""Secret scans with a trigram inverted index, in DataFrame operations only.

For each rule's regular expression a Boolean trigram query is derived: every match must hold all
trigrams of at least one clause. The index holds the postings of the rules' trigrams (a posting is
a trigram and the hash of a text, so copies share one), and is written to the shared folder. A
clause's postings are intersected by counting, a rule's clauses are united, and only
candidate texts are searched with the rule's expression; rules without mandatory
trigrams search every text.

Spans come from splitting the text at the matches, so their places count code points.

Null texts count as empty. Equal rows get equal results. Extra columns are kept out.
"""

from __future__ import annotations

import re._parser as parser
from dataclasses import dataclass
from itertools import product

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lapframe.session import materialize


@dataclass(frozen=True)
class Rule:
    """A kind of secret: an expression, and the least length of one of its groups."""

    name: str
    pattern: str
    group: int = 0
    least: int = 1


#: The base kinds, in the order in which they are listed.
BASE = (
    Rule("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", r"AKIA[A-Z0-9]{16,}"),
    Rule("hex", r"[0-9a-f]{24,}"),
)
#: Published formats of keys and tokens.
MORE = (
    Rule("private_key", r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]+"),
    Rule("stripe", r"[sr]k_(live|test)_[A-Za-z0-9]{16,}"),
    Rule("bearer", r"(?i)bearer\x20+[A-Za-z0-9._~+/=-]{16,}"),
    Rule("url_login", r"[a-z][a-z0-9+.-]{1,20}://[^\s:/@]{1,100}:[^\s:/@]{1,100}@"),
)
RULES = BASE + MORE

#: Strings that are kept apart while a query is derived.
MAX_STRINGS = 64


def trigram_clauses(pattern: str) -> list[frozenset[str]]:
    """Sets of lower-case trigrams; a match holds all of at least one set. An empty set: no trigram is mandatory."""
    exact, needed = _derive(list(parser.parse(pattern)))
    return _minimal([a | b for a, b in product(needed, _held(exact))])


def _minimal(clauses: list[frozenset[str]]) -> list[frozenset[str]]:
    distinct = sorted(set(clauses), key=lambda c: (len(c), sorted(c)))
    return [c for i, c in enumerate(distinct) if not any(d <= c for d in distinct[:i])]


def _held(strings: set[str]) -> list[frozenset[str]]:
    return [frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in sorted(strings)] or [frozenset()]


def _derive(nodes: list) -> tuple[set[str], list[frozenset[str]]]:
    """The strings that may stand at the end (exact so far), and clauses of what came before."""
    exact, needed = {""}, [frozenset()]
    for kind, value in nodes:
        kind = str(kind)
        if kind == "LITERAL":
            found = {chr(value).lower()}
        elif kind == "SUBPATTERN":
            inner, more = _derive(list(value[-1]))
            if more != [frozenset()]:
                needed = _minimal([a | b | c for a, b, c in product(needed, _held(exact), more)])
                exact = {""}
            found = inner
        elif kind == "BRANCH":
            found, clauses = set(), []
            for branch in value[1]:
                inner, more = _derive(list(branch))
                found |= inner
                clauses += [a | b for a, b in product(more, _held(inner))]
            if len(found) > MAX_STRINGS or any(_derive(list(b))[1] != [frozenset()] for b in value[1]):
                needed = _minimal([a | b | c for a, b, c in product(needed, _held(exact), clauses)])
                exact, found = {""}, {""}
        elif kind == "IN" and len(value) <= 8 and all(str(k) == "LITERAL" for k, _ in value):
            found = {chr(v).lower() for _, v in value}
        elif kind in ("MAX_REPEAT", "MIN_REPEAT") and value[:2] == (0, 1):
            inner, more = _derive(list(value[2]))
            found = inner | {""} if more == [frozenset()] else None
        elif kind == "AT":
            continue
        else:
            found = None
        if found is None or len(exact) * len(found) > MAX_STRINGS:
            needed = _minimal([a | b for a, b in product(needed, _held(exact))])
            exact = {""} if found is None else found
            if found is not None and len(found) > MAX_STRINGS:
                exact = {""}
        else:
            exact = {a + b for a, b in product(exact, found)}
    return exact, needed


def postings(texts: DataFrame, trigrams: list[str]) -> DataFrame:
    """``trigram int, th long``: which texts hold which of the trigrams. ``texts`` has ``th, text``."""
    low = texts.select("th", F.lower("text").alias("low"))
    held = F.filter(F.array([F.struct(F.lit(i).alias("i"), F.lit(t).alias("t")) for i, t in enumerate(trigrams)]), lambda x: F.contains(F.col("low"), x["t"]))
    return low.select("th", F.explode(F.transform(held, lambda x: x["i"])).alias("trigram")).distinct()


def candidates(texts: DataFrame, rules: tuple[Rule, ...]) -> tuple[DataFrame | None, list[int]]:
    """``th, rules array<int>``: the texts that may match a rule; and the rules that search every text."""
    clauses = [(r, c) for r, rule in enumerate(rules) for c in trigram_clauses(rule.pattern)]
    everywhere = sorted({r for r, c in clauses if not c})
    clauses = [(r, c) for r, c in clauses if r not in everywhere]
    trigrams = sorted({t for _, c in clauses for t in c})
    if not trigrams:
        return None, everywhere
    index = materialize(postings(texts, trigrams), "postings")
    # One row for each trigram of each clause: as many as the rules have, whatever the corpus.
    wanted = [(trigrams.index(t), n, r, len(c)) for n, (r, c) in enumerate(clauses) for t in sorted(c)]
    asked = texts.sparkSession.createDataFrame(wanted, "trigram int, clause int, rule int, size int")
    full = index.join(F.broadcast(asked), "trigram").groupBy("th", "clause", "rule", "size").count().filter("count = size")
    return materialize(full.groupBy("th").agg(F.collect_set("rule").alias("rules")), "candidates"), everywhere


def spans(text: Column, rule: Rule, kind: int) -> Column:
    """All matches of a rule as structs of start, kind and end, in code points."""
    pattern = F.lit(rule.pattern)
    matches, groups = F.regexp_extract_all(text, pattern, F.lit(0)), F.regexp_extract_all(text, pattern, F.lit(rule.group))
    between = F.split(text, rule.pattern, -1)
    pieces = F.zip_with(between, F.zip_with(matches, groups, lambda m, g: F.struct(m.alias("m"), g.alias("g"))), lambda b, x: F.struct(b.alias("b"), x["m"].alias("m"), x["g"].alias("g")))
    empty = F.array().cast("array<struct<s:int,k:int,e:int>>")

    def add(done: Column, x: Column) -> Column:
        start = done["at"] + F.length(x["b"])
        end = start + F.coalesce(F.length(x["m"]), F.lit(0))
        kept = F.length(x["g"]) >= rule.least
        span = F.struct(start.alias("s"), F.lit(kind).alias("k"), end.alias("e"))
        return F.struct(end.alias("at"), F.when(kept, F.concat(done["found"], F.array(span))).otherwise(done["found"]).alias("found"))

    return F.aggregate(pieces, F.struct(F.lit(0).alias("at"), empty.alias("found")), add, lambda done: done["found"])


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``doc_id, text, found``: all spans of each row, by start, then kind, as structs of start, kind and end."""
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    rows = rows.withColumn("th", F.xxhash64("text"))
    named, everywhere = candidates(rows.select("th", "text"), rules)
    rows = rows.join(named, "th", "left") if named is not None else rows.withColumn("rules", F.lit(None).cast("array<int>"))
    none = F.array().cast("array<struct<s:int,k:int,e:int>>")
    found = []
    for i, rule in enumerate(rules):
        may = F.col("text").rlike(rule.pattern) if i in everywhere else F.coalesce(F.array_contains("rules", F.lit(i)), F.lit(False))
        found.append(F.when(may, spans(F.col("text"), rule, i)).otherwise(none))
    return rows.select("doc_id", "text", F.array_sort(F.concat(*found)).alias("found"))


def listed(found: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    names = F.array([F.lit(r.name) for r in rules])
    return F.array_join(F.transform(found, lambda x: F.concat_ws(":", F.element_at(names, x["k"] + 1), x["s"].cast("string"), x["e"].cast("string"))), ",")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan(spark.read.parquet(f"{sf_dir}/documents.parquet")).select("doc_id", "found")

    def count(kind: int) -> Column:
        return F.size(F.filter("found", lambda x: x["k"] == kind)).cast("long")

    return found.select(
        "doc_id",
        count(0).alias("n_assign"),
        count(1).alias("n_access"),
        count(2).alias("n_hex"),
        F.sha2(listed(F.filter("found", lambda x: x["k"] < len(BASE))), 256).alias("base_sha256"),
        listed(F.col("found")).alias("spans"),
    )


def _oracle() -> str:
    """SQL for the query: places from the lengths of what stands between the matches."""

    def quoted(text: str) -> str:
        return "'" + text.replace("'", "''") + "'"

    found = " UNION ALL ".join(
        f"SELECT doc_id, {k} AS k, {quoted(r.name)} AS name, {r.least} AS least, regexp_extract_all(text, {quoted(r.pattern)}) AS ms, "
        f"regexp_extract_all(text, {quoted(r.pattern)}, {r.group}) AS gs, string_split_regex(text, {quoted(r.pattern)}) AS ps "
        f"FROM t WHERE regexp_matches(text, {quoted(r.pattern)})"
        for k, r in enumerate(RULES)
    )
    listed_all = "string_agg(name || ':' || s || ':' || e, ',' ORDER BY s, k)"
    counts = ", ".join(f"CAST(coalesce(n_{r.name}, 0) AS BIGINT) AS n_{r.name}" for r in BASE)
    sums = ", ".join(f"count(*) FILTER (k = {k}) AS n_{r.name}" for k, r in enumerate(BASE))
    return f"""
WITH t AS (SELECT doc_id, coalesce(text, '') AS text FROM documents), found AS ({found}),
one AS (SELECT *, unnest(range(1, len(ms) + 1)) AS i FROM found),
placed AS (SELECT doc_id, k, name, length(ms[i]) AS n, length(gs[i]) >= least AS kept,
  list_sum(list_transform(ps[1:i], lambda x: length(x))) + coalesce(list_sum(list_transform(ms[1:i - 1], lambda x: length(x))), 0) AS s FROM one),
spans AS (SELECT doc_id, k, name, CAST(s AS BIGINT) AS s, CAST(s + n AS BIGINT) AS e FROM placed WHERE kept),
per AS (SELECT doc_id, {sums}, {listed_all} AS spans,
  string_agg(name || ':' || s || ':' || e, ',' ORDER BY s, k) FILTER (k < {len(BASE)}) AS base FROM spans GROUP BY doc_id)
SELECT t.doc_id, {counts}, sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans FROM t LEFT JOIN per USING (doc_id)
"""


ORACLE = _oracle()
