"""Secret scanning by a trigram inverted index, with DataFrame functions only.

Each rule's regular expression is turned into a Boolean query of trigrams that every match must contain. The index holds,
for each of the trigrams that some rule asks for and each block of rows, the rows whose text contains it. Posting lists
are intersected and united block by block; the rows that come out are candidates, and only they are matched against the
rule. Rules that imply no trigram are matched against every row.
"""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import reduce
from re import _constants as op
from re import _parser as parser

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cellgrid.llm.packed import id_text

#: Rows of a block: bounds the length of a posting list.
BLOCK_ROWS = 4096
#: Strings that one stretch of a pattern may stand for before it is cut.
MOST_STRINGS = 64


@dataclass(frozen=True)
class Rule:
    """A kind of secret: its matches count if the given group has so many characters at least."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0


#: The base kinds, in the order in which spans of one start are listed, then further ones.
BASE = (
    Rule("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 6),
    Rule("access", "AKIA[A-Z0-9]{16,}"),
    Rule("hex", "[0-9a-f]{24,}"),
)
MORE = (
    Rule("pem", "-----BEGIN [A-Z ]{0,40}PRIVATE KEY-----"),
    Rule("forge", "gh[pousr]_[A-Za-z0-9]{36,}"),
)

#: All of the clauses must hold; a clause holds if all trigrams of one of its alternatives are there.
Query = list[list[frozenset[str]]]


def trigrams(text: str) -> frozenset[str]:
    return frozenset(text[k : k + 3] for k in range(len(text) - 2))


def _clause(strings: set[str]) -> list[frozenset[str]] | None:
    """One alternative for each string; none that implies another; nothing if some string implies no trigram."""
    options = {trigrams(s) for s in strings}
    if not options or frozenset() in options:
        return None
    least = [o for o in options if not any(p < o for p in options)]
    return sorted(least, key=sorted)


def trigram_query(pattern: str) -> Query:
    """Trigrams (lower case) that each match of the pattern contains; an empty query says nothing."""
    query: Query = []

    def cut(strings: set[str]) -> set[str]:
        clause = _clause(strings)
        if clause:
            query.append(clause)
        return {""}

    def options(item) -> set[str] | None:
        """The strings that an element stands for, lower-cased, if they are few."""
        what, value = item
        if what is op.LITERAL:
            return {chr(value).lower()}
        if what is op.IN:
            found: set[str] = set()
            for kind, v in value:
                if kind is op.LITERAL:
                    found.add(chr(v).lower())
                elif kind is op.RANGE and v[1] - v[0] < 8:
                    found |= {chr(c).lower() for c in range(v[0], v[1] + 1)}
                else:
                    return None
            return found
        if what is op.SUBPATTERN:
            return sequence(value[3])
        if what is op.BRANCH:
            parts = [sequence(x) for x in value[1]]
            return None if None in parts else set().union(*parts)
        if what is op.MAX_REPEAT and value[1] <= 4:
            one = sequence(value[2])
            if one is None or len(one) ** value[1] > MOST_STRINGS:
                return None
            found, now = ({""} if value[0] == 0 else set()), {""}
            for k in range(1, value[1] + 1):
                now = {a + b for a in now for b in one}
                found |= now if k >= value[0] else set()
            return found
        return None

    def sequence(items) -> set[str] | None:
        now = {""}
        for item in items:
            more = options(item)
            if more is None or len(now) * len(more) > MOST_STRINGS:
                return None
            now = {a + b for a in now for b in more}
        return now

    def walk(items) -> None:
        now = {""}
        for item in items:
            what, value = item
            more = options(item)
            if more is not None and len(now) * len(more) <= MOST_STRINGS:
                now = {a + b for a in now for b in more}
                continue
            now = cut(now)
            if what is op.SUBPATTERN:
                walk(value[3])
            elif what is op.MAX_REPEAT and value[0] >= 1:
                walk(value[2])
            elif more is not None:
                now = more
        cut(now)

    walk(parser.parse(pattern))
    return query


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """id, text and a key of the row; rows that share a key only make each other candidates."""
    return id_text(docs, id_col, text_col).withColumn("_key", F.xxhash64("id", "text"))


def postings(rows: DataFrame, wanted: list[str], blocks: int) -> DataFrame:
    """The inverted index: block, trigram, and the keys of the block's rows whose text contains it."""
    low = F.lower("text")
    held = F.filter(F.array(*[F.when(F.contains(low, F.lit(t)), F.lit(t)) for t in wanted]), lambda t: t.isNotNull())
    return (
        rows.select("_key", F.explode(held).alias("trigram"))
        .withColumn("block", F.pmod("_key", F.lit(blocks)))
        .groupBy("block", "trigram")
        .agg(F.collect_set("_key").alias("keys"))
    )


def candidates(index: DataFrame, queries: dict[str, Query]) -> DataFrame:
    """_key and the kinds whose query the row satisfies, from intersected and united posting lists."""
    lists = index.groupBy("block").agg(F.map_from_entries(F.collect_list(F.struct("trigram", "keys"))).alias("of"))
    none = F.array().cast("array<bigint>")

    def found(query: Query) -> Column:
        clauses = [
            reduce(F.array_union, [
                reduce(F.array_intersect, [F.coalesce(F.try_element_at("of", F.lit(t)), none) for t in sorted(option)])
                for option in clause
            ])
            for clause in query
        ]
        return reduce(F.array_intersect, clauses)

    def pairs_of(kind: str) -> Column:
        return F.transform(found(queries[kind]), lambda k: F.struct(k.alias("_key"), F.lit(kind).alias("kind")))

    pairs = [pairs_of(kind) for kind in queries]
    return (
        lists.select(F.explode(F.flatten(F.array(*pairs))).alias("c"))
        .groupBy("c._key")
        .agg(F.collect_set("c.kind").alias("kinds"))
    )


SPANS = "array<struct<start:int,order:int,end:int,kind:string>>"
#: Matches of a text whose places are added up together; blocks keep the work in proportion to the matches.
BLOCK_MATCHES = 256


def _steps(rule: Rule, found: str) -> Column:
    """array<struct<size, gap, value>> of the matches in a column: their lengths, what lies before each, and its value's
    length. The text is cut up only where there are matches."""
    matches = F.col(found)
    sizes = F.transform(matches, F.length)
    gaps = F.transform(F.slice(F.split("text", rule.pattern, -1), F.lit(1), F.size(matches)), F.length)
    values = sizes if rule.group == 0 else F.transform(F.regexp_extract_all("text", F.lit(rule.pattern), F.lit(rule.group)), F.length)
    zipped = F.arrays_zip(sizes.alias("size"), gaps.alias("gap"), values.alias("value"))
    return F.when(F.size(matches) > 0, zipped).otherwise(F.array().cast("array<struct<size:int,gap:int,value:int>>"))


def _block(steps: Column, b: Column) -> Column:
    return F.slice(steps, b * BLOCK_MATCHES + 1, F.lit(BLOCK_MATCHES))


def _blocks(steps: Column) -> Column:
    """Numbers of the blocks of a list of matches that isn't empty."""
    return F.sequence(F.lit(0), F.floor((F.size(steps) - 1) / BLOCK_MATCHES).cast("int"))


def _offsets(steps: Column) -> Column:
    """Where each block of matches begins in the text."""
    sums = F.transform(_blocks(steps), lambda b: F.aggregate(_block(steps, b), F.lit(0), lambda s, x: s + x["gap"] + x["size"]))
    placed = F.aggregate(sums, F.array(F.lit(0)), lambda s, v: F.concat(s, F.array(F.element_at(s, -1) + v)))
    return F.when(F.size(steps) > 0, placed)


def _spans(rule: Rule, order: int, steps: Column, offsets: Column) -> Column:
    """array<struct<start, order, end, kind>> of the rule's matches: leftmost, not overlapping, in code points."""

    def step(state: Column, x: Column) -> Column:
        start = state["at"] + x["gap"]
        end = start + x["size"]
        one = F.array(F.struct(start.alias("start"), F.lit(order).alias("order"), end.alias("end"), F.lit(rule.kind).alias("kind")))
        kept = F.when(x["value"] >= rule.least, F.concat(state["spans"], one.cast(SPANS))).otherwise(state["spans"])
        return F.struct(end.alias("at"), kept.alias("spans"))

    def block(b: Column) -> Column:
        start = F.struct(F.get(offsets, b).alias("at"), F.array().cast(SPANS).alias("spans"))
        return F.aggregate(_block(steps, b), start, step, lambda state: state["spans"])

    return F.when(F.size(steps) > 0, F.flatten(F.transform(_blocks(steps), block))).otherwise(F.array().cast(SPANS))


def scan(
    docs: DataFrame, rules: tuple[Rule, ...] = BASE + MORE, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """id_col and spans: array<struct<start, order, end, kind>> by start, then by the rules' order; one row for each row.

    Positions are code points, the end is exclusive. A null or empty text has no spans; null and repeated ids and repeated
    rows stay as they are; an empty table gives no rows; other columns play no part.
    """
    rows = _rows(docs, id_col, text_col)
    queries = {r.kind: q for r in rules if (q := trigram_query(r.pattern))}
    wanted = sorted({t for q in queries.values() for clause in q for option in clause for t in option})
    every = rows
    if wanted:
        blocks = max(1, math.ceil(docs.count() / BLOCK_ROWS))
        every = rows.join(candidates(postings(rows, wanted, blocks), queries), "_key", "left")
    # One step a projection: what a step finds is worked out once, however often the next one looks at it.
    numbers = range(len(rules))
    none = F.array().cast("array<string>")
    every_match = [F.regexp_extract_all("text", F.lit(r.pattern), F.lit(0)) for r in rules]
    matches = [F.when(F.array_contains("kinds", r.kind), m).otherwise(none) if r.kind in queries else m for r, m in zip(rules, every_match, strict=True)]
    found = every.select("id", "text", *[m.alias(f"_m{k}") for k, m in enumerate(matches)])
    found = found.select("id", *[_steps(r, f"_m{k}").alias(f"_s{k}") for k, r in enumerate(rules)])
    found = found.select("id", *[f"_s{k}" for k in numbers], *[_offsets(F.col(f"_s{k}")).alias(f"_o{k}") for k in numbers])
    parts = [_spans(r, k, F.col(f"_s{k}"), F.col(f"_o{k}")) for k, r in enumerate(rules)]
    return found.select(F.col("id").alias(id_col), F.array_sort(F.concat(*parts)).alias("spans"))


def digests(scanned: DataFrame, base: tuple[Rule, ...] = BASE, id_col: str = "doc_id") -> DataFrame:
    """Counts of the base kinds, a digest of their spans, and all spans as text."""
    kinds = [r.kind for r in base]

    def text(spans: Column) -> Column:
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind: str) -> Column:
        return F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return scanned.select(
        F.col(f"`{id_col}`"),
        *[count(k) for k in kinds],
        F.sha2(text(F.filter("spans", lambda s: s["kind"].isin(kinds))), 256).alias("base_sha256"),
        text(F.col("spans")).alias("spans"),
    )
