"""Secret scan behind a trigram index.

From each rule's regular expression a Boolean query over trigrams is derived: a
set of alternatives, each a set of trigrams that any match must contain.  The
index holds postings of the trigrams that occur in queries; intersecting them
gives the candidate texts of a rule, which its expression then verifies.  A rule
without mandatory trigrams scans all texts.

Everything that touches texts is a DataFrame function.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from itertools import product
from re import _constants as C, _parser as parser

from pyspark.sql import Column, DataFrame, functions as F

from strata.llm.common import null_as_empty

MOST_STRINGS = 64        # literal strings that a sequence may expand to

Query = frozenset        # of frozensets of trigrams: any of them, all of its trigrams
EVERY: Query = frozenset([frozenset()])


@dataclass(frozen=True)
class Rule:
    """``group`` of a match must have ``least`` characters, else it is dropped."""
    kind: str
    pattern: str
    group: int = 0
    least: int = 1


# The three kinds that are always reported, in their order.
BASE = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 16),
    Rule("hex", r"[0-9a-f]{32,}"),       # the runs of [0-9a-f]+ with 32 characters or more
)
MORE = (
    Rule("private_key", r"-----BEGIN [A-Z ]{0,20}PRIVATE KEY-----"),
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,255}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
)
RULES = BASE + MORE


# ------------------------------------------------------------ trigram queries
def _either(a: Query, b: Query) -> Query:
    return _shortest(a | b)


def _both(a: Query, b: Query) -> Query:
    return _shortest(frozenset(x | y for x, y in product(a, b)))


def _shortest(q: Query) -> Query:
    """An alternative that asks for more than another one adds nothing."""
    return frozenset(x for x in q if not any(y < x for y in q))


def _of_strings(strings: frozenset[str]) -> Query:
    return _shortest(frozenset(frozenset(s[i:i + 3] for i in range(len(s) - 2)) for s in strings))


def _letters(items) -> frozenset[str] | None:
    """The characters of a class, lowered, if they are few."""
    out: set[str] = set()
    for op, value in items:
        if op is C.LITERAL:
            out.add(chr(value).lower())
        elif op is C.RANGE and value[1] - value[0] < 8:
            out |= {chr(c).lower() for c in range(value[0], value[1] + 1)}
        else:
            return None
    return frozenset(out) if len(out) <= 8 else None


def _derive(nodes) -> tuple[frozenset[str] | None, Query]:
    """(all strings of a sequence if they are few, query of the others)."""
    query, run = EVERY, frozenset([""])
    exact = True
    for op, value in nodes:
        strings, inner = None, EVERY
        if op is C.LITERAL:
            strings = frozenset([chr(value).lower()])
        elif op is C.IN:
            strings = _letters(value)
        elif op is C.SUBPATTERN:
            strings, inner = _derive(value[-1])
        elif op is C.BRANCH:
            parts = [_derive(p) for p in value[1]]
            if all(s is not None for s, _ in parts):
                strings = frozenset().union(*(s for s, _ in parts))
            else:
                inner = frozenset().union(*(q if s is None else _of_strings(s) for s, q in parts))
        elif op in (C.MAX_REPEAT, C.MIN_REPEAT, C.POSSESSIVE_REPEAT):
            low, high, body = value
            strings, inner = _derive(body)
            if strings is not None and high == 1:
                strings = strings | {""} if low == 0 else strings
            elif low == 0:
                strings, inner = None, EVERY
            elif strings is not None:
                # at least `low` in a row, then the sequence goes on elsewhere
                run = frozenset(a + b for a, b in product(run, strings)) if len(run) * len(strings) <= MOST_STRINGS else run
                strings = None
        elif op is C.AT:
            continue
        if strings is not None and len(run) * len(strings) <= MOST_STRINGS:
            run = frozenset(a + b for a, b in product(run, strings))
            continue
        query = _both(query, _of_strings(run))
        query = _both(query, inner if strings is None else _of_strings(strings))
        run, exact = frozenset([""]), False
    if exact:
        return run, EVERY
    return None, _both(query, _of_strings(run))


def trigram_query(pattern: str) -> Query:
    """Trigrams, in lower case, that a match's lowered text must contain."""
    strings, query = _derive(parser.parse(pattern))
    return _of_strings(strings) if strings is not None else query


# ------------------------------------------------------------ index and scan
def postings(texts: DataFrame, trigrams: list[str], text_col: str = "text") -> DataFrame:
    """(trigram, text_key) for every listed trigram that a text contains."""
    low = F.lower(null_as_empty(text_col))
    held = F.filter(F.array(*[F.when(F.contains("low", F.lit(g)), F.lit(g)) for g in trigrams]), lambda g: g.isNotNull())
    return (texts.select(text_key(text_col).alias("text_key"), low.alias("low"))
            .select("text_key", F.explode(held).alias("trigram")))


def text_key(text_col: str = "text") -> Column:
    """Equal texts share candidates; a collision only adds one to verify."""
    return F.xxhash64(null_as_empty(text_col))


def candidates(index: DataFrame, queries: dict[str, Query]) -> DataFrame:
    """(text_key, kinds): the rules whose query the postings of a text meet."""
    every = lambda alt: F.size(F.array_except(F.array(*map(F.lit, sorted(alt))), "held")) == 0

    def meets(q: Query) -> Column:
        out = F.lit(False)
        for alt in sorted(map(sorted, q)):
            out = out | every(alt)
        return out

    held = index.groupBy("text_key").agg(F.collect_set("trigram").alias("held"))
    kinds = F.filter(F.array(*[F.when(meets(q), F.lit(k)) for k, q in queries.items()]), lambda k: k.isNotNull())
    return held.select("text_key", kinds.alias("kinds")).where(F.size("kinds") > 0)


def spans_of(rule: Rule, order: int, text: str) -> Column:
    """Spans of a rule's matches in a text column: the text between matches and
    the matches themselves, in turn, give the code point offsets."""
    pattern = F.lit(rule.pattern)
    parts = F.zip_with(
        F.zip_with(F.split(text, rule.pattern, -1), F.regexp_extract_all(text, pattern, F.lit(0)),
                   lambda gap, m: F.struct(F.char_length(gap).alias("gap"), F.char_length(m).alias("size"))),
        F.regexp_extract_all(text, pattern, F.lit(rule.group)),
        lambda p, g: F.struct(p["gap"].alias("gap"), p["size"].alias("size"), F.char_length(g).alias("value")))
    nothing = F.array().cast(SPANS)

    def step(acc, p):
        start = acc["at"] + p["gap"]
        end = start + p["size"]
        span = F.struct(start.alias("start"), F.lit(order).alias("order"), end.alias("end"), F.lit(rule.kind).alias("kind"))
        # the text after the last match has no match of its own
        found = F.when(p["value"] >= rule.least, F.concat(acc["spans"], F.array(span))).otherwise(acc["spans"])
        return F.struct(F.coalesce(end, acc["at"]).alias("at"), found.alias("spans"))

    walked = F.aggregate(parts, F.struct(F.lit(0).alias("at"), nothing.alias("spans")), step)["spans"]
    return F.when(F.col(text).rlike(rule.pattern), walked).otherwise(nothing)


SPANS = "array<struct<start:int,order:int,end:int,kind:string>>"


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES, text_col: str = "text") -> DataFrame:
    """docs plus ``secrets``: spans (start, order, end, kind), code points, end
    exclusive, by start, then the order of the rules.

    Per rule leftmost matches that don't overlap.  Null and empty texts have
    none; repeated rows are ordinary; a column named secrets is replaced."""
    queries = {r.kind: trigram_query(r.pattern) for r in rules}
    indexed = {k: q for k, q in queries.items() if q != EVERY}
    keep = [c for c in docs.columns if c != "secrets"]
    rows = docs.select(F.struct(*keep).alias("row"), null_as_empty(text_col).alias("text"), text_key(text_col).alias("text_key"))
    if indexed:
        trigrams = sorted({g for q in indexed.values() for alt in q for g in alt})
        rows = rows.join(candidates(postings(docs, trigrams, text_col), indexed), "text_key", "left")
    else:
        rows = rows.withColumn("kinds", F.lit(None).cast("array<string>"))
    nothing = F.array().cast(SPANS)
    found = [spans_of(r, i, "text") if r.kind not in indexed
             else F.when(F.array_contains("kinds", r.kind), spans_of(r, i, "text")).otherwise(nothing)
             for i, r in enumerate(rules)]
    return rows.select("row.*", F.array_sort(F.concat(*found)).alias("secrets"))


def digest_columns(spans: str = "secrets") -> dict[str, Column]:
    base = F.filter(spans, lambda s: s["order"] < len(BASE))
    text = lambda a: F.array_join(F.transform(a, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    counts = {f"n_{r.kind}": F.size(F.filter(base, lambda s: s["kind"] == r.kind)).cast("long") for r in BASE}
    return counts | {"base_sha256": F.sha2(text(base).cast("binary"), 256), "spans": text(F.col(spans))}


def oracle_sql() -> str:
    """DuckDB SQL for the digest columns of ``scan`` over documents: every rule
    by a full scan, without the index."""
    quoted = lambda p: "'" + p.replace("'", "''") + "'"
    per_rule = "\nUNION ALL ".join(f"""
        SELECT row_id, {i} AS ord, '{r.kind}' AS kind, {r.least} AS least,
               list_transform(string_split_regex(text, {quoted(r.pattern)}), lambda s: length(s)) AS gaps,
               list_transform(regexp_extract_all(text, {quoted(r.pattern)}, 0), lambda s: length(s)) AS sizes,
               list_transform(regexp_extract_all(text, {quoted(r.pattern)}, {r.group}), lambda s: length(s)) AS vals
        FROM d WHERE regexp_matches(text, {quoted(r.pattern)})""" for i, r in enumerate(RULES))
    counts = ",\n".join(f"count(*) FILTER (ord = {i}) AS n_{r.kind}" for i, r in enumerate(BASE))
    return f"""
    WITH d AS (SELECT row_number() OVER () AS row_id, doc_id, coalesce(text, '') AS text FROM documents),
    m AS ({per_rule}),
    e AS (SELECT *, unnest(range(1, len(sizes) + 1)) AS i FROM m),
    s AS (SELECT row_id, ord, kind,
                 list_sum(gaps[1:i]) + coalesce(list_sum(sizes[1:i - 1]), 0) AS start_at, sizes[i] AS size
          FROM e WHERE vals[i] >= least),
    g AS (SELECT row_id, {counts},
                 string_agg(kind || ':' || start_at::BIGINT || ':' || (start_at + size)::BIGINT, ','
                            ORDER BY start_at, ord) FILTER (ord < {len(BASE)}) AS base,
                 string_agg(kind || ':' || start_at::BIGINT || ':' || (start_at + size)::BIGINT, ','
                            ORDER BY start_at, ord) AS spans
          FROM s GROUP BY row_id)
    SELECT doc_id, {', '.join(f'coalesce(n_{r.kind}, 0) AS n_{r.kind}' for r in BASE)},
           sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
    FROM d LEFT JOIN g USING (row_id)"""
