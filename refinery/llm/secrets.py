"""Secret scans over a trigram inverted index.

Each rule's regex is turned into a Boolean query over lower-case trigrams. The index holds, for the
trigrams that some rule asks for, the documents that contain them; postings are intersected by
grouping on the document, and a rule's regex runs only on its candidates. Rules without mandatory
trigrams run on every document. Only DataFrame operations.
"""

from __future__ import annotations

import re._constants as sre
import re._parser as sre_parser
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """pattern: where it finds a span. group, least: matches whose group is shorter are dropped."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 1


# The three base rules, then the added ones.
BASE = (
    Rule("assign", r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 16),
    Rule("hex", r"[0-9a-f]{32,}", 0, 32),
)
ADDED = (
    Rule("github", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("google", r"AIza[0-9A-Za-z_-]{35}"),
    Rule("live_key", r"(sk|pk|rk)_(live|test)_[A-Za-z0-9]{16,}"),
    Rule("jwt", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("private_key", r"-----BEGIN [A-Z ]*PRIVATE KEY-----"),
)

#: A query is a set of alternatives, each a set of trigrams that must all occur; the empty alternative always holds.
Query = frozenset[frozenset[str]]
ALWAYS: Query = frozenset([frozenset()])
MOST_STRINGS = 64
#: Items that are gathered in one array before it is put aside.
CHUNK = 256


def _of_strings(strings: frozenset[str]) -> Query:
    grams = [frozenset(s[i : i + 3] for i in range(len(s) - 2)) for s in strings]
    return _least(frozenset(grams))


def _least(q: Query) -> Query:
    return frozenset(a for a in q if not any(b < a for b in q))


def _and(p: Query, q: Query) -> Query:
    return _least(frozenset(a | b for a in p for b in q))


def _walk(items) -> tuple[frozenset[str] | None, Query]:
    """Of a parsed sequence: all strings it can match, lower-cased, if these are few (else None); a query that holds wherever it matches."""
    run: frozenset[str] | None = frozenset([""])
    whole, query = True, ALWAYS
    for op, arg in items:
        exact, sub = _one(op, arg)
        if exact is not None and run is not None and len(run) * len(exact) <= MOST_STRINGS:
            run = frozenset(a + b for a in run for b in exact)
            continue
        whole = False
        if run is not None:
            query = _and(query, _of_strings(run))
        if exact is not None:
            run = exact
        else:
            query, run = _and(query, sub), frozenset([""])
    query = _and(query, _of_strings(run))
    return (run if whole else None), query


def _one(op, arg) -> tuple[frozenset[str] | None, Query]:
    if op is sre.LITERAL:
        return frozenset([chr(arg).lower()]), ALWAYS
    if op is sre.IN:
        chars: set[str] = set()
        for kind, x in arg:
            if kind is sre.LITERAL:
                chars.add(chr(x).lower())
            elif kind is sre.RANGE and x[1] - x[0] < MOST_STRINGS:
                chars.update(chr(c).lower() for c in range(x[0], x[1] + 1))
            else:
                return None, ALWAYS
        return (frozenset(chars), ALWAYS) if len(chars) <= 8 else (None, ALWAYS)
    if op is sre.SUBPATTERN:
        return _walk(arg[3])
    if op is sre.BRANCH:
        parts = [_walk(x) for x in arg[1]]
        query = _least(frozenset(a for exact, q in parts for a in (q if exact is None else _of_strings(exact))))
        if all(exact is not None for exact, _ in parts):
            return frozenset().union(*[exact for exact, _ in parts]), query
        return None, query
    if op in (sre.MAX_REPEAT, sre.MIN_REPEAT):
        least, most, body = arg
        exact, query = _walk(body)
        if (least, most) == (0, 1) and exact is not None:
            return exact | {""}, ALWAYS
        if least == most and exact is not None and len(exact) == 1 and least <= 32:
            return frozenset(s * least for s in exact), ALWAYS
        return None, (query if least else ALWAYS)
    return None, ALWAYS


def trigram_query(pattern: str) -> Query:
    """The Boolean trigram query that every text with a match fulfils; ALWAYS if none is mandatory."""
    exact, query = _walk(sre_parser.parse(pattern))
    return _of_strings(exact) if exact is not None else query


def build_index(docs: DataFrame, trigrams: list[str]) -> DataFrame:
    """Postings (trigram, doc_id) of the lower-cased texts for the given trigrams."""
    low = docs.select("doc_id", F.lower("text").alias("low"))
    found = F.array_compact(F.array(*[F.when(F.contains("low", F.lit(t)), F.lit(t)) for t in trigrams]))
    return low.select(F.explode(found).alias("trigram"), "doc_id")


def candidates(index: DataFrame, rules: list[Rule]) -> DataFrame:
    """(doc_id, kinds): for each document the rules whose query its postings fulfil."""
    terms = [(r.kind, n, t, len(a)) for r in rules for n, a in enumerate(sorted(trigram_query(r.pattern), key=sorted)) for t in sorted(a)]
    structs = [F.struct(*[F.lit(x).alias(c) for c, x in zip(("kind", "alternative", "trigram", "needed"), term)]) for term in terms]
    # The terms come from the rules, never from the data.
    asked = index.sparkSession.range(1).select(F.inline(F.array(*structs)))
    met = index.join(F.broadcast(asked), "trigram").groupBy("doc_id", "kind", "alternative", "needed").agg(F.countDistinct("trigram").alias("n")).where("n = needed")
    return met.groupBy("doc_id").agg(F.collect_set("kind").alias("kinds"))


def _folded(items: Column, start: Column, none: Column, put) -> Column:
    """Goes over an array and gathers what ``put(at, x)`` returns, which is the next ``at`` and what is gathered (null for nothing), from ``start``.

    Appending to an array copies it, so CHUNK items are gathered at a time and the arrays put together at the end.
    """
    chunks = F.when(F.size(items) > 0, F.transform(F.sequence(F.lit(0), F.floor((F.size(items) - 1) / CHUNK).cast("int")), lambda n: F.slice(items, n * CHUNK + 1, F.lit(CHUNK))))

    def one(acc: Column, x: Column) -> Column:
        at, found = put(acc["at"], x)
        return F.struct(at.alias("at"), F.when(found.isNotNull(), F.array_append(acc["out"], found)).otherwise(acc["out"]).alias("out"))

    def chunk(acc: Column, xs: Column) -> Column:
        inner = F.aggregate(xs, F.struct(acc["at"].alias("at"), none.alias("out")), one)
        # One array, so that the inner pass is not made twice.
        return F.aggregate(F.array(inner), acc, lambda before, done: F.struct(done["at"].alias("at"), F.array_append(before["outs"], done["out"]).alias("outs")))

    begin = F.struct(start.alias("at"), F.array_compact(F.array(F.when(F.lit(False), none))).alias("outs"))
    return F.aggregate(F.coalesce(chunks, F.array_compact(F.array(F.when(F.lit(False), items)))), begin, chunk)


def _spans(text: Column, rule: Rule, turn: int) -> Column:
    """array<struct<start, turn, end>> of the rule's matches in code points, end exclusive."""
    pattern = F.lit(rule.pattern)
    gaps = F.transform(F.split(text, rule.pattern, -1), F.length)
    lengths = F.transform(F.regexp_extract_all(text, pattern, F.lit(0)), F.length)
    held = F.transform(F.regexp_extract_all(text, pattern, F.lit(rule.group)), F.length)
    step = F.arrays_zip(gaps.alias("gap"), lengths.alias("size"), held.alias("held"))
    empty = F.expr("cast(array() as array<struct<start: int, turn: int, end: int>>)")

    def put(at: Column, x: Column) -> tuple[Column, Column]:
        start = at + x["gap"]
        end = start + x["size"]
        return end, F.when(x["held"] >= rule.least, F.struct(start.alias("start"), F.lit(turn).alias("turn"), end.alias("end")))

    # One element more than matches: the gap after the last.
    matches = F.filter(step, lambda x: x["size"].isNotNull())
    all_of = F.flatten(_folded(matches, F.lit(0), empty, put)["outs"])
    return F.when(F.regexp_like(text, pattern), all_of).otherwise(empty)


def scan(docs: DataFrame, rules: tuple[Rule, ...] = BASE + ADDED, into: str = "secrets") -> DataFrame:
    """Adds the column ``into`` to docs: array<struct<kind, start, end>> by start, then rule order.

    Matches are leftmost and do not overlap within a rule. Null text is empty, and so is its array.
    Postings name a row by a hash of its doc_id and text, so that null and repeated ids do not gather;
    rows of one hash are equal, or at worst add candidates. Columns of docs are kept, whatever their names;
    one named ``into`` is replaced.
    """
    queries = {r.kind: trigram_query(r.pattern) for r in rules}
    indexed = [r for r in rules if frozenset() not in queries[r.kind]]
    trigrams = sorted({t for r in indexed for a in queries[r.kind] for t in a})
    text = F.coalesce(F.col("text"), F.lit(""))
    key = F.xxhash64("doc_id", "text")
    hits = docs.sparkSession.range(0).select(F.col("id").alias("_id"), F.array(F.lit("")).alias("_kinds"))
    if indexed:
        index = build_index(docs.select(key.alias("doc_id"), text.alias("text")), trigrams)
        hits = candidates(index, indexed).select(F.col("doc_id").alias("_id"), F.col("kinds").alias("_kinds"))
    # The caller's row is one column, so that no name of its clashes.
    rows = docs.select(F.struct(*[f"`{c}`" for c in docs.columns]).alias("_row"), key.alias("_key"), text.alias("_text"))
    joined = rows.join(hits, F.col("_key") == F.col("_id"), "left")
    text = F.col("_text")
    none = F.expr("cast(array() as array<struct<start: int, turn: int, end: int>>)")
    found = [F.when(F.array_contains("_kinds", r.kind), _spans(text, r, n)).otherwise(none) if r in indexed else _spans(text, r, n) for n, r in enumerate(rules)]
    kinds = F.array(*[F.lit(r.kind) for r in rules])
    spans = F.transform(F.array_sort(F.concat(*found)), lambda x: F.struct(F.element_at(kinds, x["turn"] + 1).alias("kind"), x["start"].alias("start"), x["end"].alias("end")))
    kept = [spans.alias(c) if c == into else F.col("_row")[c].alias(c) for c in docs.columns]
    return joined.select(*kept, *([] if into in docs.columns else [spans.alias(into)]))


def listed(spans: Column) -> Column:
    """kind:start:end of each span, comma-joined."""
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")


def redact(text: Column, spans: Column) -> Column:
    """The text with each span (overlaps united) replaced by [SECRET]. Pieces are found in four bytes for each character, so that none is searched for from the text's start."""
    wide = F.encode(text, "UTF-32")
    none = F.expr("cast(array() as array<struct<from: int, size: int>>)")

    def put(at: Column, x: Column) -> tuple[Column, Column]:
        return F.greatest(at, x["end"]), F.when(x["start"] >= at, F.struct(at.alias("from"), (x["start"] - at).alias("size")))

    def cut(acc: Column, done: Column) -> Column:
        pieces = F.transform(F.flatten(done["outs"]), lambda p: F.concat(F.decode(F.substring(acc["wide"], 4 * p["from"] + 1, 4 * p["size"]), "UTF-32"), F.lit("[SECRET]")))
        rest = F.decode(F.substring(acc["wide"], 4 * done["at"] + 1, F.octet_length(acc["wide"])), "UTF-32")
        return F.struct(acc["wide"].alias("wide"), F.concat(F.array_join(pieces, ""), rest).alias("out"))

    # An array of one, so that the wide text is made once.
    whole = F.aggregate(F.array(_folded(spans, F.lit(0), none, put)), F.struct(wide.alias("wide"), F.lit("").alias("out")), cut)["out"]
    return F.when(F.size(spans) > 0, whole).otherwise(text)
