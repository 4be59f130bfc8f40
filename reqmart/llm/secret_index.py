"""Scan texts for secrets with a trigram inverted index.

From each rule's regular expression a Boolean query over trigrams is derived that every matching text satisfies. A
task indexes a block of texts: postings, the texts of each trigram that any rule asks for, are intersected and united
by the queries, and only the texts left are matched against the expression. A rule whose expression has no mandatory
trigram is matched against all texts. Trigrams are bytes of the text with A to Z in lower case, so one index serves
rules of either case. Whole texts are indexed and matched; nothing is shuffled.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import product
from re import _constants as op, _parser as parser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from reqmart.llm.text_bytes import LOWER

#: Bytes of text that a block of the index holds, or one text if it is longer.
BLOCK_BYTES = 4_000_000
#: Strings that are spelled out for one part of an expression; a part with more counts as unknown.
MOST_STRINGS = 64

SPANS = "doc_id long, spans array<struct<kind:string,start:long,end:long>>"


@dataclass(frozen=True)
class Rule:
    """What to find: matches of ``pattern`` whose ``group`` has at least ``least`` characters."""

    kind: str
    pattern: str
    group: int = 0
    least: int = 0


# The kinds that every scan reports, in the order in which they are listed.
BASE_RULES = (
    Rule(
        "assign",
        r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        group=2,
        least=8,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", least=16),
    Rule("hex", r"[0-9a-f]{32,}"),
)
RULES = (
    *BASE_RULES,
    Rule("private_key", r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----"),
    Rule("code_host", r"gh[opsur]_[A-Za-z0-9]{36,}"),
    Rule("chat", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("cloud", r"AIza[A-Za-z0-9_-]{35}"),
    Rule("payment", r"[rs]k_live_[A-Za-z0-9]{16,}"),
    Rule("web_token", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("bearer", r"(?ai:bearer)\x20[A-Za-z0-9._~+/-]{16,}"),
)


@dataclass(frozen=True)
class All:
    parts: tuple


@dataclass(frozen=True)
class Any:
    parts: tuple


def trigram_query(pattern: str):
    """The query that every text with a match satisfies: bytes, All, Any, or None if nothing is mandatory."""
    exact, query = _sequence(parser.parse(pattern))
    return _both([query, _spelled(exact)])


def _both(queries: list):
    parts = tuple(q for q in queries if q is not None)
    return All(parts) if len(parts) > 1 else parts[0] if parts else None


def _spelled(strings: set[bytes] | None):
    """Every trigram of one of the strings; None if one of them has none."""
    if not strings or any(len(s) < 3 for s in strings):
        return None
    options = tuple(
        _both([s[i : i + 3] for i in range(len(s) - 2)]) for s in sorted(strings)
    )
    return Any(options) if len(options) > 1 else options[0]


def _sequence(nodes) -> tuple[set[bytes] | None, object]:
    """All strings the nodes can match, if they are few, or else None and a query."""
    strings, queries, whole = {b""}, [], True
    for kind, value in nodes:
        own, query = _node(kind, value)
        queries.append(query)
        if own is not None and len(own) * len(strings) <= MOST_STRINGS:
            strings = {a + b for a, b in product(strings, own)}
        else:
            queries.append(_spelled(strings))
            if own is not None:
                queries.append(_spelled(own))
            strings, whole = {b""}, False
        if kind in (op.MAX_REPEAT, op.MIN_REPEAT) and value[0] != value[1] and own is not None and value[0] > 0:
            # At least so often: what precedes joins the first of them, what follows an unknown one.
            queries.append(_spelled(strings))
            strings, whole = {b""}, False
    if whole:
        return strings, _both(queries)
    return None, _both([*queries, _spelled(strings)])


def _node(kind, value) -> tuple[set[bytes] | None, object]:
    if kind is op.LITERAL:
        return {_lower(value)}, None
    if kind is op.IN:
        return _characters(value), None
    if kind is op.SUBPATTERN:
        return _sequence(value[-1])
    if kind is op.BRANCH:
        options = [_sequence(option) for option in value[1]]
        if all(own is not None for own, _ in options):
            return set().union(*(own for own, _ in options)), None
        queries = [_both([query, _spelled(own)]) for own, query in options]
        return None, None if None in queries else Any(tuple(queries))
    if kind in (op.MAX_REPEAT, op.MIN_REPEAT):
        least, most, what = value
        own, query = _sequence(what)
        if own is not None and (least, most) == (0, 1):
            return own | {b""}, None
        if least == 0 or own is None:
            return None, query if least else None
        repeated = own
        for _ in range(least - 1):
            if len(repeated) * len(own) > MOST_STRINGS:
                return None, _spelled(repeated)
            repeated = {a + b for a, b in product(repeated, own)}
        return repeated, None
    if kind is op.AT:
        return {b""}, None
    return None, None  # any character, negated sets, look-around: nothing is known


def _lower(code: int) -> bytes:
    return chr(code).encode("utf-8", "surrogatepass").translate(LOWER)


def _characters(items) -> set[bytes] | None:
    found: set[bytes] = set()
    for kind, value in items:
        if kind is op.LITERAL:
            found.add(_lower(value))
        elif kind is op.RANGE and value[1] - value[0] < MOST_STRINGS:
            found.update(map(_lower, range(value[0], value[1] + 1)))
        else:
            return None
    return found if len(found) <= 8 else None


def mandatory(query) -> set[bytes]:
    """All trigrams the query asks for."""
    if query is None:
        return set()
    return {query} if isinstance(query, bytes) else set().union(*map(mandatory, query.parts))


class TrigramIndex:
    """Postings of the given trigrams over a block of texts."""

    def __init__(self, texts: list[bytes], trigrams: list[bytes], table: np.ndarray):
        self.n = len(texts)
        # A byte that no text has keeps trigrams from crossing into the next one.
        blob = np.frombuffer(b"\xff".join([*texts, b"\xff\xff"]).translate(LOWER), dtype=np.uint8)
        codes = blob[:-2].astype(np.int32) << 16
        codes |= blob[1:-1].astype(np.int32) << 8
        codes |= blob[2:]
        found = table[codes]
        at = np.flatnonzero(found)
        ends = np.cumsum([len(t) + 1 for t in texts])
        pairs = np.unique(found[at].astype(np.int64) * (self.n + 1) + np.searchsorted(ends, at, side="right"))
        which, owners = np.divmod(pairs, self.n + 1)
        edges = np.searchsorted(which, np.arange(1, len(trigrams) + 2))
        self.postings = {t: owners[edges[i] : edges[i + 1]] for i, t in enumerate(trigrams)}

    def candidates(self, query) -> np.ndarray:
        """Places of the texts that satisfy the query."""
        if query is None:
            return np.arange(self.n)
        if isinstance(query, bytes):
            return self.postings[query]
        lists = sorted(map(self.candidates, query.parts), key=len)
        found = lists[0]
        for other in lists[1:]:
            join = np.intersect1d if isinstance(query, All) else np.union1d
            found = join(found, other)
        return found


def blocks(texts: list[str]) -> Iterator[tuple[int, list[bytes]]]:
    """The texts as bytes, a few megabytes at a time, with the place of the first."""
    start, block, size = 0, [], 0
    for i, text in enumerate(texts):
        encoded = text.encode("utf-8", "surrogatepass")
        if block and size + len(encoded) > BLOCK_BYTES:
            yield start, block
            start, block, size = i, [], 0
        block.append(encoded)
        size += len(encoded)
    if block:
        yield start, block


def matches(rule: Rule, expression: re.Pattern, text: str) -> Iterator[tuple[int, int]]:
    for m in expression.finditer(text):
        if len(m[rule.group]) >= rule.least:
            yield m.start(), m.end()


def find_secrets(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """doc_id and spans (kind, start, end in code points, the end exclusive) per document, by start, then in the
    rules' order.

    ``docs`` has doc_id and text; no other column is read. Matches of one rule are the leftmost that don't overlap;
    those of different rules may. Null and empty texts have no spans. Repeated rows are scanned alike; a null id stays
    null.
    """
    queries = [trigram_query(r.pattern) for r in rules]
    trigrams = sorted(set().union(*map(mandatory, queries)))

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(1 << 24, dtype=np.uint16)
        for i, trigram in enumerate(trigrams):
            table[int.from_bytes(trigram, "big")] = i + 1
        expressions = [re.compile(r.pattern) for r in rules]
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            found: list[list[tuple]] = [[] for _ in texts]
            for start, block in blocks(texts):
                index = TrigramIndex(block, trigrams, table)
                for place, (rule, query, expression) in enumerate(zip(rules, queries, expressions)):
                    for i in index.candidates(query).tolist():
                        found[start + i] += [
                            (s, place, e) for s, e in matches(rule, expression, texts[start + i])
                        ]
            spans = [[{"kind": rules[p].kind, "start": s, "end": e} for s, p, e in sorted(f)] for f in found]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, SPAN_TYPE)], names=["doc_id", "spans"])

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(scan, SPANS)


SPAN_TYPE = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
