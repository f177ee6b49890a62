"""Secret scan through a trigram inverted index.

Each rule's regex is turned into a Boolean query over trigrams that every match must contain. The
texts of a batch are indexed by block: postings say which texts hold a trigram. A rule's regex runs
only over the texts that satisfy its query; a rule without a mandatory trigram runs over all.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence
from dataclasses import dataclass
from functools import cached_property
from re import _constants as op
from re import _parser as parser

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barograph.llm.common import by_batch, documents, rows_to_batch, slices, utf8


@dataclass(frozen=True)
class Rule:
    """A kind of secret. Matches are leftmost and do not overlap; a match whose ``group`` has fewer
    than ``least`` characters is dropped after matching. Letters are ASCII, also without case."""

    kind: str
    pattern: str
    least: int = 0
    group: int = 0
    any_case: bool = False

    @cached_property
    def regex(self) -> re.Pattern:
        return re.compile(self.pattern, re.ASCII | (re.IGNORECASE if self.any_case else 0))

    def spans(self, text: str) -> list[tuple[int, int]]:
        least, group = self.least, self.group
        return [m.span() for m in self.regex.finditer(text) if len(m[group]) >= least]


BASE_RULES = (
    Rule(
        "assign",
        "(password|passwd|secret|token|api_?key)[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)",
        least=6,
        group=2,
        any_case=True,
    ),
    Rule("access", "AKIA[A-Z0-9]+", least=20),
    Rule("hex", "[0-9a-f]{24,}"),
)
MORE_RULES = (
    Rule("private_key", "-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("code_host", "gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat", "xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("web_token", "eyJ[A-Za-z0-9_-]{10,}\\.eyJ[A-Za-z0-9_-]{10,}\\.[A-Za-z0-9_-]{10,}"),
    Rule("url_login", "://[^\\s/:@]+:[^\\s/@]+@"),
)
RULES = BASE_RULES + MORE_RULES

# ---------------------------------------------------------------- queries

#: A query is True (no condition), a trigram, or ("and" | "or", queries).
Query = bool | bytes | tuple
_MOST_STRINGS = 64


def all_of(queries: Iterable[Query]) -> Query:
    parts = {q for q in queries if q is not True}
    return ("and", frozenset(parts)) if len(parts) > 1 else parts.pop() if parts else True


def any_of(queries: Iterable[Query]) -> Query:
    parts = set(queries)
    if True in parts:
        return True
    return ("or", frozenset(parts)) if len(parts) > 1 else parts.pop() if parts else True


def trigrams_of(strings: Iterable[str]) -> Query:
    """What a text holds that holds one of the strings, all in lower case."""
    encoded = [s.encode() for s in strings]
    return any_of(all_of(s[i : i + 3] for i in range(len(s) - 2)) for s in encoded)


def lowered(code: int) -> str:
    char = chr(code)
    return char.lower() if char.isascii() else char


def members(items: Sequence) -> set[str] | None:
    """The characters of a small class, or None."""
    out: set[str] = set()
    for kind, value in items:
        if kind is op.LITERAL:
            out.add(lowered(value))
        elif kind is op.RANGE and value[1] - value[0] < 4:
            out |= {lowered(x) for x in range(value[0], value[1] + 1)}
        else:
            return None
    return out if len(out) <= 6 else None


def analysed(sequence: Iterable) -> tuple[set[str] | None, Query]:
    """(all strings it can match, or None; a query that holds for every match)."""
    strings: set[str] = {""}
    exact = True
    conditions: list[Query] = []

    def cut(condition: Query = True) -> None:
        nonlocal strings, exact
        conditions.extend((trigrams_of(strings), condition))
        strings, exact = {""}, False

    def extend(more: set[str]) -> None:
        nonlocal strings, exact
        if len(strings) * len(more) > _MOST_STRINGS:
            conditions.append(trigrams_of(strings))
            strings, exact = {""}, False
        if len(more) > _MOST_STRINGS:
            cut(trigrams_of(more))
        else:
            strings = {a + b for a in strings for b in more}

    for kind, value in sequence:
        if kind is op.LITERAL:
            extend({lowered(value)})
        elif kind is op.IN and (found := members(value)):
            extend(found)
        elif kind is op.SUBPATTERN:
            inner, condition = analysed(value[3])
            extend(inner) if inner is not None else cut(condition)
        elif kind is op.BRANCH:
            found = [analysed(branch) for branch in value[1]]
            if all(inner is not None for inner, _ in found):
                extend(set().union(*[inner for inner, _ in found]))
            else:
                cut(any_of(condition for _, condition in found))
        elif kind in (op.MAX_REPEAT, op.MIN_REPEAT, op.POSSESSIVE_REPEAT):
            low, high, body = value
            inner, condition = analysed(body)
            if (low, high) == (0, 1) and inner is not None:
                extend(inner | {""})
            elif low == 0:
                cut()
            elif inner is not None and low == high and len(inner) == 1:
                extend({next(iter(inner)) * low})
            else:
                cut(trigrams_of(inner) if inner is not None else condition)
        elif kind is op.AT or kind in (op.ASSERT, op.ASSERT_NOT):
            continue
        else:  # any other element: something that is not known
            cut()
    if exact:
        return strings, trigrams_of(strings)
    return None, all_of([*conditions, trigrams_of(strings)])


def query_of(rule: Rule) -> Query:
    """The Boolean trigram query of a rule's regex, over texts with ASCII letters in lower case."""
    return analysed(parser.parse(rule.pattern))[1]


def mentioned(query: Query) -> set[bytes]:
    if isinstance(query, bytes):
        return {query}
    return set().union(*map(mentioned, query[1])) if isinstance(query, tuple) else set()


def answered(query: Query, postings: dict[bytes, np.ndarray], n: int) -> np.ndarray:
    """Which of n texts satisfy a query."""
    if query is True:
        return np.ones(n, bool)
    if isinstance(query, bytes):
        return postings[query]
    parts = [answered(q, postings, n) for q in query[1]]
    return (np.logical_and if query[0] == "and" else np.logical_or).reduce(parts)


# ---------------------------------------------------------------- index and scan

#: Text bytes indexed as one block.
BLOCK = 4_000_000


class Scanner:
    """The rules of one task with their queries and the table of wanted trigrams."""

    def __init__(self, rules: Sequence[Rule]):
        self.rules = rules
        self.queries = [query_of(rule) for rule in rules]
        self.wanted = sorted(set().union(*map(mentioned, self.queries)))
        self.codes = np.array([int.from_bytes(trigram, "big") for trigram in self.wanted], np.uint32)
        self.starts = np.zeros(1 << 16, bool)  # the first two bytes of wanted trigrams
        self.starts[self.codes >> 8] = True

    def postings(self, texts: Sequence[bytes]) -> dict[bytes, np.ndarray]:
        """For each wanted trigram, which texts hold it in any case."""
        n = len(texts)
        held = np.zeros((len(self.wanted), n), bool)
        block = np.frombuffer(b"\0\0".join(texts).lower(), np.uint8)
        if len(block) > 2 and len(self.codes):
            pairs = block[:-2].astype(np.uint16)
            pairs <<= 8
            pairs |= block[1:-1]
            at = np.flatnonzero(self.starts[pairs])
            codes = (pairs[at].astype(np.uint32) << 8) | block[at + 2]
            number = np.minimum(np.searchsorted(self.codes, codes), len(self.codes) - 1)
            wanted = self.codes[number] == codes
            ends = np.cumsum(np.fromiter((len(t) + 2 for t in texts), np.int64, n))
            held[number[wanted], np.searchsorted(ends, at[wanted], "right")] = True
        return dict(zip(self.wanted, held, strict=True))

    def scan(self, texts: Sequence[str], encoded: Sequence[bytes]) -> list[list[tuple[int, int, int]]]:
        """(start, rule number, end) of each text, in this order."""
        out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
        for first, last in slices(encoded, BLOCK):
            postings = self.postings(encoded[first:last])
            for k, (rule, query) in enumerate(zip(self.rules, self.queries, strict=True)):
                for i in np.flatnonzero(answered(query, postings, last - first)) + first:
                    out[i] += [(start, k, end) for start, end in rule.spans(texts[i])]
        return [sorted(found) for found in out]


def scan(
    docs: DataFrame, rules: Sequence[Rule] = RULES, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """(doc_id, spans): spans by start, then by the order of the rules, in code points with the end
    excluded. Row by row: a null or empty text has no spans, repeated rows and null ids stay, other
    columns are not read, no rows give no rows."""
    span = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
    schema = pa.schema([("doc_id", pa.int64()), ("spans", pa.list_(span))])

    def make():
        scanner = Scanner(rules)

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            texts = [text or "" for text in batch.column("text").to_pylist()]
            encoded = [text or b"" for text in utf8(batch.column("text"))]
            found = [
                [{"kind": rules[k].kind, "start": start, "end": end} for start, k, end in row]
                for row in scanner.scan(texts, encoded)
            ]
            return rows_to_batch(schema, [batch.column("doc_id"), found])

        return step

    return by_batch(
        documents(docs, id_col, text_col),
        make,
        "doc_id long, spans array<struct<kind: string, start: long, end: long>>",
    )


def redacted(
    docs: DataFrame, rules: Sequence[Rule] = RULES, marker: str = "[secret]", text_col: str = "text"
) -> DataFrame:
    """The same rows and columns with every span of the texts replaced by a marker; spans that
    overlap are one. A null text stays null."""
    fields = docs.schema
    at = docs.columns.index(text_col)

    def make():
        scanner = Scanner(rules)

        def clean(text: str, spans: list[tuple[int, int, int]]) -> str:
            parts, done = [], 0
            for start, _, end in spans:
                if start >= done:
                    parts += (text[done:start], marker)
                done = max(done, end)
            return "".join(parts) + text[done:]

        def step(batch: pa.RecordBatch) -> pa.RecordBatch:
            column = batch.column(at)
            texts = column.to_pylist()
            found = scanner.scan([t or "" for t in texts], [t or b"" for t in utf8(column)])
            new = [clean(t, f) if f else t for t, f in zip(texts, found, strict=True)]
            arrays = list(batch.columns)
            arrays[at] = pa.array(new, column.type)
            return pa.RecordBatch.from_arrays(arrays, schema=batch.schema)

        return step

    return by_batch(docs, make, fields)


def digests(scanned: DataFrame, base: Sequence[Rule] = BASE_RULES) -> DataFrame:
    """Counts per base kind, the digest of the base spans and the list of all spans."""

    def listed(spans: Column) -> Column:
        return F.array_join(
            F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
        )

    def of_kinds(*kinds: str) -> Column:
        return F.filter("spans", lambda s: s["kind"].isin(*kinds))

    kinds = [rule.kind for rule in base]
    return scanned.select(
        "doc_id",
        *[
            F.size(of_kinds(kind)).cast("long").alias(f"n_{kind}")
            for kind in kinds
        ],
        F.sha2(listed(of_kinds(*kinds)).cast("binary"), 256).alias("base_sha256"),
        listed(F.col("spans")).alias("spans"),
    )
