"""Secret scan with a trigram inverted index (operator 12).

Each rule is a regular expression. From its parse tree comes a Boolean query
over trigrams: the strings that a piece of the pattern must contain are listed
(classes and alternatives multiply out, up to ``MAX_STRINGS``); a piece whose
strings all have three characters or more gives a clause "one of these strings
with all its trigrams", and all clauses must hold. Trigrams are of lower-cased
(A-Z) UTF-8 bytes, so a rule in either case asks once.

Documents are indexed by segment: a few megabytes of whole texts (one longer
text alone). A segment's index holds, for every trigram that some rule asks
for, the sorted list of documents that contain it. Each rule intersects and
unites postings; only its candidates are verified by the regular expression,
over their whole text. A rule without mandatory trigrams scans every text.
Segments live inside the scan's own tasks, so nothing is shuffled, a lost
executor repeats its tasks, and memory is bounded by the segment.

Defined cases: null text is empty and has no spans; rows that share a doc_id,
or repeat, are separate; a null doc_id stays null; a long text is searched
whole; spans of different kinds may overlap, those of one kind never; spans are
ordered by start, then by the order of the rules; other columns are ignored,
whatever their names; an empty table gives no rows.
"""

from __future__ import annotations

import re
from re import _constants as c
from re import _parser
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ship_code
from .periodic_runs import segments
from .rolling import lowered, text_bytes

#: strings that one piece of a pattern may expand to
MAX_STRINGS = 64


class Rule(NamedTuple):
    kind: str
    pattern: str
    #: least characters of the matched ``group``; shorter matches are dropped
    least: int = 1
    group: int = 0


def either_case(word: str) -> str:
    return "".join(f"[{x.lower()}{x.upper()}]" if x.isalpha() else x for x in word)


# The three base kinds of the task
_NAMES = "|".join([either_case(x) for x in ("password", "passwd", "secret", "token")] + [either_case("api") + "_?" + either_case("key")])
BASE = [
    Rule("assign", f"({_NAMES})[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 8, 2),
    Rule("access", "AKIA[A-Z0-9]+", 16),
    Rule("hex", "[0-9a-f]+", 32),
]
# Published token formats
ADDED = [
    Rule("private_key", "-----BEGIN [A-Z ]*PRIVATE KEY-----"),
    Rule("github", "gh[pousr]_[A-Za-z0-9]+", 40),
    Rule("slack", "xox[abprs]-[A-Za-z0-9-]+", 15),
    Rule("google", "AIza[A-Za-z0-9_-]+", 39),
    Rule("stripe", "[rs]k_(live|test)_[A-Za-z0-9]+", 24),
    Rule("npm", "npm_[A-Za-z0-9]+", 40),
    Rule("pypi", "pypi-[A-Za-z0-9_-]+", 60),
    Rule("sendgrid", "SG[.][A-Za-z0-9_-]+[.][A-Za-z0-9_-]+", 60),
    Rule("jwt", "eyJ[A-Za-z0-9_-]+[.]eyJ[A-Za-z0-9_-]+[.][A-Za-z0-9_-]+", 40),
    Rule("bearer", either_case("bearer") + "\\x20+([A-Za-z0-9+/_.=-]+)", 20, 1),
    Rule("url_login", "://[A-Za-z0-9._-]+:([^\\x20\\x09-\\x0D/@:]+)@", 4, 1),
]
RULES = BASE + ADDED


# ---------------------------------------------------------------- queries from patterns
def _class_chars(items) -> set | None:
    """The lower-cased characters of a class, or None if it is negated or large."""
    out = set()
    for op, arg in items:
        if op is c.LITERAL:
            out.add(chr(arg))
        elif op is c.RANGE and arg[1] - arg[0] < MAX_STRINGS:
            out.update(chr(x) for x in range(arg[0], arg[1] + 1))
        else:
            return None
    return {_lower(x) for x in out}


def _lower(x: str) -> str:
    return x.lower() if x.isascii() else x


def _strings(op, arg) -> set | None:
    """All strings that one node of the parse tree matches, lower-cased, or None if there are too many."""
    if op is c.LITERAL:
        return {_lower(chr(arg))}
    if op is c.IN:
        return _class_chars(arg)
    if op is c.AT:
        return {""}
    if op is c.SUBPATTERN:
        return _all_strings(arg[3])
    if op is c.BRANCH:
        parts = [_all_strings(x) for x in arg[1]]
        return None if any(p is None for p in parts) else set().union(*parts)
    if op in (c.MAX_REPEAT, c.MIN_REPEAT):
        low, high, inner = arg
        one = _all_strings(inner)
        if one is None or high > MAX_STRINGS:
            return None
        out, power = set(), {""}
        for n in range(high + 1):
            if n >= low:
                out |= power
            power = {a + b for a in power for b in one}
            if len(power) > MAX_STRINGS:
                return None
        return out
    return None


def _all_strings(nodes) -> set | None:
    out = {""}
    for op, arg in nodes:
        more = _strings(op, arg)
        if more is None or len(out) * len(more) > MAX_STRINGS:
            return None
        out = {a + b for a in out for b in more}
    return out


def _trigrams(text: str) -> frozenset:
    raw = text.encode()
    return frozenset(raw[i:i + 3] for i in range(len(raw) - 2))


def _clauses(nodes) -> list:
    """Clauses that must all hold; a clause is a set of alternatives, each a set of trigrams that must all be there."""
    out, have = [], {""}

    def flush():
        if all(len(x.encode()) >= 3 for x in have):
            sets = {_trigrams(x) for x in have}
            out.append(frozenset(x for x in sets if not any(y < x for y in sets)))

    for op, arg in nodes:
        more = _strings(op, arg)
        if more is not None and len(have) * len(more) <= MAX_STRINGS:
            have = {a + b for a in have for b in more}
            continue
        flush()
        have = more if more is not None else {""}
        if more is None and op is c.SUBPATTERN:
            out += _clauses(arg[3])
        elif more is None and op in (c.MAX_REPEAT, c.MIN_REPEAT) and arg[0] > 0:
            out += _clauses(arg[2])
        elif more is None and op is c.BRANCH:
            sides = [_clauses(x) for x in arg[1]]
            if all(sides):  # one clause of each side stands for it
                out.append(frozenset().union(*(max(s, key=lambda clause: -len(clause)) for s in sides)))
    flush()
    return out


def trigram_query(pattern: str) -> list:
    """Clauses of mandatory trigrams of a pattern (see the module's text); empty: every text must be scanned."""
    parsed = _parser.parse(pattern)
    if parsed.state.flags & re.IGNORECASE:
        raise ValueError("write either case as classes")
    return _clauses(parsed)


# ---------------------------------------------------------------- one segment
class SegmentIndex:
    """Postings of the asked trigrams in one segment: for each the sorted documents that have it."""

    def __init__(self, data: np.ndarray, rows: np.ndarray, numbers: np.ndarray, n_trigrams: int):
        self.n = len(rows) - 1
        low = lowered(data).astype(np.int32)
        code = (low[:-2] << 16) | (low[1:-1] << 8) | low[2:] if len(low) > 2 else np.empty(0, np.int32)
        number = numbers[code]
        at = np.flatnonzero(number)
        doc = np.searchsorted(rows, at, side="right") - 1
        inside = at + 3 <= rows[doc + 1]
        pairs = np.unique(number[at[inside]].astype(np.int64) * self.n + doc[inside])
        self.docs = pairs % max(self.n, 1)
        self.bounds = np.searchsorted(pairs, np.arange(n_trigrams + 2) * self.n)

    def postings(self, number: int) -> np.ndarray:
        return self.docs[self.bounds[number]:self.bounds[number + 1]]

    def candidates(self, query) -> np.ndarray:
        """Documents of a query (clauses of alternatives of trigram numbers); all of them for an empty query."""
        out = np.arange(self.n)
        for clause in query:
            found = np.empty(0, np.int64)
            for alternative in clause:
                part = out
                for number in alternative:
                    part = np.intersect1d(part, self.postings(number), assume_unique=True)
                found = np.union1d(found, part)
            out = found
        return out


def spans(rule: Rule, pattern: re.Pattern, text: str) -> list:
    """(start, end) of the leftmost non-overlapping matches whose group is long enough, in code points."""
    return [m.span() for m in pattern.finditer(text) if len(m.group(rule.group)) >= rule.least]


_OUT = pa.schema([("doc_id", pa.int64()), ("spans", pa.list_(pa.struct([("start", pa.int64()), ("rule", pa.int32()),
                                                                       ("kind", pa.string()), ("end", pa.int64())])))])
_OUT_SQL = "doc_id long, spans array<struct<start:long,rule:int,kind:string,end:long>>"


def _scan(rules):
    queries = [trigram_query(r.pattern) for r in rules]
    asked = sorted({t for q in queries for clause in q for alternative in clause for t in alternative})

    def run(batches):
        number_of = {t: i + 1 for i, t in enumerate(asked)}
        numbers = np.zeros(1 << 24, np.int16 if len(asked) < 1 << 15 else np.int32)
        for t, i in number_of.items():
            numbers[t[0] << 16 | t[1] << 8 | t[2]] = i
        numbered = [[[[number_of[t] for t in alternative] for alternative in clause] for clause in q] for q in queries]
        patterns = [re.compile(r.pattern) for r in rules]
        for batch in segments(batches):
            column = batch.column("text")
            index = SegmentIndex(*text_bytes(column), numbers, len(asked))
            texts: dict = {}
            found = [[] for _ in range(batch.num_rows)]
            for i, (rule, pattern, query) in enumerate(zip(rules, patterns, numbered)):
                for doc in index.candidates(query).tolist():
                    if doc not in texts:
                        texts[doc] = column[doc].as_py()
                    for start, end in spans(rule, pattern, texts[doc]):
                        found[doc].append((start, i, rule.kind, end))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(
                [[dict(zip(("start", "rule", "kind", "end"), x)) for x in sorted(f)] for f in found],
                _OUT.field("spans").type)], schema=_OUT)
    return run


def scan(docs: DataFrame, rules=None, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Columns doc_id and spans (start, rule, kind, end; rule: its place in ``rules``), ordered by start, then rule."""
    rules = [Rule(*r) for r in (RULES if rules is None else rules)]
    ship_code(docs.sparkSession)
    docs = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"))
    return docs.mapInArrow(_scan(rules), _OUT_SQL)


def listed(spans_column, kinds=None):
    """``kind:start:end`` of the spans, comma-joined, of the given kinds or all."""
    chosen = spans_column if kinds is None else F.filter(spans_column, lambda s: s.kind.isin(*kinds))
    return F.array_join(F.transform(chosen, lambda s: F.concat_ws(":", s.kind, s.start.cast("string"), s.end.cast("string"))), ",")
