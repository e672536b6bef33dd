"""Secret scans over a trigram inverted index.

Every rule's regular expression is turned into a Boolean query over trigrams that any match
must contain. A segment of documents gets an inverted index: for each trigram that some query
names, the posting of documents that hold it, found in a few array passes over the segment's
bytes. Queries intersect and unite postings; only candidates are verified by the expression
itself. A rule without a mandatory trigram scans every document.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from dataclasses import dataclass
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerwide.llm.words import text_slices

MASK = "[REDACTED]"
MOST_WAYS = 64  # literal alternatives a query spells out before it gives a part up


@dataclass(frozen=True)
class Rule:
    """A kind of secret; ``valid`` may turn a match down, after which none is tried inside it."""

    kind: str
    pattern: str
    valid: Callable[[re.Match], bool] = lambda m: True
    any_case: bool = False

    def compiled(self) -> re.Pattern:
        return re.compile(self.pattern, re.ASCII | (re.IGNORECASE if self.any_case else 0))


#: The kinds and patterns that results name, in this order; further kinds follow.
BASE = (
    Rule(
        "assign",
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        lambda m: len(m[2]) >= 6,
        any_case=True,
    ),
    Rule("access", r"AKIA[A-Z0-9]+", lambda m: len(m[0]) >= 20),
    Rule("hex", r"[0-9a-f]{24,}"),  # greedy, so these are whole runs
)
MORE = (
    Rule("github", r"\bgh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("slack", r"\bxox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("jwt", r"\beyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("pem", r"-----BEGIN (?:[A-Z]+ )*PRIVATE KEY-----"),
)
RULES = BASE + MORE

Query = tuple  # ("all",) | ("tri", code) | ("and", ...) | ("or", ...)
ALL: Query = ("all",)


def _code(text: str) -> int:
    a, b, c = text.encode()
    return a << 16 | b << 8 | c


def _both(parts: list[Query]) -> Query:
    parts = list(dict.fromkeys(p for p in parts if p != ALL))
    return ALL if not parts else parts[0] if len(parts) == 1 else ("and", *parts)


def _either(parts: list[Query]) -> Query:
    parts = list(dict.fromkeys(parts))
    return ALL if ALL in parts else parts[0] if len(parts) == 1 else ("or", *parts)


def _of_literals(ways: set[str]) -> Query:
    """What a text that contains one of ``ways`` must hold."""
    each = []
    for way in sorted(ways):
        way = way.lower()
        each.append(_both([("tri", _code(way[k : k + 3])) for k in range(len(way) - 2) if way.isascii()]))
    return _either(each)


def trigram_query(pattern: str) -> Query:
    """Boolean trigram query, in lower case, that every match of ``pattern`` satisfies.

    A sequence keeps the set of literal strings it can have spelled so far; when the set
    grows too large or something open follows, what it demands is noted and it starts anew.
    """
    return _sequence(list(re._parser.parse(pattern)))


def _spelled(node) -> set[str] | None:
    """The strings a node can be, if they are few; None if they are open."""
    op, arg = str(node[0]), node[1]
    if op == "LITERAL":
        return {chr(arg)}
    if op == "IN" and all(str(k) == "LITERAL" for k, _ in arg):
        return {chr(c) for _, c in arg}
    if op == "AT":
        return {""}
    if op == "SUBPATTERN":
        return _spelled_all(list(arg[3]))
    if op == "BRANCH":
        ways = [_spelled_all(list(b)) for b in arg[1]]
        return None if None in ways else set().union(*ways)
    if op in ("MAX_REPEAT", "MIN_REPEAT", "POSSESSIVE_REPEAT") and arg[1] <= 3:
        once = _spelled_all(list(arg[2]))
        if once is None:
            return None
        return {"".join(p) for n in range(arg[0], arg[1] + 1) for p in product(sorted(once), repeat=n)}
    return None


def _spelled_all(nodes: list) -> set[str] | None:
    ways = {""}
    for node in nodes:
        more = _spelled(node)
        if more is None or len(ways) * len(more) > MOST_WAYS:
            return None
        ways = {a + b for a in ways for b in more}
    return ways


def _sequence(nodes: list) -> Query:
    demands: list[Query] = []
    ways = {""}
    for node in nodes:
        more = _spelled(node)
        if more is not None and len(ways) * len(more) <= MOST_WAYS:
            ways = {a + b for a in ways for b in more}
            continue
        demands.append(_of_literals(ways))
        ways = {""}
        op, arg = str(node[0]), node[1]
        if more is not None:
            ways = more if len(more) <= MOST_WAYS else {""}
        elif op == "SUBPATTERN":
            demands.append(_sequence(list(arg[3])))
        elif op == "BRANCH":
            demands.append(_either([_sequence(list(b)) for b in arg[1]]))
        elif op in ("MAX_REPEAT", "MIN_REPEAT", "POSSESSIVE_REPEAT") and arg[0] >= 1:
            demands.append(_sequence(list(arg[2])))
    demands.append(_of_literals(ways))
    return _both(demands)


def _trigrams(query: Query) -> set[int]:
    if query[0] == "tri":
        return {query[1]}
    return set().union(*map(_trigrams, query[1:])) if query[0] in ("and", "or") else set()


class Index:
    """Postings of one segment for the trigrams that some query names."""

    def __init__(self, texts: pa.Array, wanted: np.ndarray) -> None:
        self.rows = len(texts)
        self.wanted = wanted
        held = texts.fill_null("") if texts.null_count else texts
        large = pa.types.is_large_string(held.type)
        offsets = np.frombuffer(held.buffers()[1], np.int64 if large else np.int32)
        offsets = offsets[held.offset : held.offset + len(held) + 1].astype(np.int64)
        body = held.buffers()[2]
        data = np.frombuffer(body, np.uint8) if body is not None else np.zeros(0, np.uint8)
        data = data[offsets[0] : offsets[-1]]
        offsets = offsets - offsets[0]
        low = np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint32)
        codes = low[:-2] << 16 | low[1:-1] << 8 | low[2:] if len(low) > 2 else np.zeros(0, np.uint32)
        # A first look by two of the three bytes leaves few places for the search.
        pairs = np.zeros(1 << 16, bool)
        pairs[wanted >> 8] = True
        at = np.flatnonzero(pairs[codes >> 8])
        slot = np.searchsorted(wanted, codes[at])
        good = wanted[np.minimum(slot, len(wanted) - 1)] == codes[at] if len(wanted) else np.zeros(0, bool)
        at, slot = at[good], slot[good]
        row = np.searchsorted(offsets, at, "right") - 1
        whole = at + 3 <= offsets[row + 1]
        held_by = np.unique(slot[whole] * self.rows + row[whole])
        self.slots, self.docs = held_by // max(self.rows, 1), held_by % max(self.rows, 1)

    def posting(self, code: int) -> np.ndarray:
        slot = np.searchsorted(self.wanted, code)
        a, b = np.searchsorted(self.slots, [slot, slot + 1])
        return self.docs[a:b]

    def candidates(self, query: Query) -> np.ndarray:
        if query[0] == "all":
            return np.arange(self.rows)
        if query[0] == "tri":
            return self.posting(query[1])
        parts = [self.candidates(q) for q in query[1:]]
        out = parts[0]
        for part in parts[1:]:
            out = np.intersect1d(out, part, assume_unique=True) if query[0] == "and" else np.union1d(out, part)
        return out


class Scanner:
    def __init__(self, rules: tuple[Rule, ...]) -> None:
        self.rules = [(r, r.compiled(), trigram_query(r.pattern)) for r in rules]
        codes = set().union(*(_trigrams(q) for _, _, q in self.rules)) if rules else set()
        self.wanted = np.array(sorted(codes), np.uint32)

    def spans(self, texts: pa.Array) -> list[list[tuple[int, int, int]]]:
        """(start, place of the rule, end) in code points, sorted, for every text."""
        index = Index(texts, self.wanted)
        found: list[list[tuple[int, int, int]]] = [[] for _ in range(len(texts))]
        for place, (rule, pattern, query) in enumerate(self.rules):
            for r in index.candidates(query).tolist():
                text = texts[r].as_py()
                if text:
                    for m in pattern.finditer(text):
                        if rule.valid(m):
                            found[r].append((m.start(), place, m.end()))
        for spans in found:
            spans.sort()
        return found


def scan(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """doc_id, spans array<struct<kind, start, end>> for every row of ``docs``.

    Spans are sorted by start, then by the order of ``rules``; ends are exclusive, in code
    points. Null and empty texts have no spans. Repeated rows each give theirs. Texts of any
    length are scanned whole. Other columns of ``docs`` are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(rules)
        kinds = [r.kind for r in rules]
        kind = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])
        for batch in text_slices(batches):
            rows = [
                [{"kind": kinds[p], "start": s, "end": e} for s, p, e in spans]
                for spans in scanner.spans(batch.column(1))
            ]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(rows, pa.list_(kind))], ["doc_id", "spans"])

    columns = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return columns.mapInArrow(run, "doc_id long, spans array<struct<kind: string, start: long, end: long>>")


def digests(found: DataFrame) -> DataFrame:
    """Counts and hash of the base kinds, and all spans as text."""
    kinds = [r.kind for r in BASE]
    text = lambda spans: F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    base = F.filter("spans", lambda s: s["kind"].isin(kinds))
    return found.select(
        "doc_id",
        *[count(k).alias(f"n_{k}") for k in kinds],
        F.sha2(text(base), 256).alias("base_sha256"),
        text("spans").alias("spans"),
    )


def redacted(docs: DataFrame, rules: tuple[Rule, ...] = RULES) -> DataFrame:
    """``docs``, all columns, with every span of its texts replaced by a mask; rows never move.

    Overlapping and touching spans become one mask. n_chars, if there is such a column, is
    the length of the new text.
    """
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(rules)
        for batch in text_slices(batches):
            texts = batch.column(at)
            spans = scanner.spans(texts)
            if any(spans):
                new = [masked(texts[r].as_py(), s) if s else texts[r].as_py() for r, s in enumerate(spans)]
                batch = batch.set_column(at, batch.schema.field(at), pa.array(new, texts.type))
            yield batch

    out = docs.mapInArrow(run, docs.schema)
    if "n_chars" in docs.columns:
        kind = dict(docs.dtypes)["n_chars"]
        out = out.withColumn("n_chars", F.coalesce(F.length("text").cast(kind), F.col("n_chars")))
    return out.select(*docs.columns)


def masked(text: str, spans: list[tuple[int, int, int]]) -> str:
    out, end = [], None
    for start, _, stop in spans:
        if end is None or start > end:
            out += [text[end or 0 : start], MASK]
            end = stop
        else:
            end = max(end, stop)
    return "".join(out) + text[end or 0 :]
