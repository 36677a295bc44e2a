"""Secrets in texts, found over a trigram index.

Each rule is a regular expression. From its parse tree a Boolean query over trigrams is derived that
every match satisfies. The executors index the texts of a batch - the postings of each trigram that
some query names - intersect and unite postings as the queries say, and run a rule's expression on
the candidates alone. A rule from which no trigram follows runs on every text. An index lives as
long as its batch, so nothing is shuffled and no task holds more than a batch.

Trigrams are of UTF-8 bytes with A-Z lower-cased, on both sides, so one index serves rules that
mind letter case and rules that do not.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from re import _constants as _c  # the parse tree of the standard library's own expressions
from re import _parser

from coinfold.llm.common import pieces_of, text_bytes


@dataclass(frozen=True)
class Rule:
    """A match counts if its ``group`` has ``least`` characters or more; the span is the whole match."""

    kind: str
    pattern: str
    least: int = 0
    group: int = 0


BASE_RULES = (
    Rule("assign", r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 8, 2),
    Rule("access", r"AKIA[A-Z0-9]+", 16),
    Rule("hex", r"[0-9a-f]+", 32),
)
_LINE = r"(?:Proc-Type|DEK-Info|Version|Comment):[^\r\n\\]*+|[A-Za-z0-9+/=]{24,}+|[A-Za-z0-9+/=]++(?=[\x20\t]*(?:[\r\n\\\"',;<]|\Z))"
#: How well-known services write their keys. A private key goes to the END line of its kind if no other
#: BEGIN or END is before it, or else to the end of its base64 lines, which may be parted by blanks or a written-out \n.
MORE_RULES = (
    Rule(
        "private_key",
        r"-----BEGIN ([A-Z ]{0,40}PRIVATE KEY)-----(?:[^-]*+(?:-(?!----(?:BEGIN|END) )[^-]*+)*+-----END \1-----"
        rf"|(?:(?:\s|\\+[nrt])*+(?:{_LINE}))*+)",
    ),
    Rule("code_host", r"gh[pousr]_[A-Za-z0-9]{36,}"),
    Rule("chat_bot", r"xox[abprs]-[A-Za-z0-9-]{10,}"),
    Rule("map_key", r"AIza[0-9A-Za-z_-]{35,}"),
    # only where a token begins, so that a long run of starts is read once
    Rule("web_token", r"(?<![A-Za-z0-9_-])eyJ[A-Za-z0-9_-]{8,}+\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}"),
    Rule("payment", r"[rs]k_live_[0-9A-Za-z]{16,}"),
    Rule("url_login", r"[a-z][a-z0-9+.-]{1,20}://[^\s/:@]*:[^\s/@]+@[^\s/]+"),
)

# ---- from an expression to a Boolean query -----------------------------------------------
# A query is True (any text), a trigram, ("and", queries) or ("or", queries).

_MOST_STRINGS, _MOST_CLASS = 64, 8


def _both(kind: str, parts: list):
    """'and' or 'or' of queries, with True taken out of the first and taking over the second."""
    if kind == "or" and any(p is True for p in parts):
        return True
    flat = sorted({p for p in parts if p is not True}, key=repr)
    return True if not flat else flat[0] if len(flat) == 1 else (kind, tuple(flat))


def _grams_of(text: bytes):
    return _both("and", [text[i : i + 3] for i in range(len(text) - 2)])


@dataclass
class _Info:
    """What is known of the strings a part matches: all of them, if few, and a query."""

    strings: set[bytes] | None
    query: object = True

    def settled(self):
        """The query, with what the strings say."""
        if self.strings is None:
            return self.query
        return _both("and", [self.query, _both("or", [_grams_of(s) for s in self.strings])])


@dataclass
class _Sequence:
    """Strings are joined while they stay few; then their trigrams go into the query."""

    strings: set[bytes] = field(default_factory=lambda: {b""})
    queries: list = field(default_factory=list)

    def settle(self):
        self.queries.append(_both("or", [_grams_of(s) for s in self.strings]))
        self.strings = {b""}
        self.whole = False

    whole: bool = True

    def add(self, part: _Info):
        self.queries.append(part.query)
        if part.strings is None:
            self.settle()
        elif len(self.strings) * len(part.strings) > _MOST_STRINGS:
            self.settle()
            self.strings = set(part.strings)
        else:
            self.strings = {a + b for a in self.strings for b in part.strings}

    def info(self) -> _Info:
        if self.whole:
            return _Info(self.strings, _both("and", self.queries))
        self.settle()
        return _Info(None, _both("and", self.queries))


def _letter(code: int) -> set[bytes]:
    return {chr(code).encode("utf-8", "surrogatepass").lower()}


def _read(tree, fold: bool) -> _Info:
    out = _Sequence()
    for op, value in tree:
        if op is _c.LITERAL:
            # without regard to case, a letter beyond ASCII may match differently encoded ones
            out.add(_Info(_letter(value) if not fold or value < 128 else None))
        elif op is _c.IN:
            codes = []
            for kind, x in value:
                if kind is _c.LITERAL:
                    codes.append(x)
                elif kind is _c.RANGE and x[1] - x[0] < _MOST_CLASS:
                    codes += range(x[0], x[1] + 1)
                else:
                    codes = None
                    break
            few = codes and len(codes) <= _MOST_CLASS and not (fold and max(codes) > 127)
            out.add(_Info(set().union(*map(_letter, codes)) if few else None))
        elif op is _c.SUBPATTERN:
            _, add, drop, inner = value
            out.add(_read(inner, (fold or bool(add & re.I)) and not drop & re.I))
        elif op is _c.BRANCH:
            parts = [_read(p, fold) for p in value[1]]
            strings = None if any(p.strings is None for p in parts) else set().union(*(p.strings for p in parts))
            if strings is not None and len(strings) <= _MOST_STRINGS:
                out.add(_Info(strings, _both("or", [p.query for p in parts])))
            else:
                out.add(_Info(None, _both("or", [p.settled() for p in parts])))
        elif op in (_c.MAX_REPEAT, _c.MIN_REPEAT, _c.POSSESSIVE_REPEAT):
            low, high, inner = value
            part = _read(inner, fold)
            if (low, high) == (0, 1):
                out.add(_Info(part.strings | {b""} if part.strings is not None else None))
            else:
                for _ in range(min(low, 3)):
                    out.add(part)
                if high != low or low > 3:
                    out.add(_Info(None))
        elif op is _c.AT or op in (_c.ASSERT, _c.ASSERT_NOT):
            continue  # takes no text of its own
        elif op is _c.ATOMIC_GROUP:
            out.add(_read(value, fold))
        else:
            out.add(_Info(None))
    return out.info()


def trigram_query(pattern: str):
    """The Boolean trigram query that every text with a match of ``pattern`` satisfies."""
    tree = _parser.parse(pattern, re.A)
    return _read(tree, bool(tree.state.flags & re.I)).settled()


def _named(query) -> set[bytes]:
    if query is True:
        return set()
    return {query} if isinstance(query, bytes) else set().union(*map(_named, query[1]))


# ---- the index of a batch ----------------------------------------------------------------


class Scanner:
    """All rules, their queries, and the trigrams worth indexing."""

    def __init__(self, rules: tuple[Rule, ...]):
        self.rules = rules
        self.found = [re.compile(r.pattern, re.A) for r in rules]
        self.queries = [trigram_query(r.pattern) for r in rules]
        names = sorted(set().union(*map(_named, self.queries)))
        self.number = {name: k + 1 for k, name in enumerate(names)}
        self.lookup = np.zeros(1 << 24, np.uint16)
        for name, k in self.number.items():
            self.lookup[int.from_bytes(name, "big")] = k

    def postings(self, data: np.ndarray, starts: np.ndarray) -> dict[int, np.ndarray]:
        """Number of a trigram: the rows it occurs in, ascending."""
        if len(data) < 3:
            return {}
        low = _LOWER[data]
        code = (low[:-2] << np.uint32(16)) | (low[1:-1] << np.uint32(8)) | low[2:]
        hit = self.lookup[code]
        at = np.flatnonzero(hit)
        row = np.searchsorted(starts, at, side="right") - 1
        inside = at + 3 <= starts[row + 1]
        pairs = np.unique(hit[at[inside]].astype(np.int64) << 32 | row[inside])
        numbers, cuts = np.unique(pairs >> 32, return_index=True)
        rows = np.split(pairs & 0xFFFFFFFF, cuts[1:])
        return dict(zip(numbers.tolist(), rows, strict=True)) if len(pairs) else {}

    def candidates(self, query, postings: dict[int, np.ndarray], rows: int) -> np.ndarray:
        if query is True:
            return np.arange(rows)
        if isinstance(query, bytes):
            return postings.get(self.number[query], np.zeros(0, np.int64))
        parts = sorted((self.candidates(q, postings, rows) for q in query[1]), key=len)
        if query[0] == "or":
            return np.unique(np.concatenate(parts))
        out = parts[0]
        for part in parts[1:]:
            out = np.intersect1d(out, part, assume_unique=True)
        return out

    def spans(self, data: np.ndarray, starts: np.ndarray) -> dict[int, list[tuple[int, int, int]]]:
        """Row: (start, number of the rule, end) in code points, sorted."""
        postings, texts = self.postings(data, starts), {}
        out: dict[int, list[tuple[int, int, int]]] = {}
        for k, (rule, expression, query) in enumerate(zip(self.rules, self.found, self.queries, strict=True)):
            for row in self.candidates(query, postings, len(starts) - 1).tolist():
                if row not in texts:
                    texts[row] = data[starts[row] : starts[row + 1]].tobytes().decode("utf-8", "replace")
                for m in expression.finditer(texts[row]):
                    begin, end = m.span(rule.group)
                    if end - begin >= rule.least:
                        out.setdefault(row, []).append((m.start(), k, m.end()))
        return {row: sorted(found) for row, found in out.items()}


_LOWER = np.arange(256, dtype=np.uint32)
_LOWER[ord("A") : ord("Z") + 1] += 32


def _per_batch(rules: tuple[Rule, ...], make, text: str):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = Scanner(rules)
        for batch in batches:
            data, starts = text_bytes(batch.column(text))
            for low, high in pieces_of(starts):
                found = scanner.spans(data[starts[low] : starts[high]], starts[low : high + 1] - starts[low])
                yield make(batch.slice(low, high - low), found, rules)

    return work


def secret_spans(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rules: tuple[Rule, ...] = BASE_RULES + MORE_RULES
) -> DataFrame:
    """doc_id and spans array<struct<kind, start, end>>: all matches, one row for every row of ``docs``.

    Starts and ends count code points, ends exclusive. Spans are sorted by start, then in the order of
    the rules. Defined cases: a null or empty text has no spans; repeated rows each give a row; a null
    id stays null; an empty table gives no rows; texts are searched whole; other columns are ignored.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    item = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())])

    def make(batch: pa.RecordBatch, found: dict, rules) -> pa.RecordBatch:
        lists = [[{"kind": rules[k].kind, "start": a, "end": b} for a, k, b in found.get(i, ())] for i in range(batch.num_rows)]
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(lists, pa.list_(item))], names=["doc_id", "spans"])

    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    shape = f"doc_id {kind}, spans array<struct<kind: string, start: bigint, end: bigint>>"
    return source.mapInArrow(_per_batch(rules, make, "text"), shape)


def secret_report(docs: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans: what ``secret_spans`` finds, as counts and digests.

    ``spans`` joins kind:start:end of all matches with commas; ``base_sha256`` is the SHA-256 of the same
    text of the base rules' matches alone, which is that of the empty text if there are none.
    """
    base = [r.kind for r in BASE_RULES]
    joined = lambda spans: F.array_join(
        F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ","
    )
    count = lambda kind: F.size(F.filter("spans", lambda s: s["kind"] == kind)).cast("long")
    return secret_spans(docs).select(
        "doc_id",
        *(count(k).alias(f"n_{k}") for k in base),
        F.sha2(joined(F.filter("spans", lambda s: s["kind"].isin(base))).cast("binary"), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
    )


def redacted(docs: DataFrame, text_col: str = "text", rules: tuple[Rule, ...] = BASE_RULES + MORE_RULES) -> DataFrame:
    """``docs`` with each secret in the text replaced by its rule's kind in brackets; overlaps become one.

    A column ``n_chars`` is set to the new length where a text was changed.

    Defined cases: a null or empty text stays as it is, and so does every other column, whatever its name; repeated
    rows are each changed alike; an empty table gives no rows; texts are searched whole, however long.
    """
    names, schema = docs.columns, docs.schema

    def make(batch: pa.RecordBatch, found: dict, rules) -> pa.RecordBatch:
        columns = {name: batch.column(name) for name in names}
        if found:
            texts = columns[text_col].to_pylist()
            lengths = columns["n_chars"].to_pylist() if "n_chars" in columns else None
            for row, spans in found.items():
                text, parts, at = texts[row], [], 0
                for start, k, end in spans:
                    if start >= at:
                        parts += [text[at:start], f"[{rules[k].kind}]"]
                    at = max(at, end)
                texts[row] = "".join([*parts, text[at:]])
                if lengths:
                    lengths[row] = len(texts[row])
            columns[text_col] = pa.array(texts, columns[text_col].type)
            if lengths:
                columns["n_chars"] = pa.array(lengths, columns["n_chars"].type)
        return pa.RecordBatch.from_arrays(list(columns.values()), names=names)

    searched = "searched"
    while searched in {n.lower() for n in names}:
        searched += "_"
    source = docs.withColumn(searched, F.col(text_col).cast("string"))
    return source.mapInArrow(_per_batch(rules, make, searched), schema)


