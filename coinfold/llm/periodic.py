"""Runs of repeated word sequences, found over a run-length grammar built by recompression.

The words of some texts, numbered, with a separator of its own around each text, are compressed in turns: a block
step replaces each maximal run of one symbol by a symbol for (symbol, length), a pair step parts the symbols into left
and right ones and replaces each left one with the right one that follows. Equal stretches are parsed alike but for
their ends, so the longest common extension of two positions climbs the levels while symbols agree and descends where
they part, one step a level either way. A second grammar, of the reversed words, extends to the left.

A run of period q with at least 4 q words holds a word at a multiple of 3 q whose next period is in the run as well. So
for each q the words on that grid are compared with those q further on, a harmonic number of pairs in all, and the
equal ones are extended exactly in both directions. Nothing is sorted by suffixes.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coinfold.llm.common import pieces_of, text_bytes

#: A run has at least so many words, and so many periods.
LEAST_WORDS, LEAST_PERIODS = 6, 4
PIECE = 2_000_000
#: Pairs of positions extended at once.
PAIRS = 1_000_000
#: Compression ends when no text has more symbols than this.
TOP = 8


class Grammar:
    """Levels of a recompressed sequence. ``symbols[l]`` is level l; ``first[l]`` is where each of its symbols begins on
    level l - 1 (one more at the end), ``parent[l]`` which symbol of level l + 1 holds each; ``blocks[l]`` tells that
    level l + 1 was made of runs."""

    def __init__(self, words: np.ndarray, separators: tuple[int, int]):
        self.symbols, self.first, self.parent, self.blocks = [words], [np.arange(len(words) + 1)], [], []
        self.low, self.high = separators
        self.next = self.high
        step = 0
        while True:
            here = self.symbols[-1]
            apart = np.flatnonzero((here >= self.low) & (here < self.high))
            if np.diff(apart).max(initial=0) <= TOP:
                break
            self._blocks(here)
            self._pairs(self.symbols[-1], step)
            step += 1
        # where each symbol begins among the words
        self.place = [np.arange(len(words) + 1)]
        for first in self.first[1:]:
            self.place.append(self.place[-1][first])

    def _add(self, starts: np.ndarray, symbols: np.ndarray, blocks: bool) -> None:
        below = len(self.symbols[-1])
        self.parent.append(np.cumsum(np.bincount(starts, minlength=below)) - 1)
        self.first.append(np.append(starts, below))
        self.symbols.append(symbols)
        self.blocks.append(blocks)

    def _named(self, symbols: np.ndarray, new: np.ndarray, keys: np.ndarray) -> None:
        kinds, which = np.unique(keys, return_inverse=True)
        symbols[new] = self.next + which
        self.next += len(kinds)

    def _blocks(self, here: np.ndarray) -> None:
        starts = np.flatnonzero(np.concatenate([[True], here[1:] != here[:-1]]))
        if len(starts) == len(here):
            return
        sizes = np.diff(np.append(starts, len(here)))
        symbols, new = here[starts], sizes > 1
        self._named(symbols, new, symbols[new] * (len(here) + 1) + sizes[new])
        self._add(starts, symbols, True)

    def _pairs(self, here: np.ndarray, step: int) -> None:
        free = (here < self.low) | (here >= self.high)
        mixed = (here.astype(np.uint64) + np.uint64(step + 1)) * np.uint64(0x9E3779B97F4A7C15)
        mixed ^= mixed >> np.uint64(31)
        mixed *= np.uint64(0xBF58476D1CE4E5B9)
        left = (mixed >> np.uint64(62)) & np.uint64(1) == 1
        a, b = left & free, ~left & free
        one, other = a[:-1] & b[1:], b[:-1] & a[1:]
        pair = one if one.sum() >= other.sum() else other  # either side may be the left one
        at = np.flatnonzero(pair)
        if not len(at):
            return
        begins = np.ones(len(here), bool)
        begins[at + 1] = False
        starts = np.flatnonzero(begins)
        symbols, new = here[starts], pair[np.minimum(starts, len(pair) - 1)] & (starts < len(pair))
        self._named(symbols, new, here[at] * self.next + here[at + 1])
        self._add(starts, symbols, False)

    def _step(self, level: int, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """How many equal symbols to pass: what is left of both runs below a block level, else one."""
        if level >= len(self.parent) or not self.blocks[level]:
            return np.ones(len(x), np.int64)
        ends = self.first[level + 1]
        return np.minimum(ends[self.parent[level][x] + 1] - x, ends[self.parent[level][y] + 1] - y)

    def common(self, i: np.ndarray, j: np.ndarray) -> np.ndarray:
        """How many words from ``i`` on agree with those from ``j`` on; i and j differ."""
        x, y = i.copy(), j.copy()
        stop = np.full(len(x), len(self.parent))  # the level at which a pair of positions turned down
        live = np.arange(len(x))
        for level in range(len(self.parent)):
            symbols, parent, first = self.symbols[level], self.parent[level], self.first[level + 1]
            same = symbols[x[live]] == symbols[y[live]]
            stop[live[~same]] = level
            live = live[same]
            if not len(live):
                break
            inside = (first[parent[x[live]]] != x[live]) | (first[parent[y[live]]] != y[live])
            some = live[inside]
            step = self._step(level, x[some], y[some])
            x[some] += step
            y[some] += step
            inside = (first[parent[x[some]]] != x[some]) | (first[parent[y[some]]] != y[some])
            turned = some[inside]  # one run was longer
            stop[turned] = level
            on = np.ones(len(live), bool)
            on[np.searchsorted(live, turned)] = False
            live = live[on]
            x[live], y[live] = parent[x[live]], parent[y[live]]
        for level in range(len(self.parent), -1, -1):
            live = np.flatnonzero(stop >= level)
            symbols = self.symbols[level]
            same = live[symbols[x[live]] == symbols[y[live]]]
            while len(same):  # once, but on the highest level
                step = self._step(level, x[same], y[same])
                x[same] += step
                y[same] += step
                same = same[symbols[x[same]] == symbols[y[same]]] if level == len(self.parent) else same[:0]
            if level:
                x[live], y[live] = self.first[level][x[live]], self.first[level][y[live]]
        return x - i


def _spread(starts: np.ndarray, sizes: np.ndarray, step: np.ndarray) -> np.ndarray:
    ends = np.cumsum(sizes)
    nth = np.arange(int(ends[-1]) if len(ends) else 0) - np.repeat(ends - sizes, sizes)
    return np.repeat(starts, sizes) + nth * np.repeat(step, sizes)


def find_runs(words: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """text, start, length, period of the runs of each text, in that order; text k has the words from starts[k] on.

    A run is a stretch of words with least period q, of at least max(6, 4 q) words, which no neighbour extends.
    """
    texts, sizes = len(starts) - 1, np.diff(starts)
    most = int(words.max(initial=-1)) + 1
    sequence = np.empty(len(words) + texts + 1, np.int64)
    own = np.repeat(np.arange(texts), sizes)
    sequence[np.arange(len(words)) + own + 1] = words
    sequence[np.append(starts[:-1] + np.arange(texts), len(sequence) - 1)] = most + np.arange(texts + 1)
    begins = starts[:-1] + np.arange(texts) + 1
    forward = backward = None
    # all (text, period), each with a grid of its own
    periods = np.where(sizes >= LEAST_WORDS, sizes // LEAST_PERIODS, 0)
    text = np.repeat(np.arange(texts), periods)
    period = _spread(np.ones(texts, np.int64), periods, np.ones(texts, np.int64))
    grid = np.maximum(LEAST_WORDS, LEAST_PERIODS * period) - period
    points = -(-(sizes[text] - period) // grid)
    found = [np.zeros((0, 4), np.int64)]
    part = np.cumsum(points) // PAIRS
    for some in np.split(np.arange(len(text)), np.flatnonzero(np.diff(part)) + 1):
        i = _spread(begins[text[some]], points[some], grid[some])
        which = np.repeat(some, points[some])
        equal = sequence[i] == sequence[i + period[which]]
        i, which = i[equal], which[equal]
        if not len(i):
            continue
        if forward is None:
            around = (most, most + texts + 1)
            forward, backward = Grammar(sequence, around), Grammar(sequence[::-1].copy(), around)
        q = period[which]
        after = forward.common(i, i + q)
        before = backward.common(len(sequence) - i, len(sequence) - i - q)
        long_ = after + before + q >= np.maximum(LEAST_WORDS, LEAST_PERIODS * q)
        i, q, t = i[long_], q[long_], text[which[long_]]
        start = i - before[long_]
        found.append(np.stack([t, start - begins[t], after[long_] + before[long_] + q, q], axis=1))
    rows = np.unique(np.concatenate(found), axis=0)
    # the same stretch is found for multiples of its least period too; the least comes first
    if len(rows):
        rows = rows[np.concatenate([[True], (rows[1:, :3] != rows[:-1, :3]).any(axis=1)])]
        rows = rows[np.lexsort((rows[:, 3], rows[:, 1], rows[:, 0]))]
    return tuple(rows.T)


def repeated_from(doc_id: int, n: int) -> np.ndarray | None:
    """The order of a text's words where its id is one of those whose words are made to repeat, else None."""
    h = zlib.crc32(str(doc_id).encode())
    if h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    order = np.arange(n)
    order[a:] = a + (order[a:] - a) % p
    return order


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", planted: bool = False) -> DataFrame:
    """doc_id, runs array<struct<start, length, period>>, collapsed string: one row for every row of ``docs``.

    Words are what ASCII blanks part, numbered from 0. ``runs`` are in order of start, then period. ``collapsed`` has
    the words, one space between, without those that a run holds after its first period. With ``planted``, texts of
    some ids are made to repeat first (``repeated_from``), so that any table has runs to find.

    Defined cases: a null or blank text has no words, no runs and an empty ``collapsed``. A row without an id is never
    made to repeat. Repeated rows each give a row. An empty table gives no rows. Other columns are ignored. A text is
    worked on by one task, in memory in proportion to its length.
    """
    kind = docs.schema[id_col].dataType.simpleString()

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, starts = text_bytes(batch.column(1))
            for low, high in pieces_of(starts, PIECE):
                ids = batch.column(0).slice(low, high - low)
                yield _piece(ids, [bytes(data[a:b]).split() for a, b in zip(starts[low:high], starts[low + 1 : high + 1], strict=True)])

    def _piece(ids: pa.Array, words: list[list[bytes]]) -> pa.RecordBatch:
        for row, doc_id in enumerate(ids.to_pylist() if planted else ()):
            order = None if doc_id is None else repeated_from(doc_id, len(words[row]))
            if order is not None:
                words[row] = [words[row][k] for k in order]
        starts = np.concatenate([[0], np.cumsum([len(w) for w in words])]).astype(np.int64)
        flat = pa.array([w for row in words for w in row], pa.binary()).dictionary_encode().indices
        text, start, length, period = find_runs(flat.to_numpy(zero_copy_only=False).astype(np.int64), starts)
        change = np.zeros(int(starts[-1]) + 1, np.int64)
        np.add.at(change, starts[text] + start + period, 1)
        np.add.at(change, starts[text] + start + length, -1)
        kept = np.cumsum(change) == 0
        joined = []
        has = np.zeros(len(words), bool)
        has[text] = True
        for row, found in enumerate(words):
            if has[row]:
                found = [w for w, k in zip(found, kept[starts[row] : starts[row + 1]].tolist(), strict=True) if k]
            joined.append(b" ".join(found))
        runs = pa.StructArray.from_arrays([pa.array(x) for x in (start, length, period)], names=["start", "length", "period"])
        offsets = pa.array(np.searchsorted(text, np.arange(len(words) + 1)).astype(np.int32))
        columns = [ids, pa.ListArray.from_arrays(offsets, runs), pa.array(joined, pa.binary()).cast(pa.string())]
        return pa.RecordBatch.from_arrays(columns, names=["doc_id", "runs", "collapsed"])

    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    shape = f"doc_id {kind}, runs array<struct<start: long, length: long, period: long>>, collapsed string"
    return source.mapInArrow(work, shape)


def run_report(docs: DataFrame) -> DataFrame:
    """doc_id, n_runs, the run of greatest exponent (start, length, period, exponent_milli), runs_sha256, collapsed_sha256."""
    found = periodic_runs(docs, planted=True)
    more = lambda a, b: b["length"] * a["period"] > a["length"] * b["period"]
    best = F.when(
        F.size("runs") > 0,
        F.aggregate("runs", F.element_at("runs", 1), lambda a, b: F.when(more(a, b), b).otherwise(a)),
    )
    line = lambda r: F.concat(F.concat_ws(",", *(r[c].cast("string") for c in ("start", "length", "period"))), F.lit("\n"))
    return found.withColumn("best", best).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        "best.start",
        "best.length",
        "best.period",
        F.expr("best.length * 1000L div best.period").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )
