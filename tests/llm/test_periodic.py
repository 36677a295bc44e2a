"""Runs of repeated words against a scan of every period."""

import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from coinfold.llm.periodic import Grammar, find_runs, periodic_runs, run_report


def scanned(words):
    """(start, length, least period) of all runs: for each period, the stretches on which words agree with those a period on."""
    found = {}
    for q in range(1, len(words) // 4 + 1):
        i = 0
        while i + q < len(words):
            if words[i] != words[i + q]:
                i += 1
                continue
            start = i
            while i + q < len(words) and words[i] == words[i + q]:
                i += 1
            length = i - start + q
            if length >= max(6, 4 * q):
                found.setdefault((start, length), q)
    return sorted((s, n, q) for (s, n), q in found.items())


def report(doc_id, text):
    words = (text or "").encode().split()
    n = len(words)
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = scanned(words)
    dropped = {k for s, length, q in runs for k in range(s + q, s + length)}
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2])) if runs else (None,) * 3
    sha = lambda b: hashlib.sha256(b).hexdigest()
    lines = "".join(f"{s},{length},{q}\n" for s, length, q in runs)
    milli = 1000 * best[1] // best[2] if runs else None
    return (doc_id, len(runs), *best, milli, sha(lines.encode()), sha(b" ".join(w for k, w in enumerate(words) if k not in dropped)))


def sequences():
    few = st.lists(st.integers(0, 2), max_size=60)
    made = st.tuples(st.lists(st.integers(0, 3), min_size=1, max_size=7), st.integers(1, 30), few).map(lambda x: x[2][:9] + x[0] * x[1] + x[2])
    return st.lists(st.one_of(few, made), min_size=1, max_size=5)


@settings(max_examples=150, deadline=None)
@given(sequences())
def test_runs_are_those_of_a_scan(texts):
    starts = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    words = np.array([w for t in texts for w in t], np.int64)
    got = list(zip(*(x.tolist() for x in find_runs(words, starts)), strict=True))
    assert got == [(k, *run) for k, text in enumerate(texts) for run in scanned(text)]


def test_common_extensions_of_all_pairs():
    rnd = random.Random(2)
    words = [rnd.randrange(2) for _ in range(60)] * 2 + [0] * 40 + [0, 1] * 30
    sequence = np.array([5, *words, 6])
    i, j = (x.ravel() for x in np.meshgrid(np.arange(1, len(words)), np.arange(1, len(words))))
    i, j = i[i != j], j[i != j]
    got = Grammar(sequence, (5, 7)).common(i, j)
    for a, b, n in zip(i.tolist(), j.tolist(), got.tolist(), strict=True):
        want = 0
        while sequence[a + want] == sequence[b + want]:
            want += 1
        assert n == want


def test_the_grammar_is_small_for_repetitive_texts():
    sequence = np.array([9, *[1, 2, 3] * 20_000, 10])
    grammar = Grammar(sequence, (9, 11))
    assert len(grammar.symbols[-1]) < 12 and sum(map(len, grammar.symbols)) < 5 * len(sequence)


def test_report_against_a_scan(spark):
    rnd = random.Random(8)
    rows = [(i, " ".join(rnd.choice("abcde") for _ in range(rnd.randrange(90)))) for i in range(150)]
    rows += [(200 + i, "x y z  " * i + "ä\n" * i) for i in range(30)]
    rows += [(3, None), (4, ""), (5, " \t\n"), (None, "a " * 30), (None, None), (3, "a " * 30), (3, "a " * 30), (6, "  a " * 9)]
    docs = spark.createDataFrame([(*r, 1, [2], "p") for r in rows], "doc_id long, text string, start int, runs array<int>, period string")
    got = sorted(map(tuple, run_report(docs.repartition(4)).collect()), key=str)
    assert got == sorted((report(*r) for r in rows), key=str)
    assert sum(r[1] for r in got if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 10 == 0) > 5


def test_ties_of_the_greatest_run_go_to_the_first(spark):
    text = "a " * 8 + "q " + "b " * 8 + "r " + "c d " * 8
    docs = spark.createDataFrame([(None, text)], "doc_id long, text string")
    row = run_report(docs).first()
    assert (row.n_runs, row.start, row.length, row.period, row.exponent_milli) == (3, 0, 8, 1, 8000)


def test_texts_runs_and_long_texts(spark):
    long_ = " ".join(["tick", "tock"] * 150_000)
    docs = spark.createDataFrame([(1, "no run here"), (2, long_)], "doc_id long, text string")
    rows = {r.doc_id: r for r in periodic_runs(docs).collect()}
    assert rows[1].collapsed == "no run here" and rows[1].runs == []
    assert rows[2].collapsed == "tick tock" and [tuple(r) for r in rows[2].runs] == [(0, 300_000, 2)]
    assert run_report(docs.limit(0)).collect() == []
