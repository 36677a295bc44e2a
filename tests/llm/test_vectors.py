import math
from collections import Counter

import numpy as np
import pytest

from coinfold.llm.topk import Found, products, search, top_products
from coinfold.llm import vectors
from coinfold.llm.vectors import codes, least_estimate, links_between, near_vectors, rotation

INF, NAN = float("inf"), float("nan")


def some_vectors(seed=4, n=240, dim=16):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(12, dim))
    x = centres[rng.integers(0, 12, n)] + rng.normal(size=(n, dim)) * rng.choice([0.05, 0.12, 0.6], (n, 1))
    return (x * rng.choice([0.1, 1, 40], (n, 1))).astype(np.float32)


ODD = [
    (900, None, 1), (901, [0.0] * 16, 1), (902, [1.0] * 15 + [None], 1), (903, [1.0] * 15 + [NAN], 1), (904, [INF] + [1.0] * 15, 1),
    (905, [], 1), (906, [1.0, 2.0], 1), (907, [2.0, 4.0], 1), (908, [1.0, 2.0], None), (909, [1.0, 2.0], 2),
    (910, [1e38] * 16, 3), (911, [3e38] * 16, 3), (912, [1e-44] * 16, 3), (None, [1.0, 2.0], 1),
]


def table(spark, extra=True):
    x = some_vectors()
    rows = [(k, v.tolist(), k % 2) for k, v in enumerate(x)]
    rows += [(300 + k, x[5].tolist(), 1) for k in range(30)] + [rows[8], rows[8]]
    # ids that repeat with other vectors
    rows += [(20, x[7].tolist(), 0), (20, (-x[20]).tolist(), 0), (21, x[60].tolist(), 1), (40, x[41].tolist(), 1), (40, x[3].tolist(), None)]
    rows += ODD if extra else []
    shape = "vec_id long, embedding array<float>, label int"
    return rows, spark.createDataFrame(rows, shape).selectExpr("*", "1 as n", "'x' as unit", "2L as h").repartition(3)


def usable(v):
    return v is not None and len(v) > 0 and all(c is not None and math.isfinite(c) for c in v)


def test_links_against_brute_force(spark):
    rows, frame = table(spark)
    rows = [(i, None if v is None else [None if c is None else float(np.float32(c)) for c in v], c) for i, v, c in rows]
    good = [k for k, (i, v, c) in enumerate(rows) if i is not None and c is not None and usable(v) and any(v)]
    links = {k: set() for k in range(len(rows))}
    for a in good:
        for b in good:
            if a != b and rows[a][2] == rows[b][2] and len(rows[a][1]) == len(rows[b][1]):
                x, y = np.array(rows[a][1]) / max(map(abs, rows[a][1])), np.array(rows[b][1]) / max(map(abs, rows[b][1]))
                if x @ y / np.sqrt(x @ x) / np.sqrt(y @ y) >= 0.98:
                    links[a].add(b)
    ids = [r[0] for r in rows]
    want = Counter()
    for start in range(len(rows)):
        seen, todo = set(), [start]
        while todo:
            k = todo.pop()
            if k not in seen:
                seen.add(k)
                todo += links[k]
        root = ids[start] if ids[start] is None else min(ids[k] for k in seen)
        want[ids[start], len(links[start]), root, ids[start] == root] += 1
    got = near_vectors(frame).select("vec_id", "n_links", "component_id", "kept").collect()
    assert Counter(map(tuple, got)) == want
    assert sum(r.n_links for r in got) > 500


def test_an_id_does_not_join_its_vectors(spark):
    frame = spark.createDataFrame([(1, [1.0, 0.0], 1), (1, [0.0, 1.0], 1), (2, [1.0, 0.01], 1), (3, [0.01, 1.0], 1)], "vec_id long, embedding array<float>, label int")
    got = Counter((r.vec_id, r.n_links, r.component_id) for r in near_vectors(frame).collect())
    assert got == Counter({(1, 1, 1): 2, (2, 1, 1): 1, (3, 1, 1): 1})
    alone = spark.createDataFrame([(1, [1.0, 0.0], 1), (1, [0.0, 1.0], 1), (2, [1.0, 0.01], 1)], frame.schema)
    assert Counter((r.vec_id, r.n_links, r.component_id) for r in near_vectors(alone).collect()) == Counter({(1, 1, 1): 1, (1, 0, 1): 1, (2, 1, 1): 1})


def test_few_pairs_are_computed_again(monkeypatch):
    """At 64 dimensions the bound is well below the worst case, and unlike pairs are told by their codes."""
    rng = np.random.default_rng(5)
    x = rng.normal(size=(400, 64))
    x[200:] = x[:200] + rng.normal(size=(200, 64)) * 0.05
    norm = np.linalg.norm(x, axis=1)
    code, factor = codes(x / norm[:, None])
    side = {"vector": x, "norm": norm, "unit": x / norm[:, None], "code": code, "factor": factor}
    counted = []
    einsum = np.einsum
    monkeypatch.setattr(vectors.np, "einsum", lambda *a: counted.append(len(a[1])) or einsum(*a))
    found = {(i, j) for a, b in links_between(side, side, 0.98) for i, j in zip(a.tolist(), b.tolist(), strict=True)}
    exact = (side["unit"] @ side["unit"].T) >= 0.98
    assert found == set(zip(*(k.tolist() for k in np.nonzero(exact)), strict=True)) and len(found) == 800
    assert sum(counted) < 0.02 * 400 * 400
    assert least_estimate(factor, 64, 0.98)[0] > least_estimate(factor, 64, 0.98, confidence=100)[0]


def test_no_vectors(spark):
    _, frame = table(spark)
    assert near_vectors(frame.where("false")).collect() == []
    assert top_products(frame.where("false")).collect() == []


@pytest.mark.parametrize("dim", [1, 2, 7, 64, 300])
def test_the_bound_holds(dim):
    rng = np.random.default_rng(dim)
    a = rng.normal(size=(400, dim))
    b = a + rng.normal(size=a.shape) * np.linalg.norm(a, axis=1, keepdims=True) * rng.uniform(0, 0.3, (400, 1)) / np.sqrt(dim)
    a, b = (x / np.linalg.norm(x, axis=1, keepdims=True) for x in (a, b))
    packed, factor = codes(a)
    signs = np.unpackbits(packed, axis=1, count=dim) * 2.0 - 1
    estimate = (signs * (b @ rotation(dim))).sum(axis=1) / np.sqrt(dim) / factor
    near = (a * b).sum(axis=1) >= 0.98
    assert near.sum() > 20
    assert (estimate >= least_estimate(factor, dim, 0.98))[near].all()


def test_the_estimate_is_unbiased():
    """Over random pairs of one cosine, the mean estimate is that cosine."""
    rng = np.random.default_rng(1)
    a, b = rng.normal(size=(2, 20_000, 32))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b -= (a * b).sum(axis=1, keepdims=True) * a
    b = 0.9 * a + np.sqrt(1 - 0.81) * b / np.linalg.norm(b, axis=1, keepdims=True)
    packed, factor = codes(a)
    signs = np.unpackbits(packed, axis=1, count=32) * 2.0 - 1
    estimate = (signs * (b @ rotation(32))).sum(axis=1) / np.sqrt(32) / factor
    assert abs(estimate.mean() - 0.9) < 0.002


def brute_top(rows, top=20, every=20):
    """Every row against every other one, rows of its own id included."""
    whole = []
    for i, v, _ in rows:
        if i is not None and v is not None and all(c is not None and math.isfinite(c) for c in v):
            whole.append((i, [math.floor(64 * float(np.float32(c))) for c in v]))
    out = []
    for k, (q, x) in enumerate(whole):
        if q % every == 0:
            scores = [(-min(max(sum(map(lambda a, b: a * b, x, v)), -(2**63)), 2**63 - 1), i) for n, (i, v) in enumerate(whole) if n != k and len(v) == len(x)]
            out += [(q, place + 1, i, -s) for place, (s, i) in enumerate(sorted(scores)[:top])]
    return sorted(out)


@pytest.mark.parametrize("shelf, bucket, block", [(8192, 1024, 2048), (40, 16, 5)])
def test_top_products_against_brute_force(spark, monkeypatch, shelf, bucket, block):
    from coinfold.llm import topk

    for name, value in (("SHELF", shelf), ("BLOCK", block)):
        monkeypatch.setattr(topk, name, value)
    rows, frame = table(spark)
    assert sorted(map(tuple, top_products(frame).collect())) == brute_top(rows)


def test_buckets_and_coordinates():
    rng = np.random.default_rng(3)
    x = np.floor(64 * np.concatenate([some_vectors(1, 600), some_vectors(2, 40) * 0, np.tile(some_vectors(3, 1), (60, 1))]).astype(np.float64))
    ids = rng.permutation(len(x)).astype(np.int64)
    sides = {"rows": ids + 7, "ids": ids, "whole": x, "length": np.sqrt((x * x).sum(axis=1))}
    asks = {k: v[:150] for k, v in sides.items()}
    floor = np.full(150, np.iinfo(np.int64).min)
    exact = products(asks["whole"], x)
    for start in (floor, np.sort(exact, axis=1)[:, -21]):
        found: Found = search(asks, sides, start, 20)
        got = sorted(zip(*(r.tolist() for r in found.rows), strict=True))
        want = []
        for q in range(150):
            order = np.lexsort((ids, -exact[q]))
            want += [(q, int(ids[j]), int(exact[q, j])) for j in order[order != q][:20]]
        assert got == sorted(want)
