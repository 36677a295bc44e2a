import random

import numpy as np
import xxhash

from coinfold.llm.components import connected_components, forest
from coinfold.llm.simhash import (
    _tiles,
    fingerprint,
    fingerprint_links,
    near_pairs,
    one_of_each_group,
    simhash_groups,
)


def by_hand(text):
    """Bit by bit, straight from the definition."""
    words, word = [], ""
    for c in (text or "").translate({k: k + 32 for k in range(65, 91)}) + " ":
        if c in " \t\n\x0b\x0c\r":
            words += [word] if word else []
            word = ""
        else:
            word += c
    if not words:
        return 0
    shingles = [" ".join(words)] if len(words) < 3 else [" ".join(words[i : i + 3]) for i in range(len(words) - 2)]
    hashes = [xxhash.xxh64(s.encode(), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def components_by_hand(rows, links):
    root = {r: r for r in rows}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in links:
        a, b = sorted((top(a), top(b)))
        root[b] = a
    return {r: top(r) for r in rows}


def test_fingerprints_of_a_text():
    texts = ["", " \t\n", "One", "one TWO", "a b c", "a b c a b c a b c", "Ärger ÄB x y z", "x " * 5000, "a\x1cb c d"]
    for text in texts:
        assert fingerprint(text.encode()) & (2**64 - 1) == by_hand(text), text


def test_groups_against_brute_force(spark, documents):
    rng = random.Random(5)
    words = ["w%d" % k for k in range(60)]
    rows = [(k, " ".join(rng.choices(words, k=rng.randint(1, 60)))) for k in range(120)]
    rows += [(200 + k, (rows[k][1] + " tail")[: rng.randint(300, 400)]) for k in range(60)]
    rows += [(300 + k, rows[3][1]) for k in range(25)] + [(400, None), (401, ""), (402, " \n"), (3, rows[3][1]), (None, rows[7][1])]
    rows += [(500, "lang " * 20000)]
    prints = {(i, t): by_hand(t) for i, t in rows}
    named = [(i, prints[i, t]) for i, t in rows if i is not None]
    links = [(a, b) for a, x in named for b, y in named if a < b and (x ^ y).bit_count() <= 3]
    roots = components_by_hand({i for i, _ in named}, links)
    got = simhash_groups(documents(*rows)).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.doc_id is not None:
            assert r.component_id == roots[r.doc_id]
            assert int(r.fingerprint, 16) in {prints[i, t] for i, t in rows if i == r.doc_id}
            assert len(r.fingerprint) == 16
        else:
            assert r.component_id == roots[7]
    kept = one_of_each_group(documents(*rows)).collect()
    assert sorted(r.doc_id for r in kept if r.doc_id is not None) == sorted(set(roots.values()))
    assert sum(r.doc_id is None for r in kept) == 1


def test_a_repeated_id_loses_no_unlike_text(documents):
    rng = random.Random(6)
    three, five, five_too = (" ".join(rng.choices(["w%d" % k for k in range(500)], k=50)) for _ in range(3))
    rows = [(3, three), (5, three), (5, five), (5, five_too), (5, five), (7, five_too)]
    kept = one_of_each_group(documents(*rows)).collect()
    assert sorted((r.doc_id, r.text) for r in kept) == sorted([(3, three), (5, five), (5, five_too)])


def test_no_documents(documents):
    assert simhash_groups(documents((1, "x")).where("false")).collect() == []


def test_tiles_meet_whatever_may_be_near():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2**63, 300).astype(np.uint64)
    flips = np.uint64(1) << rng.integers(0, 63, (300, 3)).astype(np.uint64)
    prints = np.unique(np.concatenate([base, base ^ flips[:, 0], base ^ flips[:, 0] ^ flips[:, 1] ^ flips[:, 2]]))
    cell = [((int(p) >> 32).bit_count(), (int(p) & 0xFFFFFFFF).bit_count()) for p in prints]
    first, near = _tiles([(*c, cell.count(c)) for c in set(cell)], len(prints), 3)
    want = {(i, j) for i in range(len(prints)) for j in range(i) if (int(prints[i]) ^ int(prints[j])).bit_count() <= 3}
    assert len(want) > 300
    for i, j in want:
        assert first[cell[j]][0] in near[first[cell[i]][0]] and first[cell[i]][0] in near[first[cell[j]][0]]
    found = {(i, j) for a, b in near_pairs(prints, prints, 3) for i, j in zip(a.tolist(), b.tolist(), strict=True) if j < i}
    assert found == want


def test_a_dense_group_leaves_few_links(spark):
    prints = spark.range(2000).selectExpr("shiftleft(id % 12, 40) + shiftleft(cast(floor(id / 12) as bigint) % 9, 20) as fp").distinct()
    links = fingerprint_links(prints).collect()
    n = prints.count()
    assert len(links) < 40 * n
    everyone = {r.fp for r in prints.collect()}
    want = components_by_hand(everyone, [(a, b) for a in everyone for b in everyone if a < b and (a ^ b).bit_count() <= 3])
    got = components_by_hand(everyone, [tuple(r) for r in links])
    assert got == want


def test_components(spark):
    rng = random.Random(2)
    links = [(rng.randint(0, 400), rng.randint(0, 400)) for _ in range(330)] + [(k, k + 1) for k in range(500, 560)] + [(9, 9)]
    want = components_by_hand({x for p in links for x in p}, links)
    frame = spark.createDataFrame([*links, (None, 4), *links[:20]], "a long, b long")
    got = {r.node: r.root for r in connected_components(frame, "a", "b").collect()}
    linked = {x for a, b in links for x in (a, b) if a != b}
    assert got == {x: want[x] for x in linked}
    nodes, roots = forest(np.array([a for a, _ in links]), np.array([b for _, b in links]))
    assert {int(a): int(b) for a, b in zip(nodes, roots, strict=True)} == {x: r for x, r in want.items() if r != x}


def test_columns_of_any_name_survive_near_dedup(spark):
    rows = [(1, "some words that repeat here", "mine", "k", 5), (2, "some words that repeat here", "yours", "l", 6), (3, None, None, None, 7)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, `__key` string, key string, row int")
    kept = one_of_each_group(docs)
    assert kept.schema == docs.schema
    assert sorted(map(tuple, kept.collect())) == [rows[0], rows[2]]
    assert one_of_each_group(docs.limit(0)).collect() == []
