"""The filter audit against a count per order, one document at a time."""

import random
from itertools import permutations

from coinfold.llm import audit
from coinfold.llm.audit import COUNTS, INTERVALS, ORDERS, filter_audit, totals

LABELS = "doc_id long, quality int, toxic int, part string, mask long"


def by_hand(rows, labels):
    """Totals by (part, order, step), by applying the five filters to every document in every order."""
    fails = []
    for doc_id, text, lang in rows:
        text = text or ""
        words = text.encode().split()
        capitals = sum(c in "ABCDEFGHIJKLMNOPQRSTUVWXYZ" for c in text)
        copy = doc_id is not None and any(i is not None and i < doc_id and (t or "") == text for i, t, _ in rows)
        failed = {
            "A": len(words) < 100,
            "B": 100 * len(set(words)) < 80 * len(words),
            "C": 100 * capitals > 10 * len(text),
            "D": any(c in text for c in "#$%&*|"),
            "E": copy,
        }
        said = [(q, t) for i, q, t in labels if i == doc_id and i is not None]
        fails.append((lang or "", {f for f, yes in failed.items() if yes}, any(q == 1 for q, _ in said), any(t == 1 for _, t in said)))
    out = {}
    for part in {f[0] for f in fails}:
        mine = [f[1:] for f in fails if f[0] == part]
        shapley = dict.fromkeys("ABCDE", 0)
        for order in permutations("ABCDE"):
            left = mine
            for step, x in enumerate(order, 1):
                gone = [d for d in left if x in d[0]]
                left = [d for d in left if x not in d[0]]
                shapley[x] += len(gone)
                redundant = sum(x in d[0] for d in mine) - len(gone)
                unique = sum(d[0] == {x} for d in mine)
                out[part, "".join(order), step] = [len(left), len(gone), redundant, unique, sum(d[1] for d in gone), sum(d[2] for d in gone)]
        for (p, order, step), row in out.items():
            if p == part:
                row.append(shapley[order[step - 1]])
    return {k: tuple(v) for k, v in out.items()}


def found(df):
    return {(r.part, r.filter_order, r.step): tuple(r[c] for c in COUNTS) for r in df.collect()}


def test_intervals_cover_each_order_once():
    assert ORDERS == sorted(ORDERS) and len(set(ORDERS)) == 120
    for mask, cuts in enumerate(INTERVALS):
        covered = sorted(r for _, _, low, high in cuts for r in range(low, high))
        assert covered == (list(range(120)) if mask else [])


def test_audit_against_every_order_by_hand(spark):
    rnd = random.Random(5)
    texts = ["", None, "HELLO WORLD", "a # b", " ".join(f"w{k}" for k in range(150)), "w " * 150, " ".join(f"X{k}" for k in range(120))]
    texts += [" ".join(rnd.choice("abcdefgh$") + str(rnd.randrange(200)) for _ in range(rnd.randrange(300))) for _ in range(12)]
    texts += ["ÄÖÜ 中文 " * 60, "A" + "中" * 9, "AB" + "中" * 18]
    rows = [(rnd.choice([i, i, i, None, i % 9]), rnd.choice(texts), rnd.choice(["en", "de", None, ""])) for i in range(120)]
    labels = [(rnd.randrange(140), rnd.choice([0, 1, None]), rnd.choice([0, 1, None])) for _ in range(90)] + [(None, 1, 1)]
    docs = spark.createDataFrame([(*r, 1, 1, 1) for r in rows], "doc_id long, text string, lang string, quality int, mask int, first int")
    said = spark.createDataFrame([(*r, "x", 3) for r in labels], LABELS)
    assert found(filter_audit(docs.repartition(3), said)) == by_hand(rows, labels)


def test_audit_of_empty_tables(spark):
    docs = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert filter_audit(docs, spark.createDataFrame([], LABELS)).collect() == []
    one = spark.createDataFrame([(1, None, None)], docs.schema)
    rows = found(filter_audit(one, spark.createDataFrame([], LABELS)))
    assert len(rows) == 600 and rows["", "ABCDE", 1] == (0, 1, 0, 1, 0, 0, 120)


def test_a_very_long_text_is_judged_whole(spark):
    text = "word " * 400_000 + "#"
    docs = spark.createDataFrame([(1, text, "en")], "doc_id long, text string, lang string")
    rows = found(filter_audit(docs, spark.createDataFrame([], LABELS)))
    assert rows["en", "DABCE", 1][1] == 1 and rows["en", "ABCDE", 1][1] == 0 and rows["en", "ABCDE", 2][1] == 1


def test_totals_need_no_documents_of_a_mask():
    import numpy as np

    none = np.zeros(0, np.int64)
    assert all((t == 0).all() for t in totals(none, none, none, none).values())
    assert audit._COPY == 16
