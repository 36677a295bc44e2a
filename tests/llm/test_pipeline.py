"""Each stage of the pipeline against what it should make of its own input."""

import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest

import corpus_pipeline
from coinfold.llm.mixing import MIX_SQL
from coinfold.llm.packing import Encoder, cut
from coinfold.llm.secrets import BASE_RULES, MORE_RULES
from coinfold.llm.simhash import fingerprint
from coinfold.llm.toxicity import toxicity

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark, tmp_path_factory):
    """The documents before the first stage and after each."""
    base = tmp_path_factory.mktemp("pipeline")
    odd = [(90001, None, "en", None, None), (90002, "", "en", "src1", 0), (None, "a text without an id", "en", "src2", 20), (90003, "token=abcdefghijk " * 40, "en", "src0", 680)]
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    docs = docs.unionByName(spark.createDataFrame(odd, docs.schema)).unionByName(docs.where("doc_id = 5"))
    out = []
    for k, stage in enumerate([None, *(f for _, f in corpus_pipeline.STAGES)]):
        made = stage(spark, docs, SF) if stage else docs
        made.write.parquet(f"{base}/{k}")
        docs = spark.read.parquet(f"{base}/{k}")
        out.append(docs)
    return out


def rows(docs):
    return Counter(map(tuple, docs.collect()))


def test_columns(steps):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "simhash near-dedup", "secret scans", "mixing sources", "best-fit packing"]
    for docs in steps[:-1]:
        assert docs.columns == steps[0].columns


def test_toxic_documents_go(spark, steps):
    scored = toxicity(steps[0], spark.read.parquet(f"{SF}/labels.parquet")).where("predicted = 0").collect()
    assert Counter(r.doc_id for r in scored) == Counter(r.doc_id for r in steps[1].collect())
    assert not rows(steps[1]) - rows(steps[0])


@pytest.mark.parametrize("labels", [[], [(987654321, 0, 1)], [(1, 0, 1), (2, 0, 1), (3, 0, 1)], [(1, 1, 0), (2, 1, 0)]])
def test_without_both_labels_no_document_goes(spark, steps, tmp_path, labels):
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert rows(corpus_pipeline.toxicity_stage(spark, steps[0], str(tmp_path))) == rows(steps[0])


def test_one_of_a_group_stays(steps):
    before = steps[1].collect()
    prints = {r.doc_id: fingerprint((r.text or "").encode()) & (2**64 - 1) for r in before if r.doc_id is not None}
    root = {i: i for i in prints}
    changed = True
    while changed:
        changed = False
        for a in prints:
            for b in prints:
                if (prints[a] ^ prints[b]).bit_count() <= 3 and root[a] != root[b]:
                    root[a] = root[b] = min(root[a], root[b])
                    changed = True
    got = Counter(r.doc_id for r in steps[2].collect())
    want = Counter(i for i, r in root.items() if i == r)
    want[None] = sum(r.doc_id is None for r in before)
    assert got == +want and not rows(steps[2]) - rows(steps[1])


def test_secrets_are_replaced(steps):
    before = {r.doc_id: r for r in steps[2].collect()}
    after = steps[3].collect()
    assert sorted(map(str, (r.doc_id for r in after))) == sorted(map(str, before))
    changed = 0
    for r in after:
        text, spans = before[r.doc_id].text, []
        for k, rule in enumerate(BASE_RULES + MORE_RULES):
            spans += [(m.start(), k, m.end(), rule.kind) for m in re.finditer(rule.pattern, text or "", re.A) if len(m.group(rule.group)) >= rule.least]
        out, at = "", 0
        for start, _, end, kind in sorted(spans):
            if start >= at:
                out += text[at:start] + f"[{kind}]"
            at = max(at, end)
        changed += bool(spans)
        assert r.text == (out + text[at:] if spans else text)
        assert r.n_chars == (len(r.text) if spans else before[r.doc_id].n_chars)
    assert changed  # the planted one at least; every kind is in test_texts.py


def test_the_mix(steps, tmp_path):
    steps[3].write.parquet(str(tmp_path / "documents"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents/*.parquet')")
    taken = con.execute(f"SELECT doc_id, taken // size FROM ({MIX_SQL}) WHERE taken > 0").fetchall()
    assert Counter(r.doc_id for r in steps[4].collect()) == Counter({i: int(n) for i, n in taken})
    assert not set(rows(steps[4])) - set(rows(steps[3]))


def test_the_sequences(steps):
    encoder, want = Encoder("byte_bpe_50k.json").tokenizer, Counter()
    for r in steps[4].collect():
        ids = [*encoder.encode(r.text or "", add_special_tokens=False).ids, 0]
        for nth, (start, length) in enumerate(cut(len(ids))):
            want[r.doc_id, nth, start, length, zlib.crc32(np.array(ids[start : start + length], dtype="<u4").tobytes())] += 1
    packed = steps[5].collect()
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in packed) == want
    full = Counter()
    for r in packed:
        full[r.sequence_id] += r.length
    assert max(full.values()) <= 2048 and len(full) <= -(-sum(full.values()) // 2048) + 2


def test_run_is_the_stages(spark):
    made = corpus_pipeline.run(spark, SF)
    assert set(made.columns) == {"doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"}
    assert made.count() > 100


def test_an_empty_table_passes_all_stages(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for name, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
        assert docs.collect() == [], name
