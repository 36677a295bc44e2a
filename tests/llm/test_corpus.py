import math
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest

from coinfold.llm.mixing import MIX_SQL, mix, mixed
from coinfold.llm.packing import Encoder, cut, pack, plan, sequences
from coinfold.llm import sharding
from coinfold.llm.sharding import SHARDS_SQL, assign_shards, write_shards
from tests.compare import compare

SF = "/root/testdata/sf0.001"


def in_duckdb(frame, sql, tmp_path):
    """What DuckDB makes of the same rows as table ``documents``."""
    frame.write.mode("overwrite").parquet(str(tmp_path / "documents"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{tmp_path}/documents/*.parquet')")
    return sql, con


def mixture(documents):
    rng = np.random.default_rng(6)
    rows = [(k, " ".join(["word"] * int(rng.integers(0, 90))) + "!" * int(rng.integers(0, 50)), f"s{int(rng.integers(0, 7)) // 2}") for k in range(400)]
    rows += [(1000, None, "s0"), (1001, "", None), (1002, "a b\tc\x0bd e", None), (1003, "x " * 9000, "big"), (1004, "", "empty"), (None, "no id here", "s1")]
    return rows, documents(*rows)


def test_mix_against_sql(documents, tmp_path):
    rows, frame = mixture(documents)
    result = mix(frame)
    assert compare(result, *in_duckdb(frame, MIX_SQL, tmp_path))[0] == ""
    got = result.collect()
    assert all(r.taken in (0, r.size, 2 * r.size) for r in got)
    source = {i: s for i, _, s in rows}
    taken, target = Counter(), {}
    for r in got:
        taken[source[r.doc_id]] += r.taken
        target[source[r.doc_id]] = r.target
    assert sum(target.values()) == pytest.approx(1.5 * sum(r.size for r in got))
    for s in target:
        if s in ("s0", "s1", "s2", "s3"):
            assert abs(taken[s] - target[s]) <= 5


def test_mix_is_native_and_repeatable(spark, documents):
    _, frame = mixture(documents)
    plan_text = mix(frame)._jdf.queryExecution().toString()
    assert not any(x in plan_text for x in ("Python", "Arrow", "Pandas"))
    assert sorted(map(tuple, mix(frame).collect()), key=repr) == sorted(map(tuple, mix(frame.repartition(5)).collect()), key=repr)
    assert mix(frame.where("false")).collect() == []


def test_mixed_rows(documents):
    _, frame = mixture(documents)
    frame = frame.unionByName(frame.where("doc_id = 5"))
    times = Counter()
    for r in mix(frame).collect():
        times[r.doc_id] += r.taken // r.size if r.size else 0
    out = mixed(frame)
    assert out.columns == frame.columns
    assert Counter(r.doc_id for r in out.collect()) == +times


def test_packing_round_trip(documents):
    rng = np.random.default_rng(2)
    words = ["the", "of", "größe", "naïve,", "don't", "x1", "日本", "foo.bar()", "\n\n", "  ", "end.", "—", "<|endoftext|>", " ", "ﬁ", "²"]
    rows = [(k, " ".join(rng.choice(words, int(rng.integers(0, 700))))) for k in range(150)]
    rows += [(200, None), (201, ""), (202, " "), (203, "word " * 9000), (204, "a\tb \n c  d "), (5, rows[5][1]), (None, "no id"), (205, "end " * 2047)]
    packed = pack(documents(*rows), keep_ids=True)
    got = packed.collect()
    encoder = Encoder("byte_bpe_50k.json").tokenizer
    want = Counter()
    for i, text in rows:
        ids = [*encoder.encode(text or "", add_special_tokens=False).ids, 0]
        for nth, (start, length) in enumerate(cut(len(ids))):
            part = np.array(ids[start : start + length], dtype="<u4").tobytes()
            want[(i, nth, start, length, zlib.crc32(part))] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    places = {}
    for r in got:
        places.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for held in places.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= 2048
    assert len(places) <= math.ceil(sum(r.length for r in got) / 2048) + 1
    made = {r.sequence_id: r.ids for r in sequences(packed).collect()}
    for r in got:
        assert made[r.sequence_id][4 * r.offset : 4 * (r.offset + r.length)] == r.ids
    assert pack(documents((1, "x")).where("false")).collect() == []


def test_pieces_of_a_document():
    assert cut(5, 10) == [(0, 5)] and cut(10, 10) == [(0, 10)]
    assert cut(25, 10) == [(0, 5), (5, 10), (15, 10)] and cut(20, 10) == [(0, 10), (10, 10)]


@pytest.mark.parametrize("seed", range(6))
def test_plans_use_every_piece_once(seed):
    rng = np.random.default_rng(seed)
    limit = 64
    counts = np.zeros(limit + 1, int)
    for x in rng.integers(1, limit + 1 if seed % 2 else 30, 400):
        counts[x] += rng.integers(1, 50)
    lines = plan(counts)
    used = np.zeros(limit + 1, int)
    for lengths, times in lines:
        assert sum(lengths) <= limit and times > 0
        for x in lengths:
            used[x] += times
    assert (used == counts).all()
    bound = -(-(counts * np.arange(limit + 1)).sum() // limit)
    big = counts[limit // 2 + 1 :].sum()
    assert sum(t for _, t in lines) <= max(bound * 1.05 + 2, big + 2)
    assert len(lines) <= 4 * limit


def test_shards_against_sql(spark, tmp_path, monkeypatch):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    sql = SHARDS_SQL.replace("16000000", "20000")
    assert compare(assign_shards(docs, 20_000), *in_duckdb(docs, sql, tmp_path))[0] == ""


def test_shards_stay_within_the_limit(spark, documents, tmp_path):
    rows = [(k, "x" * (k % 97)) for k in range(500)] + [(7, "y" * 40)] * 60 + [(600, "z" * 5000), (601, None), (None, "q" * 30)]
    docs = documents(*rows)
    got = assign_shards(docs, 300).collect()
    assert len(got) == len(rows)
    held, count = Counter(), Counter()
    for r in got:
        held[r.shard, r.page] += r.bytes
        count[r.shard, r.page] += 1
    assert all(n <= 300 or count[k] == 1 for k, n in held.items())
    assert sum(n for k, n in held.items() if k[1] or (k[0], 1) in held) >= 60 * 40
    shards = {k[0] for k in held}
    assert not any(a != b and b.startswith(a) for a in shards for b in shards)
    write_shards(docs, str(tmp_path / "out"), 300)
    back = spark.read.option("recursiveFileLookup", "true").parquet(str(tmp_path / "out"))
    assert Counter((r.doc_id, r.text) for r in back.collect()) == Counter(rows)
    assert assign_shards(docs.where("false"), 300).collect() == []


def test_writing_shards_deals_nothing_by_id(spark, documents, tmp_path, monkeypatch):
    rows = [(None, "q" * (k % 30)) for k in range(200)] + [(7, "y" * (k % 50)) for k in range(200)] + [(k, "x") for k in range(50)]
    dealt = []

    real = sharding.Window

    class Spy(real):
        @staticmethod
        def partitionBy(*cols):
            dealt.extend(map(str, cols))
            return real.partitionBy(*cols)

    monkeypatch.setattr(sharding, "Window", Spy)
    write_shards(documents(*rows), str(tmp_path / "out"), 300)
    assert dealt and "doc_id" not in dealt
    back = spark.read.option("recursiveFileLookup", "true").parquet(str(tmp_path / "out"))
    assert Counter((r.doc_id, r.text) for r in back.collect()) == Counter(rows)


def test_the_quicker_library_gives_the_tokenizers_ids():
    """For every code point of the first planes that hold letters, in several settings, and for texts of odd shape."""
    encoder = Encoder("byte_bpe_50k.json")
    assert encoder.quick is not None
    texts = []
    for low in [*range(0, 0x3000, 512), 0xA700, 0xFE00, 0xFF00, 0x1F300, 0x1F900, 0x20000]:
        points = (chr(c) for c in range(low, low + 512) if not 0xD800 <= c < 0xE000)
        texts.append("".join(f"a{c}b {c}1 {c}! {c}{c} \n'{c}s" for c in points))
    texts += ["", " ", "\n\n x", "x" * 50_000, " " * 50_000, "ab1!" * 9_000, "It's we'll I'D 'tis", "a <|endoftext|> b", "\x00\x01"]
    for text in texts:
        assert encoder.ids(text) == encoder.whole(text)


def test_other_tokenizers_are_used_as_they_are(tmp_path):
    import json

    import public_tokenizers

    assert Encoder("word_bpe_49k.json").quick is None
    with open(public_tokenizers.path("byte_bpe_50k.json"), encoding="utf-8") as file:
        model = json.load(file)
    model["pre_tokenizer"]["add_prefix_space"] = True
    path = tmp_path / "other.json"
    path.write_text(json.dumps(model))
    other = Encoder(str(path))
    assert other.quick is None and other.ids("word") == other.whole(" word")


def test_no_cell_holds_much_of_a_source(documents, tmp_path, monkeypatch):
    """Very long words, null ids and one repeated id: cells of the sort stay small, and the mix is that of the SQL."""
    from coinfold.llm import mixing

    rows = [(k if k % 3 else (7 if k % 2 else None), "x" * 900 + " y" if k % 2 else "word " * (k % 9), "s") for k in range(4000)]
    kept = []
    before = mixing.staged

    def spy(df, name):
        kept.append((name, out := before(df, name)))
        return out

    monkeypatch.setattr(mixing, "staged", spy)
    result = mix(documents(*rows))
    cells = dict(kept)["cells"].groupBy("source", "cell").count().collect()
    assert max(r["count"] for r in cells) < 0.012 * len(rows)
    assert sum(r.taken for r in result.collect()) > 0
