import json
import os

import pytest
from pyspark.sql import functions as F

from coinfold.operators.items import block_items, transaction_items
from coinfold.plans.ingest import backfill_range, ingest_raw, load_items
from coinfold.plans.repair import repair
from coinfold.schemas import TXOUTS
from coinfold.sources import items as item_source
from coinfold.sources.raw import raw_block_stream, read_raw_blocks
from coinfold.sources.tables import (
    Ledger,
    conflict_strategy,
    layout_changes,
    migrate_catalog,
    read_table,
    write_keyed,
)
from coinfold.streaming.backfill import run as backfill
from coinfold.streaming.follow import Follow, catch_up, run_follow


def chain_block(h, value="0.5", prefix="t"):
    return {
        "hash": f"b{h}-{prefix}", "height": h, "time": 1_600_000_000 + 60 * h,
        "tx": [{"txid": f"{prefix}{h}", "vin": [{"txid": f"{prefix}{h - 1}", "vout": 0}],
                "vout": [{"n": 0, "value": value, "asset": "a",
                          "scriptPubKey": {"address": f"addr{h}"}}]}],
    }


def land_file(folder, name, *blocks):
    folder.mkdir(exist_ok=True)
    lines = [b if isinstance(b, str) else json.dumps(b) for b in blocks]
    (folder / name).write_text("\n".join(lines))
    return str(folder)


def outputs(spark, *rows):
    return spark.createDataFrame(rows, "txid string, vout int, address string, block_height bigint")


def stored(spark, path):
    return sorted(tuple(r) for r in read_table(spark, path, TXOUTS).select(
        "txid", "vout", "address", "height_bucket").collect())


def put(spark, path, rows, **options):
    write_keyed(spark, path, TXOUTS, outputs(spark, *rows), ("txid", "vout"), "block_height",
                bucket_size=10, **options)


def test_update_by_key(spark, tmp_path):
    path = str(tmp_path / "t")
    put(spark, path, [("a", 0, "old", 1), ("a", 0, "newer", 2), ("b", 0, "x", 25)])
    assert stored(spark, path) == [("a", 0, "newer", 0), ("b", 0, "x", 2)]
    for _ in range(2):  # a repeated batch changes nothing
        put(spark, path, [("a", 0, "last", 3), ("c", 1, "y", 4)])
        assert stored(spark, path) == [
            ("a", 0, "last", 0), ("b", 0, "x", 2), ("c", 1, "y", 0)]
    put(spark, path, [("b", 0, "moved", 5)])  # leaves its old bucket empty
    assert ("b", 0, "moved", 0) in stored(spark, path) and len(stored(spark, path)) == 3


def test_ignore_by_key(spark, tmp_path):
    path = str(tmp_path / "t")
    put(spark, path, [("a", 0, "first", 1), ("a", 0, "second", 2)], strategy="ignore")
    put(spark, path, [("a", 0, "third", 1), ("b", 0, "x", 1)], strategy=" Ignore ")
    assert stored(spark, path) == [("a", 0, "first", 0), ("b", 0, "x", 0)]
    assert conflict_strategy("update", fast=True) == "ignore"
    with pytest.raises(ValueError):
        conflict_strategy("replace")
    with pytest.raises(Exception, match="without key column"):
        put(spark, path, [(None, 0, "x", 1)])


def test_ingest_range_and_resume(spark, tmp_path):
    landing = land_file(tmp_path / "in", "1.json", *[chain_block(h) for h in range(8, 14)])
    ledger = Ledger(spark, str(tmp_path / "ledger"))
    ingest_raw(read_raw_blocks(spark, landing), ledger, "main", 10, 11, batch_id="one")
    assert {n: t.count() for n, t in ledger.tables().items()} == dict.fromkeys(
        ("blocks", "transactions", "txins", "txouts"), 2)
    assert [r.batch_id for r in ledger.committed().collect()] == ["one"]
    assert backfill_range(ledger, 0, 20) == (12, 20) and backfill_range(ledger, 0, 11) is None
    assert tuple(catch_up(ledger.table("blocks"), 20, 5).first()) == (15, 12, 4)


def test_item_files_into_tables(spark, tmp_path):
    raw = read_raw_blocks(spark, land_file(tmp_path / "in", "1.json", chain_block(0), chain_block(1)))
    for kind, made in (("b", block_items(raw)), ("t", transaction_items(raw))):
        item_source.write_items(made, str(tmp_path / kind))
    ledger = Ledger(spark, str(tmp_path / "ledger"))
    load_items(spark, ledger, str(tmp_path / "b"), str(tmp_path / "t"))
    row = ledger.table("txouts").where("txid = 't1'").first()
    assert (row.value_sat, row.address) == (50_000_000, "addr1")
    assert sorted(r.height for r in ledger.table("blocks").collect()) == [0, 1]


def test_export_layout(spark, tmp_path):
    raw = read_raw_blocks(spark, land_file(tmp_path / "in", "1.json",
                                           *[chain_block(h) for h in range(5)]))
    out = tmp_path / "out"
    item_source.export_partitions(raw, str(out), "side", start=0, end=3, batch_size=2)
    item_source.export_partitions(raw, str(out), "side", day="2020-09-13", batch_size=2,
                                  enrich_from=transaction_items(raw))
    folders = {str(p.parent.relative_to(out)) for p in out.rglob("*.json")}
    assert "blocks/chain=side/range=blocks/block_start=2/block_end=3" in folders
    assert "transactions/chain=side/date=2020-09-13/block_start=0/block_end=1" in folders
    assert "enriched_transactions/chain=side/date=2020-09-13/block_start=4/block_end=4" in folders
    with pytest.raises(ValueError):
        item_source.export_partitions(raw, str(out), "side", start=0)
    with pytest.raises(ValueError):
        item_source.export_partitions(raw, str(out), "side", start=3, end=1)


def test_repair(spark, tmp_path):
    full = [chain_block(h) for h in range(10)]
    landing = land_file(tmp_path / "full", "1.json", *full)
    ledger = Ledger(spark, str(tmp_path / "ledger"), bucket_size=3)
    assert repair(ledger).start is None
    rival = chain_block(4, prefix="r")
    rival["tx"].append({"txid": "r4b", "vin": [], "vout": []})
    part = land_file(tmp_path / "part", "1.json", *[b for b in full if b["height"] not in (2, 6, 7)],
                     rival)
    ingest_raw(read_raw_blocks(spark, part), ledger, "main")
    dry = repair(ledger, start=9, end=0, dry_run=True)
    assert [r.keep_hash for r in dry.duplicates.collect()] == ["b4-r"]
    assert tuple(dry.totals.first()) == (3, 2) and ledger.table("blocks").count() == 8
    with pytest.raises(ValueError):
        repair(ledger, dedupe=False)
    repair(ledger, read_raw_blocks(spark, landing))
    hashes = {r.hash for r in ledger.table("blocks").collect()}
    assert hashes == {f"b{h}-t" for h in range(10) if h != 4} | {"b4-r"}
    assert "t4" not in {r.txid for r in ledger.table("txins").collect()}
    assert repair(ledger).totals.first().ranges == 0


def test_stream_equals_batch_with_lag_and_dead_letters(spark, tmp_path):
    landing = tmp_path / "landing"
    ledger = Ledger(spark, str(tmp_path / "ledger"))
    dead = tmp_path / "dead"
    follow = Follow(str(tmp_path / "state"), ledger, topics=str(tmp_path / "topic"), start=0,
                    lag=2, enrich=True, dead_letters=str(dead))

    def heights():
        return sorted(r.height for r in ledger.table("blocks").collect())

    land_file(landing, "1.json", *[chain_block(h) for h in range(4)], "broken", '{"height": 9}')
    run_follow(raw_block_stream(spark, str(landing)), follow).awaitTermination()
    assert heights() == [0, 1]
    land_file(landing, "2.json", *[chain_block(h) for h in range(4, 7)], chain_block(1))
    run_follow(raw_block_stream(spark, str(landing)), follow).awaitTermination()
    assert heights() == [0, 1, 2, 3, 4]
    letters = spark.read.json(f"{dead}/batch=*").collect()
    assert {(r.height, r.error) for r in letters} == {
        (None, "broken"), (9, "block without hash or height")}
    spent = {r.txid: r.prevout_address for r in ledger.table("txins").collect()}
    assert spent == {"t0": None, "t1": "addr0", "t2": "addr1", "t3": "addr2", "t4": "addr3"}
    topic = spark.read.json(f"{tmp_path}/topic.blocks/batch=*")
    assert {r.item_id for r in topic.collect()} == {f"b{h}-t" for h in range(5)}


def test_stream_aborts_without_dead_letters(spark, tmp_path):
    landing = land_file(tmp_path / "landing", "1.json", "broken")
    follow = Follow(str(tmp_path / "state"), Ledger(spark, str(tmp_path / "ledger")))
    query = run_follow(raw_block_stream(spark, landing), follow)
    with pytest.raises(Exception, match="unusable block"):
        query.awaitTermination()
    with pytest.raises(ValueError):
        run_follow(raw_block_stream(spark, landing), Follow("s", topics="t"))


def test_backfill_then_stream(spark, tmp_path):
    landing = land_file(tmp_path / "landing", "1.json", *[chain_block(h) for h in range(6)])
    ledger = Ledger(spark, str(tmp_path / "ledger"))
    follow = Follow(str(tmp_path / "state"), ledger)
    first = backfill(landing, follow, "backfill", end=3)
    assert first.backfilled == (0, 3) and first.query is None
    second = backfill(landing, follow, end=3)
    assert second.backfilled is None
    second.query.awaitTermination()
    assert ledger.table("blocks").count() == 6
    with pytest.raises(ValueError):
        backfill(landing, follow, "sideways")


def test_layouts_of_earlier_versions(spark):
    assert layout_changes({"blocks": ["number"], "transactions": ["tx_index"]}) == [
        ("blocks", "blocks_legacy"), ("transactions", "transactions_legacy")]
    assert layout_changes({"blocks_v2": ["height"], "txins_v2": ["txid"]}) == [
        ("blocks_v2", "blocks"), ("txins_v2", "txins")]
    assert layout_changes({"blocks": ["height"], "blocks_v2": ["height"]}) == []
    assert layout_changes({"blocks": ["number"], "blocks_v2": ["height"]}) == [
        ("blocks", "blocks_legacy"), ("blocks_v2", "blocks")]
    assert migrate_catalog(spark) == []


@pytest.mark.parametrize("done", [0, 1, 2, 3])
def test_a_broken_batch_is_taken_again(spark, tmp_path, monkeypatch, done):
    """Broken off after each of the tables and started anew, nothing is missing."""
    from coinfold.sources import tables as module

    landing = land_file(tmp_path / "landing", "1.json", *[chain_block(h) for h in range(5)])
    whole = Ledger(spark, str(tmp_path / "whole"))
    backfill(landing, Follow(str(tmp_path / "s1"), whole), "backfill")
    ledger, written = Ledger(spark, str(tmp_path / "broken")), []
    write = module.write_keyed

    def breaking(*args, **more):
        if len(written) == done:
            raise RuntimeError("lost")
        written.append(args[1])
        write(*args, **more)

    with monkeypatch.context() as patch:
        patch.setattr(module, "write_keyed", breaking)
        with pytest.raises(RuntimeError, match="lost"):
            backfill(landing, Follow(str(tmp_path / "s2"), ledger), "backfill")
    assert ledger.committed().count() == 0
    backfill(landing, Follow(str(tmp_path / "s2"), ledger), "backfill")
    for name in whole.tables():
        rows = lambda x: sorted(map(str, x.table(name).collect()))  # noqa: B023, E731
        assert rows(ledger) == rows(whole) and rows(whole)


def test_files_that_land_late_are_taken(spark, tmp_path):
    landing = tmp_path / "landing"
    ledger = Ledger(spark, str(tmp_path / "ledger"))
    follow = Follow(str(tmp_path / "state"), ledger)
    for name, heights in (("a.json", range(10, 13)), ("b.json", range(4)), ("c.json", [20, 7])):
        land_file(landing, name, *[chain_block(h) for h in heights])
        run_follow(raw_block_stream(spark, str(landing)), follow).awaitTermination()
    assert sorted(r.height for r in ledger.table("blocks").collect()) == [0, 1, 2, 3, 7, 10, 11, 12, 20]
    assert ledger.table("transactions").count() == 9


def test_new_keys_rewrite_no_file(spark, tmp_path):
    ledger = Ledger(spark, str(tmp_path / "ledger"))
    files = lambda: {str(f): f.stat().st_mtime_ns for f in (tmp_path / "ledger").rglob("part-*")}
    seen = {}
    for first in (0, 3, 6):
        landing = land_file(tmp_path / f"landing{first}", "1.json", *[chain_block(h) for h in range(first, first + 3)])
        ingest_raw(read_raw_blocks(spark, landing), ledger, "main", batch_id=str(first))
        now = files()
        assert seen.items() <= now.items() and len(now) > len(seen)
        seen = now
    assert ledger.table("blocks").count() == 9


@pytest.mark.parametrize("strategy, size", [("update", 100), ("ignore", 900)])
def test_the_last_item_in_the_files_wins(spark, tmp_path, strategy, size):
    lines = lambda *rows: "\n".join(json.dumps(r) for r in rows)
    (tmp_path / "b").mkdir()
    (tmp_path / "b" / "1.json").write_text(lines({"hash": "x", "number": 1, "size": 900}, {"hash": "y", "number": 1, "size": 5}))
    (tmp_path / "b" / "2.json").write_text(lines({"hash": "x", "number": 1, "size": 950}, {"hash": "x", "number": 1, "size": 100}))
    ledger = Ledger(spark, str(tmp_path / "ledger"), strategy=strategy)
    load_items(spark, ledger, str(tmp_path / "b"))
    assert {r.hash: r.size for r in ledger.table("blocks").collect()} == {"x": size, "y": 5}


def test_stream_into_flat_tables_and_any_sink(spark, tmp_path, capsys):
    from coinfold.streaming.follow import console, format_sink

    landing = tmp_path / "landing"
    text = format_sink("json", "topic", path=str(tmp_path / "sunk"))

    def sink(topic, lines, number):
        console(topic, lines, number)
        text(topic, lines, number)

    follow = Follow(str(tmp_path / "state"), start=0, flat=str(tmp_path / "flat"), sink=sink)
    for name, heights in (("1.json", range(2)), ("2.json", range(2, 5))):
        land_file(landing, name, *[chain_block(h) for h in heights])
        run_follow(raw_block_stream(spark, str(landing)), follow).awaitTermination()
    assert sorted(r.number for r in spark.read.parquet(str(tmp_path / "flat/blocks")).collect()) == list(range(5))
    assert spark.read.parquet(str(tmp_path / "flat/transactions")).count() == 5
    assert spark.read.json(str(tmp_path / "sunk")).count() == 10
    assert capsys.readouterr().out.count("blocks\t") == 5


def test_exports_have_few_files(spark, tmp_path):
    landing = land_file(tmp_path / "landing", "1.json", *[chain_block(h) for h in range(40)])
    raw = read_raw_blocks(spark, landing).repartition(4)
    item_source.export_partitions(raw, str(tmp_path / "out"), "side", start=0, end=39, batch_size=20)
    for folder in (tmp_path / "out").rglob("block_end=*"):
        assert len(list(folder.glob("part-*"))) == 1


def breaking_after(module, patch, steps):
    """From here on, the writes of a commit fail after so many of them."""
    done, write, put = [], module.Versions.write, module.files.put

    def counted(use):
        def run(*args, **more):
            if len(done) == steps:
                raise RuntimeError("lost")
            done.append(use.__name__)
            return use(*args, **more)

        return run

    patch.setattr(module.Versions, "write", counted(write))
    patch.setattr(module.files, "put", counted(put))
    return done


@pytest.mark.parametrize("strategy", ["update", "ignore"])
def test_a_break_at_any_step_leaves_the_old_state(spark, tmp_path, monkeypatch, strategy):
    from coinfold.sources import tables as module

    land = lambda name, *blocks: read_raw_blocks(spark, land_file(tmp_path / name, "1.json", *blocks))
    first, second = land("a", *[chain_block(h) for h in range(6)]), land("b", *[chain_block(h, "0.7") for h in range(3, 9)])
    ledger = Ledger(spark, str(tmp_path / "ledger"), strategy, bucket_size=4)
    ingest_raw(first, ledger, "main", batch_id="one")
    state = lambda: {n: sorted(map(str, t.collect())) for n, t in ledger.tables().items()}
    before, held, steps = state(), ledger.tables(), 0
    while True:
        with monkeypatch.context() as patch:
            done = breaking_after(module, patch, steps)
            try:
                ingest_raw(second, ledger, "main", batch_id="two", land=False)
            except RuntimeError as error:
                assert "lost" in str(error)
                assert state() == before and [r.batch_id for r in ledger.committed().collect()] == ["one"]
                steps += 1 if strategy == "update" else 4
                continue
        break
    assert steps >= 9 and done[-1] == "put"  # four tables with their indexes, rewritten parts, one commit
    after = state()
    assert len(after["blocks"]) == 9 and sorted(r.batch_id for r in ledger.committed().collect()) == ["one", "two"]
    values = {r.txid: r.value_sat for r in ledger.table("txouts").collect()}
    assert values["t4"] == (70_000_000 if strategy == "update" else 50_000_000) and values["t0"] == 50_000_000
    # plans built before the commit still see what they were built on
    assert {n: sorted(map(str, t.collect())) for n, t in held.items()} == before
    left = ledger.clean(keep=1)
    assert left > 0 and state() == after and ledger.clean(keep=1) == 0
    assert sorted(r.batch_id for r in ledger.committed().collect()) == ["one", "two"]


def test_two_writers_do_not_lose_a_batch(spark, tmp_path):
    from coinfold.sources.files import AlreadyThere
    from coinfold.sources.tables import Batch, Versions

    path = str(tmp_path / "t")
    put(spark, path, [("a", 0, "x", 1)])
    slow = Batch(Versions(spark, path))
    put(spark, path, [("b", 0, "y", 1)])
    with pytest.raises(AlreadyThere):
        slow.commit()
    assert [r[0] for r in stored(spark, path)] == ["a", "b"]


def test_many_small_parts_become_one(spark, tmp_path, monkeypatch):
    from coinfold.sources import tables as module

    monkeypatch.setattr(module, "MOST_PARTS", 3)
    path = str(tmp_path / "t")
    for n in range(6):
        put(spark, path, [(f"k{n}", 0, "x", 1), (f"k{n}", 1, "x", 25)])
    live = module.Versions(spark, path).current()["tables"][""]
    assert len(stored(spark, path)) == 12 and max(map(len, live.values())) <= 3


def test_only_parts_with_known_keys_are_rewritten(spark, tmp_path):
    from coinfold.sources.tables import Versions

    path = str(tmp_path / "t")
    for n in range(3):
        put(spark, path, [(f"k{n}", 0, "x", 10 * n)])
    before = Versions(spark, path).current()["tables"][""]
    put(spark, path, [("k1", 0, "new", 10)])
    after = Versions(spark, path).current()["tables"][""]
    assert (after[0], after[2]) == (before[0], before[2]) and not set(after[1]) & set(before[1])
    assert stored(spark, path) == [("k0", 0, "x", 0), ("k1", 0, "new", 1), ("k2", 0, "x", 2)]


def test_a_sink_takes_a_batch_once(spark, tmp_path):
    """A micro-batch that is run again gives its rows to a sink no second time; one that broke off does."""
    from coinfold.streaming import follow as module

    raw = read_raw_blocks(spark, land_file(tmp_path / "in", "1.json", *[chain_block(h) for h in range(4)]))
    text, fails = module.format_sink("json", "topic", path=str(tmp_path / "sunk")), [True]

    def sink(topic, lines, number):
        if topic == "transactions" and fails:
            fails.pop()
            raise RuntimeError("lost")
        text(topic, lines, number)

    follow = Follow(str(tmp_path / "state"), start=0, sink=sink)
    with pytest.raises(RuntimeError, match="lost"):
        module.process_batch(raw, 0, follow, 0)
    for _ in range(2):
        module.process_batch(raw, 0, follow, 0)
    assert spark.read.json(str(tmp_path / "sunk")).count() == 8
    module.process_batch(raw, 1, follow, 0)
    assert spark.read.json(str(tmp_path / "sunk")).count() == 16


def test_progress_of_a_running_stream(spark, tmp_path):
    import time

    from coinfold.streaming.follow import Progress

    landing, listener = tmp_path / "landing", Progress(lag=2, head=lambda: 20)
    spark.streams.addListener(listener)
    try:
        follow = Follow(str(tmp_path / "state"), start=0, lag=2, topics=str(tmp_path / "topic"), dead_letters=str(tmp_path / "dead"))
        for name, blocks in (("1.json", range(4)), ("2.json", range(9, 12)), ("3.json", range(4, 9))):
            land_file(landing, name, *[chain_block(h) for h in blocks], *["broken"] * (name == "2.json"))
            run_follow(raw_block_stream(spark, str(landing)), follow).awaitTermination()
        for _ in range(50):
            if len(listener.rows) >= 3:
                break
            time.sleep(0.2)
    finally:
        spark.streams.removeListener(listener)
    rows = [(r["head"], r["current"], r["remaining"], r["blocks"], r["unusable"]) for r in listener.rows if r["blocks"]]
    assert rows == [(18, 2, 17, 4, 0), (18, 10, 9, 3, 1), (18, 10, 9, 5, 0)]


def test_new_keys_open_no_bucket_of_the_table(spark, tmp_path):
    """With the table's files gone, a batch of new keys is still written; one with a known key is not."""
    import shutil

    from coinfold.sources.tables import Versions

    path = str(tmp_path / "t")
    for n in range(3):
        put(spark, path, [(f"k{n}", 0, "x", 10 * n), (f"m{n}", 0, "x", 10 * n)])
    live = Versions(spark, path).current()["tables"][""]
    for version in {v for vs in live.values() for v in vs}:
        shutil.rmtree(f"{path}/table_version={version}")
    put(spark, path, [("new", 0, "x", 5), ("other", 0, "x", 15)])
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        put(spark, path, [("k1", 0, "x", 5)])


def test_the_index_follows_moved_and_replaced_keys(spark, tmp_path, monkeypatch):
    from coinfold.sources import tables as module

    monkeypatch.setattr(module, "MOST_PARTS", 2)
    path = str(tmp_path / "t")
    want = {}
    for n, rows in enumerate([[("a", 1), ("b", 11)], [("a", 25)], [("a", 2), ("c", 12)], [("b", 13)], [("a", 14), ("b", 1)], [("c", 29)]]):
        put(spark, path, [(k, 0, f"v{n}", h) for k, h in rows])
        want |= {k: (k, 0, f"v{n}", h // 10) for k, h in rows}
        assert stored(spark, path) == sorted(want.values())
    batch = module.Batch(module.Versions(spark, path))
    content = read_table(spark, path, TXOUTS).where("txid = 'a'")
    batch.replace("", content, {1}, ("txid", "vout"))
    batch.commit()
    put(spark, path, [("a", 0, "last", 3)])
    assert [r for r in stored(spark, path) if r[0] == "a"] == [("a", 0, "last", 0)]


def test_a_table_write_leaves_no_shuffle_behind(spark, tmp_path):
    """What it shuffled is gone when it has ended, its files are compressed with zstd, and the session's setting is as before."""
    import time

    from coinfold.schemas import TXOUTS
    from coinfold.sources.tables import read_table, write_keyed

    disk = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffled():
        found = disk.getAllFiles()
        return {name for i in range(found.size()) if (name := found.apply(i).getName()).startswith("shuffle_")}

    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, was = shuffled(), spark.conf.get(setting, None)
    rows = spark.range(200).selectExpr(
        "concat('t', id % 50) AS txid", "cast(0 AS int) AS vout", "id AS block_height", "concat('a', id) AS address"
    )
    path = str(tmp_path / "txouts")
    write_keyed(spark, path, TXOUTS, rows, ("txid", "vout"), "block_height", bucket_size=60)
    until = time.time() + 20
    while (left := shuffled() - before) and time.time() < until:
        time.sleep(0.2)
    assert not left
    assert spark.conf.get(setting, None) == was
    read = read_table(spark, path, TXOUTS)
    assert sorted(r.address for r in read.collect()) == [f"a{i}" for i in range(150, 200)]
    assert all(f.endswith(".zstd.parquet") for f in read.inputFiles())


class Stop(Exception):
    """Ends a query where it was looked at."""


def orders_at(spark, tmp_path, orders=60):
    rows = spark.range(1, orders).selectExpr(
        "id AS o_orderkey", "id AS o_custkey", "'F' AS o_orderstatus", "CAST(id AS DOUBLE) AS o_totalprice",
        "TIMESTAMP '1998-01-01 00:00:00' AS o_orderdate",
    )
    rows.write.parquet(str(tmp_path / "orders.parquet"))
    return str(tmp_path)


def test_a_day_is_exported_from_parsed_blocks(spark, tmp_path, monkeypatch):
    """The export is given blocks that were parsed, and keeps no second copy of them."""
    from coinfold.plans import catalog_jobs

    seen = {}

    def export(raw, *_, land=True, enrich_from, **__):
        seen.update(land=land, plans=[f._jdf.queryExecution().optimizedPlan().toString() for f in (raw, enrich_from)])
        raise Stop

    monkeypatch.setattr(catalog_jobs.item_source, "export_partitions", export)
    with pytest.raises(Stop):
        catalog_jobs.exported_day_enriched(spark, orders_at(spark, tmp_path))
    assert not seen["land"] and not any("from_json" in plan for plan in seen["plans"])


def test_what_has_landed_is_one_micro_batch(spark, tmp_path, monkeypatch):
    """However many files lie there, the stream takes them at once."""
    from coinfold.plans import catalog_jobs

    def stream(_, path, max_files=100):
        raise Stop(max_files, len([f for f in os.listdir(path) if f.endswith(".txt")]))

    monkeypatch.setattr(catalog_jobs, "raw_block_stream", stream)
    monkeypatch.setattr(catalog_jobs, "_orders", lambda spark, sf: spark.read.parquet(f"{sf}/orders.parquet").withColumn(
        "o_orderkey", F.col("o_orderkey") + 2000).repartition(120, "o_orderkey"))
    with pytest.raises(Stop) as stopped:
        catalog_jobs.followed_out_of_order(spark, orders_at(spark, tmp_path, 1000))
    most, landed = stopped.value.args
    assert 100 < landed <= most
