"""Work that has to grow no faster than its input: parts, passes, files."""

from coinfold.operators.items import block_items, transaction_items
from coinfold.operators.rows import bulk_rows
from coinfold.plans import catalog_jobs, ingest, ledger_view
from coinfold.plans.catalog_jobs import _landed, _orders, chain_text
from coinfold.plans.ingest import load_items
from coinfold.plans.repair import repair
from coinfold.sources import items as item_source
from coinfold.sources.raw import parse_raw_blocks
from coinfold.sources.tables import Ledger, one_per_key
from coinfold.streaming.follow import write_topics


def some_orders(spark, path, n=40):
    rows = spark.range(n).selectExpr(
        "id AS o_orderkey", "id % 7 AS o_custkey", "substring('FOP', CAST(id % 3 AS INT) + 1, 1) AS o_orderstatus",
        "CAST(id AS DOUBLE) + 0.25D AS o_totalprice", "timestamp_seconds(883612800 + id * 3600) AS o_orderdate",
    )
    rows.coalesce(1).write.mode("overwrite").parquet(f"{path}/orders.parquet")
    return str(path)


def test_orders_are_dealt_out_by_size(spark, tmp_path, monkeypatch):
    sf = some_orders(spark, tmp_path)
    assert _orders(spark, sf).rdd.getNumPartitions() == spark.sparkContext.defaultParallelism
    monkeypatch.setattr(ledger_view, "_PART_BYTES", 100)
    assert _orders(spark, sf).rdd.getNumPartitions() > spark.sparkContext.defaultParallelism
    assert _orders(spark, sf).count() == 40


def test_repair_parses_once(spark, tmp_path, monkeypatch):
    """Missing blocks are kept as parquet before the four tables read them."""
    seen, land = [], ingest.land_raw_blocks
    monkeypatch.setattr(ingest, "land_raw_blocks", lambda raw, *rest: (seen.append(raw.count()), land(raw, *rest)))
    raw = parse_raw_blocks(chain_text(_orders(spark, some_orders(spark, tmp_path / "sf"))))
    ledger = Ledger(spark, str(tmp_path / "ledger"))
    ledger.write(bulk_rows(raw.where("height % 3 <> 1"), "main"))
    repair(ledger, raw, start=0, end=39)
    assert seen == [13]
    assert {n: t.count() for n, t in ledger.tables().items()} == dict.fromkeys(ledger.tables(), 40)

def test_a_kept_row_is_carried_once(spark):
    """The row is the ranked struct itself, maps included; ties are settled by the row, the first or the last in order."""
    text = "SELECT * FROM VALUES ('k', 2, 'a', map('x', 1L)), ('k', 2, 'b', map('x', 3L, 'y', 1L)), ('k', 1, 'c', null), ('m', null, null, null), ('m', 0, null, map()) AS t(k, at, v, m)"
    batch = spark.sql(text)
    last, first = one_per_key(batch, ("k",), ["at"]), one_per_key(batch, ("k",), ["at"], last=False)
    assert last.columns == batch.columns and last.schema.simpleString() == batch.schema.simpleString()
    assert sorted(map(tuple, last.collect())) == [("k", 2, "b", {"x": 3, "y": 1}), ("m", 0, None, {})]
    assert sorted(map(tuple, first.collect())) == [("k", 1, "c", None), ("m", None, None, None)]
    assert "max_by" not in last._jdf.queryExecution().optimizedPlan().toString()

def test_items_and_topics_are_compressed(spark, tmp_path):
    raw = parse_raw_blocks(chain_text(_orders(spark, some_orders(spark, tmp_path / "sf"))))
    path, made = str(tmp_path / "items"), block_items(raw)
    item_source.write_items(made, path)
    item_source.write_items(made, path, append=True)
    assert {p.suffix for p in (tmp_path / "items").glob("part-*")} == {".gz"}
    read = item_source.read_block_items(spark, path)
    assert sorted(r.hash for r in read.collect()) == sorted(2 * [r.hash for r in made.collect()])
    write_topics(made, made, str(tmp_path / "topic"), 0)
    assert {p.suffix for p in (tmp_path / "topic.blocks" / "batch=0").glob("part-*")} == {".gz"}
    assert spark.read.json(str(tmp_path / "topic.blocks")).count() == 40
    item_source.export_partitions(raw, str(tmp_path / "out"), "side", start=3, end=9, compression="gzip")
    assert {p.suffix for p in (tmp_path / "out").rglob("part-*")} == {".gz"}
    assert spark.read.json(str(tmp_path / "out" / "blocks")).count() == 7

def test_loaded_items_are_parsed_once(spark, tmp_path, monkeypatch):
    """What the four tables read is parquet, with the place of each item."""
    raw = parse_raw_blocks(chain_text(_orders(spark, some_orders(spark, tmp_path / "sf"))))
    blocks, transactions = str(tmp_path / "b"), str(tmp_path / "t")
    item_source.write_items(block_items(raw), blocks)
    item_source.write_items(transaction_items(raw), transactions)
    given, rows = [], ingest.item_rows
    monkeypatch.setattr(ingest, "item_rows", lambda *items: (given.extend(items), rows(*items))[1])
    ledger = Ledger(spark, str(tmp_path / "ledger"))
    load_items(spark, ledger, blocks, transactions)
    assert all(f.endswith(".parquet") for items in given for f in items.inputFiles())
    assert {n: t.count() for n, t in ledger.tables().items()} == dict.fromkeys(ledger.tables(), 40)

def test_large_tables_land_in_more_files(spark, tmp_path, monkeypatch):
    sf = some_orders(spark, tmp_path / "sf")
    assert len(spark.read.text(_landed(spark, sf, 2)).inputFiles()) == 2
    monkeypatch.setattr(catalog_jobs, "_FILE_BLOCKS", 8)
    landed = spark.read.text(_landed(spark, sf, 2))
    assert len(landed.inputFiles()) == 5 and landed.count() == 40
