"""Catalog: sources, sinks, keyed tables, repair and streams."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from coinfold.operators import items, rows
from coinfold.plans import ledger_view as view
from coinfold.plans.catalog import (
    BLOCK,
    TX,
    query,
    with_views,
)
from coinfold.plans.ingest import ingest_raw, landed, load_flat, load_items
from coinfold.plans.repair import repair
from coinfold.schemas import FLAT_TRANSACTIONS, TABLE_KEYS, TABLES, TXOUTS
from coinfold.session import KEPT_COMPRESSION, dropping_shuffles, shared_dir
from coinfold.sources import files
from coinfold.sources import items as item_source
from coinfold.sources.raw import (
    land_raw_blocks,
    parse_raw_blocks,
    raw_block_stream,
    read_raw_blocks,
)
from coinfold.sources.tables import (
    CHILDREN_FIRST,
    Batch,
    Ledger,
    one_per_key,
    read_table,
    write_keyed,
)
from coinfold.streaming.backfill import run as backfill_and_follow
from coinfold.streaming.follow import Follow, catch_up, run_follow

# ---- orders as a chain: one block with one paying transaction per order ------------------

CHAIN = """
chain AS (
  SELECT o_orderkey AS height, md5('b' || CAST(o_orderkey AS VARCHAR)) AS hash,
    CAST(floor(epoch(o_orderdate)) AS BIGINT) AS time,
    md5('t' || CAST(o_orderkey AS VARCHAR)) AS txid,
    md5('t' || CAST(o_orderkey - 1 AS VARCHAR)) AS prev_txid,
    CAST(CAST(o_totalprice AS DECIMAL(18,2)) * 100000000 AS BIGINT) AS units,
    CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS VARCHAR) AS value,
    'cust' || CAST(o_custkey AS VARCHAR) AS address, o_orderstatus
  FROM orders)"""


def chain_columns(orders):
    return orders.selectExpr(
        "o_orderkey AS height",
        "md5(concat('b', o_orderkey)) AS hash",
        "unix_timestamp(CAST(o_orderdate AS TIMESTAMP)) AS time",
        "md5(concat('t', o_orderkey)) AS txid",
        "md5(concat('t', o_orderkey - 1)) AS prev_txid",
        "CAST(o_totalprice AS DECIMAL(18,2)) AS value",
        "concat('cust', o_custkey) AS address",
        "o_orderstatus",
    )


def chain_text(orders):
    """JSON text of the blocks. Values are numbers with all their digits."""
    return chain_columns(orders).selectExpr(
        "height",
        """to_json(named_struct('hash', hash, 'height', height, 'time', time, 'tx',
          array(named_struct('txid', txid, 'vin', array(named_struct('txid', prev_txid,
            'vout', 0, 'sequence', height)), 'vout', array(named_struct('n', 0, 'value', value,
            'asset', concat('a', o_orderstatus), 'scriptPubKey',
            named_struct('hex', '0014', 'address', address))))))) AS value""",
    )


def _orders(spark, sf):
    """One small row becomes a wide block: the rows are dealt out before they do."""
    return view.spread(view.table(spark, sf, "orders"))


def _landed(spark, sf, least):
    """The chain as landed files of raw blocks: so many of a small table, in proportion more of a large one."""
    path = shared_dir(spark, "landing")
    orders = _orders(spark, sf)
    chain_text(orders.repartitionByRange(_landed_files(spark, sf, least), "o_orderkey")).select("value").write.text(path)
    return path


#: Landed blocks in one file at most, about.
_FILE_BLOCKS = 250_000


def _landed_files(spark, sf, least):
    return max(least, -(-view.table(spark, sf, "orders").count() // _FILE_BLOCKS))


def _ledger(spark, **options):
    return Ledger(spark, shared_dir(spark, "ledger"), **options)


# ---- scans and item files ----------------------------------------------------------------


@query("S1", with_views(CHAIN) + "SELECT hash, height, time, txid, value, address FROM chain")
def landed_raw_blocks(spark, sf):
    """Values come back with every digit of the number in the file."""
    raw = read_raw_blocks(spark, _landed(spark, sf, 4))
    tx = F.col("tx")[0]
    return raw.select(
        "hash", "height", "time", tx["txid"].alias("txid"),
        tx["vout"][0]["value"].alias("value"),
        tx["vout"][0]["scriptPubKey"]["address"].alias("address"),
    )


@query("S1", with_views(CHAIN) + "SELECT hash, height, time, txid, value, address FROM chain")
def raw_blocks_in_spaced_text(spark, sf):
    """From a text column with blanks around its colons; values keep every digit all the same."""
    text = chain_text(_orders(spark, sf)).select(
        F.regexp_replace("value", '":', '" \t:  ').alias("value")
    )
    tx = F.col("tx")[0]
    return parse_raw_blocks(text).select(
        "hash", "height", "time", tx["txid"].alias("txid"),
        tx["vout"][0]["value"].alias("value"),
        tx["vout"][0]["scriptPubKey"]["address"].alias("address"),
    )


@query(
    "S1 S2 P6",
    with_views(CHAIN)
    + "SELECT txid, units AS value_sat FROM chain WHERE height BETWEEN 100 AND 1200",
)
def landed_parquet_range(spark, sf):
    """Raw blocks kept as parquet: a height range opens its buckets, a table its fields."""
    path = shared_dir(spark, "parquet")
    raw = parse_raw_blocks(chain_text(_orders(spark, sf)))
    land_raw_blocks(raw, path, bucket_size=500)
    kept = spark.read.parquet(path).where(
        F.col("height").between(100, 1200) & F.col("height_bucket").between(0, 2)
    )
    return rows.output_rows(kept, "main").select("txid", "value_sat")


@query(
    "S4 S6",
    with_views(CHAIN)
    + """SELECT hash, height AS number, time AS "timestamp", txid AS txids FROM chain""",
)
def block_items_in_files(spark, sf):
    path = shared_dir(spark, "items")
    item_source.write_items(
        items.block_items(parse_raw_blocks(chain_text(_orders(spark, sf)))), path
    )
    return item_source.read_block_items(spark, path).select(
        "hash", "number", "timestamp", F.array_join("txids", ",").alias("txids")
    )


@query(
    "S7",
    with_views(CHAIN)
    + "SELECT txid, output_value, count(*) AS copies FROM (SELECT txid, value AS output_value"
    " FROM chain UNION ALL SELECT txid, value FROM chain) GROUP BY ALL",
)
def items_appended_twice(spark, sf):
    path = shared_dir(spark, "items")
    made = items.transaction_items(parse_raw_blocks(chain_text(_orders(spark, sf))))
    item_source.write_items(made, path, append=True)
    item_source.write_items(made, path, append=True)
    read = item_source.read_transaction_items(spark, path)
    return read.groupBy("txid", F.format_string("%s", "output_value").alias("output_value")).agg(
        F.count("*").alias("copies")
    )


@query(
    "S3 S8",
    with_views(CHAIN)
    + """SELECT 'side' AS chain, 'blocks' AS "range",
      200 + (height - 200) // 300 * 300 AS block_start,
      least(1900, 200 + ((height - 200) // 300 + 1) * 300 - 1) AS block_end,
      count(*) AS blocks, CAST(sum(units) AS BIGINT) AS units
    FROM chain WHERE height BETWEEN 200 AND 1900 GROUP BY ALL""",
)
def exported_range(spark, sf):
    path = shared_dir(spark, "export")
    raw = parse_raw_blocks(chain_text(_orders(spark, sf)))
    item_source.export_partitions(raw, path, "side", start=200, end=1900, batch_size=300)
    keys = ["chain", "range", "block_start", "block_end"]
    schema = T.StructType([T.StructField("number", T.LongType()),
                           T.StructField("output_value", T.StringType())])
    blocks = spark.read.schema(schema).json(f"{path}/blocks")
    transactions = spark.read.schema(schema).json(f"{path}/transactions")
    cast = [F.col(k).cast("bigint" if k.startswith("block_") else "string").alias(k)
            for k in keys]
    counted = blocks.groupBy(*keys).agg(F.count("number").alias("blocks"))
    units = (F.col("output_value").cast("decimal(18,2)") * 100_000_000).cast("bigint")
    summed = transactions.groupBy(*keys).agg(F.sum(units).alias("units"))
    return counted.join(summed, keys).select(*cast, "blocks", "units")


@query(
    "S8 D2 J1",
    with_views(CHAIN).rstrip()
    + """, bound AS (SELECT min(CASE WHEN time >= 883612800 THEN height END) AS low,
        max(CASE WHEN time < 883699200 THEN height END) AS high FROM chain),
      part AS (SELECT c.* FROM chain c, bound WHERE height BETWEEN low AND high)
    SELECT 'side' AS chain, DATE '1998-01-01' AS "date", p.txid, prev.value AS prev_value,
      CASE WHEN prev.txid IS NULL THEN 'no such transaction' END AS enrichment_error
    FROM part p LEFT JOIN chain prev ON prev.txid = p.prev_txid""",
)
def exported_day_enriched(spark, sf):
    """The blocks of one day, with an enriched copy of their transactions."""
    path, kept = shared_dir(spark, "export"), shared_dir(spark, "parquet")
    parsed = parse_raw_blocks(chain_text(_orders(spark, sf)))
    # Parsed once: the bounds of the day, its blocks and what they may spend are read from one copy.
    with dropping_shuffles(spark):
        parsed.write.parquet(kept, compression=KEPT_COMPRESSION)
    raw = spark.read.schema(parsed.schema).parquet(kept)
    item_source.export_partitions(
        raw, path, "side", day="1998-01-01", batch_size=1000, land=False,
        enrich_from=items.transaction_items(raw), compression=item_source.COMPRESSION,
    )
    enriched = item_source.read_transaction_items(spark, f"{path}/enriched_transactions")
    return enriched.select(
        F.lit("side").alias("chain"), F.lit("1998-01-01").cast("date").alias("date"), "txid",
        F.col("inputs")[0]["value"].alias("prev_value"),
        F.col("inputs")[0]["enrichment_error"].alias("enrichment_error"),
    )


# ---- keyed tables ------------------------------------------------------------------------

_OUT_ROWS = """
out_row AS (SELECT md5('t' || CAST(l_orderkey AS VARCHAR)) AS txid, l_linenumber - 1 AS vout,
  'addr' || CAST(l_suppkey AS VARCHAR) AS address, 'first' AS script_type,
  CAST(floor(epoch(l_shipdate)) AS BIGINT) AS seen_at, l_linestatus FROM lineitem)"""


def _output_rows(spark, sf, state):
    lines = view.table(spark, sf, "lineitem").where(F.col("l_linestatus") == state)
    return lines.selectExpr(
        "md5(concat('t', l_orderkey)) AS txid",
        "CAST(l_linenumber - 1 AS INT) AS vout",
        "concat('addr', l_suppkey) AS address",
        "'witness' AS script_type",
        "l_orderkey AS block_height",
        "unix_timestamp(CAST(l_shipdate AS TIMESTAMP)) AS seen_at",
    )


def _keyed(spark, sf, strategy):
    """Two batches of outputs with repeated keys within and between them."""
    path = shared_dir(spark, "txouts")
    for state in ("F", "O"):
        batch = _output_rows(spark, sf, state)
        write_keyed(
            spark, path, TXOUTS, batch, ("txid", "vout"), "block_height",
            order=["seen_at"], strategy=strategy, bucket_size=2_000,
        )
    return read_table(spark, path, TXOUTS).select(
        "txid", F.col("vout").cast("bigint").alias("vout"), "address", "script_type"
    )


_UPSERT = with_views(_OUT_ROWS).rstrip() + """, ranked AS (SELECT *, row_number() OVER (
    PARTITION BY txid, vout ORDER BY {order}) AS nth FROM out_row)
  SELECT txid, CAST(vout AS BIGINT) AS vout, address, 'witness' AS script_type FROM ranked
  WHERE nth = 1"""


@query(
    "S9 L2", _UPSERT.format(order="l_linestatus DESC, seen_at DESC, address DESC")
)
def outputs_updated_by_key(spark, sf):
    """The later batch wins, and within a batch the later row."""
    return _keyed(spark, sf, "update")


@query("S10", _UPSERT.format(order="l_linestatus, seen_at, address"))
def outputs_ignored_by_key(spark, sf):
    """The earlier batch wins, and within a batch the earlier row."""
    return _keyed(spark, sf, "ignore")


@query(
    "S9",
    """SELECT l_orderkey AS k, CAST(max(l_partkey) AS BIGINT) AS largest FROM lineitem
    GROUP BY l_orderkey""",
)
def last_row_per_key(spark, sf):
    lines = view.table(spark, sf, "lineitem").selectExpr("l_orderkey AS k", "l_partkey AS largest")
    return one_per_key(lines, ("k",), ["largest"])


@query(
    "S11 P10",
    with_views(CHAIN)
    + """SELECT txid AS hash, CAST(0 AS BIGINT) AS "index", height AS block_number,
      0 AS is_coinbase, value AS output_value, CAST(1 AS BIGINT) AS ins FROM chain""",
)
def flat_tables(spark, sf):
    base = shared_dir(spark, "flat")
    raw = parse_raw_blocks(chain_text(_orders(spark, sf)))
    made = items.transaction_items(raw)
    load_flat(spark, base, items.block_items(raw), made)
    load_flat(spark, base, transactions=made)
    return read_table(spark, f"{base}/transactions", FLAT_TRANSACTIONS).select(
        "hash", "index", "block_number", "is_coinbase", "output_value",
        F.json_array_length("inputs").cast("bigint").alias("ins"),
    )


_TABLES = """SELECT 'blocks' AS table_name, hash AS key, height, CAST(NULL AS BIGINT) AS units
    FROM chain {where}
    UNION ALL SELECT 'transactions', txid, height, NULL FROM chain {where}
    UNION ALL SELECT 'txins', txid, height, NULL FROM chain {where}
    UNION ALL SELECT 'txouts', txid, NULL, units FROM chain {where}"""


def _content(ledger):
    """All four tables in one shape."""
    none = F.lit(None).cast("bigint")
    shapes = {
        "blocks": ("hash", F.col("height"), none),
        "transactions": ("txid", F.col("block_height"), none),
        "txins": ("txid", F.col("sequence"), none),
        "txouts": ("txid", none, F.col("value_sat")),
    }
    parts = [
        ledger.table(name).select(
            F.lit(name).alias("table_name"), F.col(key).alias("key"), height.alias("height"),
            units.alias("units"),
        )
        for name, (key, height, units) in shapes.items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


@query("S12 S2 P11", with_views(CHAIN) + _TABLES.format(where="WHERE height BETWEEN 0 AND 900"))
def ingested_tables(spark, sf):
    """Raw blocks of a range into the tables; the committed batch is part of the result."""
    ledger = _ledger(spark)
    raw = parse_raw_blocks(chain_text(_orders(spark, sf)))
    ingest_raw(raw, ledger, "main", start=-5, end=900, batch_id="first")
    return _content(ledger).where(
        F.lit(ledger.committed().where(F.col("batch_id") == "first").count() == 1)
    )


@query("S12 S9 T4", with_views(CHAIN) + _TABLES.format(where="WHERE o_orderstatus <> 'P'"))
def restarted_after_break(spark, sf):
    """Two batches over the same buckets; the second breaks off after each of its steps and is run again.
    What is read between is the first batch, whole; a third one is never committed."""
    ledger = Ledger(spark, shared_dir(spark, "ledger"), bucket_size=5_000)
    orders = _orders(spark, sf)
    part = lambda test: rows.bulk_rows(landed(parse_raw_blocks(chain_text(orders.where(test))), ledger), "main")
    ledger.write(part("o_orderstatus = 'F'"), batch_id="first")
    counts = lambda: {name: t.count() for name, t in ledger.tables().items()}
    before, second = counts(), part("o_orderstatus = 'O'")
    for steps in range(1, 4):
        broken = Batch(ledger.versions, "second")
        for name in CHILDREN_FIRST[:steps]:
            write_keyed(
                spark, ledger.path(name), TABLES[name], second[name], TABLE_KEYS[name],
                "height" if name == "blocks" else "block_height", batch=broken,
            )
        if counts() != before:
            raise AssertionError("a batch that was not committed is read")
    ledger.write(second, batch_id="second")
    never = Batch(ledger.versions, "third")
    never.merge("blocks", TABLES["blocks"], ledger.table("blocks").limit(0), ("hash",), "update")
    ledger.clean(keep=1)
    known = {r.batch_id for r in ledger.committed().collect()}
    return _content(ledger).where(F.lit(known == {"first", "second"}))


@query("S13 P7 P8", with_views(CHAIN) + _TABLES.format(where=""))
def loaded_item_files(spark, sf):
    raw = parse_raw_blocks(chain_text(_orders(spark, sf)))
    blocks, transactions = shared_dir(spark, "blocks"), shared_dir(spark, "transactions")
    item_source.write_items(items.block_items(raw), blocks)
    item_source.write_items(items.transaction_items(raw), transactions)
    ledger = _ledger(spark)
    load_items(spark, ledger, blocks, transactions)
    return _content(ledger)


@query(
    "S13 S9",
    with_views(CHAIN)
    + "SELECT hash, CASE height % 3 WHEN 0 THEN height WHEN 1 THEN height + 5 ELSE 7 END AS size FROM chain",
)
def loaded_item_files_in_order(spark, sf):
    """Keys repeated within a file and in a later one: the last wins, though it is smaller."""
    path = shared_dir(spark, "blocks")
    made = items.block_items(parse_raw_blocks(chain_text(_orders(spark, sf))))
    number, kind = F.col("number"), F.col("number") % 3
    first = F.when(kind == 2, F.array(number + 900, F.lit(7))).otherwise(F.array(number + 5))
    repeated = made.withColumn("size", F.explode(first))
    item_source.write_items(repeated, f"{path}/1")
    item_source.write_items(made.where(kind == 0).withColumn("size", number), f"{path}/2")
    ledger = _ledger(spark)
    load_items(spark, ledger, f"{path}/*")
    return ledger.table("blocks").select("hash", F.col("size").cast("bigint").alias("size"))


# ---- repair ------------------------------------------------------------------------------


@query(
    "R1 A11 W1 J4 J5 W2 A16",
    with_views(CHAIN) + _TABLES.format(where=""),
)
def repaired_tables(spark, sf):
    """Tables that lack the orders of one status and hold a second, empty block for those of
    another: repair removes the second blocks and takes the missing heights in again."""
    ledger = _ledger(spark)
    orders = _orders(spark, sf)
    raw = parse_raw_blocks(chain_text(orders))
    part = parse_raw_blocks(chain_text(orders.where(F.col("o_orderstatus") != "P")))
    ingest_raw(part, ledger, "main")
    rivals = chain_columns(orders.where(F.col("o_orderstatus") == "F")).selectExpr(
        "md5(concat('rival', height)) AS hash", "height", "time + 60 AS time"
    )
    ledger.write({"blocks": rivals})
    bounds = orders.agg(F.min("o_orderkey"), F.max("o_orderkey")).first()
    repair(ledger, raw, start=bounds[1], end=bounds[0])
    return _content(ledger)


@query(
    "R1 W7",
    with_views(CHAIN).rstrip()
    + """, present AS (SELECT height FROM chain WHERE o_orderstatus <> 'P'),
      nxt AS (SELECT height, lead(height) OVER (ORDER BY height) AS n FROM present)
    SELECT height + 1 AS start_missing, n - 1 AS end_missing FROM nxt WHERE n > height + 1
    ORDER BY 1 LIMIT 50""",
)
def repair_dry_run(spark, sf):
    ledger = _ledger(spark)
    part = parse_raw_blocks(chain_text(_orders(spark, sf).where("o_orderstatus <> 'P'")))
    ledger.write({"blocks": rows.block_rows(part, "main")})
    return repair(ledger, dry_run=True).preview


# ---- streams -----------------------------------------------------------------------------


def _chain_stream(spark, sf):
    orders = view.table(spark, sf, "orders")
    stream = spark.readStream.schema(orders.schema).option("pathGlobFilter", "orders.parquet")
    return parse_raw_blocks(chain_text(stream.parquet(sf).repartition(view.parts_of(orders))))


@query("T1 T3 T4 S12", with_views(CHAIN) + _TABLES.format(where=""))
def followed_tables(spark, sf):
    """A stream into the tables, resumed once with nothing new."""
    ledger = _ledger(spark)
    follow = Follow(state=shared_dir(spark, "state"), ledger=ledger)
    for _ in range(2):
        run_follow(_chain_stream(spark, sf), follow).awaitTermination()
    return _content(ledger)


@query(
    "T1 T2 T5",
    with_views(CHAIN)
    + _TABLES.format(where="WHERE height <= (SELECT max(height) FROM chain) - 25"),
)
def followed_with_lag(spark, sf):
    """Landed files in several micro-batches, two of a small table's files at a time; the last 25 heights wait, lines
    that are no block go to the dead letters."""
    landing = _landed(spark, sf, 2)
    broken = _orders(spark, sf).select(F.lit("no block").alias("value")).limit(3)
    broken.coalesce(1).write.mode("append").text(landing)
    ledger = _ledger(spark)

    follow = Follow(
        state=shared_dir(spark, "state"), ledger=ledger, lag=25, start=0,
        dead_letters=shared_dir(spark, "dead"),
    )
    run_follow(raw_block_stream(spark, landing, max_files=_landed_files(spark, sf, 2)), follow).awaitTermination()
    return _content(ledger)


@query(
    "T5",
    """SELECT CAST(NULL AS BIGINT) AS height, '["' || CAST(o_orderkey AS VARCHAR) || '"]'
      AS error FROM orders WHERE o_orderstatus = 'P'
    UNION ALL
    SELECT o_orderkey, 'block without hash or height' FROM orders WHERE o_orderstatus = 'F'""",
)
def dead_letters(spark, sf):
    """Lines that are no object and objects without hash, next to usable blocks."""
    landing, dead = shared_dir(spark, "landing"), shared_dir(spark, "dead")
    orders = _orders(spark, sf)
    lines = orders.selectExpr(
        """CASE o_orderstatus WHEN 'P' THEN concat('["', o_orderkey, '"]')
          WHEN 'F' THEN concat('{"height":', o_orderkey, '}')
          ELSE concat('{"hash":"h', o_orderkey, '","height":', o_orderkey, '}') END AS value"""
    )
    lines.write.text(landing)

    follow = Follow(
        state=shared_dir(spark, "state"), topics=shared_dir(spark, "topic"), start=0,
        dead_letters=dead,
    )
    run_follow(raw_block_stream(spark, landing), follow).awaitTermination()
    return spark.read.schema("height bigint, error string").json(f"{dead}/batch=*")


@query(
    "S15 T6 P9 J1",
    with_views(CHAIN)
    + """SELECT c.txid AS item_id, c.value AS output_value, prev.value AS prev_value,
      prev.address AS prev_address FROM chain c LEFT JOIN chain prev ON prev.txid = c.prev_txid""",
)
def topic_of_enriched_transactions(spark, sf):
    topics = shared_dir(spark, "topic")
    follow = Follow(state=shared_dir(spark, "state"), topics=topics, start=0, enrich=True)
    run_follow(_chain_stream(spark, sf), follow).awaitTermination()
    lines = spark.read.text(f"{topics}.transactions/batch=*")
    path = lambda p: F.get_json_object("value", p)
    return lines.select(
        path("$.item_id").alias("item_id"),
        path("$.output_value").alias("output_value"),
        path("$.inputs[0].value").alias("prev_value"),
        path("$.inputs[0].addresses[0]").alias("prev_address"),
    )


@query(
    "S15",
    with_views(CHAIN)
    + "SELECT hash AS item_id, height AS number, time AS \"timestamp\" FROM chain",
)
def topic_of_blocks(spark, sf):
    topics = shared_dir(spark, "topic")
    follow = Follow(state=shared_dir(spark, "state"), topics=topics, start=0)
    run_follow(_chain_stream(spark, sf), follow).awaitTermination()
    lines = spark.read.text(f"{topics}.blocks/batch=*")
    return lines.select(
        F.from_json("value", "item_id string, number bigint, timestamp bigint").alias("b")
    ).select("b.*")


@query("T7 T3", with_views(CHAIN) + _TABLES.format(where=""))
def backfilled_then_followed(spark, sf):
    """A backfill up to height 500, then the stream takes what lies behind it."""
    ledger = _ledger(spark)
    follow = Follow(state=shared_dir(spark, "state"), ledger=ledger)
    outcome = backfill_and_follow(_landed(spark, sf, 2), follow, start=0, end=500)
    outcome.query.awaitTermination()
    return _content(ledger)


@query("T1 T3 S12", with_views(CHAIN) + _TABLES.format(where=""))
def followed_out_of_order(spark, sf):
    """High heights land first, the stream is started anew, then the low ones land. What has landed is one
    micro-batch, however many files it is."""
    landing, ledger = shared_dir(spark, "landing"), _ledger(spark)
    follow = Follow(state=shared_dir(spark, "state"), ledger=ledger)
    text = chain_text(_orders(spark, sf))
    for part in ("height >= 1200", "height < 400", "height >= 400 AND height < 1200"):
        with dropping_shuffles(spark):
            text.where(part).select("value").write.mode("append").text(landing)
        landed_files = len(files.names(spark, landing))
        run_follow(raw_block_stream(spark, landing, max_files=landed_files), follow).awaitTermination()
    return _content(ledger)


@query(
    "T8 A10",
    with_views(TX, BLOCK)
    + """SELECT CAST(2990 AS BIGINT) AS head, max(height) + 1 AS current,
      2990 - (max(height) + 1) + 1 AS remaining FROM block""",
)
def catch_up_of_tables(spark, sf):
    return catch_up(view.order_blocks(spark, sf), head=3000, lag=10)
