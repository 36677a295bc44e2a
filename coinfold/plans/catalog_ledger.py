"""Catalog: joins, ranges, windows and aggregates over the flat ledger view."""

from __future__ import annotations

from pyspark.sql import functions as F

from coinfold.functions.amounts import to_base_units
from coinfold.operators import days, enrich, heights
from coinfold.plans import ledger_view as view
from coinfold.plans.catalog import (
    BLOCK,
    FORKED_BLOCK,
    FORKED_TX,
    INP,
    MINUTE,
    OUT,
    TX,
    query,
    with_views,
)
from coinfold.sources import raw as raw_source

# A window of minutes wider than the events, so that both edges are missing.
FIRST_MINUTE, LAST_MINUTE = 28_400_000, 28_500_000
SMALL_BUCKET = 1_000


@query(
    "A3 F1 P6",
    """SELECT 'a' || right(CAST(l_suppkey AS VARCHAR), 1) AS asset,
      CAST(o_orderdate AS DATE) AS day, count(*) AS outputs,
      CAST(sum(CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * 100000000 AS BIGINT)) AS BIGINT)
        AS units
    FROM lineitem JOIN orders ON l_orderkey = o_orderkey WHERE l_returnflag <> 'R'
    GROUP BY 1, 2""",
)
def explicit_output_by_day(spark, sf):
    """Visible output per asset and day: the flagship."""
    lines = view.table(spark, sf, "lineitem").where(F.col("l_returnflag") != "R")
    asset = F.concat(F.lit("a"), F.right(F.col("l_suppkey").cast("string"), F.lit(1)))
    units = to_base_units(F.col("l_extendedprice").cast("decimal(18,2)").cast("string"))
    outputs = lines.select("l_orderkey", asset.alias("asset"), units.alias("units"))
    orders = view.table(spark, sf, "orders").select(
        "o_orderkey", F.col("o_orderdate").cast("date").alias("day")
    )
    return (
        outputs.join(orders, F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy("asset", "day")
        .agg(F.count("*").alias("outputs"), F.sum("units").alias("units"))
    )


# ---- spent outputs -----------------------------------------------------------------------


def _outputs(spark, sf):
    return view.order_outputs(spark, sf).withColumns(
        {"addresses": F.array("address"), "type": F.col("script_type")}
    )


def _counts(spark, sf):
    made = view.order_outputs(spark, sf).groupBy(F.col("txid").alias("_of")).agg(
        F.count("*").alias("_n")
    )
    return (
        view.order_transactions(spark, sf)
        .select("txid")
        .join(made, F.col("txid") == F.col("_of"), "left")
        .select("txid", F.coalesce("_n", F.lit(0)).alias("vout_count"))
    )


_LOOKED_UP = """
cnt AS (SELECT tx.txid, count(outp.txid) AS n FROM tx LEFT JOIN outp USING (txid)
  GROUP BY tx.txid),
found AS (
  SELECT inp.txid, CAST(inp.vin AS BIGINT) AS vin, inp.prev_txid,
    CAST(inp.prev_vout AS BIGINT) AS prev_vout, outp.address AS addresses, outp.value, outp.asset,
    outp.script_type AS type,
    CASE WHEN outp.txid IS NOT NULL THEN NULL WHEN cnt.txid IS NULL THEN 'no such transaction'
      ELSE 'prevout index ' || CAST(inp.prev_vout AS VARCHAR) || ' out of range ('
        || CAST(cnt.n AS VARCHAR) || ' vouts)' END AS enrichment_error
  FROM inp LEFT JOIN outp ON outp.txid = inp.prev_txid AND outp.vout = inp.prev_vout
    LEFT JOIN cnt ON cnt.txid = inp.prev_txid)"""


@query("J1 J2", with_views(TX, OUT, INP, _LOOKED_UP) + "SELECT * FROM found")
def enriched_inputs(spark, sf):
    done = enrich.enrich_inputs(
        view.order_inputs(spark, sf), _outputs(spark, sf), _counts(spark, sf)
    )
    return done.select(
        "txid", F.col("vin").cast("bigint").alias("vin"), "prev_txid",
        F.col("prev_vout").cast("bigint").alias("prev_vout"),
        F.array_join("addresses", ",").alias("addresses"), "value", "asset", "type",
        "enrichment_error",
    )


@query(
    "A14",
    with_views(TX, OUT, INP, _LOOKED_UP)
    + "SELECT count(*) AS attempted, count_if(enrichment_error IS NULL) AS enriched,"
    " count_if(enrichment_error IS NOT NULL) AS failed FROM found",
)
def enrichment_totals(spark, sf):
    return enrich.enrichment_stats(
        enrich.enrich_inputs(
            view.order_inputs(spark, sf), _outputs(spark, sf), _counts(spark, sf)
        )
    )


def _line_items(spark, sf):
    """Every line as a transaction item with two inputs: one for an output of its own order,
    one for a transaction nobody knows; minting lines name no output."""
    from coinfold.schemas import TX_ITEM

    lines = view.with_line_columns(view.table(spark, sf, "lineitem"))
    own = F.struct(
        F.md5(F.concat(F.lit("t"), F.col("l_orderkey").cast("string"))).alias("txid"),
        (F.col("l_linenumber") - 1 + F.when(F.col("l_quantity") == 50, 100).otherwise(0))
        .cast("bigint")
        .alias("vout"),
    )
    strange = F.struct(
        F.concat(F.lit("x"), F.col("l_suppkey").cast("string")).alias("txid"),
        F.lit(0).cast("bigint").alias("vout"),
    )
    minting = F.struct(
        F.lit(None).cast("string").alias("txid"), F.lit(None).cast("bigint").alias("vout")
    )
    points = F.when(F.col("l_returnflag") == "R", F.array(minting)).otherwise(
        F.array(own, strange)
    )
    kind = TX_ITEM["inputs"].dataType
    inputs = F.transform(
        points,
        lambda p: F.struct(
            *[
                (p[f.name] if f.name in ("txid", "vout") else F.lit(None))
                .cast(f.dataType)
                .alias(f.name)
                for f in kind.elementType.fields
            ]
        ),
    )
    return lines.select(F.col("id").alias("txid"), inputs.alias("inputs"))


_ITEM_INPUTS = """
own AS (
  SELECT id AS tx, CAST(0 AS BIGINT) AS position,
    md5('t' || CAST(l_orderkey AS VARCHAR)) AS txid,
    CAST(l_linenumber - 1 + CASE WHEN l_quantity = 50 THEN 100 ELSE 0 END AS BIGINT) AS vout
  FROM line WHERE l_returnflag <> 'R'),
item_input AS (
  SELECT own.tx, own.position, own.txid, own.vout, outp.value, outp.asset,
    outp.address AS addresses,
    CASE WHEN outp.txid IS NULL THEN 'prevout index ' || CAST(own.vout AS VARCHAR)
      || ' out of range (' || CAST(cnt.n AS VARCHAR) || ' vouts)' END AS enrichment_error
  FROM own LEFT JOIN outp ON outp.txid = own.txid AND outp.vout = own.vout
    LEFT JOIN cnt ON cnt.txid = own.txid
  UNION ALL
  SELECT id, 1, 'x' || CAST(l_suppkey AS VARCHAR), 0, NULL, NULL, NULL, 'no such transaction'
  FROM line WHERE l_returnflag <> 'R'
  UNION ALL
  SELECT id, 0, NULL, NULL, NULL, NULL, NULL, NULL FROM line WHERE l_returnflag = 'R')"""


def _enriched_items(spark, sf):
    return enrich.enrich_transactions(
        _line_items(spark, sf), _outputs(spark, sf), _counts(spark, sf)
    )


def _line_views():
    from coinfold.plans.catalog import LINE

    return with_views(LINE, TX, OUT, INP, _LOOKED_UP, _ITEM_INPUTS)


@query("J1 J2", _line_views() + "SELECT * FROM item_input")
def enriched_items(spark, sf):
    i = F.col("i")
    return (
        _enriched_items(spark, sf)
        .select(F.col("txid").alias("tx"), F.posexplode_outer("inputs").alias("p", "i"))
        .select(
            "tx", F.col("p").cast("bigint").alias("position"), i["txid"].alias("txid"),
            i["vout"].alias("vout"), i["value"].alias("value"), i["asset"].alias("asset"),
            F.array_join(i["addresses"], ",").alias("addresses"),
            i["enrichment_error"].alias("enrichment_error"),
        )
    )


@query(
    "A14",
    _line_views()
    + """SELECT count_if(txid IS NOT NULL) AS attempted,
      count_if(txid IS NOT NULL AND enrichment_error IS NULL) AS enriched,
      count_if(enrichment_error IS NOT NULL) AS failed FROM item_input""",
)
def enriched_item_totals(spark, sf):
    return enrich.item_stats(_enriched_items(spark, sf)).agg(
        *[F.sum(c).alias(c) for c in ("attempted", "enriched", "failed")]
    )


@query(
    "J6",
    with_views(TX, OUT, INP).rstrip()
    + """, spender AS (
      SELECT prev_txid, prev_vout, min(struct_pack(h := tx.block_height, t := inp.txid,
        v := inp.vin)) AS s
      FROM inp JOIN tx USING (txid) GROUP BY prev_txid, prev_vout)
    SELECT txid, CAST(vout AS BIGINT) AS vout, value,
      CASE WHEN s IS NOT NULL THEN true END AS spent, s.t AS spent_by_txid,
      CAST(s.v AS BIGINT) AS spent_by_vin, s.h AS spent_at_height
    FROM outp LEFT JOIN spender ON prev_txid = txid AND prev_vout = vout""",
)
def spent_outputs(spark, sf):
    spenders = view.order_inputs(spark, sf).join(
        view.order_transactions(spark, sf).select("txid", "block_height"), "txid"
    )
    return enrich.link_spenders(
        view.order_outputs(spark, sf).select("txid", "vout", "value"), spenders
    ).withColumn("vout", F.col("vout").cast("bigint"))


# ---- heights -----------------------------------------------------------------------------


def minute_blocks(spark, sf):
    """Events as blocks at the height of their minute: many gaps, many competing blocks."""
    at = F.unix_timestamp(F.col("ts").cast("timestamp"))
    return view.table(spark, sf, "events").select(
        F.md5(F.col("event_id").cast("string")).alias("hash"),
        F.floor(at / 60).alias("height"),
        at.alias("time"),
        "value",
        "user_id",
    )


_GAPS = """
present AS (SELECT DISTINCT height FROM minute),
following AS (SELECT height, lead(height) OVER (ORDER BY height) AS next_height FROM present),
gap AS (SELECT height + 1 AS start_missing, next_height - 1 AS end_missing FROM following
  WHERE next_height > height + 1)"""
_EDGES = f"""
edge AS (
  SELECT * FROM gap
  UNION ALL SELECT {FIRST_MINUTE}, min(height) - 1 FROM present
    HAVING min(height) > {FIRST_MINUTE}
  UNION ALL SELECT max(height) + 1, {LAST_MINUTE} FROM present
    HAVING max(height) < {LAST_MINUTE})"""


@query(
    "A9 A10",
    with_views(MINUTE)
    + "SELECT min(height) AS min_height, max(height) AS max_height FROM minute",
)
def height_bounds(spark, sf):
    return heights.height_bounds(minute_blocks(spark, sf))


@query("W2 L3", with_views(MINUTE, _GAPS) + "SELECT start_missing, end_missing FROM gap")
def interior_gaps(spark, sf):
    return heights.missing_ranges(minute_blocks(spark, sf), bucket=SMALL_BUCKET)


@query(
    "W3 L4", with_views(MINUTE, _GAPS, _EDGES) + "SELECT start_missing, end_missing FROM edge"
)
def gaps_with_edges(spark, sf):
    return heights.missing_ranges(
        minute_blocks(spark, sf), FIRST_MINUTE, LAST_MINUTE, SMALL_BUCKET
    )


@query(
    "W4",
    with_views(MINUTE).rstrip()
    + """, span AS (SELECT height AS s, height + CAST(floor(value / 30) AS BIGINT) AS e
        FROM minute),
      marked AS (SELECT s, e, CASE WHEN s <= max(e) OVER (ORDER BY s, e
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) + 1 THEN 0 ELSE 1 END AS opens
        FROM span),
      numbered AS (SELECT s, e, sum(opens) OVER (ORDER BY s, e ROWS BETWEEN UNBOUNDED PRECEDING
        AND CURRENT ROW) AS island FROM marked)
    SELECT min(s) AS start_missing, max(e) AS end_missing FROM numbered GROUP BY island""",
)
def merged_ranges(spark, sf):
    spans = minute_blocks(spark, sf).select(
        F.col("height").alias("start_missing"),
        (F.col("height") + F.floor(F.col("value") / 30)).alias("end_missing"),
    )
    return heights.merge_ranges(spans, bucket=7)


@query(
    "W6 W3 W4 L1", with_views(MINUTE, _GAPS, _EDGES)
    + "SELECT start_missing, end_missing FROM edge ORDER BY start_missing",
)
def ranges_to_repair(spark, sf):
    """Bounds given in reverse order are swapped."""
    return heights.repair_ranges(
        minute_blocks(spark, sf), LAST_MINUTE, FIRST_MINUTE
    ).orderBy("start_missing")


@query(
    "W6 J5",
    with_views(MINUTE)
    + f"SELECT hash, height, time FROM minute WHERE height BETWEEN {FIRST_MINUTE} AND"
    f" {LAST_MINUTE}",
)
def blocks_of_full_range(spark, sf):
    """Everything in the range is taken in again, present or not."""
    blocks = minute_blocks(spark, sf)
    whole = heights.repair_ranges(blocks, FIRST_MINUTE, LAST_MINUTE, backfill_present=True)
    return heights.blocks_in_ranges(blocks, whole).select("hash", "height", "time")


@query(
    "A16",
    with_views(MINUTE, _GAPS, _EDGES)
    + "SELECT CAST(sum(end_missing - start_missing + 1) AS BIGINT) AS missing_blocks,"
    " count(*) AS ranges FROM edge",
)
def missing_totals(spark, sf):
    return heights.range_totals(
        heights.repair_ranges(minute_blocks(spark, sf), FIRST_MINUTE, LAST_MINUTE)
    )


@query(
    "W7 L1",
    with_views(MINUTE, _GAPS, _EDGES)
    + "SELECT start_missing, end_missing FROM edge ORDER BY start_missing LIMIT 50",
)
def gap_report(spark, sf):
    return heights.range_report(
        heights.repair_ranges(minute_blocks(spark, sf), FIRST_MINUTE, LAST_MINUTE)
    )


@query(
    "J5",
    with_views(MINUTE).rstrip()
    + """, lacking AS (SELECT DISTINCT m.height FROM minute m WHERE NOT EXISTS (
        SELECT 1 FROM minute w WHERE w.user_id < 100 AND w.height = m.height))
    SELECT hash, height, time FROM minute SEMI JOIN lacking USING (height)
    WHERE height BETWEEN (SELECT min(height) FROM minute WHERE user_id < 100)
      AND (SELECT max(height) FROM minute WHERE user_id < 100)""",
)
def blocks_of_missing_heights(spark, sf):
    """A table that lacks the blocks of some users; their heights are found and taken from
    the full set."""
    everything = minute_blocks(spark, sf)
    table = everything.where(F.col("user_id") < 100)
    gaps = heights.missing_ranges(table, bucket=SMALL_BUCKET)
    return heights.blocks_in_ranges(everything, gaps).select("hash", "height", "time")


@query(
    "A11 L1",
    with_views(MINUTE)
    + "SELECT height, count(*) AS blocks FROM minute GROUP BY height HAVING count(*) > 1"
    " ORDER BY height",
)
def duplicate_heights(spark, sf):
    return heights.duplicate_heights(minute_blocks(spark, sf)).orderBy("height")


@query(
    "J3",
    with_views(FORKED_TX, FORKED_BLOCK)
    + """SELECT fblock.hash, height, time, count(ftx.txid) AS transactions FROM fblock
      LEFT JOIN ftx ON ftx.block_hash = fblock.hash GROUP BY fblock.hash, height, time""",
)
def block_transaction_counts(spark, sf):
    return heights.block_standing(
        view.order_blocks(spark, sf, forked=True), view.order_transactions(spark, sf, forked=True)
    )


_KEPT = """
ranked AS (
  SELECT hash, height, count(*) OVER (PARTITION BY height) AS n, row_number() OVER (
    PARTITION BY height ORDER BY transactions DESC, time DESC NULLS LAST, hash DESC) AS nth
  FROM (SELECT fblock.hash, height, time, count(ftx.txid) AS transactions FROM fblock
    LEFT JOIN ftx ON ftx.block_hash = fblock.hash GROUP BY fblock.hash, height, time)),
loser AS (SELECT hash, height FROM ranked WHERE nth > 1)"""
_FORKS = with_views(FORKED_TX, FORKED_BLOCK, _KEPT)


def _forked(spark, sf):
    return (
        view.order_blocks(spark, sf, forked=True),
        view.order_transactions(spark, sf, forked=True),
    )


@query(
    "W1 L2",
    _FORKS
    + "SELECT height, hash AS keep_hash, n - 1 AS removed_blocks FROM ranked"
    " WHERE nth = 1 AND n > 1",
)
def kept_blocks(spark, sf):
    return heights.kept_blocks(*_forked(spark, sf))


@query("W1 L5", _FORKS + "SELECT hash, height FROM loser")
def losing_blocks(spark, sf):
    return heights.losing_blocks(*_forked(spark, sf))


@query(
    "J4",
    with_views(FORKED_TX, FORKED_BLOCK, _KEPT, OUT, INP).rstrip()
    + """, gone AS (SELECT txid FROM ftx SEMI JOIN loser ON loser.hash = ftx.block_hash)
    SELECT 'blocks' AS table_name, hash AS key, CAST(0 AS BIGINT) AS position FROM fblock
      ANTI JOIN loser USING (hash)
    UNION ALL SELECT 'transactions', txid, 0 FROM ftx ANTI JOIN gone USING (txid)
    UNION ALL SELECT 'txins', txid, vin FROM inp ANTI JOIN gone USING (txid)
    UNION ALL SELECT 'txouts', txid, vout FROM outp ANTI JOIN gone USING (txid)""",
)
def tables_without_losers(spark, sf):
    blocks, transactions = _forked(spark, sf)
    tables = {
        "blocks": blocks,
        "transactions": transactions,
        "txins": view.order_inputs(spark, sf),
        "txouts": view.order_outputs(spark, sf),
    }
    left = heights.drop_blocks(tables, heights.losing_blocks(blocks, transactions))
    keys = {"blocks": ("hash", F.lit(0)), "transactions": ("txid", F.lit(0)),
            "txins": ("txid", F.col("vin")), "txouts": ("txid", F.col("vout"))}
    parts = [
        left[name].select(
            F.lit(name).alias("table_name"), F.col(key).alias("key"),
            position.cast("bigint").alias("position"),
        )
        for name, (key, position) in keys.items()
    ]
    return parts[0].unionByName(parts[1]).unionByName(parts[2]).unionByName(parts[3])


# ---- ranges ------------------------------------------------------------------------------

START, END, BATCH = 100, 2_000, 250


@query("S2 Q11", with_views(TX, BLOCK) + f"SELECT * FROM block WHERE height BETWEEN {START} AND {END}")
def blocks_of_range(spark, sf):
    return raw_source.height_range(view.order_blocks(spark, sf), START, END)


@query(
    "S3",
    with_views(TX, BLOCK)
    + f"""SELECT {START} + (height - {START}) // {BATCH} * {BATCH} AS block_start,
      least({END}, {START} + ((height - {START}) // {BATCH} + 1) * {BATCH} - 1) AS block_end,
      count(*) AS blocks
    FROM block WHERE height BETWEEN {START} AND {END} GROUP BY 1, 2""",
)
def blocks_per_batch(spark, sf):
    return (
        heights.with_batches(view.order_blocks(spark, sf), START, END, BATCH)
        .groupBy("block_start", F.col("block_end").cast("bigint").alias("block_end"))
        .agg(F.count("*").alias("blocks"))
    )


@query(
    "S14",
    with_views(MINUTE)
    + "SELECT hash, height, time FROM minute"
    " WHERE height > (SELECT max(height) FROM minute) - 500",
)
def last_blocks(spark, sf):
    return raw_source.tail(minute_blocks(spark, sf), 500).select("hash", "height", "time")


@query(
    "D1 D2",
    with_views(MINUTE)
    + """SELECT CAST(to_timestamp(time) AT TIME ZONE 'UTC' AS DATE) AS day,
      min(height) AS first_height, max(height) AS last_height FROM minute GROUP BY 1""",
)
def block_ranges_by_day(spark, sf):
    return days.ranges_by_day(minute_blocks(spark, sf))


@query(
    "D1 D2",
    with_views(MINUTE)
    + """SELECT min(CASE WHEN time >= 1704877200 THEN height END) AS first_height,
      max(CASE WHEN time < 1704931200 THEN height END) AS last_height FROM minute""",
)
def block_range_of_day_hours(spark, sf):
    """10 January 2024 from hour 9 to midnight."""
    return days.range_of_window(
        minute_blocks(spark, sf), *days.day_window("2024-01-10", 9, 24)
    )


@query(
    "D3",
    with_views(MINUTE)
    + "SELECT hash, height, time FROM minute WHERE time >= 1704844800 AND time < 1704931200",
)
def blocks_within_day(spark, sf):
    return days.within_window(
        minute_blocks(spark, sf), *days.day_window("2024-01-10")
    ).select("hash", "height", "time")
