"""Heights: bounds, batches, missing ranges and competing blocks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

GAP_BUCKET = 100_000
_CELL_BITS, _CELL = 6, 64
REPORT_ROWS = 50
GAPS = "start_missing bigint, end_missing bigint"


def height_bounds(blocks: DataFrame) -> DataFrame:
    """Lowest and highest height, nulls when there is none."""
    return blocks.agg(F.min("height").alias("min_height"), F.max("height").alias("max_height"))


def max_height(blocks: DataFrame) -> int | None:
    return blocks.agg(F.max("height")).first()[0]


def resume_height(blocks: DataFrame) -> int:
    """First height still to be taken: behind the stored ones, zero for an empty table."""
    stored = max_height(blocks)
    return 0 if stored is None else stored + 1


def with_batches(df: DataFrame, start: int, end: int, size: int, column: str = "height"):
    """Rows of ``start..end`` with the bounds of their batch of ``size`` heights."""
    first = F.lit(start) + F.floor((F.col(column) - F.lit(start)) / F.lit(size)) * F.lit(size)
    return (
        df.where(F.col(column).between(start, end))
        .withColumn("block_start", first.cast("bigint"))
        .withColumn("block_end", F.least(F.lit(end), F.col("block_start") + (size - 1)))
    )


def batch_ranges(spark: SparkSession, start: int, end: int, size: int) -> DataFrame:
    """Consecutive ranges of ``size`` heights that cover ``start..end``."""
    count = max(0, -(-(end - start + 1) // size))
    return spark.range(count).select(
        (F.lit(start) + F.col("id") * size).alias("block_start"),
        F.least(F.lit(end), F.lit(start) + (F.col("id") + 1) * size - 1).alias("block_end"),
    )


# ---- missing ranges ----------------------------------------------------------------------


def missing_ranges(
    blocks: DataFrame, start: int | None = None, end: int | None = None,
    bucket: int = GAP_BUCKET,
) -> DataFrame:
    """Ranges of heights without a block, inside and at the edges of ``start..end``.

    Neighbours are found per bucket of heights, in parallel; only the first and last height
    of each bucket meet in the small second window. If nothing is present in the range there
    is nothing to anchor a gap, and none is reported.
    """
    present = blocks.where(F.col("height").isNotNull())
    if start is not None and end is not None:
        start, end = min(start, end), max(start, end)
        present = present.where(F.col("height").between(start, end))
    heights = (
        present.select("height")
        .distinct()
        .withColumn("_bucket", F.floor(F.col("height") / F.lit(bucket)))
    )
    inside = heights.select(
        F.col("height").alias("_at"),
        F.lead("height").over(W.partitionBy("_bucket").orderBy("height")).alias("_next"),
    )
    edges = heights.groupBy("_bucket").agg(
        F.min("height").alias("_first"), F.max("height").alias("_last")
    )
    across = edges.select(
        F.col("_last").alias("_at"), F.lead("_first").over(W.orderBy("_bucket")).alias("_next")
    )
    gaps = (
        inside.unionByName(across)
        .where(F.col("_next") > F.col("_at") + 1)
        .select(
            (F.col("_at") + 1).alias("start_missing"), (F.col("_next") - 1).alias("end_missing")
        )
    )
    if start is None or end is None:
        return gaps
    return gaps.unionByName(edge_ranges(edges, start, end))


def edge_ranges(edges: DataFrame, start: int, end: int) -> DataFrame:
    """Missing heights before the first and behind the last present one."""
    bounds = edges.agg(F.min("_first").alias("_low"), F.max("_last").alias("_high"))
    before = bounds.where(F.col("_low") > start).select(
        F.lit(start).cast("bigint").alias("start_missing"),
        (F.col("_low") - 1).alias("end_missing"),
    )
    behind = bounds.where(F.col("_high") < end).select(
        (F.col("_high") + 1).alias("start_missing"), F.lit(end).cast("bigint").alias("end_missing")
    )
    return before.unionByName(behind)


def merge_ranges(ranges: DataFrame, bucket: int = GAP_BUCKET) -> DataFrame:
    """Join ranges that overlap or touch.

    Ranges are ordered within buckets of their start. What earlier buckets reach, and which
    range a bucket continues, comes from one row per bucket, so no task sees all ranges.
    """
    low, high = F.col("start_missing"), F.col("end_missing")
    local = (
        ranges.groupBy("start_missing")
        .agg(F.max("end_missing").alias("end_missing"))
        .withColumn("_bucket", F.floor(low / F.lit(bucket)))
    )
    earlier_buckets = W.orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    reach = (
        local.groupBy("_bucket")
        .agg(F.max("end_missing").alias("_reach"))
        .select("_bucket", F.max("_reach").over(earlier_buckets).alias("_reach"))
    )
    in_order = W.partitionBy("_bucket").orderBy("start_missing")
    before = F.max("end_missing").over(in_order.rowsBetween(W.unboundedPreceding, -1))
    opens = F.coalesce((low > F.greatest(before, F.col("_reach")) + 1).cast("int"), F.lit(1))
    numbered = (
        local.join(reach, "_bucket")
        .withColumn("_opens", opens)
        .withColumn(
            "_nth", F.sum("_opens").over(in_order.rowsBetween(W.unboundedPreceding, 0))
        )
    )
    opened = F.when(F.col("_last") > 0, F.struct("_bucket", F.col("_last").alias("_nth")))
    continued = (
        numbered.groupBy("_bucket")
        .agg(F.max("_nth").alias("_last"))
        .select(
            "_bucket", F.last(opened, ignorenulls=True).over(earlier_buckets).alias("_open")
        )
    )
    own = F.struct("_bucket", "_nth")
    return (
        numbered.join(continued, "_bucket")
        .groupBy(F.when(F.col("_nth") > 0, own).otherwise(F.col("_open")).alias("_range"))
        .agg(F.min(low).alias("start_missing"), F.max(high).alias("end_missing"))
        .drop("_range")
    )


def repair_ranges(
    blocks: DataFrame, start: int, end: int, backfill_present: bool = False
) -> DataFrame:
    """What to take in again: the missing ranges, or with ``backfill_present`` all of it."""
    low, high = min(start, end), max(start, end)
    if backfill_present:
        return blocks.sparkSession.range(1).select(
            F.lit(low).cast("bigint").alias("start_missing"),
            F.lit(high).cast("bigint").alias("end_missing"),
        )
    return merge_ranges(missing_ranges(blocks, low, high))


def range_totals(ranges: DataFrame) -> DataFrame:
    """Number of heights and of ranges."""
    span = F.col("end_missing") - F.col("start_missing") + 1
    return ranges.agg(
        F.coalesce(F.sum(span), F.lit(0)).alias("missing_blocks"), F.count("*").alias("ranges")
    )


def range_report(ranges: DataFrame, rows: int = REPORT_ROWS) -> DataFrame:
    """The first ranges in order; the report is a preview, the totals count the rest."""
    return ranges.orderBy("start_missing").limit(rows)


def range_cells(ranges: DataFrame) -> DataFrame:
    """Disjoint ranges as cells of 64 heights: the cell's number and a bit for each height that is in a range."""
    low, high = F.col("start_missing"), F.col("end_missing")
    cell = F.shiftleft(F.col("_cell"), _CELL_BITS)
    first, last = F.greatest(low, cell) - cell, F.least(high, cell + _CELL - 1) - cell
    bits = F.expr("shiftleft(shiftrightunsigned(-1L, CAST(_size AS INT)), CAST(_first AS INT))")
    return (
        ranges.where(F.least(low, high) == low)
        .select(low, high, F.explode(F.sequence(F.shiftright(low, _CELL_BITS), F.shiftright(high, _CELL_BITS))).alias("_cell"))
        .select("_cell", first.alias("_first"), (_CELL - 1 - (last - first)).alias("_size"))
        .groupBy("_cell")
        .agg(F.bit_or(bits).alias("_bits"))
    )


def blocks_in_ranges(raw: DataFrame, ranges: DataFrame) -> DataFrame:
    """Raw blocks whose height lies in one of the disjoint ranges.

    The ranges become cells of 64 aligned heights with a bit for each height, so that a block is looked up by one
    equality join on its cell, a key that no more than 64 heights share, and a test of its bit.
    """
    cells = range_cells(ranges)
    at = F.expr("CAST(height & 63 AS INT)")
    placed = raw.where(F.col("height").isNotNull()).withColumn("_cell", F.shiftright(F.col("height").cast("bigint"), _CELL_BITS))
    inside = F.expr("shiftrightunsigned(_bits, _at) & 1L") == 1
    return placed.withColumn("_at", at).join(cells, "_cell").where(inside).select(*raw.columns)


# ---- competing blocks --------------------------------------------------------------------


def duplicate_heights(
    blocks: DataFrame, start: int | None = None, end: int | None = None
) -> DataFrame:
    """Heights with more than one block."""
    return (
        _in_bounds(blocks, start, end)
        .groupBy("height")
        .agg(F.count("*").alias("blocks"))
        .where(F.col("blocks") > 1)
    )


def block_standing(blocks: DataFrame, transactions: DataFrame) -> DataFrame:
    """Blocks with the number of their transactions, zero for none."""
    counted = transactions.groupBy(F.col("block_hash").alias("_hash")).agg(
        F.count("txid").alias("_count")
    )
    return (
        blocks.groupBy("hash", "height")
        .agg(F.max("time").alias("time"))
        .join(counted, F.col("hash") == F.col("_hash"), "left")
        .select("hash", "height", "time", F.coalesce("_count", F.lit(0)).alias("transactions"))
    )


def rival_blocks(blocks: DataFrame, start: int | None = None, end: int | None = None) -> DataFrame:
    """Blocks at heights that have more than one: hash, height, latest time."""
    each = _in_bounds(blocks, start, end).groupBy("hash", "height").agg(F.max("time").alias("time"))
    several = each.groupBy("height").agg(F.count("*").alias("_n")).where("_n > 1")
    return each.join(several, "height", "left_semi").select("hash", "height", "time")


def kept_blocks(
    blocks: DataFrame, transactions: DataFrame, start: int | None = None, end: int | None = None
) -> DataFrame:
    """The block to keep for every duplicate height: most transactions, then latest time,
    then largest hash. The choice is a maximum over a struct, so a height with very many
    blocks is reduced before the shuffle. Only transactions of blocks that have a rival are counted."""
    rivals = rival_blocks(blocks, start, end)
    theirs = transactions.join(rivals.select(F.col("hash").alias("block_hash")), "block_hash", "left_semi")
    standing = block_standing(rivals, theirs)
    best = F.max(F.struct("transactions", "time", "hash"))
    return (
        standing.groupBy("height")
        .agg(best.alias("_best"), F.count("*").alias("_blocks"))
        .where(F.col("_blocks") > 1)
        .select(
            "height",
            F.col("_best.hash").alias("keep_hash"),
            (F.col("_blocks") - 1).alias("removed_blocks"),
        )
    )


def losing_blocks(
    blocks: DataFrame, transactions: DataFrame | None = None, start: int | None = None, end: int | None = None,
    kept: DataFrame | None = None,
) -> DataFrame:
    """Hashes of the blocks that lose against another one at their height. ``kept``, if the blocks to keep are
    known already, saves finding them again."""
    if kept is None:
        kept = kept_blocks(blocks, transactions, start, end)
    return (
        _in_bounds(blocks, start, end)
        .select("hash", "height")
        .join(kept, "height")
        .where(F.col("hash") != F.col("keep_hash"))
        .select("hash", "height")
        .distinct()
    )


def drop_blocks(tables: dict[str, DataFrame], losers: DataFrame) -> dict[str, DataFrame]:
    """All four tables without the given blocks and everything that belongs to them."""
    gone = losers.select(F.col("hash").alias("_gone")).distinct()
    lost = (
        tables["transactions"]
        .join(gone, F.col("block_hash") == F.col("_gone"), "left_semi")
        .select(F.col("txid").alias("_lost"))
        .distinct()
    )
    without = {
        "blocks": tables["blocks"].join(gone, F.col("hash") == F.col("_gone"), "left_anti")
    }
    for name in ("transactions", "txins", "txouts"):
        without[name] = tables[name].join(lost, F.col("txid") == F.col("_lost"), "left_anti")
    return without


def _in_bounds(blocks: DataFrame, start: int | None, end: int | None) -> DataFrame:
    test: Column = F.col("height").isNotNull()
    if start is not None and end is not None:
        test = test & F.col("height").between(min(start, end), max(start, end))
    return blocks.where(test)
