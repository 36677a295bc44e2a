"""Mixing sources to target weights, with built-in functions only.

The size of a document is its number of words. Weighted sampling without replacement after
Efraimidis and Spirakis: each document draws an exponential key, divided by its quality weight;
sorted by key within the source, documents are taken while the sum of sizes stays within the
source's budget. A target beyond the source's size takes the source as often as it goes in whole
before that selection of the rest.

A source may hold a third of all rows, so no task sorts a source: the keys' range is cut into
``CELLS`` cells per source that fill alike, sizes are summed per cell, and a running sum over the cells
gives each its start. Only rows of one cell are sorted together.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from coinfold.llm.common import staged

#: Weights of the sources in order of their names, over and over.
WEIGHTS = (3, 1, 2)
SHARE = 1.5
MOST_REPEATS = 2
CELLS, CELL_ROWS = 256, 100_000
WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: str | Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def quality_weight(chars: Column, words: Column) -> Column:
    """1 for six characters a word, blanks included; less the further away, never below a twentieth."""
    each = chars.cast("double") / words
    return F.when(words > 0, F.greatest(F.lit(0.05), 1 / (1 + F.abs(each - 6) / 6))).otherwise(1.0)


def draw(id_col: str | Column) -> Column:
    """A number between 0 and 1 that depends on the id alone: the first 52 bits of its MD5."""
    digits = F.substring(F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")), 1, 13)
    return (F.conv(digits, 16, 10).cast("long") + 0.5) / float(1 << 52)


def source_targets(sized: DataFrame) -> DataFrame:
    """source, source_size, target: the share of all sizes spread over the sources by weight.

    A target above ``MOST_REPEATS`` times its source stops there, and what is left goes to the others
    by weight. Sources sorted by how little weight they need to get there, those that stop come
    first, so running sums tell where the stopping ends. One row a source is all this works on.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    nth = F.row_number().over(by_name) - 1
    weight = F.element_at(F.array(*map(F.lit, WEIGHTS)), (nth % len(WEIGHTS) + 1).cast("int"))
    sums = sized.groupBy("source").agg(F.sum("size").alias("source_size")).withColumn("weight", weight)
    sums = sums.withColumn("most", MOST_REPEATS * F.col("source_size"))
    everything = Window.partitionBy()
    by_need = Window.orderBy((F.col("most") / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    before = by_need.rowsBetween(Window.unboundedPreceding, -1)
    left = F.sum("source_size").over(everything) * SHARE - F.coalesce(F.sum("most").over(before), F.lit(0))
    weights = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    sums = sums.withColumns({"nth": F.row_number().over(by_need), "level": left / weights})
    free = F.when(F.col("weight") * F.col("level") <= F.col("most"), F.struct("nth", "level"))
    sums = sums.withColumn("first_free", F.min(free).over(everything))
    stops = F.col("first_free").isNull() | (F.col("nth") < F.col("first_free.nth"))
    target = F.when(stops, F.col("most").cast("double")).otherwise(F.col("weight") * F.col("first_free.level"))
    return sums.select("source", "source_size", target.alias("target"))


def _taken(sized: DataFrame) -> DataFrame:
    """Of rows (row, doc_id, source, size, key): row, doc_id, size, source_size, target, taken."""
    targets = source_targets(sized)
    # the order of the rows cut into ranges of about as many rows, whatever their weights; ties end with the row number
    ranges = max(CELLS, sized.count() // CELL_ROWS)
    order = [F.col("source").asc_nulls_last(), "key", "doc_id", "row"]
    celled = staged(sized.repartitionByRange(ranges, *order).withColumn("cell", F.spark_partition_id()), "cells")
    cells = celled.groupBy("source", "cell").agg(F.sum("size").alias("cell_size"))
    over_cells = Window.partitionBy("source").orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)
    full = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0)
    plan = cells.withColumn("start", F.coalesce(F.sum("cell_size").over(over_cells), F.lit(0)))
    same = lambda a, b: a["source"].eqNullSafe(b["source"])
    plan = plan.join(targets, same(plan, targets)).select(
        plan["source"], "cell", "start", "source_size", "target", full.cast("long").alias("full")
    )
    plan = plan.withColumn("budget", F.floor(F.col("target") - F.col("full") * F.col("source_size")))
    in_cell = Window.partitionBy("source", "cell").orderBy("key", "doc_id", "row")
    rows = celled.withColumn("within", F.sum("size").over(in_cell.rowsBetween(Window.unboundedPreceding, 0)))
    rows = rows.join(plan, same(rows, plan) & (rows["cell"] == plan["cell"])).select(
        "row", "doc_id", rows["source"], "size", "key", "source_size", "target", "full", "budget",
        (F.col("size") > 0).alias("counts"), (F.col("start") + F.col("within") <= F.col("budget")).alias("fits"),
    )
    rows = staged(rows.withColumn("picked", F.col("counts") & F.col("fits")).drop("counts", "fits"), "mix")
    # one more document closes the gap that is left, if one brings the sum nearer to the target
    gaps = rows.groupBy("source").agg(
        F.min(F.col("budget") - F.lit(0)).alias("budget"), F.sum(F.when(F.col("picked"), F.col("size")).otherwise(0)).alias("sum")
    ).select(F.col("source").alias("s"), (F.col("budget") - F.col("sum")).alias("gap"))
    off = F.abs(F.col("gap") - F.col("size"))
    closing = (
        rows.where(~F.col("picked") & (F.col("size") > 0))
        .join(gaps, F.col("source").eqNullSafe(F.col("s")))
        .where(off < F.col("gap"))
        .groupBy("s")
        .agg(F.min(F.struct(off.alias("off"), "key", "doc_id", "row")).alias("best"))
        .select(F.col("best.row").alias("closing"))
    )
    rows = rows.join(closing, rows["row"] == closing["closing"], "left")
    times = F.col("full") + (F.col("picked") | F.col("closing").isNotNull()).cast("long")
    return rows.select("row", "doc_id", "size", "source_size", "target", (times * F.col("size")).alias("taken"))


def _sized(docs: DataFrame, *more: str) -> DataFrame:
    size, chars = word_count("text"), F.length("text")
    sized = docs.select(*more, "doc_id", "source", size.alias("size"), chars.alias("chars"))
    key = -F.log(draw("doc_id")) / quality_weight(F.col("chars"), F.col("size"))
    return sized.select(*more, "doc_id", "source", "size", key.alias("key"))


def mix(docs: DataFrame) -> DataFrame:
    """doc_id, size, source_size, target, taken: one row for every row of ``docs`` (doc_id, text, source).

    ``taken`` counts the words the mix takes of the document, repeats included: its size times 0, 1
    or 2. Defined cases: a null or blank text has size 0 and is not taken; a null source is a source,
    the last one; ties of keys go to the smaller id; rows that repeat an id count each for itself, in
    the order in which they were read; a null id draws like an empty text; an empty table gives no
    rows. Other columns are ignored. The same ids and texts give the same mix.
    """
    sized = staged(_sized(docs).withColumn("row", F.monotonically_increasing_id()), "sizes")
    return _taken(sized).drop("row")


def mixed(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, each as often as the mix takes it. Works on a written copy, whose rows are numbered."""
    kept = staged(docs.select(F.monotonically_increasing_id().alias("row"), F.struct(*docs.columns).alias("doc")), "mix-rows")
    sized = staged(_sized(kept.select("row", "doc.doc_id", "doc.text", "doc.source"), "row"), "sizes")
    taken = _taken(sized).where("taken > 0").select("row", (F.col("taken") / F.col("size")).cast("int").alias("times"))
    return kept.join(taken, "row").select("doc", F.explode(F.sequence(F.lit(1), "times"))).select("doc.*")


MIX_SQL = r"""
WITH sized AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
    length(text) AS chars,
    (CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13) AS BIGINT) + 0.5::DOUBLE)
      / 4503599627370496::DOUBLE AS u
  FROM documents),
keyed AS (
  SELECT doc_id, source, size, -ln(u) / CASE WHEN size > 0 THEN
    greatest(0.05::DOUBLE, 1 / (1 + abs(chars::DOUBLE / size - 6) / 6)) ELSE 1.0 END AS key
  FROM sized),
sums AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
    [3, 1, 2][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS INTEGER)] AS weight
  FROM keyed GROUP BY source),
levels AS (
  SELECT *, 2 * source_size AS most, row_number() OVER need AS nth,
    (sum(source_size) OVER () * 1.5::DOUBLE - coalesce(sum(2 * source_size) OVER before, 0))
      / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS level
  FROM sums
  WINDOW need AS (ORDER BY 2 * source_size / weight::DOUBLE, source NULLS LAST),
    before AS (ORDER BY 2 * source_size / weight::DOUBLE, source NULLS LAST
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
targets AS (
  SELECT source, source_size,
    CASE WHEN nth < coalesce(min(CASE WHEN weight * level <= most THEN nth END) OVER (), nth + 1)
      THEN most::DOUBLE
      ELSE weight * first_value(level) OVER (
        ORDER BY CASE WHEN weight * level <= most THEN nth END NULLS LAST
        ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) END AS target
  FROM levels),
planned AS (
  SELECT *, CASE WHEN source_size > 0 THEN CAST(floor(target / source_size) AS BIGINT) ELSE 0 END AS whole
  FROM targets),
run AS (
  SELECT k.*, p.source_size, p.target, p.whole,
    CAST(floor(p.target - p.whole * p.source_size) AS BIGINT) AS budget,
    sum(k.size) OVER (PARTITION BY k.source ORDER BY k.key, k.doc_id
      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto
  FROM keyed k JOIN planned p ON k.source IS NOT DISTINCT FROM p.source),
picked AS (SELECT *, size > 0 AND upto <= budget AS picked FROM run),
gaps AS (
  SELECT *, budget - sum(CASE WHEN picked THEN size ELSE 0 END) OVER (PARTITION BY source) AS gap
  FROM picked),
closing AS (
  SELECT *, NOT picked AND size > 0 AND abs(gap - size) < gap AND row_number() OVER (
    PARTITION BY source, NOT picked AND size > 0 AND abs(gap - size) < gap
    ORDER BY abs(gap - size), key, doc_id) = 1 AS closes
  FROM gaps)
SELECT doc_id, size, source_size, target,
  size * (whole + CASE WHEN picked OR closes THEN 1 ELSE 0 END) AS taken
FROM closing"""
