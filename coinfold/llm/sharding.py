"""Shards of bounded size by extendible hashing.

A row's place is given by the bits of a hash of its id. A bucket is a hash prefix; it starts as the empty
prefix, and as long as its rows hold more bytes than a shard may, it splits on the next bit, it alone and not
its neighbours. The directory maps prefixes of ``STEP`` bits more per level to the buckets.

Sizes are summed per prefix before anything else, so the directory is worked out from at most ``2 ** STEP`` cells at a
time. Rows of one hash cannot be parted by it: where they exceed a shard, they get overflow pages.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from coinfold.llm.common import staged

LIMIT_BYTES = 16_000_000
HASH_BITS, STEP = 60, 12


def hash_of(id_col: str) -> Column:
    """60 bits of the MD5 of the id as text; a null id counts as an empty text."""
    digits = F.substring(F.md5(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")), 1, 15)
    return F.conv(digits, 16, 10).cast("long")


def prefix(bits: int | Column) -> Column:
    """The first bits of column ``h``."""
    return F.col("h") if bits is HASH_BITS else F.shiftright("h", HASH_BITS - bits)


def _level(rows: DataFrame, level: int, limit: int) -> DataFrame:
    """Cells of the level's bits, each with the depth of its bucket, or null where even the cell is too large."""
    low, high = level * STEP, (level + 1) * STEP
    sums = rows.groupBy(prefix(low).alias("open"), prefix(high).alias("cell")).agg(
        F.sum("bytes").alias("bytes"), F.count("*").alias("rows"), F.max("bytes").alias("largest"), F.min("h").alias("least"), F.max("h").alias("most")
    )
    found = []
    for depth in range(low + (level > 0), high + 1):
        # within one "open" prefix, so the windows of all depths share one exchange
        bucket = Window.partitionBy("open", F.shiftright("cell", high - depth))
        total, alone = F.sum("bytes").over(bucket), F.min("least").over(bucket) == F.max("most").over(bucket)
        parts = [total.alias("bytes"), F.sum("rows").over(bucket).alias("rows"), F.max("largest").over(bucket).alias("largest")]
        fits = (total <= limit) | alone
        found.append(F.when(fits, F.struct(F.lit(depth).alias("depth"), *parts)))
    return sums.select("cell", F.coalesce(*found).alias("bucket"))


def assign_shards(docs: DataFrame, limit: int = LIMIT_BYTES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, bytes, shard, depth, page, shard_bytes: one row for every row of ``docs``.

    ``shard`` is the bucket's prefix in binary digits, ``depth`` their number, ``shard_bytes`` what the bucket holds, ``page`` 0
    but for overflow. The rows of a shard and page hold at most ``limit`` bytes of UTF-8 text, or are one
    row that alone is larger. Defined cases: a null text has no bytes; a null id hashes like an empty text; rows that repeat an
    id share a bucket, over several pages if need be; an empty table gives no rows. Other columns are ignored.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"), F.monotonically_increasing_id().alias("row"))
    return _placed(rows, limit).drop("row")


def _placed(docs: DataFrame, limit: int) -> DataFrame:
    """What ``assign_shards`` gives, and ``row``, of docs (doc_id, text, row); ``row`` is numbered per task, in the bits from the 33rd."""
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    rows = docs.select("doc_id", size.alias("bytes"), hash_of("doc_id").alias("h"), "row")
    left, done = staged(rows, "sizes"), []
    for level in range(HASH_BITS // STEP):
        cells = staged(_level(left, level, limit), "directory")
        joined = left.withColumn("cell", prefix((level + 1) * STEP)).join(cells, "cell").drop("cell")
        done.append(joined.where("bucket is not null"))
        if cells.where("bucket is null").isEmpty():
            break
        left = staged(joined.where("bucket is null").drop("bucket"), "oversized")
    placed = done[0]
    for more in done[1:]:
        placed = placed.unionByName(more)
    fits = F.col("bucket.bytes") <= limit
    # overflow: rows of one hash, numbered by task and within it, so no task numbers them all
    task = F.shiftright("row", 33).alias("task")
    over = placed.where(~fits).withColumn("task", task)
    within = Window.partitionBy("h", "task").orderBy("row")
    counts = over.groupBy("h", "task").count()
    ahead = Window.partitionBy("h").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("h", "task", F.coalesce(F.sum("count").over(ahead), F.lit(0)).alias("ahead"))
    each = F.greatest(F.lit(1), F.floor(limit / F.greatest(F.lit(1), F.col("bucket.largest"))))
    over = (
        over.withColumn("nth", F.row_number().over(within) - 1)
        .join(counts, ["h", "task"])
        .withColumn("page", F.floor((F.col("ahead") + F.col("nth")) / each).cast("long"))
    )
    placed = placed.where(fits).withColumn("page", F.lit(0).cast("long")).unionByName(over.drop("task", "nth", "ahead"))
    digits = F.lpad(F.bin("h"), HASH_BITS, "0")
    return placed.select(
        "doc_id", "bytes", digits.substr(F.lit(1), F.col("bucket.depth")).alias("shard"), F.col("bucket.depth").alias("depth"),
        "page", F.col("bucket.bytes").alias("shard_bytes"), "row",
    )


def write_shards(docs: DataFrame, path: str, limit: int = LIMIT_BYTES, id_col: str = "doc_id", text_col: str = "text") -> None:
    """Write ``docs`` below ``path``, a folder for each shard and page. Works on a written copy, whose rows are numbered."""
    kept = staged(docs.select(F.monotonically_increasing_id().alias("row"), F.struct(*docs.columns).alias("doc")), "shard-rows")
    places = _placed(kept.select(F.col(f"doc.{id_col}").alias("doc_id"), F.col(f"doc.{text_col}").alias("text"), "row"), limit)
    out = kept.join(places.select("row", "shard", "page"), "row").select("doc.*", "shard", "page")
    out.repartition("shard", "page").write.partitionBy("shard", "page").parquet(path)


SHARDS_SQL = f"""
WITH hashed AS (
  SELECT doc_id, coalesce(strlen(text), 0) AS bytes,
    CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 15) AS BIGINT) AS h
  FROM documents),
levels AS (SELECT CAST(range AS INTEGER) AS depth FROM range(0, {HASH_BITS + 1})),
buckets AS (
  SELECT depth, h >> ({HASH_BITS} - depth) AS prefix, CAST(sum(bytes) AS BIGINT) AS shard_bytes
  FROM hashed, levels GROUP BY ALL
  HAVING sum(bytes) <= {LIMIT_BYTES} OR min(h) = max(h))
SELECT doc_id, bytes, substr(lpad(bin(h), {HASH_BITS}, '0'), 1, depth) AS shard, depth,
  CAST(0 AS BIGINT) AS page, shard_bytes
FROM hashed JOIN buckets ON prefix = h >> ({HASH_BITS} - depth)
QUALIFY row_number() OVER (PARTITION BY doc_id ORDER BY depth) = 1"""
