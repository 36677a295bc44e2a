"""Near-duplicate documents by SimHash, compared exactly tile by tile.

Each text becomes a 64-bit fingerprint. Equal fingerprints are one node. The nodes are
laid out in tiles by the number of set bits in either half; two fingerprints that differ
in at most ``radius`` bits have counts that differ by no more in sum, so all other pairs of
tiles are skipped. A remaining pair of tiles is one unit of work: exclusive-or and bit
counts over all its pairs, reduced to a spanning forest before anything leaves the task,
so that a group of thousands of near copies costs links in proportion to its size.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructField, StructType

from coinfold.llm.common import each_run, staged, text_bytes
from coinfold.llm.components import connected_components, forest

RADIUS = 3
SHINGLE = 3
SEED = 42
#: A tile has so many fingerprints, more when the table is larger: fewer, larger units then
#: keep the copies of a fingerprint sent to the tiles around it in bounds.
TILE_LEAST, TILE_MOST, TILES_WANTED = 4096, 65536, 64

_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)
_DIGEST = xxhash.xxh64_intdigest


def fingerprint(text: bytes, words: int = SHINGLE) -> int:
    """The fingerprint of one text in UTF-8, as a signed 64-bit number; 0 if it has no words."""
    found = text.lower().split()  # both know ASCII only: A-Z, and \x20 \x09-\x0D
    if not found:
        return 0
    if len(found) < words:
        shingles = [b" ".join(found)]
    else:
        shingles = map(b" ".join, zip(*(found[k:] for k in range(words)), strict=False))
    hashes = np.fromiter(map(_DIGEST, shingles, repeat(SEED)), dtype=np.uint64)
    columns = hashes.view(np.uint8).reshape(-1, 8)
    ones = np.stack([np.bincount(columns[:, k], minlength=256) for k in range(8)]) @ _BITS
    return int(np.packbits(2 * ones > len(hashes), axis=1, bitorder="little").reshape(-1).view(np.int64)[0])


def with_fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", *more: Column) -> DataFrame:
    """doc_id, fp (long) and ``more`` for every row. A null text is empty: its fingerprint is 0."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, starts = text_bytes(batch.column(1))
            view = memoryview(data)
            prints = [fingerprint(bytes(view[a:b])) for a, b in zip(starts[:-1], starts[1:], strict=True)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(prints, pa.int64()), *batch.columns[2:]], names=names
            )

    source = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"), *more)
    shape = StructType([source.schema[0], StructField("fp", LongType()), *source.schema[2:]])
    names = shape.names
    return source.mapInArrow(work, shape)


def near_pairs(a: np.ndarray, b: np.ndarray, radius: int, rows: int = 256, cols: int = 4096):
    """Blocks of (i, j) with at most ``radius`` differing bits between ``a[i]`` and ``b[j]``."""
    for top in range(0, len(a), rows):
        for left in range(0, len(b), cols):
            apart = np.bitwise_count(a[top : top + rows, None] ^ b[None, left : left + cols])
            i, j = np.nonzero(apart <= radius)
            if len(i):
                yield i + top, j + left


def _tiles(cells: list[tuple[int, int, int]], total: int, radius: int):
    """Tiles of the cells (high, low, fingerprints), and for each tile those it is compared with."""
    most = int(min(TILE_MOST, max(TILE_LEAST, total // TILES_WANTED)))
    tiles, first = [], {}
    for high, low, n in sorted(cells):
        first[high, low] = (len(tiles), -(-n // most))
        tiles += [(high, low)] * first[high, low][1]
    near = []
    for high, low in tiles:
        mine = []
        for up in range(-radius, radius + 1):
            for side in range(abs(up) - radius, radius - abs(up) + 1):
                start, n = first.get((high + up, low + side), (0, 0))
                mine += range(start, start + n)
        near.append(mine)
    return first, near


def fingerprint_links(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """a, b: a spanning forest, within each pair of tiles, of the links among distinct ``fp``."""
    spark = prints.sparkSession
    half = lambda shift: F.bit_count(F.shiftrightunsigned("fp", shift).bitwiseAND(F.lit(0xFFFFFFFF)))
    prints = prints.withColumns({"high": half(32), "low": half(0)})
    # at most 33 x 33 rows, whatever the table
    cells = [tuple(r) for r in prints.groupBy("high", "low").count().collect()]
    first, near = _tiles(cells, sum(c[2] for c in cells), radius)
    layout = spark.createDataFrame(
        [(h, w, start, n) for (h, w), (start, n) in first.items()], "high int, low int, start int, n int"
    )
    meets = spark.createDataFrame(list(enumerate(near)), "tile int, others array<int>")
    placed = prints.join(layout, ["high", "low"]).select(
        "fp", (F.col("start") + F.pmod(F.xxhash64("fp"), F.col("n"))).cast("int").alias("tile")
    )
    sent = placed.join(meets, "tile").select("fp", "tile", F.explode("others").alias("other"))
    sent = sent.select(
        (F.least("tile", "other").cast("long") * F.lit(1 << 31) + F.greatest("tile", "other")).alias("unit"),
        (F.col("tile") > F.col("other")).alias("second"),
        "fp",
    )

    def compare(rows: pa.Table) -> pa.Table | None:
        second = rows.column("second").to_numpy()
        prints = rows.column("fp").to_numpy()
        same = int(rows.column("unit")[0].as_py())
        same = same >> 31 == same & ((1 << 31) - 1)
        a = np.sort(prints[~second])
        b = a if same else np.sort(prints[second])
        left, right = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for i, j in near_pairs(a.view(np.uint64), b.view(np.uint64), radius):
            apart = a[i] != b[j]
            if apart.any():
                left = np.concatenate([left, a[i][apart]])
                right = np.concatenate([right, b[j][apart]])
            if len(left) > 1_000_000:
                left, right = forest(left, right)
        if not len(left):
            return None
        left, right = forest(left, right)
        return pa.table({"a": left, "b": right})

    units = sum(map(len, near)) // 2 + len(near)
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return (
        sent.repartition(max(1, min(units, 4 * n)), "unit")
        .sortWithinPartitions("unit")
        .mapInArrow(each_run("unit", compare), "a long, b long")
    )


def _rooted(nodes: DataFrame, radius: int) -> DataFrame:
    """``nodes``, one row for each ``fp``, with ``root``, the least fingerprint reachable over links."""
    found = connected_components(fingerprint_links(nodes.select("fp"), radius), "a", "b")
    return nodes.join(found, nodes.fp == found.node, "left").select(*nodes.columns, F.coalesce("root", "fp").alias("root"))


def simhash_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", radius: int = RADIUS
) -> DataFrame:
    """doc_id, fingerprint, component_id: one row for every row of ``docs``.

    ``fingerprint`` has 16 lowercase hex digits. ``component_id`` is the least id reachable over
    links of at most ``radius`` differing bits, the document itself included.

    Defined cases: a null or blank text has fingerprint zero and links like any other. Repeated
    rows each give a row. A null id takes its component's least id, null if there is none. An
    empty table gives no rows. Other columns are ignored.
    """
    prints = staged(with_fingerprints(docs, id_col, text_col), "fingerprints")
    nodes = staged(prints.groupBy("fp").agg(F.min("doc_id").alias("least_id")), "nodes")
    nodes = _rooted(nodes, radius)
    leasts = nodes.groupBy("root").agg(F.min("least_id").alias("component_id"))
    by_print = nodes.join(leasts, "root").select("fp", "component_id")
    return prints.join(by_print, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def one_of_each_group(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stand for their group: of each group the row with the least id.

    Groups are of rows, not of ids: of rows that repeat an id one stays for each group in which the id is the
    least. A text of that id is told from its others by a 64-bit hash; of rows that repeat both one stays.
    Rows without an id stay; nothing can name them. A null or blank text is a text like any other, so of such rows
    with an id one stays. Columns keep their names and values, whatever they are called. An empty table gives no rows.
    """
    key = F.xxhash64(F.col(text_col).cast("string"))
    prints = staged(with_fingerprints(docs, id_col, text_col, key.alias("key")), "fingerprints")
    named = F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "key"))
    nodes = _rooted(staged(prints.groupBy("fp").agg(F.min(named).alias("least")), "nodes"), RADIUS)
    leasts = nodes.groupBy("root").agg(F.min("least").alias("least")).where("least is not null")
    kept = leasts.select(F.col("least.doc_id").alias("doc_id"), F.col("least.key").alias("key"))
    rows = docs.select(F.struct(*docs.columns).alias("row"), F.col(id_col).alias("doc_id"), key.alias("key"))
    found = rows.join(kept, ["doc_id", "key"], "left_semi").dropDuplicates(["doc_id", "key"])
    return found.unionByName(rows.where("doc_id IS NULL")).select("row.*")
