"""Exact top-k search by inner product, over buckets of vectors of like length.

Vectors are ordered by length and cut into shelves, one unit of storage each, and within a
shelf into buckets. First each query searches its own shelf, which yields a score its k-th best
cannot fall below. With that it visits the other shelves, but those whose longest vector is too
short to reach the score. For a bucket the score becomes a threshold on the cosine: score over the
product of the query's length and the bucket's longest. A threshold above 1 skips the bucket. For
queries with a high threshold, the coordinate with the largest part of the query has a narrow range of
values that a vector must have there, and sorted coordinates give those within; with a low one the
range says little, and the bucket's vectors are cut off where they get too short instead. What is left
is verified by its product.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from coinfold.llm.common import each_run, list_matrix, staged

TOP, EVERY, SCALE = 20, 20, 64.0
SHELF, BUCKET, BLOCK = 8192, 1024, 2048
#: From this cosine on, a bucket is searched by coordinates.
BY_COORDINATE = 0.6
_EXACT = float(1 << 52)


def integer_parts(vectors: np.ndarray) -> np.ndarray:
    return np.floor(SCALE * vectors.astype(np.float64))


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Inner products of rows of whole numbers, exact; beyond the range of long they stop at its ends."""
    if not len(a) or not len(b):
        return np.zeros((len(a), len(b)), np.int64)
    longest = np.sqrt((a * a).sum(axis=1).max()) * np.sqrt((b * b).sum(axis=1).max())
    if longest < _EXACT:
        return (a @ b.T).astype(np.int64)
    whole = [np.array([[int(x) for x in row] for row in m], dtype=object).reshape(m.shape) for m in (a, b)]
    ends = np.iinfo(np.int64)
    return np.clip(whole[0] @ whole[1].T, ends.min, ends.max).astype(np.int64)


class Found:
    """The best of each query so far, as flat rows, with the score the k-th cannot fall below.

    ``own`` is each query's own row, which is no candidate; rows of its id are.
    """

    def __init__(self, own: np.ndarray, floor: np.ndarray, top: int):
        self.own, self.floor, self.top = own, floor.copy(), top
        self.rows = [np.zeros(0, np.int64)] * 3

    def add(self, query: np.ndarray, row: np.ndarray, vec: np.ndarray, score: np.ndarray) -> None:
        good = (score >= self.floor[query]) & (row != self.own[query])
        q, v, s = (np.concatenate([old, new[good]]) for old, new in zip(self.rows, (query, vec, score), strict=True))
        order = np.lexsort((v, -s.astype(np.float64), q)) if len(s) and np.abs(s).max() < _EXACT else np.array(sorted(range(len(q)), key=lambda i: (q[i], -int(s[i]), v[i])), np.int64)
        q, v, s = q[order], v[order], s[order]
        first = np.searchsorted(q, q, side="left")
        rank = np.arange(len(q)) - first
        kept = rank < self.top
        last = rank == self.top - 1
        self.floor[q[last]] = np.maximum(self.floor[q[last]], s[last])
        self.rows = [q[kept], v[kept], s[kept]]


def search(queries: dict, vectors: dict, floor: np.ndarray, top: int) -> Found:
    """The best ``top`` of ``vectors`` for each query that reach its floor. Sides have rows, ids, whole, length."""
    found = Found(queries["rows"], floor, top)
    order = np.lexsort((vectors["ids"], -vectors["length"]))
    for at in range(0, len(order), BUCKET):
        bucket = order[at : at + BUCKET]
        rows, ids, whole, length = (vectors[k][bucket] for k in ("rows", "ids", "whole", "length"))
        reach = queries["length"] * length[0]
        with np.errstate(divide="ignore", invalid="ignore"):
            cosine = np.where(reach > 0, found.floor / reach, np.where(found.floor > 0, np.inf, -np.inf))
        live = np.flatnonzero(cosine <= 1 + 1e-9)
        narrow = cosine[live] >= BY_COORDINATE
        if len(broad := live[~narrow]):
            _by_length(found, queries, broad, rows, ids, whole, length)
        if narrow.any():
            _by_coordinate(found, queries, live[narrow], cosine, rows, ids, whole, length)
    return found


def _by_length(found: Found, queries: dict, chosen: np.ndarray, rows, ids, whole, length) -> None:
    for at in range(0, len(chosen), 256):
        part = chosen[at : at + 256]
        with np.errstate(divide="ignore", invalid="ignore"):
            least = np.where(queries["length"][part] > 0, found.floor[part] / queries["length"][part], -np.inf)
        end = int(np.searchsorted(-length, -(least.min() * (1 - 1e-9)) if least.min() > 0 else np.inf, side="right"))
        scores = products(queries["whole"][part], whole[:end])
        bar = found.floor[part]
        if end > found.top + 1:  # one row more, as a query may meet itself
            bar = np.maximum(bar, np.partition(scores, end - found.top - 1, axis=1)[:, end - found.top - 1])
        i, j = np.nonzero(scores >= bar[:, None])
        found.add(part[i], rows[j], ids[j], scores[i, j])


def _by_coordinate(found: Found, queries: dict, chosen: np.ndarray, cosine: np.ndarray, rows, ids, whole, length) -> None:
    unit = whole / np.where(length > 0, length, 1)[:, None]
    sorted_columns: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    q_out, r_out, v_out, s_out = [], [], [], []
    for q in chosen:
        own = queries["whole"][q] / queries["length"][q]
        focus = int(np.argmax(np.abs(own)))
        if focus not in sorted_columns:
            by = np.argsort(unit[:, focus], kind="stable")
            sorted_columns[focus] = by, unit[by, focus]
        by, values = sorted_columns[focus]
        turn, spread = np.arccos(np.clip(own[focus], -1, 1)), np.arccos(min(1.0, max(-1.0, cosine[q])))
        low, high = np.cos(min(np.pi, turn + spread)) - 1e-9, np.cos(max(0.0, turn - spread)) + 1e-9
        near = by[np.searchsorted(values, low, side="left") : np.searchsorted(values, high, side="right")]
        if len(near):
            scores = products(queries["whole"][q : q + 1], whole[near])[0]
            good = scores >= found.floor[q]
            q_out.append(np.full(int(good.sum()), q))
            r_out.append(rows[near[good]])
            v_out.append(ids[near[good]])
            s_out.append(scores[good])
    if q_out:
        found.add(*map(np.concatenate, (q_out, r_out, v_out, s_out)))


def _side(rows: pa.Table) -> dict:
    whole = integer_parts(list_matrix(rows.column("vector")))
    names = {"rows": rows.column("row").to_numpy(), "ids": rows.column("vec_id").to_numpy()}
    return names | {"whole": whole, "length": np.sqrt((whole * whole).sum(axis=1))}


def _result(found: Found, queries: dict) -> pa.Table | None:
    q, v, s = found.rows
    named = {"query_row": queries["rows"][q], "query_id": queries["ids"][q]}
    return pa.table(named | {"vec_id": v, "score": s}) if len(q) else None


_NONE = np.iinfo(np.int64).min


def _own_shelf(top: int, every: int):
    def work(rows: pa.Table) -> pa.Table | None:
        vectors = _side(rows)
        asks = vectors["ids"] % every == 0
        queries = {k: v[asks] for k, v in vectors.items()}
        return _result(search(queries, vectors, np.full(int(asks.sum()), _NONE), top), queries)

    return work


def _other_shelf(top: int):
    def work(rows: pa.Table) -> pa.Table | None:
        asks = pa.array(rows.column("asks").to_numpy(zero_copy_only=False))
        queries = rows.filter(asks)
        if not queries.num_rows or queries.num_rows == rows.num_rows:
            return None
        floor, queries = queries.column("floor").to_numpy(), _side(queries)
        return _result(search(queries, _side(rows.filter(pa.compute.invert(asks))), floor, top), queries)

    return work


def top_products(rows: DataFrame, top: int = TOP, every: int = EVERY) -> DataFrame:
    """query_id, rank, vec_id, score: for each row whose id ``every`` divides, the ``top`` other rows of the
    highest inner product of integer parts, floor(64 x); ties go to the smaller id.

    Defined cases: vectors that are null or hold null or non-finite components take no part, nor do rows
    without id. Vectors are compared with those of as many components. Rows that repeat an id are
    candidates each, for each other too, and queries each. A query with fewer others gets them all. Scores beyond the range of
    long stop at its ends. An empty table gives no rows. Other columns are ignored.
    """
    spark = rows.sparkSession
    vector = F.col("embedding").cast("array<double>")
    finite = F.coalesce(F.forall("embedding", lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False))), F.lit(False))
    usable = rows.where(F.col("vec_id").isNotNull() & finite).select(F.col("vec_id").cast("long").alias("vec_id"), vector.alias("vector"))
    square = F.aggregate("vector", F.lit(0.0), lambda s, x: s + F.pow(F.floor(x * SCALE), F.lit(2)))
    single = usable.withColumn("row", F.monotonically_increasing_id())
    single = staged(single.select("row", "vec_id", "vector", F.size("vector").alias("dim"), F.sqrt(square).alias("length")), "vectors")
    total, asking = single.agg(F.count("*"), F.coalesce(F.count_if(F.col("vec_id") % every == 0), F.lit(0))).first()
    shelves, blocks = max(1, -(-total // SHELF)), max(1, -(-asking // BLOCK))

    # a shelf is a range of the order by length; the id after it parts ties
    ranged = single.repartitionByRange(shelves, "dim", F.desc("length"), "vec_id", "row")
    # a shelf with vectors of two sizes counts as two
    shelved = staged(ranged.withColumn("shelf", F.spark_partition_id().cast("long") * 65536 + F.col("dim")), "shelves")
    n = 2 * int(spark.conf.get("spark.sql.shuffle.partitions"))
    shape = "query_row long, query_id long, vec_id long, score long"
    spread = lambda df, key: df.repartition(n, key).sortWithinPartitions(key)
    own = staged(spread(shelved, "shelf").mapInArrow(each_run("shelf", _own_shelf(top, every)), shape), "own-shelf")
    floors = own.groupBy("query_row").agg(F.count("*").alias("have"), F.min("score").alias("worst"))
    floors = floors.select("query_row", F.when(F.col("have") >= top, F.col("worst")).alias("worst"))
    queries = (
        shelved.where(F.col("vec_id") % every == 0)
        .join(floors, F.col("row") == F.col("query_row"), "left")
        .select("row", "vec_id", "vector", "dim", "length", F.col("shelf").alias("home"), F.coalesce("worst", F.lit(_NONE)).alias("floor"))
        .withColumn("block", F.pmod(F.xxhash64("row"), F.lit(blocks)))
    )
    stats = shelved.groupBy("dim", "shelf").agg(F.max("length").alias("longest"))
    reaches = stats.groupBy("dim").agg(F.collect_list(F.struct("shelf", "longest")).alias("shelves"))
    visits = (
        queries.join(reaches, "dim")
        .withColumn("visit", F.explode("shelves"))
        .where("visit.shelf != home and (length * visit.longest * (1 + 1e-9) >= floor)")
        .select(F.col("visit.shelf").alias("shelf"), "block", "row", "vec_id", "vector", "floor", F.lit(True).alias("asks"))
    )
    # a shelf goes to the blocks that hold a query which may find something there, and to no other
    visited = shelved.join(visits.select("shelf", "block").distinct(), "shelf").select(
        "shelf", "block", "row", "vec_id", "vector", F.lit(_NONE).alias("floor"), F.lit(False).alias("asks")
    )
    unit = F.concat_ws(":", "shelf", "block").alias("unit")
    work = visits.unionByName(visited).select(unit, "row", "vec_id", "vector", "floor", "asks")
    others = spread(work, "unit").mapInArrow(each_run("unit", _other_shelf(top)), shape)
    best = Window.partitionBy("query_row").orderBy(F.desc("score"), "vec_id")
    return (
        own.unionByName(others)
        .withColumn("rank", F.row_number().over(best))
        .where(F.col("rank") <= top)
        .select("query_id", "rank", "vec_id", "score")
    )
