"""Near-duplicate vectors within a label: binary codes of rotated vectors decide what is computed exactly.

A vector of length one, turned by a fixed random rotation, has as its code the signs of its
coordinates; with the code goes its correction factor, the inner product f of the scaled code and
the vector itself. For another vector q, the inner product of the code and q, divided by f, is an
unbiased estimate of the cosine. What the code holds besides the vector, a part of length
sqrt(1 - f^2), points in a random direction; its inner product with a unit vector is above
e / sqrt(D - 1) with a chance below 2 exp(-e^2 / 2). So a cosine of t is estimated no lower than
t - sqrt(1 - t^2) sqrt(1 - f^2) / f times that, or times 1, which is certain. At ``CONFIDENCE`` the chance to
miss a link is below 1 in 10 billion. Pairs within the bound are recomputed in double precision.

Equal vectors are one class with a count. The classes of a label are dealt into tiles; a pair of tiles is one
unit of work, and what leaves it are link counts per class and a spanning forest, never pairs.
Work grows with the square of a label's distinct vectors, in products of a matrix.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coinfold.llm.common import each_run, list_matrix, staged
from coinfold.llm.components import connected_components, forest

COSINE, CONFIDENCE = 0.98, 7.0
#: Classes in a tile; more in labels of over ``TILES_WANTED`` tiles, to bound how often a class is sent.
TILE_LEAST, TILE_MOST, TILES_WANTED = 2048, 16384, 64
#: And never more than so many bytes of double precision.
TILE_BYTES = 8 << 20


@lru_cache(maxsize=4)
def rotation(dim: int) -> np.ndarray:
    """A fixed random orthogonal matrix."""
    q, r = np.linalg.qr(np.random.default_rng(dim).normal(size=(dim, dim)))
    return q * np.sign(np.diag(r))


def codes(unit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Packed signs of the rotated rows, and their correction factors."""
    turned = unit @ rotation(unit.shape[1])
    factor = np.abs(turned).sum(axis=1) / np.sqrt(unit.shape[1])
    return np.packbits(turned >= 0, axis=1), np.minimum(factor, 1.0)


def least_estimate(factor: np.ndarray, dim: int, cosine: float, confidence: float = CONFIDENCE) -> np.ndarray:
    """The lowest estimate that a pair of at least that cosine has, less what rounding may take."""
    spread = min(1.0, confidence / np.sqrt(dim - 1)) if dim > 1 else 1.0
    return cosine - spread * np.sqrt(1 - cosine**2) * np.sqrt(1 - factor**2) / factor - 2e-4


def is_usable(vector: str) -> Column:
    """Neither null nor zero, all components there and finite."""
    finite = F.forall(vector, lambda x: F.coalesce(F.abs(x) < float("inf"), F.lit(False)))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def links_between(a: dict, b: dict, cosine: float, rows: int = 256) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Blocks of (i, j) whose vectors reach the cosine. Sides have unit, code, factor of their vectors."""
    dim = a["unit"].shape[1]
    turned = (b["unit"] @ rotation(dim)).astype(np.float32)
    least = least_estimate(a["factor"], dim, cosine)
    for top in range(0, len(a["unit"]), rows):
        signs = np.unpackbits(a["code"][top : top + rows], axis=1, count=dim).astype(np.float32) * 2 - 1
        scale = (a["factor"][top : top + rows, None] * np.sqrt(dim)).astype(np.float32)
        estimate = (signs / scale) @ turned.T
        i, j = np.nonzero(estimate >= least[top : top + rows, None])
        for at in range(0, len(i), 50_000):
            x, y = i[at : at + 50_000] + top, j[at : at + 50_000]
            dots = np.einsum("ij,ij->i", a["vector"][x], b["vector"][y])
            near = dots / (a["norm"][x] * b["norm"][y]) >= cosine
            if near.any():
                yield x[near], y[near]


def _side(rows: pa.Table) -> dict:
    vector = list_matrix(rows.column("vector")).astype(np.float64)
    # far beyond float range, squares would overflow: scale first, which no cosine minds
    vector = vector / np.abs(vector).max(axis=1, keepdims=True)
    norm = np.sqrt(np.einsum("ij,ij->i", vector, vector))
    out = {"vector": vector, "norm": norm, "unit": vector / norm[:, None]}
    out |= {c: rows.column(c).to_numpy() for c in ("node", "n")}
    out["code"] = np.frombuffer(b"".join(rows.column("code").to_pylist()), np.uint8).reshape(len(vector), -1)
    out["factor"] = rows.column("factor").to_numpy()
    return out


def _compare(cosine: float):
    def work(rows: pa.Table) -> pa.Table | None:
        second = rows.column("second").to_numpy(zero_copy_only=False)
        unit = rows.column("unit")[0].as_py().split(":")
        same = unit[-1] == unit[-2]
        a = _side(rows.filter(pa.array(~second)))
        if not same and not second.any():
            return None
        b = a if same else _side(rows.filter(pa.array(second)))
        if not len(a["node"]):
            return None
        sums = [np.zeros(len(a["node"]), np.int64), np.zeros(len(b["node"]), np.int64)]
        left, right = np.zeros(0, np.int64), np.zeros(0, np.int64)
        for i, j in links_between(a, b, cosine):
            if same:
                i, j = i[i != j], j[i != j]  # both orders of a pair turn up
            np.add.at(sums[0], i, b["n"][j])
            if not same:
                np.add.at(sums[1], j, a["n"][i])
            left, right = np.concatenate([left, a["node"][i]]), np.concatenate([right, b["node"][j]])
            if len(left) > 500_000:
                left, right = forest(left, right)
        if not len(left):
            return None
        left, right = forest(left, right)
        reps = [a["node"]] if same else [a["node"], b["node"]]
        counted = np.concatenate(reps), np.concatenate(sums[: len(reps)])
        return pa.table(
            {
                "a": np.concatenate([counted[0], left]),
                "b": pa.concat_arrays([pa.nulls(len(counted[0]), pa.int64()), pa.array(right, pa.int64())]),
                "links": np.concatenate([counted[1], np.zeros(len(left), np.int64)]),
            }
        )

    return work


def _with_codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        vectors, rows = batch.column("vector"), batch.num_rows
        packed, factors = [b""] * rows, np.zeros(rows)
        dims = batch.column("dim").to_numpy()
        for dim in np.unique(dims):
            at = np.flatnonzero(dims == dim)
            x = list_matrix(vectors.take(pa.array(at))).astype(np.float64)
            x /= np.abs(x).max(axis=1, keepdims=True)
            found, factors[at] = codes(x / np.linalg.norm(x, axis=1, keepdims=True))
            for row, code in zip(at, found, strict=True):
                packed[row] = code.tobytes()
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array(packed, pa.binary()), pa.array(factors)], names=[*batch.schema.names, "code", "factor"]
        )


def near_vectors(rows: DataFrame, cosine: float = COSINE) -> DataFrame:
    """vec_id, n_links, component_id, kept: one row for every row of ``rows`` (vec_id, embedding, label).

    Vectors link if their labels are equal and not null and their cosine is at least ``cosine``.
    Defined cases: a vector that is null, zero or has a null or non-finite component links with
    nothing, nor does one without label or id; vectors of different lengths do not link. Equal
    vectors link, whatever their number. Rows that repeat an id count each as a vector, with links
    and a component of its own. A null id has no component and is kept. An empty table
    gives no rows. Other columns are ignored.
    """
    usable = F.col("vec_id").isNotNull() & F.col("label").isNotNull() & is_usable("embedding")
    rows = rows.select("vec_id", "label", "embedding", usable.alias("usable"))
    keys = [F.xxhash64("label", "embedding").alias("h"), F.xxhash64(F.lit("second"), "embedding", "label").alias("g")]
    keyed = rows.where("usable").select("vec_id", "label", "embedding", *keys)
    classes = keyed.groupBy("h", "g").agg(
        F.min("vec_id").alias("rep"), F.count("*").alias("n"), F.first("label").alias("label"), F.first("embedding").alias("vector")
    )
    classes = classes.withColumn("vector", F.col("vector").cast("array<double>")).withColumn("dim", F.size("vector"))
    classes = classes.withColumn("node", F.monotonically_increasing_id())
    label = rows.schema["label"].dataType.simpleString()
    shape = f"h long, g long, rep long, node long, n long, label {label}, vector array<double>, dim int, code binary, factor double"
    classes = staged(classes.select("h", "g", F.col("rep").cast("long").alias("rep"), "node", "n", "label", "vector", "dim").mapInArrow(_with_codes, shape), "classes")

    per_tile = F.least(F.lit(TILE_MOST), F.greatest(F.lit(TILE_LEAST), F.col("count") / TILES_WANTED), F.lit(TILE_BYTES // 8) / F.col("dim"))
    per_tile = F.greatest(F.lit(1), F.floor(per_tile))
    tiles = classes.groupBy("label", "dim").count().select("label", "dim", F.ceil(F.col("count") / per_tile).cast("int").alias("tiles"))
    dealt = classes.join(tiles, ["label", "dim"]).withColumn("tile", F.pmod("h", "tiles").cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
    low, high = F.least("tile", "other"), F.greatest("tile", "other")
    sent = dealt.select(
        F.concat_ws(":", "label", "dim", low, high).alias("unit"), (F.col("tile") > F.col("other")).alias("second"),
        "node", "n", "vector", "code", "factor",
    )
    n = 4 * int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    found = staged(
        sent.repartition(n, "unit").sortWithinPartitions("unit").mapInArrow(each_run("unit", _compare(cosine)), "a long, b long, links long"),
        "vector-links",
    )
    counted = found.where("b is null").groupBy("a").agg(F.sum("links").alias("links"))
    roots = connected_components(found.where("b is not null"), "a", "b")
    rooted = classes.select("h", "g", "rep", "node", "n").join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = rooted.groupBy("root").agg(F.min("rep").alias("component_id"))
    by_class = (
        rooted.join(least, "root")
        .join(counted, F.col("node") == counted["a"], "left")
        .select("h", "g", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), "component_id")
    )
    linked = keyed.select("vec_id", "h", "g").join(by_class, ["h", "g"]).select("vec_id", "n_links", "component_id")
    alone = rows.where(~F.col("usable")).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").cast("long").alias("component_id"))
    return linked.unionByName(alone).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
