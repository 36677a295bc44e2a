"""What each of five filters removes, in every order in which they can be applied.

Which filters a document fails is one of 32 masks. In an order, it is removed at the first filter of its mask:
by filter x at step s, if x is in the mask and comes at place s after filters that are not. With the orders numbered
lexicographically (by their Lehmer code), all orders that begin alike are one interval of numbers. So each mask's
removals are a few intervals for each step and filter: its counts are added where an interval begins and taken away
where it ends, and one running sum over the 120 orders gives the totals of every order at once.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import permutations
from math import factorial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coinfold.llm.common import pieces_of, staged, text_bytes

FILTERS = "ABCDE"
ORDERS = ["".join(p) for p in permutations(FILTERS)]  # permutations come in lexicographic order
LEAST_WORDS, DISTINCT_PERCENT, CAPITAL_PERCENT = 100, 80, 10
SIGNS = b"#$%&*|"
COUNTS = ["kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]
_COPY = 1 << FILTERS.index("E")


def intervals(mask: int) -> Iterator[tuple[int, int, int, int]]:
    """(step, filter, first order, order after the last) of the orders in which ``mask`` is removed so; steps from 0."""
    width = len(FILTERS)

    def begun(prefix: tuple[int, ...], first: int) -> Iterator[tuple[int, int, int, int]]:
        step, rest = len(prefix), [x for x in range(width) if x not in prefix]
        size = factorial(width - 1 - step)
        for place, x in enumerate(rest):  # its digit of the Lehmer code
            low = first + place * size
            if mask >> x & 1:
                yield step, x, low, low + size
            elif step + 1 < width:
                yield from begun((*prefix, x), low)

    return begun((), 0)


INTERVALS = [list(intervals(mask)) for mask in range(1 << len(FILTERS))]


def totals(mask: np.ndarray, n: np.ndarray, good: np.ndarray, toxic: np.ndarray) -> dict[str, np.ndarray]:
    """For documents counted by mask: the columns of ``COUNTS``, a matrix of orders and steps each."""
    width, orders = len(FILTERS), len(ORDERS)
    change = np.zeros((3, width, width, orders + 1), np.int64)  # count, step, filter, order
    for m, *counts in zip(mask.tolist(), n, good, toxic, strict=True):
        for step, x, low, high in INTERVALS[m]:
            change[:, step, x, low] += counts
            change[:, step, x, high] -= counts
    removed = np.cumsum(change, axis=-1)[..., :orders]
    turn = np.array([[FILTERS.index(x) for x in order] for order in ORDERS])  # the filter of each order and step
    here = removed[:, np.arange(width)[None, :], turn, np.arange(orders)[:, None]]
    fails = np.array([n[mask >> x & 1 == 1].sum() for x in range(width)], np.int64)
    alone = np.array([n[mask == 1 << x].sum() for x in range(width)], np.int64)
    return {
        "kept": n.sum() - np.cumsum(here[0], axis=1),
        "removed": here[0],
        "redundant": fails[turn] - here[0],
        "unique_fails": alone[turn],
        "good_lost": here[1],
        "toxic_lost": here[2],
        "shapley": removed[0].sum(axis=(0, 2))[turn],
    }


def text_masks(texts: pa.Array) -> np.ndarray:
    """Which of A to D each text fails, a bit each."""
    data, starts = text_bytes(texts)
    masks = np.zeros(len(texts), np.int64)
    for low, high in pieces_of(starts):
        part = data[starts[low] : starts[high]]
        ends = starts[low : high + 1] - starts[low]
        flags = [part & 0xC0 != 0x80, (part >= 65) & (part <= 90), np.isin(part, np.frombuffer(SIGNS, np.uint8))]
        points, capitals, signs = (np.diff(np.concatenate([[0], np.cumsum(f)])[ends]) for f in flags)
        view = memoryview(part)
        words = [bytes(view[a:b]).split() for a, b in zip(ends[:-1], ends[1:], strict=True)]  # at ASCII blanks only
        count = np.fromiter(map(len, words), np.int64, len(words))
        distinct = np.fromiter((len(set(w)) for w in words), np.int64, len(words))
        failed = [
            count < LEAST_WORDS,
            100 * distinct < DISTINCT_PERCENT * count,
            100 * capitals > CAPITAL_PERCENT * points,
            signs > 0,
        ]
        masks[low:high] = sum(f.astype(np.int64) << bit for bit, f in enumerate(failed))
    return masks


def masked(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang") -> DataFrame:
    """doc_id, part, digest (of the text), mask (of A to D), for every row of ``docs``."""
    source = docs.select(
        F.col(id_col).alias("doc_id"),
        F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    ).withColumn("digest", F.unhex(F.sha2("text", 256)))

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            masks = pa.array(text_masks(batch.column("text")), pa.int64())
            columns = [batch.column(c) for c in ("doc_id", "part", "digest")]
            yield pa.RecordBatch.from_arrays([*columns, masks], names=["doc_id", "part", "digest", "mask"])

    kind = docs.schema[id_col].dataType.simpleString()
    return source.mapInArrow(work, f"doc_id {kind}, part string, digest binary, mask long")


def filter_audit(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", part_col: str = "lang"
) -> DataFrame:
    """part, filter_order, step and the columns of ``COUNTS``: 600 rows for each part.

    The filters fail a text with A: under 100 words; B: under 80 % distinct words; C: over 10 % of code points in
    A-Z; D: one of the ``SIGNS``; E: the same text in a row of smaller id, anywhere in the table.

    Defined cases: a null text is empty, a null part is the empty string's. A row without id is no copy of any row and
    none is its copy; of rows that repeat an id and a text, none is the other's copy. ``labels`` that repeat an id
    count where any of them says so; documents without a label, and labels without a document, are neither good nor
    toxic. An empty table has no parts, hence no rows. Other columns are ignored.

    What is kept of a text is its digest and mask. The least id of each text is found by a partial minimum, and is
    looked up by text and id together, so that a text which very many documents share is no task's burden. After that
    only counts by part and mask are left, at most 32 rows a part.
    """
    marked = staged(masked(docs, id_col, text_col, part_col), "masks")
    firsts = marked.groupBy("digest").agg(F.min("doc_id").alias("doc_id")).withColumn("first", F.lit(True))
    said = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.max(F.coalesce(F.col("quality") == 1, F.lit(False)).cast("long")).alias("good"),
        F.max(F.coalesce(F.col("toxic") == 1, F.lit(False)).cast("long")).alias("toxic"),
    )
    copy = F.when(F.col("doc_id").isNotNull() & F.col("first").isNull(), F.lit(_COPY)).otherwise(F.lit(0))
    counts = (
        marked.join(firsts, ["digest", "doc_id"], "left")
        .select("doc_id", "part", (F.col("mask") + copy).alias("mask"))
        .join(said, "doc_id", "left")
        .groupBy("part", "mask")
        .agg(
            F.count("*").alias("n"),
            F.coalesce(F.sum("good"), F.lit(0)).alias("good"),
            F.coalesce(F.sum("toxic"), F.lit(0)).alias("toxic"),
        )
    )

    def of_part(rows: pa.Table) -> pa.Table:
        columns = totals(*(rows.column(c).to_numpy() for c in ("mask", "n", "good", "toxic")))
        steps = len(FILTERS)
        keys = {
            "part": pa.repeat(rows.column("part")[0], len(ORDERS) * steps),
            "filter_order": pa.array(np.repeat(ORDERS, steps), pa.string()),
            "step": pa.array(np.tile(np.arange(1, steps + 1, dtype=np.int32), len(ORDERS))),
        }
        return pa.table(keys | {c: pa.array(columns[c].reshape(-1)) for c in COUNTS})

    shape = "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in COUNTS)
    return counts.groupBy("part").applyInArrow(of_part, shape)


AUDIT_SQL = r"""
WITH words AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         doc_id > min(doc_id) OVER (PARTITION BY coalesce(text, '')) AS late
  FROM documents
),
said AS (
  SELECT doc_id, max(CAST(quality IS NOT DISTINCT FROM 1 AS INT)) AS good, max(CAST(toxic IS NOT DISTINCT FROM 1 AS INT)) AS toxic
  FROM labels GROUP BY doc_id
),
masks AS (
  SELECT part, [len(w) < 100, 100 * len(list_distinct(w)) < 80 * len(w),
                100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 10 * length(text),
                regexp_matches(text, '[#$%&*|]'), coalesce(late, false)] AS fails,
         count(*) AS n, coalesce(sum(good), 0) AS good, coalesce(sum(toxic), 0) AS toxic
  FROM words LEFT JOIN said USING (doc_id) GROUP BY ALL
),
letters AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS x),
orders AS (
  SELECT a.x || b.x || c.x || d.x || e.x AS filter_order
  FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.x, b.x, c.x, d.x, e.x])) = 5
),
steps AS (SELECT filter_order, CAST(unnest(range(1, 6)) AS INT) AS step FROM orders),
turns AS (
  SELECT *, substr(filter_order, step, 1) AS x, ascii(substr(filter_order, step, 1)) - 64 AS mine,
         [ascii(c) - 64 FOR c IN string_split(substr(filter_order, 1, step - 1), '')] AS earlier
  FROM steps
),
cases AS (
  SELECT part, filter_order, step, x, n, good, toxic, fails[mine] AS failed,
         len(list_filter(earlier, lambda e: e > 0 AND fails[e])) > 0 AS gone,
         len(list_filter(fails, lambda f: f)) = 1 AS only_one
  FROM masks, turns
),
counts AS (
  SELECT part, filter_order, step, x,
         sum(CASE WHEN NOT gone AND NOT failed THEN n ELSE 0 END) AS kept,
         sum(CASE WHEN NOT gone AND failed THEN n ELSE 0 END) AS removed,
         sum(CASE WHEN gone AND failed THEN n ELSE 0 END) AS redundant,
         sum(CASE WHEN failed AND only_one THEN n ELSE 0 END) AS unique_fails,
         sum(CASE WHEN NOT gone AND failed THEN good ELSE 0 END) AS good_lost,
         sum(CASE WHEN NOT gone AND failed THEN toxic ELSE 0 END) AS toxic_lost
  FROM cases GROUP BY ALL
)
SELECT part, filter_order, step, CAST(kept AS BIGINT) AS kept, CAST(removed AS BIGINT) AS removed,
       CAST(redundant AS BIGINT) AS redundant, CAST(unique_fails AS BIGINT) AS unique_fails,
       CAST(good_lost AS BIGINT) AS good_lost, CAST(toxic_lost AS BIGINT) AS toxic_lost,
       CAST(sum(removed) OVER (PARTITION BY part, x) AS BIGINT) AS shapley
FROM counts
"""
