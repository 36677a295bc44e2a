"""Queries over the driver tables, one or more per operator, with the SQL that checks them."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

Build = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Query:
    build: Build
    sql: str | None
    covers: str


CATALOG: dict[str, Query] = {}


def query(covers: str, sql: str | None = None):
    """Register a function under its own name. ``covers`` lists inventory ids."""

    def register(build: Build) -> Build:
        CATALOG[build.__name__] = Query(build, sql, covers)
        return build

    return register


# ---- the ledger view of the driver tables, in SQL ----------------------------------------

LINE = """
line AS (
  SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_returnflag,
    l_linestatus,
    md5(concat_ws('-', l_orderkey, l_linenumber, l_partkey, l_suppkey)) AS id,
    l_orderkey * 8 + l_linenumber AS height,
    CAST(floor(epoch(l_shipdate)) AS BIGINT) AS time,
    CAST(l_extendedprice AS DECIMAL(18,2)) AS price,
    CAST(CAST(l_extendedprice AS DECIMAL(18,2)) * CAST(l_tax AS DECIMAL(4,2))
      AS DECIMAL(18,4)) AS cost,
    CAST(CAST(l_extendedprice AS DECIMAL(18,2)) - 2 * CAST(CAST(l_extendedprice AS DECIMAL(18,2))
      * CAST(l_tax AS DECIMAL(4,2)) AS DECIMAL(18,4)) AS DECIMAL(18,4)) AS kept,
    'a' || right(CAST(l_suppkey AS VARCHAR), 1) AS asset,
    l_returnflag = 'R' AS hidden,
    l_linestatus = 'F' AND l_returnflag = 'A' AS pegin,
    lpad(lower(hex(l_partkey)), 8, '0') AS payload
  FROM lineitem)"""

_HEIGHT = "date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE))"

TX = f"""
tx AS (
  SELECT md5('t' || CAST(o_orderkey AS VARCHAR)) AS txid,
    md5('b' || CAST({_HEIGHT} AS VARCHAR)) AS block_hash, {_HEIGHT} AS block_height,
    CAST(floor(epoch(o_orderdate)) AS BIGINT) AS block_time, o_orderkey, o_orderstatus
  FROM orders)"""

FORKED_TX = TX.replace("\ntx AS", "\nftx AS").replace(
    f"CAST({_HEIGHT} AS VARCHAR)) AS block_hash",
    f"CAST({_HEIGHT} AS VARCHAR) || o_orderpriority) AS block_hash",
)

BLOCK = """
block AS (
  SELECT block_hash AS hash, block_height AS height, block_time AS time, count(*) AS tx_count
  FROM tx GROUP BY ALL)"""

FORKED_BLOCK = BLOCK.replace("\nblock AS", "\nfblock AS").replace("FROM tx", "FROM ftx")

OUT = """
picked AS (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
    ORDER BY l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC,
      l_discount DESC, l_tax DESC, l_returnflag DESC, l_linestatus DESC, l_shipdate DESC) AS nth
  FROM lineitem),
outp AS (
  SELECT md5('t' || CAST(l_orderkey AS VARCHAR)) AS txid, l_linenumber - 1 AS vout,
    CASE WHEN l_returnflag <> 'R' THEN 'a' || right(CAST(l_suppkey AS VARCHAR), 1) END AS asset,
    CASE WHEN l_returnflag <> 'R' THEN CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR)
      END AS value,
    CASE WHEN l_returnflag = 'R' THEN md5(CAST(CAST(l_extendedprice AS DECIMAL(18,2))
      AS VARCHAR)) END AS confidential_value,
    'addr' || CAST(l_suppkey AS VARCHAR) AS address, 'witness_v0_keyhash' AS script_type,
    l_orderkey, l_linenumber, l_quantity, l_linestatus
  FROM picked WHERE nth = 1)"""

INP = """
inp AS (
  SELECT md5('t' || CAST(l_orderkey + l_linenumber AS VARCHAR)) AS txid,
    l_linenumber - 1 AS vin,
    CASE WHEN l_quantity = 49 THEN md5('x' || CAST(l_orderkey AS VARCHAR)) ELSE txid END
      AS prev_txid,
    CASE WHEN l_quantity = 50 THEN vout + 100 ELSE vout END AS prev_vout
  FROM outp
  WHERE l_linestatus = 'F' AND EXISTS (
    SELECT 1 FROM orders WHERE o_orderkey = l_orderkey + l_linenumber))"""

MINUTE = """
minute AS (
  SELECT md5(CAST(event_id AS VARCHAR)) AS hash,
    CAST(floor(floor(epoch(ts)) / 60) AS BIGINT) AS height,
    CAST(floor(epoch(ts)) AS BIGINT) AS time, value, user_id
  FROM events)"""


def with_views(*views: str) -> str:
    return "WITH " + ",".join(views) + "\n"
