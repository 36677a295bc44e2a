"""Item path into the tables: exported items to block, transaction, input and output rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coinfold.functions.addresses import first_address
from coinfold.functions.amounts import to_base_units
from coinfold.functions.assets import asset_entries, fee_units, sum_by_asset
from coinfold.functions.truth import nonempty, truthy
from coinfold.operators.rows import count_of
from coinfold.schemas import BLOCK_ITEM, BLOCK_ITEM_INPUT, TX_ITEM, TX_ITEM_INPUT

# Table field <- item field, where the value is passed on unchanged.
BLOCK_FIELDS = {
    "version": "version",
    "prev_block_hash": "previous_block_hash",
    "next_block_hash": "next_block_hash",
    "merkle_root": "merkle_root",
    "time": "timestamp",
    "median_time": "median_time",
    "tx_count": "transaction_count",
    "size": "size",
    "stripped_size": "stripped_size",
    "weight": "weight",
    "signblock_solution_hex": "signblock_witness_hex",
}
TX_FIELDS = {
    "wtxid": "wtxid",
    "hash": "hash",
    "withash": "withash",
    "block_hash": "block_hash",
    "block_height": "block_number",
    "block_time": "block_timestamp",
    "version": "version",
    "lock_time": "lock_time",
    "size": "size",
    "vsize": "virtual_size",
    "weight": "weight",
    "discount_vsize": "discount_virtual_size",
    "discount_weight": "discount_weight",
}
INPUT_FIELDS = {
    "prev_txid": "txid",
    "prev_vout": "vout",
    "sequence": "sequence",
    "scriptsig_hex": "scriptsig_hex",
    "scriptsig_asm": "scriptsig_asm",
    "txinwitness": "witness",
    "pegin_witness": "pegin_witness",
    "prevout_scriptpubkey_hex": "scriptpubkey_hex",
    "prevout_script_type": "type",
}
OUTPUT_FIELDS = {
    "vout": "n",
    "asset_id": "asset",
    "asset_commitment": "asset_commitment",
    "value_commitment": "confidential_value",
    "scriptpubkey_hex": "scriptpubkey_hex",
    "scriptpubkey_asm": "scriptpubkey_asm",
    "script_type": "script_type",
    "op_return_data_hex": "op_return_data_hex",
    "surjection_proof": "surjection_proof",
}
SEQUENCE = "_sequence"
RAW_REJECTED = "raw transaction: normalise it first, only items can be loaded"


def coerce_blocks(items: DataFrame) -> DataFrame:
    """Block items to table rows. A height of zero is a height; ids missing from the item
    are taken from ``raw_block``."""
    df = _with_columns(items, BLOCK_ITEM, BLOCK_ITEM_INPUT)
    txs = F.try_variant_get(F.try_parse_json("raw_block"), "$.tx", "array<variant>")
    from_raw = F.filter(
        F.transform(
            txs,
            lambda t: F.when(
                F.schema_of_variant(t) == "STRING", F.try_variant_get(t, "$", "string")
            ).otherwise(nonempty(F.try_variant_get(t, "$.txid", "string"))),
        ),
        lambda i: i.isNotNull(),
    )
    return df.select(
        F.coalesce(nonempty(F.col("hash")), F.col("item_id")).alias("hash"),
        F.coalesce("number", "height").alias("height"),
        *[F.col(old).alias(new) for new, old in BLOCK_FIELDS.items()],
        F.coalesce(F.col("txids"), from_raw).alias("txids"),
        *_order(df),
    )


def coerce_transactions(items: DataFrame) -> DataFrame:
    """Transaction items to table rows."""
    df = _checked(items)
    ins, outs = F.col("inputs"), F.col("outputs")
    fee = fee_units(F.col("node_fee"))
    any_of = lambda arr, test: F.coalesce(F.exists(arr, test), F.lit(False))
    return df.select(
        "txid",
        *[F.col(old).alias(new) for new, old in TX_FIELDS.items()],
        F.coalesce(F.col("index"), F.lit(0)).cast("int").alias("tx_index_in_block"),
        F.lit(True).alias("confirmed"),
        count_of(ins).alias("vin_count"),
        count_of(outs).alias("vout_count"),
        F.when(F.size(F.map_keys(fee)) > 0, fee).alias("fee_by_asset"),
        sum_by_asset(asset_entries(ins, lambda i: i["asset"], lambda i: i["value"])).alias(
            "explicit_in_by_asset"
        ),
        sum_by_asset(asset_entries(outs, lambda o: o["asset"], lambda o: o["value"])).alias(
            "explicit_out_by_asset"
        ),
        any_of(outs, lambda o: truthy(o["confidential_value"])).alias("has_any_confidential"),
        any_of(ins, _pegged_in).alias("has_pegin"),
        any_of(ins, _issuing).alias("has_issuance"),
        *_order(df),
    )


def coerce_inputs(items: DataFrame) -> DataFrame:
    """Inputs of transaction items to table rows."""
    row = F.col("_in")
    issuance = row["issuance"]
    return (
        _checked(items)
        .select(
            "txid", "block_number", *_order(items), F.posexplode_outer("inputs").alias("vin", "_in")
        )
        .where(row.isNotNull())
        .select(
            "txid",
            "vin",
            *[row[old].alias(new) for new, old in INPUT_FIELDS.items()],
            F.coalesce(row["is_coinbase"], F.lit(False)).alias("is_coinbase"),
            _pegged_in(row).alias("is_pegin"),
            _issuing(row).alias("has_issuance"),
            issuance["assetBlindingNonce"].alias("issuance_asset_blinding_nonce"),
            issuance["assetEntropy"].alias("issuance_asset_entropy"),
            to_base_units(issuance["assetamount"]).alias("issuance_amount"),
            to_base_units(issuance["tokenamount"]).alias("issuance_inflation_keys"),
            first_address(row["addresses"]).alias("prevout_address"),
            F.col("block_number").alias("block_height"),
            *_order(items),
        )
    )


def coerce_outputs(items: DataFrame) -> DataFrame:
    """Outputs of transaction items to table rows."""
    row = F.col("_out")
    return (
        _checked(items)
        .select("txid", "block_number", *_order(items), F.explode_outer("outputs").alias("_out"))
        .where(row.isNotNull())
        .select(
            "txid",
            *[row[old].alias(new) for new, old in OUTPUT_FIELDS.items()],
            to_base_units(row["value"]).alias("value_sat"),
            first_address(row["addresses"]).alias("address"),
            row["op_return_data_hex"].isNotNull().alias("is_op_return"),
            F.coalesce(row["type"] == "fee", F.lit(False)).alias("is_fee"),
            F.col("block_number").alias("block_height"),
            *_order(items),
        )
    )


def item_rows(
    blocks: DataFrame | None = None, transactions: DataFrame | None = None
) -> dict[str, DataFrame]:
    """Rows of the tables that the given items fill."""
    rows = {}
    if blocks is not None:
        rows["blocks"] = coerce_blocks(blocks)
    if transactions is not None:
        rows["transactions"] = coerce_transactions(transactions)
        rows["txins"] = coerce_inputs(transactions)
        rows["txouts"] = coerce_outputs(transactions)
    return rows


def _order(items: DataFrame) -> list[str]:
    """The place of the item in its input, where it is known, goes along with its rows."""
    return [SEQUENCE] if SEQUENCE in items.columns else []


def _checked(items: DataFrame) -> DataFrame:
    """Transaction items; a row that still has raw inputs and outputs fails the job."""
    df = _with_columns(items, TX_ITEM, TX_ITEM_INPUT)
    is_raw = F.col("vin").isNotNull() & F.col("vout").isNotNull()
    id_or_error = F.when(is_raw, F.raise_error(F.lit(RAW_REJECTED)).cast("string"))
    return df.withColumn("txid", id_or_error.otherwise(F.col("txid")))


def _pegged_in(row):
    by_type = F.coalesce(row["input_type"] == "pegin", F.lit(False))
    return by_type | F.coalesce(row["is_pegin"], F.lit(False))


def _issuing(row):
    return F.coalesce(row["input_type"] == "issuance", F.lit(False))


def _with_columns(df: DataFrame, *schemas) -> DataFrame:
    missing = {
        f.name: F.lit(None).cast(f.dataType)
        for schema in schemas
        for f in schema.fields
        if f.name not in df.columns
    }
    return df.withColumns(missing) if missing else df
