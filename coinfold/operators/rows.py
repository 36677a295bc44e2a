"""Bulk path: raw blocks to block, transaction, input and output rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from coinfold.functions.addresses import pick_address
from coinfold.functions.amounts import to_base_units
from coinfold.functions.assets import asset_entries, fee_units, sum_by_asset
from coinfold.functions.scripts import disassemble, op_return_payload
from coinfold.functions.truth import first_filled, truthy
from coinfold.operators.items import (
    fee_flag,
    listed_txids,
    pegout_flag,
    transaction_total,
    truthy_text,
)
from coinfold.schemas import TABLES

# Row field <- source field, where the value is passed on unchanged.
BLOCK_FIELDS = {
    "hash": "hash",
    "height": "height",
    "version": "version",
    "prev_block_hash": "previousblockhash",
    "next_block_hash": "nextblockhash",
    "merkle_root": "merkleroot",
    "time": "time",
    "median_time": "mediantime",
    "nonce": "nonce",
    "bits": "bits",
    "difficulty": "difficulty",
    "chainwork": "chainwork",
    "size": "size",
    "stripped_size": "strippedsize",
    "weight": "weight",
    "signblock_challenge_hex": "signblock_challenge",
    "signblock_solution_hex": "signblock_witness_hex",
    "signblock_witness": "signblock_witness",
}
TX_FIELDS = {
    "txid": "txid",
    "wtxid": "wtxid",
    "hash": "hash",
    "withash": "withash",
    "version": "version",
    "lock_time": "locktime",
    "size": "size",
    "vsize": "vsize",
    "weight": "weight",
    "discount_vsize": "discountvsize",
    "discount_weight": "discountweight",
}
INPUT_FIELDS = {
    "prev_txid": "txid",
    "prev_vout": "vout",
    "sequence": "sequence",
    "pegin_witness": "pegin_witness",
    "pegin_asset_id": "pegin_asset",
    "pegin_genesis_hash": "pegin_genesis_hash",
    "pegin_claim_script_hex": "pegin_claim_script",
    "pegin_mainchain_tx_hex": "pegin_tx",
    "pegin_merkle_proof_hex": "pegin_txout_proof",
    "pegin_referenced_block_hash": "pegin_blockhash",
}
ISSUANCE_FIELDS = {
    "issuance_asset_blinding_nonce": "assetBlindingNonce",
    "issuance_asset_entropy": "assetEntropy",
    "issuance_amount_commitment": "assetamountcommitment",
    "issuance_inflation_keys_commitment": "tokenamountcommitment",
}
PREVOUT_FIELDS = {
    "prevout_asset_id": "asset",
    "prevout_value_commitment": "valuecommitment",
    "prevout_asset_commitment": "assetcommitment",
}
OUTPUT_FIELDS = {
    "vout": "n",
    "asset_id": "asset",
    "asset_commitment": "assetcommitment",
    "value_commitment": "valuecommitment",
    "nonce": "nonce",
    "surjection_proof": "surjectionproof",
    "rangeproof": "rangeproof",
    "spent": "spent",
    "spent_by_txid": "spentby",
    "spent_by_vin": "spentbyvin",
    "spent_at_height": "spentheight",
}
PEGOUT_FIELDS = {
    "pegout_chain_genesis_hash": "genesis_hash",
    "pegout_btc_scriptpubkey_hex": "scriptpubkey",
    "pegout_asset_id": "asset",
    "pegout_extra_data_hex": "extra_data",
}
SIGNED_BLOCK = "proof"


def block_rows(raw: DataFrame, network: str) -> DataFrame:
    """One row per block with all 24 columns; :func:`conform` narrows it to the table."""
    signed = (
        truthy(F.col("signblock_challenge"))
        | truthy(F.col("signblock_witness_hex"))
        | truthy(F.col("signblock_witness_asm"))
    )
    return raw.select(
        F.lit(network).alias("network"),
        *_pass(BLOCK_FIELDS, F.col),
        transaction_total(F.col("nTx"), F.col("tx")).alias("tx_count"),
        F.when(signed, SIGNED_BLOCK).alias("extdata_type"),
        first_filled(F.col("current_federation"), F.col("current_params")).alias(
            "dynafed_current_params"
        ),
        first_filled(F.col("proposed_federation"), F.col("proposed_params")).alias(
            "dynafed_proposed_params"
        ),
        listed_txids(F.col("tx"), bare=False).alias("txids"),
    )


def transaction_rows(raw: DataFrame, network: str) -> DataFrame:
    """One row per transaction object: flags, counts and per-asset maps from its arrays."""
    tx = F.col("_tx")
    vins, vouts = tx["vin"], tx["vout"]
    any_in = lambda test: F.coalesce(F.exists(vins, test), F.lit(False))
    any_out = lambda test: F.coalesce(F.exists(vouts, test), F.lit(False))
    return _transactions(raw).select(
        F.lit(network).alias("network"),
        *_pass(TX_FIELDS, lambda f: tx[f]),
        "block_hash",
        "block_height",
        "block_time",
        "tx_index_in_block",
        F.lit(True).alias("confirmed"),
        count_of(vins).alias("vin_count"),
        count_of(vouts).alias("vout_count"),
        F.coalesce(fee_units(tx["fee"]), F.create_map().cast("map<string,bigint>")).alias(
            "fee_by_asset"
        ),
        explicit_in(vins).alias("explicit_in_by_asset"),
        explicit_out(vouts).alias("explicit_out_by_asset"),
        any_out(_hides_something).alias("has_any_confidential"),
        any_in(lambda v: truthy(v["is_pegin"])).alias("has_pegin"),
        any_out(pegout_flag).alias("has_pegout"),
        any_in(_issues).alias("has_issuance"),
    )


def input_rows(raw: DataFrame, network: str) -> DataFrame:
    """One row per input with its position; elements that are no object are skipped but
    keep their position free."""
    vin = F.col("_vin")
    spent = vin["prevout"]
    script = spent["scriptPubKey"]
    issuance = F.coalesce(_with_content(vin["issuance"]), vin["assetissuance"])
    script_hex = F.coalesce(
        F.when(truthy_text(vin["scriptSig"]["hex"]), vin["scriptSig"]["hex"]),
        F.when(truthy_text(vin["coinbase"]), vin["coinbase"]),
    )
    asm = vin["scriptSig"]["asm"]
    exploded = (
        _transactions(raw)
        .select(
            F.col("_tx.txid").alias("txid"),
            "block_height",
            F.posexplode_outer("_tx.vin").alias("vin", "_vin"),
        )
        .where(vin.isNotNull())
    )
    return exploded.select(
        F.lit(network).alias("network"),
        "txid",
        "vin",
        *_pass(INPUT_FIELDS, lambda f: vin[f]),
        truthy_text(vin["coinbase"]).alias("is_coinbase"),
        script_hex.alias("scriptsig_hex"),
        F.when(truthy_text(script_hex) & ~truthy_text(asm), disassemble(script_hex))
        .otherwise(asm)
        .alias("scriptsig_asm"),
        F.coalesce(vin["txinwitness"], vin["witness"]).alias("txinwitness"),
        truthy(vin["is_pegin"]).alias("is_pegin"),
        to_base_units(vin["pegin_value"]).alias("pegin_value_sat"),
        _issues(vin).alias("has_issuance"),
        *_pass(ISSUANCE_FIELDS, lambda f: issuance[f]),
        to_base_units(issuance["assetamount"]).alias("issuance_amount"),
        to_base_units(issuance["tokenamount"]).alias("issuance_inflation_keys"),
        *_pass(PREVOUT_FIELDS, lambda f: spent[f]),
        to_base_units(spent["value"]).alias("prevout_value_sat"),
        script["hex"].alias("prevout_scriptpubkey_hex"),
        script["type"].alias("prevout_script_type"),
        pick_address(script).alias("prevout_address"),
        "block_height",
    )


def output_rows(raw: DataFrame, network: str) -> DataFrame:
    """One row per output, keyed by the number the output itself carries."""
    vout = F.col("_vout")
    script = vout["scriptPubKey"]
    payload = op_return_payload(script["hex"])
    exploded = (
        _transactions(raw)
        .select(
            F.col("_tx.txid").alias("txid"), "block_height", F.explode_outer("_tx.vout").alias("_vout")
        )
        .where(vout.isNotNull())
    )
    return exploded.select(
        F.lit(network).alias("network"),
        "txid",
        *_pass(OUTPUT_FIELDS, lambda f: vout[f]),
        to_base_units(vout["value"]).alias("value_sat"),
        script["hex"].alias("scriptpubkey_hex"),
        script["asm"].alias("scriptpubkey_asm"),
        script["type"].alias("script_type"),
        pick_address(script).alias("address"),
        payload.isNotNull().alias("is_op_return"),
        payload.alias("op_return_data_hex"),
        fee_flag(vout).alias("is_fee"),
        pegout_flag(vout).alias("is_pegout"),
        *_pass(PEGOUT_FIELDS, lambda f: vout["pegout"][f]),
        to_base_units(vout["pegout"]["value"]).alias("pegout_value_sat"),
        "block_height",
    )


def bulk_rows(raw: DataFrame, network: str) -> dict[str, DataFrame]:
    """The four row sets, with the block height on the children for table buckets."""
    return {
        "blocks": block_rows(raw, network),
        "transactions": transaction_rows(raw, network),
        "txins": input_rows(raw, network),
        "txouts": output_rows(raw, network),
    }


def conform(
    df: DataFrame, schema: T.StructType, renames: dict[str, str] | None = None
) -> DataFrame:
    """Bring rows to a table schema: rename, add missing columns as null, drop the rest."""
    renamed = df.withColumnsRenamed(renames or {})
    present = set(renamed.columns)
    return renamed.select(
        *[
            (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in schema.fields
        ]
    )


def conform_table(df: DataFrame, table: str) -> DataFrame:
    return conform(df, TABLES[table])


def count_of(items: Column) -> Column:
    """Elements of an array, counting a missing one as empty."""
    return F.coalesce(F.size(items), F.lit(0))


def explicit_in(vins: Column) -> Column:
    """Visible input amount per asset; null when nothing is visible."""
    return sum_by_asset(
        asset_entries(vins, lambda v: v["prevout"]["asset"], lambda v: v["prevout"]["value"])
    )


def explicit_out(vouts: Column) -> Column:
    """Visible output amount per asset; null when nothing is visible."""
    return sum_by_asset(asset_entries(vouts, lambda v: v["asset"], lambda v: v["value"]))


def _transactions(raw: DataFrame) -> DataFrame:
    return raw.select(
        F.col("hash").alias("block_hash"),
        F.col("height").alias("block_height"),
        F.col("time").alias("block_time"),
        F.posexplode_outer("tx").alias("tx_index_in_block", "_tx"),
    ).where(F.col("_tx").isNotNull() & F.col("_tx.bare_txid").isNull())


def _pass(fields: dict[str, str], source) -> list[Column]:
    return [source(old).alias(new) for new, old in fields.items()]


def _issues(vin: Column) -> Column:
    return vin["issuance"].isNotNull() | vin["assetissuance"].isNotNull()


def _with_content(issuance: Column) -> Column:
    names = (*ISSUANCE_FIELDS.values(), "assetamount", "tokenamount", "asset", "token")
    return F.when(F.coalesce(*[issuance[n] for n in names]).isNotNull(), issuance)


def _hides_something(vout: Column) -> Column:
    hiding = ("valuecommitment", "assetcommitment", "surjectionproof", "rangeproof")
    test = F.lit(False)
    for name in hiding:
        test = test | truthy(vout[name])
    return test
