"""Schemas of raw blocks, items and tables.

Fixed values: the names and types below are the data contract.
"""

from __future__ import annotations

from pyspark.sql import types as T

CORRUPT = "_corrupt_record"


_TYPES = {
    "string": T.StringType(),
    "bigint": T.LongType(),
    "int": T.IntegerType(),
    "double": T.DoubleType(),
    "boolean": T.BooleanType(),
    "strings": T.ArrayType(T.StringType()),
    "texts": T.MapType(T.StringType(), T.StringType()),
    "amounts": T.MapType(T.StringType(), T.LongType()),
}


def columns(text: str, **nested: T.DataType) -> T.StructType:
    """Struct type from ``name type`` pairs; ``nested`` names further types."""
    known = {**_TYPES, **nested}
    pairs = [pair.split() for pair in text.split(",")]
    return T.StructType([T.StructField(name, known[kind]) for name, kind in pairs])


# ---- raw blocks, as the node writes them -------------------------------------------------

_SCRIPT = columns(
    "hex string, asm string, type string, address string, addresses strings,"
    "reqSigs bigint, pegout string, asset string"
)
_SCRIPT_SIG = columns("hex string, asm string")
ISSUANCE = columns(
    "assetBlindingNonce string, assetEntropy string, assetamount string,"
    "assetamountcommitment string, tokenamount string, tokenamountcommitment string,"
    "asset string, token string, isreissuance string"
)
_PREVOUT = columns(
    "value string, asset string, valuecommitment string, assetcommitment string,"
    "scriptPubKey script",
    script=_SCRIPT,
)
_VIN = columns(
    "coinbase string, txid string, vout bigint, sequence bigint, scriptSig script_sig,"
    "txinwitness strings, witness strings, is_pegin string, pegin_witness strings,"
    "pegin_value string, pegin_asset string, pegin_genesis_hash string,"
    "pegin_claim_script string, pegin_tx string, pegin_txout_proof string,"
    "pegin_blockhash string, issuance issued, assetissuance issued, prevout spent_output",
    script_sig=_SCRIPT_SIG,
    issued=ISSUANCE,
    spent_output=_PREVOUT,
)
_PEGOUT = columns(
    "genesis_hash string, scriptpubkey string, value string, asset string, extra_data string"
)
_VOUT = columns(
    "n bigint, value string, asset string, valuecommitment string, assetcommitment string,"
    "nonce string, surjectionproof string, rangeproof string, is_fee string,"
    "is_pegout string, pegout_chain string, pegout pegged_out, spent boolean,"
    "spentby string, spentbyvin bigint, spentheight bigint, scriptPubKey script",
    pegged_out=_PEGOUT,
    script=_SCRIPT,
)
# ``bare_txid`` is not in the source: it holds a transaction given as a plain id.
RAW_TX = columns(
    "txid string, wtxid string, hash string, withash string, hex string, version bigint,"
    "locktime bigint, size bigint, vsize double, weight bigint, discountvsize double,"
    "discountweight bigint, sigops bigint, fee texts, vin vins, vout vouts, bare_txid string",
    vins=T.ArrayType(_VIN),
    vouts=T.ArrayType(_VOUT),
)
RAW_BLOCK = columns(
    "hash string, height bigint, confirmations bigint, version bigint, versionHex string,"
    "previousblockhash string, nextblockhash string, merkleroot string, time bigint,"
    "mediantime bigint, nTx bigint, size bigint, strippedsize bigint, weight bigint,"
    "nonce bigint, bits string, difficulty double, chainwork string,"
    "signblock_challenge string, signblock_witness_hex string, signblock_witness_asm string,"
    "signblock_witness string, current_federation string, current_params string,"
    "proposed_federation string, proposed_params string, tx transactions",
    transactions=T.ArrayType(RAW_TX),
)

# ---- items, as exports and streams write them --------------------------------------------

_ITEM_INPUT = columns(
    "txid string, vout bigint, sequence bigint, input_type string, is_coinbase boolean,"
    "scriptsig_asm string, scriptsig_hex string, coinbase_hex string, witness strings,"
    "is_pegin boolean, pegin_witness strings, pegin_value string, pegin_asset string,"
    "pegin_genesis_hash string, pegin_claim_script string, pegin_tx string,"
    "pegin_txout_proof string, pegin_blockhash string, issuance issued,"
    "addresses strings, required_signatures bigint, type string, value string, asset string,"
    "scriptpubkey_asm string, scriptpubkey_hex string, enrichment_error string",
    issued=ISSUANCE,
)
_ITEM_OUTPUT = columns(
    "value string, confidential_value string, asset_commitment string, asset string,"
    "type string, n bigint, addresses strings, required_signatures bigint,"
    "scriptpubkey_asm string, scriptpubkey_hex string, script_type string,"
    "op_return_data_hex string, nonce string, surjection_proof string, rangeproof string,"
    "pegout_chain_genesis_hash string, pegout_btc_scriptpubkey_hex string,"
    "pegout_value string, pegout_asset string, pegout_extra_data_hex string"
)
BLOCK_ITEM = columns(
    "hash string, confirmations bigint, size bigint, stripped_size bigint, weight bigint,"
    "number bigint, version bigint, version_hex string, merkle_root string, timestamp bigint,"
    "median_time bigint, nonce bigint, bits string, difficulty double, chainwork string,"
    "previous_block_hash string, next_block_hash string, transaction_count bigint,"
    "signblock_challenge string, signblock_witness_asm string, signblock_witness_hex string,"
    "dynafed_current_params string, dynafed_proposed_params string, signblock_witness string,"
    "txids strings"
)
TX_ITEM = columns(
    "hash string, txid string, wtxid string, withash string, tx_hex string, size bigint,"
    "virtual_size double, discount_virtual_size double, weight bigint, discount_weight bigint,"
    "sigops bigint, version bigint, lock_time bigint, block_number bigint, block_hash string,"
    "block_timestamp bigint, is_coinbase boolean, index bigint,"
    "inputs inputs, outputs outputs,"
    "input_count bigint, output_count bigint, input_value string, output_value string,"
    "fee string, node_fee texts",
    inputs=T.ArrayType(_ITEM_INPUT),
    outputs=T.ArrayType(_ITEM_OUTPUT),
)
# Loading accepts a little more than exporting writes.
BLOCK_ITEM_INPUT = columns("item_id string, height bigint, n_tx bigint, raw_block string")
TX_ITEM_INPUT = columns("item_id string, vin string, vout string")

# ---- keyed tables ------------------------------------------------------------------------

BLOCKS = columns(
    "hash string, height bigint, version bigint, prev_block_hash string,"
    "next_block_hash string, merkle_root string, time bigint, median_time bigint,"
    "tx_count bigint, size bigint, stripped_size bigint, weight bigint,"
    "signblock_solution_hex string, txids strings"
)
TRANSACTIONS = columns(
    "txid string, wtxid string, hash string, withash string, block_hash string,"
    "block_height bigint, block_time bigint, tx_index_in_block int, confirmed boolean,"
    "version bigint, lock_time bigint, size bigint, vsize double, weight bigint,"
    "discount_vsize double, discount_weight bigint, vin_count int, vout_count int,"
    "fee_by_asset amounts, explicit_in_by_asset amounts,"
    "explicit_out_by_asset amounts, has_any_confidential boolean,"
    "has_pegin boolean, has_issuance boolean"
)
TXINS = columns(
    "txid string, vin int, prev_txid string, prev_vout int, sequence bigint,"
    "is_coinbase boolean, scriptsig_hex string, scriptsig_asm string,"
    "txinwitness strings, pegin_witness strings, is_pegin boolean,"
    "has_issuance boolean, issuance_asset_blinding_nonce string,"
    "issuance_asset_entropy string, issuance_amount bigint, issuance_inflation_keys bigint,"
    "prevout_scriptpubkey_hex string, prevout_script_type string, prevout_address string"
)
TXOUTS = columns(
    "txid string, vout int, asset_id string, asset_commitment string, value_sat bigint,"
    "value_commitment string, scriptpubkey_hex string, scriptpubkey_asm string,"
    "script_type string, address string, is_op_return boolean, op_return_data_hex string,"
    "is_fee boolean, surjection_proof string"
)
TABLES = {"blocks": BLOCKS, "transactions": TRANSACTIONS, "txins": TXINS, "txouts": TXOUTS}
TABLE_KEYS = {
    "blocks": ("hash",),
    "transactions": ("txid",),
    "txins": ("txid", "vin"),
    "txouts": ("txid", "vout"),
}
# Columns of earlier layouts that the tables above no longer have.
OBSOLETE = {
    "blocks": (
        "network", "nonce", "bits", "difficulty", "chainwork", "extdata_type",
        "signblock_challenge_hex", "dynafed_current_params", "dynafed_proposed_params",
        "signblock_witness", "raw_block_hex", "raw_block_json",
    ),
    "transactions": ("network", "has_pegout", "raw_tx_hex", "raw_tx_json"),
    "txins": (
        "network", "pegin_value_sat", "pegin_asset_id", "pegin_genesis_hash",
        "pegin_claim_script_hex", "pegin_mainchain_tx_hex", "pegin_merkle_proof_hex",
        "pegin_referenced_block_hash", "issuance_amount_commitment",
        "issuance_inflation_keys_commitment", "prevout_asset_id", "prevout_value_sat",
        "prevout_value_commitment", "prevout_asset_commitment",
    ),
    "txouts": (
        "network", "is_pegout", "pegout_chain_genesis_hash", "pegout_btc_scriptpubkey_hex",
        "pegout_value_sat", "pegout_asset_id", "pegout_extra_data_hex", "nonce", "rangeproof",
        "spent", "spent_by_txid", "spent_by_vin", "spent_at_height",
    ),
}
# A column that only the earliest layout has.
LEGACY_MARKER = {"blocks": "number", "transactions": "tx_index"}

# ---- flat layout: two tables, nested values as JSON text ---------------------------------

FLAT_BLOCKS = columns(
    "hash string, number bigint, timestamp bigint, median_time bigint, confirmations bigint,"
    "size bigint, stripped_size bigint, weight bigint, version bigint, version_hex string,"
    "merkle_root string, nonce bigint, bits string, previous_block_hash string,"
    "next_block_hash string, transaction_count bigint, signblock_challenge string,"
    "signblock_witness_asm string, signblock_witness_hex string"
)
FLAT_TRANSACTIONS = columns(
    "hash string, txid string, wtxid string, withash string, tx_hex string, index bigint,"
    "block_hash string, block_number bigint, block_timestamp bigint, lock_time bigint,"
    "size bigint, virtual_size double, discount_virtual_size double, weight bigint,"
    "discount_weight bigint, sigops bigint, version bigint, is_coinbase int,"
    "input_count bigint, output_count bigint, input_value string, output_value string,"
    "fee string, node_fee string, inputs string, outputs string"
)
FLAT_KEYS = {"blocks": ("hash",), "transactions": ("hash", "index")}
