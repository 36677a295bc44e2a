"""Export path: raw blocks to block items and transaction items with nested inputs/outputs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coinfold.functions.addresses import address_list
from coinfold.functions.amounts import amount, is_amount, total_text
from coinfold.functions.scripts import disassemble, op_return_payload
from coinfold.functions.truth import first_filled, nonempty, truthy
from coinfold.schemas import BLOCK_ITEM, TX_ITEM

# Item field <- source field, where the value is passed on unchanged.
BLOCK_FIELDS = {
    "hash": "hash",
    "confirmations": "confirmations",
    "size": "size",
    "stripped_size": "strippedsize",
    "weight": "weight",
    "number": "height",
    "version": "version",
    "version_hex": "versionHex",
    "merkle_root": "merkleroot",
    "timestamp": "time",
    "median_time": "mediantime",
    "nonce": "nonce",
    "bits": "bits",
    "difficulty": "difficulty",
    "chainwork": "chainwork",
    "previous_block_hash": "previousblockhash",
    "next_block_hash": "nextblockhash",
    "signblock_challenge": "signblock_challenge",
    "signblock_witness_asm": "signblock_witness_asm",
    "signblock_witness_hex": "signblock_witness_hex",
    "signblock_witness": "signblock_witness",
}
TX_FIELDS = {
    "txid": "txid",
    "wtxid": "wtxid",
    "withash": "withash",
    "tx_hex": "hex",
    "size": "size",
    "virtual_size": "vsize",
    "discount_virtual_size": "discountvsize",
    "weight": "weight",
    "discount_weight": "discountweight",
    "sigops": "sigops",
    "version": "version",
    "lock_time": "locktime",
    "node_fee": "fee",
}
INPUT_FIELDS = (
    "txid", "vout", "sequence", "pegin_witness", "pegin_value", "pegin_asset",
    "pegin_genesis_hash", "pegin_claim_script", "pegin_tx", "pegin_txout_proof",
    "pegin_blockhash",
)
OUTPUT_FIELDS = {
    "value": "value",
    "confidential_value": "valuecommitment",
    "asset_commitment": "assetcommitment",
    "n": "n",
    "nonce": "nonce",
    "surjection_proof": "surjectionproof",
    "rangeproof": "rangeproof",
}
OUTPUT_SCRIPT_FIELDS = {
    "required_signatures": "reqSigs",
    "scriptpubkey_asm": "asm",
    "scriptpubkey_hex": "hex",
    "script_type": "type",
}
PEGOUT_FIELDS = {
    "pegout_chain_genesis_hash": "genesis_hash",
    "pegout_btc_scriptpubkey_hex": "scriptpubkey",
    "pegout_value": "value",
    "pegout_asset": "asset",
    "pegout_extra_data_hex": "extra_data",
}


def listed_txids(tx: Column, bare: bool) -> Column:
    """Ids of the transactions of a block; ``bare`` also takes those given as plain ids."""
    ids = F.transform(
        F.coalesce(tx, F.array().cast(_type_of_txs())),
        lambda t: F.coalesce(nonempty(t["txid"]), t["bare_txid"])
        if bare
        else nonempty(t["txid"]),
    )
    return F.filter(ids, lambda i: i.isNotNull())


def transaction_total(n_tx: Column, tx: Column) -> Column:
    """Count given by the block, otherwise the length of its list."""
    return F.coalesce(n_tx, F.size(tx).cast("bigint"), F.lit(0).cast("bigint"))


def block_items(raw: DataFrame) -> DataFrame:
    """One item per block."""
    made = {name: F.col(source) for name, source in BLOCK_FIELDS.items()}
    made["transaction_count"] = transaction_total(F.col("nTx"), F.col("tx"))
    made["dynafed_current_params"] = first_filled(
        F.col("current_federation"), F.col("current_params")
    )
    made["dynafed_proposed_params"] = first_filled(
        F.col("proposed_federation"), F.col("proposed_params")
    )
    made["txids"] = listed_txids(F.col("tx"), bare=True)
    return raw.select(*[made[f.name].cast(f.dataType).alias(f.name) for f in BLOCK_ITEM.fields])


def transaction_items(raw: DataFrame) -> DataFrame:
    """One item per transaction object, with its inputs and outputs as arrays.

    Everything a transaction needs is in its own row, so there is no shuffle: the block is
    exploded once, the totals are folds over the row's arrays.
    """
    exploded = raw.select(
        F.col("hash").alias("block_hash"),
        F.col("height").alias("block_number"),
        F.col("time").alias("block_timestamp"),
        F.posexplode_outer("tx").alias("index", "_tx"),
    ).where(F.col("_tx").isNotNull() & F.col("_tx.bare_txid").isNull())
    tx = F.col("_tx")
    no_items = F.array()
    vins = F.coalesce(tx["vin"], no_items.cast(_type_of(tx_field="vin")))
    vouts = F.coalesce(tx["vout"], no_items.cast(_type_of(tx_field="vout")))
    ins, outs = F.filter(vins, lambda v: v.isNotNull()), F.filter(vouts, lambda v: v.isNotNull())
    shown = F.filter(outs, lambda v: ~_hidden(v["valuecommitment"], v["assetcommitment"], v["value"]))
    # Each amount is read once, from the source: totals do not need the items' arrays, nor these the totals.
    amounts = exploded.select(
        "*",
        F.exists(vins, lambda v: v["coinbase"].isNotNull()).alias("_minted"),
        F.transform(ins, _input).alias("inputs"),
        F.transform(outs, _output).alias("outputs"),
        F.size(ins).alias("_ins"),
        F.size(outs).alias("_outs"),
        F.exists(vins, lambda v: v.isNull()).alias("_malformed"),
        F.transform(ins, lambda v: amount(v["prevout"]["value"])).alias("_paid"),
        F.transform(shown, lambda v: amount(v["value"])).alias("_given"),
    )
    known = (
        (F.size("_paid") > 0)
        & ~F.coalesce(F.col("_minted"), F.lit(False))
        & ~F.coalesce(F.col("_malformed"), F.lit(False))
        & F.forall("_paid", is_amount)
    )
    totals = amounts.withColumn("_known", known)
    paid, given = F.col("_paid"), F.col("_given")
    open_ = F.col("_known") & (F.size("_given") == F.col("_outs"))
    made = {name: tx[source] for name, source in TX_FIELDS.items()}
    made |= {
        "hash": F.coalesce(nonempty(tx["txid"]), tx["hash"]),
        "is_coinbase": F.coalesce(F.col("_minted"), F.lit(False)),
        "input_count": F.col("_ins"),
        "output_count": F.col("_outs"),
        "input_value": F.when(F.col("_known"), total_text(paid)),
        "output_value": total_text(given),
        "fee": F.when(open_, total_text(paid, given)),
    }
    return totals.select(
        *[
            made.get(f.name, F.col(f.name)).cast(f.dataType).alias(f.name)
            for f in TX_ITEM.fields
        ]
    )


def with_item_id(items: DataFrame) -> DataFrame:
    """Stream items carry their hash as ``item_id``."""
    return items.withColumn("item_id", F.col("hash"))


def _hidden(value_commitment: Column, asset_commitment: Column, value: Column) -> Column:
    return (truthy(value_commitment) | truthy(asset_commitment)) & value.isNull()


def _input(vin: Column) -> Column:
    minted = vin["coinbase"].isNotNull()
    issuance = F.coalesce(vin["issuance"], vin["assetissuance"])
    pegged_in = truthy(vin["is_pegin"])
    spent = vin["prevout"]
    script = spent["scriptPubKey"]
    given_hex = vin["scriptSig"]["hex"]
    hex_text = F.when(minted & ~truthy_text(given_hex), vin["coinbase"]).otherwise(given_hex)
    given_asm = vin["scriptSig"]["asm"]
    # Minted inputs are read anew, others only where the node gave no operations.
    unread = truthy_text(hex_text) & (minted | ~truthy_text(given_asm))
    # Bound, so that a script is read once though its operations are looked at twice.
    own_asm = F.transform(
        F.array(disassemble(F.when(unread, hex_text))),
        lambda own: F.when(minted, nonempty(own)).otherwise(own),
    )[0]
    asm = F.coalesce(own_asm, F.when(minted | ~unread, given_asm))
    made = {name: vin[name] for name in INPUT_FIELDS}
    made |= {
        "input_type": F.when(issuance.isNotNull(), "issuance").when(pegged_in, "pegin"),
        "is_coinbase": minted,
        "scriptsig_asm": asm,
        "scriptsig_hex": hex_text,
        "coinbase_hex": vin["coinbase"],
        "witness": F.coalesce(vin["txinwitness"], vin["witness"]),
        "is_pegin": pegged_in,
        "issuance": issuance,
        "addresses": address_list(script),
        "required_signatures": script["reqSigs"],
        "type": script["type"],
        "value": spent["value"],
        "asset": spent["asset"],
        "scriptpubkey_asm": script["asm"],
        "scriptpubkey_hex": script["hex"],
        "enrichment_error": F.lit(None),
    }
    return _as_struct(made, "inputs")


def _output(vout: Column) -> Column:
    script = vout["scriptPubKey"]
    hidden = _hidden(vout["valuecommitment"], vout["assetcommitment"], vout["value"])
    pegged_out = pegout_flag(vout) | truthy(vout["pegout_chain"])
    made = {name: vout[source] for name, source in OUTPUT_FIELDS.items()}
    made |= {name: script[source] for name, source in OUTPUT_SCRIPT_FIELDS.items()}
    made |= {name: vout["pegout"][source] for name, source in PEGOUT_FIELDS.items()}
    made |= {
        "asset": F.coalesce(nonempty(vout["asset"]), script["asset"]),
        "type": F.when(pegged_out, "pegout").when(fee_flag(vout), "fee").when(
            hidden, "confidential"
        ),
        "addresses": address_list(script),
        "op_return_data_hex": op_return_payload(script["hex"]),
    }
    return _as_struct(made, "outputs")


def fee_flag(vout: Column) -> Column:
    """Output that pays the fee: flagged, or by its script type."""
    by_type = F.coalesce(vout["scriptPubKey"]["type"] == "fee", F.lit(False))
    return truthy(vout["is_fee"]) | by_type


def pegout_flag(vout: Column) -> Column:
    """Output that leaves the chain: flagged, described, or by its script."""
    described = F.coalesce(*[vout["pegout"][f] for f in PEGOUT_FIELDS.values()]).isNotNull()
    script = vout["scriptPubKey"]
    by_type = F.coalesce(script["type"] == "pegout", F.lit(False))
    return truthy(vout["is_pegout"]) | described | truthy(script["pegout"]) | by_type


def truthy_text(text: Column) -> Column:
    """Not missing and not empty; for hexadecimal text, where ``0`` is a value."""
    return F.coalesce(F.length(text) > 0, F.lit(False))


def _as_struct(made: dict[str, Column], field: str) -> Column:
    fields = TX_ITEM[field].dataType.elementType.fields
    return F.struct(*[made[f.name].cast(f.dataType).alias(f.name) for f in fields])


def _type_of(tx_field: str):
    from coinfold.schemas import RAW_TX

    return RAW_TX[tx_field].dataType


def _type_of_txs():
    from coinfold.schemas import RAW_BLOCK

    return RAW_BLOCK["tx"].dataType
