"""Which source fields are ever filled, and which columns could go."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from coinfold.schemas import CORRUPT

# Audited fields per level.
AUDITED = {
    "block": (
        "bits", "nonce", "difficulty", "chainwork", "current_federation", "current_params",
        "proposed_federation", "proposed_params", "signblock_challenge",
        "signblock_witness_hex", "signblock_witness",
    ),
    "vin": (
        "prevout", "is_pegin", "pegin_witness", "pegin_value", "pegin_asset",
        "pegin_genesis_hash", "pegin_claim_script", "pegin_tx", "pegin_txout_proof",
        "pegin_blockhash", "issuance", "assetissuance", "txinwitness", "witness",
    ),
    "vout": (
        "asset", "assetcommitment", "value", "valuecommitment", "nonce", "surjectionproof",
        "rangeproof", "pegout", "is_pegout", "spent", "spentby", "spentbyvin", "spentheight",
    ),
    "prevout": ("asset", "value", "valuecommitment", "assetcommitment"),
    "issuance": (
        "assetBlindingNonce", "assetEntropy", "assetamount", "assetamountcommitment",
        "tokenamount", "tokenamountcommitment",
    ),
}
# Fields that can be pruned, per table, with the columns they feed.
PRUNABLE = {
    ("blocks", "block"): {
        "bits": ("bits",),
        "nonce": ("nonce",),
        "difficulty": ("difficulty",),
        "chainwork": ("chainwork",),
    },
    ("txins", "vin"): {
        "pegin_value": ("pegin_value_sat",),
        "pegin_asset": ("pegin_asset_id",),
        "pegin_genesis_hash": ("pegin_genesis_hash",),
        "pegin_claim_script": ("pegin_claim_script_hex",),
        "pegin_tx": ("pegin_mainchain_tx_hex",),
        "pegin_txout_proof": ("pegin_merkle_proof_hex",),
        "pegin_blockhash": ("pegin_referenced_block_hash",),
    },
    ("txouts", "vout"): {
        "nonce": ("nonce",),
        "rangeproof": ("rangeproof",),
        "pegout": (
            "pegout_chain_genesis_hash", "pegout_btc_scriptpubkey_hex", "pegout_value_sat",
            "pegout_asset_id", "pegout_extra_data_hex",
        ),
        "is_pegout": ("is_pegout",),
        "spent": ("spent",),
        "spentby": ("spent_by_txid",),
        "spentbyvin": ("spent_by_vin",),
        "spentheight": ("spent_at_height",),
    },
}


def field_audit(
    raw: DataFrame, audited: dict[str, tuple[str, ...]] = AUDITED
) -> DataFrame:
    """Long format ``level, field, sampled, hits``: rows seen at the level, and rows where
    the field is present and not null. ``audited`` names the fields of each level wanted.

    Counts are taken inside each block's row and summed in one aggregate over the scan; no
    input or output is exploded.
    """
    txs = F.filter("tx", lambda t: t.isNotNull() & t["bare_txid"].isNull())
    vins = F.flatten(F.transform(txs, lambda t: _objects(t["vin"])))
    vouts = F.flatten(F.transform(txs, lambda t: _objects(t["vout"])))
    per_block = raw.select(
        _is_block(raw).alias("_block"), *audited.get("block", ()), F.size(_or_empty(txs)).alias("_txs"), vins.alias("_vins"),
        vouts.alias("_vouts"),
    )
    prevouts = F.transform("_vins", lambda v: v["prevout"])
    issuances = F.transform("_vins", lambda v: F.coalesce(v["issuance"], v["assetissuance"]))
    levels = {"vin": F.col("_vins"), "vout": F.col("_vouts"), "prevout": prevouts,
              "issuance": issuances}
    sums = {("block", "", "sampled"): F.count_if("_block"), ("tx", "", "sampled"): F.sum("_txs")}
    for field in audited.get("block", ()):
        sums["block", field, "hits"] = F.count(field)
    for level, items in levels.items():
        sums[level, "", "sampled"] = F.sum(_hits(items, None))
        for field in audited.get(level, ()):
            sums[level, field, "hits"] = F.sum(_hits(items, field))
    names = {key: f"_{i}" for i, key in enumerate(sums)}
    totals = per_block.agg(
        *[F.coalesce(c, F.lit(0)).cast("bigint").alias(names[k]) for k, c in sums.items()]
    )
    rows = [
        F.struct(
            F.lit(level).alias("level"),
            F.lit(field).alias("field"),
            F.col(names[level, "", "sampled"]).alias("sampled"),
            F.col(names[level, field, "hits"]).alias("hits"),
        )
        for level, fields in audited.items()
        for field in fields
    ]
    return totals.select(F.inline_outer(F.array(*rows)))


def sampled_counts(raw: DataFrame) -> DataFrame:
    """Blocks, transactions, inputs and outputs seen."""
    txs = F.filter("tx", lambda t: t.isNotNull() & t["bare_txid"].isNull())
    inner = lambda f: F.aggregate(
        F.transform(txs, lambda t: F.size(_or_empty(_objects(t[f])))),
        F.lit(0), lambda total, n: total + n,
    )
    return raw.agg(
        F.count_if(_is_block(raw)).alias("blocks"),
        F.coalesce(F.sum(F.size(_or_empty(txs))), F.lit(0)).alias("transactions"),
        F.coalesce(F.sum(inner("vin")), F.lit(0)).alias("vins"),
        F.coalesce(F.sum(inner("vout")), F.lit(0)).alias("vouts"),
    )


def prunable_columns(audit: DataFrame) -> DataFrame:
    """``table_name, field, column_name`` of candidates that were never filled, only for
    levels that were seen at all."""
    columns: dict[tuple[str, str], list[Column]] = {}
    for (table, level), fields in PRUNABLE.items():
        for field, fed in fields.items():
            columns[level, field] = [
                F.struct(F.lit(table).alias("table_name"), F.lit(c).alias("column_name"))
                for c in fed
            ]
    fed_by = F.create_map(
        *[x for (level, field), fed in columns.items()
          for x in (F.lit(f"{level}.{field}"), F.array(*fed))]
    )
    never = (F.col("sampled") > 0) & (F.col("hits") == 0)
    unused = F.when(never, F.try_element_at(fed_by, F.concat_ws(".", "level", "field")))
    return audit.select("field", F.inline_outer(unused)).where(
        F.col("table_name").isNotNull()
    ).select("table_name", "field", "column_name")


def drop_statements(prunable: DataFrame) -> DataFrame:
    """One statement per column; ``conform`` does the same to a DataFrame."""
    return prunable.select(
        F.format_string(
            "ALTER TABLE %s DROP COLUMN IF EXISTS %s", "table_name", "column_name"
        ).alias("statement")
    )


def _is_block(raw: DataFrame) -> Column:
    """False for lines that are no block at all."""
    return F.col(CORRUPT).isNull() if CORRUPT in raw.columns else F.lit(True)


def _objects(items: Column) -> Column:
    return F.coalesce(F.filter(items, lambda x: x.isNotNull()), F.slice(items, 1, 0))


def _or_empty(items: Column) -> Column:
    return F.coalesce(items, F.array())


def _hits(items: Column, field: str | None) -> Column:
    test = lambda x: (x if field is None else x[field]).isNotNull()
    return F.coalesce(F.size(F.filter(items, test)), F.lit(0))
