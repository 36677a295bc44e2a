"""Per-asset maps inside one row. No shuffle: the arrays belong to one transaction."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from coinfold.functions.amounts import to_base_units

_ENTRY = "struct<key:string,value:decimal(38,0)>"
_STATE = f"struct<done:array<{_ENTRY}>,last:{_ENTRY}>"


def _append(state: Column) -> Column:
    return F.concat(state["done"], F.array(state["last"]))


def sum_by_asset(entries: Column) -> Column:
    """Array of ``struct(asset, units)`` to ``map<asset, sum>``; null when nothing is left.

    Entries without asset or amount are skipped. The array is sorted once and folded, so
    the cost does not grow with assets times entries. Sums are kept wide; one that a bigint
    cannot hold fails the job rather than to go missing.
    """
    usable = F.sort_array(
        F.filter(entries, lambda e: e["asset"].isNotNull() & e["units"].isNotNull())
    )
    start = F.struct(
        F.array().cast(f"array<{_ENTRY}>").alias("done"), F.lit(None).cast(_ENTRY).alias("last")
    ).cast(_STATE)

    def add(state: Column, e: Column) -> Column:
        same = state["last"]["key"] == e["asset"]
        own = e["units"].cast("decimal(38,0)")
        units = F.when(same, F.try_add(state["last"]["value"], own)).otherwise(own)
        done = F.when(same | state["last"].isNull(), state["done"]).otherwise(_append(state))
        last = F.struct(e["asset"].alias("key"), units.alias("value"))
        return F.struct(done.alias("done"), last.alias("last")).cast(_STATE)

    folded = F.aggregate(usable, start, add, lambda state: _append(state))
    sums = F.transform_values(F.map_from_entries(folded), lambda _, total: _bigint(total))
    return F.when(F.size(usable) > 0, sums)


def _bigint(total: Column) -> Column:
    too_large = F.raise_error(F.lit("a sum of an asset is beyond bigint")).cast("bigint")
    return F.coalesce(total.try_cast("bigint"), too_large)


def asset_entries(items: Column, asset, value) -> Column:
    """Build the entries for :func:`sum_by_asset`; ``asset`` and ``value`` are functions
    from an array element to a Column."""
    return F.transform(
        items,
        lambda x: F.struct(asset(x).alias("asset"), to_base_units(value(x)).alias("units")),
    )


def fee_units(fee: Column) -> Column:
    """Node fee map to base units. Entries that are no exact amount are dropped; a missing
    map stays null."""
    return F.map_filter(
        F.transform_values(fee, lambda _, amount: to_base_units(amount)),
        lambda _, units: units.isNotNull(),
    )
