"""Addresses of an output script."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from coinfold.functions.truth import nonempty


def pick_address(script: Column) -> Column:
    """First listed address, otherwise the single non-empty one."""
    listed = script["addresses"]
    return F.when(F.size(listed) > 0, listed[0]).otherwise(nonempty(script["address"]))


def address_list(script: Column) -> Column:
    """Listed addresses, otherwise the single one as a list; null when there is none."""
    listed = script["addresses"]
    single = nonempty(script["address"])
    return F.when(F.size(listed) > 0, listed).when(single.isNotNull(), F.array(single))


def first_address(addresses: Column) -> Column:
    return F.when(F.size(addresses) > 0, addresses[0])
