"""Registered queries against their SQL on the smallest tables.

``CATALOG_SF_DIR`` names other tables, ``CATALOG_ALL=1`` runs every query.
"""

import os

import pytest

import __spark_entry__ as entry
from coinfold.plans.library import CATALOG
from tests.compare import compare, connect

SF_DIR = os.environ.get("CATALOG_SF_DIR", "/root/testdata/sf0.001")
QUICK = (
    "explicit_output_by_day", "enriched_inputs", "enriched_items", "spent_outputs",
    "interior_gaps", "gaps_with_edges", "merged_ranges", "kept_blocks", "losing_blocks",
    "tables_without_losers", "blocks_per_batch", "block_ranges_by_day", "output_rows",
    "filter_logic_on_missing", "filter_equality", "filter_text", "scripts_read",
    "amounts_in_base_units", "outputs_updated_by_key", "landed_raw_blocks",
)
NAMES = list(CATALOG) if os.environ.get("CATALOG_ALL") else QUICK

pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no driver tables")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", NAMES)
def test_query_matches_sql(spark, con, name):
    problem, _ = compare(entry.queries()[name](spark, SF_DIR), entry.oracle_sql()[name], con)
    assert not problem


def test_every_query_has_sql_and_names_what_it_covers():
    # queries that may be added beside the catalog are tested where they live
    assert all(query.sql for query in CATALOG.values())
    assert set(CATALOG) <= set(entry.oracle_sql()) <= set(entry.queries())


def test_entry_runs(spark):
    assert entry.entry(spark).columns == ["asset", "day", "outputs", "units"]
