"""All registered queries."""

from __future__ import annotations

from coinfold.plans import (  # noqa: F401  (registers on import)
    catalog_filters,
    catalog_jobs,
    catalog_rows,
)
from coinfold.plans.catalog import CATALOG
from coinfold.plans.catalog_ledger import explicit_output_by_day

__all__ = ["CATALOG", "explicit_output_by_day"]
