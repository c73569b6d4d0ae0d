"""Data marts and the catalogue of registered queries."""

from tallyforge.plans.registry import ORACLES, QUERIES, query  # noqa: F401
from tallyforge.plans import kpi_queries  # noqa: F401
from tallyforge.plans import enrich_queries  # noqa: F401
from tallyforge.plans import mart_queries  # noqa: F401
from tallyforge.plans import cohort_queries  # noqa: F401
from tallyforge.plans import sequence_queries  # noqa: F401
from tallyforge.plans import segment_queries  # noqa: F401
from tallyforge.plans import state_queries  # noqa: F401
from tallyforge.plans import lake_queries  # noqa: F401
