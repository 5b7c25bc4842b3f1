"""All registered queries over the driver's tables, each with its DuckDB oracle.

Importing this module imports every query module, which fills the registry.
"""

from lakeloom.plans import (  # noqa: F401
    q_embed,
    q_features,
    q_gold,
    q_ingest,
    q_profile,
    q_quality,
    q_resolve,
    q_search,
    q_sinks,
    q_stream,
)
from lakeloom.plans.registry import ORACLES, QUERIES, register, rounded  # noqa: F401
