"""Query catalogue.  Importing this package registers every query."""

from tidepool.plans import registry
from tidepool.plans import io, ml, observations, relational, text  # noqa: F401  (registers queries)

QUERIES = registry.QUERIES
ORACLES = registry.ORACLES

__all__ = ["QUERIES", "ORACLES"]
