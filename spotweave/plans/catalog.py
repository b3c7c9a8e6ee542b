"""All registered queries."""

from spotweave.plans.flagship import flagship
from spotweave.plans.registry import ORACLES, QUERIES
from spotweave.plans import queries_sources  # noqa: F401
from spotweave.plans import queries_contracts  # noqa: F401
from spotweave.plans import queries_exprs  # noqa: F401
from spotweave.plans import queries_joins  # noqa: F401
from spotweave.plans import queries_aggs  # noqa: F401
from spotweave.plans import queries_models  # noqa: F401

__all__ = ["ORACLES", "QUERIES", "flagship"]
