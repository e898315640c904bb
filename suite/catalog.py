"""All registered queries."""

from suite import (  # noqa: F401 - importing registers
    q_batches,
    q_extents,
    q_extract,
    q_identity,
    q_index,
    q_inventory,
    q_profile,
    q_store,
    q_variance,
)
from suite.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
