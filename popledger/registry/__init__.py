"""Named queries over the test tables, each with the SQL it must agree with."""

from popledger.registry.base import ORACLES, QUERIES
from popledger.registry import delivery, marts, results, shapes  # noqa: F401  (registration)

__all__ = ["ORACLES", "QUERIES"]
