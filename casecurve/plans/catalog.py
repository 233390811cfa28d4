"""All named queries; importing the modules registers them."""

from casecurve.plans import queries_classify, queries_profile, queries_regions, queries_series  # noqa: F401
from casecurve.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
