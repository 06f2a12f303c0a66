"""All registered queries; importing the modules fills the registry."""

from echoloom.registry import insights, models, rows, topics  # noqa: F401
from echoloom.registry.core import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
