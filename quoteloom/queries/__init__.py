"""The named queries and, where SQL can say the same, their SQL."""

from quoteloom.queries import bars, companies, landing, lists, merging, pages, stores, universe, upkeep  # noqa: F401
from quoteloom.queries.registry import REGISTRY

__all__ = ["REGISTRY"]
