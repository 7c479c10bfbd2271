"""All registered queries."""

from . import q_dump, q_events, q_search, q_sync, q_text  # noqa: F401
from .registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
