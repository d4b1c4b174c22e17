"""Operators for building training data: near-duplicates, search, archives, tokens, shards, packing."""

from logframe.llm import queries  # noqa: F401
from logframe.llm.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
