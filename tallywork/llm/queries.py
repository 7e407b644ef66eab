"""All registered queries of this package."""

from tallywork.llm import queries_models, queries_native, queries_shape, queries_text  # noqa: F401
from tallywork.llm.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
