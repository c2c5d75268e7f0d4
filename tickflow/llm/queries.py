"""All queries of this subpackage, in one place."""

from tickflow.llm import queries_corpus, queries_free, queries_native  # noqa: F401 - register their queries
from tickflow.llm.registry import LLM_ORACLES, LLM_QUERIES

__all__ = ["LLM_ORACLES", "LLM_QUERIES"]
