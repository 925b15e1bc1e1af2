"""All queries of the language-model operators."""

from mirrorset.llm import queries  # noqa: F401
from mirrorset.llm.catalog import REGISTRY

__all__ = ["REGISTRY"]
