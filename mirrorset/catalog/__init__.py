"""Every operator as a query over the test tables, with its SQL counterpart."""

from mirrorset.catalog import generators, measures, relational, runs, sampling, scalars, scans  # noqa: F401
from mirrorset.catalog.registry import REGISTRY

__all__ = ["REGISTRY"]
