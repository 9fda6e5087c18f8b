"""The library's operators applied to the test tables, each beside its SQL counterpart."""

from workload import aggregates, expressions, flows, relational, sinks, sources, streams
from workload.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
