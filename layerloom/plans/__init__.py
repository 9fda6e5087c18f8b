"""Whole flows, composed of the library's operators, sources and sinks."""

from layerloom.plans.layers import (
    CUSTOMERS,
    CleanRules,
    LayerFlow,
    MetricRules,
    bronze,
    dated,
    gold,
    run,
    silver,
)
from layerloom.plans.responses import (
    export_by_key,
    store_responses,
    stored_elements,
    stored_rejects,
)

__all__ = [
    "CUSTOMERS",
    "CleanRules",
    "LayerFlow",
    "MetricRules",
    "bronze",
    "dated",
    "export_by_key",
    "gold",
    "run",
    "silver",
    "store_responses",
    "stored_elements",
    "stored_rejects",
]
