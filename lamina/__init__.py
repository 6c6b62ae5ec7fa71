"""lamina: feature layers as Spark tables.

A layer is a DataFrame plus a contract; queries, edits and attachment operations
are DataFrame jobs that Catalyst plans.
"""

from lamina.errors import (
    InvalidParameterError,
    LaminaError,
    LayerCapabilityError,
    MissingGeometryError,
    StaleLayerError,
)
from lamina.layer import Layer
from lamina.operators.attachments import AttachmentsQueryResult
from lamina.operators.query import QueryResult
from lamina.operators.results import EditResults
from lamina.plans.contract import FieldSet, LayerContract
from lamina.sources.store import LayerStore

__all__ = [
    "AttachmentsQueryResult",
    "EditResults",
    "FieldSet",
    "InvalidParameterError",
    "LaminaError",
    "Layer",
    "LayerCapabilityError",
    "LayerContract",
    "LayerStore",
    "MissingGeometryError",
    "QueryResult",
    "StaleLayerError",
]
