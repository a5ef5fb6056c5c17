"""All registered queries; importing the modules fills the register."""

from __future__ import annotations

from brightloom.plans import (  # noqa: F401
    aggregation,
    column_operations,
    evaluation,
    functions_text,
    graphs,
    joins_sets,
    models,
    preparation,
    sources_sinks,
    streams,
)
from brightloom.plans.registry import CHECK_SQL, QUERIES  # noqa: F401
