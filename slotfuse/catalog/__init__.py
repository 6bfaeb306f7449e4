"""All registered queries over the test tables."""

from slotfuse.catalog import (  # noqa: F401  (importing registers)
    boosting_queries,
    file_queries,
    learning_queries,
    profile_queries,
    sensor_queries,
    survey_queries,
)
from slotfuse.catalog.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
