"""Wearable-sensor and questionnaire analytics as Spark jobs."""

from slotfuse.session import build_session

__all__ = ["build_session"]
