"""Imports every query module so that the registry is complete."""

from . import q_classify, q_evaluate, q_features, q_telemetry, q_grammar, q_sources, q_text, q_vectors  # noqa: F401
from .registry import ORACLES, QUERIES

__all__ = ["QUERIES", "ORACLES"]
