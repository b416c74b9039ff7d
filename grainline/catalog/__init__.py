"""Operator queries registered for the driver (``__spark_entry__``)."""

from . import q_fit, q_flow, q_io, q_model, q_quality, q_rows  # noqa: F401  (registers on import)
from .registry import ORACLES, QUERIES  # noqa: F401
