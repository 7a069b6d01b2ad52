"""Imports every report module, so that all queries are registered."""

from . import aggregates, joins, patterns, sql, storage, streams, udfs, windows  # noqa: F401
from .registry import ORACLES, QUERIES  # noqa: F401
