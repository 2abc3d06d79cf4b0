"""All registered queries (importing the modules fills the registry)."""

from __future__ import annotations

from . import q_arma, q_ingest, q_merge, q_models, q_quality, q_series, q_unitroot  # noqa: F401
from .registry import ORACLES, QUERIES

__all__ = ["QUERIES", "ORACLES"]
