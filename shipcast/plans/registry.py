"""Import every query module so that the catalog is complete."""

from __future__ import annotations

from . import q_audit, q_features, q_model, q_reports, q_split, q_text  # noqa: F401
from .catalog import ORACLE, QUERIES


def all_queries():
    return dict(QUERIES)


def all_oracle_sql():
    return dict(ORACLE)
