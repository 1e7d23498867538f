"""Registered queries: each runs an operator over the test tables, most with an SQL check."""

from tidemark.catalog import (  # noqa: F401
    agreement_queries,
    experiment_queries,
    grid_queries,
    label_queries,
    model_queries,
    report_queries,
    source_queries,
    stream_queries,
    window_queries,
)
from tidemark.catalog.registry import CHECKS, QUERIES

__all__ = ["CHECKS", "QUERIES"]
