"""All queries of the subpackage and their SQL."""

from tidemark.llm import (  # noqa: F401
    decontaminate,
    fingerprints,
    hard_negatives,
    line_dedup,
    mixing,
    near_dedup,
    ranked_search,
    secret_scan,
    sharding,
    substring_dedup,
    token_counts,
    toxicity,
    url_filter,
)
from tidemark.llm.common import CHECKS, QUERIES

__all__ = ["CHECKS", "QUERIES"]
