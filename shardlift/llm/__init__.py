"""Operators for training-data pipelines, and their queries.

Nothing else in the library imports this package.
"""

from shardlift.llm import (  # noqa: F401
    q_audit,
    q_chat,
    q_collocations,
    q_encoding,
    q_mixing,
    q_multiindex,
    q_prefixes,
    q_pseudolikelihood,
    q_rules,
    q_simhash,
    q_styletree,
    q_toxicity,
    q_warc,
)
from shardlift.llm.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
