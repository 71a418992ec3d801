"""Imports every query module so that the registry is complete."""

from tallyforge.plans import (  # noqa: F401
    clean_queries,
    contract_queries,
    drift_queries,
    feature_queries,
    prep_queries,
    profile_queries,
    quality_queries,
    source_queries,
    stream_queries,
    train_queries,
)
from tallyforge.plans.registry import ORACLES, QUERIES  # noqa: F401
