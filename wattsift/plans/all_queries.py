"""Every query module, imported for its registrations."""

from wattsift.plans import (  # noqa: F401
    cleaning_queries,
    fixed_model_queries,
    injection_queries,
    metric_queries,
    model_queries,
    registry_queries,
    sampling_queries,
    whole_queries,
)
from wattsift.plans.catalog import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
