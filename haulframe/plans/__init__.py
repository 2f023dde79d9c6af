"""Named queries. Importing this package fills the registry."""

from haulframe.plans import (  # noqa: F401
    aggregation,
    cleansing,
    composites,
    joining,
    landing,
    projecting,
    ranking,
    scalars,
    storing,
    tabling,
)
from haulframe.plans.registry import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
