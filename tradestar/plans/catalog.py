"""All registered queries: importing this module fills the registry."""

from tradestar.plans import (q_gold, q_lake, q_pipeline, q_quality, q_registry, q_silver,  # noqa: F401
                             q_sources, q_sql)
from tradestar.plans.registry import ORACLE, QUERIES  # noqa: F401
