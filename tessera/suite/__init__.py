"""The registered queries, one per operator, with the SQL each must agree with."""

from tessera.suite.registry import ORACLES, QUERIES  # noqa: F401
from tessera.suite import (  # noqa: F401
    q_sources,
    q_sinks,
    q_incremental,
    q_standardize,
    q_quality,
    q_history,
    q_gold,
    q_realtime,
    q_drift,
    q_profile,
    q_maintain,
    q_observe,
    q_measures,
    q_jobs,
)
