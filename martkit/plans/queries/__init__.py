"""Driver query catalogue (``__spark_entry__`` re-exports it).

Each query runs one operator family of the library over the whole test tables; the
matching oracle is an independent ANSI-SQL formulation of the same result for DuckDB.
Inputs that play the part of raw feeds or second-day snapshots are derived from the test
tables by simple row rules; the operators themselves never rely on how they were derived.
"""

from martkit.plans.queries import (  # noqa: F401  (registration side effects)
    q_cleanse, q_incremental, q_joins, q_loaders, q_partitioned, q_reshape_agg, q_streaming, q_warehouse,
)
from martkit.plans.queries.registry import ORACLES, QUERIES

__all__ = ["QUERIES", "ORACLES"]
