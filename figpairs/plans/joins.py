"""Join helpers with an explicit, checked broadcast decision."""

from __future__ import annotations

from pyspark.sql import DataFrame

# Only tables with a row per file or file split are joined this way; one is
# broadcast if it has at most this many rows, counted.
BROADCAST_MAX_ROWS = 1_000_000


def join_checked(big: DataFrame, small: DataFrame, on, how: str = "inner", max_rows: int = BROADCAST_MAX_ROWS) -> DataFrame:
    """Join ``big`` with a narrow table of one row per file or split.

    ``small`` is checkpointed and counted; beyond the limit the join is left to
    the planner, so the plan stays correct at any size.
    """
    from pyspark.sql import functions as F

    from figpairs.session import checkpoint_dir

    checkpoint_dir(small.sparkSession)
    small = small.checkpoint(eager=True)
    return big.join(F.broadcast(small) if small.count() <= max_rows else small, on, how)


def ensure_parallelism(df: DataFrame, min_partitions: int | None = None) -> DataFrame:
    """Round-robin the rows when the input has fewer partitions than the cluster
    has cores (e.g. a table stored as one large row group, which scans as one
    task).  On inputs that already have enough partitions — any large table — this
    is a no-op, so it never adds a shuffle at scale."""
    target = min_partitions or max(df.sparkSession.sparkContext.defaultParallelism, 1)
    return df.repartition(target) if df.rdd.getNumPartitions() < target else df
