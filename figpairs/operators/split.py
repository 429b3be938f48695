"""Split and shard assignment.

Both are plain column expressions: no shuffle, no order dependence beyond
the ``line_no`` carried from the scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from figpairs.functions.text import SHARD_NAME_FORMAT, SHARD_SIZE, SPLIT_CUTS, SPLIT_NAMES, md5_bucket


def split_bucket(key="pmcid") -> "F.Column":
    return md5_bucket(key, 100)


def assign_split(df: DataFrame, key: str = "pmcid", cuts=SPLIT_CUTS, names=SPLIT_NAMES, keep_bucket: bool = False) -> DataFrame:
    """F16: article-level split by the md5 bucket of ``key``.

    bucket < cuts[0] → names[0]; bucket < cuts[1] → names[1]; else names[2].
    Deterministic per key, so no article straddles two splits.
    """
    b = split_bucket(key)
    out = df.withColumn("bucket", b) if keep_bucket else df
    bcol = F.col("bucket") if keep_bucket else b
    return out.withColumn("split", F.when(bcol < cuts[0], names[0]).when(bcol < cuts[1], names[1]).otherwise(names[2]))


def assign_shard(df: DataFrame, shard_size: int = SHARD_SIZE, line_col: str = "line_no", prefix: str | None = None) -> DataFrame:
    """Contiguous shards of ``shard_size`` data lines, numbered from 0.

    Every data line counts (blank and malformed ones too); sizes below 1 give
    one line per shard.  ``prefix`` adds ``shard_name = prefix_shard-00000``.
    """
    n = max(int(shard_size), 1)
    out = df.withColumn("shard_idx", F.expr(f"(`{line_col}` - 1) div {n}").cast("int"))
    if prefix is not None:
        out = out.withColumn("shard_name", F.format_string(SHARD_NAME_FORMAT, F.lit(prefix), F.col("shard_idx")))
    return out


def split_partition_check(df: DataFrame, key_cols=("line_no",)) -> DataFrame:
    """Rows lost or duplicated by the split, as (check, n) rows.

    Splitting must be a partition of the input: the union of the three splits
    equals the input as a multiset.  Both differences are computed with
    ``exceptAll`` and counted; a correct split gives two zero rows.
    """
    base = df.select(*key_cols)
    parts = None
    for name in SPLIT_NAMES:
        p = df.filter(F.col("split") == name).select(*key_cols)
        parts = p if parts is None else parts.unionByName(p)
    missing = base.exceptAll(parts).select(F.lit("missing").alias("check"))
    extra = parts.exceptAll(base).select(F.lit("extra").alias("check"))
    counts = missing.unionByName(extra).groupBy("check").agg(F.count(F.lit(1)).alias("n"))
    zero = df.sparkSession.createDataFrame([("missing",), ("extra",)], "check string")
    return zero.join(counts, "check", "left").select("check", F.coalesce("n", F.lit(0)).cast("bigint").alias("n"))
