"""Parallelism guard for CPU-heavy per-row work (regex over long texts).

A single large Parquet row group yields one scan task; text work on it
would run on one core.  Hash-repartition whole rows only when the input has
fewer partitions than the cluster has cores: on big inputs the scan is
already wide and no shuffle is added.  Hashing the whole row (not a key
that may be hot) spreads a key holding a third of the rows, as long as the
rows differ; exact copies of one row stay together.  A hash (not round-robin)
repartition is deterministic, so a lost executor recomputes the same rows.

Inputs that already went through a shuffle have
``spark.sql.shuffle.partitions`` partitions and are left alone; asking an
adaptive plan for its partition count would run its shuffle stages early.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def _has_exchange(df: DataFrame) -> bool:
    try:
        plan = df._jdf.queryExecution().executedPlan().toString()
    except Exception:  # noqa: BLE001 - e.g. Spark Connect: no JVM plan access
        return True
    return "Exchange" in plan or "AdaptiveSparkPlan" in plan


def spread(df: DataFrame, keys=None, min_partitions: int | None = None) -> DataFrame:
    """``keys`` is accepted for call-site readability; rows are hashed on
    all their columns."""
    spark = df.sparkSession
    target = min_partitions or max(spark.sparkContext.defaultParallelism * 2, 1)
    if _has_exchange(df) or df.rdd.getNumPartitions() >= target:
        return df
    return df.repartition(target, *df.columns)
