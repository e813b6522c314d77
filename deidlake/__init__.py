"""Incremental de-identification on Spark.

Every operator is a lazy ``DataFrame -> DataFrame`` function built from
Spark SQL expressions; jobs in :mod:`deidlake.plans.jobs` compose them
into ingest -> pseudonymise -> extract -> clean runs over a Parquet
zone layout.
"""

from deidlake.spec import ColumnRole, TableSpec, UpdateMode

__all__ = ["ColumnRole", "TableSpec", "UpdateMode"]
