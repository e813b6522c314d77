"""Row-count monitoring rows (table, time, count)."""

from __future__ import annotations

import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from deidlake.constants import MONITOR_COMPAT_COLUMNS, MONITOR_TIME_FORMAT

MONITOR_SCHEMA = "table_name string, logged_at string, row_count long"
COMPAT_NAMES = dict(zip(("table_name", "logged_at", "row_count"), MONITOR_COMPAT_COLUMNS))


def now_minute() -> str:
    return datetime.datetime.now(datetime.timezone.utc).strftime(MONITOR_TIME_FORMAT)


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """(table_name, row_count), one global count per table."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(n).alias("table_name"), "row_count")
             for n, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def monitoring_rows(spark: SparkSession, counts: list[tuple[str, int]], logged_at: str | None = None,
                    compat_names: bool = False) -> DataFrame:
    """Rows for the monitoring log; explicit schema so an empty run still
    yields a typed (empty) frame.  ``compat_names`` uses the original,
    misassigned names (Row_Count = table name, Date_Time, Value = count)."""
    ts = logged_at or now_minute()
    df = spark.createDataFrame([(n, ts, int(c)) for n, c in counts], MONITOR_SCHEMA)
    if compat_names:
        df = df.select(*[F.col(k).alias(v) for k, v in COMPAT_NAMES.items()])
    return df


def append_monitoring(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)
