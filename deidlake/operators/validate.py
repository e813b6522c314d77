"""Schema validation as set logic over (table, column) relations.

``live`` and ``declared`` are DataFrames with (table_name, column_name);
drift rows are (kind, table_name, column_name).  Only the final report
(bounded by the size of the catalog, not of the data) reaches the driver.
"""

from __future__ import annotations

import json
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from deidlake.constants import (
    REPORT_ANALYSED_TABLES,
    REPORT_MISSING_COLUMNS,
    REPORT_MISSING_TABLES,
    REPORT_UNCLASSIFIED_COLUMNS,
    REPORT_UNCLASSIFIED_TABLES,
)

# drift kinds (rows of the drift frame)
UNCLASSIFIED_TABLE = "unclassified_table"
MISSING_TABLE = "classified_but_unexisting_table"
UNCLASSIFIED_COLUMN = "unclassified_column"
MISSING_COLUMN = "classified_but_unexisting_column"
_REPORT_KEY = {
    UNCLASSIFIED_TABLE: REPORT_UNCLASSIFIED_TABLES,
    MISSING_TABLE: REPORT_MISSING_TABLES,
    UNCLASSIFIED_COLUMN: REPORT_UNCLASSIFIED_COLUMNS,
    MISSING_COLUMN: REPORT_MISSING_COLUMNS,
}


class SchemaValidationError(LookupError):
    def __init__(self, report: dict):
        self.report = report
        super().__init__("Schema validation failed: " + json.dumps(report, sort_keys=True))


def live_columns(tables: dict[str, DataFrame], schema: str = "dbo") -> DataFrame:
    """Live catalog of a set of tables: one row per column, with the table's
    row count.  Names come from the tables' schemas, also of empty tables and
    of columns without a value; the count reads no column."""
    parts = []
    for name, df in tables.items():
        names = F.array(*[F.lit(c) for c in df.columns])
        parts.append(df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(schema).alias("table_schema"), F.lit(name).alias("table_name"),
            F.explode(names).alias("column_name"), "row_count"))
    return reduce(DataFrame.unionByName, parts)


def table_drift(live: DataFrame, declared: DataFrame) -> DataFrame:
    """Tables on one side only: one full outer join of the distinct table
    names (each side is read once)."""
    lt = live.select("table_name").distinct().withColumn("_l", F.lit(True))
    dt = declared.select("table_name").distinct().withColumn("_d", F.lit(True))
    both = lt.join(dt, "table_name", "full_outer").where(F.col("_l").isNull() | F.col("_d").isNull())
    return both.select(
        F.when(F.col("_d").isNull(), F.lit(UNCLASSIFIED_TABLE)).otherwise(F.lit(MISSING_TABLE)).alias("kind"),
        "table_name",
        F.lit(None).cast("string").alias("column_name"),
    )


def column_drift(live: DataFrame, declared: DataFrame) -> DataFrame:
    """Column differences, only for tables present on both sides: one full
    outer join on (table, column); per-table presence flags come from a
    window over the catalog rows of that table (catalog-sized, not data)."""
    l = live.select("table_name", "column_name").distinct().withColumn("_l", F.lit(True))
    d = declared.select("table_name", "column_name").distinct().withColumn("_d", F.lit(True))
    per_table = Window.partitionBy("table_name")
    both = l.join(d, ["table_name", "column_name"], "full_outer").select(
        "table_name", "column_name", "_l", "_d",
        F.max(F.col("_l").isNotNull()).over(per_table).alias("_tl"),
        F.max(F.col("_d").isNotNull()).over(per_table).alias("_td"),
    )
    return both.where(F.col("_tl") & F.col("_td") & (F.col("_l").isNull() | F.col("_d").isNull())).select(
        F.when(F.col("_d").isNull(), F.lit(UNCLASSIFIED_COLUMN)).otherwise(F.lit(MISSING_COLUMN)).alias("kind"),
        "table_name",
        "column_name",
    )


def schema_drift(live: DataFrame, declared: DataFrame) -> DataFrame:
    return table_drift(live, declared).unionByName(column_drift(live, declared))


def drift_report(drift: DataFrame) -> dict:
    """The structured report (sorted lists) of a drift frame."""
    grouped = drift.groupBy("kind", "table_name").agg(
        F.sort_array(F.collect_set("column_name")).alias("columns")
    ).collect()
    report = {REPORT_UNCLASSIFIED_TABLES: [], REPORT_MISSING_TABLES: [], REPORT_ANALYSED_TABLES: {}}
    for r in grouped:
        key = _REPORT_KEY[r["kind"]]
        if r["kind"] in (UNCLASSIFIED_TABLE, MISSING_TABLE):
            report[key].append(r["table_name"])
        else:
            t = report[REPORT_ANALYSED_TABLES].setdefault(
                r["table_name"], {REPORT_UNCLASSIFIED_COLUMNS: [], REPORT_MISSING_COLUMNS: []}
            )
            t[key] = list(r["columns"])
    report[REPORT_UNCLASSIFIED_TABLES].sort()
    report[REPORT_MISSING_TABLES].sort()
    return report


def validate(live: DataFrame, declared: DataFrame) -> None:
    """Raise :class:`SchemaValidationError` with the report on any drift."""
    report = drift_report(schema_drift(live, declared))
    if any(report[k] for k in (REPORT_UNCLASSIFIED_TABLES, REPORT_MISSING_TABLES, REPORT_ANALYSED_TABLES)):
        raise SchemaValidationError(report)
