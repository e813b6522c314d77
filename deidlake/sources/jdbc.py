"""JDBC source: table-or-query scans (optionally partitioned), projected
scans built from a classification, catalog listings.

Connection details are a plain options dict; nothing is read from
cluster-specific secret stores."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from deidlake.spec import TableSpec


@dataclass(frozen=True)
class JdbcSource:
    url: str
    user: str | None = None
    password: str | None = None
    driver: str | None = None
    authentication: str | None = None
    fetchsize: int = 10_000
    extra: dict = field(default_factory=dict)

    def options(self) -> dict[str, str]:
        opts = {"url": self.url, "fetchsize": str(self.fetchsize)}
        for k in ("user", "password", "driver", "authentication"):
            v = getattr(self, k)
            if v is not None:
                opts[k] = v
        opts.update({k: str(v) for k, v in self.extra.items()})
        return opts


def partition_options(column: str, lower: int, upper: int, num_partitions: int) -> dict[str, str]:
    """Parallel read: ``num_partitions`` range queries over ``column``
    (the original jobs read every table through one connection)."""
    if num_partitions < 1 or upper < lower:
        raise ValueError("invalid partition bounds")
    return {
        "partitionColumn": column,
        "lowerBound": str(lower),
        "upperBound": str(upper),
        "numPartitions": str(num_partitions),
    }


def read_jdbc(spark: SparkSession, source: JdbcSource, table_or_query: str, **partitioning) -> DataFrame:
    """``table_or_query`` is a table name or ``(SELECT ...) alias``."""
    reader = spark.read.format("jdbc").options(**source.options()).option("dbtable", table_or_query)
    if partitioning:
        reader = reader.options(**partition_options(**partitioning))
    return reader.load()


def quote_ident(name: str) -> str:
    return '"' + name.replace('"', '""') + '"'


def projected_query(spec: TableSpec) -> str:
    """``(SELECT "c1", "c2" FROM schema.table) tbl`` over the imported columns."""
    cols = ", ".join(quote_ident(c) for c in spec.imported_columns)
    return f"(SELECT {cols} FROM {spec.name}) tbl"


def read_projected(spark: SparkSession, source: JdbcSource, spec: TableSpec, **partitioning) -> DataFrame:
    return read_jdbc(spark, source, projected_query(spec), **partitioning)


def catalog_columns(catalog: DataFrame, schema: str | None = "dbo") -> DataFrame:
    """``information_schema.columns``-like rows -> (table_schema, table_name,
    column_name, full_name); temp tables (``#...``) skipped.  The filter is
    pushed to the database when ``catalog`` is a JDBC scan."""
    cols = {c.lower(): c for c in catalog.columns}
    out = catalog.select(
        F.col(cols["table_schema"]).alias("table_schema"),
        F.col(cols["table_name"]).alias("table_name"),
        F.col(cols["column_name"]).alias("column_name"),
    )
    if schema is not None:
        out = out.where(F.col("table_schema") == F.lit(schema))
    out = out.where(~F.col("table_name").startswith("#"))
    return out.withColumn("full_name", F.concat_ws(".", "table_schema", "table_name"))


def read_catalog(spark: SparkSession, source: JdbcSource, catalog_table: str = "information_schema.columns",
                 schema: str | None = "dbo") -> DataFrame:
    return catalog_columns(read_jdbc(spark, source, catalog_table), schema)


def list_tables(spark: SparkSession, source: JdbcSource, table_type: str | None = None,
                catalog_table: str = "INFORMATION_SCHEMA.TABLES") -> list[tuple[str, str]]:
    """(schema, table) pairs; one scan, one small collect (table names only)."""
    df = read_jdbc(spark, source, catalog_table)
    cols = {c.lower(): c for c in df.columns}
    if table_type is not None:
        df = df.where(F.col(cols["table_type"]) == F.lit(table_type))
    rows = df.select(cols["table_schema"], cols["table_name"]).collect()
    return [(r[0], r[1]) for r in rows]
