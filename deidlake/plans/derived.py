"""Inputs derived by Spark from the given test tables, with the same
derivation written as SQL for the oracle.

Two snapshots of the whole ``orders`` table play the source database at
two points in time (every row is read for both):

* ``orders_old`` -- as of 2001-01-01: the orders placed before that date;
* ``orders_new`` -- later: all orders, except fulfilled ones from before
  1996 (archived away), and open orders from before 1998 now fulfilled.

Together they hold inserts (new orders), deletes (archived), changed
(fulfilled) and unchanged rows.  The change feed of ``orders`` has three
batches: 0 = first load of old, 1 = old -> new, 2 = new -> old (a restore:
keys deleted in 1 come back in 2).  ``conversations`` gives the
composite-key case: the log trimmed at the head (turn 0 dropped) and
extended at the tail (turns after 3 added).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from deidlake.constants import BATCH_ID_COLUMN, CHANGE_TYPE_COLUMN
from deidlake.operators.merge import changes_of, merge_tagged
from deidlake.spec import ColumnRole, TableSpec, UpdateMode

ORDERS_COLUMNS = ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")

ORDERS_SPEC = TableSpec(
    name="dbo.orders",
    columns=ORDERS_COLUMNS,
    update_mode=UpdateMode.DROP_AND_RECREATE,
    roles={
        ColumnRole.CLIENT_ID: ("o_custkey",),
        ColumnRole.DATE: ("o_orderdate",),
        ColumnRole.OTHER_IDENTIFIABLE: ("o_orderpriority",),
    },
    keys=("o_orderkey",),
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _ts(text: str):
    # string -> TIMESTAMP_NTZ: no session time zone involved
    return F.lit(text).cast("timestamp_ntz")


SNAPSHOT_DATE = "2001-01-01 00:00:00"
ARCHIVED_BEFORE = "1996-01-01 00:00:00"
FULFILLED_BEFORE = "1998-01-01 00:00:00"


def orders_old(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.where(F.col("o_orderdate") < _ts(SNAPSHOT_DATE))


def orders_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    archived = (F.col("o_orderstatus") == "F") & (F.col("o_orderdate") < _ts(ARCHIVED_BEFORE))
    fulfilled = (F.col("o_orderstatus") == "O") & (F.col("o_orderdate") < _ts(FULFILLED_BEFORE))
    status = F.when(fulfilled, F.lit("F")).otherwise(F.col("o_orderstatus"))
    return o.where(~archived).select(*[status.alias(c) if c == "o_orderstatus" else F.col(c) for c in o.columns])


def _stamp(df: DataFrame, batch: int) -> DataFrame:
    return df.withColumn(BATCH_ID_COLUMN, F.lit(batch).cast("long"))


def orders_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change feed of orders: data columns + ``_change_type`` + ``batch_id``."""
    old, new = orders_old(spark, sf_dir), orders_new(spark, sf_dir)
    keys = ORDERS_SPEC.keys
    mode = UpdateMode.DROP_AND_RECREATE
    b0 = changes_of(merge_tagged(None, old, keys, mode))
    b1 = changes_of(merge_tagged(old, new, keys, mode))
    b2 = changes_of(merge_tagged(new, old, keys, mode))
    return _stamp(b0, 0).unionByName(_stamp(b1, 1)).unionByName(_stamp(b2, 2))


def conversations_old(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations")
    return c.where(F.col("turn") <= 3)


def conversations_new(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "conversations")
    return c.where(F.col("turn") >= 1)


# --- the same derivations as SQL (DuckDB views are named like the tables) ---

ORDERS_OLD_SQL = f"SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '{SNAPSHOT_DATE}'"
ORDERS_NEW_SQL = (
    "SELECT o_orderkey, o_custkey, "
    f"CASE WHEN o_orderstatus = 'O' AND o_orderdate < TIMESTAMP '{FULFILLED_BEFORE}' THEN 'F' "
    "ELSE o_orderstatus END AS o_orderstatus, "
    "o_totalprice, o_orderdate, o_orderpriority FROM orders "
    f"WHERE NOT (o_orderstatus = 'F' AND o_orderdate < TIMESTAMP '{ARCHIVED_BEFORE}')"
)
CONV_OLD_SQL = "SELECT * FROM conversations WHERE turn <= 3"
CONV_NEW_SQL = "SELECT * FROM conversations WHERE turn >= 1"

ORDERS_FEED_SQL = f"""
SELECT *, 'insert' AS {CHANGE_TYPE_COLUMN}, CAST(0 AS BIGINT) AS {BATCH_ID_COLUMN} FROM ({ORDERS_OLD_SQL})
UNION ALL SELECT *, 'insert', 1 FROM (({ORDERS_NEW_SQL}) EXCEPT ({ORDERS_OLD_SQL}))
UNION ALL SELECT *, 'delete', 1 FROM (({ORDERS_OLD_SQL}) EXCEPT ({ORDERS_NEW_SQL}))
UNION ALL SELECT *, 'insert', 2 FROM (({ORDERS_OLD_SQL}) EXCEPT ({ORDERS_NEW_SQL}))
UNION ALL SELECT *, 'delete', 2 FROM (({ORDERS_NEW_SQL}) EXCEPT ({ORDERS_OLD_SQL}))
"""


def with_ctes(body: str, **ctes: str) -> str:
    parts = ", ".join(f"{name} AS ({sql})" for name, sql in ctes.items())
    return f"WITH {parts} {body}" if parts else body
