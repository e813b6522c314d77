"""Flagship plan: one incremental bronze -> silver step, all lazy.

orders_old / orders_new -> full-update merge (row-hash key) -> change rows
-> net change per key -> de-identify inserts, delete layout for deletes ->
keyed apply onto the silver snapshot of orders_old."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dataclasses import replace

from deidlake.constants import BATCH_ID_COLUMN, CHANGE_TYPE_COLUMN, DELETE, INSERT, TEST_HASH_SALT
from deidlake.operators import changes as ch
from deidlake.operators.deidentify import deidentified_keys, deidentify, delete_layout
from deidlake.operators.merge import changes_of, merge_tagged, snapshot_of
from deidlake.plans import derived as d
from deidlake.spec import UpdateMode

FULL_UPDATE_ORDERS = replace(d.ORDERS_SPEC, update_mode=UpdateMode.FULL_UPDATE)


def silver_step(bronze_changes: DataFrame, silver: DataFrame | None, spec, salt: str) -> DataFrame:
    """Apply one range of bronze changes to the silver snapshot."""
    keys = spec.merge_keys
    net = ch.net_changes(bronze_changes, keys)
    data = ch.data_columns(net)
    inserts = deidentify(net.where(F.col(CHANGE_TYPE_COLUMN) == INSERT).select(*data), spec, salt)
    deletes = delete_layout(net.where(F.col(CHANGE_TYPE_COLUMN) == DELETE).select(*data), spec, salt)
    silver_keys = list(deidentified_keys(spec))
    net_silver = inserts.withColumn(CHANGE_TYPE_COLUMN, F.lit(INSERT)).unionByName(
        deletes.select(*silver_keys).withColumn(CHANGE_TYPE_COLUMN, F.lit(DELETE)), allowMissingColumns=True
    )
    return ch.apply_changes(silver, net_silver, silver_keys)


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    spec = FULL_UPDATE_ORDERS
    bronze_old = snapshot_of(merge_tagged(None, d.orders_old(spark, sf_dir), [], UpdateMode.FULL_UPDATE))
    changes = changes_of(merge_tagged(bronze_old, d.orders_new(spark, sf_dir), [], UpdateMode.FULL_UPDATE))
    changes = changes.withColumn(BATCH_ID_COLUMN, F.lit(1).cast("long"))
    silver_old = deidentify(bronze_old, spec, TEST_HASH_SALT)
    return silver_step(changes, silver_old, spec, TEST_HASH_SALT)
