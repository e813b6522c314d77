"""Change-feed operators: read a range of batches, collapse to the net
change per key, apply net changes to a downstream snapshot, compact.

A change row = data columns + ``_change_type`` ('insert'/'delete') +
``batch_id``.  Within one batch a key has at most one delete (old row)
and one insert (new row); the insert is the later event.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deidlake.constants import BATCH_ID_COLUMN, CHANGE_TYPE_COLUMN, DELETE, INSERT
from deidlake.operators.keys import check_orderable, key_columns, key_names

SYSTEM_COLUMNS = (CHANGE_TYPE_COLUMN, BATCH_ID_COLUMN)


def data_columns(feed: DataFrame) -> list[str]:
    return [c for c in feed.columns if c not in SYSTEM_COLUMNS]


def select_changes(
    feed: DataFrame,
    after: int | None = None,
    upto: int | None = None,
    change_type: str | None = None,
    keep_system: bool = False,
) -> DataFrame:
    """Batches in ``(after, upto]`` of one change type.  On a feed
    partitioned by ``batch_id`` the range prunes partitions."""
    cond = F.lit(True)
    if after is not None:
        cond = cond & (F.col(BATCH_ID_COLUMN) > F.lit(after))
    if upto is not None:
        cond = cond & (F.col(BATCH_ID_COLUMN) <= F.lit(upto))
    if change_type is not None:
        if change_type not in (INSERT, DELETE):
            raise ValueError(f"unknown change type {change_type!r}")
        cond = cond & (F.col(CHANGE_TYPE_COLUMN) == F.lit(change_type))
    out = feed.where(cond)
    return out if keep_system else out.select(*data_columns(feed))


def net_changes(feed: DataFrame, keys) -> DataFrame:
    """The last change of every key: greatest ``batch_id``, an insert
    winning over a delete of the same batch.

    ``groupBy(keys).agg(max(struct(batch_id, is_insert, row...)))`` is a
    partial aggregate, so a key with very many changes is collapsed before
    the shuffle."""
    keys = list(keys)
    check_orderable(feed, keys)
    cols = data_columns(feed)
    rest = [c for c in cols if c not in keys]
    order = F.struct(
        F.col(BATCH_ID_COLUMN).alias("_b"),
        (F.col(CHANGE_TYPE_COLUMN) == F.lit(INSERT)).alias("_i"),
        *[F.col(c) for c in rest],
    )
    last = feed.groupBy(*keys).agg(F.max(order).alias("_m"))
    return last.select(
        *[F.col(c) for c in keys],
        *[F.col("_m." + c).alias(c) for c in rest],
        F.when(F.col("_m._i"), F.lit(INSERT)).otherwise(F.lit(DELETE)).alias(CHANGE_TYPE_COLUMN),
        F.col("_m._b").alias(BATCH_ID_COLUMN),
    ).select(*cols, CHANGE_TYPE_COLUMN, BATCH_ID_COLUMN)


def apply_changes(target: DataFrame | None, net: DataFrame, keys) -> DataFrame:
    """The target with its rows of changed keys replaced by the net inserts:
    one full outer join on null-safe key columns, in which ``net`` and all
    that it is computed from appear once.  ``net`` and the target hold one row
    per key.  Idempotent, so a re-delivered batch is harmless.
    ``target=None`` (first load) keeps the inserts only."""
    keys = list(keys)
    cols = data_columns(net)
    is_insert = F.col(CHANGE_TYPE_COLUMN) == F.lit(INSERT)
    if target is None:
        return net.where(is_insert).select(*cols)
    cols = target.columns
    n = net.select(*key_columns(net, keys), is_insert.alias("_i"), F.struct(*cols).alias("_n"))
    t = target.select(*key_columns(target, keys), F.struct(*cols).alias("_t"))
    joined = t.join(n, key_names(keys), "full_outer")
    # a key without a net change keeps its row; a deleted one has no row left
    row = F.when(F.col("_i").isNull(), F.col("_t")).when(F.col("_i"), F.col("_n"))
    return joined.select(row.alias("_r")).where(F.col("_r").isNotNull()).select(*[F.col("_r." + c).alias(c) for c in cols])


def replace_by_key(target: DataFrame, net: DataFrame, keys) -> DataFrame:
    """The same result for net changes that are cheap to read twice, such as
    stored batches: an anti join, which AQE turns into a broadcast when the
    changes are few, so that a large target is scanned but not shuffled.

    The anti join uses ALL net-change keys; anti-joining the inserts alone
    would keep the stale row of an updated key."""
    changed = net.select(*keys)
    cond = reduce(lambda a, b: a & b, [target[k].eqNullSafe(changed[k]) for k in keys])
    inserts = net.where(F.col(CHANGE_TYPE_COLUMN) == F.lit(INSERT)).select(*target.columns)
    return target.join(changed, cond, "left_anti").unionByName(inserts)


def compact_changes(feed: DataFrame, keys, upto: int) -> DataFrame:
    """Rewrite all batches ``<= upto`` as their net change stamped
    ``batch_id = upto`` (what the consumption marker used to expire)."""
    net = net_changes(select_changes(feed, upto=upto, keep_system=True), keys)
    return net.withColumn(BATCH_ID_COLUMN, F.lit(upto).cast("long"))


def latest_batch(feed: DataFrame) -> DataFrame:
    """Latest committed batch, number of batches and change rows."""
    return feed.agg(
        F.max(BATCH_ID_COLUMN).alias("latest_batch_id"),
        F.countDistinct(BATCH_ID_COLUMN).alias("n_batches"),
        F.count(F.lit(1)).alias("n_change_rows"),
    )
