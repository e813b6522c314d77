"""Snapshot merge by key or by row hash, producing the new snapshot and its
change rows from ONE full outer join (one shuffle of each side).

The joined, tagged frame has the data columns plus ``_side``:
``keep`` (row stays), ``insert`` (new or changed row), ``delete`` (removed
or replaced row).  New snapshot = keep + insert; change feed = insert +
delete.  A job writes the tagged frame once and derives both outputs, so
the join never runs twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from deidlake.constants import CHANGE_TYPE_COLUMN, DELETE, INSERT, ROW_HASH_COLUMN
from deidlake.functions.hashing import row_hash
from deidlake.operators.keys import check_orderable, key_columns, key_names
from deidlake.spec import UpdateMode

SIDE = "_side"
KEEP = "keep"


def dedupe_on_key(df: DataFrame, keys) -> DataFrame:
    """One row per key; the survivor is the smallest row in column order
    (NULLs first), so reruns agree.

    Implemented as ``groupBy(keys).agg(min(struct(rest)))``: a partial
    (map-side) aggregate, so a key holding a third of all rows is collapsed
    inside each input partition before the shuffle instead of being sorted
    in one task."""
    keys = list(keys)
    if not keys:
        raise ValueError("dedupe_on_key needs at least one key column")
    rest = [c for c in df.columns if c not in keys]
    if not rest:
        return df.dropDuplicates(keys)
    check_orderable(df, keys)
    survivor = F.min(F.struct(*[F.col(c) for c in rest])).alias("_s")
    return df.groupBy(*keys).agg(survivor).select(*keys, "_s.*").select(*df.columns)


def with_row_hash(df: DataFrame, mode: str = "compat") -> DataFrame:
    cols = [c for c in df.columns if c != ROW_HASH_COLUMN]
    return df.select(*cols, row_hash(cols, mode).alias(ROW_HASH_COLUMN))


def _check_same_columns(target: DataFrame, cols) -> None:
    missing = [c for c in cols if c not in target.columns]
    if missing:
        raise ValueError(f"target lacks source columns {missing}")
    dropped = [c for c in target.columns if c not in cols]
    if dropped:
        raise ValueError(f"source lacks target columns {dropped}")


def _one_per_key(source: DataFrame, keyed, names, observation: Observation | None) -> DataFrame:
    """The de-duplicated source, grouped by the SAME key columns the join
    uses: one shuffle of the source serves both (partial aggregation first)."""
    check_orderable(source, ())
    s = source.select(*keyed, F.struct(*source.columns).alias("_row")).groupBy(*names).agg(
        F.min("_row").alias("_s"), F.count(F.lit(1)).alias("_n")
    )
    if observation is not None:
        s = s.observe(observation, F.coalesce(F.sum("_n"), F.lit(0)).alias("row_count"))
    return s


def merge_tagged(
    target: DataFrame | None,
    source: DataFrame,
    keys,
    mode: UpdateMode = UpdateMode.APPEND_AND_REMOVE,
    null_safe: bool = True,
    hash_mode: str = "compat",
    observation: Observation | None = None,
) -> DataFrame:
    """Tag every row of the merge result (see module doc).

    ``observation`` receives ``row_count``, the number of source rows before
    de-duplication: summed from per-key counts right after the final
    aggregate, i.e. in the stage that also writes the result, where Spark
    applies each partition's update once even when tasks are retried.

    * APPEND_AND_REMOVE: source-only keys inserted, target-only keys deleted,
      matched keys keep the target row unchanged.
    * FULL_UPDATE: same, keyed on the row hash (a changed row is delete old
      + insert new).  ``keys`` is ignored.
    * DROP_AND_RECREATE: snapshot = source; changes are the real
      differences only (changed row -> delete + insert, equal -> nothing).
    * ``target=None``: first load, everything is an insert.
    """
    if mode == UpdateMode.NOT_IMPORT:
        raise ValueError("NOT_IMPORT tables are not merged")
    if mode == UpdateMode.FULL_UPDATE:
        source = with_row_hash(source, hash_mode)
        keys = [ROW_HASH_COLUMN]
    keys = list(keys)
    if not keys:
        raise ValueError("merge needs key columns")
    cols = source.columns
    if target is not None:
        _check_same_columns(target, cols)
    names = key_names(keys) if null_safe else [f"_k{i}" for i in range(len(keys))]

    def keyed(df):
        return key_columns(df, keys) if null_safe else [df[k].alias(f"_k{i}") for i, k in enumerate(keys)]

    s = _one_per_key(source, keyed(source), names, observation)
    if target is None:
        return s.select(*[F.col("_s." + c).alias(c) for c in cols]).withColumn(SIDE, F.lit(INSERT))
    s = s.drop("_n")
    t = target.select(*keyed(target), F.struct(*cols).alias("_t"))
    joined = t.join(s, names, "full_outer")

    def row(side, struct_col):
        return F.struct(F.lit(side).alias(SIDE), F.col(struct_col).alias("_r"))

    only_source = F.col("_t").isNull()
    only_target = F.col("_s").isNull()
    if mode == UpdateMode.DROP_AND_RECREATE:
        matched = F.when(F.col("_t").eqNullSafe(F.col("_s")), F.array(row(KEEP, "_t"))).otherwise(
            F.array(row(DELETE, "_t"), row(INSERT, "_s"))
        )
    else:
        matched = F.array(row(KEEP, "_t"))
    rows = (
        F.when(only_source, F.array(row(INSERT, "_s")))
        .when(only_target, F.array(row(DELETE, "_t")))
        .otherwise(matched)
    )
    return joined.select(F.inline(rows)).select(*[F.col("_r." + c).alias(c) for c in cols], SIDE)


def snapshot_of(tagged: DataFrame) -> DataFrame:
    return tagged.where(F.col(SIDE) != DELETE).drop(SIDE)


def changes_of(tagged: DataFrame) -> DataFrame:
    return tagged.where(F.col(SIDE) != KEEP).withColumnRenamed(SIDE, CHANGE_TYPE_COLUMN)


def merge_changes(target: DataFrame | None, source: DataFrame, keys, mode: UpdateMode,
                  observation: Observation | None = None) -> DataFrame:
    """Only the insert and delete rows of the merge, tagged like
    :func:`merge_tagged`.

    Where matched keys keep their row (APPEND_AND_REMOVE, FULL_UPDATE) the
    target's key columns decide, so only those are read and shuffled; the
    delete rows then hold the key, and nulls elsewhere.  DROP_AND_RECREATE
    compares whole rows and deletes whole rows."""
    if target is None or mode not in (UpdateMode.APPEND_AND_REMOVE, UpdateMode.FULL_UPDATE):
        return merge_tagged(target, source, keys, mode, observation=observation).where(F.col(SIDE) != KEEP)
    if mode == UpdateMode.FULL_UPDATE:
        source, keys = with_row_hash(source), [ROW_HASH_COLUMN]
    keys = list(keys)
    if not keys:
        raise ValueError("merge needs key columns")
    cols = source.columns
    _check_same_columns(target, cols)
    names = key_names(keys)
    s = _one_per_key(source, key_columns(source, keys), names, observation).drop("_n")
    t = target.select(*key_columns(target, keys), F.struct(*keys).alias("_t"))
    changed = t.join(s, names, "full_outer").where(F.col("_t").isNull() | F.col("_s").isNull())
    is_new = F.col("_t").isNull()
    return changed.select(
        *[F.when(is_new, F.col("_s." + c)).otherwise(F.col("_t." + c) if c in keys else F.lit(None)).alias(c) for c in cols],
        F.when(is_new, F.lit(INSERT)).otherwise(F.lit(DELETE)).alias(SIDE))
