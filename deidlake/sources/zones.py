"""Zone tables as plain Parquet directories: bronze, silver, gold, internal,
monitoring under one root.

``<root>/<zone>/<schema.table>/changes/batch_id=N/``
    the change rows of batch N, with ``_change_type`` insert or delete: a
    batch writes in proportion to the change, not to the table;
``<root>/<zone>/<schema.table>/base/batch_id=N/_key_bucket=K/``
    the rows of key bucket K as of batch N (:meth:`ZoneTable.compact`), only
    for buckets with changes since the compaction before.
``<root>/<zone>/<schema.table>/layout/batch_id=N/``
    one row for each bucket of the snapshot as of batch N: the batch whose
    base directory holds it.  The base counts when this is published.
``<root>/<zone>/<schema.table>/consumers/consumer=NAME/batch_id=N/``
    one row: the registered consumer NAME has consumed batch N (0: none yet).
    No batch beyond the smallest of these marks ever expires.
``<root>/<zone>/<schema.table>/markers/batch_id=N/``
    one row: batch N is published (:meth:`ZoneTable.announce`), for consumers
    that read the table as a stream.

A directory counts when Spark's own ``_SUCCESS`` file is in it.  Nothing that
is published is ever rewritten or renamed: compaction writes a directory of
its own, and expiry takes ``_SUCCESS`` away before the data.  The schema is
that of the files; the key columns and the batch before stand in the metadata
of ``_change_type``, so a consumer sees whether batches after its mark are gone.

Snapshot as of N = latest base at or before N (or the inserts of the first
load) with the net change per key of the later batches applied.  One writer
per table, whose batch ids grow.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from deidlake.constants import BATCH_ID_COLUMN, CHANGE_TYPE_COLUMN, DELETE, INSERT

SIDE = "_side"
KEY_BUCKET = "_key_bucket"
ZONES = ("bronze", "silver", "gold", "internal", "monitoring")


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    return hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hpath


def zone_path(root: str, zone: str, table: str) -> str:
    """``<root>/<zone>/<schema.table>``; the schema stays in the name so
    ``a.t`` and ``b.t`` never collide."""
    if zone not in ZONES:
        raise ValueError(f"unknown zone {zone!r}")
    return f"{root.rstrip('/')}/{zone}/{table}"


def _publish(df: DataFrame, path: str) -> None:
    """Write ``df`` as the directory ``path``, leftovers of a failed attempt
    replaced; ``_SUCCESS`` appears last."""
    df.write.mode("overwrite").option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "true").parquet(path)


class HistoryExpired(RuntimeError):
    """Batches that a consumer hasn't seen have expired, and what it holds
    isn't known, so the keys deleted in them can't be told."""


class Unconsumed(NamedTuple):
    """What a consumer has to apply: the change rows up to batch ``newest``.
    With ``reset`` they are the whole snapshot as inserts, and every other key
    that the consumer holds is gone."""

    newest: int
    feed: DataFrame
    reset: bool


@dataclass(frozen=True)
class ZoneTable:
    """``buckets``: key buckets of the compacted table; about its size in
    units that one compaction may rewrite for a single changed row."""

    root: str
    zone: str
    name: str
    buckets: int = 64

    @property
    def path(self) -> str:
        return zone_path(self.root, self.zone, self.name)

    def _dir(self, kind: str, batch: int | str) -> str:
        return f"{self.path}/{kind}/{BATCH_ID_COLUMN}={batch}"

    # ---- what is published ---------------------------------------------------
    def _batches(self, spark: SparkSession, kind: str, marker: str = "/_SUCCESS") -> list[int]:
        fs, pattern = _fs(spark, self._dir(kind, "*") + marker)
        found = [st.getPath().getParent() if marker else st.getPath() for st in fs.globStatus(pattern) or []]
        return sorted(int(p.getName().split("=")[1]) for p in found)

    def committed(self, spark: SparkSession) -> list[int]:
        return self._batches(spark, "changes")

    def bases(self, spark: SparkSession) -> list[int]:
        return self._batches(spark, "layout")

    # ---- key buckets of a base -----------------------------------------------
    def _bucket(self, keys) -> Column:
        return F.pmod(F.xxhash64(*[F.col(k) for k in keys]), F.lit(self.buckets)).cast("int").alias(KEY_BUCKET)

    def _form(self, schema: T.StructType, keys) -> str:
        """What decides the bucket of a row; rows move if it changes."""
        return f"{self.buckets}:" + ",".join(f"{k} {schema[k].dataType.simpleString()}" for k in keys)

    def _layout(self, spark: SparkSession, base: int, form: str | None = None) -> dict[int, int] | None:
        """Bucket -> batch whose directory holds it, at most ``buckets``
        entries; None if the base was dealt in another form than ``form``."""
        rows = spark.read.parquet(self._dir("layout", base)).collect()
        return None if form is not None and any(r["form"] != form for r in rows) else {r["bucket"]: r["holder"] for r in rows}

    def _read_base(self, spark: SparkSession, base: int, schema: T.StructType, only: set[int] | None = None) -> DataFrame:
        paths = [f"{self._dir('base', holder)}/{KEY_BUCKET}={k}"
                 for k, holder in self._layout(spark, base).items() if only is None or k in only]
        return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)

    def latest(self, spark: SparkSession) -> int | None:
        c = self.committed(spark)
        return c[-1] if c else None

    def next_batch(self, spark: SparkSession) -> int:
        """Id for the next write: an abandoned attempt is retried under the
        same id, so its leftovers are replaced rather than orphaned."""
        latest = self.latest(spark)
        return 1 if latest is None else latest + 1

    def _stored(self, spark: SparkSession, batch: int) -> T.StructType:
        return spark.read.parquet(self._dir("changes", batch)).schema

    def schema(self, spark: SparkSession, batch: int) -> T.StructType:
        return T.StructType([f for f in self._stored(spark, batch).fields if f.name != CHANGE_TYPE_COLUMN])

    def keys(self, spark: SparkSession, batch: int) -> list[str]:
        return list(self._stored(spark, batch)[CHANGE_TYPE_COLUMN].metadata["keys"])

    def _is_first_load(self, spark: SparkSession, batch: int) -> bool:
        return bool(self._stored(spark, batch)[CHANGE_TYPE_COLUMN].metadata["first_load"])

    def _follows(self, spark: SparkSession, batch: int, mark: int) -> bool:
        """Is ``mark`` the batch before ``batch``, or a later one?"""
        before = self._stored(spark, batch)[CHANGE_TYPE_COLUMN].metadata.get("previous")
        return before is not None and before <= mark

    # ---- reads -------------------------------------------------------------
    def _read(self, spark: SparkSession, batches: list[int]) -> DataFrame:
        """Change rows of exactly these batches, in the schema of the last."""
        full = T.StructType([*self.schema(spark, batches[-1]).fields,
                             T.StructField(CHANGE_TYPE_COLUMN, T.StringType()),
                             T.StructField(BATCH_ID_COLUMN, T.LongType())])
        paths = [self._dir("changes", b) for b in batches]
        return spark.read.schema(full).option("basePath", f"{self.path}/changes").parquet(*paths)

    def read_snapshot(self, spark: SparkSession, batch: int | None = None) -> DataFrame | None:
        """Snapshot as of ``batch`` (default: latest); None if never committed."""
        return self._snapshot(spark, batch)

    def _snapshot(self, spark: SparkSession, batch: int | None, only: set[int] | None = None) -> DataFrame | None:
        """The snapshot; with ``only``, of these buckets of the base and all
        later changes."""
        from deidlake.operators.changes import net_changes, replace_by_key

        committed = [b for b in self.committed(spark) if batch is None or b <= batch]
        if not committed:
            return None
        schema = self.schema(spark, committed[-1])
        bases = [b for b in self.bases(spark) if b <= committed[-1]]
        if bases:
            start = bases[-1]
            base = self._read_base(spark, start, schema, only)
        elif self._is_first_load(spark, committed[0]):
            # a first load holds one insert per key: those rows are the snapshot
            start = committed[0]
            full = T.StructType([*schema.fields, T.StructField(CHANGE_TYPE_COLUMN, T.StringType())])
            first = spark.read.schema(full).parquet(self._dir("changes", start))
            base = first.where(F.col(CHANGE_TYPE_COLUMN) == INSERT).drop(CHANGE_TYPE_COLUMN)
        else:
            raise ValueError(f"the history of {self.name} up to batch {committed[-1]} has expired")
        tail = [b for b in committed if b > start]
        if not tail:
            return base
        keys = self.keys(spark, committed[-1])
        return replace_by_key(base, net_changes(self._read(spark, tail), keys), keys)

    def read_changes(self, spark: SparkSession, after: int | None = None, upto: int | None = None) -> DataFrame | None:
        """Change rows (data + ``_change_type`` + ``batch_id``) of committed
        batches in ``(after, upto]``."""
        committed = [b for b in self.committed(spark)
                     if (after is None or b > after) and (upto is None or b <= upto)]
        return self._read(spark, committed) if committed else None

    def unconsumed(self, spark: SparkSession, mark: int | None, upto: int | None = None) -> Unconsumed | None:
        """What is new to a consumer that has consumed ``mark`` (None: nothing
        yet), up to batch ``upto`` if given, or None.  The ids are listed first
        and exactly these are read, so
        a batch that appears meanwhile waits for the next call.  If batches
        after the mark have expired, the snapshot comes instead (``reset``),
        never a part of the changes."""
        ids = [b for b in self.committed(spark) if (mark is None or b > mark) and (upto is None or b <= upto)]
        if not ids:
            return None
        whole = self._is_first_load(spark, ids[0]) if mark is None else self._follows(spark, ids[0], mark)
        if whole:
            return Unconsumed(ids[-1], self._read(spark, ids), False)
        snap = self.read_snapshot(spark, ids[-1])
        return Unconsumed(ids[-1], snap.select("*", F.lit(INSERT).alias(CHANGE_TYPE_COLUMN),
                                               F.lit(ids[-1]).cast("long").alias(BATCH_ID_COLUMN)), True)

    # ---- consumers ---------------------------------------------------------
    def _marks_of(self, spark: SparkSession, consumer: str, marker: str = "/_SUCCESS") -> list[int]:
        if not re.fullmatch(r"[A-Za-z0-9_.-]+", consumer):
            raise ValueError(f"consumer {consumer!r}: letters, digits, '_', '.' and '-' only")
        return self._batches(spark, f"consumers/consumer={consumer}", marker)

    def mark(self, spark: SparkSession, consumer: str) -> int | None:
        """The newest batch that ``consumer`` has consumed; None if it isn't
        registered or has consumed nothing."""
        marks = self._marks_of(spark, consumer)
        return (marks[-1] or None) if marks else None

    def register_consumer(self, spark: SparkSession, consumer: str) -> None:
        """Keep every batch from now on until ``consumer`` has consumed it."""
        if not self._marks_of(spark, consumer):
            self.mark_consumed(spark, consumer, 0)

    def mark_consumed(self, spark: SparkSession, consumer: str, batch: int) -> None:
        """Note that ``consumer`` has consumed ``batch``.  The new mark is
        published before older ones go; a crash between leaves both, and the
        newest counts."""
        kind = f"consumers/consumer={consumer}"
        older = [b for b in self._marks_of(spark, consumer, marker="") if b < batch]
        _publish(spark.range(1).select(F.current_timestamp().alias("noted")).coalesce(1), self._dir(kind, batch))
        for b in older:
            fs, path = _fs(spark, self._dir(kind, b))
            fs.delete(path, True)

    def unregister_consumer(self, spark: SparkSession, consumer: str) -> None:
        self._marks_of(spark, consumer)
        fs, path = _fs(spark, f"{self.path}/consumers/consumer={consumer}")
        fs.delete(path, True)

    def consumers(self, spark: SparkSession) -> dict[str, int]:
        """Newest consumed batch of every registered consumer (0: none yet)."""
        fs, pattern = _fs(spark, f"{self.path}/consumers/consumer=*")
        names = [st.getPath().getName().split("=", 1)[1] for st in fs.globStatus(pattern) or []]
        marks = {name: self._marks_of(spark, name) for name in names}
        return {name: m[-1] for name, m in marks.items() if m}

    # ---- writes ------------------------------------------------------------
    def write_batch(self, spark: SparkSession, changes: DataFrame, batch: int, keys) -> None:
        """Write the change rows (``_side`` insert/delete; other sides are
        dropped) as batch ``batch`` and publish it."""
        latest = self.latest(spark)
        if latest is not None and batch <= latest:
            raise ValueError(f"batch {batch} of {self.name} is already committed or older than batch {latest}")
        missing = [k for k in keys if k not in changes.columns]
        if missing:
            raise ValueError(f"key columns {missing} missing from {self.name}")
        about = {"keys": list(keys), "first_load": latest is None, "previous": 0 if latest is None else latest}
        data = [c for c in changes.columns if c != SIDE]
        out = changes.where(F.col(SIDE).isin(INSERT, DELETE)).select(
            *data, F.col(SIDE).alias(CHANGE_TYPE_COLUMN, metadata=about))
        _publish(out, self._dir("changes", batch))

    def announce(self, spark: SparkSession) -> list[int]:
        """Publish a marker for every published batch that has none, and remove
        those of expired batches.  A crash between writing a batch and announcing
        it is mended by the next call; a marker written twice does no harm.
        Returns the batches announced."""
        committed, marked = self.committed(spark), self._batches(spark, "markers")
        new = sorted(set(committed) - set(marked))
        for b in new:
            # one file, moved into place as a whole
            _publish(spark.range(1).select(F.lit(b).cast("long").alias("batch")).coalesce(1), self._dir("markers", b))
        for b in set(marked) - set(committed):
            fs, path = _fs(spark, self._dir("markers", b))
            fs.delete(path, True)
        return new

    def compact(self, spark: SparkSession, batch: int | None = None) -> int | None:
        """Write the snapshot as of ``batch`` (default: latest) as that
        batch's base; later reads start there.  Only key buckets with changes
        since the base before are read and written, the others stay where they
        are.  Returns the batch id."""
        batch = self.latest(spark) if batch is None else batch
        if batch is None or batch in self.bases(spark):
            return batch
        committed = [b for b in self.committed(spark) if b <= batch]
        bases = [b for b in self.bases(spark) if b < batch]
        keys = self.keys(spark, committed[-1])
        form = self._form(self.schema(spark, committed[-1]), keys)
        before = self._layout(spark, bases[-1], form) if bases else None
        touched = None
        if before is not None:
            tail = [b for b in committed if b > bases[-1]]
            # at most ``buckets`` numbers
            touched = {r[0] for r in self._read(spark, tail).select(self._bucket(keys)).distinct().collect()} if tail else set()
        path = self._dir("base", batch)
        rows = self._snapshot(spark, batch, touched).withColumn(KEY_BUCKET, self._bucket(keys))
        # large buckets are split over tasks, small ones share a task
        rows.hint("rebalance", KEY_BUCKET).write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(
            KEY_BUCKET).parquet(path)
        # a bucket whose rows are all gone has no directory
        fs, pattern = _fs(spark, f"{path}/{KEY_BUCKET}=*")
        written = {int(st.getPath().getName().split("=")[1]): batch for st in fs.globStatus(pattern) or []}
        kept = {k: holder for k, holder in (before or {}).items() if k not in touched}
        _publish(spark.createDataFrame([(k, h, form) for k, h in {**kept, **written}.items()],
                                       "bucket int, holder long, form string").coalesce(1), self._dir("layout", batch))
        return batch

    def expire(self, spark: SparkSession, before: int) -> list[int]:
        """Remove batches ``< before`` that the snapshot no longer needs
        (older than the latest base) and that every registered consumer has
        consumed.  Returns the removed batch ids.  What an interrupted expiry
        left behind goes with the next one."""
        bases = self.bases(spark)
        if not bases:
            return []
        limit = min([before, bases[-1], *[m + 1 for m in self.consumers(spark).values()]])
        removed = [b for b in self.committed(spark) if b < limit]
        # buckets of older bases stay while a later base still uses them
        needed = {(holder, k) for base in bases if base >= limit for k, holder in self._layout(spark, base).items()}
        for kind in ("changes", "layout", "base"):
            for b in self._batches(spark, kind, marker=""):
                if b < limit:
                    fs, marker = _fs(spark, self._dir(kind, b) + "/_SUCCESS")
                    fs.delete(marker, False)
                    if kind != "base" or all(holder != b for holder, _ in needed):
                        fs.delete(_fs(spark, self._dir(kind, b))[1], True)
                        continue
                    for st in fs.globStatus(_fs(spark, f"{self._dir(kind, b)}/{KEY_BUCKET}=*")[1]) or []:
                        if (b, int(st.getPath().getName().split("=")[1])) not in needed:
                            fs.delete(st.getPath(), True)
        return removed

    def drop(self, spark: SparkSession) -> None:
        fs, p = _fs(spark, self.path)
        fs.delete(p, True)


def register_table(spark: SparkSession, table: ZoneTable, qualified_name: str) -> DataFrame:
    """Register the current snapshot in the catalog as an external table over
    a directory of its own (``table/batch_id=N``), which is written if there is
    none yet.  A table registered before is moved there, and the directories
    of older snapshots go."""
    batch = table.latest(spark)
    if batch is None:
        raise ValueError(f"{table.name} has no committed batch")
    directory = table._dir("table", batch)
    if batch not in table._batches(spark, "table"):
        _publish(table.read_snapshot(spark), directory)
    location = directory.replace("'", "\\'")
    name = ".".join(f"`{part}`" for part in qualified_name.split("."))
    if "." in qualified_name:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name.rsplit('.', 1)[0]}")
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} USING parquet LOCATION '{location}'")
    spark.sql(f"ALTER TABLE {name} SET LOCATION '{location}'")
    spark.catalog.refreshTable(name)
    for old in table._batches(spark, "table", marker=""):
        if old < batch:
            fs, path = _fs(spark, table._dir("table", old))
            fs.delete(path, True)
    return spark.table(name)
