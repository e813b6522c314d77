"""Incremental propagation for any consumer of a zone table.

A consumer is registered with the table it reads: one small Parquet row names
the newest batch it has consumed, and no batch beyond it expires.  A run lists
the published batches beyond the mark, reads exactly those, applies them with
the keyed replace of the batch jobs, and publishes the new mark.  Files that
appear meanwhile belong to a batch that is not published yet, and wait for the
next run.  A crash between applying and marking repeats the batches, which the
keyed replace allows.

A consumer that was not registered while batches expired gets the whole
snapshot plus a delete for every key it holds that is gone; without a way to
tell what it holds it gets an error, never a part of the changes.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from deidlake.constants import BATCH_ID_COLUMN, CHANGE_TYPE_COLUMN, DELETE
from deidlake.operators.keys import key_columns, key_names
from deidlake.sources.zones import HistoryExpired, Unconsumed, ZoneTable


def with_deletes(new: Unconsumed, held: DataFrame, keys) -> DataFrame:
    """The snapshot of a ``reset`` as change rows: its inserts, and a delete
    (the key, nulls elsewhere) for each key of ``held`` that it lacks."""
    keys = list(keys)
    gone = held.select(*key_columns(held, keys), *[F.col(k).alias(f"_held{i}") for i, k in enumerate(keys)])
    present = new.feed.select(*key_columns(new.feed, keys))
    gone = gone.join(present, key_names(keys), "left_anti").dropDuplicates(key_names(keys))
    place = {k: f"_held{i}" for i, k in enumerate(keys)}
    system = {CHANGE_TYPE_COLUMN: F.lit(DELETE), BATCH_ID_COLUMN: F.lit(new.newest).cast("long")}
    deletes = gone.select(*[
        system[f.name].alias(f.name) if f.name in system else (F.col(place[f.name]) if f.name in place else F.lit(None)).cast(f.dataType).alias(f.name)
        for f in new.feed.schema.fields])
    return new.feed.unionByName(deletes)


def _consume(spark: SparkSession, src: ZoneTable, consumer: str, apply: Callable[[DataFrame, int], None],
             held: Callable[[], DataFrame] | None, upto: int | None) -> int | None:
    """Apply the batches beyond the consumer's mark, up to ``upto``, and move
    the mark."""
    mark = src.mark(spark, consumer)
    new = src.unconsumed(spark, mark, upto)
    if new is None:
        return None
    feed = new.feed
    rows = held() if new.reset and held is not None else None
    if rows is not None:
        feed = with_deletes(new, rows, src.keys(spark, new.newest))
    elif new.reset and mark is not None:
        raise HistoryExpired(f"batches of {src.name} after {mark} have expired before {consumer} consumed them")
    apply(feed, new.newest)
    src.mark_consumed(spark, consumer, new.newest)
    return new.newest


def run_available_now(spark: SparkSession, src: ZoneTable, consumer: str, apply: Callable[[DataFrame, int], None],
                      held: Callable[[], DataFrame] | None = None) -> int | None:
    """Consume all committed changes of ``src`` that ``consumer`` hasn't
    consumed; ``apply(feed, newest_batch_id)`` writes the result.  ``held``
    returns rows with the key columns of what the consumer holds (None:
    nothing); it is asked only if batches have expired.  Returns the newest batch id, None if there
    was nothing new."""
    src.register_consumer(spark, consumer)
    return _consume(spark, src, consumer, apply, held, None)
