"""A zone table read by Structured Streaming.

The stream's source is the folder of batch markers (a row for each published
batch), so a trigger costs in proportion to the new batches, and the change rows
themselves are read by an ordinary batch scan, pruned and pushed down as usual.
``foreachBatch`` gets the announced ids, reads the change rows from the consumer's
mark up to the newest of them, applies them and moves the mark.

What is applied is decided by the mark and the published batches alone; a marker
only tells that it is time to look.  So these are safe:

* a crash between applying, marking and Spark's own commit: the trigger is
  repeated, and batches up to the mark are not read again (those applied but not
  marked are, which the keyed replace allows);
* markers that come late, twice or in another order, and a lost checkpoint;
* expiry: registered consumers bound it; one that was away while batches expired
  gets the snapshot and the deletes, or an error.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from deidlake.sources.zones import ZoneTable
from deidlake.streaming.incremental import _consume


def read_markers(spark: SparkSession, src: ZoneTable, batches_per_trigger: int | None = None) -> DataFrame:
    """Streaming frame of the announced batch ids (``batch``)."""
    reader = spark.readStream.schema("batch long").option("recursiveFileLookup", "true").option("ignoreMissingFiles", "true")
    if batches_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", batches_per_trigger)
    return reader.parquet(f"{src.path}/markers")


def start_consumer(spark: SparkSession, src: ZoneTable, consumer: str, apply: Callable[[DataFrame, int], None],
                   held: Callable[[], DataFrame] | None = None, checkpoint: str | None = None,
                   batches_per_trigger: int | None = None, trigger: dict | None = None) -> StreamingQuery | None:
    """Start the stream of ``consumer``: ``apply(feed, newest_batch_id)`` gets the
    change rows of each trigger.  ``trigger`` is that of ``DataStreamWriter``
    (default: all that is there now, then stop); ``checkpoint`` a folder shared by
    driver and executors (default: beside the table's zone data).  ``held`` as in
    :func:`deidlake.streaming.incremental.run_available_now`.  None if nothing was
    ever announced, so that there is no folder to watch yet."""
    src.register_consumer(spark, consumer)
    src.announce(spark)
    if not src._batches(spark, "markers"):
        return None

    def step(markers: DataFrame, _: int) -> None:
        newest = markers.agg(F.max("batch")).first()[0]
        if newest is not None:
            _consume(markers.sparkSession, src, consumer, apply, held, newest)

    return (read_markers(spark, src, batches_per_trigger).writeStream.foreachBatch(step)
            .option("checkpointLocation", checkpoint or f"{src.path}/streams/{consumer}")
            .queryName(f"{src.name}-{consumer}").trigger(**(trigger or {"availableNow": True})).start())


def stream_available_now(spark: SparkSession, src: ZoneTable, consumer: str, apply: Callable[[DataFrame, int], None],
                         held: Callable[[], DataFrame] | None = None, checkpoint: str | None = None,
                         batches_per_trigger: int | None = None) -> int | None:
    """Run the stream over all announced batches and stop; the consumer's mark
    afterwards.  An error of ``apply`` is raised here."""
    query = start_consumer(spark, src, consumer, apply, held, checkpoint, batches_per_trigger)
    if query is not None:
        query.awaitTermination()
    return src.mark(spark, consumer)
