"""The Structured Streaming consumer of a zone table: restarts, late and repeated
markers, several batches a run, expiry."""

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from deidlake.sources.zones import ZoneTable, _fs
from deidlake.streaming.structured import read_markers, stream_available_now
from helpers import rows
from test_consumers import BATCHES, ROWS, Copy, feed_table


def expected(spark, zt):
    return rows(zt.read_snapshot(spark))


def test_stream_applies_every_batch_once_across_restarts(spark, root, tmp_path):
    zt = feed_table(spark, root, {1: BATCHES[1]})
    copy, seen = Copy(spark, str(tmp_path / "copy")), []

    def apply(feed, newest):
        seen.append(sorted({r["batch_id"] for r in feed.collect()}))
        copy.apply(feed, newest)

    assert read_markers(spark, zt).isStreaming if zt.announce(spark) else False
    assert stream_available_now(spark, zt, "s", apply) == 1
    assert stream_available_now(spark, zt, "s", apply) == 1  # nothing new
    for b in (2, 3, 4):
        zt.write_batch(spark, spark.createDataFrame(BATCHES[b], ROWS), b, ["k"])
    # three batches in one run, one for each trigger
    assert stream_available_now(spark, zt, "s", apply, batches_per_trigger=1) == 4
    assert seen == [[1], [2], [3], [4]]
    assert rows(copy.held(), "k", "v") == expected(spark, zt)


def test_batches_of_one_trigger_are_netted(spark, root, tmp_path):
    zt = feed_table(spark, root)
    copy = Copy(spark, str(tmp_path / "copy"))
    assert stream_available_now(spark, zt, "s", copy.apply) == 4
    assert copy.runs == 1 and rows(copy.held(), "k", "v") == expected(spark, zt)


def test_crash_between_apply_and_mark_repeats_the_trigger(spark, root, tmp_path):
    zt = feed_table(spark, root)
    copy, crash = Copy(spark, str(tmp_path / "copy")), [True]

    def apply(feed, newest):
        copy.apply(feed, newest)
        if crash.pop() if crash else False:
            raise RuntimeError("lost the driver")

    with pytest.raises(StreamingQueryException, match="lost the driver"):
        stream_available_now(spark, zt, "s", apply)
    assert zt.mark(spark, "s") is None and zt.consumers(spark) == {"s": 0}
    assert stream_available_now(spark, zt, "s", apply) == 4
    assert copy.runs == 2 and rows(copy.held(), "k", "v") == expected(spark, zt)


def test_late_and_repeated_markers_and_a_lost_checkpoint(spark, root, tmp_path):
    zt = feed_table(spark, root, {b: BATCHES[b] for b in (1, 2, 3)})
    zt.announce(spark)
    fs, late = _fs(spark, zt._dir("markers", 2))
    fs.delete(late, True)
    zt.mark_consumed(spark, "s", 0)
    copy = Copy(spark, str(tmp_path / "copy"))
    # the consumer announces what a crashed writer didn't; here the marker comes after its run
    announce, ZoneTable.announce = ZoneTable.announce, lambda self, spark: []
    try:
        assert stream_available_now(spark, zt, "s", copy.apply) == 3
    finally:
        ZoneTable.announce = announce
    assert zt.announce(spark) == [2]
    assert stream_available_now(spark, zt, "s", copy.apply) == 3 and copy.runs == 1
    # all markers are new to an empty checkpoint
    assert stream_available_now(spark, zt, "s", copy.apply, checkpoint=str(tmp_path / "other")) == 3 and copy.runs == 1
    assert rows(copy.held(), "k", "v") == expected(spark, zt)


def test_expired_batches_come_as_snapshot_and_deletes(spark, root, tmp_path):
    zt = feed_table(spark, root, {1: BATCHES[1]})
    copy = Copy(spark, str(tmp_path / "copy"))
    stream_available_now(spark, zt, "s", copy.apply)
    zt.unregister_consumer(spark, "s")
    for b in (2, 3, 4):
        zt.write_batch(spark, spark.createDataFrame(BATCHES[b], ROWS), b, ["k"])
    zt.announce(spark)
    zt.compact(spark)
    assert zt.expire(spark, 4) == [1, 2, 3]
    zt.mark_consumed(spark, "s", 1)
    with pytest.raises(StreamingQueryException, match="have expired"):
        stream_available_now(spark, zt, "s", copy.apply)
    assert zt._batches(spark, "markers") == [4]
    assert stream_available_now(spark, zt, "s", copy.apply, copy.held) == 4
    assert rows(copy.held(), "k", "v") == expected(spark, zt)


def test_nothing_announced_and_an_empty_batch(spark, root, tmp_path):
    zt = ZoneTable(root, "bronze", "dbo.F")
    copy = Copy(spark, str(tmp_path / "copy"))
    assert stream_available_now(spark, zt, "s", copy.apply) is None
    zt.write_batch(spark, spark.createDataFrame([], ROWS), 1, ["k"])
    assert stream_available_now(spark, zt, "s", lambda feed, newest: None) == 1
    assert zt.unconsumed(spark, 1) is None and zt.read_snapshot(spark).where(F.lit(True)).isEmpty()
