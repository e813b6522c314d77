"""Consumers of a zone table: registry, expiry bounded by it, and consumers
whose next batches have expired."""

import pytest
from pyspark.sql import functions as F

from deidlake.constants import TEST_HASH_SALT
from deidlake.operators.changes import apply_changes, net_changes
from deidlake.plans import jobs
from deidlake.sources.zones import HistoryExpired, ZoneTable
from deidlake.spec import ColumnRole, TableSpec, UpdateMode, spec_df
from deidlake.streaming.incremental import run_available_now
from helpers import rows

ROWS = "k long, v string, _side string"
BATCHES = {
    1: [(1, "a", "insert"), (2, "b", "insert"), (None, "n", "insert")],
    2: [(2, None, "delete"), (3, "c", "insert")],
    3: [(None, None, "delete"), (4, "d", "insert")],
    4: [(1, "a", "delete"), (1, "a4", "insert")],
}


def feed_table(spark, root, batches=BATCHES):
    zt = ZoneTable(root, "bronze", "dbo.F")
    for batch, data in batches.items():
        zt.write_batch(spark, spark.createDataFrame(data, ROWS), batch, ["k"])
    return zt


class Copy:
    """A consumer that keeps a copy of the table, in a Parquet folder a run."""

    def __init__(self, spark, folder):
        self.spark, self.folder, self.runs = spark, folder, 0

    def held(self):
        return self.spark.read.parquet(f"{self.folder}/{self.runs}") if self.runs else None

    def apply(self, feed, newest):
        net = net_changes(feed, ["k"])
        apply_changes(self.held(), net, ["k"]).write.parquet(f"{self.folder}/{self.runs + 1}")
        self.runs += 1


def test_expiry_stops_at_the_slowest_registered_consumer(spark, root, tmp_path):
    zt = feed_table(spark, root)
    copy = Copy(spark, str(tmp_path / "copy"))
    zt.register_consumer(spark, "new")  # has consumed nothing: nothing goes
    zt.compact(spark)
    assert zt.consumers(spark) == {"new": 0} and zt.expire(spark, 10) == []
    zt.mark_consumed(spark, "new", 2)
    zt.mark_consumed(spark, "other", 1)
    assert zt.expire(spark, 10) == [1]
    zt.unregister_consumer(spark, "other")
    assert zt.consumers(spark) == {"new": 2} and zt.expire(spark, 10) == [2]
    got = zt.unconsumed(spark, zt.mark(spark, "new"))
    assert not got.reset and sorted({r["batch_id"] for r in got.feed.collect()}) == [3, 4]
    # nothing is kept for a consumer that is through
    assert run_available_now(spark, zt, "new", lambda feed, newest: None) == 4
    assert run_available_now(spark, zt, "new", copy.apply) is None and zt.expire(spark, 10) == [3]


def test_a_consumer_never_gets_a_part_of_the_changes(spark, root, tmp_path):
    """Batches 2 and 3 expire before a consumer at 1 sees them."""
    zt = feed_table(spark, root, {1: BATCHES[1]})
    copy = Copy(spark, str(tmp_path / "copy"))
    assert run_available_now(spark, zt, "copy", copy.apply, copy.held) == 1
    for b in (2, 3, 4):
        zt.write_batch(spark, spark.createDataFrame(BATCHES[b], ROWS), b, ["k"])
    zt.compact(spark)
    assert zt.expire(spark, 10) == [1]  # registered: 2 to 4 stay
    assert not zt.unconsumed(spark, 1).reset
    zt.unregister_consumer(spark, "copy")
    assert zt.expire(spark, 10) == [2, 3]
    # the consumer comes back with its own mark
    zt.mark_consumed(spark, "copy", 1)
    assert zt.unconsumed(spark, 1).reset
    with pytest.raises(HistoryExpired):
        run_available_now(spark, zt, "copy", copy.apply)
    assert zt.mark(spark, "copy") == 1  # not marked
    seen = []

    def apply(feed, newest):
        seen.extend((r["k"], r["v"], r["_change_type"]) for r in feed.collect())
        copy.apply(feed, newest)

    assert run_available_now(spark, zt, "copy", apply, copy.held) == 4
    assert sorted(seen, key=str) == sorted(
        [(1, "a4", "insert"), (3, "c", "insert"), (4, "d", "insert"), (2, None, "delete"), (None, None, "delete")], key=str)
    assert rows(copy.held()) == [(1, "a4"), (3, "c"), (4, "d")] == rows(zt.read_snapshot(spark))
    assert run_available_now(spark, zt, "copy", copy.apply, copy.held) is None


def test_the_next_batch_is_enough_though_older_ones_are_gone(spark, root):
    zt = feed_table(spark, root)
    zt.compact(spark)
    zt.expire(spark, 3)  # 1 and 2
    got = zt.unconsumed(spark, 2)
    assert not got.reset and got.newest == 4 and got.feed.count() == 4
    assert zt.unconsumed(spark, 1).reset and zt.unconsumed(spark, 4) is None


def test_batch_ids_with_holes_are_no_gap(spark, root):
    zt = feed_table(spark, root, {3: BATCHES[1], 7: BATCHES[2], 20: BATCHES[3]})
    assert not zt.unconsumed(spark, 3).reset and not zt.unconsumed(spark, 7).reset
    zt.compact(spark)
    zt.expire(spark, 8)
    assert zt.committed(spark) == [20] and not zt.unconsumed(spark, 7).reset and zt.unconsumed(spark, 3).reset


def test_marks_survive_a_crash_between_publishing_and_removing(spark, root):
    zt = feed_table(spark, root, {1: BATCHES[1]})
    zt.mark_consumed(spark, "c", 1)
    spark.range(1).selectExpr("current_timestamp() AS noted").write.parquet(zt._dir("consumers/consumer=c", 3))
    assert zt.mark(spark, "c") == 3  # both there: the newest counts
    # an unpublished mark doesn't
    spark.range(1).write.option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(zt._dir("consumers/consumer=c", 9))
    assert zt.mark(spark, "c") == 3
    zt.mark_consumed(spark, "c", 10)
    assert zt.consumers(spark) == {"c": 10}
    with pytest.raises(ValueError):
        zt.register_consumer(spark, "../x")


def test_downstream_zone_catches_up_after_expiry(spark, root):
    """Silver misses bronze batches that have expired: rows deleted in them go
    from silver too, by de-identified keys."""
    spec = TableSpec("dbo.T", ("k", "c", "v"), UpdateMode.APPEND_AND_REMOVE, {ColumnRole.CLIENT_ID: ("c",)}, keys=("c",))
    cfg = jobs.RunConfig(root=root, salt=TEST_HASH_SALT)
    bronze, silver = ZoneTable(root, "bronze", spec.name), ZoneTable(root, "silver", spec.name)
    live = spec_df(spark, [spec]).select("table_name", "column_name")
    loads = [[(1, "p", "a"), (2, "q", "b")], [(1, "p", "a"), (3, "r", "c")], [(3, "r", "c"), (4, "s", "d")]]
    for batch, data in enumerate(loads, 1):
        df = spark.createDataFrame(data, "k long, c string, v string")
        jobs.run_ingestion(spark, cfg, [spec], lambda s, df=df: df, batch, live)
        if batch == 1:
            jobs.run_deidentification(spark, cfg, [spec])
    bronze.compact(spark)
    assert bronze.expire(spark, 10) == [1, 2]
    jobs.run_deidentification(spark, cfg, [spec])
    assert rows(silver.read_snapshot(spark), "k", "v") == [(3, "c"), (4, "d")]
    deleted = silver.read_changes(spark, after=1).where(F.col("_change_type") == "delete").collect()
    assert len(deleted) == 2 and all(r["v"] is None and len(r["c_hashed"]) == 64 for r in deleted)


def test_cleaning_keeps_what_a_registered_consumer_lacks(spark, root):
    spec = TableSpec("dbo.U", ("k", "v"), UpdateMode.APPEND_AND_REMOVE, {}, keys=("k",))
    cfg = jobs.RunConfig(root=root, salt=TEST_HASH_SALT)
    live = spec_df(spark, [spec]).select("table_name", "column_name")
    zones = {z: ZoneTable(root, z, spec.name) for z in ("bronze", "silver", "gold")}
    for zt in zones.values():
        zt.register_consumer(spark, "export")
    for batch in (1, 2, 3):
        df = spark.createDataFrame([(batch, "x")], "k long, v string")
        jobs.run_ingestion(spark, cfg, [spec], lambda s, df=df: df, batch, live)
        jobs.run_deidentification(spark, cfg, [spec])
        jobs.run_entity_extraction(spark, cfg, [spec])
    assert not any(jobs.run_cleaning(spark, cfg, [spec]).values())
    for z, mark in (("bronze", 3), ("silver", 2), ("gold", 1)):
        zones[z].mark_consumed(spark, "export", mark)
    removed = jobs.run_cleaning(spark, cfg, [spec])
    assert removed == {f"bronze/{spec.name}": [1, 2], f"silver/{spec.name}": [1, 2], f"gold/{spec.name}": [1]}
    for zt in zones.values():
        assert not (zt.unconsumed(spark, zt.mark(spark, "export")) or (0, 0, False))[2]
        assert rows(zt.read_snapshot(spark)) == [(3, "x")]
