"""Compaction by touched key buckets: what is written grows with the change."""

import pytest
from pyspark.sql import functions as F

from deidlake.sources import zones
from deidlake.sources.zones import KEY_BUCKET, ZoneTable

SCHEMA = "k long, v string, _side string"


@pytest.fixture
def root(tmp_path):
    return str(tmp_path / "lake")


def publish(spark, zt, batch, rows):
    zt.write_batch(spark, spark.createDataFrame(rows, SCHEMA), batch, ["k"])


def snapshot(spark, zt, batch=None):
    return sorted(zt.read_snapshot(spark, batch).collect(), key=lambda r: (r["k"] is not None, r["k"]))


def size_of(spark, path):
    fs, p = zones._fs(spark, path)
    return fs.getContentSummary(p).getLength()


def held(spark, zt, base):
    return {k for k, holder in zt._layout(spark, base).items() if holder == base}


def test_bytes_written_grow_with_touched_buckets(spark, root):
    zt = ZoneTable(root, "bronze", "dbo.big")
    first = spark.range(20_000).select(F.col("id").alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("v"),
                                       F.lit("insert").alias("_side"))
    zt.write_batch(spark, first, 1, ["k"])
    zt.compact(spark)
    assert len(held(spark, zt, 1)) == 64
    whole = size_of(spark, f"{zt.path}/base/batch_id=1")
    publish(spark, zt, 2, [(7, "new", "insert")])
    zt.compact(spark)
    one = size_of(spark, f"{zt.path}/base/batch_id=2")
    assert len(held(spark, zt, 2)) == 1 and one < whole / 30
    publish(spark, zt, 3, [(k, None, "delete") for k in range(100, 108)])
    zt.compact(spark)
    assert len(held(spark, zt, 3)) <= 8 and one < size_of(spark, f"{zt.path}/base/batch_id=3") < whole / 5
    want = {k: v for k, v in first.drop("_side").collect() if not 100 <= k < 108} | {7: "new"}
    assert dict(map(tuple, zt.read_snapshot(spark).collect())) == want
    # what later bases use of older ones stays, the rest goes
    assert zt.expire(spark, 10) == [1, 2]
    assert zt.bases(spark) == [3]
    assert dict(map(tuple, zt.read_snapshot(spark).collect())) == want
    assert size_of(spark, f"{zt.path}/base") < 1.05 * whole
    assert any(h == 1 for h in zt._layout(spark, 3).values())
    with pytest.raises(ValueError, match="expired"):  # an old base in use is no snapshot of its own
        publish(spark, zt, 4, [])
        zones._fs(spark, f"{zt.path}/layout")[0].delete(zones._fs(spark, f"{zt.path}/layout/batch_id=3")[1], True)
        zt.read_snapshot(spark)


def test_every_snapshot_stays_right(spark, root):
    """Null keys, buckets that empty, batches without changes."""
    zt = ZoneTable(root, "silver", "dbo.t", buckets=4)
    state, batches = {}, [
        [(k, f"v{k}", "insert") for k in range(12)] + [(None, "none", "insert")],
        [(3, None, "delete"), (3, "again", "insert"), (None, None, "delete")],
        [],
        [(k, None, "delete") for k in range(12)],
        [(5, "back", "insert"), (None, "none too", "insert")],
    ]
    kept = {}
    for batch, rows in enumerate(batches, start=1):
        publish(spark, zt, batch, rows)
        for k, v, side in sorted(rows, key=lambda r: r[2]):  # deletes first
            state.pop(k, None)
            if side == "insert":
                state[k] = v
        assert zt.compact(spark) == batch
        kept[batch] = sorted(state.items(), key=lambda r: (r[0] is not None, r[0]))
        for b, want in kept.items():
            assert [tuple(r) for r in snapshot(spark, zt, b)] == want
    assert zt._layout(spark, 4) == {} and zt.compact(spark, 5) == 5
    assert zt.expire(spark, 3) == [1, 2]
    assert [tuple(r) for r in snapshot(spark, zt, 3)] == kept[3]


def test_another_number_of_buckets_or_key_type_rewrites_the_table(spark, root):
    zt = ZoneTable(root, "gold", "dbo.t", buckets=4)
    publish(spark, zt, 1, [(k, f"v{k}", "insert") for k in range(12)])
    zt.compact(spark)
    more = ZoneTable(root, "gold", "dbo.t", buckets=8)
    publish(spark, more, 2, [(1, None, "delete")])
    more.compact(spark)
    assert set(more._layout(spark, 2).values()) == {2}
    assert [r["k"] for r in snapshot(spark, more)] == [0, *range(2, 12)]


def test_an_interrupted_compaction_counts_for_nothing(spark, root, monkeypatch):
    zt = ZoneTable(root, "bronze", "dbo.t")
    publish(spark, zt, 1, [(k, f"v{k}", "insert") for k in range(12)])
    zt.compact(spark)
    publish(spark, zt, 2, [(1, "new", "insert")])
    before = snapshot(spark, zt)

    def fail(df, path):
        raise OSError("lost")

    monkeypatch.setattr(zones, "_publish", fail)
    with pytest.raises(OSError):
        zt.compact(spark)
    monkeypatch.undo()
    assert zt.bases(spark) == [1] and snapshot(spark, zt) == before
    assert zt.compact(spark) == 2 and snapshot(spark, zt) == before
    written = spark.read.parquet(f"{zt.path}/base/batch_id=2")
    assert KEY_BUCKET in written.columns and "_key_bucket" not in zt.read_snapshot(spark).columns
