import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from deidlake.constants import BATCH_ID_COLUMN, CHANGE_TYPE_COLUMN, ROW_HASH_COLUMN
from deidlake.operators import changes as ch
from deidlake.operators.merge import changes_of, dedupe_on_key, merge_tagged, snapshot_of
from deidlake.spec import UpdateMode

from helpers import rows

KV = "key long, value string"
START = [(1, "a"), (2, "b"), (3, "c")]
UPDATE = [(1, "d"), (2, "b"), (3, "c"), (4, "e")]
WITH_DELETES = [(1, "d"), (4, "e")]
MODES = [UpdateMode.APPEND_AND_REMOVE, UpdateMode.FULL_UPDATE, UpdateMode.DROP_AND_RECREATE]


def run(spark, target, source, mode, keys=("key",), schema=KV):
    t = None
    if target is not None:
        t = snapshot_of(merge_tagged(None, spark.createDataFrame(target, schema), list(keys), mode))
    tagged = merge_tagged(t, spark.createDataFrame(source, schema), list(keys), mode)
    cols = [c for c in spark.createDataFrame([], schema).columns]
    return rows(snapshot_of(tagged), *cols), rows(changes_of(tagged), *cols, CHANGE_TYPE_COLUMN)


@pytest.mark.parametrize("mode", MODES)
def test_first_load_equals_source(spark, mode):
    snap, changes = run(spark, None, START, mode)
    assert snap == START and [c[:2] for c in changes] == START


def test_update_append_and_remove_keeps_matched_rows(spark):
    snap, changes = run(spark, START, UPDATE, UpdateMode.APPEND_AND_REMOVE)
    assert snap == [(1, "a"), (2, "b"), (3, "c"), (4, "e")]
    assert changes == [(4, "e", "insert")]


def test_update_full_update(spark):
    snap, changes = run(spark, START, UPDATE, UpdateMode.FULL_UPDATE)
    assert snap == [(1, "d"), (2, "b"), (3, "c"), (4, "e")]
    assert changes == [(1, "a", "delete"), (1, "d", "insert"), (4, "e", "insert")]


def test_update_recreate_emits_real_differences_only(spark):
    snap, changes = run(spark, START, UPDATE, UpdateMode.DROP_AND_RECREATE)
    assert snap == [(1, "d"), (2, "b"), (3, "c"), (4, "e")]
    assert changes == [(1, "a", "delete"), (1, "d", "insert"), (4, "e", "insert")]


@pytest.mark.parametrize("mode,expected", [
    (UpdateMode.APPEND_AND_REMOVE, [(1, "a"), (4, "e")]),
    (UpdateMode.FULL_UPDATE, [(1, "d"), (4, "e")]),
    (UpdateMode.DROP_AND_RECREATE, [(1, "d"), (4, "e")]),
])
def test_deletes(spark, mode, expected):
    assert run(spark, START, WITH_DELETES, mode)[0] == expected


@pytest.mark.parametrize("mode,expected", [
    (UpdateMode.APPEND_AND_REMOVE, [(1, 1, "a"), (1, 2, "b"), (1, 3, "c"), (1, 4, "e")]),
    (UpdateMode.FULL_UPDATE, [(1, 1, "d"), (1, 2, "b"), (1, 3, "c"), (1, 4, "e")]),
    (UpdateMode.DROP_AND_RECREATE, [(1, 1, "d"), (1, 2, "b"), (1, 3, "c"), (1, 4, "e")]),
])
def test_composite_key(spark, mode, expected):
    schema = "key1 long, key2 long, value string"
    start = [(1, 1, "a"), (1, 2, "b"), (1, 5, "f")]
    update = [(1, 1, "d"), (1, 2, "b"), (1, 3, "c"), (1, 4, "e")]
    assert run(spark, start, update, mode, keys=("key1", "key2"), schema=schema)[0] == expected


def test_null_keys_match_null_safely(spark):
    snap, changes = run(spark, [(None, "a"), (1, "b")], [(None, "a"), (1, "b")], UpdateMode.APPEND_AND_REMOVE)
    assert changes == [] and len(snap) == 2


def test_dedupe_is_deterministic_and_keeps_smallest(spark):
    df = spark.createDataFrame([(1, "z"), (1, None), (1, "b"), (2, "x")], KV)
    assert rows(dedupe_on_key(df, ["key"])) == [(1, None), (2, "x")]
    with pytest.raises(ValueError):
        dedupe_on_key(df, [])


def test_full_update_hash_column(spark):
    tagged = merge_tagged(None, spark.createDataFrame(START, KV), [], UpdateMode.FULL_UPDATE)
    assert ROW_HASH_COLUMN in tagged.columns


def feed(spark, batches):
    data = [(k, v, t, b) for b, changes in enumerate(batches) for (k, v, t) in changes]
    return spark.createDataFrame(data, f"key long, value string, {CHANGE_TYPE_COLUMN} string, {BATCH_ID_COLUMN} long")


def test_apply_changes_fixture(spark):
    target = spark.createDataFrame([("1", "a"), ("2", "b"), ("3", "c")], "key string, value string")
    net = spark.createDataFrame([("4", "d", "insert"), ("3", "c", "delete")],
                                f"key string, value string, {CHANGE_TYPE_COLUMN} string")
    assert rows(ch.apply_changes(target, net, ["key"])) == [("1", "a"), ("2", "b"), ("4", "d")]
    assert rows(ch.apply_changes(None, net, ["key"])) == [("4", "d")]


def test_net_changes_delete_then_reinsert(spark):
    f = feed(spark, [[(1, "a", "insert")], [(1, "a", "delete")], [(1, "a2", "insert")]])
    net = ch.net_changes(f, ["key"])
    assert rows(net, "key", "value", CHANGE_TYPE_COLUMN) == [(1, "a2", "insert")]
    # update inside one batch: delete old + insert new -> the insert wins
    f = feed(spark, [[(1, "old", "delete"), (1, "new", "insert")]])
    assert rows(ch.net_changes(f, ["key"]), "value", CHANGE_TYPE_COLUMN) == [("new", "insert")]


def test_compact_and_latest(spark):
    f = feed(spark, [[(1, "a", "insert"), (2, "b", "insert")], [(2, "b", "delete")], [(3, "c", "insert")]])
    compact = ch.compact_changes(f, ["key"], upto=1)
    assert rows(compact, "key", CHANGE_TYPE_COLUMN, BATCH_ID_COLUMN) == [(1, "insert", 1), (2, "delete", 1)]
    assert ch.latest_batch(f).collect()[0] == (2, 3, 4)
    assert rows(ch.select_changes(f, after=0, upto=1, change_type="delete"), "key") == [(2,)]


state = st.dictionaries(st.integers(0, 8), st.sampled_from(["a", "b", "c"]), max_size=6)


@settings(max_examples=15, deadline=None)
@given(st.lists(state, min_size=1, max_size=4))
def test_applying_all_feeds_rebuilds_last_state(spark, states):
    """Property: bronze feed over several snapshots, applied at once from the
    first snapshot, equals the last snapshot -- also when re-applied."""
    schema = KV
    mode = UpdateMode.DROP_AND_RECREATE
    snap, parts = None, []
    for i, s in enumerate(states):
        src = spark.createDataFrame(sorted(s.items()), schema)
        tagged = merge_tagged(snap, src, ["key"], mode)
        parts.append(changes_of(tagged).withColumn(BATCH_ID_COLUMN, __import__("pyspark.sql.functions",
                                                                              fromlist=["lit"]).lit(i).cast("long")))
        snap = spark.createDataFrame(rows(snapshot_of(tagged)), schema)
    from functools import reduce
    all_changes = reduce(lambda a, b: a.unionByName(b), parts)
    first = spark.createDataFrame(sorted(states[0].items()), schema)
    net = ch.net_changes(ch.select_changes(all_changes, after=0, keep_system=True), ["key"])
    applied = ch.apply_changes(first, net, ["key"])
    assert rows(applied) == sorted(states[-1].items())
    assert rows(ch.apply_changes(applied, net, ["key"])) == sorted(states[-1].items())


def test_hot_key_holding_a_third_of_rows(spark):
    """One key with a third of all rows: results stay exact (the partial
    aggregates collapse it before the shuffle)."""
    from pyspark.sql import functions as F

    n = 3000
    src = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id")).alias("key"),
        F.format_string("v%05d", (n - F.col("id"))).alias("value"),
    )
    deduped = dict(rows(dedupe_on_key(src, ["key"])))
    assert len(deduped) == n - n // 3 + 1
    assert deduped[-1] == min(f"v{n - i:05d}" for i in range(0, n, 3))
    target = spark.createDataFrame([(-1, "old"), (1, "x")], KV)
    snap = dict(rows(snapshot_of(merge_tagged(target, src, ["key"], UpdateMode.DROP_AND_RECREATE))))
    assert snap[-1] == deduped[-1] and len(snap) == len(deduped)
    f = src.select("key", "value", F.lit("insert").alias(CHANGE_TYPE_COLUMN),
                   (F.col("value").substr(2, 5).cast("long") % 5).alias(BATCH_ID_COLUMN))
    net = dict((r["key"], r["value"]) for r in ch.net_changes(f, ["key"]).collect())
    hot = [(int(v[1:]) % 5, v) for v in (f"v{n - i:05d}" for i in range(0, n, 3))]
    assert net[-1] == max(hot)[1]


rows_strategy = st.lists(st.tuples(st.integers(0, 6), st.sampled_from(["a", "b", None])), max_size=8)


@settings(max_examples=15, deadline=None)
@given(rows_strategy, rows_strategy)
def test_full_update_result_is_source_as_a_set_and_rerun_is_quiet(spark, old, new):
    mode = UpdateMode.FULL_UPDATE
    first = snapshot_of(merge_tagged(None, spark.createDataFrame(old, KV), [], mode))
    target = spark.createDataFrame(rows(first), first.schema)
    tagged = merge_tagged(target, spark.createDataFrame(new, KV), [], mode)
    assert {r[:2] for r in rows(snapshot_of(tagged))} == set(new)
    again = snapshot_of(tagged)
    again = spark.createDataFrame(rows(again), again.schema)
    assert changes_of(merge_tagged(again, spark.createDataFrame(new, KV), [], mode)).count() == 0


def test_merge_changes_by_key(spark):
    from deidlake.operators.merge import merge_changes

    target = spark.createDataFrame([(1, "a"), (2, "b"), (None, "n")], "k int, v string")
    source = spark.createDataFrame([(1, "changed"), (3, "c"), (3, "d"), (None, "x")], "k int, v string")
    got = merge_changes(target, source, ["k"], UpdateMode.APPEND_AND_REMOVE)
    assert rows(got, "k", "v", "_side") == [(2, None, "delete"), (3, "c", "insert")]


def test_columns_must_agree_and_have_an_order(spark):
    two = spark.createDataFrame([(1, "a")], "k int, v string")
    with pytest.raises(ValueError, match="source lacks target columns"):
        merge_tagged(two, two.select("k"), ["k"])
    maps = two.selectExpr("k", "map('a', v) AS m")
    for use in (lambda: dedupe_on_key(maps, ["k"]), lambda: merge_tagged(None, maps, ["k"])):
        with pytest.raises(TypeError, match="'m'"):
            use()


def test_apply_changes_with_null_keys(spark):
    target = spark.createDataFrame([(None, "n"), (1, "a"), (2, "b")], "key int, v string")
    net = spark.createDataFrame([(None, "n2", "insert", 1), (2, None, "delete", 1), (3, "c", "insert", 1)],
                                "key int, v string, _change_type string, batch_id long")
    want = [(1, "a"), (3, "c"), (None, "n2")]
    assert rows(ch.apply_changes(target, net, ["key"])) == want
    assert rows(ch.replace_by_key(target, net, ["key"])) == want
