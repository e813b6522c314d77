import datetime as dt

from deidlake.constants import TEST_HASH_SALT
from deidlake.plans import jobs
from deidlake.sources.jdbc import JdbcSource, partition_options, projected_query
from deidlake.sources.zones import ZoneTable
from deidlake.spec import ColumnRole, TableSpec, UpdateMode, spec_df
from deidlake.streaming.incremental import run_available_now

SCHEMA = "SequenceID int, ClientID string, DateAndTime timestamp, NoteText string"
ROUND1 = [(1, "123", dt.datetime(2016, 5, 3, 15, 20), "John Smith is in London"),
          (2, "456", dt.datetime(2017, 8, 7, 14, 25), "treated with aripiprazole")]
ROUND2 = [ROUND1[0], (3, "789", dt.datetime(2019, 3, 3, 15, 20), "diagnosed with paranoid schizophrenia")]

SPEC = TableSpec(
    "dbo.PrgProgressNote", ("SequenceID", "ClientID", "DateAndTime", "NoteText"), UpdateMode.FULL_UPDATE,
    {ColumnRole.FREE_TEXT: ("NoteText",), ColumnRole.CLIENT_ID: ("ClientID",), ColumnRole.DATE_TIME: ("DateAndTime",)},
    keys=("SequenceID",),
)
SKIPPED = TableSpec("dbo.Other", ("a",), UpdateMode.NOT_IMPORT)


def ingest(spark, cfg, specs, read_source, batch):
    """Ingestion against a live catalog that agrees with the specs."""
    live = spec_df(spark, specs).select("table_name", "column_name")
    return jobs.run_ingestion(spark, cfg, specs, read_source, batch, live)


def one_round(spark, cfg, data, batch):
    src = spark.createDataFrame(data, SCHEMA)
    logged = ingest(spark, cfg, [SPEC, SKIPPED], lambda spec: src, batch)
    jobs.run_deidentification(spark, cfg, [SPEC, SKIPPED])
    jobs.run_entity_extraction(spark, cfg, [SPEC, SKIPPED])
    return logged


def leave_unpublished(spark, df, path):
    """What a crash before the commit leaves: data files without _SUCCESS."""
    df.write.mode("overwrite").option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(path)


def test_two_rounds_end_to_end(spark, root):
    cfg = jobs.RunConfig(root=root, salt=TEST_HASH_SALT, extract_entities=True)
    logged = one_round(spark, cfg, ROUND1, 1)
    assert [(r["table_name"], r["row_count"]) for r in logged.collect()] == [("dbo.PrgProgressNote", 2)]
    one_round(spark, cfg, ROUND2, 2)
    bronze, silver, gold = (ZoneTable(root, z, SPEC.name).read_snapshot(spark) for z in ("bronze", "silver", "gold"))
    assert bronze.count() == silver.count() == gold.count() == 2
    assert len(bronze.columns) == 5 and len(silver.columns) == 5 and len(gold.columns) == 6
    s = {r["SequenceID"]: r for r in silver.collect()}
    assert set(s) == {1, 3}
    assert s[1]["NoteText"] == "<PERSON> is in <LOCATION>"
    assert s[1]["DateAndTime"] == dt.datetime(2016, 5, 3, 15)
    assert "ClientID" not in silver.columns and len(s[1]["ClientID_hashed"]) == 64
    g = {r["SequenceID"]: r["NoteText_feature_extraction"] for r in gold.collect()}
    assert g[3] == [["paranoid schizophrenia"], []]
    # the silver feed of batch 2 holds the delete of row 2 (key columns only,
    # no raw values) and the insert of row 3
    feed = ZoneTable(root, "silver", SPEC.name).read_changes(spark, after=1).collect()
    assert sorted(r["_change_type"] for r in feed) == ["delete", "insert"]
    deleted = [r for r in feed if r["_change_type"] == "delete"][0]
    assert deleted["MD5_ROW_HASH"] is not None and deleted["NoteText"] is None and deleted["SequenceID"] is None
    assert [r["SequenceID"] for r in feed if r["_change_type"] == "insert"] == [3]
    mon = spark.read.parquet(f"{root}/monitoring/UpsertLogs")
    assert sorted(r["row_count"] for r in mon.collect()) == [2, 2]
    # nothing new: a third propagation writes nothing
    assert jobs.run_deidentification(spark, cfg, [SPEC]) == {SPEC.name: None}


def test_unconsumed_batches_are_netted(spark, root):
    """Two ingests before one propagation: a key deleted then re-inserted
    must end up present (not deleted) downstream."""
    cfg = jobs.RunConfig(root=root, salt=TEST_HASH_SALT)
    spec = TableSpec("dbo.T", ("k", "v"), UpdateMode.APPEND_AND_REMOVE, {ColumnRole.OTHER_IDENTIFIABLE: ("v",)},
                     keys=("k",))
    for batch, data in enumerate([[(1, "a"), (2, "b")], [(1, "a")], [(1, "a"), (2, "b2")]], start=1):
        df = spark.createDataFrame(data, "k long, v string")
        ingest(spark, cfg, [spec], lambda s, df=df: df, batch)
        if batch == 1:
            jobs.run_deidentification(spark, cfg, [spec])
    jobs.run_deidentification(spark, cfg, [spec])
    silver = ZoneTable(root, "silver", spec.name).read_snapshot(spark)
    assert sorted(r["k"] for r in silver.collect()) == [1, 2] and silver.columns == ["k"]
    removed = jobs.run_cleaning(spark, cfg, [spec])
    assert removed[f"bronze/{spec.name}"] == [1, 2]
    assert ZoneTable(root, "bronze", spec.name).read_snapshot(spark).count() == 2


def test_incremental_consumer_restart(spark, root):
    cfg = jobs.RunConfig(root=root, salt=TEST_HASH_SALT)
    spec = TableSpec("dbo.S", ("k", "v"), UpdateMode.DROP_AND_RECREATE, {}, keys=("k",))
    bronze, silver = ZoneTable(root, "bronze", spec.name), ZoneTable(root, "silver", spec.name)
    marker = "to-silver"

    def apply(feed, newest):
        jobs.apply_feed(spark, feed, silver, ["k"], ["k"], lambda d: d, lambda d: d, newest)

    def load(batch, data):
        df = spark.createDataFrame(data, "k long, v string")
        ingest(spark, cfg, [spec], lambda s: df, batch)

    load(1, [(1, "a"), (2, "b")])
    load(2, [(1, "a2"), (3, "c")])
    run_available_now(spark, bronze, marker, apply)
    assert sorted(tuple(r) for r in silver.read_snapshot(spark).collect()) == [(1, "a2"), (3, "c")]
    first = silver.committed(spark)
    run_available_now(spark, bronze, marker, apply)   # nothing new
    assert silver.committed(spark) == first
    load(3, [(3, "c"), (4, "d")])
    run_available_now(spark, bronze, marker, apply)
    assert sorted(tuple(r) for r in silver.read_snapshot(spark).collect()) == [(3, "c"), (4, "d")]


def test_empty_first_batch_keeps_schema(spark, root):
    cfg = jobs.RunConfig(root=root, salt=TEST_HASH_SALT)
    empty = spark.createDataFrame([], SCHEMA)
    ingest(spark, cfg, [SPEC], lambda s: empty, 1)
    jobs.run_deidentification(spark, cfg, [SPEC])
    silver = ZoneTable(root, "silver", SPEC.name).read_snapshot(spark)
    assert silver.count() == 0 and "ClientID_hashed" in silver.columns and "ClientID" not in silver.columns


def test_jdbc_options_and_projection():
    src = JdbcSource("jdbc:sqlserver://db", user="u", password="p", driver="D", authentication="ActiveDirectory")
    opts = src.options()
    assert opts["url"] == "jdbc:sqlserver://db" and opts["authentication"] == "ActiveDirectory"
    assert partition_options("id", 0, 100, 8)["numPartitions"] == "8"
    spec = TableSpec("dbo.T", ("a", "b", 'c"d'), UpdateMode.FULL_UPDATE, skip_columns=("b",))
    assert projected_query(spec) == '(SELECT "a", "c""d" FROM dbo.T) tbl'


def test_compaction_keeps_snapshot_and_abandoned_batch_is_replaced(spark, root):
    spec = TableSpec("dbo.C", ("k", "v"), UpdateMode.DROP_AND_RECREATE, {}, keys=("k",))
    cfg = jobs.RunConfig(root=root, salt=TEST_HASH_SALT)
    bronze = ZoneTable(root, "bronze", spec.name)
    for batch, data in enumerate([[(1, "a"), (2, "b")], [(2, "b2"), (3, "c")], [(3, "c"), (4, "d")]], start=1):
        df = spark.createDataFrame(data, "k long, v string")
        ingest(spark, cfg, [spec], lambda s, df=df: df, bronze.next_batch(spark))
    before = sorted(tuple(r) for r in bronze.read_snapshot(spark).collect())
    assert before == [(3, "c"), (4, "d")]
    assert bronze.compact(spark) == 3
    assert sorted(tuple(r) for r in bronze.read_snapshot(spark).collect()) == before
    assert sorted(tuple(r) for r in bronze.read_snapshot(spark, 2).collect()) == [(2, "b2"), (3, "c")]
    assert bronze.expire(spark, 10) == [1, 2]
    assert sorted(tuple(r) for r in bronze.read_snapshot(spark).collect()) == before
    # a crashed attempt at batch 4 left files but no commit marker
    stray = spark.createDataFrame([(9, "x", "delete")], "k long, v string, _change_type string")
    leave_unpublished(spark, stray, f"{bronze.path}/changes/batch_id=4")
    assert bronze.next_batch(spark) == 4
    assert sorted(tuple(r) for r in bronze.read_snapshot(spark).collect()) == before  # uncommitted: invisible
    df = spark.createDataFrame([(4, "d"), (5, "e")], "k long, v string")
    ingest(spark, cfg, [spec], lambda s: df, 4)
    assert sorted(tuple(r) for r in bronze.read_snapshot(spark).collect()) == [(4, "d"), (5, "e")]
    assert sorted((r["k"], r["_change_type"]) for r in bronze.read_changes(spark, after=3).collect()) == [
        (3, "delete"), (5, "insert")]


def test_monitoring_compat_names_and_text_removed_before_extraction(spark, root):
    from deidlake.operators.monitor import monitoring_rows

    compat = monitoring_rows(spark, [("dbo.T", 2)], logged_at="2024-01-01T00:00", compat_names=True)
    assert compat.columns == ["Row_Count", "Date_Time", "Value"] and compat.collect()[0] == ("dbo.T", "2024-01-01T00:00", 2)
    assert monitoring_rows(spark, []).count() == 0  # typed even when nothing was imported
    cfg = jobs.RunConfig(root=root, salt=TEST_HASH_SALT, text_mode="remove", extract_entities=True)
    src = spark.createDataFrame(ROUND1, SCHEMA)
    ingest(spark, cfg, [SPEC], lambda s: src, 1)
    jobs.run_deidentification(spark, cfg, [SPEC])
    jobs.run_entity_extraction(spark, cfg, [SPEC])
    gold = ZoneTable(root, "gold", SPEC.name).read_snapshot(spark)
    assert "NoteText" not in gold.columns and not any(c.endswith("_feature_extraction") for c in gold.columns)
    assert gold.count() == 2


def test_provisioning_and_snapshot_jobs(spark, root, tmp_path):
    import uuid as _uuid

    from deidlake.operators.provision import TableRequest, encode_request

    cfg = jobs.RunConfig(root=root, salt=TEST_HASH_SALT)
    src = spark.createDataFrame(ROUND1, SCHEMA)
    ingest(spark, cfg, [SPEC], lambda s: src, 1)
    jobs.run_deidentification(spark, cfg, [SPEC])
    jobs.run_entity_extraction(spark, cfg, [SPEC])
    req = encode_request({SPEC.name: TableRequest(("SequenceID", "DateAndTime"), "SequenceID > 1")})
    dest = str(tmp_path / "workspace")
    paths = jobs.run_provisioning(spark, cfg, req, str(_uuid.uuid4()), dest, stamp="2024-01-01-00-00-00")
    got = spark.read.parquet(paths[SPEC.name])
    assert got.columns == ["SequenceID", "DateAndTime"] and [r[0] for r in got.collect()] == [2]
    assert paths[SPEC.name].endswith(f"{SPEC.name}/2024-01-01-00-00-00")

    tables = {("dbo", "a"): spark.range(5).toDF("x"), ("dbo", "b"): spark.range(3).toDF("y")}
    dests = [str(tmp_path / "d1"), str(tmp_path / "d2")]
    written = jobs.run_snapshot_distribution(spark, tables, str(tmp_path / "stage"), dests, stamp="S1")
    assert sorted(written) == ["dbo_a", "dbo_b"] and len(written["dbo_a"]) == 4
    assert spark.read.parquet(f"{dests[1]}/latest/dbo_a").count() == 5
    assert spark.read.parquet(f"{dests[0]}/archive/S1/dbo_b").count() == 3


def test_injected_model_extractor(spark, root):
    from deidlake.functions.udfs import entities_udf

    def factory():  # pickled by value (defined inside the test)
        return lambda t: [("CHEMICAL", w.strip(".")) for w in t.split() if w.strip(".").endswith("ole")]

    cfg = jobs.RunConfig(root=root, salt=TEST_HASH_SALT, extract_entities=True, entity_fn=entities_udf(factory))
    one_round(spark, cfg, ROUND1, 1)
    gold = {r["SequenceID"]: r["NoteText_feature_extraction"]
            for r in ZoneTable(root, "gold", SPEC.name).read_snapshot(spark).collect()}
    assert gold == {1: [[], []], 2: [[], ["aripiprazole"]]}


def test_ingestion_validates_live_catalog_first(spark, root):
    import pytest

    from deidlake.operators.validate import SchemaValidationError

    cfg = jobs.RunConfig(root=root, salt=TEST_HASH_SALT)
    src = spark.createDataFrame(ROUND1, SCHEMA)
    live = spark.createDataFrame([(SPEC.name, c) for c in SPEC.columns] + [(SPEC.name, "Extra")],
                                 "table_name string, column_name string")
    with pytest.raises(SchemaValidationError) as e:
        jobs.run_ingestion(spark, cfg, [SPEC], lambda s: src, 1, live_catalog=live)
    assert e.value.report["analysed_tables"][SPEC.name]["unclassified_columns"] == ["Extra"]
    assert ZoneTable(root, "bronze", SPEC.name).latest(spark) is None  # nothing was ingested
    ok = live.where("column_name <> 'Extra'")
    jobs.run_ingestion(spark, cfg, [SPEC], lambda s: src, 1, live_catalog=ok)
    assert ZoneTable(root, "bronze", SPEC.name).read_snapshot(spark).count() == 2


def changes_table(spark, root, batches):
    """A zone table with the given (key, value, side) rows as batches."""
    zt = ZoneTable(root, "bronze", "dbo.Z")
    for batch, data in batches.items():
        zt.write_batch(spark, spark.createDataFrame(data, "k long, v string, _side string"), batch, ["k"])
    return zt


def test_consumer_waits_for_a_batch_whose_files_are_still_appearing(spark, root):
    src = changes_table(spark, root, {1: [(1, "a", "insert")]})
    marker, seen = "late", []

    def apply(feed, newest):
        seen.append((newest, sorted(r["k"] for r in feed.collect())))

    # half of batch 2 is there when the first run lists the table
    part = spark.createDataFrame([(2, "b", "insert")], "k long, v string, _change_type string")
    leave_unpublished(spark, part, f"{src.path}/changes/batch_id=2")
    assert run_available_now(spark, src, marker, apply) == 1
    src.write_batch(spark, spark.createDataFrame([(2, "b", "insert"), (3, "c", "insert")],
                                                 "k long, v string, _side string"), 2, ["k"])
    assert run_available_now(spark, src, marker, apply) == 2
    assert run_available_now(spark, src, marker, apply) is None
    assert seen == [(1, [1]), (2, [2, 3])]


def test_crash_inside_compaction_and_expiry_keeps_every_batch(spark, root, monkeypatch):
    from deidlake.sources import zones

    zt = changes_table(spark, root, {1: [(1, "a", "insert"), (2, "b", "insert")], 2: [(2, None, "delete"), (3, "c", "insert")]})
    want = [(1, "a"), (3, "c")]
    # the data of the base is written, its publication fails
    monkeypatch.setattr(zones, "_publish", lambda df, path: leave_unpublished(spark, df, path))
    zt.compact(spark)
    monkeypatch.undo()
    assert zt.committed(spark) == [1, 2] and zt.bases(spark) == [] and zt.next_batch(spark) == 3
    assert sorted(tuple(r) for r in zt.read_snapshot(spark).collect()) == want
    assert zt.compact(spark) == 2 and zt.bases(spark) == [2]
    # expiry got as far as batch 1's _SUCCESS
    fs, p = zones._fs(spark, f"{zt.path}/changes/batch_id=1/_SUCCESS")
    fs.delete(p, False)
    assert zt.committed(spark) == [2] and zt.next_batch(spark) == 3
    assert sorted(tuple(r) for r in zt.read_snapshot(spark).collect()) == want
    zt.expire(spark, 10)
    assert not fs.exists(p.getParent())  # the leftovers went


def test_new_consumer_of_expired_history_starts_from_the_snapshot(spark, root):
    zt = changes_table(spark, root, {1: [(1, "a", "insert")], 2: [(2, "b", "insert")]})
    zt.compact(spark)
    zt.expire(spark, 3)
    newest, feed, reset = zt.unconsumed(spark, None)
    assert newest == 2 and reset
    assert sorted((r["k"], r["_change_type"]) for r in feed.collect()) == [(1, "insert"), (2, "insert")]
    assert zt.unconsumed(spark, 2) is None


def test_gold_tables_are_registered_by_name(spark, root):
    cfg = jobs.RunConfig(root=root, salt=TEST_HASH_SALT)
    for batch, data in ((1, ROUND1), (2, ROUND2)):
        src = spark.createDataFrame(data, SCHEMA)
        ingest(spark, cfg, [SPEC], lambda s: src, batch)
        jobs.run_deidentification(spark, cfg, [SPEC])
        jobs.run_entity_extraction(spark, cfg, [SPEC], database="gold_db")
        got = spark.newSession().sql("SELECT SequenceID FROM gold_db.dbo_PrgProgressNote ORDER BY 1").collect()
        assert [r[0] for r in got] == sorted(r[0] for r in data)
    spark.sql("DROP DATABASE gold_db CASCADE")


def test_snapshot_checksum_sees_contents(spark):
    from deidlake.operators.snapshot import content_checksum

    a = spark.createDataFrame([(1, "x"), (2, None)], "k int, v string")
    same = spark.createDataFrame([(2, None), (1, "x")], "k int, v string")
    other = spark.createDataFrame([(1, "y"), (2, None)], "k int, v string")
    assert content_checksum(a).first() == content_checksum(same).first() != content_checksum(other).first()
    assert content_checksum(a.limit(0)).first() == (0, None)


def test_checksum_sees_every_type_and_no_order(spark):
    from decimal import Decimal

    from pyspark.sql import functions as F

    from deidlake.operators.snapshot import canonical, content_checksum

    schema = ("b boolean, i int, d decimal(20,4), f float, g double, s string, x binary, day date, t timestamp, n timestamp_ntz, "
              "a array<double>, m map<string,int>, r struct<p:int,q:string>")
    when = dt.datetime(2020, 1, 2, 3, 4, 5, 6)
    row = (True, 1, Decimal(2), 0.1, 0.1, "s", bytearray(b"x"), when.date(), when, when, [1.5, None], {"a": 1, "b": 2}, (1, "q"))
    others = {"b": False, "i": None, "d": Decimal(3), "f": 0.2, "g": 0.1 + 2 ** -56, "s": "", "x": bytearray(b""), "day": dt.date(1969, 12, 31),
              "t": dt.datetime(2020, 1, 2, 3, 4, 5, 7), "n": dt.datetime(1960, 1, 1), "a": [1.5], "m": {"a": 2, "b": 1}, "r": (1, None)}

    def total(data):
        return tuple(content_checksum(spark.createDataFrame(data, schema)).first())

    names = [f.split(" ")[0] for f in schema.split(", ")]
    base, seen = total([row]), set()
    for i, name in enumerate(names):
        seen.add(total([(*row[:i], others[name], *row[i + 1:])]))
    assert len(seen) == len(names) and base not in seen
    # null and empty, and where a value ends
    assert total([(None,) * len(names)]) not in seen | {base}
    two = spark.createDataFrame([("a", "bc"), ("ab", "c")], "p string, q string")
    assert content_checksum(two.limit(1)).first()[1] != content_checksum(two.where("q = 'c'")).first()[1]
    # order and partitions don't count, copies do
    many = spark.createDataFrame([row, row, (None,) * len(names)], schema)
    assert content_checksum(many).first() == content_checksum(many.repartition(3).orderBy("i")).first()
    assert content_checksum(many).first()["row_count"] == 3
    assert tuple(content_checksum(many.limit(0)).first()) == (0, None)
    special = spark.createDataFrame([(x,) for x in (float("nan"), float("inf"), float("-inf"), 0.0, -0.0, 5e-324)], "g double")
    assert [r[0] for r in special.select(canonical(F.col("g"), special.schema["g"].dataType)).collect()] == [
        "nan", "inf", "-inf", "0x0p0", "-0x0p0", "0x0.0000000000001p-1022"]


def test_checksum_ignores_the_session_time_zone(spark):
    from deidlake.operators.snapshot import content_checksum

    df = spark.sql("SELECT timestamp_ntz'2021-03-28 02:30:00.123456' AS n, 1.25D AS g")
    before, sums = spark.conf.get("spark.sql.session.timeZone"), set()
    try:
        for zone in ("UTC", "Europe/Paris", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            sums.add(tuple(content_checksum(df).first()))
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
    assert len(sums) == 1


def test_checksum_of_doubles_without_a_pattern_search_for_each(spark):
    import math
    import random
    import struct

    from pyspark.sql import functions as F

    from deidlake.operators.snapshot import canonical, content_checksum

    rnd = random.Random(5)
    values = [struct.unpack("<d", struct.pack("<Q", rnd.getrandbits(64) >> rnd.choice((0, 0, 0, 13, 40))))[0] for _ in range(2000)]
    values = [x for x in values if math.isfinite(x)] + [math.ldexp(s, e) for e in range(-1074, 1024, 7) for s in (1, -1)] + [0.01, 1e22, 0.0]
    df = spark.createDataFrame([(x, [x, None]) for x in values], "g double, a array<double>")
    got = df.select("g", *[canonical(F.col(c), df.schema[c].dataType).alias(c + "_text") for c in ("g", "a")]).collect()
    for r in got:
        head, _, power = r["g"].hex().partition("p")
        digits = head.rstrip("0").rstrip(".") if "." in head else head
        want = ("-" if math.copysign(1, r["g"]) < 0 else "") + "0x0p0" if r["g"] == 0 else f"{digits}p{int(power)}"
        assert r["g_text"] == want and r["a_text"] == f"[2]{len(want)}:{want}n"
    plan = content_checksum(df)._jdf.queryExecution().toString()
    assert "format_string" not in plan
