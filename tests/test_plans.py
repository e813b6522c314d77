"""Physical-plan properties that matter at scale (static plans, AQE off)."""

import pytest

import __spark_entry__ as entry
from deidlake.operators.merge import merge_changes, merge_tagged
from deidlake.spec import UpdateMode

SF = "/root/testdata/sf0.001"


@pytest.fixture()
def static(spark):
    prev = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield spark
    spark.conf.set("spark.sql.adaptive.enabled", prev)


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_merge_shuffles_each_side_once_and_dedupes_map_side(static, tmp_path):
    t, s = str(tmp_path / "t"), str(tmp_path / "s")
    static.range(1000).selectExpr("id AS k", "CAST(id AS STRING) AS v").write.parquet(t)
    static.range(500, 1500).selectExpr("id % 700 AS k", "CAST(id AS STRING) AS v").write.parquet(s)
    p = plan(merge_tagged(static.read.parquet(t), static.read.parquet(s), ["k"], UpdateMode.DROP_AND_RECREATE))
    assert p.count("Exchange hashpartitioning") == 2
    assert "partial_min" in p  # duplicates collapse before the shuffle


def test_net_changes_is_a_partial_aggregate(static):
    p = plan(entry.queries()["net_changes"](static, SF))
    assert "partial_max" in p and "Window" not in p


@pytest.mark.parametrize("name", ["redact_text", "deidentify_documents", "pii_spans", "entities_long"])
def test_text_paths_stay_in_the_jvm(static, name):
    p = plan(entry.queries()[name](static, SF))
    assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p and "MapInPandas" not in p


def test_projection_and_filter_reach_the_scan(static):
    p = plan(entry.queries()["provision_filtered"](static, SF))
    assert "PushedFilters: [IsNotNull(o_orderstatus), IsNotNull(o_totalprice), EqualTo(o_orderstatus,F)" in p
    # only the provisioned columns are read (the hashed id is not requested)
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderstatus:string,o_totalprice:double,o_orderdate:timestamp_ntz>" in p


def test_zone_reads_open_only_the_requested_batches(spark, root):
    from deidlake.sources.zones import ZoneTable

    zt = ZoneTable(root, "bronze", "dbo.P")
    for b in (1, 2):
        zt.write_batch(spark, spark.createDataFrame([(b, "insert")], "k long, _side string"), b, ["k"])
    files = zt.read_changes(spark, after=1).inputFiles()
    assert files and all("/changes/batch_id=2/" in f for f in files)


def test_apply_changes_runs_each_merge_below_it_once(static):
    p = plan(entry.queries()["apply_changes"](static, SF))
    assert p.count("SortMergeJoin") + p.count("ShuffledHashJoin") + p.count("BroadcastHashJoin") <= 3


def test_keyed_ingest_shuffles_only_the_targets_keys(static, tmp_path):
    t, s = str(tmp_path / "t"), str(tmp_path / "s")
    static.range(1000).selectExpr("id AS k", "CAST(id AS STRING) AS v").write.parquet(t)
    static.range(500, 1500).selectExpr("id AS k", "CAST(id AS STRING) AS v").write.parquet(s)
    p = plan(merge_changes(static.read.parquet(t), static.read.parquet(s), ["k"], UpdateMode.APPEND_AND_REMOVE))
    assert p.count("Exchange hashpartitioning") == 2
    scans = [line for line in p.splitlines() if "FileScan" in line]
    assert any("ReadSchema: struct<k:bigint>" in line for line in scans)
