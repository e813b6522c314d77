import pytest

from deidlake.constants import ROW_HASH_COLUMN, TEST_HASH_SALT
from deidlake.functions.hashing import row_hash, salted_sha256
from deidlake.operators.merge import with_row_hash
from deidlake.spec import ColumnRole, TableSpec, UpdateMode, spec_df


def test_spec_rejects_string_column_list():
    with pytest.raises(TypeError):
        TableSpec("dbo.t", "COLUMN_1", UpdateMode.FULL_UPDATE)
    with pytest.raises(TypeError):
        TableSpec("dbo.t", ("a",), UpdateMode.FULL_UPDATE, {ColumnRole.FREE_TEXT: "a"})


def test_spec_keys_and_flags():
    full = TableSpec("dbo.t", ("a", "b"), UpdateMode.FULL_UPDATE, {ColumnRole.FREE_TEXT: ("b",)})
    assert full.merge_keys == (ROW_HASH_COLUMN,)
    assert not full.skip_deidentification and not full.skip_entity_extraction
    plain = TableSpec("dbo.t", ("a",), UpdateMode.APPEND_AND_REMOVE, {}, keys=("a",))
    assert plain.merge_keys == ("a",) and plain.skip_deidentification and plain.skip_entity_extraction
    with pytest.raises(ValueError):
        TableSpec("dbo.t", ("a",), UpdateMode.APPEND_AND_REMOVE)  # keys are mandatory
    skipped = TableSpec("dbo.t", ("a", "b"), UpdateMode.NOT_IMPORT, skip_columns=("b",))
    assert not skipped.is_imported and skipped.imported_columns == ("a",)
    assert skipped.short_name == "t"


def test_spec_df(spark):
    spec = TableSpec("dbo.t", ("a", "b"), UpdateMode.FULL_UPDATE, {ColumnRole.CLIENT_ID: ("a",)})
    assert sorted(spec_df(spark, [spec]).collect()) == [("dbo.t", "a", "client_id"), ("dbo.t", "b", None)]


def test_row_hash_golden_values(spark):
    df = spark.createDataFrame([(1, 5, "a"), (2, 6, "b"), (3, 7, None)], "key long, value_int long, value_str string")
    got = dict((r[0], r[1]) for r in with_row_hash(df).select("key", ROW_HASH_COLUMN).collect())
    assert got == {
        1: "9f12338fb5d8f48a5957916e78cb4f3b",
        2: "442bd90b2959404f49608b9f1a648bf0",
        3: "75cf219fc872342266cce9607f6d21ee",
    }


def test_row_hash_safe_mode_separates_collisions(spark):
    df = spark.createDataFrame([("a|b", "c"), ("a", "b|c"), (None, "c"), ("c", None)], "x string, y string")
    compat = [r[0] for r in df.select(row_hash(["x", "y"], "compat")).collect()]
    safe = [r[0] for r in df.select(row_hash(["x", "y"], "safe")).collect()]
    assert compat[0] == compat[1] and compat[2] == compat[3]
    assert len(set(safe)) == 4


def test_salted_id_hash_golden_value(spark):
    df = spark.createDataFrame([(1, "x"), (None, "y")], "ID long, Text string")
    got = df.select(salted_sha256("ID", TEST_HASH_SALT).alias("h")).collect()
    assert got[0][0] == "e59cb3f3ffba6255f0f32b278a76f8a44780fde36bb7a1b3428a394ff4c39596"
    assert got[1][0] is None
