import datetime as dt

import pytest

from deidlake.constants import TEST_HASH_SALT
from deidlake.operators.deidentify import deidentified_keys, deidentify, delete_layout
from deidlake.spec import ColumnRole, TableSpec, UpdateMode

R = ColumnRole


def spec(cols, roles, keys=("ID",)):
    return TableSpec("dbo.TestTable", cols, UpdateMode.APPEND_AND_REMOVE, roles, keys=keys)


@pytest.fixture()
def notes(spark):
    return spark.createDataFrame([("note a", 1, "t1", "x"), ("note b", 2, "t2", "y")],
                                 "NoteText string, ID long, Text string, Another string")


def test_drop_one_and_several(notes):
    out = deidentify(notes, spec(notes.columns, {R.OTHER_IDENTIFIABLE: ("NoteText",)}), TEST_HASH_SALT)
    assert out.columns == ["ID", "Text", "Another"]
    out = deidentify(notes, spec(notes.columns, {R.OTHER_IDENTIFIABLE: ("Text", "Another")}), TEST_HASH_SALT)
    assert out.columns == ["NoteText", "ID"]


def test_no_roles_is_pass_through(notes):
    out = deidentify(notes, spec(notes.columns, {}), TEST_HASH_SALT)
    assert out is notes


def test_missing_column_raises_key_error(notes):
    with pytest.raises(KeyError, match="NotThere"):
        deidentify(notes, spec(notes.columns, {R.OTHER_IDENTIFIABLE: ("NotThere",)}), TEST_HASH_SALT)


def test_free_text_redaction(spark):
    df = spark.createDataFrame([("John Smith is in London", 1), ("Adam is in London", 2)], "NoteText string, ID long")
    out = deidentify(df, spec(df.columns, {R.FREE_TEXT: ("NoteText",)}), TEST_HASH_SALT)
    assert sorted(r[0] for r in out.select("NoteText").collect()) == [
        "<PERSON> is in <LOCATION>", "<PERSON> is in <LOCATION>"]


def test_two_text_columns(spark):
    df = spark.createDataFrame([("John Smith is in London", 1, "This is London")],
                               "NoteText string, ID long, OtherText string")
    out = deidentify(df, spec(df.columns, {R.FREE_TEXT: ("NoteText", "OtherText")}), TEST_HASH_SALT).collect()[0]
    assert out["NoteText"] == "<PERSON> is in <LOCATION>" and out["OtherText"] == "This is <LOCATION>"


def test_text_remove_mode(spark):
    df = spark.createDataFrame([("John", 1)], "NoteText string, ID long")
    out = deidentify(df, spec(df.columns, {R.FREE_TEXT: ("NoteText",)}), TEST_HASH_SALT, text_mode="remove")
    assert out.columns == ["ID"]


def test_empty_text_becomes_null_and_whole_text_is_processed(spark):
    long_text = ("x " * 15000) + "mail me at a.b@example.org"
    df = spark.createDataFrame([("", 1), (None, 2), (long_text, 3)], "NoteText string, ID long")
    out = dict((r["ID"], r["NoteText"]) for r in
               deidentify(df, spec(df.columns, {R.FREE_TEXT: ("NoteText",)}), TEST_HASH_SALT).collect())
    assert out[1] is None and out[2] is None
    assert out[3].endswith("<EMAIL_ADDRESS>") and len(out[3]) > 20000
    cut = deidentify(df, spec(df.columns, {R.FREE_TEXT: ("NoteText",)}), TEST_HASH_SALT, max_chars=20000)
    assert len(cut.where("ID = 3").collect()[0]["NoteText"]) == 20000


def test_round_hour_and_month_keep_types(spark):
    ts = dt.datetime(2023, 8, 16, 3, 4, 5)
    df = spark.createDataFrame([(1, ts, ts, ts, dt.date(2023, 8, 16))],
                               "ID long, H timestamp, M timestamp, N timestamp_ntz, D date")
    out = deidentify(df, spec(df.columns, {R.DATE_TIME: ("H", "N"), R.DATE: ("M", "D")}), TEST_HASH_SALT)
    assert dict(out.dtypes) == {"ID": "bigint", "H": "timestamp", "M": "timestamp", "N": "timestamp_ntz", "D": "date"}
    r = out.collect()[0]
    assert r["H"] == dt.datetime(2023, 8, 16, 3) and r["N"] == dt.datetime(2023, 8, 16, 3)
    assert r["M"] == dt.datetime(2023, 8, 1) and r["D"] == dt.date(2023, 8, 1)


def test_invalid_date_text_becomes_null(spark):
    df = spark.createDataFrame([(1, "invalid value"), (2, "2023-08-16 05:04:02")], "ID long, SomeDateTimeColumn string")
    out = deidentify(df, spec(df.columns, {R.DATE_TIME: ("SomeDateTimeColumn",)}), TEST_HASH_SALT)
    got = dict((r[0], r[1]) for r in out.collect())
    assert got[1] is None and got[2] == dt.datetime(2023, 8, 16, 5)


def test_hash_client_id_golden(spark):
    df = spark.createDataFrame([(1, "a")], "ID long, Text string")
    out = deidentify(df, spec(df.columns, {R.CLIENT_ID: ("ID",)}, keys=("Text",)), TEST_HASH_SALT)
    assert out.columns == ["Text", "ID_hashed"]
    assert out.collect()[0]["ID_hashed"] == "e59cb3f3ffba6255f0f32b278a76f8a44780fde36bb7a1b3428a394ff4c39596"


def test_delete_layout_and_keys(spark):
    df = spark.createDataFrame([(1, "c1", "text", dt.datetime(2020, 1, 1, 5, 6))],
                               "ID long, ClientID string, NoteText string, T timestamp")
    s = spec(df.columns, {R.CLIENT_ID: ("ClientID",), R.FREE_TEXT: ("NoteText",), R.DATE_TIME: ("T",)},
             keys=("ID", "ClientID"))
    out = delete_layout(df, s, TEST_HASH_SALT)
    full = deidentify(df, s, TEST_HASH_SALT)
    assert out.columns == full.columns
    assert deidentified_keys(s) == ("ID", "ClientID_hashed")
    assert out.collect()[0]["ClientID_hashed"] == full.collect()[0]["ClientID_hashed"]
    with pytest.raises(ValueError):
        deidentified_keys(spec(df.columns, {R.DATE_TIME: ("T",)}, keys=("T",)))


def test_pluggable_pandas_udfs(spark):
    from deidlake.functions.udfs import entities_udf, text_udf

    # defined inside the test: pickled by value (the test module is not
    # importable on Python workers)
    def _shout_factory():
        return lambda t: t.upper()

    def _fake_ner_factory():
        return lambda t: [("CHEMICAL", w) for w in t.split() if w.endswith("ole")] + [("OTHER", "x")]

    df = spark.createDataFrame([("note a", 1), ("", 2), (None, 3)], "NoteText string, ID long")
    out = deidentify(df, spec(df.columns, {R.FREE_TEXT: ("NoteText",)}), TEST_HASH_SALT, text_fn=text_udf(_shout_factory))
    assert dict((r["ID"], r["NoteText"]) for r in out.collect()) == {1: "NOTE A", 2: None, 3: None}
    ex = spark.createDataFrame([("take aripiprazole", 1), (None, 2)], "t string, id long")
    got = dict((r["id"], r["e"]) for r in ex.select("id", entities_udf(_fake_ner_factory)(ex.t).alias("e")).collect())
    assert got == {1: [[], ["aripiprazole"]], 2: [[], []]}


def test_row_hash_is_rekeyed_by_default(spark):
    from deidlake.constants import ROW_HASH_COLUMN
    from deidlake.functions.hashing import salted_sha256

    df = spark.createDataFrame([(1, "c", "abc")], f"ID long, ClientID string, {ROW_HASH_COLUMN} string")
    s = TableSpec("dbo.T", ("ID", "ClientID"), UpdateMode.FULL_UPDATE, {R.CLIENT_ID: ("ClientID",)})
    rekeyed = deidentify(df, s, TEST_HASH_SALT).collect()[0][ROW_HASH_COLUMN]
    expected = df.select(salted_sha256(ROW_HASH_COLUMN, TEST_HASH_SALT)).collect()[0][0]
    assert rekeyed == expected and rekeyed != "abc"
    assert deidentify(df, s, TEST_HASH_SALT, row_hash_mode="compat").collect()[0][ROW_HASH_COLUMN] == "abc"
    assert delete_layout(df, s, TEST_HASH_SALT).collect()[0][ROW_HASH_COLUMN] == rekeyed
