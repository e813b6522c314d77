import base64
import json
import re
import uuid

import pytest

from deidlake.functions.patterns import ENTITY_LEXICON
from deidlake.operators.entities import entity_counts, extract_entities, lexicon_df, nested_entities
from deidlake.operators.provision import TableRequest, decode_request, encode_request, provision, request_entries
from deidlake.operators.validate import SchemaValidationError, drift_report, schema_drift, validate
from deidlake.spec import TableSpec, UpdateMode, spec_df

TEXTS = [
    "Patient was diagnosed with paranoid schizophrenia on 26th July 2023 and is treated with aripiprazole.",
    "Nothing to be extracted",
    None,
    "",
    "Lithium carbonate and lithium; Type 2 diabetes, diabetes. Major depressive disorder and depression",
]


def brute_force(text):
    """Reference implementation in plain Python for the fixture texts."""
    if not text:
        return []
    toks = re.split(r"[^\w]+|_", text)
    lex = {t: lab for t, lab in ENTITY_LEXICON}
    cands = []
    for i in range(len(toks)):
        for n in range(1, 5):
            words = toks[i:i + n]
            if len(words) == n and all(words) and " ".join(words).lower() in lex:
                cands.append((-n, i, lex[" ".join(words).lower()], " ".join(words)))
    taken, out = set(), []
    for neg_n, i, lab, txt in sorted(cands):
        span = set(range(i, i - neg_n))
        if not span & taken:
            taken |= span
            out.append((lab, i, txt))
    return sorted(out)


def test_entities_match_brute_force_and_fixture(spark):
    df = spark.createDataFrame(list(enumerate(TEXTS)), "ID long, NoteText string")
    long = extract_entities(df, ["ID"], "NoteText")
    got = {}
    for r in long.collect():
        got.setdefault(r["ID"], []).append((r["label"], r["pos"], r["text"]))
    for i, t in enumerate(TEXTS):
        assert sorted(got.get(i, [])) == brute_force(t), i
    nested = dict((r["ID"], r["NoteText_feature_extraction"]) for r in nested_entities(df, ["ID"], "NoteText", long).collect())
    assert nested[0] == [["paranoid schizophrenia"], ["aripiprazole"]]
    assert nested[1] == [[], []] and nested[2] == [[], []] and nested[3] == [[], []]
    counts = dict(((r["label"], r["term"]), r["n_mentions"]) for r in entity_counts(long).collect())
    assert counts[("CHEMICAL", "lithium")] == 1


def test_custom_lexicon(spark):
    df = spark.createDataFrame([(1, "Take Foo Bar daily")], "id long, t string")
    lex = lexicon_df(spark, [("foo bar", "CHEMICAL")])
    assert [(r["label"], r["text"]) for r in extract_entities(df, ["id"], "t", lex).collect()] == [("CHEMICAL", "Foo Bar")]


def test_terms_of_any_length(spark):
    df = spark.createDataFrame([(1, "an acute severe chronic left heart failure today")], "id long, t string")
    lex = lexicon_df(spark, [("Acute severe chronic left heart failure", "DISEASE"), ("heart", "CHEMICAL")])
    assert [tuple(r) for r in extract_entities(df, ["id"], "t", lex).collect()] == [
        (1, "DISEASE", 1, "acute severe chronic left heart failure")]
    assert extract_entities(df, ["id"], "t", lex.limit(0)).count() == 0


def test_entities_of_null_and_repeated_ids(spark):
    rows = [(None, "has depression"), (1, "has depression"), (1, "took lithium, depression"), (2, "lithium"), (2, "lithium")]
    df = spark.createDataFrame(rows, "id long, t string")
    lex = lexicon_df(spark, [("depression", "DISEASE"), ("lithium", "CHEMICAL")])
    assert extract_entities(df, ["id"], "t", lex).count() == 6
    nested = nested_entities(df, ["id"], "t", extract_entities(df, ["id"], "t", lex, by_text=True)).collect()
    assert len(nested) == 5
    assert {(r["id"], r["t"]): r["t_feature_extraction"] for r in nested} == {
        (None, "has depression"): [["depression"], []], (1, "has depression"): [["depression"], []],
        (1, "took lithium, depression"): [["depression"], ["lithium"]], (2, "lithium"): [[], ["lithium"]]}


def test_catalog_keeps_empty_tables_and_columns_without_values(spark):
    from deidlake.operators.validate import live_columns

    tables = {"a": spark.createDataFrame([(1, None)], "x long, y string"), "b": spark.createDataFrame([], "z long")}
    assert sorted(map(tuple, live_columns(tables).collect())) == [("dbo", "a", "x", 1), ("dbo", "a", "y", 1), ("dbo", "b", "z", 0)]


def test_each_model_factory_has_its_own_model(spark):
    from pyspark.sql import functions as F

    from deidlake.functions.udfs import entities_udf, text_udf

    def replacing(token):
        return lambda: lambda text: token

    def finding(token):
        return lambda: lambda text: [("DISEASE", token)]

    df = spark.createDataFrame([("t",)], "t string").coalesce(1)
    for token in "ABC":
        assert df.select(text_udf(replacing(token))(F.col("t"))).first()[0] == token
        assert df.select(entities_udf(finding(token))(F.col("t"))).first()[0] == [[token], []]


def test_no_private_folder_off_a_local_master():
    import pytest

    from deidlake.session import checkpoint_dir

    class Context:
        master = "spark://host:7077"

        def getConf(self):
            return {}

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext, conf = Context(), {}

    with pytest.raises(RuntimeError):
        checkpoint_dir(Session())


def test_schema_validation_report(spark):
    live = spark.createDataFrame(
        [("dbo.AmsAppointment", c) for c in ("SequenceID", "Location", "Comment", "SuperUnclassified")]
        + [("dbo.SomeNonsenseToBeUnclassified", "SequenceID")]
        + [("dbo.PrgProgressNote", c) for c in ("SequenceID", "ClientID", "DateAndTime", "NoteText")],
        "table_name string, column_name string")
    specs = [
        TableSpec("dbo.AmsAppointment", ("SequenceID", "Location", "Comment", "Missing"), UpdateMode.FULL_UPDATE),
        TableSpec("dbo.PrgProgressNote", ("SequenceID", "ClientID", "DateAndTime", "NoteText"), UpdateMode.FULL_UPDATE),
        TableSpec("dbo.Gone", ("a",), UpdateMode.FULL_UPDATE),
    ]
    report = drift_report(schema_drift(live, spec_df(spark, specs)))
    assert report["unclassified_tables"] == ["dbo.SomeNonsenseToBeUnclassified"]
    assert report["classified_but_unexisting_tables"] == ["dbo.Gone"]
    assert report["analysed_tables"] == {"dbo.AmsAppointment": {
        "unclassified_columns": ["SuperUnclassified"], "classified_but_unexisting_columns": ["Missing"]}}
    with pytest.raises(SchemaValidationError) as e:
        validate(live, spec_df(spark, specs))
    assert json.loads(str(e.value).split(": ", 1)[1])["classified_but_unexisting_tables"] == ["dbo.Gone"]
    ok = live.where("table_name = 'dbo.PrgProgressNote'")
    validate(ok, spec_df(spark, specs[1:2]))


def test_request_decoding_rules():
    req = {"orders": TableRequest(("a", "b"), "a > 1")}
    enc = encode_request(req)
    ws = str(uuid.uuid4())
    assert decode_request(enc, ws) == req
    for bad_query, bad_ws, msg in [
        (None, ws, "is required"), (enc, None, "is required"), (enc, "nope", "UUID"),
        ("%%%", ws, "base64"), (base64.b64encode(b"{not json").decode(), ws, "JSON"),
    ]:
        with pytest.raises(ValueError, match=msg):
            decode_request(bad_query, bad_ws)


def test_provision_filter_then_project_pushes_down(spark, tmp_path):
    path = str(tmp_path / "gold")
    spark.createDataFrame([(1, "F", 5.0), (2, "O", 7.0)], "k long, s string, p double").write.parquet(path)
    df = provision(spark.read.parquet(path), ["k", "p"], "s = 'F'")
    assert [tuple(r) for r in df.collect()] == [(1, 5.0)]
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(s), EqualTo(s,F)]" in plan
    assert "ReadSchema: struct<k:bigint,s:string,p:double>" in plan
    parsed = spark.createDataFrame([(encode_request({"t": TableRequest(("x",), None)}),)], "q string")
    m = parsed.select(request_entries(parsed.q).alias("m")).collect()[0]["m"]
    assert m["t"]["columns"] == ["x"] and m["t"]["where_statement"] is None


def test_entities_of_a_text_with_many_hits(spark):
    """Islands of overlapping terms in one text of 60,000 words, and terms of
    different lengths that begin with the same word."""
    lex = [("a b", "DISEASE"), ("b c d", "CHEMICAL"), ("d e", "DISEASE"), ("x", "CHEMICAL"), ("x y z w v u", "DISEASE")]
    unit = "a b c d e x x y z w v u q "
    df = spark.createDataFrame([(1, unit * 5000)], "id long, t string")
    got = extract_entities(df, ["id"], "t", lexicon_df(spark, lex)).collect()
    # "b c d" wins over "a b" and "d e"; the long term over the "x" it begins with
    want = [(13 * k + at, label, text) for k in range(5000)
            for at, label, text in ((1, "CHEMICAL", "b c d"), (5, "CHEMICAL", "x"), (6, "DISEASE", "x y z w v u"))]
    assert sorted((r["pos"], r["label"], r["text"]) for r in got) == want


def test_entity_plan_makes_word_sequences_at_begun_terms_only(spark):
    df = spark.createDataFrame([(1, "a b c")], "id long, t string")
    plan = extract_entities(df, ["id"], "t", lexicon_df(spark, [("a b", "DISEASE")]))._jdf.queryExecution().optimizedPlan().toString()
    assert "posexplode" in plan and "arrays_zip" not in plan
