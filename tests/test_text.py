import duckdb
import pytest

from deidlake.functions import patterns as pat
from deidlake.operators.redact import pii_spans, redact_columns, redaction_audit

CASES = [
    "Write to john.doe@example.com or visit https://example.org/a?b=1 today",
    "Call +1 (743) 555-3824, or 555-123-4567; card 4785380592391139 stays",
    "Born 2023-08-16 at 15:20, seen 26th July 2023 and July 26, 2023 and 03/04/2020",
    "John Smith,Adam,Anna met in London,Paris,Berlin",
    "555-123-4567(743) 555-3824 and 555-123-4567+1 555 123 4567",
    "Londoner Johnson JohnSmith éLondon London_x xLondon",
    "a@b.co,c@d.io https://x.y/z,www.q.org",
    "a@b.co_c@d.io x.y@z.com.w@q.org+e@f.gh",
    "Mr Johnson Smith Robert Roberts at 12:30pm on 1/2/2020, 2020-01-02T10:11:12 in New York",
    "",
    None,
]


@pytest.fixture()
def texts(spark):
    return spark.createDataFrame(list(enumerate(CASES)), "id long, text string")


def duck_redact(text):
    con = duckdb.connect()
    expr = "NULLIF(?, '')"
    for p in pat.DEFAULT_PATTERNS:
        for _ in range(p.re2_passes):
            expr = f"regexp_replace({expr}, '{p.re2_regex.replace(chr(39), chr(39) * 2)}', '{p.re2_replacement}', 'g')"
    return con.execute(f"SELECT {expr}", [text]).fetchone()[0]


def test_one_pass_spark_equals_two_pass_re2(texts):
    got = dict((r[0], r[1]) for r in redact_columns(texts, ["text"]).collect())
    for i, t in enumerate(CASES):
        assert got[i] == duck_redact(t), (i, t)


def test_expected_redactions(texts):
    got = dict((r[0], r[1]) for r in redact_columns(texts, ["text"]).collect())
    assert got[0] == "Write to <EMAIL_ADDRESS> or visit <URL> today"
    assert "4785380592391139" in got[1] and got[1].count("<PHONE_NUMBER>") == 2
    assert got[2].count("<DATE_TIME>") == 5
    assert got[3] == "<PERSON>,<PERSON>,<PERSON> met in <LOCATION>,<LOCATION>,<LOCATION>"
    assert got[5] == "Londoner Johnson JohnSmith éLondon London_x xLondon".replace("Johnson", "<PERSON>")
    assert got[CASES.index("")] is None and got[CASES.index(None)] is None


def test_spans_and_audit(texts):
    spans = pii_spans(texts, ["id"], "text")
    got = sorted((r["id"], r["entity"], r["span"]) for r in spans.collect())
    assert (0, "EMAIL_ADDRESS", "john.doe@example.com") in got
    assert (1, "PHONE_NUMBER", "+1 (743) 555-3824") in got
    assert (3, "PERSON", "John Smith") in got
    audit = dict((r["entity"], (r["n_spans"], r["n_rows"])) for r in redaction_audit(spans, "id").collect())
    assert audit["LOCATION"][0] == 4 and audit["PERSON"][1] == 3


# hand-written: (id, entity, span, start) of the cases above, and of texts
# where a span follows another of a different length
EXPECTED = {
    0: [("EMAIL_ADDRESS", "john.doe@example.com", 9), ("URL", "https://example.org/a?b=1", 39)],
    1: [("PHONE_NUMBER", "+1 (743) 555-3824", 5), ("PHONE_NUMBER", "555-123-4567", 27)],
    3: [("PERSON", "John Smith", 0), ("PERSON", "Adam", 11), ("PERSON", "Anna", 16),
        ("LOCATION", "London", 28), ("LOCATION", "Paris", 35), ("LOCATION", "Berlin", 41)],
    6: [("EMAIL_ADDRESS", "a@b.co", 0), ("EMAIL_ADDRESS", "c@d.io", 7),
        ("URL", "https://x.y/z,www.q.org", 14)],
}


def test_span_offsets(texts):
    got = pii_spans(texts, ["id"], "text").collect()
    for i, want in EXPECTED.items():
        mine = sorted((r["start"], r["entity"], r["span"]) for r in got if r["id"] == i)
        assert mine == sorted((s, e, x) for e, x, s in want)
    for r in got:
        assert CASES[r["id"]][r["start"]:r["end"]] == r["span"]


def test_all_six_entities_with_offsets(spark):
    text = "é😀 Anna wrote a.b@c.org on 2023-08-16 from Paris, see https://x.org/y or call 555-123-4567."
    want = [("PERSON", "Anna"), ("EMAIL_ADDRESS", "a.b@c.org"), ("DATE_TIME", "2023-08-16"),
            ("LOCATION", "Paris"), ("URL", "https://x.org/y"), ("PHONE_NUMBER", "555-123-4567")]
    df = spark.createDataFrame([(1, text)], "id int, text string")
    got = sorted((r["start"], r["entity"], r["span"], r["end"]) for r in pii_spans(df, ["id"], "text").collect())
    assert got == sorted((text.index(s), e, s, text.index(s) + len(s)) for e, s in want)


def test_names_from_a_lexicon(spark):
    from deidlake.operators.redact import redact_names

    lexicon = spark.createDataFrame([("john", "PERSON"), ("Smith", "PERSON"), ("Priya Nair", "PERSON"), ("Date", "PERSON"),
                                     ("Prague", "LOCATION"), ("San Juan Bautista del Monte Alto", "LOCATION")],
                                    "term string, label string")
    cases = {
        "john smith and Priya Nair met in Prague": "<PERSON> and <PERSON> met in <LOCATION>",
        "Johnson, prague.": "Johnson, <LOCATION>.",
        "  <DATE_TIME> Date!": "  <DATE_TIME> <PERSON>!",
        "San Juan Bautista del Monte Alto": "<LOCATION>",
        "nothing here": "nothing here",
        "": "",
        None: None,
    }
    df = spark.createDataFrame([(i, t) for i, t in enumerate(cases)] * 2, "id int, text string")
    got = redact_names(df, "text", lexicon).collect()
    assert len(got) == 2 * len(cases)
    for r in got:
        assert r["text"] == list(cases.values())[r["id"]]
    exact = redact_names(df, "text", lexicon, case_sensitive=True).where("id = 0").first()["text"]
    assert exact == "<PERSON> smith and <PERSON> met in <LOCATION>"


def test_deidentify_takes_names(spark):
    from deidlake.operators.deidentify import deidentify
    from deidlake.spec import ColumnRole, TableSpec, UpdateMode

    names = spark.createDataFrame([("Priya", "PERSON")], "term string, label string")
    spec = TableSpec("dbo.N", ("k", "note"), UpdateMode.APPEND_AND_REMOVE, {ColumnRole.FREE_TEXT: ("note",)}, keys=("k",))
    df = spark.createDataFrame([(1, "priya Smith in London")], "k int, note string")
    assert deidentify(df, spec, "s", names=names).first()["note"] == "<PERSON> in <LOCATION>"


@pytest.mark.parametrize("k", [0, 1, 2, 3, 5, 10, 30_000])
def test_span_offsets_of_a_text_with_many_spans(spark, k):
    from deidlake.operators.redact import pii_spans

    text = "".join(f"some text {'é' * (i % 5)} mail{i}@example{i % 9}.org, " for i in range(k)) + "end"
    df = spark.createDataFrame([(1, text), (2, None), (3, "")], "id long, t string")
    found = [(r["start"], r["end"], r["span"]) for r in pii_spans(df, ["id"], "t", ("EMAIL_ADDRESS",)).collect()]
    assert len(found) == k and all(text[a:b] == span and "@" in span for a, b, span in found)
