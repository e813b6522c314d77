"""Scored detectors against a plain version, and their odd rows."""

import re
from collections import Counter

from pyspark.sql import functions as F

from deidlake.functions.patterns import Pattern
from deidlake.operators.detect import CONTEXT_WORDS, Detector, detect

NUMBER = Detector(Pattern("PHONE_NUMBER", "[0-9]{7,9}", "0-9A-Za-z", "0-9A-Za-z"), 30)
CODE = Detector(Pattern("DATE_TIME", "[0-9]{4}-[0-9]{2}", "0-9", "0-9"), 60)
NAMES = [("Ann Lee", "PERSON"), ("Lee", "LOCATION"), ("Customer#0000012", "PERSON"), ("São Tomé", "LOCATION"), ("Ann", "PERSON")]
COLUMNS = ("entity", "span", "start", "end", "score")


def plain(text, names=NAMES, detectors=(NUMBER, CODE), context=CONTEXT_WORDS):
    words = [(m.start(), m.end(), m.group().lower()) for m in re.finditer(r"[^\W_]+", text or "")]

    def places(term):
        own = [w.lower() for w in re.findall(r"[^\W_]+", term)]
        for i in range(len(words) - len(own) + 1):
            if [w[2] for w in words[i:i + len(own)]] == own:
                yield words[i][0], words[i + len(own) - 1][1]

    found = {(label, a, b, 85) for term, label in names for a, b in places(term)}
    for d in detectors:
        p = d.pattern
        for m in re.finditer(f"(?<![{p.lead}])({p.body})(?![{p.trail}])", text or ""):
            found.add((p.entity, m.start(), m.end(), d.score))
    ends = {entity: [b for w in own for _, b in places(w)] for entity, own in context.items()}
    scored = []
    for label, a, b, score in found:
        if any(0 <= a - e <= 40 for e in ends.get(label, ())):
            score = min(100, max(score + 35, 40))
        if score >= 40:
            scored.append((-score, a - b, a, label, b))
    kept = []
    for s, _, a, label, b in sorted(scored):
        if all(b <= x[2] or x[3] <= a for x in kept):
            kept.append((label, text[a:b], a, b, -s))
    return Counter(kept)


TEXTS = [
    "Patient Ann Lee from São-Tomé, phone 1234567, ref 7654321; 2020-01",
    "Customer#0000012 called 0000012", "tel. 1234567 Lee 2020-01 Ann", "", None, "phone " + "x" * 40 + " 1234567", "ann LEE, lee ann",
    "mobile 😀 1234567 and 12345678 on 2020-01-02", "phone phone 7654321 phone", "Ann " * 3000 + "phone 1234567 " * 500,
]


def test_equals_the_plain_version(spark):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)] + [(0, TEXTS[0]), (None, TEXTS[1])], "id long, note string")
    names = spark.createDataFrame(NAMES, "term string, label string")
    got = {}
    for r in detect(df, ["id"], "note", names, (NUMBER, CODE)).collect():
        assert r["column_name"] == "note"
        got.setdefault(r["id"], Counter())[tuple(r[c] for c in COLUMNS)] += 1
    for i, t in enumerate(TEXTS):
        want = plain(t)
        assert got.get(i, Counter()) == (Counter({k: 2 for k in want}) if i == 0 else want), t
    assert got[None] == plain(TEXTS[1])


def test_context_decides(spark):
    df = spark.createDataFrame([(1, "ref 1234567"), (2, "phone 1234567"), (3, "1234567 phone")], "id long, note string")
    assert [tuple(r) for r in detect(df, ["id"], "note", detectors=(NUMBER,)).select("id", "entity", "score").collect()] == [(2, "PHONE_NUMBER", 65)]
    assert detect(df, ["id"], "note", detectors=(NUMBER,), context={}).isEmpty()
    assert detect(df, ["id"], "note", detectors=(NUMBER,), context={}, least=30).count() == 3


def test_default_detectors_and_empty_tables(spark):
    df = spark.createDataFrame([("write to a.b@example.org on 2020-01-02",)], "note string").withColumn("term", F.lit("x")).withColumn("label", F.lit(1))
    got = {r["entity"]: (r["span"], r["score"]) for r in detect(df, ["label"], "note").collect()}
    assert got["EMAIL_ADDRESS"] == ("a.b@example.org", 100) and got["DATE_TIME"] == ("2020-01-02", 95)
    none = spark.createDataFrame([], "term string, label string")
    assert detect(df.limit(0), ["label"], "note").isEmpty()
    assert detect(df, ["label"], "note", none, detectors=(), context={}).isEmpty()
