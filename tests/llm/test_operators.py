"""Every operator against a plain version, on the small tables and on odd
rows (see ``odd``); empty tables give empty results."""

import base64
import collections
import hashlib
import random
import re
import zlib

import duckdb
import numpy as np
import pandas as pd
import public_tokenizers
import pytest
import tiktoken
import xxhash
from pyspark.sql import functions as F

from deidlake.llm import bpe, fingerprint, mixing, pii, quality, simhash, substring_dedup, toxicity, url_filter, warc
from deidlake.llm.common import word_hashes
from deidlake.llm.queries import ORACLES, QUERIES, RANKS

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")
PATH = public_tokenizers.path(RANKS)
sha = lambda b: hashlib.sha256(b).hexdigest()


def bag(rows):
    return collections.Counter(rows)


# ------------------------------------------------------------------------ 1

@pytest.fixture(scope="module")
def reference():
    lines = open(PATH, "rb").read()
    ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines.splitlines())}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}), bpe.Codec(lines)


def test_bpe_equals_the_library_on_random_texts(reference):
    library, codec = reference
    rnd = random.Random(1)
    parts = ["'", "s", "re", "ll", "d", " ", "  ", "\n", "\t", "\u00a0", "a", "é", "漢", "1", "²", "!", "''", "🙂", "\0", "\u0085", "_"]
    texts = ["".join(rnd.choice(parts) for _ in range(rnd.randint(0, 60))) for _ in range(3000)]
    texts += ["", "a" * 5000, " " * 3000, "ab" * 4000 + " x", "'s", "'"]
    ids, at, counts, by_text = codec.encode(texts)
    assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:])] == [library.encode_ordinary(t) for t in texts]
    data, bounds = codec.decode(ids.astype(np.int64), at)
    assert [data[a:b].tobytes() for a, b in zip(bounds[:-1], bounds[1:])] == [t.encode() for t in texts]
    assert counts.sum() == len(ids) and by_text[-1] == len(counts)


def test_bpe_classes_cover_every_letter_the_library_knows(reference):
    library, codec = reference
    texts = [f"a{chr(c)}a {chr(c)}1{chr(c)}" for c in range(0x80, 0x32000, 7) if not 0xD800 <= c < 0xE000]
    ids, at, _, _ = codec.encode(texts)
    assert [ids[a:b].tolist() for a, b in zip(at[:-1], at[1:])] == library.encode_ordinary_batch(texts)


@pytest.mark.parametrize("name", ["docs", "odd", "empty"])
def test_bpe_digests(request, reference, name):
    df = request.getfixturevalue(name)
    want = []
    for r in df.collect():
        ids = reference[0].encode_ordinary(r["text"] or "")
        want.append((r["doc_id"], len(ids), sha(",".join(map(str, ids)).encode()), sha((r["text"] or "").encode())))
    assert bag(map(tuple, bpe.digests(df, PATH).collect())) == bag(want)


def test_bpe_keeps_columns_and_decodes_alone(odd):
    coded = bpe.encode(odd, PATH)
    assert {"lang", "chunk", "ids", "piece_ids"} <= set(coded.columns)
    back = bpe.decode(coded, PATH).select("text", "decoded").collect()
    assert all(bytes(r["decoded"]).decode() == (r["text"] or "") for r in back)


# ------------------------------------------------------------------------ 2

def repeats(rows):
    seen, out = set(), []
    for i, t in sorted(((-1 << 63 if i is None else i, t or "") for i, t in rows)):
        ws = WORD.findall(t)
        gone = [False] * len(ws)
        for k in range(len(ws) - 19):
            g = tuple(ws[k:k + 20])
            if g in seen:
                gone[k:k + 20] = [True] * 20
            seen.add(g)
        kept = " ".join(w for w, x in zip(ws, gone) if not x)
        out.append((None if i == -1 << 63 else i, len(ws), sum(gone), sha(kept.encode())))
    return out


@pytest.mark.parametrize("name", ["docs", "odd", "empty"])
def test_substring_dedup(request, name):
    df = request.getfixturevalue(name)
    want = repeats([(r["doc_id"], r["text"]) for r in df.collect()])
    assert bag(map(tuple, substring_dedup.digests(df).collect())) == bag(want)


def test_substring_dedup_at_every_shift(spark):
    rnd = random.Random(2)
    words = lambda n: [f"w{rnd.randrange(10**6)}" for _ in range(n)]
    passage = words(26)
    rows = [(k, " ".join(words(k) + passage[:20 + k % 7] + words(3))) for k in range(60)] + [(99, "again " * 100)]
    got = substring_dedup.digests(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert bag(map(tuple, got)) == bag(repeats(rows))


# ------------------------------------------------------------------------ 3

def measures(text):
    text = text or ""
    ws = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    count = collections.Counter(tuple(ws[i:i + 3]) for i in range(len(ws) - 2))
    again = {i + k for i in range(len(ws) - 2) if count[tuple(ws[i:i + 3])] > 1 for k in range(3)}
    base = (len(ws), sum(map(len, ws)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(again))
    return (*base, base[0] < 50 or 100 * base[4] > 50 * base[0])


@pytest.mark.parametrize("name", ["docs", "odd", "empty"])
def test_quality_measures(request, name):
    df = request.getfixturevalue(name)
    got = quality.judge(df).collect()
    assert bag(tuple(r)[:-1] for r in got) == bag((r["doc_id"], *measures(r["text"])) for r in df.collect())
    assert not any(r["base_failed"] and r["kept"] for r in got)


def test_quality_verdict_does_not_depend_on_the_order(docs):
    rules = quality.BASE_RULES + quality.OWN_RULES
    m = quality.Measures(F.col("text"))
    rows = docs.select(quality.verdict(rules, m).alias("a"), quality.verdict(rules[::-1], m).alias("b")).collect()
    assert all(r["a"] == r["b"] for r in rows) and len({r["a"] for r in rows}) == 2
    order = quality.in_order([quality.Estimate(rules[0], 2.0, 0.1), quality.Estimate(rules[1], 1.0, 0.2)])
    assert [r.name for r in order] == [rules[1].name, rules[0].name]


# ------------------------------------------------------------------------ 4

EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"
PATTERNS = (EMAIL, r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]")


def plain_spans(text):
    digits = lambda s: re.sub("[^0-9]", "", s)

    def luhn(d):
        return sum(int(c) if k % 2 == 0 else sum(divmod(2 * int(c), 10)) for k, c in enumerate(reversed(d))) % 10 == 0

    ok = (lambda s: True, lambda s: all(int(x) <= 255 for x in s.split(".")),
          lambda s: 13 <= len(digits(s)) <= 19 and luhn(digits(s)), lambda s: 9 <= len(digits(s)) <= 15)
    return [(k, *m.span()) for k, p in enumerate(PATTERNS) for m in re.finditer(p, text) if ok[k](m.group())]


def test_pii_patterns_on_random_texts():
    rnd = random.Random(3)
    parts = ["a", "b@", "@", "c.d", "-", ".", "..", "1", "12", "255", "256", " ", "+", "(", ")", "_", "é", "4111 1111 1111 1111", "+1 555 123 4567"]
    for _ in range(5000):
        text = "".join(rnd.choice(parts) for _ in range(rnd.randint(0, 25)))
        assert pii.base_spans(text) == plain_spans(text)


@pytest.mark.parametrize("name", ["docs", "odd", "empty"])
def test_pii_base(request, name):
    df = request.getfixturevalue(name)
    want = []
    for r in df.collect():
        spans = plain_spans(r["text"] or "")
        text = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for k, a, b in spans)
        want.append((r["doc_id"], *(sum(k == x for x, _, _ in spans) for k in range(4)), sha(text.encode())))
    assert bag(tuple(r)[:6] for r in pii.digests(df).collect()) == bag(want)


def test_pii_removes_terms_that_disclose(spark):
    rows = [(i, f"the nice plumber zanzibar wrote from a.b@c.org about the work item{i}") for i in range(3)]
    rows += [(10 + i, f"the nice plumber wrote about the work and the weather of day{i}") for i in range(40)]
    out = {r["doc_id"]: r["text"] for r in pii.sanitise(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert "zanzibar" not in out[0] and "[EMAIL]" in out[0] and "plumber" in out[0] and "the work item0" in out[0]
    assert all(out[i] == t for i, t in rows if i >= 10)


def test_pii_counts_entities_without_neighbours(spark):
    """An entity that mostly stands alone isn't disclosed by a term that is as
    frequent elsewhere: n(e) counts every document with the entity."""
    rows = [(0, "x@y.org wrote to zanzibar"), (1, "x@y.org wrote to zanzibar")] + [(k, "x@y.org") for k in range(2, 30)]
    rows += [(k, "zanzibar wrote") for k in (30, 31)] + [(k, f"day {k}") for k in range(32, 60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = pii._scan(docs, "doc_id", "text")
    gains = {abs(round(r["disclosure"], 6)) for r in pii.disclosures(docs, found).collect()}
    assert gains == {0.0}  # n(e, t) = 2, n(t) = 4, n(e) = 30, N = 60: log(60 * 2 / (30 * 4)) / log(60 / 30)


def test_pii_estimates_pairs_seen_once(spark):
    """Where most pairs come again, one meeting tells too; where none does, it doesn't."""
    alone = [(0, "zebulon wrote from z@q.org today")]
    others = [(k, f"day {k} was today") for k in range(1, 300)]
    again = [(1000 + k, f"name{k // 2} wrote from a{k // 2}@q.org today") for k in range(60)]
    for rows, gone in ((alone + others + again, True), (alone + others, False)):
        docs = spark.createDataFrame(rows, "doc_id long, text string")
        out = {r["doc_id"]: r["text"] for r in pii.sanitise(docs).collect()}
        assert ("zebulon" not in out[0]) == gone and out[0].endswith("[EMAIL] today")
        # every pair has an estimate, that of a plain version
        words = {i: set(re.findall("[0-9a-z]+", re.sub(EMAIL, " ", t))) for i, t in rows}
        entity = {i: m.group() for i, t in rows if (m := re.search(EMAIL, t))}
        n_pair = collections.Counter((e, t) for i, e in entity.items() for t in words[i] if len(t) >= pii.SHORTEST_TERM)
        n_entity, n_term = collections.Counter(entity.values()), collections.Counter(t for ws in words.values() for t in ws)
        once, twice = (sum(n == k for n in n_pair.values()) for k in (1, 2))
        count = lambda n: n if n > 1 else min(1, max(2 * twice / once, 1e-9))
        want = [np.log(len(rows) * count(n) / (n_entity[e] * n_term[t])) / np.log(len(rows) / n_entity[e]) for (e, t), n in n_pair.items()]
        found = [r["disclosure"] for r in pii.disclosures(docs, pii._scan(docs, "doc_id", "text")).collect()]
        assert np.allclose(sorted(found), sorted(want))


def test_pii_sanitise_keeps_rows(odd, empty):
    out = pii.sanitise(odd)
    assert out.columns == odd.columns and out.count() == odd.count()
    assert out.where("text LIKE '[EMAIL] and [IP]%'").select("n_chars").first()[0] == len("[EMAIL] and [IP] 🙂 é")
    assert pii.sanitise(empty).count() == 0


# ------------------------------------------------------------------------ 5

def test_warc_round_trip(spark, tmp_path):
    body = "x" * 2000
    rows = [(1, "http://a/%0A\r\nb", body), (2, None, body), (2, None, body), (None, "u", body), (3, "v", "short"), (4, "w", "short"),
            (5, "z", None), (6, "", "é" * 300_000), (None, None, None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("digest", F.lit(1))
    want = []
    for i, _, html in rows:
        data = (html or "").encode()
        revisit = html == body and i != 2
        want.append((i, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", 2 if revisit else None))
    assert bag(map(tuple, warc.round_trip(pages).collect())) == bag(want)
    archive = warc.write(pages, str(tmp_path / "a"))
    assert {r["url"] for r in warc.read(spark, archive).collect()} == {u for _, u, _ in rows}
    found = warc.lookup(spark, archive, spark.createDataFrame([(6,), (3,), (77,)], "page_id long")).collect()
    assert {r["page_id"]: bytes(r["payload"]).decode() for r in found} == {6: "é" * 300_000, 3: "short"}
    none = warc.write(pages.limit(0), str(tmp_path / "b"))
    assert warc.read(spark, none).count() == 0


# ------------------------------------------------------------------------ 6

LOW = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def plain_fingerprint(text):
    ws = WORD.findall((text or "").translate(LOW))
    shingles = [" ".join(ws[i:i + 4]) for i in range(max(1, len(ws) - 3))] if ws else []
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


@pytest.mark.parametrize("name", ["docs", "odd", "empty"])
def test_simhash(request, name):
    df = request.getfixturevalue(name)
    rows = [(r["doc_id"], plain_fingerprint(r["text"])) for r in df.collect()]
    root = list(range(len(rows)))
    for i in range(len(rows)):
        for j in range(i):
            if bin(rows[i][1] ^ rows[j][1]).count("1") <= 4 and root[i] != root[j]:
                root = [root[j] if r == root[i] else r for r in root]
    least = {r: min((rows[i][0] for i in range(len(rows)) if root[i] == r and rows[i][0] is not None), default=None) for r in root}
    want = [(i, f"{fp:016x}", least[r]) for (i, fp), r in zip(rows, root)]
    assert bag(map(tuple, simhash.digests(df).collect())) == bag(want)
    kept = simhash.one_of_each(df)
    assert kept.columns == df.columns and kept.count() == len(set(root))


def test_simhash_refines_large_buckets(monkeypatch):
    rng = np.random.default_rng(1)
    fps = np.unique(np.array([sum(1 << int(b) for b in rng.choice(40, size=3)) for _ in range(700)], np.uint64))
    whole = simhash.links_within(fps)
    monkeypatch.setattr(simhash, "LARGE", 50)
    assert len(simhash.links_within(fps)) == len(whole)


def test_covering_masks_leave_no_pair_out():
    masks, rng = simhash.covering_masks(list(range(64))), np.random.default_rng(2)
    for _ in range(2000):
        diff = np.uint64(sum(1 << int(b) for b in rng.choice(64, size=4, replace=False)))
        assert (masks & diff == 0).any()


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(k, k + 1) for k in range(200)] + [(500, 501)], "a long, b long")
    got = {r["node"]: r["root"] for r in simhash.connected(edges).collect()}
    assert got == {**{k: 0 for k in range(1, 201)}, 501: 500}


# ------------------------------------------------------------------------ 7

def test_toxicity_held_out(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.1/{t}.parquet") for t in ("documents", "labels"))
    rows = toxicity.score(docs, labels).join(labels, "doc_id").where("held_out AND toxic IS NOT NULL").collect()
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in rows)
    toxic, clean = [r for r in rows if r["toxic"]], [r for r in rows if not r["toxic"]]
    assert sum(r["predicted"] for r in toxic) > 0.8 * len(toxic)
    assert sum(r["predicted"] for r in clean) < 0.01 * len(clean)


@pytest.mark.parametrize("share", [0.05, 0.3, 0.6])
def test_toxicity_at_any_share_of_toxic_documents(spark, share):
    """Toxic words, and a toxic pair of ordinary words, in two languages of
    which one is more often toxic."""
    rnd = random.Random(7)
    languages = [[f"{x}{k}" for k in range(300)] for x in ("en", "de")]
    rows, truth = [], {}
    for i in range(1200):
        toxic = rnd.random() < share
        language = languages[rnd.random() < (0.3 if toxic else 0.6)]
        ws = [language[int(300 * rnd.random() ** 2)] for _ in range(60)] + ["cold", "fish"]
        rnd.shuffle(ws)
        ws = [w for k, w in enumerate(ws) if not (w == "fish" and k and ws[k - 1] == "cold")]
        kind = i % 2 if toxic else None
        if toxic:
            ws[10:10] = ["scum"] * 2 if kind else ["cold", "fish"] * 3
        rows.append((i, " ".join(ws)))
        truth[i] = (int(toxic), kind)
    labels = spark.createDataFrame([(i, t) for i, (t, _) in truth.items()], "doc_id long, toxic int")
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    found = [(*truth[r["doc_id"]], r["predicted"]) for r in toxicity.score(docs, labels).where("held_out").collect()]
    clean, word, pair = ([p for t, k, p in found if (t, k) == kind] for kind in ((0, None), (1, 1), (1, 0)))
    assert sum(word) >= 0.8 * len(word) and sum(pair) >= 0.8 * len(pair) and sum(clean) <= 0.05 * len(clean)


def test_toxicity_counts_bigrams_that_share_a_slot(spark):
    """A toxic pair of ordinary words whose slot a more frequent bigram holds."""
    def numbers(words):
        return [toxicity.bigrams(np.frombuffer(w.encode(), np.uint8), np.array([0, len(w)]))[0][0] for w in words]

    first, second = ([f"{x}{k}" for k in range(3000)] for x in ("left", "right"))
    cold, fish = numbers(["cold", "fish"])
    keys = np.array(numbers(first))[:, None] * toxicity.WORDS + np.array(numbers(second))[None, :]
    i, j = np.argwhere(toxicity.pair_slot(keys.ravel()).reshape(keys.shape) == toxicity.pair_slot(np.array([cold * toxicity.WORDS + fish]))[0])[0]
    rnd = random.Random(3)
    rows, truth = [], {}
    for k in range(1000):
        truth[k] = int(rnd.random() < 0.2)
        ws = [f"w{int(200 * rnd.random())}" for _ in range(40)]
        ws[5:5] = ["cold", "fish"]
        ws[20:20] = [first[i], second[j]] * 3 if truth[k] else [first[i], "and", second[j], "or"] * 3
        rows.append((k, " ".join(ws)))
    labels = spark.createDataFrame(list(truth.items()), "doc_id long, toxic int")
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    model = toxicity.train(docs, labels)
    key = int(keys[i, j])
    assert key not in model.table.value.keys and model.weights().where(F.col("key") == key).first()["weight"] > toxicity.UNIT
    # scores are those of the whole texts, word by word
    weights = {r["key"]: r["weight"] / toxicity.UNIT for r in model.weights().collect()}
    scored = toxicity._raw(docs.unionByName(docs.where("doc_id < 20")), model, ["doc_id"]).select("doc_id", toxicity._score(model).alias("score")).collect()
    got = {r["doc_id"]: r["score"] for r in scored}
    assert len(scored) == 1020 and len(got) == 1000
    for k, text in rows[:50]:
        word, context, _ = toxicity.bigrams(np.frombuffer(text.encode(), np.uint8), np.array([0, len(text)]))
        odds = [float(model.table.value.word[w]) + weights.get(int(c) * toxicity.WORDS + int(w), 0) for w, c in zip(word, context)]
        want = model.curve.score(np.array([sum(odds) / len(odds)]), np.array([len(odds)]))[0]
        assert abs(got[k] - want) < 1e-6
    kept = {r["doc_id"] for r in toxicity.without_toxic(docs, labels).collect()}
    assert kept == {k for k, x in got.items() if x < 0.5}


def test_toxicity_curve_is_fitted_to_all_rows_of_its_fold(spark):
    """More labelled rows than were once drawn; those of other folds don't count."""
    ids = [i for i in range(150_000) if zlib.crc32(str(i).encode()) % 5 in (toxicity.CALIBRATION, 1)]
    rnd = random.Random(5)
    rows = [(i, rnd.gauss(0.02, 0.1)) for i in ids]
    labels = {i: int(rnd.random() < 1 / (1 + np.exp(-20 * x + 1))) for i, x in rows}
    model = toxicity.Model(None, None, toxicity.Curve(0.5))
    raw = spark.createDataFrame(pd.DataFrame(rows, columns=["doc_id", "mean"]))
    toxicity._calibrate(model, raw, spark.createDataFrame(pd.DataFrame(list(labels.items()), columns=["doc_id", "toxic"])))
    own = [(x, labels[i]) for i, x in rows if zlib.crc32(str(i).encode()) % 5 == toxicity.CALIBRATION]
    assert len(own) > 25_000
    x, y = np.array(own).T
    want = toxicity.fit_curve(x, y, np.ones(len(x)))
    assert np.allclose((model.curve.slope, model.curve.shift), want, rtol=1e-5)


def test_toxicity_odd_rows(spark, odd, empty):
    labels = spark.createDataFrame([(4, 1, 0), (5, 0, 1), (6, 1, None), (None, 0, 1)], "doc_id long, quality int, toxic int")
    out = toxicity.score(odd, labels).collect()
    assert len(out) == odd.count() and all(0 <= r["score"] <= 1 for r in out)
    assert toxicity.score(empty, labels).count() == 0
    assert toxicity.without_toxic(odd, labels.limit(0)).count() == odd.count()


# ------------------------------------------------------------------------ 8

def plain_url(url):
    url = url or ""
    rest = url.partition("://")[2] if "://" in url else ""
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host):]).group()
    host = host.translate(LOW)
    best = None
    for rule, verdict in sorted(url_filter.RULES, key=lambda r: len(r[0])):
        name, slash, start = rule.partition("/")
        if (host == name or host.endswith("." + name)) and path.startswith(slash + start):
            best = rule, verdict
    return host, path, *(best or (None, None))


def test_url_rules(spark):
    urls = ["http://A.Example.NET/en/1?x", "https://example.net/en", "x://net", "x://net/", "no scheme", None, "", "a://b://c/d#e",
            "http://example.com/de/7", "http://notexample.com/de/7", "http://m.org/fr/x", "ftp://É.org/fr/", "http://h/a\nb?c"]
    pages = spark.createDataFrame([(k, u) for k, u in enumerate(urls)] + [(None, urls[0])], "page_id long, url string")
    for r in url_filter.judge(pages.withColumn("host", F.lit("own"))).collect():
        host, path, rule, verdict = plain_url(urls[r["page_id"] or 0])
        assert (r["host"], r["path"], r["rule"], r["verdict"]) == (host, path, rule, verdict or "allow")
    assert url_filter.judge(pages.limit(0)).count() == 0


def test_url_templates_generalise_merge_and_reject(spark):
    rows = [(f"http://h/spam/{k}.html", 1 if k < 30 else None) for k in range(60)]
    rows += [(f"http://h/junk/{k}.html", 1 if k < 6 else None) for k in range(12)]  # too few alone, merged with /spam/
    rows += [(f"http://h/good/{k}", 0 if k < 30 else None) for k in range(60)]
    rows += [(f"http://g/{'abcdefghij'[k % 10]}{'klmnopqrst'[k // 10]}x", None) for k in range(60)]
    pages = spark.createDataFrame([(k, u, y) for k, (u, y) in enumerate(rows)], "page_id long, url string, y int")
    got = {rows[r["page_id"]][0]: r["verdict"] for r in url_filter.judge(pages, rules=(), label=F.col("y")).collect()}
    assert {u: v for u, v in got.items() if v == "block"}.keys() == {u for u, _ in rows if "/spam/" in u or "/junk/" in u}
    found = url_filter.branches(url_filter.templates(pages.select(
        url_filter.host_of(F.col("url")).alias("host"), url_filter.path_of(F.col("url")).alias("path"), F.col("y").alias("label"))))
    assert {(tuple(r["template"]), r["labels"], round(r["purity"], 6)) for r in found.collect()} == {
        (("spam", "*"), 36, round((36 + 5 * 36 / 66) / 41, 6)), (("junk", "*"), 36, round((36 + 5 * 36 / 66) / 41, 6)),
        (("good", "*"), 30, round(5 * 36 / 66 / 35, 6))}
    urls = pages.select(url_filter.host_of(F.col("url")).alias("host"), url_filter.path_of(F.col("url")).alias("path"), F.col("y").alias("label"))
    assert {tuple(r["template"]) for r in url_filter.templates(urls).where("host = 'g'").collect()} == {("*",)}


def test_url_small_branches_are_merged_before_they_are_judged(spark):
    """A host with 24 sections of 4 rejected labels each, one without labels;
    another with accepted ones beside a section without labels."""
    word = lambda k: "abcdefghij"[k // 10] * 3 + "klmnopqrst"[k % 10]
    rows = [(f"http://bad/{word(k)}/{i}", 1 if k else None) for k in range(25) for i in range(4)]
    rows += [(f"http://mixed/{word(k)}/{i}", k % 2 if k else None) for k in range(25) for i in range(4)]
    rows += [(f"http://fine/{word(k)}/{i}", 0 if k else None) for k in range(25) for i in range(4)]
    pages = spark.createDataFrame([(k, u, y) for k, (u, y) in enumerate(rows)], "page_id long, url string, y int")
    got = {rows[r["page_id"]][0]: r["verdict"] for r in url_filter.judge(pages, rules=(), label=F.col("y")).collect()}
    assert all((v == "block") == (u.startswith("http://bad/") or ("mixed" in u and dict(rows)[u] == 1)) for u, v in got.items())
    # verdicts of rules don't reach the paths beside theirs
    rows = [(k, f"http://example.com/{'de' if k < 50 else 'en'}/{k}") for k in range(100)]
    ruled = url_filter.judge(spark.createDataFrame(rows, "page_id long, url string")).collect()
    assert all((r["verdict"] == "block") == (r["page_id"] < 50) for r in ruled)


def test_url_templates_of_copies_and_below_wildcards(spark):
    """Every URL twice; several pages for each name; names below names; and
    sections with many pages each, which stay."""
    word = lambda k: "abcdefghij"[k // 10] * 3 + "klmnopqrst"[k % 10]
    paths = [("u", f"/user/{word(k)}/{x}") for k in range(40) for x in ("home", "mail")]
    paths += [("v", f"/{word(k)}/x{word(k + i)}") for k in range(40) for i in (1, 2)]
    paths += [("s", f"/sec{word(k)}/page{word(i)}") for k in range(31) for i in range(60)]
    urls = spark.createDataFrame([(h, p, None) for h, p in paths * 2], "host string, path string, label int")
    got = {}
    for r in url_filter.templates(urls).collect():
        got.setdefault(r["host"], set()).add(tuple(r["template"]))
    assert got["u"] == {("user", "*", "home"), ("user", "*", "mail")}
    assert got["v"] == {("*", "*")}
    assert got["s"] == {(f"sec{word(k)}", "*") for k in range(31)}


# ------------------------------------------------------------------------ 9

@pytest.mark.parametrize("name", ["docs", "odd", "empty"])
def test_fingerprints_of_edited_texts(request, name):
    df = request.getfixturevalue(name)
    got = fingerprint.edited(df).collect()
    prints = bag(map(tuple, fingerprint.fingerprints(df).collect()))
    assert prints == bag((r["doc_id"], r["fingerprint"]) for r in got)
    tie = lambda t: hashlib.sha256(t.encode()).digest()[:8]
    rows = sorted(((-1 << 63 if r["doc_id"] is None else r["doc_id"], tie(r["text"] or ""), r["text"] or "") for r in df.collect()), reverse=True)
    want = []
    for k, (i, _, t) in enumerate(rows):
        half = len(t) // 2
        e = t[:len(t) - half] + rows[(k + 1) % len(rows)][2][:half]
        want.append((None if i == -1 << 63 else i, len(t), sha(e.encode())))
    assert bag((r["doc_id"], r["n_chars"], r["edited_sha256"]) for r in got) == bag(want)
    assert all(0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1 for r in got)


def test_likeness_of_very_long_texts():
    """More shingles than 2^16: the count must not wrap."""
    lines = [" ".join(f"w{k}x{i}" for i in range(10)) for k in range(10_000)]
    def of(ls):
        data = np.frombuffer("\n".join(ls).encode(), np.uint8)
        return fingerprint.vectors(data, np.array([0, len(data)]))
    whole = of(lines)
    assert (fingerprint.add(of(lines[:9_000]), of(lines[9_000:])) == whole).all()
    assert (fingerprint.subtract(whole, of(lines[9_000:])) == of(lines[:9_000])).all()
    assert abs(fingerprint.likeness(whole, of(lines[:9_000] + [x.replace("w", "v") for x in lines[9_000:]]))[0] - 0.9) < 0.05


@pytest.mark.parametrize("times", [100, 70_000])
def test_likeness_of_repeated_lines(times):
    """Counts of lines, n of one and none of others: 1 - |a - b|^2 / (|a|^2 + |b|^2)."""
    def of(*lines):
        data = np.frombuffer("".join((" ".join(f"{x}{i}" for i in range(10)) + "\n") * n for x, n in lines).encode(), np.uint8)
        return fingerprint.vectors(data, np.array([0, len(data)]))

    whole, half, other = of(("a", times)), of(("a", times // 2), ("b", times // 2)), of(("c", times))
    assert abs(fingerprint.likeness(whole, half)[0] - 2 / 3) < 0.15
    assert fingerprint.likeness(whole, other)[0] < 0.3
    assert fingerprint.likeness(of(("a", 1 << 16)), of(("c", 1 << 16)))[0] < 0.3  # no multiple of 2^16 cancels
    assert (of(("a", 1 << 16))[:, :fingerprint.EXACT] != of(("c", 1 << 16))[:, :fingerprint.EXACT]).any()
    assert (fingerprint.subtract(half, of(("b", times // 2))) == of(("a", times // 2))).all()


def test_fingerprint_is_a_multiset_hash():
    def of(text):
        data = np.frombuffer(text.encode(), np.uint8)
        return fingerprint.vectors(data, np.array([0, len(data)]))

    a, b = "one two three four\nfive six seven\neight", "nine ten eleven twelve"
    assert (of(a + "\n" + b) == fingerprint.add(of(a), of(b))).all()
    assert (fingerprint.subtract(of(b + "\n" + a), of(b)) == of(a)).all()
    assert (of("x\ny\ny") == of("y\nx\ny")).all() and (of("x\ny") != of("x\ny\ny")).any()
    words = [f"w{k}" for k in range(400)]
    text, other = " ".join(words), " ".join(words[:200] + [f"v{k}" for k in range(200)])
    assert abs(fingerprint.likeness(of(text), of(other))[0] - 0.5) < 0.15
    assert fingerprint.likeness(of(text), of(text))[0] == 1


# ----------------------------------------------------------------------- 10

def plain_targets(sizes):
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: (5, 2, 1)[k % 3] for k, s in enumerate(names)}
    rest, free, out = sum(sizes.values()), set(names), {}
    while free:
        share = rest / sum(weight[s] for s in free)
        over = [s for s in free if share * weight[s] > 3 * sizes[s]]
        if not over:
            out |= {s: share * weight[s] for s in free}
            break
        for s in over:
            out[s] = 3 * sizes[s]
            rest -= out[s]
            free.discard(s)
    return out


@pytest.mark.parametrize("name", ["docs", "odd", "empty"])
def test_mixing(request, name):
    df = request.getfixturevalue(name)
    out = mixing.with_copies(df)
    got = out.collect()
    sizes = collections.Counter()
    for r in df.collect():
        sizes[r["source"]] += len(WORD.findall(r["text"] or ""))
    targets = plain_targets(sizes)
    for r in got:
        assert r["source_size"] == sizes[r["source"]] and abs(r["target"] - targets[r["source"]]) < 1e-6 * (1 + r["target"])
        assert r["taken"] == r["copies"] * r["size"] <= 3 * r["size"]
    for s in sizes:  # copies: one per boundary crossed
        rows = [r for r in got if r["source"] == s]
        if sizes[s]:
            assert abs(sum(r["copies"] for r in rows) - len(rows) * targets[s] / sizes[s]) < 1 + 1e-6
    again = mixing.with_copies(df.repartition(3)).collect()
    key = lambda rows: bag((r["doc_id"], r["text"], r["copies"]) for r in rows)
    assert key(got) == key(again)
    mixed = mixing.mix(df)
    assert mixed.count() == sum(r["copies"] for r in got)


# ------------------------------------------------------- clashing columns

def test_operators_that_keep_rows_keep_columns_of_any_name(spark, odd):
    """Names of the operators' own columns, in the input."""
    names = ("id", "tie", "doc", "own", "spans", "number", "row", "root", "fp", "__id", "__text", "__spans", "__row",
             "__source", "__group", "copy", "copies", "size", "target", "Taken", "score", "toxic", "fold")
    docs = odd.withColumns({n: F.concat(F.lit(n), F.col("doc_id").cast("string")) for n in names})
    rows = bag(r["__id"] for r in docs.collect())
    labels = spark.createDataFrame([(k, k % 2) for k in range(40)], "doc_id long, toxic int")
    for out in (toxicity.without_toxic(docs, labels), simhash.one_of_each(docs), pii.sanitise(docs), mixing.mix(docs)):
        assert out.columns == docs.columns
        assert all(r[n] is None or r[n] == f"{n}{r['doc_id']}" for r in out.collect() for n in names)
    assert bag(r["__id"] for r in pii.sanitise(docs).collect()) == rows
    assert bag(r["__id"] for r in mixing.with_copies(docs).collect()) == rows
    coded = bpe.encode(docs.withColumn("text_", F.lit("x")), PATH)
    assert bag(r["__id"] for r in coded.collect()) == rows


# ------------------------------------------------------------------ queries

@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "conversations", "embeddings"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = QUERIES[name](spark, SF)
    want = con.execute(ORACLES[name])
    assert sorted(c[0] for c in want.description) == sorted(df.columns)
    names = [c[0] for c in want.description]
    assert bag(map(tuple, df.select(*names).collect())) == bag(want.fetchall())


def test_pipeline(spark):
    import corpus_pipeline as p

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert [n for n, _ in p.STAGES] == ["toxicity", "simhash_near_dedup", "pii", "mixing", "bpe"]
    for _, stage in p.STAGES[:-1]:
        before, docs = docs, stage(spark, docs, SF)
        assert docs.columns == before.columns
        docs = docs.persist()
    assert bag(map(tuple, p.run(spark, SF).collect())) == bag(map(tuple, bpe.digests(docs, PATH).collect()))


def test_urls_without_a_rule_are_allowed(spark):
    """No URL fits a rule, so there are no labels at all."""
    rows = [(i, f"http://host{i % 3}.info/user/{i}/x") for i in range(60)] + [(100, None), (101, "no url"), (102, "://")]
    got = url_filter.judge(spark.createDataFrame(rows, "page_id long, url string")).collect()
    assert sorted(r["page_id"] for r in got) == sorted(i for i, _ in rows)
    assert {(r["rule"], r["verdict"]) for r in got} == {(None, "allow")}


# ----------------------------------------------------------- strong hashes

def _thue_morse(steps: int = 10) -> tuple[str, str]:
    a, b = "a", "b"
    for _ in range(steps):
        a, b = a + b, b + a
    return a, b


def test_words_built_to_collide_are_told_apart(spark):
    """Equal under every polynomial modulo 2^64 with an odd base."""
    a, b = _thue_morse()
    for words in ([a, b], [a, a + "x"], ["x" + a, "x" + b], ["\0", "\0\0"]):
        data = " ".join(words).encode()
        start = np.cumsum([0] + [len(w) + 1 for w in words[:-1]])
        hashes = word_hashes(np.frombuffer(data, np.uint8), start, start + [len(w) for w in words])
        assert hashes[0] != hashes[1]
    same = word_hashes(np.frombuffer(f" {a}  {b} {a}".encode(), np.uint8), np.array([1, 1027, 2052]), np.array([1025, 2051, 3076]))
    assert same[0] == same[2] != same[1]
    tail = " ".join(f"w{i}" for i in range(20))
    frame = spark.createDataFrame([(1, f"{a} {tail}"), (2, f"{b} {tail}"), (3, a), (4, b)], "doc_id long, text string")
    # the 20 words after the first repeat, the first word doesn't
    assert {r["id"]: r["n_removed"] for r in substring_dedup.remove_repeats(frame).collect()} == {1: 0, 2: 20, 3: 0, 4: 0}
    one_window = spark.createDataFrame(
        [(k, f"{w} " + " ".join(f"w{i}" for i in range(19))) for k, w in ((1, a), (2, b), (3, a))], "doc_id long, text string")
    assert {r["id"]: r["n_removed"] for r in substring_dedup.remove_repeats(one_window).collect()} == {1: 0, 2: 0, 3: 20}
    prints = {r["doc_id"]: r["fingerprint"] for r in fingerprint.fingerprints(frame).collect()}
    assert len(set(prints.values())) == 4


def test_mixing_numbers_alone_read_no_other_column(docs):
    out = mixing.copies(docs)
    assert bag(map(tuple, out.collect())) == bag(map(tuple, mixing.with_copies(docs).select(*out.columns).collect()))
    plan = out._jdf.queryExecution().executedPlan().toString()
    for line in plan.splitlines():  # the text ends in the projection above its scan
        if "Exchange" in line or "Sort" in line:
            assert "text" not in line
