"""Prefix trie, collocations and embedding near-duplicates against plain
versions, on random and odd rows."""

import collections
import hashlib
import itertools
import math
import random
import re
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from deidlake.llm import collocations, embedding_dedup, prefix_trie
from deidlake.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def bag(rows):
    return collections.Counter(map(tuple, rows))


@pytest.mark.parametrize("name", ["op11_prefix_trie", "op12_collocations", "op13_embedding_dedup"])
def test_query_equals_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "embeddings", "conversations"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    want = con.sql(ORACLES[name])
    got = QUERIES[name](spark, SF)
    assert set(got.columns) == set(want.columns)
    assert bag(got.select(*want.columns).collect()) == bag(want.fetchall())


# ----------------------------------------------------------------------- 11

def plain_trie(rows):
    """rows: (conv_id, turn, role, text)."""
    own = collections.defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append((turn is not None, turn or 0, role or "", text or ""))
    # equal turns: by the hash of role and text, as the operator says
    order = lambda r: (r[0], r[1], hashlib.sha256(f"{len(r[2])}:{r[2]}{r[3]}".encode()).digest()[:16])
    turns = {c: [(r[2], r[3]) for r in sorted(v, key=order)] for c, v in own.items()}
    whole = {}
    for c in turns:
        h = zlib.crc32(str(c).encode()) % 4
        whole[c] = tuple(turns.get(c - int(math.fmod(c, 20)), [])[:h] + turns[c][h:])
    members = collections.defaultdict(list)
    for c, s in whole.items():
        for d in range(len(s) + 1):
            members[s[:d]].append(c)
    out = []
    for node, convs in members.items():
        below = [u for u in members if u[:len(node)] == node]
        ends = sorted(c for c in convs if len(whole[c]) == len(node))
        out.append((
            min(convs), len(node), min(members[node[:-1]]) if node else None, len(convs), sum(len(u) == len(node) + 1 for u in below),
            sum(not any(len(x) == len(u) + 1 and x[:len(u)] == u for x in members) for u in below),
            sum((len(members[u]) - 1) * len(WORD.findall(u[-1][1])) for u in below if u),
            hashlib.sha256(",".join(map(str, ends)).encode()).hexdigest()))
    return out


def check_trie(spark, rows):
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    df = df.select("*", *[F.lit("own").alias(c) for c in ("conv", "part", "key", "words", "hash", "depth")])
    assert bag(prefix_trie.trie(df).collect()) == bag(plain_trie(rows))


def test_trie_of_random_families(spark):
    rnd = random.Random(3)
    rows = []
    for c in rnd.sample(range(-45, 130), 110):
        for turn in range(rnd.choice([1, 1, 2, 3, 4, 6])):
            rows.append((c, turn, rnd.choice(["user", "assistant"]), rnd.choice(["a", "b b", "", "c d e"])))
    check_trie(spark, rows)


def test_trie_of_odd_rows(spark):
    rnd = random.Random(4)
    long = " ".join(f"word{i}" for i in range(20_000))
    rows = [(None, 0, "user", "x"), (None, None, None, None), (1, None, None, None), (1, None, None, None), (1, 0, "user", long),
            (2, 5, None, "tie"), (2, 5, "", "tie"), (2, 5, "user", "tie one"), (2, 5, "user", "tie two"), (40, 0, "u", " \t\n"), (41, 0, "u", "")]
    rows += [(200 + i, t, "user", "same words") for i in range(40) for t in range(3)]  # many copies
    rows += [(60, t, "user", rnd.choice("ab")) for t in range(250)]  # a long one, over several pieces
    rows += [(61, t, "user", "x") for t in range(3)] + [(9223372036854775807, 0, "u", "t"), (-9223372036854775808, 0, "u", "t")]
    check_trie(spark, rows)


def test_trie_of_no_rows(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert prefix_trie.trie(df).collect() == []
    assert prefix_trie.trie(spark.createDataFrame([(None, 1, "u", "x")], df.schema)).collect() == []


def test_role_and_text_are_not_mixed_up(spark):
    check_trie(spark, [(20, 0, "ab", "c"), (40, 0, "a", "bc"), (60, 0, "a", "b"), (60, 1, "c", ""), (80, 0, "a", "b"), (80, 1, "", "c")])


# ----------------------------------------------------------------------- 12

def plain_phrases(rows, least, top):
    f, n = collections.Counter(), collections.Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            ws = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(ws)
            for k in range(1, 5):
                f.update((lang, tuple(ws[i:i + k])) for i in range(len(ws) - k + 1))
    often = {x: a for x, a in f.items() if a >= least}
    covered = set()
    for (lang, p), a in often.items():
        for i, j in itertools.combinations(range(len(p) + 1), 2):
            if 2 <= j - i < len(p) and 100 * a >= 80 * f[lang, p[i:j]]:
                covered.add((lang, p[i:j]))
    found = collections.defaultdict(list)
    for (lang, p), a in often.items():
        if len(p) > 1 and (lang, p) not in covered:
            cuts = [(2_000_000 * a // (f[lang, p[:k]] + f[lang, p[k:]]), k, f[lang, p[:k]], f[lang, p[k:]]) for k in range(1, len(p))]
            score, _, left, right = min(cuts)
            found[lang].append((-score, -a, " ".join(p).encode(), left, right))
    return [(lang, i, p.decode(), -a, left, right, n[lang], -score)
            for lang, v in found.items() for i, (score, a, p, left, right) in enumerate(sorted(v)[:top], 1)]


def check_phrases(spark, rows, least, top=2000, size=collocations.SHARD_WORDS, parts=3):
    df = spark.createDataFrame(rows, "text string, lang string").repartition(parts)
    df = df.select("*", *[F.lit("own").alias(c) for c in ("id", "n", "shard", "word", "a", "score", "rank")])
    assert bag(collocations.collocations(df, least=least, top=top, size=size).collect()) == bag(plain_phrases(rows, least, top))


def test_phrases_over_many_shards(spark):
    rnd = random.Random(5)
    words = ["a", "B", "b", "cé", "d", "e-f", " ", "Ä", "ä", "rare1", "rare2"]
    rows = [("".join(rnd.choice(words) + rnd.choice([" ", " ", "  ", "\t", ". ", "\n", ",", "!? "]) for _ in range(rnd.randint(0, 80))),
             rnd.choice(["en", "de", None, "und"])) for _ in range(200)]
    for size in (50, 700, 1 << 20):
        check_phrases(spark, rows, least=8, size=size)
    check_phrases(spark, rows, least=5, top=7)


def test_phrases_of_odd_rows(spark):
    long = "one two three four " * 5000
    rows = [(None, "en"), ("", "en"), (" .,\n", None), (None, None), (long, "en"), (long, "en"), ("x " * 3000, "fr"), ("x", "fr"), ("a.a.a a", "es")]
    rows += [("the same text of copies", "en")] * 60
    check_phrases(spark, rows, least=3, size=1000)


def test_phrases_of_no_rows(spark):
    df = spark.createDataFrame([], "text string, lang string")
    assert collocations.collocations(df).collect() == []
    check_phrases(spark, [(None, None), ("a b c", "en")], least=30)


def test_index_intervals_count_occurrences():
    rnd = np.random.default_rng(1)
    symbols = np.concatenate([[0], rnd.integers(0, 6, 4000), [0]])
    index = collocations.Index(*collocations.Index.of(symbols))
    level = index.words()
    text = [tuple(symbols[i:i + k]) for k in range(1, 5) for i in range(len(symbols) - k + 1)]
    count = collections.Counter(text)
    names = [(c,) for c in range(1, 6)]
    for side in ("left", "right", "left"):
        which, symbol, level = getattr(index, side)(level)
        names = [(int(s), *names[w]) if side == "left" else (*names[w], int(s)) for w, s in zip(which, symbol)]
        assert dict(zip(names, level.size.tolist())) == {p: n for p, n in count.items() if len(p) == len(names[0]) and 0 not in p}


# ----------------------------------------------------------------------- 13

def plain_links(rows, threshold=0.93):
    """Set of linked (row number, row number)."""
    def good(v, label):
        return label is not None and v is not None and len(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)

    unit = [np.array(v, float) / np.abs(np.array(v, float)).max() if good(v, label) else None for _, v, label in rows]
    out = set()
    for i, j in itertools.combinations(range(len(rows)), 2):
        a, b = unit[i], unit[j]
        if a is not None and b is not None and len(a) == len(b) and rows[i][2] == rows[j][2]:
            if a @ b / math.sqrt((a @ a) * (b @ b)) >= threshold:
                out.add((i, j))
    return out


def plain_components(rows):
    links = plain_links(rows)
    root, degree = list(range(len(rows))), collections.Counter()

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, j in links:
        degree[i] += 1
        degree[j] += 1
        root[find(i)] = find(j)
    least = {}
    for i, (vec, _, _) in enumerate(rows):
        if vec is not None:
            least[find(i)] = min(vec, least.get(find(i), vec))
    return [(vec, degree[i], least.get(find(i)), vec is not None and vec == least.get(find(i))) for i, (vec, _, _) in enumerate(rows)]


def vectors(rows, spark, kind="float"):
    df = spark.createDataFrame(rows, f"vec_id long, embedding array<{kind}>, label int")
    return df.select("*", *[F.lit("own").alias(c) for c in ("id", "grp", "digest", "n", "node", "own", "vec")])


def clusters(seed, groups=12, size=16, spread=(0.02, 0.03, 0.05)):
    rnd = np.random.default_rng(seed)
    rows = []
    for g in range(groups):
        centre = rnd.standard_normal(size)
        centre /= np.linalg.norm(centre)
        for _ in range(rnd.integers(1, 14)):
            rows.append([len(rows), (centre + rnd.standard_normal(size) * rnd.choice(spread)).astype(np.float32).tolist(), int(g % 3)])
    return [tuple(r) for r in rows]


def test_links_of_random_clusters(spark):
    rows = clusters(1)
    assert len(plain_links(rows)) > 100
    assert bag(embedding_dedup.components(vectors(rows, spark)).collect()) == bag(plain_components(rows))


def test_links_of_split_buckets(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "BLOCK", 5)
    rows = clusters(2, groups=4, spread=(0.01,)) + [(1000 + i, [1.0] + [0.01 * i / 40] * 15, 1) for i in range(40)]
    assert bag(embedding_dedup.components(vectors(rows, spark)).collect()) == bag(plain_components(rows))


def test_links_of_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, None, 1), (2, [], 1), (3, [0.0, 0.0], 1), (4, [1.0, None], 1), (5, [1.0, nan], 1), (6, [inf, 1.0], 1), (7, [1.0, 2.0], None),
            (8, [1.0, 2.0], 1), (9, [2.0, 4.0], 1), (10, [1.0, 2.0, 0.0], 1), (11, [1.0, 2.0], 2), (8, [1.0, 2.0], 1), (None, [1.0, 2.0], 1),
            (None, [5.0, -1.0], 1), (None, None, None), (12, [1e300, 2e300], 1), (13, [1e-300, 2e-300], 1), (14, [-1.0, -2.0], 1),
            (15, [0.0, 1.0], 1), (16, [-0.0, 1.0], 1)]
    rows += [(100 + i, [3.0, -1.0], 7) for i in range(60)]  # copies
    got = embedding_dedup.components(vectors(rows, spark, "double")).collect()
    assert bag(got) == bag(plain_components(rows))


def test_components_of_a_chain(spark):
    angle = [0.3 * i for i in range(18)]  # neighbours only
    rows = [(50 - i, [math.cos(a), math.sin(a)], 1) for i, a in enumerate(angle)]
    got = {r["vec_id"]: (r["n_links"], r["component_id"]) for r in embedding_dedup.components(vectors(rows, spark)).collect()}
    assert got == {50 - i: (1 if i in (0, 17) else 2, 33) for i in range(18)}


def test_vectors_of_no_rows_and_kept_columns(spark):
    empty = vectors([], spark)
    assert embedding_dedup.components(empty).collect() == [] and embedding_dedup.one_of_each(empty).collect() == []
    rows = clusters(3)
    kept = embedding_dedup.one_of_each(vectors(rows, spark))
    assert kept.columns == vectors(rows, spark).columns
    assert {r["vec_id"] for r in kept.collect()} == {r[0] for r in plain_components(rows) if r[3]}


@pytest.mark.parametrize("largest", [1, 1000, 10**6, 10**9])
def test_pairs_at_the_threshold_share_a_bucket(largest):
    tables = embedding_dedup.Tables(largest)
    rnd = np.random.default_rng(4)
    a = rnd.standard_normal((400, 32))
    b = rnd.standard_normal((400, 32))
    a = embedding_dedup.units(a)
    b = embedding_dedup.units(b - (a * b).sum(1, keepdims=True) * a)
    near = 0.93 * a + math.sqrt(1 - 0.93 ** 2) * b
    assert (tables.keys(a) == tables.keys(near)).any(axis=1).mean() >= 0.99
    part = tables.keys(a[7:9], 1)
    assert (part == tables.keys(a)[7:9, :1]).all()  # the same in any batch
    assert (tables.keys(a) == tables.keys(b)).mean() * largest <= 10 * embedding_dedup.BY_CHANCE + 0.01 * largest
