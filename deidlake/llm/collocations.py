"""Phrase collocations by a bidirectional FM-index per shard over word ids.

A shard holds whole texts of about ``SHARD_WORDS`` words, as ids of (lang,
word) with a break between pieces; a task makes its shards one after another.
Phrases are found in four steps, each summed up over all shards by Spark:

1. words: counts of each shard's words.
2. two words: a shard replaces words that aren't found often enough (as often
   as a phrase must be) by breaks, since no phrase with them can be frequent,
   builds its index and extends every word to the left.
3. three words: pairs are extended to the right, if the last two words are a
   pair too.
4. four words: phrases of three are extended to the left, if the first three
   are one of them.

Each step from 2 counts twice: first only hashes of 40 bits of the phrases, which
are small rows and can't miss a frequent phrase; then the phrases themselves, of
those whose hash was counted often enough, exactly.  Most phrases are rare and
are shuffled in the first form alone.

What is frequent of a step reaches the shards as a bitmap of 2^28 bits at most:
its size is bounded, and a bit that is set by chance costs work but changes no
count.

The index is the Burrows-Wheeler transform of the ids and of the reversed ids.
Suffixes are sorted by their first four words only, which is enough for
patterns up to four.  A phrase is an interval in both; extending by a word on
one side is a rank query there and an offset within the interval on the
other, for all phrases of a level at once.  Whether the words without the one
at the far end are frequent is whether the interval lies in one of theirs.

A phrase can't be more frequent than its parts, so leaving out extensions of
rare parts loses nothing, and a phrase that covers another by two more words
implies one by one more word that covers it too.  Words are named by 64-bit
hashes; the vocabulary is searched for two words of one name, and if there are
any, all starts anew with other names.

Defined results: a null or empty text has no words; a null language counts as
``und``; texts of any length belong to one shard as a whole; repeated rows
count each; equal scores and counts are ranked by the phrase's bytes.  An
empty table gives an empty result; other columns are ignored."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from deidlake.llm.common import binary_array, discard, lower_ascii, mix64, pieces, shuffles_removed, small_batches, stored, utf8, word_spans

LEAST = 30
LONGEST = 4
#: A phrase goes if a longer one has at least COVER of its occurrences in 100.
COVER = 80
SCALE = 2_000_000
TOP = 2000
NO_LANG = "und"
SHARD_WORDS = 1 << 19
#: Seed of Spark's xxhash64, by which the shards name words too.
HASH_SEED = 42
#: Bits of a bitmap for each word or pair in it, and as a power of two at most.
BITS_EACH, MOST_BITS = 16, 28
#: Bits of a phrase's hash, in the first count of each step, and its column.
HASH_BITS, HASHED = 40, "h"
#: Parts of a language that are ranked on their own first.
SPREAD = 64

BREAKS = np.zeros(256, bool)
BREAKS[[ord(c) for c in ".,;:!?\n\v\f\r"]] = True
GAPS = BREAKS.copy()
GAPS[[9, 32]] = True


def _packed(values: np.ndarray) -> bytes:
    """int32 numbers, byte by byte of equal weight, compressed."""
    return zstandard.compress(np.ascontiguousarray(values.astype("<i4").view(np.uint8).reshape(-1, 4).T).tobytes(), 1)


def _unpacked(data: bytes) -> np.ndarray:
    planes = np.frombuffer(zstandard.decompress(data), np.uint8).reshape(4, -1)
    return np.ascontiguousarray(planes.T).view("<i4").ravel()


# -------------------------------------------------------------------- shards

class _Shard:
    """Words of consecutive texts."""

    def __init__(self):
        self.words: list[pa.Array] = []
        self.first: list[np.ndarray] = []  # does a word begin a piece?
        self.lang: list[np.ndarray] = []
        self.langs: dict[str, int] = {}
        self.size = 0

    def add(self, data: np.ndarray, offsets: np.ndarray, langs: list[str]) -> None:
        data = lower_ascii(data)
        start, end, first = word_spans(data, offsets, GAPS)
        breaks = np.concatenate([[0], np.cumsum(BREAKS[data])])
        begins = np.ones(len(start), bool)
        begins[1:] = breaks[start[1:]] != breaks[end[:-1]]
        begins[first[:-1][np.diff(first) > 0]] = True
        code = np.array([self.langs.setdefault(x, len(self.langs)) for x in langs], np.int64)
        self.words.append(binary_array(data[~GAPS[data]], np.concatenate([[0], np.cumsum(end - start)])))
        self.first.append(begins)
        self.lang.append(np.repeat(code, np.diff(first)))
        self.size += len(start)

    def rows(self, tag: str) -> Iterator[pa.RecordBatch]:
        """The shard's tokens (0 for a break) and its words' names, then its
        vocabulary."""
        found = pa.chunked_array(self.words, pa.binary()).combine_chunks().dictionary_encode()
        pair = found.indices.to_numpy().astype(np.int64) * len(self.langs) + np.concatenate(self.lang)
        pairs, code, n = np.unique(pair, return_inverse=True, return_counts=True)
        first = np.concatenate(self.first)
        tokens = np.zeros(len(code) + int(first.sum()) + 1, np.int32)
        tokens[np.arange(len(code)) + np.cumsum(first)] = code + 1
        words = found.dictionary.take(pa.array(pairs // len(self.langs)))
        lang = pairs % len(self.langs)
        heads = [f"{tag}\0{x}\0".encode() for x in self.langs]
        names = np.fromiter((xxhash.xxh64_intdigest(heads[k] + w, HASH_SEED) for k, w in zip(lang.tolist(), words.to_pylist())), np.uint64, len(pairs))
        yield pa.RecordBatch.from_arrays(
            [pa.array([None], pa.string()), pa.array([None], pa.string()), pa.array([0], pa.int64()), pa.array([_packed(tokens)], pa.binary()),
             pa.array([names.tobytes()], pa.binary())], SHARD_COLUMNS)
        none = pa.nulls(len(pairs), pa.binary())
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(self.langs), pa.string()).take(pa.array(lang)), words.cast(pa.string()), pa.array(n.astype(np.int64)), none, none],
            SHARD_COLUMNS)


SHARD_COLUMNS = ["lang", "word", "n", "tokens", "names"]


def shards(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", size: int = SHARD_WORDS, tag: str = "") -> DataFrame:
    """(lang, word, n, tokens, names): a row with the tokens of each shard, and
    one for each of its words."""
    source = docs.select(F.col(f"`{text_col}`").cast("string").alias("text"),
                         F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit(NO_LANG)).alias("lang"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        current = _Shard()
        for batch in batches:
            data, offsets = utf8(batch.column("text"))
            langs = batch.column("lang").to_pylist()
            for i, j in pieces(offsets):
                current.add(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], langs[i:j])
                if current.size >= size:
                    yield from current.rows(tag)
                    current = _Shard()
        if current.size:
            yield from current.rows(tag)

    return source.mapInArrow(run, "lang string, word string, n long, tokens binary, names binary")


def _name(tag: str) -> Column:
    """The name of a word, as the shards make it."""
    return F.xxhash64(F.concat(F.lit(f"{tag}\0"), F.col("lang"), F.lit("\0"), F.col("word")))


def vocabulary_and_shards(docs: DataFrame, text_col: str, lang_col: str, size: int) -> tuple[DataFrame, DataFrame]:
    """(id, lang, word, f) of every word, and the shards (tokens, names)."""
    for turn in range(9):
        own = stored(shards(docs, text_col, lang_col, size, str(turn)), "shards", "zstd")
        words = own.where("tokens is null").groupBy("lang", "word").agg(F.sum("n").alias("f"))
        words = stored(words.select(_name(str(turn)).alias("id"), "lang", "word", "f"), "vocabulary", "zstd")
        if words.groupBy("id").count().where("count > 1").isEmpty():
            break
    else:
        raise RuntimeError("words share names whatever the hash")
    return words, own.where("tokens is not null").select("tokens", "names")


# --------------------------------------------------------------------- index

class Half:
    """One direction of the index: rows are suffixes in order of their first
    four symbols, ``before[row]`` is the symbol before the suffix."""

    def __init__(self, before: np.ndarray):
        self.before = before.astype(np.int64)
        self.first = np.concatenate([[0], np.cumsum(np.bincount(self.before))])  # symbol -> its first row
        self.rows = len(before)
        order = np.argsort(self.before, kind="stable")
        self.places = self.before[order] * self.rows + order  # (symbol, row), sorted

    @staticmethod
    def transform(symbols: np.ndarray) -> np.ndarray:
        s = symbols.astype(np.int64)
        two = np.unique(s * (int(s.max()) + 1) + np.roll(s, -1), return_inverse=True)[1].astype(np.int64)
        four = two * (int(two.max()) + 1) + np.roll(two, -2)
        return symbols[np.argsort(four, kind="stable") - 1].astype(np.int32)

    def rank(self, symbol: np.ndarray, row: np.ndarray) -> np.ndarray:
        """Occurrences of a symbol in ``before`` above a row."""
        return np.searchsorted(self.places, symbol * self.rows + row) - self.first[symbol]

    def extended(self, low: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, ...]:
        """Every extension of the intervals [low, low + size): (interval,
        symbol, count, first row of the extension, number of the interval's
        occurrences with a smaller symbol)."""
        which = np.repeat(np.arange(len(low)), size)
        row = np.arange(len(which)) - np.repeat(np.cumsum(size) - size, size) + low[which]
        width = len(self.first)
        key, count = np.unique(which * width + self.before[row], return_counts=True)
        which, symbol = key // width, key % width
        smaller = np.cumsum(count) - count
        smaller -= (np.cumsum(size) - size)[which]
        real = symbol > 0
        which, symbol, count, smaller = which[real], symbol[real], count[real], smaller[real]
        return which, symbol, count, self.first[symbol] + self.rank(symbol, low[which]), smaller


class Phrases:
    """Intervals of phrases in both halves."""

    def __init__(self, low: np.ndarray, back: np.ndarray, size: np.ndarray):
        self.low, self.back, self.size = low, back, size

    def __getitem__(self, rows: np.ndarray) -> Phrases:
        return Phrases(self.low[rows], self.back[rows], self.size[rows])


def _holder(starts: np.ndarray, sizes: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Which of disjoint intervals holds a row; -1 for none."""
    if not len(starts):
        return np.full(len(at), -1)
    order = np.argsort(starts)
    k = np.searchsorted(starts[order], at, side="right") - 1
    found = order[np.maximum(k, 0)]
    return np.where((k >= 0) & (at < starts[found] + sizes[found]), found, -1)


class Index:
    """Bidirectional index; symbol 0 is the break at both ends and between
    pieces."""

    def __init__(self, forward: np.ndarray, backward: np.ndarray):
        self.forward, self.backward = Half(forward), Half(backward)

    @staticmethod
    def of(symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        return Half.transform(symbols), Half.transform(symbols[::-1])

    def words(self) -> Phrases:
        first = self.forward.first
        return Phrases(first[1:-1], first[1:-1], np.diff(first)[1:])

    def left(self, phrases: Phrases) -> tuple[np.ndarray, np.ndarray, Phrases]:
        which, symbol, count, low, smaller = self.forward.extended(phrases.low, phrases.size)
        return which, symbol, Phrases(low, phrases.back[which] + smaller, count)

    def right(self, phrases: Phrases) -> tuple[np.ndarray, np.ndarray, Phrases]:
        which, symbol, count, back, smaller = self.backward.extended(phrases.back, phrases.size)
        return which, symbol, Phrases(phrases.low[which] + smaller, back, count)


def only(tokens: np.ndarray, kept: np.ndarray) -> np.ndarray:
    """Tokens as symbols 1.. by ``kept`` (0 for a word to leave out), without
    words that stand alone and with one break between pieces and at the ends."""
    symbols = np.concatenate([[0], kept[tokens], [0]])
    near = (symbols[:-2] > 0) | (symbols[2:] > 0)
    symbols[1:-1] *= near
    last = np.concatenate([[False], (symbols[1:] == 0) & (symbols[:-1] == 0)])
    return symbols[~last]


# ------------------------------------------------------------------ counting

def _indices(own: DataFrame, bitmap: Broadcast, bits: int) -> DataFrame:
    """(forward, backward, names): the index of every shard over its words in
    the broadcast bitmap, and their names in order of their symbols 1, 2, ..."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        often = bitmap.value
        for batch in batches:
            for row in batch.to_pylist():
                tokens, names = _unpacked(row["tokens"]), np.frombuffer(row["names"], "<i8")
                found = _in_bitmap(often, _bit([names], bits))
                kept = np.concatenate([[0], np.cumsum(found) * found]).astype(np.int32)
                symbols = only(tokens, kept)
                # symbols 1.. for the words that stand beside another one
                used, symbols = np.unique(np.append(symbols, 0), return_inverse=True)
                if len(used) < 2:
                    continue
                forward, backward = Index.of(symbols[:-1].astype(np.int32))
                names = names[found][used[1:] - 1]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([_packed(forward)]), pa.array([_packed(backward)]), pa.array([names.tobytes()])], ["forward", "backward", "names"])

    return own.mapInArrow(run, "forward binary, backward binary, names binary")


def _open(row: dict) -> tuple[Index, np.ndarray]:
    return Index(_unpacked(row["forward"]), _unpacked(row["backward"])), np.frombuffer(row["names"], "<i8")


def _hash(words: list[np.ndarray]) -> np.ndarray:
    """A hash of HASH_BITS bits of each phrase, given by the names of its words."""
    out = np.zeros(len(words[0]), np.uint64)
    for k, name in enumerate(words):
        out = mix64(out ^ name.view(np.uint64), k)
    return (out >> np.uint64(64 - HASH_BITS)).astype(np.int64)


def _bit(words: list[np.ndarray], bits: int) -> np.ndarray:
    """Place of each phrase in a bitmap."""
    return _hash(words) >> (HASH_BITS - bits)


def _in_bitmap(bitmap: np.ndarray, bit: np.ndarray) -> np.ndarray:
    return (bitmap[bit >> 3] >> (bit & 7).astype(np.uint8) & 1).astype(bool)


def _bitmap(found: DataFrame, *words: str) -> tuple[Broadcast, int]:
    """2^bits bits, as bytes, with those of the phrases set; bits.  ``words``
    names the columns of their words, or the one of their hash, HASHED."""
    spark = found.sparkSession
    bits = min(MOST_BITS, max(15, (BITS_EACH * found.count()).bit_length()))
    hashed = words == (HASHED,)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = [c.to_numpy() for c in batch.columns]
            bit = columns[0] >> (HASH_BITS - bits) if hashed else _bit(columns, bits)
            yield pa.RecordBatch.from_arrays([pa.array(bit >> 15), pa.array(bit & 32767)], ["part", "place"])

    parts = found.select(*words).mapInArrow(run, "part long, place long").groupBy("part").agg(
        F.bitmap_construct_agg("place").alias("set")).collect()  # at most 2^(bits - 15) rows of 4 KB
    out = np.zeros((1 << bits) >> 3, np.uint8)
    for part, piece in parts:
        out[part * 4096:(part + 1) * 4096] = np.frombuffer(piece, np.uint8)
    return spark.sparkContext.broadcast(out), bits


def _counts(words: list[np.ndarray], n: np.ndarray, names: list[str], among: tuple[Broadcast, int] | None) -> pa.RecordBatch:
    """The hashes of a shard's phrases and their counts; with ``among``, the
    words of those whose hash is in that bitmap instead."""
    n = n.astype(np.int64)
    if among is None:
        return pa.RecordBatch.from_arrays([pa.array(_hash(words)), pa.array(n)], [HASHED, "n"])
    kept = np.flatnonzero(_in_bitmap(among[0].value, _bit(words, among[1])))
    return pa.RecordBatch.from_arrays([*[pa.array(c[kept]) for c in words], pa.array(n[kept])], [*names, "n"])


def _columns(names: list[str], among) -> str:
    return ", ".join(f"{c} long" for c in ([HASHED] if among is None else names) + ["n"])


def _pairs(indices: DataFrame, among: tuple[Broadcast, int] | None) -> DataFrame:
    """``_counts`` (x, y) of the pairs of words of every shard."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                index, names = _open(row)
                which, symbol, found = index.left(index.words())
                yield _counts([names[symbol - 1], names[which]], found.size, ["x", "y"], among)

    return indices.mapInArrow(run, _columns(["x", "y"], among))


def _longer(indices: DataFrame, among: tuple[Broadcast, int] | None, pairs: tuple[Broadcast, int],
            triples: tuple[Broadcast, int] | None = None) -> DataFrame:
    """``_counts`` (w1, w2, w3) of the phrases of three words of every shard whose
    pairs are in the broadcast bitmap; with that of phrases of three,
    (w1, w2, w3, w4) of those of four."""
    names_ = ["w1", "w2", "w3", *(["w4"] if triples else [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                index, names = _open(row)
                which, symbol, two = index.left(index.words())
                x, y = names[symbol - 1], names[which]
                kept = np.flatnonzero(_in_bitmap(pairs[0].value, _bit([x, y], pairs[1])))
                two, x, y = two[kept], x[kept], y[kept]
                which, symbol, found = index.right(two)
                both = np.flatnonzero(_holder(two.back, two.size, found.back) >= 0)
                found, words = found[both], [x[which[both]], y[which[both]], names[symbol[both] - 1]]
                if triples:
                    kept = np.flatnonzero(_in_bitmap(triples[0].value, _bit(words, triples[1])))
                    three, words = found[kept], [c[kept] for c in words]
                    which, symbol, found = index.left(three)
                    both = np.flatnonzero(_holder(three.low, three.size, found.low) >= 0)
                    found, words = found[both], [names[symbol[both] - 1], *[c[which[both]] for c in words]]
                yield _counts(words, found.size, names_, among)

    return indices.mapInArrow(run, _columns(names_, among))


def _named(df: DataFrame, **columns: str) -> DataFrame:
    return df.select(*[F.col(v).alias(k) for k, v in columns.items()])


def phrases(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = LEAST, size: int = SHARD_WORDS) -> DataFrame:
    """All candidates, covered ones dropped: (lang, phrase, a, l, r, n, score)."""
    small_batches(docs.sparkSession)
    enough = lambda df, *key: df.groupBy(*key).agg(F.sum("n").alias("f")).where(F.col("f") >= least)
    with shuffles_removed(docs.sparkSession):
        vocabulary, own = vocabulary_and_shards(docs, text_col, lang_col, size)
        total = vocabulary.groupBy("lang").agg(F.sum("f").alias("n"))
        one = vocabulary.where(F.col("f") >= least)
        indices = stored(_indices(own, *_bitmap(one, "id")), "indices", "zstd")
        if not total.isEmpty():
            discard(own)

        def frequent(counts: Callable[[tuple[Broadcast, int] | None], DataFrame], name: str, *words: str) -> DataFrame:
            # a hash counts all phrases that share it, so none that is frequent is missed
            likely = stored(enough(counts(None), HASHED), f"likely-{name}")
            return stored(enough(counts(_bitmap(likely, HASHED)), *words), f"frequent-{name}")

        pairs = frequent(lambda among: _pairs(indices, among), "pairs", "x", "y")
        often = _bitmap(pairs, "x", "y")
        three = frequent(lambda among: _longer(indices, among, often), "triples", "w1", "w2", "w3")
        triples = _bitmap(three, "w1", "w2", "w3")
        four = frequent(lambda among: _longer(indices, among, often, triples), "fours", "w1", "w2", "w3", "w4")

        two = pairs.join(_named(one, x="id", lang="lang", first="word", f_first="f"), "x").join(_named(one, y="id", last="word", f_last="f"), "y")
        two = stored(two, "pairs-with-words")
    three_words = (three.join(_named(two, w1="x", w2="y", lang="lang", t1="first", t2="last", f1="f_first", f12="f"), ["w1", "w2"])
                   .join(_named(two, w2="x", w3="y", t3="last", f23="f", f3="f_last"), ["w2", "w3"]))
    four_words = (four.join(_named(two, w1="x", w2="y", lang="lang", t1="first", t2="last", f1="f_first", f12="f"), ["w1", "w2"])
                  .join(_named(two, w3="x", w4="y", t3="first", t4="last", f34="f", f4="f_last"), ["w3", "w4"])
                  .join(_named(three, w1="w1", w2="w2", w3="w3", f123="f"), ["w1", "w2", "w3"])
                  .join(_named(three, w2="w1", w3="w2", w4="w3", f234="f"), ["w2", "w3", "w4"]))
    over_two = _named(three, x="w1", y="w2", f="f").unionByName(_named(three, x="w2", y="w3", f="f"))
    over_two = over_two.groupBy("x", "y").agg(F.max("f").alias("over"))
    over_three = _named(four, w1="w1", w2="w2", w3="w3", f="f").unionByName(_named(four, w1="w2", w2="w3", w3="w4", f="f"))
    over_three = over_three.groupBy("w1", "w2", "w3").agg(F.max("f").alias("over"))

    wide = lambda c: F.col(c).cast("decimal(38,0)") if isinstance(c, str) else c

    def scored(df: DataFrame, names: list[str], cuts: list[tuple[str, str]]) -> DataFrame:
        options = F.array(*[F.struct(F.expr(f"cast(f as decimal(20,0)) * {SCALE} div (cast({a} as decimal(20,0)) + {b})").alias("score"),
                                     F.lit(k).alias("k"), F.col(a).alias("l"), F.col(b).alias("r")) for k, (a, b) in enumerate(cuts, 1)])
        df = df.where(F.col("over").isNull() | (wide("over") * 100 < wide("f") * COVER)) if "over" in df.columns else df
        return df.withColumn("cut", F.array_min(options)).select(
            "lang", F.concat_ws(" ", *names).alias("phrase"), F.col("f").alias("a"), "cut.l", "cut.r", "cut.score")

    found = [
        scored(two.join(over_two, ["x", "y"], "left"), ["first", "last"], [("f_first", "f_last")]),
        scored(three_words.join(over_three, ["w1", "w2", "w3"], "left"), ["t1", "t2", "t3"], [("f1", "f23"), ("f12", "f3")]),
        scored(four_words, ["t1", "t2", "t3", "t4"], [("f1", "f234"), ("f12", "f34"), ("f123", "f4")]),
    ]
    return reduce(DataFrame.unionByName, found).join(total, "lang").select("lang", "phrase", "a", "l", "r", "n", "score")


def collocations(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", least: int = LEAST, top: int = TOP,
                 size: int = SHARD_WORDS) -> DataFrame:
    """Each language's best phrases: (lang, rank, phrase, a, l, r, n, score)."""
    found = phrases(docs, text_col, lang_col, least, size).withColumn("part", F.pmod(F.xxhash64("phrase"), F.lit(SPREAD)))
    best = [F.col("score").desc(), F.col("a").desc(), F.col("phrase")]
    for part in (["lang", "part"], ["lang"]):
        found = found.withColumn("rank", F.row_number().over(Window.partitionBy(*part).orderBy(*best))).where(F.col("rank") <= top)
    return found.select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


COLLOCATIONS_SQL = rf"""
WITH docs AS (SELECT coalesce(lang, '{NO_LANG}') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
              FROM documents),
piece AS (SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS ws
          FROM (SELECT lang, unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')) AS p FROM docs)),
gram AS (SELECT lang, k, array_to_string(ws[i:i + k - 1], ' ') AS g, count(*) AS f
         FROM piece, unnest(generate_series(1, len(ws))) AS a(i), unnest(generate_series(1, {LONGEST})) AS b(k)
         WHERE i + k - 1 <= len(ws) GROUP BY ALL),
total AS (SELECT lang, sum(f) AS n FROM gram WHERE k = 1 GROUP BY lang),
often AS (SELECT lang, k, g, string_split(g, ' ') AS ws, f FROM gram WHERE f >= {LEAST}),
parts AS (SELECT lang, g, f AS a, j, array_to_string(ws[1:j], ' ') AS x, array_to_string(ws[j + 1:k], ' ') AS y
          FROM often, unnest(generate_series(1, k - 1)) AS t(j)),
cut AS (SELECT p.lang, p.g, p.a, p.j, u.f AS l, v.f AS r, {SCALE} * p.a::HUGEINT // (u.f + v.f) AS score
        FROM parts p JOIN often u ON u.lang = p.lang AND u.g = p.x JOIN often v ON v.lang = p.lang AND v.g = p.y),
best AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, j) = 1),
inside AS (SELECT lang, f, array_to_string(ws[i:i + m - 1], ' ') AS g
           FROM often, unnest(generate_series(1, k)) AS s(i), unnest(generate_series(2, k - 1)) AS u(m) WHERE i + m - 1 <= k),
covered AS (SELECT b.lang, b.g FROM best b JOIN inside i ON i.lang = b.lang AND i.g = b.g WHERE 100 * i.f >= {COVER} * b.a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(g)) AS rank FROM best ANTI JOIN covered USING (lang, g))
SELECT lang, rank::BIGINT AS rank, g AS phrase, a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM ranked JOIN total USING (lang) WHERE rank <= {TOP}
"""
