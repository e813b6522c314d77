"""Toxicity by two class-conditional Kneser-Ney bigram models.

One model is learnt from toxic and one from ordinary labelled documents.  As
in Kneser-Ney smoothing an absolute discount below 1 (of each class and order,
from counts of counts) is taken off every count and its mass goes to the next
lower order: bigrams back off to the class's words, and these to *shared*
continuation counts (in how many different contexts a word occurs, in both
classes together).

Most differences between the classes say nothing about toxicity: rare words,
and the classes' shares of languages, topics and lengths.  So the log-odds of
a word (and what a bigram adds to its word's) are weighted by the probability
that the classes differ there at all: the likelihood ratio against one shared
share of toxic occurrences, with a penalty for the free parameter, its
deviance divided by the usual one of words of that frequency.  No count is
cut: evidence grows with the counts in either class, whatever its share.
The difference of the two
log-likelihoods, divided by the number of words, becomes a probability by a
logistic curve.  That curve is fitted on all labelled documents that the models
haven't seen (one of the four learning folds), else their own counts would
flatter them.

Size: the counts are gathered by Spark from all labelled documents (they grow
with the input).  ``WORDS`` slots for words are broadcast, shared by words with
the same hash.  Every bigram seen has a weight: the most frequent of those
hashed to each of ``PAIRS`` slots is broadcast with the words, as a cache; the
others of a text are joined with the table of all bigrams, and their weights
(in units of 2^-32, so that sums are exact) added up by a hash of the text.
One task makes the arrays of the counts by slot; 12 and 14 MB reach the driver
(in small pieces) and the workers, whatever the corpus.  The curve is fitted to
counts by steps of the mean log-odds, of which there are few.

Defined results: a null or empty text is scored by the share of toxic labels;
without any label of one of the classes every score is that share (0 without
labels); repeated rows are scored alike; of several labels for one id the
largest counts; a null id is never labelled, its held_out is null; an empty
table gives an empty result; extra columns are ignored by ``score`` and kept
by ``without_toxic``."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from functools import partial, reduce

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deidlake.llm.common import PUNCTUATION, lower_ascii, mix64, pieces, shuffles_removed, small_batches, stored, unused, utf8, word_hashes, word_spans

FOLDS = 5
HELD_OUT, CALIBRATION = 0, 4
#: Odds against a word's (a bigram's) use differing between the classes.
WORD_AGAINST, PAIR_AGAINST = 100.0, 1000.0
#: Bands of counts (powers of two) of fewer members take the next one's dispersion.
LEAST_MEMBERS = 30
#: Median of the chi-square distribution with one degree of freedom.
CHI_MEDIAN = 0.455
WORD_BITS, PAIR_BITS = 19, 20
WORDS, PAIRS = 1 << WORD_BITS, 1 << PAIR_BITS
#: Weights of bigrams are added up in these units.
UNIT = float(1 << 32)
#: Passes over the texts in which the bigrams outside the cache are joined, each
#: with its share of the keys: the disk holds the rows of one pass at a time.
PASSES = 3
#: Steps an octave of the deviances whose median is taken.
STEPS = 32
#: Steps of the mean log-odds by which the calibration rows are counted.
CURVE_STEPS = 1 << 16
#: The model's arrays reach the driver in pieces: large objects swell its heap.
ARRAY_PIECE, ARRAY_TASKS = 1 << 18, 32


def fold_of(doc_id: Column) -> Column:
    return F.pmod(F.crc32(doc_id.cast("string")), F.lit(FOLDS))


def bigrams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(slot of each word, slot of the word before it, index of the first
    word of each text); the context of a first word is slot 0."""
    data = lower_ascii(data)
    start, end, first = word_spans(data, offsets, PUNCTUATION)
    word = (word_hashes(data, start, end) % np.uint64(WORDS - 1)).astype(np.int64) + 1
    context = np.zeros(len(word), np.int64)
    context[1:] = word[:-1]
    context[first[:-1][first[:-1] < len(word)]] = 0
    return word, context, first


def pair_slot(key: np.ndarray) -> np.ndarray:
    return (mix64(key.astype(np.uint64), 3) >> np.uint64(64 - PAIR_BITS)).astype(np.int64)


def discount(counts: np.ndarray) -> np.ndarray:
    """Kneser-Ney's absolute discount of each class, from counts of counts."""
    return _discount((counts == 1).sum(axis=0), (counts == 2).sum(axis=0))


def _discount(once: np.ndarray, twice: np.ndarray) -> np.ndarray:
    return np.where(once > 0, np.clip(once / np.maximum(once + 2 * twice, 1), 0.05, 0.95), 0.5)


def deviance(counts: np.ndarray, odds: np.ndarray) -> np.ndarray:
    """How far counts (n, 2) are from the odds of toxic (0 or more)."""
    share = odds / (1 + odds)
    expected = counts.sum(axis=1)[:, None] * np.stack([1 - share, share], axis=1)
    return 2 * np.where(counts > 0, counts * np.log(np.maximum(counts, 1) / np.maximum(expected, 1e-300)), 0).sum(axis=1)


def band_of(counts: np.ndarray) -> np.ndarray:
    return np.floor(np.log2(np.maximum(counts.sum(axis=1), 1))).astype(int)


def spreads(medians: dict[int, tuple[int, float]]) -> np.ndarray:
    """The usual deviance of each band, of (members, median) by band."""
    usual, spread = 1.0, np.ones(64)
    for k in sorted(medians):
        members, median = medians[k]
        if members >= LEAST_MEMBERS:
            usual = max(1.0, median / CHI_MEDIAN)
        spread[k] = usual
    return spread


def differs(counts: np.ndarray, odds: np.ndarray, against: float, spread: np.ndarray | None = None) -> np.ndarray:
    """Probability that the classes differ: the likelihood ratio with a
    penalty for the free share, tempered by the usual deviance of counts of
    that size (what languages, topics and lengths of documents make), which
    are those of ``counts`` unless given by band."""
    n, far, band = counts.sum(axis=1), deviance(counts, odds), band_of(counts)
    if spread is None:
        spread = spreads({int(k): (int(own.sum()), float(np.median(far[own])))
                          for k in np.unique(band[n > 0]) for own in [(band == k) & (n > 0)]})
    return np.where(n > 0, 1 / (1 + against * np.sqrt(n + 1) * np.exp(-np.minimum(far / spread[band], 1400) / 2)), 0)


def word_weights(words: np.ndarray, continuations: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """What each word slot adds to the log-odds, and its probability among
    ordinary words, from occurrences (WORDS, 2; column 0 ordinary, column 1
    toxic) and different contexts in both classes together (WORDS,)."""
    shared = (continuations + 0.5) / (continuations.sum() + 0.5 * WORDS)
    total = np.maximum(words.sum(axis=0), 1)
    over = np.maximum(words - discount(words), 0)
    unigram = over / total + (1 - over.sum(axis=0) / total) * shared[:, None]
    telling = differs(words, np.full(WORDS, total[1] / total[0]), WORD_AGAINST)
    return telling * np.log(unigram[:, 1] / unigram[:, 0]), unigram[:, 0]


@dataclass
class Slots:
    """What the weight of a bigram takes of its two words: log-odds and ordinary
    probability of the second, occurrences and different successors of the first
    by class."""

    word: np.ndarray
    ordinary: np.ndarray
    seen: np.ndarray
    successors: np.ndarray

    def odds(self, keys: np.ndarray) -> np.ndarray:
        seen = self.seen[keys // WORDS].astype(np.float64)
        return (seen[:, 1] + 0.5) / (seen[:, 0] + 0.5) * np.exp(self.word[keys % WORDS].astype(np.float64))

    def weights(self, keys: np.ndarray, counts: np.ndarray, spread: np.ndarray, less: np.ndarray) -> np.ndarray:
        """What each bigram adds to the log-odds of its word; ``spread`` has the
        usual deviances by band, ``less`` the discount of bigrams."""
        context, after = keys // WORDS, keys % WORDS
        seen, word = self.seen[context].astype(np.float64), self.word[after].astype(np.float64)
        free = np.where(seen > 0, less * self.successors[context] / np.maximum(seen, 1), 1)
        lower = self.ordinary[after, None] * np.exp(np.stack([np.zeros(len(keys)), word], axis=1))
        p = np.maximum(counts - less, 0) / np.maximum(seen, 1) + np.maximum(free, 1e-9) * lower
        return differs(counts, self.odds(keys), PAIR_AGAINST, spread) * (np.log(p[:, 1] / p[:, 0]) - word)


@dataclass
class Table:
    """What scoring looks up: log-odds of word slots, and keys and log-odds of
    the kept bigrams."""

    word: np.ndarray
    keys: np.ndarray
    bigram: np.ndarray

    def raw(self, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Of each text, the sum of log p(word | context, toxic) - log p(word |
        context, ordinary), as far as the classes differ, without the bigrams
        that aren't in the table; and the number of its words."""
        word, context, first = bigrams(data, offsets)
        key = context * WORDS + word
        slot = pair_slot(key)
        odds = self.word[word].astype(np.float64) + np.where(self.keys[slot] == key, self.bigram[slot], 0)
        sums = np.concatenate([[0.0], np.cumsum(odds)])
        return sums[first[1:]] - sums[first[:-1]], np.diff(first)

    def others(self, data: np.ndarray, offsets: np.ndarray, part: int, passes: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(index of the text, key, occurrences) of the bigrams not in the table,
        those of one pass."""
        word, context, first = bigrams(data, offsets)
        key, doc = context * WORDS + word, np.repeat(np.arange(len(offsets) - 1), np.diff(first))
        rest = np.flatnonzero(key % passes == part)
        rest = rest[self.keys[pair_slot(key[rest])] != key[rest]]
        rest = rest[np.lexsort((key[rest], doc[rest]))]
        key, doc = key[rest], doc[rest]
        new = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (doc[1:] != doc[:-1])])) if len(rest) else rest
        return doc[new], key[new], np.diff(np.append(new, len(rest)))


@dataclass
class Curve:
    """From mean log-odds to a probability."""

    prior: float
    slope: float = 1.0
    shift: float = 0.0

    def score(self, mean: np.ndarray, n: np.ndarray) -> np.ndarray:
        curve = 1 / (1 + np.exp(-np.clip(self.slope * mean + self.shift, -500, 500)))
        return np.where((n > 0) & (self.slope > 0), curve, self.prior)


@dataclass
class Model:
    """The table as a broadcast variable (the driver keeps no copy of its
    own), the weights (key, weight in units) of all bigrams or of those of a
    pass, and the curve."""

    table: Broadcast[Table]
    weights: Callable[..., DataFrame]
    curve: Curve


def fit_curve(x: np.ndarray, y: np.ndarray, n: np.ndarray, steps: int = 60) -> tuple[float, float]:
    """Slope and shift of a logistic curve, by Newton steps on standardised
    values with a little regularisation; ``y`` of ``n`` rows at each ``x`` are
    toxic."""
    mean = (n * x).sum() / n.sum()
    scale = np.sqrt((n * (x - mean) ** 2).sum() / n.sum()) or 1.0
    z = np.stack([(x - mean) / scale, np.ones(len(x))], axis=1)
    w = np.zeros(2)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        grad = z.T @ (n * p - y) + np.array([1e-2, 0]) * w
        hess = (z * (n * p * (1 - p))[:, None]).T @ z + np.diag([1e-2, 1e-6])
        w = w - np.linalg.solve(hess, grad)
    return float(w[0] / scale), float(w[1] - w[0] * mean / scale)


# -------------------------------------------------------------------- Spark

def _pair_counts(labelled: DataFrame) -> DataFrame:
    """(key, ordinary, toxic): occurrences of each bigram."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column("text"))
            toxic = np.asarray(batch.column("toxic"), np.int64)
            for i, j in pieces(offsets):
                word, context, first = bigrams(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
                doc = np.repeat(np.arange(j - i), np.diff(first))
                # once a document: a repeated line is no more evidence than one
                _, once = np.unique(mix64((context * WORDS + word).astype(np.uint64)) + doc.astype(np.uint64), return_index=True)
                key = (context * WORDS + word)[once] * 2 + toxic[i:j][doc[once]]
                values, counts = np.unique(key, return_counts=True)
                bad = (values & 1).astype(bool)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(values >> 1), pa.array(np.where(bad, 0, counts)), pa.array(np.where(bad, counts, 0))],
                    ["key", "ordinary", "toxic"])

    rows = labelled.select("text", "toxic").mapInArrow(run, "key long, ordinary long, toxic long")
    return rows.groupBy("key").agg(F.sum("ordinary").alias("ordinary"), F.sum("toxic").alias("toxic"))


_PIECE = "name string, place int, data binary"


def _in_pieces(arrays: dict[str, np.ndarray], dtype: type | None = None) -> pa.RecordBatch:
    """Rows of ``_PIECE``."""
    rows = []
    for name, array in arrays.items():
        data = array.astype(dtype or array.dtype).tobytes()
        rows += [(name, at, data[at:at + ARRAY_PIECE]) for at in range(0, len(data), ARRAY_PIECE)]
    name, place, data = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(name), pa.array(place, pa.int32()), pa.array(data, pa.binary())], ["name", "place", "data"])


def _fetched(rows: DataFrame) -> dict[str, bytes]:
    """The arrays of rows of ``_PIECE``."""
    found = rows.repartition(ARRAY_TASKS).toArrow().sort_by([("name", "ascending"), ("place", "ascending")])
    out: dict[str, bytearray] = {}
    for name, data in zip(found.column("name").to_pylist(), found.column("data")):
        out.setdefault(name, bytearray()).extend(data.as_buffer())
    return {name: bytes(data) for name, data in out.items()}


def _word_slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The arrays of ``Slots`` of counts by slot, (kind, slot, ordinary, toxic,
    more, most): one task, whose arrays have a fixed size."""
    words, seen, successors, continuations = np.zeros((WORDS, 2)), np.zeros((WORDS, 2)), np.zeros((WORDS, 2)), np.zeros(WORDS)
    for batch in batches:
        kind, slot, ordinary, toxic, more, most = (np.asarray(c) for c in batch.columns)
        own, as_context = kind == 0, kind == 1
        words[slot[own]] = np.stack([ordinary[own], toxic[own]], axis=1)
        continuations[slot[own]] = more[own]
        seen[slot[as_context]] = np.stack([ordinary[as_context], toxic[as_context]], axis=1)
        successors[slot[as_context]] = np.stack([more[as_context], most[as_context]], axis=1)
    if words.any(axis=0).all():
        word, ordinary = word_weights(words, continuations)
        yield _in_pieces({"word": word, "ordinary": ordinary, "seen": seen, "successors": successors}, np.float32)


def _cache(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The arrays of the bigram cache of (slot, key, weight)."""
    keys, bigram = np.full(PAIRS, -1, np.int64), np.zeros(PAIRS, np.float32)
    for batch in batches:
        slot, key, weight = (np.asarray(c) for c in batch.columns)
        keys[slot], bigram[slot] = key, weight / UNIT
    yield _in_pieces({"keys": keys, "bigram": bigram})


def _counts(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    key, *counts = (np.asarray(batch.column(c)) for c in ("key", "ordinary", "toxic"))
    return key, np.stack(counts, axis=1).astype(np.float64)


def _usual(pairs: DataFrame, slots: Broadcast[Slots]) -> tuple[np.ndarray, np.ndarray]:
    """The usual deviance of bigrams by band (medians to one step of an octave),
    and their discount."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key, counts = _counts(batch)
            far = deviance(counts, slots.value.odds(key))
            step = np.floor(np.log2(np.maximum(far, 1e-9)) * STEPS).astype(np.int64)
            code, n = np.unique(band_of(counts) * (1 << 20) + step + (1 << 19), return_counts=True)
            # counts of counts have codes below zero
            few = [(counts[:, c] == k).sum() for k in (1, 2) for c in (0, 1)]
            code, n = np.concatenate([[-4, -3, -2, -1], code]), np.concatenate([few, n])
            yield pa.RecordBatch.from_arrays([pa.array(code), pa.array(n)], ["code", "n"])

    found = pairs.mapInArrow(run, "code long, n long").groupBy("code").agg(F.sum("n").alias("n")).orderBy("code").toArrow()
    code, n = (np.asarray(found.column(c), np.int64) for c in ("code", "n"))
    few, code, n = n[code < 0], code[code >= 0], n[code >= 0]
    medians = {}
    for k in np.unique(code >> 20):
        own = (code >> 20) == k
        upto = np.cumsum(n[own])
        step = (code[own] & ((1 << 20) - 1))[np.searchsorted(upto, (upto[-1] + 1) // 2)] - (1 << 19)
        medians[int(k)] = int(upto[-1]), float(2 ** ((step + 0.5) / STEPS))
    return spreads(medians), _discount(few[:2], few[2:])


def known_labels(labels: DataFrame) -> DataFrame:
    """(__id, toxic) of the labels outside the test fold."""
    known = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").where(fold_of(F.col("doc_id")) != HELD_OUT)
    return known.groupBy(F.col("doc_id").cast("long").alias("__id")).agg((F.max("toxic") > 0).cast("long").alias("toxic"))


def labelled_texts(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(fold, text, toxic) of the labelled documents outside the test fold."""
    own = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    # one plan at every size: labels grow with the documents, so they aren't broadcast
    return own.where(fold_of(F.col("id")) != HELD_OUT).join(known_labels(labels).hint("merge"), F.col("id") == F.col("__id")).select(
        fold_of(F.col("id")).alias("fold"), F.coalesce("text", F.lit("")).alias("text"), "toxic")


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> Model | float:
    """The model, or the share of toxic labels where a class is missing."""
    with shuffles_removed(docs.sparkSession):
        model = _learn(docs, labels, id_col, text_col)
        if not isinstance(model, float):
            rows = _rows(docs, id_col, text_col).where(fold_of(F.col("doc_id")) == CALIBRATION)
            _calibrate(model, _raw(rows, model, ["doc_id"], passes=1), labels)
        return model


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))


def _scored(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str) -> tuple[DataFrame, Model] | float:
    """(doc_id, tie, mean, n) of every row and the model, whose curve is fitted
    to those rows that calibrate; or the share of toxic labels."""
    with shuffles_removed(docs.sparkSession):
        model = _learn(docs, labels, id_col, text_col)
        if isinstance(model, float):
            return model
        raw = stored(_raw(_rows(docs, id_col, text_col), model, ["doc_id"]), "log-odds")
        _calibrate(model, raw, labels)
        return raw, model


def _calibrate(model: Model, raw: DataFrame, labels: DataFrame) -> None:
    """Fit the curve to all labelled rows of the calibration fold."""
    rows = raw.where(fold_of(F.col("doc_id")) == CALIBRATION).join(known_labels(labels).hint("merge"), F.col("doc_id") == F.col("__id"))
    steps = rows.groupBy(F.floor(F.col("mean") * CURVE_STEPS).alias("step")).agg(
        F.sum("mean").alias("sum"), F.sum("toxic").alias("toxic"), F.count(F.lit(1)).alias("n"))
    found = steps.select("sum", "toxic", "n").toArrow()
    x, y, n = (np.asarray(found.column(c), np.float64) for c in ("sum", "toxic", "n"))
    if 0 < y.sum() < n.sum():
        model.curve.slope, model.curve.shift = fit_curve(x / n, y, n)


def _learn(docs: DataFrame, labels: DataFrame, id_col: str, text_col: str) -> Model | float:
    small_batches(docs.sparkSession)
    rows = labelled_texts(docs, labels, id_col, text_col)
    spark = docs.sparkSession
    pairs = stored(_pair_counts(rows.where(F.col("fold") != CALIBRATION)), "bigrams")
    both = (F.sum("ordinary").alias("ordinary"), F.sum("toxic").alias("toxic"))
    word, context = F.pmod("key", F.lit(WORDS)), F.floor(F.col("key") / WORDS)
    words = pairs.groupBy(word.alias("slot")).agg(*both, F.count(F.lit(1)).alias("more"), F.lit(0).cast("long").alias("most"))
    contexts = pairs.groupBy(context.alias("slot")).agg(
        *both, F.count_if(F.col("ordinary") > 0).alias("more"), F.count_if(F.col("toxic") > 0).alias("most"))
    # at most 2 * WORDS rows, whatever the corpus: one task makes the arrays of them
    counted = reduce(DataFrame.unionByName, [part.select(F.lit(k).alias("kind"), "slot", "ordinary", "toxic", "more", "most")
                                             for k, part in enumerate((words, contexts))])
    built = counted.repartition(1).mapInArrow(_word_slots, _PIECE)
    curve = Curve(float(rows.agg(F.avg("toxic")).first()[0] or 0.0))
    arrays = {name: np.frombuffer(data, np.float32) for name, data in _fetched(built).items()}
    if not arrays:  # a class is missing
        return curve.prior
    shared = spark.sparkContext.broadcast(Slots(
        arrays["word"], arrays["ordinary"], arrays["seen"].reshape(-1, 2), arrays["successors"].reshape(-1, 2)))
    spread, less = _usual(pairs, shared)

    def rate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            key, counts = _counts(batch)
            weight = np.rint(shared.value.weights(key, counts, spread, less) * UNIT).astype(np.int64)
            n = counts.sum(axis=1).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(pair_slot(key)), pa.array(n), pa.array(key), pa.array(weight)], ["slot", "n", "key", "weight"])

    schema = "slot long, n long, key long, weight long"

    def weighed(part: int = 0, passes: int = 1) -> DataFrame:
        own = pairs if passes == 1 else pairs.where(F.pmod("key", F.lit(passes)) == part)
        return own.mapInArrow(rate, schema).select("key", "weight")

    # bigrams seen once would gain little in the cache, and are most
    top = pairs.where(F.col("ordinary") + F.col("toxic") > 1).mapInArrow(rate, schema).groupBy("slot").agg(F.max(F.struct("n", "key", "weight")).alias("top")).select("slot", "top.key", "top.weight")
    cache = _fetched(top.repartition(1).mapInArrow(_cache, _PIECE))
    table = spark.sparkContext.broadcast(Table(
        arrays["word"], np.frombuffer(cache["keys"], np.int64), np.frombuffer(cache["bigram"], np.float32)))
    return Model(table, weighed, curve)


def _raw(rows: DataFrame, model: Model, keep: list[str], passes: int = PASSES) -> DataFrame:
    """The columns ``keep``, ``tie`` (a hash of the text), ``mean`` log-odds and
    ``n``, the number of words, of every row of (``keep``, text)."""
    shared = model.table
    rows = rows.select(*keep, F.xxhash64(F.coalesce("text", F.lit(""))).alias("tie"), "text")
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*keep).schema), "tie long, sum double, n long"])

    def known(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column("text"))
            found = [(np.zeros(0), np.zeros(0, np.int64))]
            for i, j in pieces(offsets):
                found.append(shared.value.raw(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]))
            sums, n = (np.concatenate(x) for x in zip(*found))
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(c) for c in (*keep, "tie")), pa.array(sums), pa.array(n.astype(np.int64))], [*keep, "tie", "sum", "n"])

    def others(part: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column("text"))
            tie = np.asarray(batch.column("tie"))
            for i, j in pieces(offsets):
                doc, key, times = shared.value.others(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], part, passes)
                yield pa.RecordBatch.from_arrays([pa.array(tie[i:j][doc]), pa.array(key), pa.array(times)], ["tie", "key", "times"])

    # copies of a text add up to as many times its sum
    sums = [rows.groupBy("tie").agg(F.lit(0).cast("long").alias("more"), F.count(F.lit(1)).alias("copies"))]
    for part in range(passes):
        found = rows.select("tie", "text").mapInArrow(partial(others, part), "tie long, key long, times long")
        weights = model.weights(part, passes).withColumnRenamed("key", "own")
        each = found.join(weights.hint("merge"), F.col("key") == F.col("own"))
        each = each.groupBy("tie").agg(F.sum(F.col("times") * F.col("weight")).alias("more"))
        with shuffles_removed(rows.sparkSession):
            sums.append(stored(each.withColumn("copies", F.lit(0).cast("long")), "odds"))
    more = reduce(DataFrame.unionByName, sums).groupBy(F.col("tie").alias("text_tie")).agg(
        (F.sum("more") / F.sum("copies") / UNIT).alias("more"))
    out = rows.select(*keep, "tie", "text").mapInArrow(known, schema).join(more.hint("merge"), F.col("tie") == F.col("text_tie"))
    return out.select(*keep, "tie", ((F.col("sum") + F.col("more")) / F.greatest("n", F.lit(1))).alias("mean"), "n")


def _score(model: Model) -> Column:
    """The curve at ``mean`` of ``_raw``."""
    c = model.curve
    if c.slope <= 0:
        return F.lit(c.prior)
    at = F.greatest(F.least(F.col("mean") * c.slope + c.shift, F.lit(500.0)), F.lit(-500.0))
    return F.when(F.col("n") > 0, 1 / (1 + F.exp(-at))).otherwise(F.lit(c.prior))


def score(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, held_out, score, predicted) of every row."""
    found = _scored(docs, labels, id_col, text_col)
    if isinstance(found, float):
        out = _rows(docs, id_col, text_col).select("doc_id", F.lit(found).alias("score"))
    else:
        raw, model = found
        out = raw.select("doc_id", _score(model).alias("score"))
    return out.select("doc_id", (fold_of(F.col("doc_id")) == HELD_OUT).alias("held_out"), "score",
                      (F.col("score") >= 0.5).cast("int").alias("predicted"))


def without_toxic(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose score is below one half."""
    found = _scored(docs, labels, id_col, text_col)
    if isinstance(found, float):
        return docs if found < 0.5 else docs.limit(0)
    raw, model = found
    text = F.col(f"`{text_col}`").cast("string")
    toxic = raw.where(_score(model) >= 0.5)
    # equal texts have equal scores
    (own,) = unused(docs, "own")
    toxic = stored(toxic.select(F.col("tie").alias(own)).distinct(), "toxic")
    return docs.join(toxic, F.xxhash64(F.coalesce(text, F.lit(""))) == F.col(own), "left_anti")
