"""SimHash near-duplicates by covering locality-sensitive hashing.

Fingerprint: 64 bits; a bit is 1 if it is set in over half of the XXH64
values (seed 42) of a text's 4-word shingles, A-Z in lower case.

Search: every bit position gets a non-zero vector of r + 1 bits (r is the
radius); for each of the 2^(r+1) - 1 non-zero vectors v, the mask of v has
the positions whose vector has an odd inner product with v.  The vectors of
at most r differing positions span less than the whole space, so some v is
orthogonal to all of them: under its mask the two fingerprints are equal.
Thus every pair within the radius collides in at least one of the 31 tables,
without exception, and a comparison of the colliding fingerprints gives
exactly the links.

Only distinct fingerprints enter the tables, so copies of a text cost
nothing.  A bucket with more than ``LARGE`` fingerprints is refined: the
bits outside its mask get masks of their own by the same construction, which
again no pair within the radius escapes; a refined bucket has at most 2^16
fingerprints because at least 48 bits are then fixed.  A bucket emits a
spanning forest of its links, not its pairs.  Components come from
alternating large-star and small-star steps over the links, each step
written to the shared folder.

Defined results: a null or empty text, or one without words, has fingerprint
zero and is linked like any other; a text of one to three words has one
shingle; null ids get a component like others (its smallest non-null id, or
null if it has none); repeated rows are equal; an empty table gives an empty
result; extra columns are ignored by ``components`` and kept by
``one_of_each``."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from deidlake.llm.common import lower_ascii, small_batches, partitions, pieces, scratch, stored, unused, utf8, word_spans

BITS = 64
SHINGLE = 4
RADIUS = 4
SEED = 42
LARGE = 2048


# ------------------------------------------------------------- fingerprints

def fingerprints_of(data: np.ndarray, offsets: np.ndarray, shingle: int = SHINGLE) -> np.ndarray:
    """Fingerprints (uint64) of consecutive texts."""
    n = len(offsets) - 1
    start, end, first = word_spans(data, offsets)
    if not len(start):
        return np.zeros(n, np.uint64)
    # the words again, with single spaces between them
    size = end - start
    to = np.cumsum(size + 1) - size - 1
    normal = np.full(int((size + 1).sum()), 32, np.uint8)
    normal[np.repeat(to - np.cumsum(size) + size, size) + np.arange(int(size.sum()))] = lower_ascii(
        data[np.repeat(start - np.cumsum(size) + size, size) + np.arange(int(size.sum()))])
    whole = normal.tobytes()
    counts = np.diff(first)
    shingles = np.where(counts > 0, np.maximum(counts - shingle + 1, 1), 0)
    doc = np.repeat(np.arange(n), shingles)
    begin = np.arange(int(shingles.sum())) - np.repeat(np.cumsum(shingles) - shingles, shingles) + first[:-1][doc]
    last = np.minimum(begin + shingle, first[1:][doc]) - 1
    parts = [whole[a:b] for a, b in zip(to[begin].tolist(), (to[last] + size[last]).tolist())]
    hashes = np.fromiter(map(xxhash.xxh64_intdigest, parts, repeat(SEED)), np.uint64, len(parts))
    out = np.zeros(n, np.uint64)
    has = np.flatnonzero(shingles)
    starts = (np.cumsum(shingles) - shingles)[has]
    for low in range(0, BITS, 8):  # eight bits of all shingles at a time
        bits = np.unpackbits(((hashes >> np.uint64(low)) & np.uint64(255)).astype(np.uint8)[:, None], axis=1, bitorder="little")
        sums = np.add.reduceat(bits, starts, axis=0, dtype=np.int64)
        major = 2 * sums > shingles[has][:, None]
        out[has] |= np.packbits(major, axis=1, bitorder="little")[:, 0].astype(np.uint64) << np.uint64(low)
    return out


def with_fingerprint(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(id, tie, fp) of every row: a hash of the text, and the fingerprint as
    a signed 64-bit integer."""
    text = F.col(f"`{text_col}`")
    source = docs.select(F.col(f"`{id_col}`").cast("long").alias("id"), _tie(text).alias("tie"), text.cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column("text"))
            fps = [fingerprints_of(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i], shingle)
                   for i, j in pieces(offsets)]
            fps = np.concatenate(fps) if fps else np.zeros(0, np.uint64)
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("tie"), pa.array(fps.view(np.int64))],
                                             ["id", "tie", "fp"])

    return source.mapInArrow(run, "id long, tie long, fp long")


def _tie(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text.cast("string"), F.lit("")))


# ------------------------------------------------------------ covering masks

def covering_masks(bits: list[int], radius: int = RADIUS) -> np.ndarray:
    """One mask (uint64) for each non-zero vector of radius + 1 bits.  The
    vectors are dealt to the bit positions in turn, so that every mask has
    about half of them."""
    size = (1 << (radius + 1)) - 1
    vector = {b: k % size + 1 for k, b in enumerate(bits)}
    return np.array([sum(1 << b for b in bits if bin(vector[b] & v).count("1") % 2) for v in range(1, size + 1)], np.uint64)


class Union:
    """Disjoint sets over 0..n-1."""

    def __init__(self, n: int):
        self.parent = np.arange(n)

    def find(self, x: int) -> int:
        parent = self.parent
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    def join(self, a: int, b: int) -> bool:
        a, b = self.find(a), self.find(b)
        if a == b:
            return False
        self.parent[max(a, b)] = min(a, b)
        return True


def _forest(fps: np.ndarray, radius: int, sets: Union, members: np.ndarray, out: list) -> None:
    """Add the links among ``members`` (indices into ``fps``) that join two
    sets.  Everything within the radius of a row is linked in one go."""
    values = fps[members]
    for k in range(len(members) - 1):
        near = np.flatnonzero(np.bitwise_count(values[k + 1:] ^ values[k]) <= radius) + k + 1
        for j in near.tolist():
            if sets.join(int(members[k]), int(members[j])):
                out.append((values[k], values[j]))


def _buckets(keys: np.ndarray) -> Iterator[np.ndarray]:
    order = np.argsort(keys, kind="stable")
    cuts = np.flatnonzero(np.diff(keys[order])) + 1
    for group in np.split(order, cuts) if len(order) else ():
        if len(group) > 1:
            yield group


def links_within(fps: np.ndarray, radius: int = RADIUS) -> np.ndarray:
    """Spanning forest, as pairs, of the links among distinct fingerprints of
    one bucket, whatever its size: refined where it is large."""
    out: list = []
    sets = Union(len(fps))
    if len(fps) <= LARGE:
        _forest(fps, radius, sets, np.arange(len(fps)), out)
    else:
        varying = int(np.bitwise_or.reduce(fps ^ fps[0]))
        for mask in covering_masks([b for b in range(BITS) if varying >> b & 1], radius):
            for members in _buckets(fps & mask):
                _forest(fps, radius, sets, members, out)
    return np.array(out, np.uint64).reshape(-1, 2)


def links(distinct: DataFrame, radius: int = RADIUS) -> DataFrame:
    """(a, b) links (a < b) that connect the distinct fingerprints ``fp``
    like all links within the radius do."""
    spark = distinct.sparkSession
    masks = covering_masks(list(range(BITS)), radius)
    signed = [int(m) - (1 << 64) if int(m) >= 1 << 63 else int(m) for m in masks]
    table = F.array(*[F.struct(F.lit(k).cast("short").alias("k"), F.lit(m).cast("long").alias("mask"))
                      for k, m in enumerate(signed)])
    rows = distinct.select("fp", F.explode(table).alias("t")).select(
        "fp", F.col("t.k").alias("k"), F.col("fp").bitwiseAND(F.col("t.mask")).alias("part"))
    dealt = rows.repartition(partitions(spark), "k", "part").select("fp", "k")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = [(np.asarray(b.column("fp"), np.int64).view(np.uint64), np.asarray(b.column("k"), np.int16)) for b in batches]
        if not kept:
            return
        fps, ks = (np.concatenate(x) for x in zip(*kept))
        found = []
        for k in np.unique(ks):
            mine = np.unique(fps[ks == k])
            for members in _buckets(mine & masks[k]):
                found.append(links_within(mine[members], radius))
        pairs = np.sort(np.concatenate(found).view(np.int64), axis=1) if found else np.zeros((0, 2), np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(pairs[:, 0]), pa.array(pairs[:, 1])], ["a", "b"])

    return dealt.mapInArrow(run, "a long, b long").distinct()


# --------------------------------------------------------------- components

def connected(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b): root is the least node
    of its component.  Alternates large-star and small-star until the set of
    edges stays the same; the number of rounds grows with the logarithm of
    the size of the components."""
    spark = edges.sparkSession
    path = scratch(spark, "components")
    current, mark, turn = None, None, 0

    def keep(df: DataFrame) -> tuple[DataFrame, tuple]:
        nonlocal turn
        turn += 1
        df.write.parquet(f"{path}/{turn}")
        df = spark.read.schema("node long, to long").parquet(f"{path}/{turn}")
        row = df.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("node", "to").cast("decimal(38,0)")).alias("h")).first()
        return df, (row["n"], row["h"])

    def star(df: DataFrame, large: bool) -> DataFrame:
        """Each neighbour (large: those above the node, else those below or
        equal and the node) gets an edge to the least of all neighbours."""
        both = df.unionByName(df.select(F.col("to").alias("node"), F.col("node").alias("to"))) if large else df
        least = both.groupBy("node").agg(F.min("to").alias("least"))
        least = least.select("node", F.least("least", "node").alias("least"))
        joined = both.join(least, "node")
        if large:
            moved = joined.where("to > node").select(F.col("to").alias("node"), F.col("least").alias("to"))
        else:
            moved = joined.select(F.col("to").alias("node"), F.col("least").alias("to")).unionByName(
                least.select("node", F.col("least").alias("to")))
        return moved.where("node <> to").distinct()

    current, mark = keep(edges.select(F.greatest("a", "b").alias("node"), F.least("a", "b").alias("to")).where("node <> to").distinct())
    while mark[0]:
        following, new = keep(star(star(current, True), False))
        if new == mark:
            break
        current, mark = following, new
    return current.select("node", F.col("to").alias("root"))


def components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
               radius: int = RADIUS) -> DataFrame:
    """(id, tie, fp, root, component_id) of every row; ``root`` names the
    component, ``tie`` is a hash of the text."""
    small_batches(docs.sparkSession)
    prints = stored(with_fingerprint(docs, id_col, text_col, shingle), "fingerprints")
    distinct = prints.groupBy("fp").agg(F.min("id").alias("least"))
    roots = connected(links(distinct.select("fp"), radius))
    rooted = distinct.join(roots, distinct["fp"] == roots["node"], "left").select(
        "fp", F.coalesce("root", "fp").alias("root"), "least")
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return prints.join(rooted.join(least, "root").select("fp", "root", "component_id"), "fp")


def digests(docs: DataFrame) -> DataFrame:
    out = components(docs)
    return out.select(F.col("id").alias("doc_id"), F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                radius: int = RADIUS) -> DataFrame:
    """One row of ``docs`` for each component: that with the smallest id
    (null last), then the smallest hash of the text."""
    found = components(docs, id_col, text_col, shingle, radius)
    first = found.groupBy("root").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "tie")).alias("row"))
    id_, tie, own_id, own_tie, number = unused(docs, "id", "tie", "own_id", "own_tie", "number")
    first = stored(first.select(F.col("row.id").alias(id_), F.col("row.tie").alias(tie)), "representatives")
    names = [F.col(f"`{c}`") for c in docs.columns]
    keyed = docs.select(*names, F.col(f"`{id_col}`").cast("long").alias(own_id), _tie(F.col(f"`{text_col}`")).alias(own_tie))
    kept = keyed.join(first, keyed[own_id].eqNullSafe(first[id_]) & (keyed[own_tie] == first[tie]), "left_semi")
    one = F.row_number().over(Window.partitionBy(own_id, own_tie).orderBy(*[F.xxhash64(c) for c in names]))
    return kept.withColumn(number, one).where(F.col(number) == 1).select(*names)
