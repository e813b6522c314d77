"""Near-duplicate vectors by Euclidean p-stable hashing.

Vectors are scaled to length 1, so a cosine of at least c is a distance of at
most sqrt(2 - 2c).  A table hashes a vector by ``k`` projections on Gaussian
directions, each cut into steps of ``WIDTH`` times that distance; two vectors
in the same steps share a bucket, and the cosine of every pair of a bucket is
computed in double precision.  ``k`` grows with the logarithm of the largest
label's number of vectors, so that unrelated vectors keep to a bounded number a
bucket, and the number of tables makes a pair at the threshold collide with
probability ``RECALL`` (closer pairs more often).

Vectors and directions are rounded to multiples of 2^-16 before they are
multiplied: the sums are then whole numbers below 2^53, exact in any order,
so a task can compute again in which earlier tables a pair has met.  Each link
is counted in the first of them only, and no list of pairs is kept.

Equal vectors of a label are one class with a count.  A bucket of more than
``BLOCK`` classes is cut into blocks by a hash; each pair of blocks is a cell
of its own, so no task holds more than two blocks.  A cell returns for each
class the weight of its links and a spanning forest of them; components come
from the forests.  In a group of m different vectors that are all alike, m^2
cosines are computed, as the number of links of each asks for.

Defined results: a vector that is null, empty or zero, or holds nulls or
numbers that aren't finite, and a row without a label, has no links and its
own id as component.  Vectors of different length are never linked.  A null id
takes part like others; its component is the smallest id that isn't null (null
if there is none) and it is not kept.  Repeated rows are vectors of their own,
linked with each other.  An empty table gives an empty result; other columns
are ignored by ``components`` and kept by ``one_of_each``."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, FloatType

from deidlake.llm.common import mix64, partitions, small_batches, stored, unused
from deidlake.llm.simhash import connected

THRESHOLD = 0.93
#: A step in units of the distance at the threshold.
WIDTH = 4.0
#: Probability that a pair just at the threshold shares a bucket.
RECALL = 0.999
#: Vectors of a label that may share a bucket by chance, on average.
BY_CHANCE = 256
#: Classes of a bucket that are compared in one go.
BLOCK = 4096
#: Rows of a block that are multiplied at once.
STRIP = 512
SEED = 13
GRID = float(1 << 16)


class Tables:
    """Hash tables for vectors of any length."""

    def __init__(self, largest: int, threshold: float = THRESHOLD):
        self.threshold = threshold
        near = math.sqrt(2 - 2 * threshold)
        self.width = WIDTH * near
        self.steps = max(1, math.ceil(math.log(max(largest / BY_CHANCE, 1)) / -math.log(self._same(math.sqrt(2)))))
        self.number = math.ceil(math.log(1 - RECALL) / math.log(1 - self._same(near) ** self.steps))
        self._made: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def _same(self, distance: float) -> float:
        """Probability of the same step for two vectors at a distance."""
        r = self.width / distance
        return math.erf(r / math.sqrt(2)) - math.sqrt(2 / math.pi) / r * (1 - math.exp(-r * r / 2))

    def _directions(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        if size not in self._made:
            rnd = np.random.default_rng([SEED, size])
            n = self.steps * self.number
            self._made[size] = (np.rint(rnd.standard_normal((size, n)) * GRID), rnd.random(n) * self.width)
        return self._made[size]

    def keys(self, unit: np.ndarray, first: int | None = None) -> np.ndarray:
        """Bucket (int64) of each vector in each table, or in the first ones."""
        number = self.number if first is None else first
        direction, shift = self._directions(unit.shape[1])
        n = number * self.steps
        step = np.floor((np.rint(unit * GRID) @ direction[:, :n] / (GRID * GRID) + shift[:n]) / self.width)
        step = step.astype(np.int64).view(np.uint64).reshape(len(unit), number, self.steps)
        key = np.zeros((len(unit), number), np.uint64)
        for k in range(self.steps):
            key = mix64(key ^ step[:, :, k], k)
        return key.view(np.int64)


def units(values: np.ndarray) -> np.ndarray:
    """Rows of finite numbers, none all zero, scaled to length 1."""
    values = values / np.abs(values).max(axis=1, keepdims=True)
    return values / np.sqrt((values * values).sum(axis=1, keepdims=True))


# ------------------------------------------------------------------- classes

def _rows(df: DataFrame, id_col: str, vector_col: str, label_col: str) -> tuple[DataFrame, str]:
    """(id, grp, digest, vec) of every row: ``grp`` names label and length,
    ``vec`` has the numbers' bytes; digest and vec are null where the row links
    with nothing.  Also the numbers' type."""
    kind = df.schema[vector_col].dataType
    single = isinstance(kind, ArrayType) and isinstance(kind.elementType, FloatType)
    code, numbers = ("<f4", "array<float>") if single else ("<f8", "array<double>")
    vector, label = F.col(f"`{vector_col}`").cast(numbers), F.col(f"`{label_col}`").cast("string")
    source = df.select(F.col(f"`{id_col}`").cast("long").alias("id"),
                       F.when(F.size(vector) > 0, F.concat_ws(":", F.size(vector).cast("string"), label)).alias("grp"),
                       F.when(label.isNotNull(), vector).alias("vector"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column("vector")
            flat = vectors.flatten()
            whole = flat.is_valid().to_numpy(zero_copy_only=False)
            numbers = flat.fill_null(0).to_numpy(zero_copy_only=False).astype(code)
            fine = whole & np.isfinite(numbers)
            at = np.concatenate([[0], np.cumsum(vectors.value_lengths().fill_null(0).to_numpy(zero_copy_only=False))]).astype(np.int64)
            bad = np.concatenate([[0], np.cumsum(~fine)])
            some = np.concatenate([[0], np.cumsum(numbers != 0)])
            good = (at[1:] > at[:-1]) & (bad[at[1:]] == bad[at[:-1]]) & (some[at[1:]] > some[at[:-1]])
            vec = [numbers[a:b].tobytes() if g else None for a, b, g in zip(at[:-1].tolist(), at[1:].tolist(), good.tolist())]
            digest = [v and hashlib.blake2b(v, digest_size=16).digest() for v in vec]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("grp"), pa.array(digest, pa.binary()), pa.array(vec, pa.binary())],
                ["id", "grp", "digest", "vec"])

    return source.mapInArrow(run, "id long, grp string, digest binary, vec binary"), code


# --------------------------------------------------------------------- cells

def _keyed(classes: DataFrame, tables: Tables, code: str, with_vector: bool) -> DataFrame:
    """(table, key, grp, node[, n, vec]) of every class and table."""
    schema = "table int, key long, grp string, node long" + (", n long, vec binary" if with_vector else "")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = np.array([len(v) for v in batch.column("vec").to_pylist()])
            for length in np.unique(size).tolist():
                mine = np.flatnonzero(size == length)
                part = batch.take(pa.array(mine))
                keys = tables.keys(units(_matrix(part.column("vec"), code)))
                for t in range(tables.number):
                    columns = [pa.array(np.full(len(mine), t, np.int32)), pa.array(keys[:, t]), part.column("grp"), part.column("node")]
                    columns += [part.column("n"), part.column("vec")] if with_vector else []
                    yield pa.RecordBatch.from_arrays(columns, [f.split()[0] for f in schema.split(", ")])

    return classes.mapInArrow(run, schema)


def _matrix(vec: pa.Array, code: str) -> np.ndarray:
    """Vectors of one length as rows of doubles."""
    joined = b"".join(vec.to_pylist())
    return np.frombuffer(joined, code).reshape(len(vec), -1).astype(float) if len(vec) else np.zeros((0, 1))


def _whole_cells(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[tuple[pa.Table, list[tuple[int, int]]]]:
    """Sorted rows cut into tables that end with a cell, and the rows [a, b)
    of their cells of two rows or more; one unfinished cell is held back."""
    held: list[pa.RecordBatch] = []

    def cut(table: pa.Table) -> np.ndarray:
        new = np.zeros(len(table), bool)
        for name in names:
            codes = table.column(name).combine_chunks()
            codes = codes.dictionary_encode().indices if pa.types.is_string(codes.type) else codes
            codes = codes.to_numpy(zero_copy_only=False)
            new[1:] |= codes[1:] != codes[:-1]
        new[:1] = True
        return np.flatnonzero(new)

    def found(table: pa.Table, starts: np.ndarray) -> tuple[pa.Table, list[tuple[int, int]]]:
        ends = np.append(starts[1:], len(table))
        several = ends - starts > 1
        return table, list(zip(starts[several].tolist(), ends[several].tolist()))

    def key(batch: pa.RecordBatch, row: int) -> list:
        return [batch.column(n)[row].as_py() for n in names]

    for batch in batches:
        if not batch.num_rows:
            continue
        if held and key(held[0], 0) == key(batch, batch.num_rows - 1):
            held.append(batch)  # one long cell
            continue
        table = pa.Table.from_batches([*held, batch])
        starts = cut(table)
        last = int(starts[-1])
        held = table.slice(last).combine_chunks().to_batches()
        if last:
            yield found(table.slice(0, last), starts[:-1])
    if held:
        table = pa.Table.from_batches(held)
        yield found(table, cut(table))


def links_of_cell(unit: np.ndarray, keys: np.ndarray, side: np.ndarray | None, threshold: float) -> tuple[np.ndarray, list]:
    """Which rows of a cell are linked, without pairs that met in an earlier
    table (same entry of ``keys``), and a spanning forest of these links.
    ``side`` tells the two blocks of a cell apart: only pairs across count."""
    n = len(unit)
    adjacent = np.zeros((n, n), bool)
    for a in range(0, n, STRIP):
        near = unit[a:a + STRIP] @ unit.T >= threshold
        p, q = np.nonzero(near)
        p += a
        new = p < q
        if side is not None:
            new &= side[p] != side[q]
        p, q = p[new], q[new]
        met = np.zeros(len(p), bool)
        for t in range(keys.shape[1]):
            met |= keys[p, t] == keys[q, t]
        p, q = p[~met], q[~met]
        adjacent[p, q] = adjacent[q, p] = True
    forest, waiting = [], adjacent.any(axis=1)
    for start in np.flatnonzero(waiting).tolist():
        if not waiting[start]:
            continue
        waiting[start] = False
        queue = [start]
        while queue:
            v = queue.pop()
            following = np.flatnonzero(adjacent[v] & waiting)
            waiting[following] = False
            forest.append(np.stack([np.full(len(following), v), following], 1))
            queue.extend(following.tolist())
    return adjacent, forest


def links(classes: DataFrame, tables: Tables, code: str) -> DataFrame:
    """From classes (node, grp, n, vec): rows (a, null, n), to be summed up, of
    the weight of a class's links, and (a, b, null) of a spanning forest."""
    spark = classes.sparkSession
    large = _keyed(classes, tables, code, False).groupBy("table", "key", "grp").count().where(F.col("count") > BLOCK)
    large = stored(large.select("table", "key", "grp", F.ceil(F.col("count") / BLOCK).cast("int").alias("blocks")), "large-buckets")
    dealt = _keyed(classes, tables, code, True).join(large, ["table", "key", "grp"], "left").withColumn(
        "blocks", F.coalesce("blocks", F.lit(1))).withColumn("own", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).withColumns(
        {"i": F.least("own", "other"), "j": F.greatest("own", "other")})
    cell = ["table", "key", "grp", "i", "j"]
    dealt = dealt.select(*cell, "own", "node", "n", "vec").repartition(partitions(spark), *cell).sortWithinPartitions(*cell)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table, found in _whole_cells(batches, cell):
            for a, b in found:
                rows = table.slice(a, b - a)
                unit = units(_matrix(rows.column("vec").combine_chunks(), code))
                keys = tables.keys(unit, int(rows.column("table")[0].as_py()))
                own = rows.column("own").to_numpy()
                i, j = rows.column("i")[0].as_py(), rows.column("j")[0].as_py()
                adjacent, forest = links_of_cell(unit, keys, None if i == j else own == i, tables.threshold)
                node, n = rows.column("node").to_numpy(), rows.column("n").to_numpy()
                has = np.flatnonzero(adjacent.any(axis=1))
                if not len(has):
                    continue
                weight = np.array([n[adjacent[v]].sum() for v in has.tolist()], np.int64)
                pairs = np.concatenate(forest)
                ends = [node[has], node[pairs[:, 0]]], [np.zeros(len(has), np.int64), node[pairs[:, 1]]]
                edge = np.concatenate([np.zeros(len(has), bool), np.ones(len(pairs), bool)])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(ends[0])), pa.array(np.concatenate(ends[1]), mask=~edge),
                     pa.array(np.concatenate([weight, np.zeros(len(pairs), np.int64)]), mask=edge)], ["a", "b", "n"])

    return dealt.mapInArrow(run, "a long, b long, n long")


# ------------------------------------------------------------------- results

def components(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
               threshold: float = THRESHOLD) -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row."""
    spark = df.sparkSession
    small_batches(spark)
    rows, code = _rows(df, id_col, vector_col, label_col)
    rows = stored(rows, "vectors")
    classes = rows.where("digest is not null").groupBy("grp", "digest").agg(
        F.count(F.lit(1)).alias("n"), F.min("id").alias("least"), F.first("vec").alias("vec"))
    classes = stored(classes.withColumn("node", F.monotonically_increasing_id()), "vector-classes")
    largest = classes.groupBy("grp").count().agg(F.max("count").alias("n")).first()["n"] or 0
    found = stored(links(classes, Tables(largest, threshold), code), "vector-links")
    roots = connected(found.where("b is not null").select("a", "b"))
    weight = found.where("b is null").groupBy(F.col("a").alias("node")).agg(F.sum("n").alias("links"))
    known = classes.select("grp", "digest", "n", "least", "node").join(weight, "node", "left").join(roots, "node", "left").withColumn(
        "root", F.coalesce("root", "node"))
    least = known.groupBy("root").agg(F.min("least").alias("component_id"))
    known = known.join(least, "root").select(
        "grp", "digest", "component_id", (F.col("n") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"))
    alone = F.col("digest").isNull()
    return rows.drop("vec").join(known, ["grp", "digest"], "left").select(
        F.col("id").alias("vec_id"), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(alone, F.col("id")).otherwise(F.col("component_id")).alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))


def one_of_each(df: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label",
                threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``df`` whose id is their component's smallest (rows that
    share such an id all stay)."""
    own, = unused(df, "own")
    found = components(df, id_col, vector_col, label_col, threshold).where("kept").select(F.col("vec_id").alias(own)).distinct()
    keyed = df.withColumn(own, F.col(f"`{id_col}`").cast("long"))
    return keyed.join(found, own, "left_semi").select(*[F.col(f"`{c}`") for c in df.columns])


COMPONENTS_SQL = f"""
WITH RECURSIVE e AS (SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
good AS (SELECT * FROM e WHERE label IS NOT NULL AND len(v) > 0 AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0
         AND list_dot_product(v, v) > 0),
link AS (SELECT a.vec_id AS a, b.vec_id AS b FROM good a JOIN good b ON a.label = b.label AND len(a.v) = len(b.v) AND a.vec_id <> b.vec_id
         WHERE list_cosine_similarity(a.v, b.v) >= {THRESHOLD}),
reach AS (SELECT a, b FROM link UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a),
found AS (SELECT vec_id, (SELECT count(*) FROM link WHERE a = vec_id) AS n_links,
                 coalesce(least(vec_id, (SELECT min(b) FROM reach WHERE a = vec_id)), vec_id) AS component_id FROM e)
SELECT vec_id, n_links::BIGINT AS n_links, component_id, vec_id = component_id AS kept FROM found
"""
