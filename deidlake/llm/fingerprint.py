"""Document fingerprints: a homomorphic hash of the multiset of paragraphs.

A paragraph (line of a text) is hashed to a wide vector; the fingerprint of a
text is the sum of its paragraphs' vectors, each lane modulo 2^32.  Sums don't
depend on the order, and paragraphs can be added or deleted without the rest
of the text (``add``, ``subtract``).

A paragraph's vector has three parts.  ``EXACT`` lanes are the 32-bit words
of a 256-bit cryptographic hash of the whole paragraph: equal sums mean, but
for a negligible chance, equal multisets of fewer than 2^32 paragraphs.  ``SKETCH``
lanes add up +1 or -1 for each word triple of the paragraph (a shorter
paragraph is one shingle), and the last lane counts the shingles.  The mean
square of the sketch lanes estimates the sum of the squared counts of a text's
shingles (the tug-of-war sketch), and so does that of the difference of two
fingerprints, in which everything the texts share cancels.  The likeness is
1 - |a - b|^2 / (|a|^2 + |b|^2): 0 if no shingle is shared, 1 if all counts
agree, however often a line is repeated.  Sketch lanes are read as signed
numbers; no text that a column holds (2^31 bytes) has shingles to overflow them.

Defined results: a null text is an empty one; empty texts have the zero
vector and likeness 1 to each other; equal texts have equal fingerprints and
likeness 1; for the edited text, documents follow each other by descending
id (null last), rows with one id by descending hash of the text; a single
document follows itself; an empty table gives an empty result; extra columns
are ignored."""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b, sha256

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deidlake.llm.common import NO_ID, mix64, small_batches, partitions, pieces, rolling, utf8, word_hashes, word_spans

EXACT, SKETCH = 8, 96
SHINGLE = 3
LANES = EXACT + SKETCH + 1
_TRIPLE = 0x8C4B2D19E3F7A651


def vectors(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Fingerprints (texts, LANES) of uint32 of consecutive texts."""
    n = len(offsets) - 1
    out = np.zeros((n, LANES), np.uint32)
    if not len(data):
        return out
    # paragraphs: the bytes between newlines
    newline = np.flatnonzero(data == 10)
    cuts = np.unique(np.concatenate([offsets, newline, newline + 1]))
    start, end = cuts[:-1], cuts[1:]
    keep = (data[start] != 10) & (end > start)
    start, end = start[keep], end[keep]
    doc = np.searchsorted(offsets, start, side="right") - 1
    # rows of equal documents are neighbours, so sums go by segments
    edges = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]])) if len(doc) else np.zeros(0, np.int64)
    lanes = exact_lanes(data, start, end)
    if len(doc):
        out[doc[edges], :EXACT] = np.add.reduceat(lanes, edges, axis=0, dtype=np.uint32)
    # shingles inside the paragraphs
    paragraphs = np.concatenate([start, [len(data)]])
    ws, we, first = word_spans(data, _covering(paragraphs))
    first = first[-len(paragraphs):]
    counts = np.diff(first)
    shingles = np.where(counts > 0, np.maximum(counts - SHINGLE + 1, 1), 0)
    par = np.repeat(np.arange(len(counts)), shingles)
    at = np.arange(int(shingles.sum())) - np.repeat(np.cumsum(shingles) - shingles, shingles) + first[:-1][par]
    hashes = rolling(word_hashes(data, ws, we), at, np.minimum(at + SHINGLE, first[1:][par]), _TRIPLE)
    owner = doc[par]
    if not len(owner):
        return out
    edges = np.flatnonzero(np.concatenate([[True], owner[1:] != owner[:-1]]))
    have = owner[edges]
    total = np.diff(np.append(edges, len(owner)))
    for low in range(0, SKETCH, 8):
        byte = (hashes >> np.uint64(low % 64)).astype(np.uint8) if low < 64 else (
            mix64(hashes, 9) >> np.uint64(low - 64)).astype(np.uint8)
        bits = np.unpackbits(byte[:, None], axis=1)
        ones = np.add.reduceat(bits, edges, axis=0, dtype=np.int64)
        out[have, EXACT + low:EXACT + low + 8] = (2 * ones - total[:, None]).astype(np.uint32)
    out[have, -1] = total.astype(np.uint32)
    return out


def exact_lanes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The ``EXACT`` lanes (uint32) of each paragraph data[start:end]: its
    BLAKE2b hash, of which every bit depends on every byte."""
    whole = data.tobytes()
    hashes = [blake2b(whole[a:b], digest_size=4 * EXACT).digest() for a, b in zip(start.tolist(), end.tolist())]
    return np.frombuffer(b"".join(hashes), "<u4").reshape(len(hashes), EXACT)


def _covering(paragraphs: np.ndarray) -> np.ndarray:
    """Offsets that start at 0, as word_spans takes them."""
    return paragraphs if paragraphs[0] == 0 else np.concatenate([[0], paragraphs])


def add(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Fingerprint of a text with the paragraphs of another one added."""
    return a + b


def subtract(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Fingerprint of a text with the paragraphs of another one deleted."""
    return a - b


def _squares(a: np.ndarray) -> np.ndarray:
    """Estimated sum of squared shingle counts of each fingerprint."""
    return (np.ascontiguousarray(a[:, EXACT:-1]).view(np.int32).astype(np.float64) ** 2).mean(axis=1)


def likeness(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Likeness (0 to 1) of fingerprints, row by row."""
    every = np.maximum(_squares(a) + _squares(b), 1e-9)
    same = (a == b).all(axis=1)
    return np.where(same, 1.0, np.clip(1 - _squares(a - b) / every, 0, 1))


def text_of(vector: np.ndarray) -> str:
    return vector.astype(">u4").tobytes().hex()


# --------------------------------------------------------------------- Spark

def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, fingerprint) of every row; the fingerprint as hexadecimal."""
    source = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = utf8(batch.column("text"))
            for i, j in pieces(offsets):
                found = vectors(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i])
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(i, j - i), pa.array([text_of(v) for v in found], pa.string())],
                    ["doc_id", "fingerprint"])

    return source.mapInArrow(run, f"doc_id {docs.schema[id_col].dataType.simpleString()}, fingerprint string")


def _bounds(ids: DataFrame, n: int) -> list[int]:
    """At most n ids, descending, that part the rows evenly; the first is the
    largest id."""
    row = ids.agg(F.max("id").alias("most"), F.percentile_approx(
        "id", [k / n for k in range(1, n)] if n > 1 else [0.5], 10 * n).alias("cuts")).first()
    if row["most"] is None:
        return []
    return sorted({row["most"], *(row["cuts"] if n > 1 else ())}, reverse=True)


def with_next(docs: DataFrame, id_col: str, text_col: str, run) -> DataFrame:
    """Deal the rows to ranges of ids and give each range, in order, to
    ``run``.  The first rows of a range also go to the range before it (and
    those of the first to the last), marked as ``tail``: so each range knows
    what follows its last row.  The text is shuffled once."""
    spark = docs.sparkSession
    source = docs.select(
        F.coalesce(F.col(f"`{id_col}`").cast("long"), F.lit(NO_ID)).alias("id"),
        F.col(f"`{id_col}`").isNull().alias("none"), F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))
    small_batches(spark)
    n = partitions(spark)
    bounds = _bounds(source.select("id"), 4 * n)
    ascending = np.array(bounds[::-1], np.int64)

    @F.pandas_udf("int")
    def part(ids: pd.Series) -> pd.Series:
        # the number of bounds above an id tells its range
        at = len(ascending) - 1 - np.searchsorted(ascending, ids.to_numpy(np.int64))
        return pd.Series(np.maximum(at, 0).astype(np.int32))

    dealt = source.withColumn("part", part("id"))
    firsts = F.col("id").isin(*bounds) if bounds else F.lit(False)
    last = len(bounds) - 1
    both = F.when(firsts, F.array(
        F.struct(F.col("part"), F.lit(False).alias("tail")),
        F.struct(F.when(F.col("part") > 0, F.col("part") - 1).otherwise(F.lit(last)).alias("part"), F.lit(True).alias("tail")),
    )).otherwise(F.array(F.struct(F.col("part"), F.lit(False).alias("tail"))))
    rows = dealt.select("id", "none", "text", F.explode(both).alias("to")).select(
        "id", "none", "text", F.col("to.part").alias("part"), F.col("to.tail").alias("tail"))
    return rows.repartition(n, "part").groupBy("part").applyInArrow(run, _EDITED)


_EDITED = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
           "near_edited double, near_next double")


def _edit_part(table: pa.Table) -> pa.Table:
    ids = np.asarray(table.column("id"), np.int64)
    tail = np.asarray(table.column("tail").combine_chunks(), bool) if len(ids) else np.zeros(0, bool)
    none = np.asarray(table.column("none").combine_chunks(), bool)
    texts = table.column("text").combine_chunks()
    data, offsets = utf8(texts)
    tie = np.array([int.from_bytes(sha256(data[a:b]).digest()[:8], "big") for a, b in zip(offsets[:-1], offsets[1:])], np.uint64)
    order = np.lexsort((~tie, ~ids))  # descending, for signed and unsigned numbers
    own, after = order[~tail[order]], order[tail[order]]
    prints = vectors_of(data, offsets)
    following = np.concatenate([own[1:], after[:1] if len(after) else own[:1]]) if len(own) else own
    whole = data.tobytes()
    columns: list[list] = [[] for _ in range(7)]
    for i in range(0, len(own), 64):
        mine, others = own[i:i + 64], following[i:i + 64]
        edited, sizes = [], []
        for a, b in zip(mine.tolist(), others.tolist()):
            text = whole[offsets[a]:offsets[a + 1]].decode()
            half = len(text) // 2
            sizes.append(len(text))
            edited.append((text[:len(text) - half] + whole[offsets[b]:offsets[b + 1]].decode()[:half]).encode())
        joined = np.frombuffer(b"".join(edited), np.uint8)
        new = vectors_of(joined, np.concatenate([[0], np.cumsum([len(e) for e in edited])]))
        columns[0] += [None if none[a] else int(ids[a]) for a in mine]
        columns[1] += sizes
        columns[2] += [sha256(e).hexdigest() for e in edited]
        columns[3] += [text_of(v) for v in prints[mine]]
        columns[4] += [text_of(v) for v in new]
        columns[5] += likeness(prints[mine], new).tolist()
        columns[6] += likeness(prints[mine], prints[others]).tolist()
    kinds = (pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64())
    names = [c.split()[0] for c in _EDITED.split(", ")]
    return pa.table({n: pa.array(c, k) for n, c, k in zip(names, columns, kinds)})


def vectors_of(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """``vectors`` by pieces, so that temporaries stay small."""
    parts = [vectors(data[offsets[i]:offsets[j]], offsets[i:j + 1] - offsets[i]) for i, j in pieces(offsets, 1 << 20)]
    return np.concatenate(parts) if parts else np.zeros((0, LANES), np.uint32)


def edited(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of every text and of its edited text (the last half of
    its code points replaced by the first as many of the next document), and
    the likeness to that and to the next document."""
    return with_next(docs, id_col, text_col, _edit_part)
