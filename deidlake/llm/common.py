"""Helpers shared by the operators of this subpackage: scratch tables in the
shared folder, and vectorised word handling on Arrow string columns.

A *word* is a run of bytes other than space and \\t \\n \\v \\f \\r; those
bytes never occur inside a UTF-8 multi-byte character, so words can be found
on the bytes."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from deidlake.session import workspace_root

#: Java and Python regular expression of a word (fixed by the data contract).
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"
#: NumPy temporaries are made for at most about this many text bytes at once.
PIECE_BYTES = 500_000
#: Powers of a hash's base are kept between calls up to this many.
KEPT_POWERS = 1 << 19
#: Rows of an Arrow batch: long texts make large batches.
BATCH_ROWS = 1000
BATCH_BYTES = 16 << 20
NO_ID = np.iinfo(np.int64).min

_IS_GAP = np.zeros(256, bool)
_IS_GAP[[9, 10, 11, 12, 13, 32]] = True


def scratch(spark: SparkSession, name: str) -> str:
    """A new folder below the shared workspace (``spark.checkpoint.dir``)."""
    return f"{workspace_root(spark)}/llm/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str, compression: str = "snappy") -> DataFrame:
    """Write ``df`` to the shared folder and read it back: later actions
    neither recompute it nor depend on the executors that made it."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path, compression=compression)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_removed(spark: SparkSession) -> Iterator[None]:
    """Let Spark remove the shuffle files of each query when it has ended, for
    operators that write every intermediate table."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.set(name, before)


def discard(df: DataFrame) -> None:
    """Remove the folder of a table made by ``stored`` that nothing reads any more."""
    spark = df.sparkSession
    path = spark._jvm.org.apache.hadoop.fs.Path(df.select("_metadata.file_path").first()[0]).getParent()
    if path.getParent().toUri().getPath() != spark._jvm.org.apache.hadoop.fs.Path(f"{workspace_root(spark)}/llm").toUri().getPath():
        raise ValueError(f"not a table of this subpackage: {path}")
    path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def small_batches(spark: SparkSession) -> None:
    """Let Python workers get batches of at most ``BATCH_ROWS`` texts and
    about ``BATCH_BYTES`` (a single longer text is a batch of its own)."""
    for name, most in (("maxRecordsPerBatch", BATCH_ROWS), ("maxBytesPerBatch", BATCH_BYTES)):
        name = f"spark.sql.execution.arrow.{name}"
        now = spark.conf.get(name)  # the default has a unit
        if not (now.isdigit() and 0 < int(now) <= most):
            spark.conf.set(name, most)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def unused(df: DataFrame, *names: str) -> list[str]:
    """For each of ``names`` a column name that ``df`` doesn't have."""
    taken, tail = {c.lower() for c in df.columns}, ""
    while any((n + tail).lower() in taken for n in names):
        tail += "_"
    return [n + tail for n in names]


def words(text: Column) -> Column:
    """Array of the words of a text; empty for a null or empty text."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), GAP), "")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_bytes(df: DataFrame, text_col: str) -> int:
    """Total UTF-8 bytes of a text column (one scan of that column)."""
    return df.agg(F.sum(F.octet_length(F.col(text_col))).alias("n")).first()["n"] or 0


# ------------------------------------------------------------------ NumPy

def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary array; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks() if column.num_chunks != 1 else column.chunk(0)
    if not pa.types.is_large_binary(column.type):
        column = column.cast(pa.large_binary())
    if column.null_count:
        column = column.fill_null(b"")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def pieces(offsets: np.ndarray, limit: int = PIECE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges [i, j) of at most ``limit`` bytes each (or of one row)."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + limit, side="right")) - 1)
        yield i, min(j, n)
        i = min(j, n)


#: Gaps for language models: all ASCII but letters and digits.
PUNCTUATION = np.array([b < 128 and not chr(b).isalnum() for b in range(256)])


def word_spans(data: np.ndarray, offsets: np.ndarray, gaps: np.ndarray = _IS_GAP) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, first) of the words of consecutive texts: byte ranges of
    the words, and for each text the index of its first word (one more entry
    at the end).  ``gaps`` tells of each byte value whether it parts words."""
    gap = gaps[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    inside = ~gap
    before = np.empty(len(data), bool)
    after = np.empty(len(data), bool)
    if len(data):
        before[0], before[1:] = True, gap[:-1]
        after[-1], after[:-1] = True, gap[1:]
        before |= edge[:-1]
        after |= edge[1:]
    start = np.flatnonzero(inside & before)
    end = np.flatnonzero(inside & after) + 1
    return start, end, np.searchsorted(start, offsets)


def mix64(x: np.ndarray, seed: int = 0) -> np.ndarray:
    """A bijective mixing of 64-bit values (SplitMix64's finaliser)."""
    x = x + np.uint64((0x9E3779B97F4A7C15 * (seed + 1)) & 0xFFFFFFFFFFFFFFFF)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BASE = 0x9E6C63D0876A9A35  # odd, hence invertible modulo 2**64
_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _powers(n: int, base: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i < n, kept between calls."""
    have = _POWERS.get(base)
    if have is None or len(have[0]) < n:
        size = KEPT_POWERS if n <= KEPT_POWERS else n
        up, down = np.full(size, base, np.uint64), np.full(size, pow(base, -1, 1 << 64), np.uint64)
        up[0] = down[0] = 1
        have = (np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64))
        if size <= KEPT_POWERS:
            _POWERS[base] = have
    return have[0][:n], have[1][:n]


def rolling(values: np.ndarray, start: np.ndarray, end: np.ndarray, base: int = _BASE) -> np.ndarray:
    """Hash of values[start:end] for each pair, by prefix sums of a
    polynomial modulo 2**64; equal ranges have equal hashes."""
    n = len(values)
    up, down = _powers(n + 1, base)
    prefix = np.zeros(n + 1, np.uint64)
    np.cumsum(values * up[:n], dtype=np.uint64, out=prefix[1:])
    return mix64((prefix[end] - prefix[start]) * down[start])


_BYTE = mix64(np.arange(256, dtype=np.uint64), 77)


_PLACES: list[np.ndarray] = [np.zeros(0, np.uint64)]


def _places(n: int) -> np.ndarray:
    """A number for each place of a byte in its word, kept between calls."""
    if len(_PLACES[0]) < n:
        size = KEPT_POWERS if n <= KEPT_POWERS else n
        made = mix64(np.arange(size, dtype=np.uint64), 78)
        if size > KEPT_POWERS:
            return made
        _PLACES[0] = made
    return _PLACES[0][:n]


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each word; the words follow each other, without overlap.

    Each byte is mixed with its place in the word before the sum is taken, so
    the hash is no polynomial: words built to make every polynomial modulo a
    power of two equal (Thue-Morse words) have different hashes."""
    n = len(data)
    if not len(start):
        return np.zeros(0, np.uint64)
    begins = np.concatenate([[0], start])
    lengths = np.diff(np.append(begins, n))
    place = np.arange(n) - np.repeat(begins, lengths)
    x = _BYTE[data] ^ _places(int(lengths.max()) + 1)[place]
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(29)
    prefix = np.zeros(n + 1, np.uint64)
    np.cumsum(x, dtype=np.uint64, out=prefix[1:])
    # the length too: no bytes of a word can add up to nothing
    return mix64(prefix[end] - prefix[start] + (end - start).astype(np.uint64))


def lower_ascii(data: np.ndarray) -> np.ndarray:
    """A-Z to a-z, other bytes as they are."""
    return np.where((data >= 65) & (data <= 90), data + 32, data).astype(np.uint8)


def binary_array(data: np.ndarray, bounds: np.ndarray) -> pa.Array:
    """Binary array of data[bounds[i]:bounds[i + 1]] (bytes)."""
    return pa.Array.from_buffers(
        pa.large_binary(), len(bounds) - 1,
        [None, pa.py_buffer(np.ascontiguousarray(bounds, np.int64)), pa.py_buffer(np.ascontiguousarray(data))],
    ).cast(pa.binary())
