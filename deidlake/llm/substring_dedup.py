"""Removal of repeated passages: words covered by a 20-word window whose
word sequence starts earlier in the corpus.

Method: fixed-block anchors.  Every document is cut into non-overlapping
reference blocks of 10 words; these form the index.  Every rolling 10-word
window of every document probes it.  Of two equal 20-word windows each holds
a whole reference block, which the other holds at some offset: so a window
that has no hit at another place than its own is no repeat.  Hits are then
extended by up to 10 words to both sides, and the 20-word windows in these
stretches are compared exactly (96-bit hashes of the word sequences), which
yields the maximal repeats.

Shape of the job: documents are dealt to chunks by a hash of their id, and
probes travel as packed arrays of 4-byte keys, one array per chunk and range
of hash values, instead of as rows.  The answer to an array is a bit array.
Within a chunk equal windows are sent once, so a passage in a third of all
documents costs each range as many entries as there are chunks.  The text is
shuffled once; the three passes over it read that same shuffle.

Defined results: a null or empty text has no words; a null id counts as the
smallest; rows with the same id are ordered by their text (identical rows:
any order, they are equal); an empty table gives an empty result.  Extra
columns are ignored."""

from __future__ import annotations

from itertools import compress

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deidlake.llm.common import (
    NO_ID, binary_array, small_batches, partitions, pieces, rolling, text_bytes, utf8, word_hashes, word_spans,
)

Key = tuple[pa.Scalar, ...]
WINDOW = 20
#: At most (WINDOW + 1) // 2, so that every window holds a whole block.
BLOCK = 10
CHUNK_BYTES = 8 << 20
_BASES = (0xD1342543DE82EF95, 0x2545F4914F6CDD1D, 0xAF251AF3B0F025B5)

_CELLS = "bucket int, chunk int, section int, keys binary, ids binary"
_REPLY = "chunk int, pass int, section int, bucket int, bits binary"
_RESULT = "id long, n_words long, n_removed long, kept_text string"


class Chunk:
    """The documents of a chunk in order, with the hashes of their words."""

    def __init__(self, table: pa.Table):
        ids = np.asarray(table.column("id").combine_chunks().fill_null(NO_ID), np.int64)
        data, offsets = utf8(table.column("text"))
        order = np.argsort(ids, kind="stable")
        if (np.diff(ids[order]) == 0).any():  # several rows with one id: by text
            order = np.array(sorted(range(len(ids)), key=lambda i: (ids[i], data[offsets[i]:offsets[i + 1]].tobytes())))
        self.data, self.offsets, self.order, self.ids = data, offsets, order, ids[order]
        self.null = np.asarray(table.column("id").combine_chunks().is_null())[order]
        hashes, counts = [], np.zeros(len(ids), np.int64)
        for i, j in pieces(offsets):
            part = data[offsets[i]:offsets[j]]
            start, end, first = word_spans(part, offsets[i:j + 1] - offsets[i])
            hashes.append(word_hashes(part, start, end))
            counts[i:j] = np.diff(first)
        words = np.concatenate(hashes) if hashes else np.zeros(0, np.uint64)
        begins = np.cumsum(counts) - counts
        self.counts = counts[order]
        self.first = np.concatenate([[0], np.cumsum(self.counts)])
        at = np.repeat(begins[order] - self.first[:-1], self.counts) + np.arange(len(words))
        self.words = words[at]

    def windows(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """(position of each window of ``size`` words, its document)."""
        n = np.maximum(self.counts - size + 1, 0)
        doc = np.repeat(np.arange(len(n)), n)
        at = np.repeat(self.first[:-1] - np.cumsum(n) + n, n) + np.arange(int(n.sum()))
        return at, doc

    def hashes(self, at: np.ndarray, size: int, base: int) -> np.ndarray:
        return rolling(self.words, at, at + size, base)

    def doc_bytes(self, k: int) -> bytes:
        i = self.order[k]
        return self.data[self.offsets[i]:self.offsets[i + 1]].tobytes()


class Probes:
    """Pass 1 of a chunk: its distinct block-sized windows, in sections by
    the number of reference blocks among their places: 0, 1, 2 or more."""

    def __init__(self, chunk: Chunk):
        self.at, doc = chunk.windows(BLOCK)
        hashes = chunk.hashes(self.at, BLOCK, _BASES[0])
        self.reference = (self.at - chunk.first[doc]) % BLOCK == 0
        self.values, self.which = np.unique(hashes, return_inverse=True)
        blocks = np.bincount(self.which, self.reference, len(self.values)).astype(np.int64)
        self.section = np.minimum(blocks, 2)

    def cells(self, section: int, bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(buckets, bounds of their keys, 4-byte keys) of a section."""
        values = self.values[self.section == section]
        bucket = (values >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(values), np.int64)
        keys = (values >> np.uint64(32 - bits)).astype(np.uint32)
        present, starts = np.unique(bucket, return_index=True)
        return present, np.append(starts, len(values)), keys

    def hits(self, bits: int, replies: dict) -> np.ndarray:
        """Positions whose window has a reference block at another place."""
        total = self.section.copy()
        for section in (0, 1):
            members = np.flatnonzero(self.section == section)
            buckets, bounds, _ = self.cells(section, bits)
            for b, i, j in zip(buckets.tolist(), bounds[:-1].tolist(), bounds[1:].tolist()):
                if (answer := replies.get((1, section, b))) is not None:
                    total[members[i:j]] = section + np.unpackbits(np.frombuffer(answer, np.uint8), count=j - i)
        total = total[self.which]
        return self.at[np.where(self.reference, total >= 2, total >= 1)]


class Candidates:
    """Pass 2 of a chunk: the windows in the stretches around hits; equal
    ones are represented by the first."""

    def __init__(self, chunk: Chunk, hits: np.ndarray):
        at, doc = chunk.windows(WINDOW)
        seen = np.zeros(len(chunk.words) + 1, np.int64)
        seen[hits + 1] = 1
        seen = np.cumsum(seen)
        near = seen[at + WINDOW - BLOCK + 1] > seen[at]  # a hit inside the window
        self.at, self.doc = at[near], doc[near]
        self.high = chunk.hashes(self.at, WINDOW, _BASES[1])
        self.low = chunk.hashes(self.at, WINDOW, _BASES[2]).astype(np.uint32)
        order = np.lexsort((self.low, self.high))  # stable: the first place comes first
        high, low = self.high[order], self.low[order]
        new = np.ones(len(order), bool)
        new[1:] = (high[1:] != high[:-1]) | (low[1:] != low[:-1])
        self.repeat = np.ones(len(order), bool)
        self.repeat[order[new]] = False
        self.firsts = order[new]  # by hash value

    def cells(self, chunk: Chunk, bits: int):
        high, low = self.high[self.firsts], self.low[self.firsts]
        bucket = (high >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(high), np.int64)
        present, starts = np.unique(bucket, return_index=True)
        entry = np.zeros(len(high), np.dtype([("high", "<u8"), ("low", "<u4")]))
        entry["high"], entry["low"] = high, low
        return present, np.append(starts, len(high)), entry, chunk.ids[self.doc[self.firsts]]

    def covered(self, chunk: Chunk, bits: int, replies: dict) -> np.ndarray:
        """Is each word of the chunk covered by a window found earlier."""
        repeat = self.repeat.copy()
        buckets, bounds, _, _ = self.cells(chunk, bits)
        for b, i, j in zip(buckets.tolist(), bounds[:-1].tolist(), bounds[1:].tolist()):
            if (answer := replies.get((2, 0, b))) is not None:
                repeat[self.firsts[i:j]] = np.unpackbits(np.frombuffer(answer, np.uint8), count=j - i)
        at = self.at[repeat]
        edge = np.zeros(len(chunk.words) + 1, np.int64)
        edge[at] += 1
        edge[at + WINDOW] -= 1  # each start occurs once, and so does each end
        return np.cumsum(edge)[:-1] > 0


def _cell_table(chunk: int, section: int, buckets, bounds, keys: np.ndarray, ids=None) -> pa.Table:
    n = len(buckets)
    packed = lambda x: binary_array(x.view(np.uint8), bounds * x.itemsize)
    return pa.table({
        "bucket": pa.array(buckets, pa.int32()), "chunk": pa.array(np.full(n, chunk), pa.int32()),
        "section": pa.array(np.full(n, section), pa.int32()), "keys": packed(keys),
        "ids": packed(ids) if ids is not None else pa.nulls(n, pa.binary()),
    })


def _replies(table: pa.Table) -> dict:
    columns = [table.column(c).to_pylist() for c in ("pass", "section", "bucket", "bits")]
    return {(p, s, b): bits for p, s, b, bits in zip(*columns)}


def _reply_table(chunks: list, number: int, sections: list, bucket: int, answers: list) -> pa.Table:
    kept = [k for k, a in enumerate(answers) if a.any()]  # no answer: all bits are 0
    return pa.table({
        "chunk": pa.array([chunks[k] for k in kept], pa.int32()), "pass": pa.array([number] * len(kept), pa.int32()),
        "section": pa.array([sections[k] for k in kept], pa.int32()),
        "bucket": pa.array([bucket] * len(kept), pa.int32()),
        "bits": pa.array([np.packbits(answers[k]).tobytes() for k in kept], pa.binary()),
    })


def _member(values: np.ndarray, among: np.ndarray) -> np.ndarray:
    if not len(among):
        return np.zeros(len(values), bool)
    return among[np.minimum(np.searchsorted(among, values), len(among) - 1)] == values


def _probe_cells(bits: int):
    def run(key: Key, table: pa.Table) -> pa.Table:
        probes = Probes(Chunk(table))
        chunk = key[0].as_py()
        return pa.concat_tables(_cell_table(chunk, s, *probes.cells(s, bits)) for s in range(3))

    return run


def _answer_probes(key: Key, table: pa.Table) -> pa.Table:
    """The index of a range of hash values against all probes of the range."""
    sections, chunks = table.column("section").to_pylist(), table.column("chunk").to_pylist()
    keys = [np.frombuffer(x, np.uint32) for x in table.column("keys").to_pylist()]
    pick = lambda s: np.concatenate([np.zeros(0, np.uint32), *(k for k, t in zip(keys, sections) if t == s)])
    once, often = pick(1), pick(2)
    values, counts = np.unique(once, return_counts=True)
    twice = np.union1d(values[counts > 1], often)
    some = np.union1d(values, often)
    ask = [k for k, s in enumerate(sections) if s < 2]
    answers = [_member(keys[k], some if sections[k] == 0 else twice) for k in ask]
    return _reply_table([chunks[k] for k in ask], 1, [sections[k] for k in ask], key[0].as_py(), answers)


def _candidate_cells(bits: int):
    def run(key: Key, table: pa.Table, replies: pa.Table) -> pa.Table:
        chunk = Chunk(table)
        hits = Probes(chunk).hits(bits, _replies(replies))
        return _cell_table(key[0].as_py(), 0, *Candidates(chunk, hits).cells(chunk, bits))

    return run


def _answer_candidates(key: Key, table: pa.Table) -> pa.Table:
    """Of equal windows of several chunks all but that with the least id are
    repeats."""
    chunks = table.column("chunk").to_pylist()
    entries = [np.frombuffer(x, np.dtype([("high", "<u8"), ("low", "<u4")])) for x in table.column("keys").to_pylist()]
    ids = np.concatenate([np.frombuffer(x, np.int64) for x in table.column("ids").to_pylist()])
    every = np.concatenate(entries)
    order = np.lexsort((ids, every["low"], every["high"]))
    high, low = every["high"][order], every["low"][order]
    later = np.zeros(len(order), bool)
    later[order[1:]] = (high[1:] == high[:-1]) & (low[1:] == low[:-1])
    bounds = np.cumsum([0, *map(len, entries)])
    answers = [later[i:j] for i, j in zip(bounds[:-1], bounds[1:])]
    return _reply_table(chunks, 2, [0] * len(chunks), key[0].as_py(), answers)


def _kept(bits: int):
    def run(key: Key, table: pa.Table, replies: pa.Table) -> pa.Table:
        chunk, answers = Chunk(table), _replies(replies)
        covered = Candidates(chunk, Probes(chunk).hits(bits, answers)).covered(chunk, bits, answers)
        removed = np.concatenate([[0], np.cumsum(covered)])
        texts = []
        for k in range(len(chunk.ids)):
            i, j = chunk.first[k], chunk.first[k + 1]
            ws = chunk.doc_bytes(k).split()
            if removed[j] > removed[i]:
                ws = compress(ws, (~covered[i:j]).tolist())
            texts.append(b" ".join(ws))
        return pa.table({
            "id": pa.array(chunk.ids, pa.int64(), mask=chunk.null), "n_words": pa.array(chunk.counts, pa.int64()),
            "n_removed": pa.array(np.diff(removed[chunk.first]), pa.int64()),
            "kept_text": pa.array(texts, pa.binary()).cast(pa.string()),
        })

    return run


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_words, n_removed, kept_text) of every row of ``docs``.

    The number of chunks follows the bytes of text (one scan); it is at
    least the number of shuffle partitions."""
    spark = docs.sparkSession
    small_batches(spark)
    n = max(partitions(spark), -(-text_bytes(docs, text_col) // CHUNK_BYTES))
    bits = (n - 1).bit_length()
    source = docs.select(
        F.col(f"`{id_col}`").cast("long").alias("id"), F.col(f"`{text_col}`").cast("string").alias("text"),
        F.pmod(F.xxhash64(F.col(f"`{id_col}`").cast("long")), F.lit(n)).cast("int").alias("chunk"),
    ).repartition(partitions(spark), "chunk")
    chunks = lambda: source.groupBy("chunk")
    probes = chunks().applyInArrow(_probe_cells(bits), _CELLS)
    first = probes.groupBy("bucket").applyInArrow(_answer_probes, _REPLY)
    candidates = chunks().cogroup(first.groupBy("chunk")).applyInArrow(_candidate_cells(bits), _CELLS)
    second = candidates.groupBy("bucket").applyInArrow(_answer_candidates, _REPLY)
    return chunks().cogroup(first.unionByName(second).groupBy("chunk")).applyInArrow(_kept(bits), _RESULT)


def digests(docs: DataFrame) -> DataFrame:
    out = remove_repeats(docs)
    return out.select(F.col("id").alias("doc_id"), "n_words", "n_removed",
                      F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256"))

