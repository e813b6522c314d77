"""Byte-level BPE encoding and decoding with a given rank file.

Pre-tokenisation uses no regular expression.  Each code point gets a class
(letter, number, white space, other, apostrophe that opens a contraction ...)
from a class array.  The classes drive a small automaton whose transition
functions form a finite monoid: the functions of a whole block are composed
with a table look-up (composition is associative), so that boundaries of all
texts of a batch are found by a block-wise scan in NumPy.  The resulting
slices go to a cached pair merging.

Defined results: a null or empty text has no ids and decodes to nothing; an
id column that is null decodes to nothing; repeated rows are encoded alike;
columns of the input other than the text are kept unless an output column has
the same name (the output wins)."""

from __future__ import annotations

import base64
import heapq
import sys
import unicodedata
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from deidlake.llm.common import binary_array, pieces, rolling, small_batches, unused, utf8

# ------------------------------------------------------- code point classes
#: Classes of single code points.
LETTER, NUMBER, OTHER, BLANK, SPACE = range(5)
#: White space as regular expressions understand it (fixed values).
WHITE_SPACE = (*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F,
               0x205F, 0x3000)


#: Ranges first assigned in Unicode 16, which the library matched against
#: knows and Python's own tables don't (fixed values).
UNICODE_16 = ((0x1C89, 0x1C8A), (0xA7CB, 0xA7CD), (0xA7DA, 0xA7DC), (0x105C0, 0x105FF), (0x10D40, 0x10D8F),
              (0x10EC2, 0x10EC4), (0x11380, 0x113FF), (0x116D0, 0x116FF), (0x11BC0, 0x11BFF), (0x13460, 0x143FF),
              (0x16100, 0x1613F), (0x16D40, 0x16D7F), (0x1CCF0, 0x1CCF9), (0x1E5D0, 0x1E5FF))


def _classes() -> np.ndarray:
    """Class of every code point."""
    table = np.full(sys.maxunicode + 1, OTHER, np.uint8)
    for cp in range(sys.maxunicode + 1):
        kind = unicodedata.category(chr(cp))[0]
        if kind == "L":
            table[cp] = LETTER
        elif kind == "N":
            table[cp] = NUMBER
    for first, last in UNICODE_16:
        for cp in range(first, last + 1):
            if regex.match(r"\p{L}", chr(cp)):
                table[cp] = LETTER
            elif regex.match(r"\p{N}", chr(cp)):
                table[cp] = NUMBER
    table[list(WHITE_SPACE)] = BLANK
    table[0x20] = SPACE
    return table


# --------------------------------------------------------------- automaton
#: Input symbols: the classes, an apostrophe that opens a contraction of one
#: or two letters, white space with white space behind it or at a text's end
#: (MORE), and the mark between two texts.
L, N, O, APOS1, APOS2, BLANK_LAST, BLANK_MORE, SPACE_LAST, SPACE_MORE, MARK = range(10)
#: States: what the last symbol was.  AFTER: a contraction has just ended.
START, IN_L, IN_N, IN_O, IN_BLANK, IN_SPACE, EXPECT1, EXPECT2, AFTER = range(9)


def _step(state: int, symbol: int) -> tuple[int, bool]:
    """(next state, does a piece start at this symbol)."""
    if symbol == MARK:
        return START, False
    if state == EXPECT2:
        return EXPECT1, False
    if state == EXPECT1:
        return AFTER, False
    if symbol in (APOS1, APOS2):
        if state in (IN_O, IN_SPACE):  # part of a run of other characters
            return IN_O, False
        return (EXPECT1 if symbol == APOS1 else EXPECT2), True
    if symbol in (L, N, O):
        into = (IN_L, IN_N, IN_O)[symbol]
        return into, state != into and state != IN_SPACE
    into = IN_SPACE if symbol in (SPACE_LAST, SPACE_MORE) else IN_BLANK
    last = symbol in (BLANK_LAST, SPACE_LAST)
    if into == IN_SPACE and not last:
        into = IN_BLANK  # only the last space of a run can open the next piece
    return into, last or state not in (IN_BLANK, IN_SPACE)


_N_SYMBOLS, _N_STATES = 10, 9
_NEXT = np.array([[_step(q, s)[0] for q in range(_N_STATES)] for s in range(_N_SYMBOLS)], np.uint8)
_OPENS = np.array([[_step(q, s)[1] for q in range(_N_STATES)] for s in range(_N_SYMBOLS)], bool)


def _monoid() -> tuple[np.ndarray, np.ndarray]:
    """All compositions of the symbols' transition functions, numbered (the
    symbols first), and the table of products: first i, then j."""
    functions = [tuple(int(x) for x in row) for row in _NEXT]
    number: dict[tuple[int, ...], int] = {}
    for f in [*functions, tuple(range(_N_STATES))]:
        number.setdefault(f, len(number))
    grown, todo = list(number), list(number)
    while todo:
        f = todo.pop()
        for g in functions:
            fg = tuple(g[q] for q in f)
            if fg not in number:
                number[fg] = len(number)
                grown.append(fg)
                todo.append(fg)
    names = np.array(grown, np.uint8)
    product = np.array([[number[tuple(int(b[q]) for q in a)] for b in names] for a in names], np.uint16)
    return names, product


_FUNCTIONS, _PRODUCT = _monoid()
_SYMBOL = {tuple(int(x) for x in f): i for i, f in enumerate(_FUNCTIONS)}
_OF_SYMBOL = np.array([_SYMBOL[tuple(int(x) for x in row)] for row in _NEXT], np.uint16)
_BLOCK = 256


def _opens(symbols: np.ndarray) -> np.ndarray:
    """For each symbol, does a piece start there.  Three scans: the function
    of each block, the states before the blocks, the states inside them."""
    n = len(symbols)
    rows = -(-n // _BLOCK)
    grid = np.full(rows * _BLOCK, MARK, np.uint8)
    grid[:n] = symbols
    grid = np.ascontiguousarray(grid.reshape(rows, _BLOCK).T)
    block = _OF_SYMBOL[grid[0]]
    for t in range(1, _BLOCK):
        block = _PRODUCT[block, _OF_SYMBOL[grid[t]]]
    shift = 1  # inclusive scan over the blocks by doubling
    scan = block.copy()
    while shift < rows:
        scan[shift:] = _PRODUCT[scan[:-shift], scan[shift:]]
        shift *= 2
    state = np.empty(rows, np.uint8)
    state[0] = START
    state[1:] = _FUNCTIONS[scan[:-1], START]
    opens = np.empty(grid.shape, bool)
    for t in range(_BLOCK):
        opens[t] = _OPENS[grid[t], state]
        state = _NEXT[grid[t], state]
    return opens.T.reshape(-1)[:n]


def boundaries(points: np.ndarray, marks: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """Positions at which pieces start.  ``points``: code points of texts with
    one mark (any value) before each text, at the positions ``marks``."""
    kind = classes[points]
    kind[marks] = 255
    symbols = np.empty(len(points), np.uint8)
    np.take(np.array([L, N, O, BLANK_MORE, SPACE_MORE], np.uint8), np.minimum(kind, 4), out=symbols)
    following = np.full(len(points), 255, np.uint8)
    following[:-1] = kind[1:]
    last = following <= OTHER  # a letter, number or other character follows
    blank = (kind == BLANK) | (kind == SPACE)
    symbols[(kind == BLANK) & last] = BLANK_LAST
    symbols[(kind == SPACE) & last] = SPACE_LAST
    symbols[blank & ~last & (kind == SPACE)] = SPACE_MORE
    apostrophes = np.flatnonzero(points == 39)
    apostrophes = apostrophes[kind[apostrophes] != 255]
    if len(apostrophes):
        padded = np.concatenate([points, np.zeros(2, points.dtype)])
        live = np.concatenate([kind, np.full(2, 255, np.uint8)]) != 255
        one, two = padded[apostrophes + 1], padded[apostrophes + 2]
        ok1, ok2 = live[apostrophes + 1], live[apostrophes + 1] & live[apostrophes + 2]
        single = ok1 & np.isin(one, [ord(c) for c in "stmd"])
        double = np.zeros(len(apostrophes), bool)
        for pair in ("re", "ve", "ll"):
            double |= ok2 & (one == ord(pair[0])) & (two == ord(pair[1]))
        symbols[apostrophes[single]] = APOS1
        symbols[apostrophes[double]] = APOS2
    symbols[marks] = MARK
    return np.flatnonzero(_opens(symbols))


# ------------------------------------------------------------------ merging

class PairMerger(dict):
    """piece (str) -> ids; merges the pair of lowest rank, leftmost first.
    Short pieces are remembered, at most ``limit`` of them."""

    def __init__(self, ranks: dict[bytes, int], limit: int = 150_000, longest: int = 64):
        super().__init__()
        self.ranks, self.limit, self.longest = ranks, limit, longest

    def __missing__(self, piece: str) -> tuple[int, ...]:
        ids = self.merge(piece.encode())
        if len(piece) <= self.longest:
            if len(self) >= self.limit:
                self.clear()
            self[piece] = ids
        return ids

    def merge(self, piece: bytes) -> tuple[int, ...]:
        ranks = self.ranks
        if (whole := ranks.get(piece)) is not None:
            return (whole,)
        return self._merge_short(piece) if len(piece) <= 256 else self._merge_long(piece)

    def _merge_short(self, piece: bytes) -> tuple[int, ...]:
        """Lists of the parts and of the ranks of neighbouring parts."""
        ranks, none = self.ranks, 1 << 60
        parts = [piece[i:i + 1] for i in range(len(piece))]
        pairs = [ranks.get(piece[i:i + 2], none) for i in range(len(piece) - 1)]
        while pairs and (least := min(pairs)) < none:
            i = pairs.index(least)
            part = parts[i] + parts.pop(i + 1)
            parts[i] = part
            del pairs[i]
            if i < len(pairs):
                pairs[i] = ranks.get(part + parts[i + 1], none)
            if i:
                pairs[i - 1] = ranks.get(parts[i - 1] + part, none)
        return tuple([ranks[x] for x in parts])

    def _merge_long(self, piece: bytes) -> tuple[int, ...]:
        """A heap of pairs: near-linear time for pieces of any length."""
        ranks, n = self.ranks, len(piece)
        end = list(range(1, n + 1))  # of the part that starts here
        prev = list(range(-1, n - 1))
        heap = [(r, i, i + 2) for i in range(n - 1) if (r := ranks.get(piece[i:i + 2])) is not None]
        heapq.heapify(heap)
        alive = bytearray(b"\x01") * n
        while heap:
            _, i, stop = heapq.heappop(heap)
            if not alive[i] or (j := end[i]) >= n or end[j] != stop:
                continue  # one of the two parts has changed since
            alive[j] = 0
            end[i] = stop
            if stop < n:
                prev[stop] = i
                if (r := ranks.get(piece[i:end[stop]])) is not None:
                    heapq.heappush(heap, (r, i, end[stop]))
            if (h := prev[i]) >= 0 and (r := ranks.get(piece[h:stop])) is not None:
                heapq.heappush(heap, (r, h, stop))
        return tuple(ranks[piece[i:end[i]]] for i in range(n) if alive[i])


def read_ranks(lines: bytes) -> dict[bytes, int]:
    """Ranks of a file of lines "base64 of the bytes, space, rank"."""
    return {base64.b64decode(a): int(b) for a, b in (x.split() for x in lines.splitlines() if x)}


#: Stands before each text of a batch; a lone surrogate, so no text holds it.
MARK_CHARACTER = "\udfff"


class Codec:
    """Encodes and decodes batches of texts."""

    def __init__(self, lines: bytes):
        ranks = read_ranks(lines)
        self.merger = PairMerger(ranks)
        self.classes = _classes()
        size = max(ranks.values(), default=-1) + 1
        self.length = np.zeros(size, np.int64)
        for token, i in ranks.items():
            self.length[i] = len(token)
        self.first = np.concatenate([[0], np.cumsum(self.length)[:-1]]) if size else self.length
        blob = bytearray(int(self.length.sum()))
        for token, i in ranks.items():
            blob[self.first[i]:self.first[i] + len(token)] = token
        self.blob = np.frombuffer(bytes(blob), np.uint8)

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(ids, offsets into them by text, number of ids of each piece,
        offsets into those by text)."""
        sizes = np.array([len(t) for t in texts], np.int64)
        marks = np.cumsum(sizes + 1) - sizes - 1
        joined = MARK_CHARACTER + MARK_CHARACTER.join(texts) if texts else ""
        points = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), np.uint32)
        starts = boundaries(points, marks, self.classes) if len(points) else np.zeros(0, np.int64)
        by_text = np.searchsorted(starts, np.append(marks, len(points)))
        ends = np.empty_like(starts)
        if len(starts):
            ends[:-1], ends[-1] = starts[1:], len(points)
        lasts = by_text[1:][np.diff(by_text) > 0] - 1  # the last piece of a text ends where the text ends
        ends[lasts] = (marks + 1 + sizes)[np.diff(by_text) > 0]
        ids, counts = self._merged(joined, points, starts, ends)
        ends_of = np.concatenate([[0], np.cumsum(counts)])
        return ids, ends_of[by_text], counts.astype(np.int32), by_text

    def _merged(self, joined: str, points: np.ndarray, starts: np.ndarray, ends: np.ndarray):
        """Ids of all pieces and their number for each.  Every distinct piece
        (by a 64-bit hash) is looked up once; the decoded bytes are compared
        with the text, so that a collision can't pass unnoticed."""
        if not len(starts):
            return np.zeros(0, np.int32), np.zeros(0, np.int64)
        _, first, which = np.unique(rolling(points.astype(np.uint64) + np.uint64(1), starts, ends),
                                    return_index=True, return_inverse=True)
        merger = self.merger
        merged = [merger[joined[a:b]] for a, b in zip(starts[first].tolist(), ends[first].tolist())]
        size = np.fromiter(map(len, merged), np.int64, len(merged))
        flat = np.fromiter(chain.from_iterable(merged), np.int32, int(size.sum()))
        counts = size[which]
        stops = np.cumsum(counts)
        ids = flat[np.repeat((np.cumsum(size) - size)[which] - stops + counts, counts) + np.arange(int(stops[-1]))]
        data, _ = self.decode(ids, np.zeros(1, np.int64))
        if data.tobytes() != joined.replace(MARK_CHARACTER, "").encode():
            merged = [merger[joined[a:b]] for a, b in zip(starts.tolist(), ends.tolist())]
            counts = np.fromiter(map(len, merged), np.int64, len(merged))
            ids = np.fromiter(chain.from_iterable(merged), np.int32, int(counts.sum()))
        return ids, counts

    def decode(self, ids: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(bytes of all texts, offsets into them by text): every token is
        copied to the offset at which the tokens before it end."""
        length = self.length[ids]
        ends = np.concatenate([[0], np.cumsum(length)])
        total = int(ends[-1])
        at = np.repeat(self.first[ids] - ends[:-1], length) + np.arange(total)
        return self.blob[at], ends[offsets]


_CODECS: dict[int, Codec] = {}


def _codec(shared) -> Codec:
    """One codec for each rank file and Python worker."""
    key = hash(shared.value)
    if key not in _CODECS:
        _CODECS.clear()
        _CODECS[key] = Codec(shared.value)
    return _CODECS[key]


def _share(df: DataFrame, ranks_path: str):
    """The rank file (about a megabyte, its size is that of a vocabulary)."""
    with open(ranks_path, "rb") as f:
        return df.sparkSession.sparkContext.broadcast(f.read())


def _lists(values: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, pa.int32()))


def _with(df: DataFrame, added: list[T.StructField]) -> tuple[list[str], T.StructType]:
    new = {f.name.lower() for f in added}
    kept = [f for f in df.schema.fields if f.name.lower() not in new]
    return [f.name for f in kept], T.StructType([*kept, *added])


def encode(df: DataFrame, ranks_path: str, text_col: str = "text", keep: list[str] | None = None,
           decoded: bool = False) -> DataFrame:
    """Add ``ids`` (array of int) and ``piece_ids`` (number of ids of each
    piece, in order: with the ids these are the offsets that let any range of
    pieces be decoded alone).  ``keep`` names the input columns that stay
    (default: all).  ``decoded`` adds what ``decode`` makes of the ids, in
    the same task."""
    ints = T.ArrayType(T.IntegerType(), False)
    shared = _share(df, ranks_path)
    small_batches(df.sparkSession)
    (own,) = unused(df, "own")
    text = F.col(f"`{text_col}`").cast("string").alias(own)
    rest = df.select(*[f"`{c}`" for c in (df.columns if keep is None else keep)])
    kept, schema = _with(rest, [T.StructField("ids", ints, False), T.StructField("piece_ids", ints, False),
                               *[T.StructField("decoded", T.BinaryType(), False)] * decoded])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(shared)
        for batch in batches:
            _, offsets = utf8(batch.column(own))
            for i, j in pieces(offsets):
                part = batch.slice(i, j - i)
                ids, at, counts, by_text = codec.encode([x or "" for x in part.column(own).to_pylist()])
                columns = [*(part.column(c) for c in kept), _lists(ids, at), _lists(counts, by_text)]
                if decoded:
                    columns.append(binary_array(*codec.decode(ids.astype(np.int64), at)))
                yield pa.RecordBatch.from_arrays(columns, schema.names)

    names = [f"`{c}`" for c in kept]
    return df.select(*names, text).mapInArrow(run, schema)


def decode(df: DataFrame, ranks_path: str, ids_col: str = "ids") -> DataFrame:
    """Add ``decoded`` (binary: the bytes of the ids in ``ids_col``)."""
    shared = _share(df, ranks_path)
    kept, schema = _with(df, [T.StructField("decoded", T.BinaryType(), False)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(shared)
        for batch in batches:
            column = batch.column(ids_col)
            sizes = np.asarray(column.value_lengths().fill_null(0), np.int64)
            for i, j in pieces(np.concatenate([[0], np.cumsum(sizes)]), 1 << 19):
                part = batch.slice(i, j - i)
                lists = part.column(ids_col)
                at = np.concatenate([[0], np.cumsum(np.asarray(lists.value_lengths().fill_null(0), np.int64))])
                out = binary_array(*codec.decode(np.asarray(lists.flatten(), np.int64), at))
                yield pa.RecordBatch.from_arrays([*[part.column(c) for c in kept], out], schema.names)

    return df.mapInArrow(run, schema)


def digests(df: DataFrame, ranks_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Encode, decode, and return (doc_id, n_tokens, ids_sha256,
    decoded_sha256) for each document."""
    source = df.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    coded = encode(source, ranks_path, "text", ["doc_id"], decoded=True)
    return coded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(",", F.col("ids").cast("array<string>")).cast("binary"), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )
