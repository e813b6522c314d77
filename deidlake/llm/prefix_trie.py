"""Prefix trie of conversations by whole-sequence collapse.

A turn becomes a 128-bit hash of role and text and a count of words; texts are
not shuffled.  Rows are dealt by ranges of (conversation, turn), so a long
conversation is spread over tasks; positions and running sums are made within
each piece of a conversation and completed by the sums of the pieces before.
A prefix is named by the sum of 128 hashed bits of (depth, turn) over its
turns, in four lanes, which is fixed by the turns and their places; the
parent's name is the same sum without the last turn.

Equal rebuilt conversations collapse into one sequence with a weight and a
list of ends.  Sequences that are a proper prefix of another go by an
anti-join; the others are the leaves.  Nodes are the weighted prefixes of the
sequences.  With n(v) the weight of a node, W(v) the words down to it and w(v)
those of its own text, its subtree holds

    sum of n(u) w(u) = sum over sequences s through v of weight(s) W(s)
                       - n(v) (W(v) - w(v))

and, each node being owned by the smallest leaf below it, the owned nodes of a
leaf being the end of its path from words B(leaf) on,

    sum of w(u) = sum over leaves l through v of (W(l) - B(l))
                  - (W(v) - w(v) - B(owner of v)).

Saved words are the difference.  Every step is a join or aggregate over one
row for each turn of a sequence: nothing grows with depth times length, and
nothing is done level by level.  The digest of ends has to be taken in one
pass over a sequence's sorted ids; they stream through, none is collected.

Defined results: turns of a null ``conv_id`` belong to no conversation; null
roles and texts are empty; rows of equal turn are ordered by the hash of role
and text, and equal rows are turns of their own.  Conversations without
turns after the rebuilding are members of the root alone.  An empty table
gives an empty result; other columns are ignored."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from deidlake.llm.common import WORD, partitions, stored

#: Conversations of a family: conv_id minus this remainder starts them.
FAMILY = 20
#: The shared head has fewer turns than this.
HEADS = 4
LANES = ("a", "b", "c", "d")
NO_ENDS = hashlib.sha256(b"").hexdigest()


def head_length(conv: Column) -> Column:
    """Turns that a rebuilt conversation takes from its family's first one."""
    return (F.crc32(conv.cast("string").cast("binary")) % HEADS).cast("int")


# ------------------------------------------------------------------ rebuilding

def _turns(df: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """(conv, turn, hash, words, part): one row a turn, ordered ranges of
    (conv, turn) by ``part``, written."""
    role, text = (F.coalesce(F.col(f"`{c}`").cast("string"), F.lit("")) for c in (role_col, text_col))
    whole = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    turns = df.where(F.col(f"`{conv_col}`").isNotNull()).select(
        F.col(f"`{conv_col}`").cast("long").alias("conv"), F.col(f"`{turn_col}`").alias("turn"),
        F.substring(F.unhex(F.sha2(whole, 256)), 1, 16).alias("hash"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"), F.monotonically_increasing_id().alias("row"))
    turns = turns.repartitionByRange(partitions(df.sparkSession), "conv", F.col("turn").asc_nulls_first(), "hash", "row")
    return stored(turns.withColumn("part", F.spark_partition_id()), "turns")


def rebuilt(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
            text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """The rebuilt conversations: (conv, part, depth, hash, words) for every
    turn, and (conv, length) for every conversation."""
    turns = _turns(df, conv_col, turn_col, role_col, text_col)
    pieces = turns.groupBy("conv", "part").agg(F.count(F.lit(1)).alias("n"))
    pieces = stored(pieces, "pieces")
    sizes = pieces.groupBy("conv").agg(F.sum("n").alias("own"))
    convs = sizes.select("conv", "own", head_length(F.col("conv")).alias("head"), (F.col("conv") - F.col("conv") % FAMILY).alias("first"))
    first = sizes.select(F.col("conv").alias("first"), F.col("own").alias("first_own"))
    convs = convs.join(first, "first", "left").withColumn("taken", F.least("head", F.coalesce("first_own", F.lit(0))))
    convs = stored(convs.select("conv", "first", "head", "taken", (F.col("taken") + F.greatest(F.col("own") - F.col("head"), F.lit(0))).alias("length")),
                   "conversations")
    before = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    pieces = pieces.withColumn("offset", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    pieces = pieces.join(convs.select("conv", "head", "taken"), "conv")
    order = Window.partitionBy("conv", "part").orderBy(F.col("turn").asc_nulls_first(), "hash", "row")
    placed = turns.join(pieces, ["conv", "part"]).withColumn("place", F.col("offset") + F.row_number().over(order))
    placed = stored(placed.select("conv", "part", "place", "head", "taken", "hash", "words"), "placed")
    own = placed.where("place > head").select("conv", "part", (F.col("place") - F.col("head") + F.col("taken")).alias("depth"), "hash", "words")
    heads = placed.where(F.col("place") < HEADS).select(F.col("conv").alias("first"), "place", "hash", "words")
    heads = convs.select("conv", "first", "taken").join(heads, "first").where("place <= taken")
    heads = heads.select("conv", F.lit(-1).alias("part"), F.col("place").alias("depth"), "hash", "words")
    return own.unionByName(heads), convs.select("conv", "length")


# -------------------------------------------------------------------- prefixes

def _name(depth: Column, lanes: list[Column]) -> Column:
    return F.unhex(F.md5(F.concat_ws(",", depth.cast("string"), *[x.cast("string") for x in lanes])))


def _root() -> Column:
    return _name(F.lit(0), [F.lit(0)] * len(LANES))


def prefixes(turns: DataFrame) -> DataFrame:
    """(conv, part, depth, key, parent, words, total) of every turn: names of
    the prefix and of its parent, words of the turn and down to it."""
    x, y = (F.xxhash64(F.lit(seed), F.col("depth").cast("long"), F.col("hash")) for seed in (1, 2))
    mask = F.lit((1 << 32) - 1)
    lanes = dict(zip(LANES, (x.bitwiseAND(mask), F.shiftrightunsigned(x, 32), y.bitwiseAND(mask), F.shiftrightunsigned(y, 32))))
    sums = [*LANES, "words"]
    turns = stored(turns.withColumns(lanes).drop("hash"), "turn-lanes")
    pieces = turns.groupBy("conv", "part").agg(*[F.sum(c).alias(c) for c in sums])
    before = Window.partitionBy("conv").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    pieces = pieces.select("conv", "part", *[F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"{c}_before") for c in sums])
    upto = Window.partitionBy("conv", "part").orderBy("depth").rowsBetween(Window.unboundedPreceding, 0)
    run = turns.join(pieces, ["conv", "part"]).select(
        "conv", "part", "depth", *sums, *[(F.col(f"{c}_before") + F.sum(c).over(upto)).alias(f"{c}_sum") for c in sums])
    return run.select("conv", "part", "depth", _name(F.col("depth"), [F.col(f"{c}_sum") for c in LANES]).alias("key"),
                      _name(F.col("depth") - 1, [F.col(f"{c}_sum") - F.col(c) for c in LANES]).alias("parent"),
                      "words", F.col("words_sum").alias("total"))


def ends_digests(ends: DataFrame) -> DataFrame:
    """(key, ends_sha256) from (key, conv): SHA-256 of the ids, ascending,
    joined by commas.  A key's ids stream through one task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state = None, None
        for batch in batches:
            keys, texts = [], []
            ids = batch.column("conv").to_pylist()
            found = batch.column("key").dictionary_encode()
            names, codes = found.dictionary.to_pylist(), found.indices.to_pylist()
            a = 0
            while a < len(ids):
                b = a + 1
                while b < len(ids) and codes[b] == codes[a]:
                    b += 1
                if names[codes[a]] != key:
                    if state is not None:
                        keys.append(key)
                        texts.append(state.hexdigest())
                    key, state = names[codes[a]], hashlib.sha256()
                else:
                    state.update(b",")
                state.update(",".join(map(str, ids[a:b])).encode())
                a = b
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(texts, pa.string())], ["key", "ends_sha256"])
        if state is not None:
            yield pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([state.hexdigest()])], ["key", "ends_sha256"])

    dealt = ends.select("key", "conv").repartition(partitions(ends.sparkSession), "key").sortWithinPartitions("key", "conv")
    return dealt.mapInArrow(run, "key binary, ends_sha256 string")


# ------------------------------------------------------------------------ trie

def trie(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row for each node of the trie of the rebuilt conversations:
    conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves,
    saved_tokens, ends_sha256."""
    turns, convs = rebuilt(df, conv_col, turn_col, role_col, text_col)
    steps = stored(prefixes(turns), "prefixes")
    # whole sequences
    last = steps.join(convs, "conv").where("depth = length").select("conv", "key", "total")
    turnless = convs.where("length = 0").select("conv", _root().alias("key"), F.lit(0).cast("long").alias("total"))
    whole = stored(last.unionByName(turnless), "whole-sequences")
    sequences = whole.groupBy("key", "total").agg(F.min("conv").alias("conv"), F.count(F.lit(1)).alias("weight"))
    sequences = stored(sequences, "sequences")
    paths = stored(steps.join(sequences.select("conv", "weight", F.col("total").alias("whole")), "conv").select(
        "conv", "depth", "key", "parent", "words", "total", "weight", "whole"), "paths")
    inner = paths.select(F.col("parent").alias("key")).distinct()
    leaves = stored(sequences.join(inner, "key", "left_anti").select("conv", F.lit(True).alias("leaf")), "leaves")
    # nodes: the weighted prefixes
    root = sequences.select("conv", F.lit(0).cast("long").alias("depth"), _root().alias("key"), F.lit(None).cast("binary").alias("parent"),
                            F.lit(0).cast("long").alias("words"), F.lit(0).cast("long").alias("total"), "weight", F.col("total").alias("whole"))
    paths = paths.withColumn("depth", F.col("depth").cast("long")).unionByName(root).join(leaves, "conv", "left")
    nodes = stored(paths.groupBy("key", "parent", "depth", "words", "total").agg(
        F.min("conv").alias("conv_id"), F.sum("weight").alias("n_convs"), F.sum(F.col("weight") * F.col("whole")).alias("weighted"),
        F.count("leaf").alias("n_leaves"), F.min(F.when(F.col("leaf"), F.col("conv"))).alias("owner")), "nodes")
    above = nodes.groupBy("owner").agg(F.min(F.col("total") - F.col("words")).alias("above"))
    below = paths.where("leaf").join(above, F.col("conv") == F.col("owner")).groupBy("key").agg(
        F.sum(F.col("whole") - F.col("above")).alias("distinct_words"))
    children = nodes.where("depth > 0").groupBy(F.col("parent").alias("key")).agg(F.count(F.lit(1)).alias("n_children"))
    parents = nodes.select(F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    head = F.col("total") - F.col("words")
    return (nodes.join(below, "key").join(above, "owner").join(children, "key", "left").join(ends_digests(whole), "key", "left")
            .join(parents, "parent", "left").select(
                "conv_id", "depth", "parent_conv_id", "n_convs", F.coalesce("n_children", F.lit(0)).cast("long").alias("n_children"), "n_leaves",
                (F.col("weighted") - F.col("n_convs") * head - F.col("distinct_words") + head - F.col("above")).alias("saved_tokens"),
                F.coalesce("ends_sha256", F.lit(NO_ENDS)).alias("ends_sha256")))


TRIE_SQL = rf"""
WITH t AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
                  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS place
           FROM conversations WHERE conv_id IS NOT NULL),
size AS (SELECT conv_id, count(*) AS own FROM t GROUP BY conv_id),
crc AS (SELECT conv_id, own, conv_id - conv_id % {FAMILY} AS first,
               xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
                   lambda c, b: list_reduce(list_prepend(xor(c, b), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
                                            lambda v, z: CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END)), 4294967295) % {HEADS} AS h
        FROM size),
conv AS (SELECT c.conv_id, c.first, c.h, least(c.h, coalesce(f.own, 0)) AS taken FROM crc c LEFT JOIN size f ON f.conv_id = c.first),
step AS (SELECT conv_id, place - h + taken AS depth, role, text FROM t JOIN conv USING (conv_id) WHERE place > h
         UNION ALL
         SELECT c.conv_id, place, role, text FROM conv c JOIN t ON t.conv_id = c.first WHERE place <= taken),
path AS (SELECT conv_id, depth, len(regexp_extract_all(text, '{WORD}')) AS w,
                md5(string_agg(md5(length(role) || ':' || role || text), ',')
                    OVER (PARTITION BY conv_id ORDER BY depth ROWS UNBOUNDED PRECEDING)) AS key FROM step),
member AS (SELECT conv_id, depth, w, key, lag(key, 1, '') OVER (PARTITION BY conv_id ORDER BY depth) AS parent FROM path
           UNION ALL SELECT conv_id, 0, 0, '', NULL FROM conv),
node AS (SELECT key, min(conv_id) AS conv_id, any_value(depth) AS depth, any_value(w) AS w, any_value(parent) AS parent, count(*) AS n
         FROM member GROUP BY key),
child AS (SELECT parent AS key, count(*) AS n_children FROM node WHERE parent IS NOT NULL GROUP BY parent),
below AS (SELECT v.key, sum((u.n - 1) * u.w) AS saved, count(*) FILTER (u.key NOT IN (SELECT key FROM child)) AS n_leaves
          FROM node u JOIN member v ON v.conv_id = u.conv_id AND v.depth <= u.depth GROUP BY v.key),
last AS (SELECT key, conv_id FROM member QUALIFY row_number() OVER (PARTITION BY conv_id ORDER BY depth DESC) = 1),
ends AS (SELECT key, sha256(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id)) AS ends_sha256 FROM last GROUP BY key)
SELECT n.conv_id, n.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, n.n::BIGINT AS n_convs, coalesce(n_children, 0)::BIGINT AS n_children,
       n_leaves::BIGINT AS n_leaves, saved::BIGINT AS saved_tokens, coalesce(ends_sha256, sha256('')) AS ends_sha256
FROM node n JOIN below USING (key) LEFT JOIN child USING (key) LEFT JOIN ends USING (key) LEFT JOIN node p ON p.key = n.parent
"""
