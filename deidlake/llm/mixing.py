"""Mixing sources to target weights, with DataFrame operations only.

Targets: the sources, in code point order (null last), have given weights
that repeat; each gets its share of all words, but at most three times its
own words.  What is over goes to the others by weight until none is above:
in order of limit per weight the sources that stop are the first ones, so
running sums over the small table of sources find the level.

Sampling: systematic.  Each document's expected copies are target / size of
its source.  Their prefix sums run through the documents of a source; with
one random offset per source a document is emitted once per integer boundary
crossed.  A source is dealt to groups of bounded size by a hash of the
document id, and ranked inside the groups (smaller documents first, which
spreads every size evenly over the boundaries); the groups' counts are summed
up in the table of groups.  So a source with a third of all rows is spread
over many tasks.

Defined results: a null or empty text has size 0 and takes nothing; sources
without words have target 0; ties and repeated rows are separate documents,
ranked by size, id and text hash; an empty table gives an empty result;
a run on the same rows gives the same copies, whatever their order.
``with_copies`` (and ``copies``, which carries the id alone) replaces columns called like an output column (``OUTPUTS``)
and keeps others, ``mix`` keeps all."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from deidlake.llm.common import words

WEIGHTS = (5, 2, 1)
MOST_COPIES = 3
#: Documents of a group (on average).
GROUP_ROWS = 2_000
OUTPUTS = ("size", "source_size", "target", "copies", "taken")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_COPIES) -> DataFrame:
    """Add ``target`` to a table (source, source_size, ...) of sources."""
    by_source = Window.orderBy(F.col("source").asc_nulls_last())
    level = F.col("limit") / F.col("weight")
    by_level = Window.orderBy(level, F.col("source").asc_nulls_last())
    everything = Window.partitionBy()
    cycle = F.array(*[F.lit(w) for w in weights])
    ranked = sizes.withColumn("weight", F.get(cycle, F.pmod(F.row_number().over(by_source) - 1, F.lit(len(weights)))))
    ranked = ranked.withColumn("limit", most * F.col("source_size"))
    # words and weight that are left if this source and all before it stop
    before = by_level.rowsBetween(Window.unboundedPreceding, -1)
    rest = (
        F.sum("source_size").over(everything) - F.coalesce(F.sum("limit").over(before), F.lit(0))
    ) / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
    ranked = ranked.withColumn("rest", rest).withColumn("open", F.col("rest") <= level)
    # the level of the first source that doesn't stop holds for all after it
    share = F.min(F.when(F.col("open"), F.struct(level, F.col("rest")))).over(everything)["rest"]
    target = F.when(F.coalesce(level < share, F.lit(True)), F.col("limit")).otherwise(share * F.col("weight"))
    return ranked.withColumn("target", target.cast("double")).drop("weight", "limit", "rest", "open")


def _offset(source: Column, seed: int) -> Column:
    """A number in [0, 1) for each source."""
    return F.pmod(F.xxhash64(F.coalesce(source, F.lit("")), source.isNull(), F.lit(seed)), F.lit(1 << 40)) / (1 << 40)


def with_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
                seed: int = 0, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """Add ``OUTPUTS``: a document's words, its source's words and target,
    the document's copies, and the words these take."""
    return _with_copies(docs, docs.columns, id_col, text_col, source_col, seed, weights)


def copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
           seed: int = 0, weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """(id, ``OUTPUTS``) of each document: the numbers alone.  No text leaves
    the task that reads it."""
    return _with_copies(docs, [id_col], id_col, text_col, source_col, seed, weights)


def _with_copies(docs: DataFrame, carry: list[str], *options) -> DataFrame:
    kept = [F.col(f"doc.`{c}`") for c in carry if c.lower() not in OUTPUTS]
    return _placed(docs, *options, carry=carry).select(*kept, *OUTPUTS)


def _placed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
            seed: int = 0, weights: tuple[int, ...] = WEIGHTS, carry: list[str] | None = None) -> DataFrame:
    """(doc, OUTPUTS): the columns ``carry`` of ``docs`` (default: all) as one
    struct, so that their names clash with nothing."""
    sized = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in carry or docs.columns]).alias("doc"), F.size(words(F.col(f"`{text_col}`").cast("string"))).cast("long").alias("size"),
        F.col(f"`{source_col}`").cast("string").alias("__source"),
        F.xxhash64(F.col(f"`{id_col}`"), F.lit(seed)).alias("__deal"),
        F.xxhash64(F.col(f"`{text_col}`")).alias("__tie"), F.col(f"`{id_col}`").alias("__id"),
    )
    lean = docs.select(
        F.col(f"`{source_col}`").cast("string").alias("source"),
        F.xxhash64(F.col(f"`{id_col}`"), F.lit(seed)).alias("deal"),
        F.size(words(F.col(f"`{text_col}`").cast("string"))).cast("long").alias("size"),
    )
    sources = lean.groupBy("source").agg(F.sum("size").alias("source_size"), F.count(F.lit(1)).alias("rows"))
    sources = targets(sources, weights).select(
        F.col("source").alias("__source"), "source_size", "target",
        F.ceil(F.col("rows") / GROUP_ROWS).alias("__groups"))
    same = lambda a, b: a["__source"].eqNullSafe(b["__source"])
    # groups of a source and the number of documents in the groups before
    dealt = lean.select(F.col("source").alias("__source"), "deal")
    counts = dealt.join(sources, same(dealt, sources)).select(
        dealt["__source"], F.pmod("deal", F.col("__groups")).alias("__group")).groupBy("__source", "__group").count()
    running = Window.partitionBy("__source").orderBy("__group").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select("__source", "__group", F.coalesce(F.sum("count").over(running), F.lit(0)).alias("__before"))
    grouped = sized.join(sources, same(sized, sources)).drop(sources["__source"])
    grouped = grouped.withColumn("__group", F.pmod("__deal", F.col("__groups")))
    rank = Window.partitionBy("__source", "__group").orderBy("size", F.col("__id").asc_nulls_first(), "__tie")
    grouped = grouped.withColumn("__rank", F.row_number().over(rank))
    placed = grouped.join(
        counts, same(grouped, counts) & (grouped["__group"] == counts["__group"])
    ).drop(counts["__source"]).drop(counts["__group"])
    rate = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(0.0))
    at = F.col("__before") + F.col("__rank")
    crossed = lambda n: F.floor(n * rate + _offset(F.col("__source"), seed))
    placed = placed.withColumn("copies", F.least(crossed(at) - crossed(at - 1), F.lit(MOST_COPIES)).cast("long"))
    return placed.withColumn("taken", F.col("copies") * F.col("size")).select("doc", *OUTPUTS)


def mix(docs: DataFrame, **options) -> DataFrame:
    """The mixture itself: each document as often as it has copies, with the
    columns of the input."""
    out = _placed(docs, **options).where("copies > 0")
    each = out.select("doc", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("copy"))
    return each.select(*[F.col(f"doc.`{c}`") for c in docs.columns])
