"""Lexicon-based entity extraction (DISEASE, CHEMICAL by default).

Plan (all JVM-side, no Python worker):

1. group equal rows (ids, null-safe, and text) under one row key, with their
   number, so that copies of a row are searched once and texts with a
   repeated id stay apart; all later steps keep that partitioning;
2. tokenize each text into words (``split`` on non-letter/digit runs), one
   row for each word: its position and the word alone;
3. join them with the lexicon's first words, each with the lengths of the
   terms that begin with it; Catalyst and AQE choose the join by the lexicon's
   measured size;
4. collect the surviving positions of each text and cut word sequences out
   of its tokens there, of just these lengths; equi-join them with the terms;
5. per text, resolve overlaps like ``filter_spans``: longest first, then
   earliest; accept a span if none of its words is taken.  Spans that overlap
   nothing need no comparison: a window over the text's candidates cuts them
   into islands (runs of overlapping spans), and each island is resolved alone.

Outputs: long form (ids, label, pos, text) and the nested form
``array<array<string>>`` with one list per label in label order.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from deidlake.constants import FEATURE_EXTRACTION_LABELS, FEATURE_EXTRACTION_SUFFIX
from deidlake.functions.patterns import ENTITY_LEXICON, TOKEN_SPLIT

TEXT_KEY = "_text_key"
ROW_KEY = "_row_key"


def normalised(terms: DataFrame) -> DataFrame:
    """(term, label, n_words, first_word) of (term, label), the terms
    normalised like texts: lower case, words separated by single spaces."""
    words = F.filter(F.split(F.lower("term"), TOKEN_SPLIT), lambda w: w != "")
    return terms.select(
        F.array_join(words, " ").alias("term"),
        "label",
        F.size(words).alias("n_words"),
        F.get(words, 0).alias("first_word"),
    ).where(F.col("n_words") > 0).dropDuplicates(["term", "label"])


def lexicon_df(spark: SparkSession, entries=ENTITY_LEXICON) -> DataFrame:
    """``normalised`` of a list of (term, label)."""
    return normalised(spark.createDataFrame(list(entries), "term string, label string"))


def keyed_texts(texts: DataFrame, id_columns) -> DataFrame:
    """Equal rows of ``texts`` (ids, _text) as one row under ``ROW_KEY``, which
    is never null: ids, ``TEXT_KEY``, the text and the number of rows."""
    ids = list(id_columns)
    every = texts.select(*ids, "_text", text_key("_text").alias(TEXT_KEY))
    row = F.md5(F.to_json(F.struct(*[F.col(c) for c in ids], F.col(TEXT_KEY))).cast("binary"))
    return every.groupBy(row.alias(ROW_KEY)).agg(
        *[F.first(c).alias(c) for c in (*ids, TEXT_KEY, "_text")], F.count(F.lit(1)).alias("_n"))


def entity_candidates(texts: DataFrame, lexicon: DataFrame, key: str = ROW_KEY) -> DataFrame:
    """All lexicon hits in ``texts`` (``key``, never null, _text): ``key``, label,
    pos (word index), n (words), text."""
    base = texts.select(key, F.split("_text", TOKEN_SPLIT).alias("_tok"))
    words = base.select(key, F.posexplode("_tok").alias("pos", "_w")).where(F.col("_w") != "")
    first = lexicon.groupBy(F.col("first_word").alias("_first")).agg(F.collect_set("n_words").alias("lengths"))
    begun = words.join(first, F.lower("_w") == F.col("_first")).groupBy(key).agg(
        F.collect_list(F.struct("pos", "lengths")).alias("_at"))

    def sequences(at):
        return F.transform(F.filter(at["lengths"], lambda n: at["pos"] + n <= F.size("_tok")), lambda n: F.struct(
            at["pos"].alias("pos"), n.alias("n"), F.array_join(F.slice("_tok", at["pos"] + 1, n), " ").alias("text")))

    found = base.join(begun, key).select(key, F.flatten(F.transform("_at", sequences)).alias("_seq"))
    found = found.select(key, F.inline("_seq"))
    lex = lexicon.select(F.col("term").alias("_term"), "label", F.col("n_words").alias("_nw"))
    hit = (F.lower(F.col("text")) == F.col("_term")) & (F.col("n") == F.col("_nw"))
    return found.join(lex, hit).select(key, "label", "pos", "n", "text")


def resolve_overlaps(cands: DataFrame, id_columns, first: str | None = None) -> DataFrame:
    """Keep non-overlapping spans per text: longest first, then earliest,
    then label; a span is accepted when none of its words is taken.  With
    ``first``, an integer column that is returned as well, spans of a smaller
    number go before longer ones."""
    ids = list(id_columns)
    if first is None:
        return resolve_overlaps(cands.withColumn("_first", F.lit(0)), ids, "_first").drop("_first")
    before = Window.partitionBy(*ids).orderBy("pos", "n", "label").rowsBetween(Window.unboundedPreceding, -1)
    reached = F.coalesce(F.max(F.col("pos") + F.col("n")).over(before), F.lit(0))
    upto = Window.partitionBy(*ids).orderBy("pos", "n", "label").rowsBetween(Window.unboundedPreceding, 0)
    # spans that no earlier span reaches begin a new island
    cut = cands.withColumn("_new", (F.col("pos") >= reached).cast("long")).withColumn("_island", F.sum("_new").over(upto))
    item = F.struct(F.col(first).cast("int").alias("first"), (-F.col("n")).alias("neg_n"), "pos", "label", "n", "text")
    islands = cut.groupBy(*ids, "_island").agg(F.sort_array(F.collect_list(item)).alias("_c"))
    empty = F.array().cast("array<struct<label:string,pos:int,n:int,text:string,first:int>>")

    def step(acc, c):
        overlaps = F.exists(acc, lambda a: (a["pos"] < c["pos"] + c["n"]) & (c["pos"] < a["pos"] + a["n"]))
        accepted = F.struct(c["label"].alias("label"), c["pos"].alias("pos"), c["n"].alias("n"),
                            c["text"].alias("text"), c["first"].alias("first"))
        return F.when(overlaps, acc).otherwise(F.concat(acc, F.array(accepted)))

    kept = islands.select(*ids, F.aggregate("_c", empty, step).alias("_k"))
    return kept.select(*ids, F.inline("_k")).select(*ids, "label", "pos", "n", "text", F.col("first").alias(first))


def text_key(column: str) -> Column:
    """Tells texts with equal ids apart."""
    return F.md5(F.col(column).cast("binary"))


def extract_entities(df: DataFrame, id_columns, column: str, lexicon: DataFrame | None = None,
                     by_text: bool = False) -> DataFrame:
    """Long form: one row per accepted entity (ids, label, pos, text).

    Entities of equal rows are found once and repeated as often as the row;
    with ``by_text`` they aren't repeated, and ``TEXT_KEY`` is added, as
    ``nested_entities`` takes them."""
    ids = list(id_columns)
    lexicon = lexicon_df(df.sparkSession) if lexicon is None else lexicon
    texts = keyed_texts(df.where(F.col(column).isNotNull()).select(*ids, F.col(column).alias("_text")), ids)
    found = resolve_overlaps(entity_candidates(texts, lexicon), [ROW_KEY])
    found = found.join(texts.select(ROW_KEY, *ids, TEXT_KEY, "_n"), ROW_KEY)
    if by_text:
        return found.select(*ids, TEXT_KEY, "label", "pos", "text")
    each = found.withColumn("_k", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_n"))))
    return each.select(*ids, "label", "pos", "text")


def _has_label(label: str):
    # one-argument lambda: PySpark reads a second parameter as the index
    return lambda e: e["label"] == F.lit(label)


def nested_entities(df: DataFrame, id_columns, column: str, long: DataFrame,
                    labels=FEATURE_EXTRACTION_LABELS) -> DataFrame:
    """``df`` plus ``<column>_feature_extraction``: one list per label (in
    ``labels`` order) of entity texts in document order; rows without
    entities (also NULL/empty text) get one empty list per label."""
    ids = list(id_columns)
    keys = [*ids, *[c for c in (TEXT_KEY,) if c in long.columns]]
    per = long.groupBy(*[F.col(k).alias(f"_own_{k}") for k in keys]).agg(
        F.sort_array(F.collect_list(F.struct("pos", "label", "text"))).alias("_e"))
    lists = [F.transform(F.filter(F.col("_e"), _has_label(lab)), lambda e: e["text"]) for lab in labels]
    empty = F.array(*[F.array().cast("array<string>") for _ in labels])
    out_name = column + FEATURE_EXTRACTION_SUFFIX
    same = F.lit(True)
    for k in keys:  # null-safe, like all keys of this library
        same = same & (text_key(column) if k == TEXT_KEY else F.col(k)).eqNullSafe(F.col(f"_own_{k}"))
    joined = df.join(per, same, "left")
    return joined.select(
        *[df[c] for c in df.columns],
        F.when(F.col("_e").isNull(), empty).otherwise(F.array(*lists)).alias(out_name),
    )


def entity_counts(long: DataFrame) -> DataFrame:
    """Mentions and distinct texts per (label, lower-cased term)."""
    return long.groupBy("label", F.lower("text").alias("term")).agg(
        F.count(F.lit(1)).alias("n_mentions"),
    )
