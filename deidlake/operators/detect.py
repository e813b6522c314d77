"""Scored detection of personal data: patterns and name lexicons propose spans with
a score, context words before a span raise it, and conflicts go to the higher score.

Scores are whole per cents, so that they add up alike everywhere.

1. Equal rows are searched once (:func:`deidlake.operators.entities.keyed_texts`).
2. Patterns are searched each in the original text (not in what others left), by
   the JVM; names and context words in one lexicon join of the words.
3. A span whose entity has a context word ending at most ``reach`` code points
   before it gains ``boost``, and has ``with_context`` at least.  The nearest
   context word is found by a window over the text's spans and context words of
   the entity, so the work is linear in their number.
4. Spans below ``least`` go; of overlapping ones the higher score stays, then
   the longer, the earlier, the entity's name.

Null and empty texts have no spans; those of repeated rows are repeated."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from deidlake.functions.patterns import DATE_TIME, EMAIL, PHONE, TOKEN_SPLIT, URL, Pattern
from deidlake.functions.text import empty_to_null, may_match
from deidlake.operators.entities import ROW_KEY, entity_candidates, keyed_texts, normalised, resolve_overlaps
from deidlake.operators.redact import _starts

BOOST, WITH_CONTEXT, LEAST, REACH = 35, 40, 40, 40
NAME_SCORE = 85
#: Marks context words among the labels of the lexicon join.
CONTEXT = "context of "


@dataclass(frozen=True)
class Detector:
    """A pattern, and the score of its matches without context."""

    pattern: Pattern
    score: int


DETECTORS = (Detector(EMAIL, 100), Detector(URL, 50), Detector(DATE_TIME, 60), Detector(PHONE, 40))
#: Words that make an entity likelier when they stand before it.
CONTEXT_WORDS = {
    "PERSON": ("name", "named", "patient", "client", "dr", "mr", "mrs", "ms"),
    "LOCATION": ("from", "in", "address", "lives", "born in"),
    "DATE_TIME": ("date", "on", "born", "seen"),
    "EMAIL_ADDRESS": ("email", "mail"),
    "URL": ("website", "link"),
    "PHONE_NUMBER": ("phone", "tel", "telephone", "mobile", "call"),
}


def _of_pattern(texts: DataFrame, d: Detector) -> DataFrame:
    """(ROW_KEY, label, pos, n, text, score) of a pattern, places in code points."""
    found = F.regexp_extract_all("_text", F.lit(d.pattern.regex), 1)
    guard = may_match(F.col("_text"), d.pattern)
    hits = texts.select(ROW_KEY, "_text", (found if guard is None else F.when(guard, found)).alias("_f")).where(F.size("_f") > 0)
    hits = hits.select(ROW_KEY, "_f", F.split("_text", d.pattern.regex, -1).alias("_g"))
    starts = F.slice(_starts(F.col("_g"), F.col("_f")), F.lit(1), F.size("_f"))
    hits = hits.select(ROW_KEY, F.inline(F.transform(starts, lambda at, i: F.struct(F.get(F.col("_f"), i).alias("text"), at.alias("pos")))))
    return hits.select(ROW_KEY, F.lit(d.pattern.entity).alias("label"), "pos", F.length("text").alias("n"), "text",
                       F.lit(d.score).alias("score"))


def _of_words(texts: DataFrame, terms: DataFrame, score: int) -> DataFrame:
    """The same for the terms of a lexicon, cut from the original text."""
    hits = entity_candidates(texts, terms).groupBy(ROW_KEY).agg(F.collect_list(F.struct("label", "pos", "n")).alias("_hits"))
    cut = texts.join(hits, ROW_KEY).select(
        ROW_KEY, "_hits", F.split("_text", TOKEN_SPLIT, -1).alias("_tok"), F.regexp_extract_all("_text", F.lit(TOKEN_SPLIT), 0).alias("_gap"))
    # text = token 0, gap 0, token 1, gap 1, ...
    cut = cut.select(ROW_KEY, "_hits", "_tok", F.concat(F.array(F.lit("")), F.col("_gap")).alias("_before"), F.transform(
        "_tok", lambda t, i: F.concat(t, F.coalesce(F.get(F.col("_gap"), i), F.lit("")))).alias("_pair"))
    cut = cut.select(ROW_KEY, "_hits", "_tok", "_pair", _starts(F.col("_before"), F.col("_tok")).alias("_at"))

    def placed(h):
        last = F.get(F.col("_tok"), h["pos"] + h["n"] - 1)
        # of one word: no slice, which reads the whole array
        text = F.when(h["n"] == 1, last).otherwise(F.concat(F.array_join(F.slice("_pair", h["pos"] + 1, h["n"] - 1), ""), last))
        return F.struct(h["label"].alias("label"), F.get(F.col("_at"), h["pos"]).alias("pos"), text.alias("text"))

    found = cut.select(ROW_KEY, F.inline(F.transform("_hits", placed)))
    return found.select(ROW_KEY, "label", "pos", F.length("text").alias("n"), "text", F.lit(score).alias("score"))


def _with_context(found: DataFrame, boost: int, with_context: int, reach: int) -> DataFrame:
    """Spans with the score that their context gives them; context words go."""
    is_context = F.col("label").startswith(CONTEXT)
    own = found.withColumn("_context", is_context).withColumn("label", F.replace("label", F.lit(CONTEXT), F.lit("")))
    # a context word counts from where it ends, before a span that begins there
    at = F.when(F.col("_context"), F.col("pos") + F.col("n")).otherwise(F.col("pos"))
    before = (Window.partitionBy(ROW_KEY, "label").orderBy(F.col("_at"), F.col("_context").desc())
              .rangeBetween(Window.unboundedPreceding, Window.currentRow))
    own = own.withColumn("_at", at).withColumn("_near", F.max(F.when(F.col("_context"), F.col("_at"))).over(before))
    raised = F.least(F.lit(100), F.greatest(F.col("score") + boost, F.lit(with_context)))
    score = F.when(F.col("_at") - F.col("_near") <= reach, raised).otherwise(F.col("score"))
    return own.where(~F.col("_context")).select(ROW_KEY, "label", "pos", "n", "text", score.alias("score"))


def detect(df: DataFrame, id_columns, column: str, names: DataFrame | None = None, detectors: Sequence[Detector] = DETECTORS,
           context: Mapping[str, Sequence[str]] = CONTEXT_WORDS, name_score: int = NAME_SCORE, boost: int = BOOST,
           with_context: int = WITH_CONTEXT, least: int = LEAST, reach: int = REACH) -> DataFrame:
    """One row per accepted span: ids, ``column_name``, ``entity``, ``span``,
    ``start`` and ``end`` (code points, end exclusive), ``score`` (per cent).

    ``names`` (term, label) is a lexicon of any size: terms of any number of
    words, case ignored, equal up to what parts the words."""
    if names is None and not detectors:
        raise ValueError("nothing to detect")
    spark = df.sparkSession
    # ids under names of our own: theirs may be those of the result
    ids = {f"_id{i}": c for i, c in enumerate(id_columns)}
    texts = df.select(*[F.col(f"`{c}`").alias(k) for k, c in ids.items()], empty_to_null(F.col(f"`{column}`")).alias("_text"))
    texts = keyed_texts(texts.where("_text IS NOT NULL"), list(ids))
    found = [_of_pattern(texts, d) for d in detectors]
    near = [(word, CONTEXT + entity) for entity, own in context.items() for word in own]
    terms = [] if names is None else [names.select(F.col("term").cast("string"), F.col("label").cast("string"))]
    if near:
        terms.append(spark.createDataFrame(near, "term string, label string"))
    if terms:
        found.append(_of_words(texts, normalised(reduce(DataFrame.unionByName, terms)), name_score))
    scored = _with_context(reduce(DataFrame.unionByName, found), boost, with_context, reach).where(F.col("score") >= least)
    kept = resolve_overlaps(scored.withColumn("_rank", -F.col("score")), [ROW_KEY], "_rank")
    kept = kept.join(texts.select(ROW_KEY, *ids, "_n"), ROW_KEY)
    each = kept.withColumn("_k", F.explode(F.sequence(F.lit(1).cast("long"), F.col("_n"))))
    return each.select(*[F.col(k).alias(c) for k, c in ids.items()], F.lit(column).alias("column_name"), F.col("label").alias("entity"), F.col("text").alias("span"),
                       F.col("pos").alias("start"), (F.col("pos") + F.col("n")).alias("end"), (-F.col("_rank")).alias("score"))
