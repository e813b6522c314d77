"""Free-text redaction as Spark column expressions, span tables and an
audit aggregate.

Detection is a fixed chain of regular expressions (e-mail, URL, date/time,
phone) followed by lexicon matches (person, location), all evaluated by
the JVM inside the projection -- no Python worker in the hot path.  A
model-based detector can be plugged in through ``text_fn`` of
:func:`deidlake.operators.deidentify.deidentify` (see
:mod:`deidlake.functions.udfs`)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from deidlake.constants import PII_ENTITIES
from deidlake.functions.patterns import TOKEN_SPLIT, patterns_for
from deidlake.functions.text import empty_to_null, may_match, redact_expr
from deidlake.operators.entities import entity_candidates, normalised, resolve_overlaps, text_key
from deidlake.operators.parallel import spread


def redact_columns(df: DataFrame, columns, entities=PII_ENTITIES, max_chars: int | None = None) -> DataFrame:
    columns = list(columns)
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise KeyError(f"Unable to redact missing columns {missing}")
    return df.select(
        *[redact_expr(df[c], entities, max_chars).alias(c) if c in columns else df[c] for c in df.columns]
    )


def redact_table(df: DataFrame, key_columns, columns, entities=PII_ENTITIES, max_chars: int | None = None) -> DataFrame:
    """:func:`redact_columns` after :func:`spread` so long texts use all cores."""
    return redact_columns(spread(df, key_columns), columns, entities, max_chars)


#: Stands for the inner characters of a masked span; no pattern matches it.
FILLER = "\ue000"
SPAN_ARRAY = "array<struct<entity:string,span:string,start:int,end:int>>"


def _running(values, gap, span):
    """Fold ``values`` into the offset after them and the offset of each span."""
    def step(acc, x):
        at = acc["at"] + gap(x)
        return F.struct((at + span(x)).alias("at"), F.concat(acc["starts"], F.array(at)).alias("starts"))

    return F.aggregate(values, F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("starts")), step)


def _starts(gaps, spans):
    """Code point offsets of the spans, given the text between them.

    A fold copies its array at each step, so the spans are taken in blocks of
    about the square root of their number: offsets inside each block, then
    those of the blocks (100,000 spans: 3e7 numbers copied, not 5e9)."""
    n = F.greatest(F.size(gaps), F.lit(1))
    size = F.ceil(F.sqrt(n)).cast("int")

    length = lambda c: F.coalesce(F.length(c), F.lit(0))

    def block(i):
        # by index: arrays_zip is slower than all the rest
        values = F.transform(F.slice(gaps, i, size), lambda g, k: F.struct(length(g).alias("g"), length(F.get(spans, i + k - 1)).alias("s")))
        return _running(values, lambda x: x["g"], lambda x: x["s"])

    # a block is to its neighbours like a span without a gap
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<int>").alias("starts"))
    return F.aggregate(F.transform(F.sequence(F.lit(1), n, size), block), zero, lambda acc, b: F.struct(
        (acc["at"] + b["at"]).alias("at"),
        F.concat(acc["starts"], F.transform(b["starts"], lambda start: start + acc["at"])).alias("starts")), lambda acc: acc["starts"])


def _located(entity: str):
    def span(x):
        return F.struct(F.lit(entity).alias("entity"), x["span"].alias("span"), x["start"].alias("start"),
                        (x["start"] + F.length(x["span"])).alias("end"))
    return span


def _mask(span):
    """``<``, filler, ``>``, as long as the span: what later patterns see in
    place of the span is bounded like ``<ENTITY>``, and offsets stay those of
    the original text."""
    inner = F.greatest(F.length(span) - 2, F.lit(0))
    return F.substring(F.concat(F.lit("<"), F.repeat(F.lit(FILLER), inner), F.lit(">")), F.lit(1), F.length(span))


def pii_spans(df: DataFrame, id_columns, column: str, entities=PII_ENTITIES) -> DataFrame:
    """One row per replaced span: ids, ``column_name``, ``entity``, ``span``,
    ``start`` and ``end`` (code points of the original text, end exclusive).

    Built as a few projections per pattern: each pattern reads the text left
    by the previous one once (the projections are not collapsed because
    every intermediate text is used twice), so the cost is linear in the
    number of patterns."""
    id_columns = list(id_columns)
    cur = spread(df.select(*id_columns, empty_to_null(column).alias("_t")), id_columns)
    parts: list[str] = []
    for i, p in enumerate(patterns_for(entities)):
        part = f"_p{i}"
        found = F.regexp_extract_all(F.col("_t"), F.lit(p.regex), 1)
        guard = may_match(F.col("_t"), p)
        if guard is not None:
            found = F.when(guard, found)
        cur = cur.select(*id_columns, *parts, found.alias("_f"), F.col("_t"))
        # split and mask only where the pattern was found: one scan for most rows
        hit = F.size(F.coalesce(F.col("_f"), F.array().cast("array<string>"))) > 0
        cur = cur.select(*id_columns, *parts, "_f", F.when(hit, F.split("_t", p.regex, -1)).alias("_g"), "_t")
        located = F.transform(
            F.arrays_zip(F.col("_f").alias("span"), F.slice(_starts(F.col("_g"), F.col("_f")), F.lit(1), F.size("_f"))
                         .alias("start")), _located(p.entity))
        pairs = F.arrays_zip(F.col("_g").alias("gap"), F.transform("_f", _mask).alias("mask"))
        masked = F.array_join(F.transform(pairs, lambda x: F.concat(x["gap"], F.coalesce(x["mask"], F.lit("")))), "")
        cur = cur.select(
            *id_columns, *parts,
            F.when(F.col("_g").isNotNull(), located).otherwise(F.array().cast(SPAN_ARRAY)).alias(part),
            F.when(F.col("_g").isNotNull(), masked).otherwise(F.col("_t")).alias("_t"),
        )
        parts.append(part)
    cur = cur.select(*id_columns, F.concat(*[F.col(c) for c in parts]).alias("_spans"))
    # explode_outer + filter: a plain explode makes the optimizer infer
    # ``size(_spans) > 0`` and push it below the projections, which would
    # inline the whole regex chain a second time
    return (
        cur.select(*id_columns, F.explode_outer("_spans").alias("s"))
        .where(F.col("s").isNotNull())
        .select(*id_columns, F.lit(column).alias("column_name"), "s.*")
    )


def redact_names(df: DataFrame, column: str, lexicon: DataFrame, case_sensitive: bool = False) -> DataFrame:
    """Replace the terms of ``lexicon`` (term, label) in ``column`` by
    ``<label>``: whole words, any number of words, the longest term first.
    Adjacent ``<PERSON>`` become one.  Placeholders already in the text are
    left alone.  Null texts stay null.

    The distinct texts are searched like in entity extraction (the lexicon
    may be of any size), and the hits are joined back by a hash of the text."""
    holders = {e: chr(ord(FILLER) + 1 + i) for i, e in enumerate(PII_ENTITIES)}
    text = F.col(column)
    for entity, mark in holders.items():
        text = F.replace(text, F.lit(f"<{entity}>"), F.lit(mark))
    marked = df.withColumn("_marked", text).withColumn("_name_key", text_key("_marked"))
    texts = marked.where("_marked IS NOT NULL").groupBy("_name_key").agg(F.first("_marked").alias("_text"))
    terms = normalised(lexicon)
    cands = entity_candidates(texts, terms, "_name_key")
    if case_sensitive:
        words = F.filter(F.split("term", TOKEN_SPLIT), lambda w: w != "")
        cased = lexicon.select(F.array_join(words, " ").alias("_cased"), F.col("label").alias("_label")).distinct()
        cands = cands.join(cased, (F.col("text") == F.col("_cased")) & (F.col("label") == F.col("_label")), "left_semi")
    hits = resolve_overlaps(cands, ["_name_key"]).groupBy(F.col("_name_key").alias("_hit_key")).agg(
        F.sort_array(F.collect_list(F.struct("pos", "n", "label"))).alias("_hits"))
    joined = marked.join(hits, F.col("_name_key") == F.col("_hit_key"), "left")
    # text = token 0, gap 0, token 1, gap 1, ...; the hits cut it into slices
    joined = joined.withColumn("_gaps", F.when(F.col("_hits").isNotNull(), F.regexp_extract_all("_marked", F.lit(TOKEN_SPLIT), 0)))
    pairs = F.transform(
        F.arrays_zip(F.split("_marked", TOKEN_SPLIT, -1).alias("t"), F.col("_gaps").alias("g")),
        lambda x: F.concat(x["t"], F.coalesce(x["g"], F.lit(""))))
    joined = joined.withColumn("_pairs", F.when(F.col("_hits").isNotNull(), pairs))
    zero = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("out"))

    def step(acc, h):
        before = F.array_join(F.slice(F.col("_pairs"), acc["at"] + 1, h["pos"] - acc["at"]), "")
        gap = F.coalesce(F.get(F.col("_gaps"), h["pos"] + h["n"] - 1), F.lit(""))
        return F.struct((h["pos"] + h["n"]).alias("at"),
                        F.concat(acc["out"], F.array(before, F.concat(F.lit("<"), h["label"], F.lit(">"), gap))).alias("out"))

    def finish(acc):
        rest = F.slice(F.col("_pairs"), acc["at"] + 1, F.size("_pairs"))
        return F.concat(F.array_join(acc["out"], ""), F.array_join(rest, ""))

    out = F.when(F.col("_hits").isNotNull(), F.aggregate("_hits", zero, step, finish)).otherwise(F.col("_marked"))
    for entity, mark in holders.items():
        out = F.replace(out, F.lit(mark), F.lit(f"<{entity}>"))
    out = F.regexp_replace(out, "<PERSON>(?: <PERSON>)+", "<PERSON>")
    return joined.select(*[out.alias(c) if c == column else df[c] for c in df.columns])


def redaction_audit(spans: DataFrame, id_column: str) -> DataFrame:
    """Spans and distinct rows per entity (partial aggregation before the
    shuffle; the distinct count is exact)."""
    return spans.groupBy("entity").agg(
        F.count(F.lit(1)).alias("n_spans"),
        F.countDistinct(id_column).alias("n_rows"),
    )
