"""Quality rules as a short-circuit cascade, with Spark SQL expressions only.

A document is kept if no rule rejects it.  The rules' order doesn't change
the verdict, only the work: on a bounded sample the cost of each rule (time
of evaluating it alone) and its selectivity (share of rows it rejects) are
estimated, and the rules are put in order of rejections per cost.  The
verdict is one CASE expression, so a row that an early rule rejects never
reaches the later ones.

Defined results: a null or empty text has no words and fails the base rule;
an empty table gives an empty result (the order is then that of the list);
repeated rows get the same verdict; extra columns are ignored by ``judge``
and kept by ``keep`` unless they are called ``kept``."""

from __future__ import annotations

import time
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deidlake.llm.common import WORD, words

#: Symbols that count (fixed by the data contract).
SYMBOLS = "#*$%&|<>"
#: Words of a window for repetition inside one document (fixed).
REPEAT_WINDOW = 3
#: Rows of the sample that estimates cost and selectivity.
SAMPLE_ROWS = 300
#: Below this, times of a query on the sample tell nothing.
LEAST_SECONDS = 1e-3


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def worded_lines(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), "\n"), lambda x: x.rlike(WORD))


def n_repeat_words(ws: Column) -> Column:
    """Words of the array ``ws`` in windows of three words that occur more
    than once.  The windows' hashes are sorted together with their positions,
    so equal ones are neighbours; each such window adds the words that the
    one before it didn't cover."""
    k = REPEAT_WINDOW

    def pairs(w: Column) -> Column:
        starts = F.sequence(F.lit(0), F.size(w) - k)
        return F.sort_array(F.transform(starts, lambda i: F.struct(
            F.xxhash64(*[F.get(w, i + j) for j in range(k)]).alias("h"), i.alias("i"))))

    def repeated(p: Column) -> Column:
        same = lambda x, j: F.coalesce(F.get(p, j)["h"] == x["h"], F.lit(False))
        return F.sort_array(F.transform(F.filter(p, lambda x, j: same(x, j - 1) | same(x, j + 1)), lambda x: x["i"]))

    def covered(starts: Column) -> Column:
        zero = F.struct(F.lit(0).alias("n"), F.lit(-k).alias("last"))
        return F.aggregate(
            starts, zero,
            lambda a, i: F.struct((a["n"] + F.least(F.lit(k), i - a["last"])).alias("n"), i.alias("last")),
            lambda a: a["n"])

    return F.when(F.size(ws) < k, F.lit(0)).otherwise(
        _let(ws, lambda w: _let(pairs(w), lambda p: covered(repeated(p))))).cast("long")


class Measures:
    """Expressions over a document; ``known`` maps names to columns that have
    been computed already."""

    def __init__(self, text: Column, known: dict[str, Column] | None = None):
        self.text, self.known = text, known or {}

    def __getitem__(self, name: str) -> Column:
        return self.known[name] if name in self.known else getattr(self, "_" + name)()

    def _words(self) -> Column:
        return words(self.text)

    def _n_words(self) -> Column:
        return F.size(self["words"]).cast("long")

    def _word_chars(self) -> Column:
        return F.char_length(F.array_join(self["words"], "")).cast("long")

    def _n_symbols(self) -> Column:
        whole = F.coalesce(self.text, F.lit(""))
        return (F.char_length(whole) - F.char_length(F.translate(whole, SYMBOLS, ""))).cast("long")

    def _n_lines(self) -> Column:
        return F.size(worded_lines(self.text)).cast("long")

    def _n_dup_lines(self) -> Column:
        return _let(worded_lines(self.text), lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long")

    def _n_repeat_words(self) -> Column:
        return n_repeat_words(self["words"])

    def _longest_word(self) -> Column:
        return F.coalesce(F.array_max(F.transform(self["words"], F.char_length)), F.lit(0)).cast("long")


@dataclass(frozen=True)
class Rule:
    """``rejects`` maps the measures of a document to a boolean column."""

    name: str
    rejects: Callable[[Measures], Column]


#: The two base rules of the data contract, then the method's own.  Their
#: bounds hold for any language that puts spaces between words.
BASE_RULES = (
    Rule("few_words", lambda m: m["n_words"] < 50),
    Rule("repeat_words", lambda m: 100 * m["n_repeat_words"] > 50 * m["n_words"]),
)
OWN_RULES = (
    Rule("symbols", lambda m: 10 * m["n_symbols"] > m["n_words"]),
    Rule("word_length", lambda m: (m["word_chars"] < 2 * m["n_words"]) | (m["word_chars"] > 20 * m["n_words"])),
    Rule("dup_lines", lambda m: 2 * m["n_dup_lines"] > m["n_lines"]),
    Rule("longest_word", lambda m: m["longest_word"] > 500),
)


@dataclass(frozen=True)
class Estimate:
    rule: Rule
    seconds: float
    rejected: float

    @property
    def gain(self) -> float:
        return self.rejected / max(self.seconds, 1e-6)


def estimate(docs: DataFrame, rules: tuple[Rule, ...], text_col: str = "text",
             sample_rows: int = SAMPLE_ROWS) -> list[Estimate]:
    """Cost and selectivity of each rule on the same sample, the first rows
    found (only as many partitions are read as are needed for them).  Each
    query runs twice, the second time with its code compiled, and what a
    query without a rule takes is not the rule's cost."""
    taken = docs.select(F.col(f"`{text_col}`").cast("string").alias("text")).take(sample_rows)
    if not taken:
        return [Estimate(r, 1.0, 0.0) for r in rules]
    sample = docs.sparkSession.createDataFrame(taken, "text string")

    def timed(rejects: Column) -> tuple[float, float]:
        query = sample.agg(F.avg(rejects.cast("double")).alias("share"))
        query.first()
        began = time.perf_counter()
        share = query.first()["share"]
        return time.perf_counter() - began, share or 0.0

    without, _ = timed(F.length("text") < 0)
    found = [(rule, *timed(rule.rejects(Measures(F.col("text"))))) for rule in rules]
    return [Estimate(rule, max(seconds - without, LEAST_SECONDS), share) for rule, seconds, share in found]


def in_order(estimates: list[Estimate]) -> tuple[Rule, ...]:
    """The rules by rejections per cost, the most first; ties as given."""
    return tuple(e.rule for e in sorted(estimates, key=lambda e: -e.gain))


def verdict(rules: tuple[Rule, ...], measures: Measures) -> Column:
    """True if no rule rejects; evaluated rule by rule."""
    kept = F.lit(True)
    for rule in reversed(rules):
        kept = F.when(rule.rejects(measures), F.lit(False)).otherwise(kept)
    return kept


def keep(docs: DataFrame, rules: tuple[Rule, ...] = BASE_RULES + OWN_RULES, text_col: str = "text") -> DataFrame:
    """Add ``kept``."""
    rules = in_order(estimate(docs, rules, text_col))
    return docs.withColumn("kept", verdict(rules, Measures(F.col(f"`{text_col}`").cast("string"))))


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The base measures of each document, whether the base rules reject it,
    and the verdict.  All base measures are results here, so the cascade
    takes them as they are and computes only the others on the way."""
    own = in_order(estimate(docs, OWN_RULES, text_col))
    text = F.col("text")
    base = docs.select(F.col(f"`{id_col}`").alias("doc_id"), F.col(f"`{text_col}`").cast("string").alias("text"))
    base = base.withColumn("words", words(text))
    known = {"words": F.col("words")}
    for name in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"):
        known[name] = Measures(text, {"words": F.col("words")})[name]
    names = [n for n in known if n != "words"]
    base = base.select("doc_id", "text", "words", *[known[n].alias(n) for n in names])
    measures = Measures(text, {n: F.col(n) for n in known})
    failed = BASE_RULES[0].rejects(measures) | BASE_RULES[1].rejects(measures)
    base = base.withColumn("base_failed", failed)
    kept = F.when(F.col("base_failed"), F.lit(False)).otherwise(verdict(own, measures))
    return base.select("doc_id", *names, "base_failed", kept.alias("kept"))


JUDGE_SQL = r"""
WITH docs AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
grams AS (SELECT rid, i, ws[i] || ' ' || ws[i + 1] || ' ' || ws[i + 2] AS g
          FROM docs, unnest(generate_series(1, len(ws) - 2)) AS t(i)),
repeats AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, g) AS c FROM grams) WHERE c > 1),
cover AS (SELECT rid, count(DISTINCT i + k) AS n FROM repeats, unnest([0, 1, 2]) AS t(k) GROUP BY rid),
base AS (
  SELECT docs.rid, doc_id, len(ws)::BIGINT AS n_words, length(array_to_string(ws, ''))::BIGINT AS word_chars,
         length(regexp_replace(text, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
         coalesce(n, 0)::BIGINT AS n_repeat_words, len(lines) AS n_lines,
         coalesce(list_max(list_transform(ws, lambda x: length(x))), 0) AS longest
  FROM docs LEFT JOIN cover USING (rid)),
judged AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM base)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed OR 10 * n_symbols > n_words OR word_chars < 2 * n_words OR word_chars > 20 * n_words
            OR 2 * n_dup_lines > n_lines OR longest > 500) AS kept
FROM judged
"""
