"""Text column expressions: truncation, empty-text rule, regex redaction."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from deidlake.constants import PII_ENTITIES
from deidlake.functions.patterns import Pattern, patterns_for


def truncate(column: str | Column, max_chars: int) -> Column:
    c = F.col(column) if isinstance(column, str) else column
    return F.substring(c, 1, max_chars)


def empty_to_null(column: str | Column) -> Column:
    """Falsy text (NULL or '') becomes NULL."""
    c = F.col(column) if isinstance(column, str) else column
    return F.nullif(c, F.lit(""))


def may_match(c: Column, p: Pattern) -> Column | None:
    """Byte-level pre-check (no regex, no string conversion); None if the
    pattern has no required substring."""
    if not p.needles:
        return None
    cond = None
    for n in p.needles:
        e = c.contains(n)
        cond = e if cond is None else cond | e
    return cond


def replace_pattern(c: Column, p: Pattern) -> Column:
    replaced = F.regexp_replace(c, p.regex, p.spark_replacement)
    guard = may_match(c, p)
    return replaced if guard is None else F.when(guard, replaced).otherwise(c)


def redact_expr(column: str | Column, entities=PII_ENTITIES, max_chars: int | None = None) -> Column:
    """Replace every detected span with ``<ENTITY>``; the whole text is
    processed unless ``max_chars`` asks for the original truncation.
    Runs inside whole-stage codegen as a chain of ``regexp_replace``."""
    c = empty_to_null(column)
    if max_chars is not None:
        c = truncate(c, max_chars)
    for p in patterns_for(entities):
        c = replace_pattern(c, p)
    return c
