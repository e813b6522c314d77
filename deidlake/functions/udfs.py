"""Pluggable model-based detectors as Arrow-batched pandas UDFs.

The built-in redaction and extraction run as JVM expressions.  When a
statistical model must be used instead, wrap its per-text function here:
``factory`` builds the model and runs once per Python worker (cached),
batches of texts arrive as pandas Series (Iterator UDF), never row by row.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from deidlake.constants import FEATURE_EXTRACTION_LABELS

_MODELS: dict[str, object] = {}


def _model(key: str, factory: Callable[[], object]):
    if key not in _MODELS:
        _MODELS[key] = factory()
    return _MODELS[key]


def text_udf(factory: Callable[[], Callable[[str], str | None]], key: str | None = None) -> Callable[[Column], Column]:
    """``factory()`` -> ``fn(text) -> redacted text``; falsy text -> NULL."""
    cache_key = key or uuid.uuid4().hex  # each call has a model of its own unless a key says otherwise

    @F.pandas_udf("string")
    def _redact(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        fn = _model(cache_key, factory)
        for s in batches:
            yield s.map(lambda t: fn(t) if isinstance(t, str) and t else None)

    return lambda col: _redact(col)


def entities_udf(factory: Callable[[], Callable[[str], list[tuple[str, str]]]],
                 labels=FEATURE_EXTRACTION_LABELS, key: str | None = None) -> Callable[[Column], Column]:
    """``factory()`` -> ``fn(text) -> [(label, surface text), ...]`` in
    document order.  Output: one list per label in ``labels`` order; labels
    outside ``labels`` are ignored; falsy text -> one empty list per label."""
    labels = tuple(labels)
    cache_key = key or uuid.uuid4().hex  # each call has a model of its own unless a key says otherwise

    def per_text(fn, t):
        out = {lab: [] for lab in labels}
        if isinstance(t, str) and t:
            for lab, txt in fn(t):
                if lab in out:
                    out[lab].append(txt)
        return [out[lab] for lab in labels]

    @F.pandas_udf("array<array<string>>")
    def _extract(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        fn = _model(cache_key, factory)
        for s in batches:
            yield s.map(lambda t: per_text(fn, t))

    return lambda col: _extract(col)
