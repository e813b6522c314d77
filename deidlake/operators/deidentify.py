"""Role-driven de-identification (one ``select``).

* OTHER_IDENTIFIABLE -> column removed
* FREE_TEXT          -> redacted (``text_mode='redact'``) or removed (``'remove'``)
* CLIENT_ID          -> replaced by ``<col>_hashed`` = salted SHA-256, appended last
* DATE_TIME          -> truncated to the hour, type kept
* DATE               -> truncated to the month, type kept
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame

from deidlake.constants import CLIENT_ID_HASH_SUFFIX, ROW_HASH_COLUMN
from deidlake.functions.dates import coarsen
from deidlake.functions.hashing import salted_sha256
from deidlake.functions.text import redact_expr
from deidlake.operators.parallel import spread
from deidlake.operators.redact import redact_names
from deidlake.spec import ColumnRole, TableSpec

TextFn = Callable[[Column], Column]


def check_columns(df: DataFrame, spec: TableSpec) -> None:
    """Every classified column must exist: raise KeyError naming it."""
    present = set(df.columns)
    for role, cols in spec.roles.items():
        for c in cols:
            if c not in present:
                raise KeyError(
                    f"Unable to apply role {role.value} to column '{c}': it does not exist in {spec.name}."
                )


def _role_of(spec: TableSpec) -> dict[str, ColumnRole]:
    return {c: role for role, cols in spec.roles.items() for c in cols}


def deidentify(
    df: DataFrame,
    spec: TableSpec,
    salt: str,
    text_fn: TextFn | None = None,
    text_mode: str = "redact",
    max_chars: int | None = None,
    row_hash_mode: str = "rekey",
    names: DataFrame | None = None,
) -> DataFrame:
    """Apply the role of every classified column in a single projection.

    ``text_fn`` replaces the built-in regex/lexicon redaction (e.g. a pandas
    UDF wrapping a model); it receives the text column and returns a column.
    ``names`` (term, label) adds names to the built-in PERSON and LOCATION words.
    ``row_hash_mode``: the merge key of full-update tables is an unsalted MD5
    of the raw row; ``rekey`` (default) replaces it by a salted SHA-256 of
    itself under the same name (still unique, no longer open to dictionary
    attacks on low-entropy rows); ``compat`` keeps the MD5 as is.
    """
    if text_mode not in ("redact", "remove"):
        raise ValueError("text_mode must be 'redact' or 'remove'")
    if spec.skip_deidentification:
        return df
    check_columns(df, spec)
    roles = _role_of(spec)
    if text_mode == "redact" and spec.role_columns(ColumnRole.FREE_TEXT):
        # regex work over long texts: make sure every core gets a share
        df = spread(df, [c for c in spec.keys if c in df.columns] or df.columns[:1])
    kept: list[Column] = []
    hashed: list[Column] = []
    for name in df.columns:
        role = roles.get(name)
        col = df[name]
        if name == ROW_HASH_COLUMN and role is None:
            kept.append(_row_hash_key(col, salt, row_hash_mode))
        elif role is None:
            kept.append(col)
        elif role is ColumnRole.OTHER_IDENTIFIABLE:
            continue
        elif role is ColumnRole.FREE_TEXT:
            if text_mode == "remove":
                continue
            expr = text_fn(col) if text_fn is not None else redact_expr(col, max_chars=max_chars)
            kept.append(expr.alias(name))
        elif role is ColumnRole.CLIENT_ID:
            hashed.append(salted_sha256(col, salt).alias(name + CLIENT_ID_HASH_SUFFIX))
        elif role is ColumnRole.DATE_TIME:
            kept.append(coarsen(name, df.schema[name].dataType, "hour").alias(name))
        elif role is ColumnRole.DATE:
            kept.append(coarsen(name, df.schema[name].dataType, "month").alias(name))
    out = df.select(*kept, *hashed)
    if names is not None and text_mode == "redact" and text_fn is None:
        for name in spec.role_columns(ColumnRole.FREE_TEXT):
            out = redact_names(out, name, names)
    return out


def _row_hash_key(col: Column, salt: str, mode: str) -> Column:
    if mode == "compat":
        return col
    if mode != "rekey":
        raise ValueError("row_hash_mode must be 'rekey' or 'compat'")
    return salted_sha256(col, salt).alias(ROW_HASH_COLUMN)


def delete_layout(df: DataFrame, spec: TableSpec, salt: str, text_mode: str = "redact",
                  row_hash_mode: str = "rekey") -> DataFrame:
    """Give delete rows the de-identified column layout without the costly
    parts: identifiers dropped and ids hashed (so keys line up), dates and
    text left as they are."""
    if spec.skip_deidentification:
        return df
    check_columns(df, spec)
    roles = _role_of(spec)
    kept, hashed = [], []
    for name in df.columns:
        role = roles.get(name)
        if role is ColumnRole.OTHER_IDENTIFIABLE or (role is ColumnRole.FREE_TEXT and text_mode == "remove"):
            continue
        if role is ColumnRole.CLIENT_ID:
            hashed.append(salted_sha256(df[name], salt).alias(name + CLIENT_ID_HASH_SUFFIX))
        elif name == ROW_HASH_COLUMN and role is None:
            kept.append(_row_hash_key(df[name], salt, row_hash_mode))
        else:
            kept.append(df[name])
    return df.select(*kept, *hashed)


def deidentified_keys(spec: TableSpec, keys=None) -> tuple[str, ...]:
    """Names of the merge keys after de-identification.

    A hashed client id key becomes ``<key>_hashed`` on both sides; a
    coarsened date cannot identify a row and is refused as a key."""
    keys = tuple(keys if keys is not None else spec.merge_keys)
    roles = _role_of(spec)
    out = []
    for k in keys:
        role = roles.get(k)
        if role is ColumnRole.CLIENT_ID:
            out.append(k + CLIENT_ID_HASH_SUFFIX)
        elif role in (ColumnRole.DATE, ColumnRole.DATE_TIME, ColumnRole.OTHER_IDENTIFIABLE, ColumnRole.FREE_TEXT):
            raise ValueError(f"key column {k} of {spec.name} has role {role.value} and cannot identify a row")
        else:
            out.append(k)
    return tuple(out)
