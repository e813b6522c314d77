"""Row hash and salted id hash expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from deidlake.constants import ROW_HASH_SEPARATOR


def row_hash(columns, mode: str = "compat") -> Column:
    """Hash of a row.

    ``compat``: ``md5(concat_ws("|", c1, c2, ...))`` -- NULLs are skipped and
    the separator is not escaped, so ('a|b','c') and ('a','b|c') collide.
    ``safe``: md5 of the JSON of the whole struct with NULL fields kept,
    so distinct rows never share a hash input."""
    cols = list(columns)
    if not cols:
        raise ValueError("row_hash needs at least one column")
    if mode == "compat":
        return F.md5(F.concat_ws(ROW_HASH_SEPARATOR, *[F.col(c) for c in cols]))
    if mode == "safe":
        return F.md5(F.to_json(F.struct(*[F.col(c) for c in cols]), {"ignoreNullFields": "false"}))
    raise ValueError(f"unknown row hash mode {mode!r}")


def salted_sha256(column: str | Column, salt: str) -> Column:
    """``sha2(cast(concat(id, salt) as binary), 256)``; NULL id -> NULL."""
    c = F.col(column) if isinstance(column, str) else column
    return F.sha2(F.concat(c.cast("string"), F.lit(salt)).cast("binary"), 256)
