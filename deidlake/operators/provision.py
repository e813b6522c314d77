"""Dataset provisioning: a request names tables, the columns to hand out
and an optional SQL predicate; each table is filtered, projected and
written as Parquet under ``<dest>/<table>/<yyyy-MM-dd-HH-mm-ss>``."""

from __future__ import annotations

import base64
import binascii
import datetime
import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from deidlake.constants import PROVISION_FOLDER_FORMAT

REQUEST_SCHEMA = "map<string, struct<columns: array<string>, where_statement: string>>"


@dataclass(frozen=True)
class TableRequest:
    columns: tuple[str, ...]
    where_statement: str | None = None


def decode_request(query_base64: str | None, workspace_uuid: str | None) -> dict[str, TableRequest]:
    """Validate and decode a request; ValueError names the failed rule
    (presence, UUID, base64, JSON, shape)."""
    if not query_base64:
        raise ValueError("query_base64 is required")
    if not workspace_uuid:
        raise ValueError("workspace_uuid is required")
    try:
        uuid.UUID(workspace_uuid)
    except ValueError as e:
        raise ValueError(f"workspace_uuid {workspace_uuid!r} must be a UUID") from e
    try:
        text = base64.b64decode(query_base64, validate=True).decode("ascii")
    except (binascii.Error, UnicodeDecodeError, ValueError) as e:
        raise ValueError("query_base64 must be base64 of ASCII text") from e
    try:
        raw = json.loads(text)
    except json.JSONDecodeError as e:
        raise ValueError("the decoded request must be JSON") from e
    if not isinstance(raw, dict):
        raise ValueError("request must map table names to definitions")
    out = {}
    for table, spec in raw.items():
        if not isinstance(spec, dict) or not isinstance(spec.get("columns"), list) or not spec["columns"]:
            raise ValueError(f"request for {table} needs a non-empty 'columns' list")
        out[table] = TableRequest(tuple(spec["columns"]), spec.get("where_statement") or None)
    return out


def encode_request(request: dict[str, TableRequest]) -> str:
    raw = {t: {"columns": list(r.columns), "where_statement": r.where_statement} for t, r in request.items()}
    return base64.b64encode(json.dumps(raw).encode("ascii")).decode("ascii")


def request_entries(encoded: Column) -> Column:
    """Column expression: base64 request -> ``map<table, struct<columns,
    where_statement>>`` (NULL for undecodable input), for request tables."""
    return F.from_json(F.unbase64(encoded).cast("string"), REQUEST_SCHEMA)


def provision(df: DataFrame, columns, where_statement: str | None = None) -> DataFrame:
    """Filter (if a predicate is given) then project.  Both reach the
    Parquet scan: ``PushedFilters`` and a pruned ``ReadSchema``."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise KeyError(f"requested columns {missing} do not exist")
    out = df.where(where_statement) if where_statement else df
    return out.select(*columns)


def provision_all(request: dict[str, TableRequest], read: Callable[[str], DataFrame]) -> dict[str, DataFrame]:
    return {t: provision(read(t), r.columns, r.where_statement) for t, r in request.items()}


def provision_timestamp(now: datetime.datetime | None = None) -> str:
    return (now or datetime.datetime.now(datetime.timezone.utc)).strftime(PROVISION_FOLDER_FORMAT)


def write_provisioned(frames: dict[str, DataFrame], dest_root: str, stamp: str | None = None) -> dict[str, str]:
    stamp = stamp or provision_timestamp()
    paths = {}
    for table, df in frames.items():
        path = f"{dest_root.rstrip('/')}/{table}/{stamp}"
        df.write.mode("overwrite").parquet(path)
        paths[table] = path
    return paths
