"""Jobs: ingest -> de-identify -> extract entities -> clean, over the zone
layout of :mod:`deidlake.sources.zones`.

Each job is a loop over the (small) list of classified tables; every table
is one Spark plan.  Watermarks need no extra store: a downstream table's
latest committed batch id IS the last upstream batch it consumed, because
it commits under the upstream's batch id.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from deidlake.constants import CHANGE_TYPE_COLUMN, DELETE, FEATURE_EXTRACTION_SUFFIX, INSERT
from deidlake.operators import changes as ch
from deidlake.operators.deidentify import TextFn, deidentified_keys, deidentify, delete_layout
from deidlake.operators.entities import extract_entities, nested_entities
from deidlake.operators.keys import key_columns, key_names
from deidlake.operators.merge import merge_changes
from deidlake.operators.monitor import append_monitoring, monitoring_rows
from deidlake.operators.validate import validate
from deidlake.sources.zones import SIDE, ZoneTable, register_table
from deidlake.spec import ColumnRole, TableSpec, spec_df

SourceReader = Callable[[TableSpec], DataFrame]


@dataclass
class RunConfig:
    root: str
    salt: str
    text_mode: str = "redact"          # or "remove"
    text_fn: TextFn | None = None       # pluggable detector (pandas UDF)
    max_chars: int | None = None        # optional truncation of free text
    extract_entities: bool = False
    entity_fn: TextFn | None = None     # pluggable extractor -> array<array<string>> (pandas UDF)
    compat_monitoring_names: bool = False
    row_hash_mode: str = "rekey"        # or "compat": keep the raw-row MD5 in silver
    lexicon: DataFrame | None = field(default=None, repr=False)  # of entity extraction
    names: DataFrame | None = field(default=None, repr=False)    # (term, label) for redaction
    text_partitions: int | None = None  # partitions for text work; None: those of the net changes

    def table(self, zone: str, spec: TableSpec) -> ZoneTable:
        return ZoneTable(self.root, zone, spec.name)


# ------------------------------------------------------------------ ingestion

def ingest_table(spark: SparkSession, cfg: RunConfig, spec: TableSpec, source: DataFrame, batch: int) -> int:
    """Merge ``source`` into bronze as batch ``batch``; returns the number of
    source rows (observed while writing -- the source is read once)."""
    bronze = cfg.table("bronze", spec)
    target = bronze.read_snapshot(spark)
    src = source.select(*spec.imported_columns)
    obs = Observation(f"rows_{spec.short_name}_{batch}")
    changes = merge_changes(target, src, spec.keys, spec.update_mode, observation=obs)
    bronze.write_batch(spark, changes, batch, spec.merge_keys)
    return int(obs.get.get("row_count", 0) or 0)


def run_ingestion(spark: SparkSession, cfg: RunConfig, specs, read_source: SourceReader, batch: int,
                  live_catalog: DataFrame) -> DataFrame:
    """Validate the live catalog (table_name, column_name), merge every imported table into
    bronze as batch ``batch`` and append (table, time, row count) rows to the
    monitoring zone.  Counts are observed inside the merge while writing
    (the source is read once; exact under task retries)."""
    validate(live_catalog, spec_df(spark, specs))
    counts = []
    for spec in specs:
        if not spec.is_imported:
            continue
        counts.append((spec.name, ingest_table(spark, cfg, spec, read_source(spec), batch)))
    rows = monitoring_rows(spark, counts, compat_names=cfg.compat_monitoring_names)
    append_monitoring(rows, f"{cfg.root.rstrip('/')}/monitoring/UpsertLogs")
    return rows


# ------------------------------------------------------------------ propagation

def _propagate(spark, src: ZoneTable, dst: ZoneTable, src_keys, dst_keys,
               on_inserts: Callable[[DataFrame], DataFrame],
               on_deletes: Callable[[DataFrame], DataFrame]) -> int | None:
    """Consume src batches after dst's watermark; commit dst under the
    newest consumed src batch id.  Returns that id (None if nothing new)."""
    mark = dst.latest(spark)
    new = src.unconsumed(spark, mark)
    if new is None:
        return None
    apply_feed(spark, new.feed, dst, src_keys, dst_keys, on_inserts, on_deletes, new.newest, reset=new.reset and mark is not None)
    return new.newest


def apply_feed(spark, feed: DataFrame, dst: ZoneTable, src_keys, dst_keys,
               on_inserts: Callable[[DataFrame], DataFrame],
               on_deletes: Callable[[DataFrame], DataFrame], commit_id: int, reset: bool = False) -> None:
    """Net the change rows of ``feed`` per key, transform them, and commit
    them as batch ``commit_id`` of ``dst`` -- O(changes): the target is not
    read, because readers apply changes as a keyed replace.  Delete rows
    carry only the (de-identified) key columns, never raw values.  With
    ``reset`` the feed is the whole snapshot, because changes have expired: the
    keys that the target has besides are deleted, which reads its key columns.
    Idempotent: a re-delivered batch is skipped."""
    if commit_id in dst.committed(spark):
        return  # replay after a crash between this commit and the consumer's marker
    net = ch.net_changes(feed, list(src_keys))
    data = ch.data_columns(net)
    inserts = on_inserts(net.where(F.col(CHANGE_TYPE_COLUMN) == INSERT).select(*data))
    delete_keys = on_deletes(net.where(F.col(CHANGE_TYPE_COLUMN) == DELETE).select(*data)).select(*dst_keys)
    if reset:
        held = dst.read_snapshot(spark)
        kept = inserts.select(*key_columns(inserts, dst_keys))
        gone = held.select(*dst_keys, *key_columns(held, dst_keys)).join(kept, key_names(dst_keys), "left_anti")
        delete_keys = delete_keys.unionByName(gone.select(*dst_keys))
    deletes = delete_keys.select(*[
        F.col(c) if c in dst_keys else F.lit(None).cast(inserts.schema[c].dataType).alias(c) for c in inserts.columns
    ])
    changes = inserts.withColumn(SIDE, F.lit(INSERT)).unionByName(deletes.withColumn(SIDE, F.lit(DELETE)))
    dst.write_batch(spark, changes, commit_id, list(dst_keys))


def _spread_text(cfg: RunConfig, df: DataFrame, keys) -> DataFrame:
    """The net changes hold one row per key, so hashing the key spreads them evenly."""
    return df if cfg.text_partitions is None else df.repartition(cfg.text_partitions, *keys)


def run_deidentification(spark: SparkSession, cfg: RunConfig, specs) -> dict[str, int | None]:
    """bronze -> silver for every imported table."""
    done = {}
    for spec in specs:
        if spec.update_mode.value == "not-import":
            continue
        src, dst = cfg.table("bronze", spec), cfg.table("silver", spec)
        done[spec.name] = _propagate(
            spark, src, dst, spec.merge_keys, deidentified_keys(spec),
            lambda df, s=spec: deidentify(_spread_text(cfg, df, s.merge_keys), s, cfg.salt, cfg.text_fn,
                                          cfg.text_mode, cfg.max_chars, cfg.row_hash_mode, cfg.names),
            lambda df, s=spec: delete_layout(df, s, cfg.salt, cfg.text_mode, cfg.row_hash_mode),
        )
    return done


def _gold_inserts(cfg: RunConfig, spec: TableSpec, keys):
    def run(df: DataFrame) -> DataFrame:
        if not cfg.extract_entities or spec.skip_entity_extraction:
            return df
        df = _spread_text(cfg, df, keys)
        for col in spec.role_columns(ColumnRole.FREE_TEXT):
            if col not in df.columns:  # text removed upstream: nothing to extract
                continue
            if cfg.entity_fn is not None:
                df = df.withColumn(col + FEATURE_EXTRACTION_SUFFIX, cfg.entity_fn(F.col(col)))
                continue
            long = extract_entities(df, list(keys), col, cfg.lexicon, by_text=True)
            df = nested_entities(df, list(keys), col, long)
        return df
    return run


def run_entity_extraction(spark: SparkSession, cfg: RunConfig, specs,
                          database: str | None = None) -> dict[str, int | None]:
    """silver -> gold; with extraction on, every FREE_TEXT column gets
    ``<col>_feature_extraction``.  With ``database``, each gold table is
    registered there as ``<schema>_<table>`` (an external Parquet table)."""
    done = {}
    for spec in specs:
        if spec.update_mode.value == "not-import":
            continue
        keys = deidentified_keys(spec)
        src, dst = cfg.table("silver", spec), cfg.table("gold", spec)
        done[spec.name] = _propagate(spark, src, dst, keys, keys, _gold_inserts(cfg, spec, keys), lambda df: df)
        if database is not None and dst.latest(spark) is not None:
            register_table(spark, dst, f"{database}.{spec.name.replace('.', '_')}")
    return done


def run_cleaning(spark: SparkSession, cfg: RunConfig, specs) -> dict[str, list[int]]:
    """Compact every zone table (base snapshot at its latest batch) and
    expire history nobody needs any more: bronze batches consumed by silver,
    silver batches consumed by gold, gold batches before its base -- and, in
    each zone, only what all registered consumers of the table have consumed."""
    removed = {}
    for spec in specs:
        if spec.update_mode.value == "not-import":
            continue
        b, s, g = (cfg.table(z, spec) for z in ("bronze", "silver", "gold"))
        s_mark, g_mark = s.latest(spark), g.latest(spark)
        for zt, mark in ((b, s_mark), (s, g_mark), (g, g.latest(spark))):
            committed = zt.committed(spark)
            if not committed:
                continue
            if len(committed) > 1:  # a first load alone is its own snapshot
                zt.compact(spark)
            if mark is not None:
                removed[f"{zt.zone}/{spec.name}"] = zt.expire(spark, mark + 1)
    return removed


# ------------------------------------------------------------------ provisioning, snapshots

def run_provisioning(spark: SparkSession, cfg: RunConfig, query_base64: str, workspace_uuid: str,
                     dest_root: str, stamp: str | None = None) -> dict[str, str]:
    """Decode and validate a request, read each requested gold table,
    filter + project it, write it under ``<dest_root>/<table>/<stamp>``.
    Table names are ``schema.table`` as in the zone layout."""
    from deidlake.operators.provision import decode_request, provision_all, write_provisioned

    request = decode_request(query_base64, workspace_uuid)

    def read(table: str) -> DataFrame:
        df = ZoneTable(cfg.root, "gold", table).read_snapshot(spark)
        if df is None:
            raise KeyError(f"gold table {table} does not exist")
        return df

    return write_provisioned(provision_all(request, read), dest_root, stamp)


def run_snapshot_distribution(spark: SparkSession, tables: dict[tuple[str, str], DataFrame], staging_root: str,
                              destinations, stamp: str | None = None, single_file: bool = False) -> dict:
    """Snapshot every (schema, table) to staging, then fan each one out to
    ``latest/`` and ``archive/<stamp>/`` of every destination."""
    from deidlake.operators.snapshot import fan_out, snapshot_database, snapshot_stamp

    stamp = stamp or snapshot_stamp()
    staged = snapshot_database(tables, staging_root, stamp, single_file=single_file)
    return fan_out(spark, staged, destinations, stamp, single_file=single_file)
