"""Registered queries: one Spark plan per operator of the inventory, each
paired (where SQL can express it) with an independent DuckDB oracle.

Every query reads whole given tables (or data Spark derives from them).
Column names are aliased identically on both sides."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from deidlake.constants import (
    BATCH_ID_COLUMN,
    CHANGE_TYPE_COLUMN,
    CLIENT_ID_HASH_SUFFIX,
    MAX_TEXT_CHARS,
    ROW_HASH_COLUMN,
    TEST_HASH_SALT,
)
from deidlake.functions.text import empty_to_null, truncate
from deidlake.operators import changes as ch
from deidlake.operators.deidentify import deidentify, delete_layout
from deidlake.operators.merge import changes_of, dedupe_on_key, merge_tagged, snapshot_of
from deidlake.plans import derived as d
from deidlake.spec import ColumnRole, TableSpec, UpdateMode

QueryFn = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, QueryFn] = {}
ORACLES: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    def deco(fn: QueryFn) -> QueryFn:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return deco


SALT_SQL = TEST_HASH_SALT.replace("'", "''")
ORDERS = d.ORDERS_COLUMNS
EVENTS = ("event_id", "ts", "user_id", "event_type", "value", "props")
LINEITEM = (
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
)
CUSTOMER = ("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment")


def _sha(col: str) -> str:
    return f"sha256(CAST({col} AS VARCHAR) || '{SALT_SQL}')"


def _md5(cols) -> str:
    return "md5(concat_ws('|', " + ", ".join(cols) + "))"


def _cols(cols, prefix: str = "") -> str:
    return ", ".join(prefix + c for c in cols)


# ---------------------------------------------------------------- step 1: roles

@register(
    "hash_client_id",
    f"SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority, "
    f"{_sha('o_custkey')} AS o_custkey{CLIENT_ID_HASH_SUFFIX} FROM orders",
)
def q_hash_client_id(spark, sf_dir):
    spec = TableSpec("dbo.orders", ORDERS, UpdateMode.DROP_AND_RECREATE,
                     {ColumnRole.CLIENT_ID: ("o_custkey",)}, keys=("o_orderkey",))
    return deidentify(d.table(spark, sf_dir, "orders"), spec, TEST_HASH_SALT)


@register(
    "round_hour",
    "SELECT event_id, date_trunc('hour', ts) AS ts, user_id, event_type, value, props FROM events",
)
def q_round_hour(spark, sf_dir):
    spec = TableSpec("dbo.events", EVENTS, UpdateMode.FULL_UPDATE, {ColumnRole.DATE_TIME: ("ts",)})
    return deidentify(d.table(spark, sf_dir, "events"), spec, TEST_HASH_SALT)


@register(
    "round_month",
    "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, "
    "CAST(date_trunc('month', o_orderdate) AS TIMESTAMP) AS o_orderdate, o_orderpriority FROM orders",
)
def q_round_month(spark, sf_dir):
    spec = TableSpec("dbo.orders", ORDERS, UpdateMode.FULL_UPDATE, {ColumnRole.DATE: ("o_orderdate",)})
    return deidentify(d.table(spark, sf_dir, "orders"), spec, TEST_HASH_SALT)


@register("drop_identifiers", "SELECT c_custkey, c_nationkey, c_acctbal, c_mktsegment FROM customer")
def q_drop_identifiers(spark, sf_dir):
    spec = TableSpec("dbo.customer", CUSTOMER, UpdateMode.FULL_UPDATE,
                     {ColumnRole.OTHER_IDENTIFIABLE: ("c_name",)})
    return deidentify(d.table(spark, sf_dir, "customer"), spec, TEST_HASH_SALT)


DEIDENTIFY_ORDERS_SQL = (
    "SELECT o_orderkey, o_orderstatus, o_totalprice, "
    "CAST(date_trunc('month', o_orderdate) AS TIMESTAMP) AS o_orderdate, "
    f"{_sha('o_custkey')} AS o_custkey{CLIENT_ID_HASH_SUFFIX} FROM orders"
)


@register("deidentify_orders", DEIDENTIFY_ORDERS_SQL)
def q_deidentify_orders(spark, sf_dir):
    return deidentify(d.table(spark, sf_dir, "orders"), d.ORDERS_SPEC, TEST_HASH_SALT)


@register(
    "truncate_text",
    f"SELECT doc_id, substring(text, 1, {MAX_TEXT_CHARS}) AS text, "
    f"length(text) > {MAX_TEXT_CHARS} AS was_truncated FROM documents",
)
def q_truncate_text(spark, sf_dir):
    docs = d.table(spark, sf_dir, "documents")
    return docs.select(
        "doc_id",
        truncate("text", MAX_TEXT_CHARS).alias("text"),
        (F.length("text") > MAX_TEXT_CHARS).alias("was_truncated"),
    )


@register(
    "empty_text_rules",
    "SELECT conv_id, turn, NULLIF(text, '') AS text, (text IS NULL OR text = '') AS is_empty FROM conversations",
)
def q_empty_text_rules(spark, sf_dir):
    conv = d.table(spark, sf_dir, "conversations")
    return conv.select(
        "conv_id", "turn", empty_to_null("text").alias("text"),
        empty_to_null("text").isNull().alias("is_empty"),
    )


@register("skip_passthrough", "SELECT * FROM lineitem")
def q_skip_passthrough(spark, sf_dir):
    spec = TableSpec("dbo.lineitem", LINEITEM, UpdateMode.FULL_UPDATE, {})
    return deidentify(d.table(spark, sf_dir, "lineitem"), spec, TEST_HASH_SALT)


# ---------------------------------------------------------------- step 2: merge

@register("row_hash", f"SELECT *, {_md5(ORDERS)} AS {ROW_HASH_COLUMN} FROM orders")
def q_row_hash(spark, sf_dir):
    from deidlake.operators.merge import with_row_hash

    return with_row_hash(d.table(spark, sf_dir, "orders"))


_LI_REST = [c for c in LINEITEM if c not in ("l_orderkey", "l_linenumber")]


@register(
    "dedupe_on_key",
    "SELECT " + _cols(LINEITEM) + " FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber "
    "ORDER BY " + ", ".join(f"{c} ASC NULLS FIRST" for c in _LI_REST) + ") AS rn FROM lineitem) WHERE rn = 1",
)
def q_dedupe_on_key(spark, sf_dir):
    return dedupe_on_key(d.table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


@register("merge_first_load", "SELECT * FROM orders")
def q_merge_first_load(spark, sf_dir):
    return snapshot_of(merge_tagged(None, d.table(spark, sf_dir, "orders"), ["o_orderkey"]))


_APPEND_REMOVE_SNAPSHOT_SQL = d.with_ctes(
    "SELECT * FROM old WHERE o_orderkey IN (SELECT o_orderkey FROM new) "
    "UNION ALL SELECT * FROM new WHERE o_orderkey NOT IN (SELECT o_orderkey FROM old)",
    old=d.ORDERS_OLD_SQL, new=d.ORDERS_NEW_SQL,
)


@register("merge_append_remove", _APPEND_REMOVE_SNAPSHOT_SQL)
def q_merge_append_remove(spark, sf_dir):
    t = merge_tagged(d.orders_old(spark, sf_dir), d.orders_new(spark, sf_dir), ["o_orderkey"],
                     UpdateMode.APPEND_AND_REMOVE)
    return snapshot_of(t)


@register(
    "merge_append_remove_changes",
    d.with_ctes(
        f"SELECT *, 'insert' AS {CHANGE_TYPE_COLUMN} FROM new WHERE o_orderkey NOT IN (SELECT o_orderkey FROM old) "
        "UNION ALL SELECT *, 'delete' FROM old WHERE o_orderkey NOT IN (SELECT o_orderkey FROM new)",
        old=d.ORDERS_OLD_SQL, new=d.ORDERS_NEW_SQL,
    ),
)
def q_merge_append_remove_changes(spark, sf_dir):
    t = merge_tagged(d.orders_old(spark, sf_dir), d.orders_new(spark, sf_dir), ["o_orderkey"],
                     UpdateMode.APPEND_AND_REMOVE)
    return changes_of(t)


def _full_update_target(spark, sf_dir):
    # the bronze table of a full-update source already carries the hash
    return snapshot_of(merge_tagged(None, d.orders_old(spark, sf_dir), [], UpdateMode.FULL_UPDATE))


@register(
    "merge_full_update",
    d.with_ctes(f"SELECT *, {_md5(ORDERS)} AS {ROW_HASH_COLUMN} FROM new", new=d.ORDERS_NEW_SQL),
)
def q_merge_full_update(spark, sf_dir):
    t = merge_tagged(_full_update_target(spark, sf_dir), d.orders_new(spark, sf_dir), [], UpdateMode.FULL_UPDATE)
    return snapshot_of(t)


@register(
    "merge_full_update_changes",
    d.with_ctes(
        f"SELECT *, 'insert' AS {CHANGE_TYPE_COLUMN} FROM hn WHERE {ROW_HASH_COLUMN} NOT IN (SELECT {ROW_HASH_COLUMN} FROM ho) "
        f"UNION ALL SELECT *, 'delete' FROM ho WHERE {ROW_HASH_COLUMN} NOT IN (SELECT {ROW_HASH_COLUMN} FROM hn)",
        ho=f"SELECT *, {_md5(ORDERS)} AS {ROW_HASH_COLUMN} FROM ({d.ORDERS_OLD_SQL})",
        hn=f"SELECT *, {_md5(ORDERS)} AS {ROW_HASH_COLUMN} FROM ({d.ORDERS_NEW_SQL})",
    ),
)
def q_merge_full_update_changes(spark, sf_dir):
    t = merge_tagged(_full_update_target(spark, sf_dir), d.orders_new(spark, sf_dir), [], UpdateMode.FULL_UPDATE)
    return changes_of(t)


@register(
    "merge_composite_key",
    d.with_ctes(
        "SELECT * FROM old o WHERE EXISTS (SELECT 1 FROM new n WHERE n.conv_id = o.conv_id AND n.turn = o.turn) "
        "UNION ALL SELECT * FROM new n WHERE NOT EXISTS "
        "(SELECT 1 FROM old o WHERE n.conv_id = o.conv_id AND n.turn = o.turn)",
        old=d.CONV_OLD_SQL, new=d.CONV_NEW_SQL,
    ),
)
def q_merge_composite_key(spark, sf_dir):
    t = merge_tagged(d.conversations_old(spark, sf_dir), d.conversations_new(spark, sf_dir),
                     ["conv_id", "turn"], UpdateMode.APPEND_AND_REMOVE)
    return snapshot_of(t)


@register(
    "merge_recreate_changes",
    d.with_ctes(
        f"SELECT *, 'insert' AS {CHANGE_TYPE_COLUMN} FROM (SELECT * FROM new EXCEPT SELECT * FROM old) "
        "UNION ALL SELECT *, 'delete' FROM (SELECT * FROM old EXCEPT SELECT * FROM new)",
        old=d.ORDERS_OLD_SQL, new=d.ORDERS_NEW_SQL,
    ),
)
def q_merge_recreate_changes(spark, sf_dir):
    t = merge_tagged(d.orders_old(spark, sf_dir), d.orders_new(spark, sf_dir), ["o_orderkey"],
                     UpdateMode.DROP_AND_RECREATE)
    return changes_of(t)


# ---------------------------------------------------------------- step 3: change feed

FEED_CTE = {"feed": d.ORDERS_FEED_SQL}
_NET_SQL = (
    f"SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY o_orderkey ORDER BY {BATCH_ID_COLUMN} DESC, "
    f"({CHANGE_TYPE_COLUMN} = 'insert') DESC) AS rn FROM feed WHERE {{where}}) WHERE rn = 1"
)


@register(
    "change_feed_inserts",
    d.with_ctes(f"SELECT {_cols(ORDERS)} FROM feed WHERE {BATCH_ID_COLUMN} > 0 AND {CHANGE_TYPE_COLUMN} = 'insert'",
                **FEED_CTE),
)
def q_change_feed_inserts(spark, sf_dir):
    return ch.select_changes(d.orders_feed(spark, sf_dir), after=0, change_type="insert")


@register(
    "change_feed_deletes",
    d.with_ctes(f"SELECT {_cols(ORDERS)} FROM feed WHERE {BATCH_ID_COLUMN} > 0 AND {CHANGE_TYPE_COLUMN} = 'delete'",
                **FEED_CTE),
)
def q_change_feed_deletes(spark, sf_dir):
    return ch.select_changes(d.orders_feed(spark, sf_dir), after=0, change_type="delete")


@register(
    "change_feed_range",
    d.with_ctes(f"SELECT * FROM feed WHERE {BATCH_ID_COLUMN} BETWEEN 1 AND 1", **FEED_CTE),
)
def q_change_feed_range(spark, sf_dir):
    return ch.select_changes(d.orders_feed(spark, sf_dir), after=0, upto=1, keep_system=True)


@register("net_changes", d.with_ctes(_NET_SQL.format(where=f"{BATCH_ID_COLUMN} > 0"), **FEED_CTE))
def q_net_changes(spark, sf_dir):
    feed = ch.select_changes(d.orders_feed(spark, sf_dir), after=0, keep_system=True)
    return ch.net_changes(feed, ["o_orderkey"])


@register(
    "apply_changes",
    d.with_ctes(
        f"SELECT * FROM old WHERE o_orderkey NOT IN (SELECT o_orderkey FROM net) "
        f"UNION ALL SELECT {_cols(ORDERS)} FROM net WHERE {CHANGE_TYPE_COLUMN} = 'insert'",
        old=d.ORDERS_OLD_SQL, feed=d.ORDERS_FEED_SQL, net=_NET_SQL.format(where=f"{BATCH_ID_COLUMN} > 0"),
    ),
)
def q_apply_changes(spark, sf_dir):
    feed = ch.select_changes(d.orders_feed(spark, sf_dir), after=0, keep_system=True)
    return ch.apply_changes(d.orders_old(spark, sf_dir), ch.net_changes(feed, ["o_orderkey"]), ["o_orderkey"])


@register(
    "delete_frame",
    d.with_ctes(
        f"SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderdate, {_sha('o_custkey')} AS o_custkey{CLIENT_ID_HASH_SUFFIX} "
        f"FROM feed WHERE {BATCH_ID_COLUMN} > 0 AND {CHANGE_TYPE_COLUMN} = 'delete'",
        **FEED_CTE,
    ),
)
def q_delete_frame(spark, sf_dir):
    deletes = ch.select_changes(d.orders_feed(spark, sf_dir), after=0, change_type="delete")
    return delete_layout(deletes, d.ORDERS_SPEC, TEST_HASH_SALT)


@register(
    "watermark_lookup",
    d.with_ctes(
        f"SELECT max({BATCH_ID_COLUMN}) AS latest_batch_id, count(DISTINCT {BATCH_ID_COLUMN}) AS n_batches, "
        "count(*) AS n_change_rows FROM feed",
        **FEED_CTE,
    ),
)
def q_watermark_lookup(spark, sf_dir):
    return ch.latest_batch(d.orders_feed(spark, sf_dir))


@register(
    "compact_changes",
    d.with_ctes(
        f"SELECT * REPLACE (CAST(1 AS BIGINT) AS {BATCH_ID_COLUMN}) FROM ("
        + _NET_SQL.format(where=f"{BATCH_ID_COLUMN} <= 1") + ")",
        **FEED_CTE,
    ),
)
def q_compact_changes(spark, sf_dir):
    return ch.compact_changes(d.orders_feed(spark, sf_dir), ["o_orderkey"], upto=1)


# ---------------------------------------------------------------- flagship composition

@register(
    "silver_propagation",
    d.with_ctes(
        "SELECT o_orderkey, o_orderstatus, o_totalprice, "
        "CAST(date_trunc('month', o_orderdate) AS TIMESTAMP) AS o_orderdate, "
        f"{_sha(_md5(ORDERS))} AS {ROW_HASH_COLUMN}, {_sha('o_custkey')} AS o_custkey{CLIENT_ID_HASH_SUFFIX} FROM new",
        new=d.ORDERS_NEW_SQL,
    ),
)
def q_silver_propagation(spark, sf_dir):
    from deidlake.plans.flagship import flagship

    return flagship(spark, sf_dir)


# ---------------------------------------------------------------- step 5: text

from deidlake.functions import patterns as pat  # noqa: E402
from deidlake.operators.redact import pii_spans, redact_table, redaction_audit  # noqa: E402


def _sql_str(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _sql_redact(expr: str, patterns) -> str:
    expr = f"NULLIF({expr}, '')"
    for p in patterns:
        for _ in range(p.re2_passes):
            expr = f"regexp_replace({expr}, {_sql_str(p.re2_regex)}, {_sql_str(p.re2_replacement)}, 'g')"
    return expr


def _spans_sql(table: str, id_col: str, column: str) -> str:
    """Spans with offsets: every pass cuts the text at a mark, so that the
    pieces between the marks give the offsets, and masks the spans with text
    of equal length for the next pass."""
    mark, fill = "\ue0ff", "\ue0fe"
    ctes = [f"t0 AS (SELECT {id_col} AS id, NULLIF({column}, '') AS t FROM {table})"]
    found = []
    k = 0
    for p in pat.DEFAULT_PATTERNS:
        for _ in range(p.re2_passes):
            regex = _sql_str(p.re2_regex)
            ctes.append(
                f"f{k} AS (SELECT id, t, regexp_extract_all(t, {regex}, 2) AS s, "
                f"string_split(regexp_replace(t, {regex}, '\\1{mark}\\3', 'g'), '{mark}') AS g FROM t{k})")
            at = "list_sum(list_transform(g[1:i], lambda x: len(x))) + COALESCE(list_sum(list_transform(s[1:i - 1], lambda x: len(x))), 0)"
            found.append(f"SELECT id, '{p.entity}' AS entity, s[i] AS span, CAST({at} AS INTEGER) AS start "
                         f"FROM f{k} CROSS JOIN LATERAL generate_series(1, len(s)) AS x(i)")
            masked = ("array_to_string(list_transform(range(1, len(g) + 1), lambda i: g[i] || COALESCE('<' || "
                      f"repeat('{fill}', greatest(len(s[i]) - 2, 0)) || '>', '')), '')")
            ctes.append(f"t{k + 1} AS (SELECT id, {masked} AS t FROM f{k})")
            k += 1
    return (f"WITH {', '.join(ctes)} SELECT id AS {id_col}, '{column}' AS column_name, entity, span, start, "
            f"CAST(start + len(span) AS INTEGER) AS \"end\" FROM ({' UNION ALL '.join(found)})")


_SPANS_SQL = _spans_sql("documents", "doc_id", "text")


@register("redact_email", f"SELECT doc_id, {_sql_redact('text', [pat.EMAIL])} AS text FROM documents")
def q_redact_email(spark, sf_dir):
    docs = d.table(spark, sf_dir, "documents").select("doc_id", "text")
    return redact_table(docs, ["doc_id"], ["text"], entities=["EMAIL_ADDRESS"])


@register("redact_phone", f"SELECT doc_id, {_sql_redact('text', [pat.PHONE])} AS text FROM documents")
def q_redact_phone(spark, sf_dir):
    docs = d.table(spark, sf_dir, "documents").select("doc_id", "text")
    return redact_table(docs, ["doc_id"], ["text"], entities=["PHONE_NUMBER"])


@register(
    "redact_text",
    f"SELECT conv_id, turn, role, {_sql_redact('text', pat.DEFAULT_PATTERNS)} AS text FROM conversations "
    f"UNION ALL SELECT doc_id, -1, lang, {_sql_redact('text', pat.DEFAULT_PATTERNS)} FROM documents",
)
def q_redact_text(spark, sf_dir):
    conv = d.table(spark, sf_dir, "conversations")
    docs = d.table(spark, sf_dir, "documents").select(
        F.col("doc_id").alias("conv_id"), F.lit(-1).cast("long").alias("turn"), F.col("lang").alias("role"), "text"
    )
    return redact_table(conv.unionByName(docs), ["conv_id", "turn"], ["text"])


@register(
    "redact_pages",
    f"SELECT page_id, {_sql_redact('url', pat.DEFAULT_PATTERNS)} AS url, "
    f"{_sql_redact('html', pat.DEFAULT_PATTERNS)} AS html FROM pages",
)
def q_redact_pages(spark, sf_dir):
    pages = d.table(spark, sf_dir, "pages").select("page_id", "url", "html")
    return redact_table(pages, ["page_id"], ["url", "html"])


@register("pii_spans_pages", " UNION ALL ".join(f"SELECT * FROM ({_spans_sql('pages', 'page_id', c)})" for c in ("url", "html")))
def q_pii_spans_pages(spark, sf_dir):
    pages = d.table(spark, sf_dir, "pages")
    return pii_spans(pages, ["page_id"], "url").unionByName(pii_spans(pages, ["page_id"], "html"))


@register("pii_spans", _SPANS_SQL)
def q_pii_spans(spark, sf_dir):
    return pii_spans(d.table(spark, sf_dir, "documents"), ["doc_id"], "text")


@register(
    "redaction_audit",
    f"SELECT entity, count(*) AS n_spans, count(DISTINCT doc_id) AS n_rows FROM ({_SPANS_SQL}) GROUP BY entity",
)
def q_redaction_audit(spark, sf_dir):
    return redaction_audit(pii_spans(d.table(spark, sf_dir, "documents"), ["doc_id"], "text"), "doc_id")


DOCUMENTS_SPEC = TableSpec(
    "dbo.documents", ("doc_id", "text", "lang", "source", "n_chars"), UpdateMode.APPEND_AND_REMOVE,
    {ColumnRole.FREE_TEXT: ("text",), ColumnRole.OTHER_IDENTIFIABLE: ("source",)}, keys=("doc_id",),
)


@register(
    "deidentify_documents",
    f"SELECT doc_id, {_sql_redact('text', pat.DEFAULT_PATTERNS)} AS text, lang, n_chars FROM documents",
)
def q_deidentify_documents(spark, sf_dir):
    return deidentify(d.table(spark, sf_dir, "documents"), DOCUMENTS_SPEC, TEST_HASH_SALT)


# ---------------------------------------------------------------- step 4: catalog, validation, monitoring

from deidlake.operators.monitor import row_counts  # noqa: E402
from deidlake.operators.validate import column_drift, live_columns, table_drift  # noqa: E402
from deidlake.sources.jdbc import catalog_columns  # noqa: E402
from deidlake.sources.parquet import list_tables as list_parquet_tables  # noqa: E402
from deidlake.spec import spec_df  # noqa: E402

# schema of the given test tables (names only; used to write the SQL side)
TABLE_COLUMNS = {
    "region": ("r_regionkey", "r_name"),
    "nation": ("n_nationkey", "n_name", "n_regionkey"),
    "customer": CUSTOMER,
    "supplier": ("s_suppkey", "s_name", "s_nationkey", "s_acctbal"),
    "part": ("p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice"),
    "orders": ORDERS,
    "lineitem": LINEITEM,
    "events": EVENTS,
    "documents": ("doc_id", "text", "lang", "source", "n_chars"),
    "embeddings": ("vec_id", "embedding", "label"),
    "pages": ("page_id", "url", "html"),
    "benchmark": ("item_id", "text"),
    "labels": ("doc_id", "quality", "toxic"),
    "conversations": ("conv_id", "turn", "role", "text"),
}

# Declared classification used by the validation queries: some drift on
# purpose (a missing column, an unclassified column, a vanished table).
DECLARED = (
    TableSpec("dbo.orders", ORDERS, UpdateMode.FULL_UPDATE),
    TableSpec("dbo.customer", ("c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_phone"),
              UpdateMode.APPEND_AND_REMOVE, keys=("c_custkey",)),
    TableSpec("dbo.lineitem", LINEITEM, UpdateMode.FULL_UPDATE),
    TableSpec("dbo.events", EVENTS, UpdateMode.APPEND_AND_REMOVE, keys=("event_id",)),
    TableSpec("dbo.documents", ("doc_id", "text", "lang", "source"), UpdateMode.APPEND_AND_REMOVE, keys=("doc_id",)),
    TableSpec("dbo.conversations", ("conv_id", "turn", "role", "text"), UpdateMode.APPEND_AND_REMOVE,
              keys=("conv_id", "turn")),
    TableSpec("dbo.patients", ("patient_id", "name"), UpdateMode.NOT_IMPORT),
)


def _live(spark, sf_dir) -> DataFrame:
    # every table found in the folder: drift is about tables nobody listed
    return live_columns({name: d.table(spark, sf_dir, name) for name in list_parquet_tables(spark, sf_dir)}, schema="dbo")


def _live_catalog(spark, sf_dir) -> DataFrame:
    return catalog_columns(_live(spark, sf_dir), schema="dbo")


def _live_catalog_sql() -> str:
    return " UNION ALL ".join(
        f"SELECT 'dbo' AS table_schema, '{name}' AS table_name, unnest({list(cols)!r}) AS column_name, 'dbo.{name}' AS full_name"
        for name, cols in TABLE_COLUMNS.items())


def _catalog_counts_sql() -> str:
    counts = " UNION ALL ".join(f"SELECT 'dbo.{t}' AS full_name, count(*) AS row_count FROM {t}" for t in TABLE_COLUMNS)
    return f"SELECT * FROM ({_live_catalog_sql()}) JOIN ({counts}) USING (full_name)"


def _declared_sql() -> str:
    rows = ", ".join(f"('{s.name}', '{c}')" for s in DECLARED for c in s.columns)
    return f"SELECT * FROM (VALUES {rows}) AS v(table_name, column_name)"


_DRIFT_CTES = {
    "live": f"SELECT full_name AS table_name, column_name FROM ({_live_catalog_sql()})",
    "declared": _declared_sql(),
}


@register("catalog_listing", _catalog_counts_sql())
def q_catalog_listing(spark, sf_dir):
    live = _live(spark, sf_dir)
    counts = live.select(F.concat_ws(".", "table_schema", "table_name").alias("full_name"), "column_name", "row_count")
    return catalog_columns(live, schema="dbo").join(counts, ["full_name", "column_name"])


@register(
    "schema_drift_tables",
    d.with_ctes(
        "SELECT 'unclassified_table' AS kind, table_name, CAST(NULL AS VARCHAR) AS column_name FROM "
        "(SELECT DISTINCT table_name FROM live EXCEPT SELECT DISTINCT table_name FROM declared) "
        "UNION ALL SELECT 'classified_but_unexisting_table', table_name, NULL FROM "
        "(SELECT DISTINCT table_name FROM declared EXCEPT SELECT DISTINCT table_name FROM live)",
        **_DRIFT_CTES,
    ),
)
def q_schema_drift_tables(spark, sf_dir):
    live = _live_catalog(spark, sf_dir).select(F.col("full_name").alias("table_name"), "column_name")
    return table_drift(live, spec_df(spark, DECLARED))


@register(
    "schema_drift_columns",
    d.with_ctes(
        "SELECT 'unclassified_column' AS kind, table_name, column_name FROM "
        "(SELECT * FROM live WHERE table_name IN (SELECT table_name FROM declared) EXCEPT SELECT * FROM declared) "
        "UNION ALL SELECT 'classified_but_unexisting_column', table_name, column_name FROM "
        "(SELECT * FROM declared WHERE table_name IN (SELECT table_name FROM live) EXCEPT SELECT * FROM live)",
        **_DRIFT_CTES,
    ),
)
def q_schema_drift_columns(spark, sf_dir):
    live = _live_catalog(spark, sf_dir).select(F.col("full_name").alias("table_name"), "column_name")
    return column_drift(live, spec_df(spark, DECLARED).select("table_name", "column_name"))


_PROJECTED = TableSpec("dbo.lineitem", LINEITEM, UpdateMode.FULL_UPDATE,
                       skip_columns=("l_tax", "l_returnflag"))


@register("projected_scan", "SELECT " + _cols(_PROJECTED.imported_columns) + " FROM lineitem")
def q_projected_scan(spark, sf_dir):
    # same projection the JDBC reader sends as a subquery; on Parquet it is
    # pruned into the scan (ReadSchema)
    return d.table(spark, sf_dir, "lineitem").select(*_PROJECTED.imported_columns)


_IMPORTED = [s for s in DECLARED if s.is_imported]


@register(
    "ingest_row_counts",
    " UNION ALL ".join(
        f"SELECT '{s.name}' AS table_name, count(*) AS row_count FROM {s.short_name}" for s in _IMPORTED
    ),
)
def q_ingest_row_counts(spark, sf_dir):
    return row_counts({s.name: d.table(spark, sf_dir, s.short_name) for s in _IMPORTED})


# ---------------------------------------------------------------- step 6: entities

from deidlake.operators.entities import entity_counts, extract_entities, nested_entities, normalised  # noqa: E402


# Terms taken from a given table whose passages occur in the documents: the
# first six words of each benchmark text, and the two words after them.
LEXICON_SPANS = (("DISEASE", 1, 6), ("CHEMICAL", 7, 2))


def benchmark_lexicon(spark, sf_dir) -> DataFrame:
    words = F.filter(F.split("text", pat.TOKEN_SPLIT), lambda w: w != "")
    texts = d.table(spark, sf_dir, "benchmark").select(words.alias("w"))
    terms = F.array(*[F.struct(F.array_join(F.slice("w", start, n), " ").alias("term"), F.lit(label).alias("label"))
                      for label, start, n in LEXICON_SPANS])
    return normalised(texts.select(F.inline(terms)))


def _benchmark_lexicon_sql() -> str:
    split = _sql_str(pat.TOKEN_SPLIT)
    words = f"SELECT list_filter(string_split_regex(text, {split}), lambda x: x <> '') AS w FROM benchmark"
    parts = " UNION ".join(
        f"SELECT lower(array_to_string(w[{a}:{a + n - 1}], ' ')) AS term, '{label}' AS label, len(w[{a}:{a + n - 1}]) AS n_words FROM ({words})"
        for label, a, n in LEXICON_SPANS)
    return f"SELECT DISTINCT * FROM ({parts}) WHERE n_words > 0"


def _entities_sql(table: str, id_col: str, text_col: str) -> str:
    split = _sql_str(pat.TOKEN_SPLIT)
    return f"""WITH RECURSIVE
lex AS ({_benchmark_lexicon_sql()}),
sizes AS (SELECT DISTINCT n_words AS n FROM lex),
toks AS (SELECT {id_col} AS id, string_split_regex({text_col}, {split}) AS t FROM {table} WHERE {text_col} IS NOT NULL),
starts AS (SELECT id, t, i FROM toks, generate_series(0, len(t) - 1) AS g(i)
           WHERE t[i + 1] <> '' AND lower(t[i + 1]) IN (SELECT string_split(term, ' ')[1] FROM lex)),
grams AS (SELECT id, i AS pos, n, array_to_string(t[i + 1:i + n], ' ') AS text
          FROM starts, sizes WHERE i + n <= len(t)),
cand AS (SELECT g.id, g.pos, g.n, g.text, l.label FROM grams g JOIN lex l ON lower(g.text) = l.term AND g.n = l.n_words),
ranked AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY n DESC, pos, label) AS r FROM cand),
walk(id, r, taken, keep) AS (
  SELECT id, CAST(0 AS BIGINT), CAST([] AS BIGINT[]), false FROM (SELECT DISTINCT id FROM ranked)
  UNION ALL
  SELECT w.id, c.r,
         CASE WHEN list_has_any(w.taken, range(c.pos, c.pos + c.n)) THEN w.taken
              ELSE list_concat(w.taken, range(c.pos, c.pos + c.n)) END,
         NOT list_has_any(w.taken, range(c.pos, c.pos + c.n))
  FROM walk w JOIN ranked c ON c.id = w.id AND c.r = w.r + 1)
SELECT c.id AS {id_col}, c.label, CAST(c.pos AS INTEGER) AS pos, c.text
FROM walk w JOIN ranked c ON c.id = w.id AND c.r = w.r WHERE w.keep"""


_ENTITIES_SQL = _entities_sql("documents", "doc_id", "text")


@register("entities_long", _ENTITIES_SQL)
def q_entities_long(spark, sf_dir):
    return extract_entities(d.table(spark, sf_dir, "documents"), ["doc_id"], "text", benchmark_lexicon(spark, sf_dir))


_NESTED_SQL = (
    "SELECT d.doc_id, [" + ", ".join(
        f"COALESCE(e.l{i}, CAST([] AS VARCHAR[]))" for i in range(2)
    ) + "] AS text_feature_extraction FROM documents d LEFT JOIN (SELECT doc_id, "
    + ", ".join(
        f"list(text ORDER BY pos) FILTER (WHERE label = '{lab}') AS l{i}"
        for i, lab in enumerate(("DISEASE", "CHEMICAL"))
    )
    + f" FROM ({_ENTITIES_SQL}) GROUP BY doc_id) e ON d.doc_id = e.doc_id"
)


@register("entities_nested", _NESTED_SQL)
def q_entities_nested(spark, sf_dir):
    docs = d.table(spark, sf_dir, "documents").select("doc_id", "text")
    long = extract_entities(docs, ["doc_id"], "text", benchmark_lexicon(spark, sf_dir), by_text=True)
    return nested_entities(docs, ["doc_id"], "text", long).drop("text")


@register(
    "entity_counts",
    f"SELECT label, lower(text) AS term, count(*) AS n_mentions FROM ({_ENTITIES_SQL}) GROUP BY label, lower(text)",
)
def q_entity_counts(spark, sf_dir):
    return entity_counts(extract_entities(d.table(spark, sf_dir, "documents"), ["doc_id"], "text", benchmark_lexicon(spark, sf_dir)))


# ---------------------------------------------------------------- scored detectors

# a note for each order; {} are the customer, the nation, two numbers and the date
NOTE = ("Call ", " about the parcel, lives in ", "; phone ", " on ", "; the number of the parcel in our warehouse since then is ")
_NOTE_VALUES = ("c_name", "n_name", "lpad(CAST(o_custkey AS VARCHAR), 7, '0')", "CAST(CAST(o_orderdate AS DATE) AS VARCHAR)",
                "lpad(CAST(o_orderkey AS VARCHAR), 9, '0')")


def _detected_sql() -> str:
    """Spans by the construction of the note: the customer's digits are a number
    after "call" too, but the name scores higher; the last number has no context."""
    parts, before = [], []
    for text, value, entity, score in zip(NOTE, _NOTE_VALUES, ("PERSON", "LOCATION", "PHONE_NUMBER", "DATE_TIME", None), (85, 100, 65, 95, 0)):
        before += [f"'{text}'"]
        if entity:
            start = f"length({' || '.join(before)})"
            parts.append(f"SELECT o_orderkey, 'note' AS column_name, '{entity}' AS entity, {value} AS span, {start} AS \"start\", "
                         f"{start} + length({value}) AS \"end\", {score} AS score FROM o")
        before += [value]
    return ("WITH o AS (SELECT * FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey) "
            + " UNION ALL ".join(parts))


@register("detect_names", _detected_sql())
def q_detect_names(spark, sf_dir):
    """Scored detection in a note for each order, with all customers and nations
    as the lexicon of names."""
    from deidlake.functions.patterns import DATE_TIME, Pattern
    from deidlake.operators.detect import Detector, detect

    orders, customer, nation = (d.table(spark, sf_dir, t) for t in ("orders", "customer", "nation"))
    notes = orders.join(customer, F.col("o_custkey") == F.col("c_custkey")).join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
    pieces = [x for text, value in zip(NOTE, _NOTE_VALUES) for x in (F.lit(text), F.expr(value.replace("VARCHAR", "STRING")))]
    notes = notes.select("o_orderkey", F.concat(*pieces).alias("note"))
    names = customer.select(F.col("c_name").alias("term"), F.lit("PERSON").alias("label")).unionByName(
        nation.select(F.col("n_name").alias("term"), F.lit("LOCATION").alias("label")))
    number = Detector(Pattern("PHONE_NUMBER", "[0-9]{7,9}", "0-9A-Za-z", "0-9A-Za-z"), 30)
    return detect(notes, ["o_orderkey"], "note", names, (number, Detector(DATE_TIME, 60)))


# ---------------------------------------------------------------- step 7: provisioning, snapshots

from functools import reduce  # noqa: E402

from deidlake.operators.provision import provision  # noqa: E402
from deidlake.operators.snapshot import content_checksum, fan_out, snapshot_database  # noqa: E402
from deidlake.session import workspace_root  # noqa: E402

PROVISION_COLUMNS = ("o_orderkey", "o_orderstatus", "o_totalprice", "o_orderdate")
PROVISION_WHERE = "o_orderstatus = 'F' AND o_totalprice > 100000"


@register("provision_projection", f"SELECT {_cols(PROVISION_COLUMNS)} FROM ({DEIDENTIFY_ORDERS_SQL})")
def q_provision_projection(spark, sf_dir):
    gold = deidentify(d.table(spark, sf_dir, "orders"), d.ORDERS_SPEC, TEST_HASH_SALT)
    return provision(gold, PROVISION_COLUMNS)


@register(
    "provision_filtered",
    f"SELECT {_cols(PROVISION_COLUMNS)} FROM ({DEIDENTIFY_ORDERS_SQL}) WHERE {PROVISION_WHERE}",
)
def q_provision_filtered(spark, sf_dir):
    gold = deidentify(d.table(spark, sf_dir, "orders"), d.ORDERS_SPEC, TEST_HASH_SALT)
    return provision(gold, PROVISION_COLUMNS, PROVISION_WHERE)


SNAPSHOT_STAMP = "query-run"
DESTINATIONS = ("dest_a", "dest_b")


def _snapshot(spark, sf_dir, query: str):
    # one scratch folder per application and query: neither applications nor
    # queries share one, and a rerun overwrites its own output
    root = f"{workspace_root(spark)}/snapshot-queries/{spark.sparkContext.applicationId}/{query}"
    # whole-database listing (S4): every table found in the source folder
    tables = {("dbo", name): d.table(spark, sf_dir, name) for name in list_parquet_tables(spark, sf_dir)}
    return root, snapshot_database(tables, root + "/staging", SNAPSHOT_STAMP)


def _counts(spark, paths: dict[str, str], **labels) -> DataFrame:
    parts = []
    for name, path in paths.items():
        df = content_checksum(spark.read.parquet(path))
        parts.append(df.select(*[F.lit(v).alias(k) for k, v in labels.items()], F.lit(name).alias("table_name"),
                               "row_count", "content_sum"))
    return reduce(DataFrame.unionByName, parts)


# columns whose text differs between engines, by the form the checksum takes
TIMES = {"o_orderdate", "l_shipdate", "ts"}
DOUBLES = {"c_acctbal", "s_acctbal", "p_retailprice", "o_totalprice", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "value"}
VECTORS = {"embedding"}


def _counts_sql(extra: str = "") -> str:
    def framed(text):
        return f"coalesce(length({text}) || ':' || ({text}), 'n')"

    def bits(x):
        return f"replace(replace(format('{{:a}}', CAST({x} AS DOUBLE)), 'p+', 'p'), '.0p', 'p')"

    def text(c):
        if c in TIMES:
            return f"CAST(epoch_us({c}) AS VARCHAR)"
        if c in DOUBLES:
            return bits(c)
        if c in VECTORS:
            return f"'[' || len({c}) || ']' || array_to_string(list_transform({c}, lambda x: {framed(bits('x'))}), '')"
        return f"CAST({c} AS VARCHAR)"

    def digest(table):
        row = " || ".join(framed(text(c)) for c in TABLE_COLUMNS[table])
        return f"CAST(sum(CAST(CAST('0x' || substr(md5({row}), 1, 16) AS UBIGINT) AS HUGEINT)) AS VARCHAR) AS content_sum"

    return " UNION ALL ".join(
        f"SELECT {extra}'dbo_{t}' AS table_name, count(*) AS row_count, {digest(t)} FROM {t}" for t in TABLE_COLUMNS
    )


@register("db_snapshot", _counts_sql())
def q_db_snapshot(spark, sf_dir):
    _, staged = _snapshot(spark, sf_dir, "db_snapshot")
    return _counts(spark, staged)


def _fanned(spark, sf_dir, kind: str):
    root, staged = _snapshot(spark, sf_dir, f"snapshot_{kind}")
    dests = [f"{root}/{x}" for x in DESTINATIONS]
    fan_out(spark, staged, dests, SNAPSHOT_STAMP, kinds=(kind,))
    parts = []
    for name, dest in zip(DESTINATIONS, dests):
        sub = "latest" if kind == "latest" else f"archive/{SNAPSHOT_STAMP}"
        parts.append(_counts(spark, {t: f"{dest}/{sub}/{t}" for t in staged}, destination=name))
    return reduce(DataFrame.unionByName, parts)


_FAN_SQL = " UNION ALL ".join(f"SELECT * FROM ({_counts_sql(repr(x) + ' AS destination, ')})" for x in DESTINATIONS)


@register("snapshot_latest", _FAN_SQL)
def q_snapshot_latest(spark, sf_dir):
    return _fanned(spark, sf_dir, "latest")


@register("snapshot_archive", _FAN_SQL)
def q_snapshot_archive(spark, sf_dir):
    return _fanned(spark, sf_dir, "archive")


# ---------------------------------------------------------------- zones

from deidlake.operators.deidentify import deidentified_keys  # noqa: E402
from deidlake.operators.merge import SIDE  # noqa: E402
from deidlake.sources.zones import ZoneTable  # noqa: E402

ZONE_ORDERS_SPEC = TableSpec(
    "dbo.orders", ORDERS, UpdateMode.FULL_UPDATE,
    {ColumnRole.CLIENT_ID: ("o_custkey",), ColumnRole.DATE: ("o_orderdate",),
     ColumnRole.OTHER_IDENTIFIABLE: ("o_orderpriority",)},
    keys=("o_orderkey",),
)


@register(
    "zone_scan",
    d.with_ctes(
        "SELECT o_orderkey, o_orderstatus, o_totalprice, "
        "CAST(date_trunc('month', o_orderdate) AS TIMESTAMP) AS o_orderdate, "
        f"{_sha(_md5(ORDERS))} AS {ROW_HASH_COLUMN}, {_sha('o_custkey')} AS o_custkey{CLIENT_ID_HASH_SUFFIX} FROM new",
        new=d.ORDERS_NEW_SQL,
    ),
)
def q_zone_scan(spark, sf_dir):
    """The de-identified new orders, written as the first batch of a zone
    table and read back as its snapshot."""
    silver = ZoneTable(f"{workspace_root(spark)}/zone-queries/{spark.sparkContext.applicationId}", "silver",
                       ZONE_ORDERS_SPEC.name)
    silver.drop(spark)  # of an earlier run in this application
    merged = merge_tagged(None, d.orders_new(spark, sf_dir), [], UpdateMode.FULL_UPDATE)
    rows = deidentify(merged.drop(SIDE), ZONE_ORDERS_SPEC, TEST_HASH_SALT).withColumn(SIDE, F.lit("insert"))
    silver.write_batch(spark, rows, 1, deidentified_keys(ZONE_ORDERS_SPEC))
    return silver.read_snapshot(spark)


@register("consumer_catch_up", d.ORDERS_NEW_SQL)
def q_consumer_catch_up(spark, sf_dir):
    """A consumer's copy of the orders: it has consumed the old orders when the
    batch that makes them the new ones expires (the consumer being away), and
    catches up by the snapshot and the deletes."""
    from deidlake.streaming.incremental import run_available_now

    root = f"{workspace_root(spark)}/zone-queries/{spark.sparkContext.applicationId}"
    keys = list(d.ORDERS_SPEC.keys)
    source, copy = ZoneTable(root, "bronze", "dbo.orders_feed"), ZoneTable(root, "silver", "dbo.orders_copy")
    for zone_table in (source, copy):
        zone_table.drop(spark)  # of an earlier run in this application
    feed = d.orders_feed(spark, sf_dir)

    def publish(batch: int, rows) -> None:
        source.write_batch(spark, rows.drop(BATCH_ID_COLUMN).withColumnRenamed(CHANGE_TYPE_COLUMN, SIDE), batch, keys)

    def apply(changes, newest: int) -> None:
        copy.write_batch(spark, changes.drop(BATCH_ID_COLUMN).withColumnRenamed(CHANGE_TYPE_COLUMN, SIDE), newest, keys)

    publish(1, feed.where(F.col(BATCH_ID_COLUMN) == 0))
    run_available_now(spark, source, "copy", apply)
    source.unregister_consumer(spark, "copy")
    publish(2, feed.where(F.col(BATCH_ID_COLUMN) == 1))
    publish(3, feed.where(F.lit(False)))
    source.compact(spark)
    source.expire(spark, 3)
    source.mark_consumed(spark, "copy", 1)
    run_available_now(spark, source, "copy", apply, lambda: copy.read_snapshot(spark))
    return copy.read_snapshot(spark)


@register("stream_propagation", d.ORDERS_NEW_SQL)
def q_stream_propagation(spark, sf_dir):
    """A copy of the orders kept by a stream: the first load in one run, the
    restart consumes the change and an empty batch in one trigger."""
    from deidlake.streaming.structured import stream_available_now

    root = f"{workspace_root(spark)}/zone-queries/{spark.sparkContext.applicationId}"
    keys = list(d.ORDERS_SPEC.keys)
    source, copy = ZoneTable(root, "bronze", "dbo.orders_streamed"), ZoneTable(root, "silver", "dbo.orders_streamed")
    for zone_table in (source, copy):
        zone_table.drop(spark)  # of an earlier run in this application
    feed = d.orders_feed(spark, sf_dir)

    def publish(batch: int, rows) -> None:
        source.write_batch(spark, rows.drop(BATCH_ID_COLUMN).withColumnRenamed(CHANGE_TYPE_COLUMN, SIDE), batch, keys)
        source.announce(spark)

    def apply(changes, newest: int) -> None:
        copy.write_batch(spark, changes.drop(BATCH_ID_COLUMN).withColumnRenamed(CHANGE_TYPE_COLUMN, SIDE), newest, keys)

    publish(1, feed.where(F.col(BATCH_ID_COLUMN) == 0))
    stream_available_now(spark, source, "copy", apply)
    publish(2, feed.where(F.col(BATCH_ID_COLUMN) == 1))
    publish(3, feed.where(F.lit(False)))
    stream_available_now(spark, source, "copy", apply)
    return copy.read_snapshot(spark)


@register("clean_touched_buckets", d.ORDERS_NEW_SQL)
def q_clean_touched_buckets(spark, sf_dir):
    """The orders compacted, changed and compacted again: only key buckets
    with changes are rewritten, and what expires leaves the others in place."""
    root = f"{workspace_root(spark)}/zone-queries/{spark.sparkContext.applicationId}"
    orders = ZoneTable(root, "gold", "dbo.orders_cleaned")
    orders.drop(spark)  # of an earlier run in this application
    feed = d.orders_feed(spark, sf_dir)
    for batch in (0, 1):
        rows = feed.where(F.col(BATCH_ID_COLUMN) == batch).drop(BATCH_ID_COLUMN).withColumnRenamed(CHANGE_TYPE_COLUMN, SIDE)
        orders.write_batch(spark, rows, batch + 1, list(d.ORDERS_SPEC.keys))
        orders.compact(spark)
    orders.expire(spark, 3)
    return orders.read_snapshot(spark)
