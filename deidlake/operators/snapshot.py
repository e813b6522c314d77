"""Whole-database snapshot and fan-out to "latest" and "archive" folders.

Every table is written by Spark in parallel files (no ``coalesce(1)``
unless a single file is explicitly requested; ``max_records_per_file``
bounds file size instead).  A copy follows the splits of the scan, without
a shuffle; ``partitions`` asks for one explicitly.  The fan-out re-reads the staged snapshot and
lets executors write each destination -- nothing streams through the
driver."""

from __future__ import annotations

import datetime
from concurrent.futures import ThreadPoolExecutor
from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Tables are written by concurrent Spark jobs (the scheduler interleaves
# their tasks); this bounds how many are in flight.
DEFAULT_PARALLEL_TABLES = 8
# Columns whose text one projection of the checksum makes.
COLUMNS_AT_ONCE = 2


def snapshot_stamp(now: datetime.datetime | None = None) -> str:
    return (now or datetime.datetime.now(datetime.timezone.utc)).strftime("%Y%m%dT%H%M%SZ")


def staged_name(schema: str, table: str) -> str:
    return f"{schema}_{table}" if schema else table


def _write(df: DataFrame, path: str, mode: str, single_file: bool, max_records_per_file: int | None,
           partitions: int | None = None) -> None:
    if single_file:
        df = df.coalesce(1)
    elif partitions is not None:
        df = df.repartition(partitions, *df.columns)
    w = df.write.mode(mode)
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", max_records_per_file)
    w.parquet(path)


def _run_all(jobs, parallel: int) -> None:
    with ThreadPoolExecutor(max_workers=max(1, parallel)) as pool:
        for f in [pool.submit(j) for j in jobs]:
            f.result()  # re-raise the first failure


def snapshot_database(tables: dict[tuple[str, str], DataFrame], staging_root: str, stamp: str,
                      single_file: bool = False, max_records_per_file: int | None = 5_000_000,
                      parallel_tables: int = DEFAULT_PARALLEL_TABLES, partitions: int | None = None) -> dict[str, str]:
    """Write every (schema, table) to ``<staging_root>/<stamp>/<schema>_<table>``."""
    out, jobs = {}, []
    for (schema, table), df in tables.items():
        name = staged_name(schema, table)
        path = f"{staging_root.rstrip('/')}/{stamp}/{name}"
        jobs.append(lambda df=df, path=path: _write(df, path, "overwrite", single_file, max_records_per_file,
                                                        partitions))
        out[name] = path
    _run_all(jobs, parallel_tables)
    return out


def _framed(text: Column) -> Column:
    """The text after its length, ``n`` for null: no two rows of frames look alike."""
    return F.coalesce(F.concat(F.length(text).cast("string"), F.lit(":"), text), F.lit("n"))


def _bits(x: Column) -> Column:
    """The 64 bits of a double; of zero for null.  (Java's, as Spark has none.)"""
    return F.reflect(F.lit("java.lang.Double"), F.lit("doubleToLongBits"), F.coalesce(x.cast("double"), F.lit(0.0))).cast("long")


def _hexadecimal(bits: Column) -> Column:
    """The double of these bits as ``%a`` writes it, ``.0p`` as ``p``: cut out of the
    bits, without the pattern searches that ``%a`` makes for each value."""
    power, rest = F.shiftright(bits, 52).bitwiseAND(F.lit(2047)), bits.bitwiseAND(F.lit((1 << 52) - 1))
    digits = F.rtrim(F.lower(F.lpad(F.hex(rest), 13, "0")), F.lit("0"))
    text = F.concat(
        F.when(bits < 0, F.lit("-0x")).otherwise(F.lit("0x")), F.when(power > 0, F.lit("1")).otherwise(F.lit("0")),
        F.when(rest != 0, F.concat(F.lit("."), digits)).otherwise(F.lit("")), F.lit("p"),
        F.when(power > 0, power - 1023).when(rest == 0, 0).otherwise(-1022).cast("string"))
    endless = F.when(rest != 0, F.lit("nan")).when(bits < 0, F.lit("-inf")).otherwise(F.lit("inf"))
    return F.when(power == 2047, endless).otherwise(text)


def canonical(column: Column, kind: T.DataType, bits: Column | None = None) -> Column:
    """A value of any type as text that tells unequal values apart, whatever the
    engine, session time zone or file it was read from; null stays null.

    Floating point by its bits in hexadecimal (``0x1.8p0``, ``nan``, ``inf``),
    times as microseconds and dates as days since 1970, binary as hexadecimal,
    arrays and structs element by element, maps in order of their keys.
    ``bits`` may give those of a floating-point column, made once."""
    if isinstance(kind, (T.FloatType, T.DoubleType)):
        return F.when(column.isNotNull(), _hexadecimal(_bits(column) if bits is None else bits))
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(column).cast("string")
    if isinstance(kind, T.TimestampNTZType):
        # from the fields of the wall clock, so that no session time zone takes part
        minutes = (F.unix_date(column.cast("date")).cast("long") * 24 + F.hour(column)) * 60 + F.minute(column)
        micros = (F.extract(F.lit("SECOND"), column) * F.lit(1_000_000)).cast("long")
        return (minutes * 60_000_000 + micros).cast("string")
    if isinstance(kind, T.DateType):
        return F.unix_date(column).cast("string")
    if isinstance(kind, T.BinaryType):
        return F.hex(column)
    if isinstance(kind, T.ArrayType):
        if isinstance(kind.elementType, (T.FloatType, T.DoubleType)):
            both = F.transform(column, lambda x: F.struct(x.alias("x"), _bits(x).alias("bits")))
            parts = F.transform(both, lambda b: _framed(canonical(b["x"], kind.elementType, b["bits"])))
        else:
            parts = F.transform(column, lambda x: _framed(canonical(x, kind.elementType)))
        return F.concat(F.lit("["), F.size(column).cast("string"), F.lit("]"), F.array_join(parts, ""))
    if isinstance(kind, T.StructType):
        parts = [_framed(canonical(column.getField(f.name), f.dataType)) for f in kind.fields]
        return F.when(column.isNotNull(), F.concat(F.lit("{"), *parts))
    if isinstance(kind, T.MapType):
        entry = T.StructType([T.StructField("key", kind.keyType), T.StructField("value", kind.valueType)])
        parts = F.array_sort(F.transform(F.map_entries(column), lambda e: _framed(canonical(e, entry))))
        return F.concat(F.lit("<"), F.size(column).cast("string"), F.lit(">"), F.array_join(parts, ""))
    return column.cast("string")


def content_checksum(df: DataFrame) -> DataFrame:
    """One row: ``row_count`` and ``content_sum``, the sum over all rows of
    the first 64 bits of the MD5 of the row's values (every column, in column
    order, framed), as decimal text.  The sum doesn't depend on the order of
    rows or files, and counts repeated rows each; null for an empty table."""
    floats = [i for i, f in enumerate(df.schema.fields) if isinstance(f.dataType, (T.FloatType, T.DoubleType))]
    own = df.toDF(*[f"_{i}" for i in range(len(df.columns))])
    own = own.select("*", *[_bits(F.col(f"_{i}")).alias(f"_bits{i}") for i in floats])
    # few texts a projection: the JVM doesn't compile methods of more than 8000 bytes
    for start in range(0, len(df.columns), COLUMNS_AT_ONCE):
        some = list(enumerate(df.schema.fields))[start:start + COLUMNS_AT_ONCE]
        own = own.select("*", *[canonical(F.col(f"_{i}"), f.dataType, F.col(f"_bits{i}") if i in floats else None).alias(f"_text{i}") for i, f in some])
    row = F.concat(*[_framed(F.col(f"_text{i}")) for i in range(len(df.columns))], F.lit(""))
    digest = own.select(F.md5(row.cast("binary")).alias("_md5"))
    bits = digest.select(F.conv(F.substring("_md5", 1, 16), 16, -10).cast("long").alias("_bits"))
    # added up in three parts of 22 bits, as longs: exact up to 2^41 rows
    part, low = 22, F.lit((1 << 22) - 1)
    sums = bits.agg(F.count(F.lit(1)).alias("row_count"), *[
        F.sum(F.shiftrightunsigned("_bits", k * part).bitwiseAND(low)).cast("decimal(20,0)").alias(f"_sum{k}") for k in range(3)])
    total = reduce(Column.__add__, [F.col(f"_sum{k}") * F.lit(Decimal(1 << k * part)) for k in range(3)])
    return sums.select("row_count", total.cast("string").alias("content_sum"))


def fan_out(spark: SparkSession, staged: dict[str, str], destinations, stamp: str,
            single_file: bool = False, kinds=("latest", "archive"),
            parallel_tables: int = DEFAULT_PARALLEL_TABLES) -> dict[str, list[str]]:
    """Copy each staged table to ``<dest>/latest/<table>`` (replaced) and
    ``<dest>/archive/<stamp>/<table>`` (kept) for every destination."""
    written: dict[str, list[str]] = {}
    jobs = []
    for name, path in staged.items():
        df = spark.read.parquet(path)
        for dest in destinations:
            root = dest.rstrip("/")
            targets = {"latest": f"{root}/latest/{name}", "archive": f"{root}/archive/{stamp}/{name}"}
            for kind in kinds:
                target = targets[kind]
                jobs.append(lambda df=df, target=target: _write(df, target, "overwrite", single_file, None))
                written.setdefault(name, []).append(target)
    _run_all(jobs, parallel_tables)
    return written
