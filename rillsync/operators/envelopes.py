"""Envelopes to one canonical changelog: seq, op (I, U, D), source, target, produced_ms, key, old_key, tuple."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rillsync.functions import decode as D
from rillsync.sources.schema import TableSpec

#: What a record that cannot be read as its envelope goes into, whole.
_BAD = "_unreadable"
MAXWELL = (
    "database string, table string, ts bigint, type string, data map<string,variant>, old map<string,variant>, "
    f"{_BAD} string"
)
DEBEZIUM = (
    "payload struct<op:string,ts_ms:bigint,before:map<string,variant>,after:map<string,variant>>, "
    f"{_BAD} string"
)


def _common(v: Column, f: T.StructField) -> Column:
    if isinstance(f.dataType, T.StringType):
        return D.clean_text(v.cast("string"))
    return v.cast(f.dataType)


def maxwell_value(v: Column, f: T.StructField) -> Column:
    """A member of a Maxwell row as the target's type."""
    if "bits" in f.metadata:
        return D.bits_of_int(v.cast("bigint"), f.metadata["bits"])
    if isinstance(f.dataType, T.BinaryType):
        return D.binary_of_base64(v.cast("string"))
    if isinstance(f.dataType, T.BooleanType):
        return F.when(v.cast("string").isNotNull(), F.lower(v.cast("string")).isin("1", "true"))
    if isinstance(f.dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
        return v.cast("string").cast(f.dataType)
    return _common(v, f)


def debezium_value(v: Column, f: T.StructField) -> Column:
    """A member of a Debezium row as the target's type."""
    text = v.cast("string")
    if "bits" in f.metadata:
        return D.bits_of_base64(text, f.metadata["bits"])
    if "time" in f.metadata:
        return F.when(text.contains("Z"), text).otherwise(D.time_of_nanos(text.try_cast("bigint"), f.metadata["time"]))
    if isinstance(f.dataType, T.BinaryType):
        return D.binary_of_base64(text)
    if isinstance(f.dataType, T.DateType):
        return D.date_of_days(v.cast("int"))
    if isinstance(f.dataType, (T.TimestampType, T.TimestampNTZType)):
        nanos = D.timestamp_of_nanos(text.try_cast("bigint"), f.metadata.get("scale", 6)).cast(f.dataType)
        return F.when(text.contains("Z"), text.try_cast(f.dataType)).otherwise(nanos)
    if isinstance(f.dataType, T.DecimalType):
        return D.decimal_of_base64(text, f.dataType.precision, f.dataType.scale)
    return _common(v, f)


def _struct(table: TableSpec, names: list[str] | tuple[str, ...], value) -> Column:
    by = {f.name: f for f in table.schema.fields}
    return F.struct(*[value(n, by[n]).alias(n) for n in names])


def _canonical(df: DataFrame, table: TableSpec, key: Column, old_key: Column, row: Column) -> DataFrame:
    shown = df.select(
        "seq", "op", "source", F.lit(table.name).alias("target"), "produced_ms", key.alias("key"),
        old_key.alias("old_key"), F.when(F.col("op") != "D", row).alias("tuple"),
    )
    # a key that did not change is no old key
    return shown.withColumn("old_key", F.when(~F.col("old_key").eqNullSafe(F.col("key")), F.col("old_key")))


def _envelope(schema: str) -> Column:
    return F.from_json("value", schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _BAD})


def maxwell_headers(records: DataFrame, source: str) -> DataFrame:
    """Rows (topic, ..., seq, source: "<source>.<database>.<table>", op, produced_ms, data, old, readable). Nothing of
    the row's members is decoded yet. A null message says nothing and is skipped. Text that is no envelope is kept:
    it is not readable, its op is null, and so is its source unless its table can be told. A kind of change that is
    unknown has a null op, too."""
    df = records.where("value is not null").withColumn("e", _envelope(MAXWELL))
    op = (
        F.when(F.col("e.type") == "insert", "I")
        .when(F.col("e.type") == "update", "U")
        .when(F.col("e.type") == "delete", "D")
    )
    named = F.concat(F.lit(f"{source}."), "e.database", F.lit("."), "e.table")
    readable = F.col(f"e.{_BAD}").isNull() & named.isNotNull()
    return df.select(
        *records.columns,
        named.alias("source"),
        F.when(readable, op).alias("op"),
        D.millis_of_seconds(F.col("e.ts")).alias("produced_ms"),
        "e.data",
        "e.old",
        readable.alias("readable"),
    )


def debezium_headers(records: DataFrame, source: str) -> DataFrame:
    """Like maxwell_headers; the source is its name and the topic's part from the first dot on. Null messages and
    envelopes whose payload is null are tombstones and are skipped; an envelope without a payload is not readable."""
    df = records.where("value is not null").withColumn("e", _envelope(DEBEZIUM))
    # only text without a payload is looked at again, for the null that makes it a tombstone
    tombstone = F.when(
        F.col("e.payload").isNull(),
        F.coalesce(
            F.is_variant_null(F.try_variant_get(F.try_parse_json("value"), "$.payload", "variant")), F.lit(False)
        ),
    ).otherwise(F.lit(False))
    df = df.where(~tombstone)
    readable = F.col(f"e.{_BAD}").isNull() & F.col("e.payload").isNotNull()
    kind = F.col("e.payload.op")
    op = F.when(kind.isin("r", "c"), "I").when(kind == "u", "U").when(kind == "d", "D")
    data = F.when(kind == "d", F.col("e.payload.before")).otherwise(F.col("e.payload.after"))
    return df.select(
        *records.columns,
        F.concat(F.lit(source), D.topic_suffix(F.col("topic"))).alias("source"),
        F.when(readable, op).alias("op"),
        F.col("e.payload.ts_ms").alias("produced_ms"),
        data.alias("data"),
        F.lit(None).cast("map<string,variant>").alias("old"),
        readable.alias("readable"),
    )


def routed(headers: DataFrame, tables: dict[str, str]) -> DataFrame:
    """Rows whose source is mapped, with their target, and those that are not readable and tell no source: they may
    be of any table, so they are not dropped. The map is configuration, a few rows: a literal, not a join."""
    lost = ~F.col("readable") & F.col("source").isNull()
    if not tables:
        return headers.withColumn("target", F.lit(None).cast("string")).where(lost)
    known = F.create_map(*[F.lit(x) for pair in tables.items() for x in pair])
    target = F.when(F.col("source").isNotNull(), F.try_element_at(known, F.col("source")))
    return headers.where(lost | F.col("source").isin(list(tables))).withColumn("target", target)


def broken(headers: DataFrame) -> DataFrame:
    """Rows to set aside: not readable, of an unknown kind or without a row."""
    return headers.where(BROKEN)


BROKEN = "not readable or op is null or data is null"


def maxwell_changes(headers: DataFrame, table: TableSpec) -> DataFrame:
    """The canonical changelog of one target. An update without old members leaves its key as it was."""
    data, old = F.col("data"), F.col("old")

    def now(n: str, f: T.StructField) -> Column:
        return maxwell_value(D.field(data, n), f)

    def was(n: str, f: T.StructField) -> Column:
        return F.when(D.has_field(old, n), maxwell_value(D.field(old, n, required=False), f)).otherwise(now(n, f))

    old_key = F.when((F.col("op") == "U") & old.isNotNull(), _struct(table, table.keys, was))
    return _canonical(
        headers.where(f"not ({BROKEN})"), table, _struct(table, table.keys, now), old_key,
        _struct(table, table.columns, now)
    )


def debezium_changes(headers: DataFrame, table: TableSpec) -> DataFrame:
    """The canonical changelog of one target; a changed key comes as a delete and an insert in this envelope."""

    def now(n: str, f: T.StructField) -> Column:
        return debezium_value(D.field(F.col("data"), n), f)

    key = _struct(table, table.keys, now)
    return _canonical(
        headers.where(f"not ({BROKEN})"), table, key, F.when(F.lit(False), key), _struct(table, table.columns, now)
    )
