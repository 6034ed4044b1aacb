"""Target tables: columns, types and primary keys."""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


_TYPES = {
    t.simpleString(): t for t in (
        T.LongType(), T.IntegerType(), T.ShortType(), T.StringType(), T.BooleanType(), T.BinaryType(), T.DateType(),
        T.TimestampType(), T.TimestampNTZType(), T.FloatType(), T.DoubleType()
    )
}


def columns_of(ddl: str) -> T.StructType:
    """A schema of "name type, ..." without a session. Beside Spark's types: bit(n), a string of n bits; time(p), a
    clock string with p digits of fraction; timestamp(p) and timestamp_ntz(p), cut to p digits."""
    out = T.StructType()
    for part in re.split(r",(?![^(]*\))", ddl):
        name, kind = part.split(maxsplit=1)
        stem, *sizes = re.findall(r"\w+", kind)
        if stem == "decimal" and sizes:
            out.add(name, T.DecimalType(*map(int, sizes)))
        elif stem in ("bit", "time"):
            out.add(name, T.StringType(), True, {{"bit": "bits", "time": "time"}[stem]: int(sizes[0]) if sizes else 1})
        elif stem in _TYPES:
            out.add(name, _TYPES[stem], True, {"scale": int(sizes[0])} if sizes else None)
        else:
            raise ValueError(f"unknown type {kind.strip()} of column {name}")
    return out


@dataclass(frozen=True)
class TableSpec:
    """A target table. The target drives the projection: its columns, their order and their types. A bit column is a
    string field with metadata {"bits": width}, a time column one with {"time": digits of fraction}."""

    name: str
    schema: T.StructType
    keys: tuple[str, ...]

    def __post_init__(self) -> None:
        if not self.keys:
            raise ValueError(f"table {self.name} has no primary key")
        missing = [k for k in self.keys if k not in self.schema.fieldNames()]
        if missing:
            raise ValueError(f"table {self.name} has no column {', '.join(missing)}")

    @staticmethod
    def of(name: str, ddl: str, *keys: str) -> TableSpec:
        return TableSpec(name, columns_of(ddl), keys)

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()


def probe(df: DataFrame) -> T.StructType:
    """A relation's schema, as a query of no rows would tell it; nothing is read."""
    return df.where(F.lit(False)).schema


def existing(spark: SparkSession, names: list[str]) -> list[str]:
    return [n for n in names if spark.catalog.tableExists(n)]


def discover(spark: SparkSession, names: set[str], schemas: dict[str, str]) -> dict[str, TableSpec]:
    """The targets' tables: those in the catalog by their schema and the table property primaryKey, the others by
    their columns and "<table>.key" in `schemas`. A target without a key is an error."""
    found, keyed = {}, set()
    held = set(existing(spark, sorted(names)))
    for name in sorted(names):
        if name in held:
            shown = {r.key: r.value for r in spark.sql(f"SHOW TBLPROPERTIES {name}").collect()}
            schema, keys = probe(spark.table(name)), shown.get("primaryKey", "")
        elif name in schemas:
            schema, keys = columns_of(schemas[name]), schemas.get(f"{name}.key", "")
        else:
            raise ValueError(f"no table {name}")
        found[name] = schema, tuple(k.strip() for k in keys.split(",") if k.strip())
        if found[name][1]:
            keyed.add(name)
    require_keys(names, keyed)
    return {name: TableSpec(name, schema, keys) for name, (schema, keys) in found.items()}


def primary_keys(
    classes: DataFrame, attributes: DataFrame, namespaces: DataFrame, indexes: DataFrame, tables: list[str],
    namespace: str = "public"
) -> DataFrame:
    """Primary-key columns by table in key order, from catalog relations: classes (oid, relname, relnamespace),
    attributes (attrelid, attname, attnum), namespaces (oid, nspname), indexes (indrelid, indexrelid, indisprimary, indkey
    array). Rows (table_name, pk_name, key_seq, column_name)."""
    keyed = indexes.where("indisprimary").select(
        "indrelid", "indexrelid", F.posexplode("indkey").alias("pos", "attnum")
    )
    relation = classes.where(F.col("relname").isin(tables)).select(
        F.col("oid").alias("indrelid"), F.col("relname").alias("table_name"), "relnamespace"
    )
    space = namespaces.where(F.col("nspname") == namespace).select(F.col("oid").alias("relnamespace"))
    named = classes.select(F.col("oid").alias("indexrelid"), F.col("relname").alias("pk_name"))
    column = attributes.select(F.col("attrelid").alias("indrelid"), "attnum", F.col("attname").alias("column_name"))
    return keyed.join(relation, "indrelid").join(space, "relnamespace").join(named, "indexrelid").join(column, ["indrelid", "attnum"]).select("table_name", "pk_name", (F.col("pos") + 1).alias("key_seq"), "column_name").orderBy("table_name", "pk_name", "key_seq")


def keys_by_table(keys: DataFrame) -> DataFrame:
    """(table_name, columns): each table's key columns in key order, comma-joined."""
    ordered = F.sort_array(F.collect_list(F.struct("key_seq", "column_name")))
    return keys.groupBy("table_name").agg(
        F.concat_ws(",", F.transform(ordered, lambda s: s["column_name"])).alias("columns")
    )


def require_keys(mapped: set[str], keyed: set[str]) -> None:
    """Every mapped target needs a primary key; several sources may share one target."""
    if missing := sorted(mapped - keyed):
        raise ValueError(f"no primary key for {', '.join(missing)}")
