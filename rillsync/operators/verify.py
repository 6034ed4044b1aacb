"""Whether source and target agree: ordered dumps, checksums and differences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rillsync.functions.decode import compared_cell


def rendered(df: DataFrame) -> Column:
    """A row as it is compared: its cells in the order of the columns' names, parted by tabs."""
    kinds = dict(df.dtypes)
    return F.concat_ws("\t", *[compared_cell(F.col(c), kinds[c]) for c in sorted(df.columns)])


def dump(df: DataFrame, keys: list[str]) -> DataFrame:
    """(line) of every row, in key order."""
    return df.orderBy(*keys).select(rendered(df).alias("line"))


def ordered_checksum(df: DataFrame, keys: list[str]) -> DataFrame:
    """MD5 of all rendered rows in key order. The rows meet in one task, so this is for small tables; checksum() is
    the one for large ones."""
    lines = F.sort_array(F.collect_list(F.struct(*keys, rendered(df).alias("line"))))
    return df.agg(
        F.md5(F.concat_ws("", F.transform(lines, lambda s: s["line"]))).alias("checksum"), F.count("*").alias("n_rows")
    )


def checksum(df: DataFrame) -> DataFrame:
    """An order-free checksum: sum and exclusive or of 60 bits of each rendered row's MD5, computed where it lies."""
    h = F.conv(F.substring(F.md5(rendered(df)), 1, 15), 16, 10).cast("bigint")
    return df.agg(
        F.sum(h.cast("decimal(38,0)")).alias("sum_hash"), F.bit_xor(h).alias("xor_hash"), F.count("*").alias("n_rows")
    )


def differences(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of one side without a counterpart, as many times as they lack one, marked by side."""
    columns = sorted(left.columns)
    a, b = left.select(*columns), right.select(*columns)
    return a.exceptAll(b).withColumn("side", F.lit("left")).union(b.exceptAll(a).withColumn("side", F.lit("right")))
