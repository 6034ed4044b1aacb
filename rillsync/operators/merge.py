"""Net changes: an ordered last-write-wins reduction by key, as one aggregation with map-side partial results."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def explode_events(changes: DataFrame) -> DataFrame:
    """Changes to events (key, kind: put or rm, tuple, del, s), of which a change gives one, and two where its key
    changed: the old key is removed before the new one is put."""
    moved = F.col("old_key").isNotNull() & (F.col("op") == "U")
    gone = F.struct(
        (F.col("seq") * 2).alias("s"), F.col("old_key").alias("key"), F.lit("rm").alias("kind"),
        F.when(F.lit(False), F.col("tuple")).alias("tuple"), F.lit(True).alias("del")
    )
    kind = F.when(F.col("op") == "D", "rm").otherwise("put")
    here = F.struct(
        (F.col("seq") * 2 + 1).alias("s"), F.col("key"), kind.alias("kind"), F.col("tuple"),
        ((F.col("op") == "D") | ((F.col("op") == "U") & ~moved)).alias("del")
    )
    return changes.select(F.inline(F.when(moved, F.array(gone, here)).otherwise(F.array(here))))


def compact(changes: DataFrame) -> DataFrame:
    """(key, kind, tuple, del, s) for each key touched: its last event, whether the delete set holds it, its order."""
    last = F.max_by(F.struct("kind", "tuple"), "s").alias("last")
    net = explode_events(changes).groupBy("key").agg(last, F.bool_or("del").alias("del"), F.max("s").alias("s"))
    return net.select("key", "last.kind", "last.tuple", "del", "s")


def delete_set(net: DataFrame) -> DataFrame:
    return net.where("del").select("key.*")


#: True of every row of compact(). A condition of both sets below, so that both need the same aggregates: the planner
#: then evaluates the changelog once and reuses its exchange.
_WHOLE = "kind is not null and del is not null and s is not null"


def upsert_set(net: DataFrame) -> DataFrame:
    return net.where(f"kind = 'put' and {_WHOLE}").select("tuple.*")


def touched(net: DataFrame) -> DataFrame:
    """Delete set and upsert keys together: what is taken out of the target before the upserts go in. These are all
    keys of net, since a key whose last event removes it is in the delete set."""
    return net.where(_WHOLE).select("key.*")
