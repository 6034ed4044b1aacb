"""Changelogs made from the driver's tables, as envelopes of records, and the SQL that gives the same changes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rillsync.operators import envelopes
from rillsync.sources.schema import TableSpec

ORDERS = TableSpec.of(
    "public.orders", "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_orderpriority string", "o_orderkey"
)
MOVED = 10_000_000

#: The same changes in SQL: (s, op, k, ok, c, st, p).
ORDERS_SQL = f"""
ch AS (
  SELECT o_orderkey*10 AS seq, 'I' AS op, o_orderkey AS k, CAST(NULL AS BIGINT) AS ok, o_custkey AS c, o_orderstatus AS st, o_orderpriority AS p FROM orders
  UNION ALL SELECT o_orderkey*10+1, 'U', o_orderkey, NULL, o_custkey, 'U', o_orderpriority FROM orders WHERE o_orderkey%3=0
  UNION ALL SELECT o_orderkey*10+2, 'U', o_orderkey+{MOVED}, o_orderkey, o_custkey, 'K', o_orderpriority FROM orders WHERE o_orderkey%7=0
  UNION ALL SELECT o_orderkey*10+3, 'D', CASE WHEN o_orderkey%7=0 THEN o_orderkey+{MOVED} ELSE o_orderkey END, NULL, o_custkey, o_orderstatus, o_orderpriority FROM orders WHERE o_orderkey%5=0
  UNION ALL SELECT o_orderkey*10+4, 'I', o_orderkey, NULL, o_custkey, 'R', o_orderpriority FROM orders WHERE o_orderkey%10=0),
ev AS (
  SELECT 2*seq AS s, ok AS k, 'rm' AS kind, TRUE AS del, c, st, p FROM ch WHERE op='U' AND ok IS NOT NULL
  UNION ALL SELECT 2*seq+1, k, CASE WHEN op='D' THEN 'rm' ELSE 'put' END, (op='D' OR (op='U' AND ok IS NULL)), c, st, p FROM ch),
net AS (
  SELECT * FROM (SELECT *, bool_or(del) OVER (PARTITION BY k) AS any_del, row_number() OVER (PARTITION BY k ORDER BY s DESC) AS rn FROM ev) WHERE rn=1)
"""


def orders_records(orders: DataFrame) -> DataFrame:
    """Insert, update, key change, delete and insert again over the orders, as Maxwell records (topic, partition,
    offset, value, seq)."""
    k, c, st, p = (F.col(x) for x in ("o_orderkey", "o_custkey", "o_orderstatus", "o_orderpriority"))
    moved = k + MOVED

    def change(step: int, kind: str, key, status, when, old=None):
        row = F.struct(
            key.alias("O_OrderKey"), c.alias("o_custkey"), status.alias("o_orderstatus"), p.alias("o_orderpriority")
        )
        before = F.struct(
            (old if old is not None else F.lit(None).cast("bigint")).alias("o_orderkey"),
            (F.lit("x") if kind == "update" else F.lit(None).cast("string")).alias("o_orderstatus")
        )
        doc = F.struct(
            F.lit("shop").alias("database"), F.lit("orders").alias("table"), F.lit(kind).alias("type"),
            (F.lit(1_500_000_000) + F.pmod(k, F.lit(1000))).alias("ts"), row.alias("data"),
            (
                before if kind == "update" else F.lit(None).cast("struct<o_orderkey:bigint,o_orderstatus:string>")
            ).alias("old")
        )
        return F.when(when, F.struct((k * 10 + step).alias("seq"), F.to_json(doc).alias("value")))

    now = F.when(k % 7 == 0, moved).otherwise(k)
    steps = F.array(
        change(0, "insert", k, st, F.lit(True)),
        change(1, "update", k, F.lit("U"), k % 3 == 0),
        change(2, "update", moved, F.lit("K"), k % 7 == 0, k),
        change(3, "delete", now, st, k % 5 == 0),
        change(4, "insert", k, F.lit("R"), k % 10 == 0),
    )
    made = orders.select(F.explode(F.array_compact(steps)).alias("m"))
    return made.select(
        F.lit("shop").alias("topic"), F.lit(0).alias("partition"), F.col("m.seq").alias("offset"),
        F.col("m.value").alias("value"), F.col("m.seq").alias("seq")
    )


def orders_changes(orders: DataFrame) -> DataFrame:
    heads = envelopes.maxwell_headers(orders_records(orders), "mysql")
    return envelopes.maxwell_changes(envelopes.routed(heads, {"mysql.shop.orders": "public.orders"}), ORDERS)
