"""The driver's queries over the synchroniser's operators, each beside the SQL that gives the same rows."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rillsync.functions import decode as D
from rillsync.operators import apply as A
from rillsync.operators import envelopes as E
from rillsync.operators import merge as M
from rillsync.operators import verify as V
from rillsync.plans.changelogs import ORDERS, ORDERS_SQL, orders_changes, orders_records
from rillsync.sources import schema as S
from rillsync.sources import transport as R
from rillsync.sources.config import Config, SourceConfig
from rillsync.sources.schema import TableSpec
from rillsync.sources.scratch import materialize, scratch_root
from rillsync.streaming.runner import Synchroniser
from rillsync.streaming.state import State

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def keep(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return keep


def _t(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def _net(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.compact(orders_changes(_t(spark, sf_dir, "orders")))


def _known_net(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The net changes, computed once for the operators that read them more than once."""
    return materialize(_net(spark, sf_dir), "net")


def _orders_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the target holds before the changes: every other order."""
    return _t(spark, sf_dir, "orders").where("o_orderkey % 2 = 0").select(*ORDERS.columns)


_LIVE = "SELECT k AS o_orderkey, c AS o_custkey, st AS o_orderstatus, p AS o_orderpriority FROM net WHERE kind='put'"
_TARGET = "SELECT o_orderkey, o_custkey, o_orderstatus, o_orderpriority FROM orders WHERE o_orderkey%2=0"
_APPLIED = (
    f"WITH {ORDERS_SQL} {_TARGET} AND NOT EXISTS (SELECT 1 FROM net WHERE net.k=orders.o_orderkey AND "
    f"(net.any_del OR net.kind='put')) UNION ALL {_LIVE}"
)


@query(f"WITH {ORDERS_SQL} SELECT k AS o_orderkey, kind, any_del AS del, s FROM net")
def cdc_net_changes_orders(spark, sf_dir):
    return _net(spark, sf_dir).select("key.o_orderkey", "kind", "del", "s")


@query(f"WITH {ORDERS_SQL} SELECT k AS o_orderkey FROM net WHERE any_del")
def cdc_delete_set_orders(spark, sf_dir):
    return M.delete_set(_net(spark, sf_dir))


@query(f"WITH {ORDERS_SQL} {_LIVE}")
def cdc_upsert_set_orders(spark, sf_dir):
    return M.upsert_set(_net(spark, sf_dir))


@query(_APPLIED)
def cdc_apply_orders(spark, sf_dir):
    return A.apply_net(_orders_target(spark, sf_dir), _known_net(spark, sf_dir), ["o_orderkey"])


@query(_APPLIED)
def replay_idempotent(spark, sf_dir):
    net = _known_net(spark, sf_dir)
    once = A.apply_net(_orders_target(spark, sf_dir), net, ["o_orderkey"])
    return A.apply_net(once, net, ["o_orderkey"])


@query(_APPLIED)
def optimistic_apply_orders(spark, sf_dir):
    net, target = _known_net(spark, sf_dir), _orders_target(spark, sf_dir)
    return target.join(
        A.optimistic_keys(net, target, ["o_orderkey"]), "o_orderkey", "left_anti"
    ).unionByName(M.upsert_set(net))


@query(
    f"WITH {ORDERS_SQL} SELECT seq, op, k AS o_orderkey, CASE WHEN ok IS DISTINCT "
    f"FROM k THEN ok END AS old_key FROM ch WHERE op='U'"
)
def cdc_key_change_orders(spark, sf_dir):
    return orders_changes(_t(spark, sf_dir, "orders")).where("op = 'U'").select(
        "seq", "op", "key.o_orderkey", F.col("old_key.o_orderkey").alias("old_key")
    )


@query("SELECT o_orderkey, (1500000000 + o_orderkey%1000)*1000 AS produced_ms FROM orders")
def produced_times(spark, sf_dir):
    """Envelope times in seconds as milliseconds, of the first change of each order."""
    return orders_changes(_t(spark, sf_dir, "orders")).where("seq % 10 = 0").select("key.o_orderkey", "produced_ms")


@query(
    "SELECT user_id, event_type, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY "
    "event_id DESC) AS rn FROM events) WHERE rn=1 AND event_type<>'error'"
)
def cdc_latest_state_events(spark, sf_dir):
    return M.upsert_set(M.compact(_event_changes(_t(spark, sf_dir, "events"))))


def _event_changes(events: DataFrame) -> DataFrame:
    key = F.struct("user_id")
    op = F.when(F.col("event_type") == "signup", "I").when(F.col("event_type") == "error", "D").otherwise("U")
    return events.select(
        F.col("event_id").alias("seq"), op.alias("op"), key.alias("key"),
        F.lit(None).cast("struct<user_id:bigint>").alias("old_key"),
        F.struct("user_id", "event_type", "event_id").alias("tuple")
    )


@query(
    "SELECT c_custkey, c_name, c_nationkey, c_mktsegment, CAST(c_nationkey%2=0 AS BOOLEAN) AS flag, "
    "hex(encode(c_name)) AS raw, lpad(bin(c_nationkey), 7, '0') AS bits FROM customer"
)
def maxwell_parse_customer(spark, sf_dir):
    c = _t(spark, sf_dir, "customer")
    fields = [
        ("c_custkey", "bigint"), ("c_name", "string"), ("c_nationkey", "int"), ("c_mktsegment", "string"),
        ("flag", "boolean"), ("raw", "binary")
    ]
    schema = S.columns_of(", ".join(f"{n} {t}" for n, t in fields)).add(
        T.StructField("bits", T.StringType(), True, {"bits": 7})
    )
    spec = TableSpec("public.customer", schema, ("c_custkey",))
    row = F.struct(
        F.col("c_custkey").alias("C_CUSTKEY"), "c_name", "c_nationkey", "c_mktsegment",
        (F.col("c_nationkey") % 2 == 0).cast("int").alias("flag"), F.base64(F.encode("c_name", "UTF-8")).alias("raw"),
        F.col("c_nationkey").alias("bits"), F.lit("unused").alias("not_in_target")
    )
    doc = F.to_json(
        F.struct(
            F.lit("shop").alias("database"), F.lit("customer").alias("table"), F.lit("insert").alias("type"),
            F.lit(1).alias("ts"), row.alias("data")
        )
    )
    records = c.select(
        F.lit("t").alias("topic"), F.lit(0).alias("partition"), F.col("c_custkey").alias("offset"), doc.alias("value"),
        F.col("c_custkey").alias("seq")
    )
    changes = E.maxwell_changes(E.routed(E.maxwell_headers(records, "m"), {"m.shop.customer": "public.customer"}), spec)
    return changes.select("tuple.*").withColumn("raw", F.hex("raw"))


@query(
    "SELECT p_partkey, CASE WHEN p_partkey%5=4 THEN 'D' WHEN p_partkey%5=3 THEN 'U' ELSE 'I' END AS op, CASE "
    "WHEN p_partkey%5<>4 THEN p_name END AS p_name, CASE WHEN p_partkey%5<>4 THEN p_size END AS p_size "
    "FROM part WHERE p_partkey%5<>0"
)
def debezium_parse_part(spark, sf_dir):
    p = _t(spark, sf_dir, "part")
    kind, row = F.pmod("p_partkey", F.lit(5)), F.struct("p_partkey", "p_name", "p_size")
    op = F.when(kind == 1, "r").when(kind == 2, "c").when(kind == 3, "u").otherwise("d")
    body = F.struct(
        op.alias("op"), F.lit(1).alias("ts_ms"), F.when(kind == 4, row).alias("before"),
        F.when(kind != 4, row).alias("after")
    )
    value = F.when(kind != 0, F.to_json(F.struct(body.alias("payload")))).otherwise(
        F.when(F.col("p_partkey") % 2 == 0, F.lit('{"payload":null}'))
    )
    records = p.select(
        F.lit("pg.public.part").alias("topic"), F.lit(0).alias("partition"), F.col("p_partkey").alias("offset"),
        value.alias("value"), F.col("p_partkey").alias("seq")
    )
    spec = TableSpec.of("public.part", "p_partkey bigint, p_name string, p_size int", "p_partkey")
    changes = E.debezium_changes(
        E.routed(E.debezium_headers(R.one_partition_each(records), "pg"), {"pg.public.part": "public.part"}), spec
    )
    return changes.select("key.p_partkey", "op", "tuple.p_name", "tuple.p_size")


_MIXED = {"m.shop.nation": "public.nation", "m.shop.region": "public.region"}


def _mixed(spark, sf_dir):
    parts = []
    for table, key in (("nation", "n_nationkey"), ("region", "r_regionkey"), ("supplier", "s_suppkey")):
        doc = F.to_json(
            F.struct(
                F.lit("shop").alias("database"), F.lit(table).alias("table"), F.lit("insert").alias("type"),
                F.lit(7).alias("ts"), F.struct(F.col(key)).alias("data")
            )
        )
        parts.append(
            _t(spark, sf_dir, table).select(
                F.lit("t").alias("topic"), F.lit(0).alias("partition"), F.col(key).cast("bigint").alias("offset"),
                doc.alias("value"), F.col(key).cast("bigint").alias("seq")
            )
        )
    return E.maxwell_headers(parts[0].unionByName(parts[1]).unionByName(parts[2]), "m")


@query(
    "SELECT 'public.nation' AS target, count(*) AS n FROM nation UNION ALL SELECT 'public.region', count(*) FROM region"
)
def table_filter_route(spark, sf_dir):
    return E.routed(_mixed(spark, sf_dir), _MIXED).groupBy("target").agg(F.count("*").alias("n"))


@query(
    "SELECT p_partkey, CASE WHEN length(bin(p_size))>=5 THEN bin(p_size) ELSE lpad(bin(p_size), 5, '0') END AS "
    "bits FROM part"
)
def decode_bit(spark, sf_dir):
    return _t(spark, sf_dir, "part").select("p_partkey", D.bits_of_int(F.col("p_size"), 5).alias("bits"))


@query("SELECT p_partkey, right(lpad(bin(p_size + 256*(p_partkey%100)), 16, '0'), 15) AS bits FROM part")
def decode_bit_base64(spark, sf_dir):
    low, high = F.col("p_size"), F.pmod("p_partkey", F.lit(100))
    text = F.base64(F.unhex(F.concat(*[F.lpad(F.hex(x.cast("bigint")), 2, "0") for x in (low, high)])))
    return _t(spark, sf_dir, "part").select("p_partkey", D.bits_of_base64(text, 15).alias("bits"))


@query("SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS day FROM orders")
def decode_date_days(spark, sf_dir):
    return _t(spark, sf_dir, "orders").select(
        "o_orderkey", D.date_of_days(F.unix_date(F.col("o_orderdate").cast("date"))).cast("string").alias("day")
    )


@query(
    "SELECT event_id, epoch_us(ts) AS micros, strftime(ts, '%H:%M:%S') AS clock, epoch_us(ts - INTERVAL 60 "
    "YEAR) AS early FROM events"
)
def decode_ts_nanos(spark, sf_dir):
    def nanos(t):
        return F.unix_micros(t.cast("timestamp")) * F.lit(1000) + F.lit(999)

    ts = F.col("ts")
    early = nanos(ts - F.expr("INTERVAL 60 YEAR"))
    return _t(spark, sf_dir, "events").select(
        "event_id", F.unix_micros(D.timestamp_of_nanos(nanos(ts))).alias("micros"),
        D.time_of_nanos(nanos(ts)).alias("clock"), F.unix_micros(D.timestamp_of_nanos(early)).alias("early")
    )


@query(
    "SELECT l_orderkey, l_partkey, l_suppkey, l_linenumber, CAST(CAST(CASE WHEN l_linenumber%2=0 THEN -1 ELSE "
    "1 END * CAST(round(l_extendedprice*100) AS BIGINT) AS DECIMAL(18,0)) * CAST(0.01 AS DECIMAL(3,2)) AS "
    "VARCHAR) AS price FROM lineitem"
)
def decode_decimal_base64(spark, sf_dir):
    cents = F.round(F.col("l_extendedprice") * 100).cast("bigint") * F.when(
        F.col("l_linenumber") % 2 == 0, -1
    ).otherwise(1)
    text = F.base64(F.unhex(F.lpad(F.hex(cents), 16, "0")))
    return _t(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber",
        D.decimal_of_base64(text, 18, 2).cast("string").alias("price")
    )


@query(
    "SELECT r_regionkey, hex(encode(r_name)) AS raw, replace(r_name, '\\', '\\\\') || '\\000\\377' AS octal FROM region"
)
def decode_binary_hex(spark, sf_dir):
    raw = D.binary_of_base64(F.base64(F.encode("r_name", "UTF-8")))
    more = F.unhex(F.concat(F.hex(raw), F.lit("00FF")))
    return _t(spark, sf_dir, "region").select("r_regionkey", F.hex(raw).alias("raw"), D.octal_text(more).alias("octal"))


@query(
    """SELECT doc_id, md5('"' || replace(replace(text, '\\', '\\\\'), '"', '\\"') || '"') AS cell_md5 FROM documents"""
)
def escape_csv_documents(spark, sf_dir):
    return _t(spark, sf_dir, "documents").select("doc_id", F.md5(D.quoted_text(F.col("text"))).alias("cell_md5"))


@query(
    """SELECT n_nationkey, CAST(n_nationkey AS VARCHAR) || '|"' || n_name || '"|' || CASE WHEN n_regionkey=0 THEN '' ELSE CAST(n_regionkey AS VARCHAR) END AS line FROM nation"""
)
def csv_tuple_render(spark, sf_dir):
    n = _t(spark, sf_dir, "nation").withColumn("r", F.when(F.col("n_regionkey") != 0, F.col("n_regionkey")))
    return n.select(
        "n_nationkey",
        F.concat_ws(
            "|", *[D.load_cell(F.col(c), k) for c, k in (("n_nationkey", "int"), ("n_name", "string"), ("r", "int"))]
        ).alias("line")
    )


@query(
    f"WITH {ORDERS_SQL} SELECT count(*) AS n_affected FROM orders WHERE o_orderkey%2=0 AND EXISTS (SELECT 1 "
    f"FROM net WHERE net.k=o_orderkey AND any_del)"
)
def semi_join_affected(spark, sf_dir):
    keys = M.delete_set(_net(spark, sf_dir))
    return A.affected(_orders_target(spark, sf_dir), keys, ["o_orderkey"]).agg(F.count("*").alias("n_affected"))


_CATALOG = {
    "classes": (
        "oid long, relname string, relnamespace long",
        [(1, "orders", 9), (2, "lineitem", 9), (3, "orders_pkey", 9), (4, "lineitem_pkey", 9), (5, "lineitem_idx", 9)]
    ),
    "attributes": (
        "attrelid long, attname string, attnum int",
        [(1, "o_orderkey", 1), (1, "o_custkey", 2), (2, "l_orderkey", 1), (2, "l_partkey", 2), (2, "l_linenumber", 4)]
    ),
    "namespaces": ("oid long, nspname string", [(9, "public"), (8, "other")]),
    "indexes": (
        "indrelid long, indexrelid long, indisprimary boolean, indkey array<int>",
        [(1, 3, True, [1]), (2, 4, True, [4, 1]), (2, 5, False, [2])]
    ),
}


@query(
    """SELECT * FROM (VALUES ('lineitem', 'lineitem_pkey', 1, 'l_linenumber'), ('lineitem', 'lineitem_pkey', 2, 'l_orderkey'), ('orders', 'orders_pkey', 1, 'o_orderkey')) AS t(table_name, pk_name, key_seq, column_name)"""
)
def pk_discovery(spark, sf_dir):
    frames = [spark.createDataFrame(rows, ddl) for ddl, rows in _CATALOG.values()]
    return S.primary_keys(*frames, ["orders", "lineitem"])


@query(
    "SELECT * FROM (VALUES ('lineitem', 'l_linenumber,l_orderkey'), ('orders', 'o_orderkey')) AS t(table_name, columns)"
)
def pk_columns_by_table(spark, sf_dir):
    return S.keys_by_table(pk_discovery(spark, sf_dir))


@query("SELECT * FROM region WHERE 1=2")
def schema_probe(spark, sf_dir):
    region = _t(spark, sf_dir, "region")
    return spark.createDataFrame([], S.probe(region))


@query("SELECT * FROM region LIMIT 0")
def limit_zero(spark, sf_dir):
    return _t(spark, sf_dir, "region").limit(0)


@query(_APPLIED)
def micro_batch_windows(spark, sf_dir):
    """Four batches by range of order, each compacted by itself and applied in turn."""
    changes, target = orders_changes(_t(spark, sf_dir, "orders")), _orders_target(spark, sf_dir)
    changes = materialize(changes, "changes")
    for i in range(4):
        net = M.compact(changes.where(F.pmod(F.floor(F.col("seq") / 10), F.lit(4)) == i))
        target = A.apply_net(target, net, ["o_orderkey"])
    return target


@query(
    "SELECT 'events' AS topic, CAST(event_id%4 AS INTEGER) AS partition, max(event_id)+1 AS next_offset "
    "FROM events GROUP BY 2"
)
def offset_high_water(spark, sf_dir):
    records = _t(spark, sf_dir, "events").select(
        F.lit("events").alias("topic"), (F.col("event_id") % 4).cast("int").alias("partition"),
        F.col("event_id").alias("offset")
    )
    return R.high_water(records)


@query("SELECT event_type AS source, count(*) AS n, max(epoch_us(ts)) AS latest FROM events GROUP BY 1")
def newest_record(spark, sf_dir):
    e = _t(spark, sf_dir, "events")
    return e.groupBy(F.col("event_type").alias("source")).agg(
        F.count("*").alias("n"), F.max(F.unix_micros(F.col("ts").cast("timestamp"))).alias("latest")
    )


@query(
    "SELECT event_type AS source_name, strftime(max(ts), '%Y-%m-%dT%H:%M:%S.') || lpad(CAST((max(epoch_us(ts)) "
    "// 1000) % 1000 AS VARCHAR), 3, '0') || 'Z' AS latest FROM events GROUP BY 1"
)
def pipeline_state(spark, sf_dir):
    """What the state endpoint tells: the latest change of each source, one row each."""
    found = newest_record(spark, sf_dir).collect()
    state = State()
    for r in found:
        state.done(r.source, "maxwell", 0, r.n, r.latest // 1000)
    return state.frame(spark).select("source_name", "latest")


def _records(rows: DataFrame, offset, topic: str, value) -> DataFrame:
    return rows.select(
        F.lit(topic).alias("topic"), F.lit(0).alias("partition"), F.col(offset).cast("bigint").alias("offset"), value.alias("value")
    )


def _maxwell(table: str, kind, row, ts: int = 7):
    doc = F.struct(
        F.lit("shop").alias("database"), F.lit(table).alias("table"), kind.alias("type"), F.lit(ts).alias("ts"),
        row.alias("data")
    )
    return F.to_json(doc)


def _store_root(spark: SparkSession) -> str:
    return f"{scratch_root(spark)}/store-{uuid.uuid4().hex}"


@query(
    "SELECT 'public.nation' AS target, count(DISTINCT n_nationkey%4) AS n_batches, count(*) AS n_rows FROM nation "
    "UNION ALL SELECT 'public.region', count(DISTINCT r_regionkey%4), count(*) FROM region"
)
def loader_barrier(spark, sf_dir):
    """Four batches into two targets side by side; a batch ends when each target has it. Batches and rows by target."""
    parts = []
    for table, key in (("nation", "n_nationkey"), ("region", "r_regionkey")):
        parts.append(
            _records(_t(spark, sf_dir, table), key, "t", _maxwell(table, F.lit("insert"), F.struct(F.col(key))))
        )
    records = parts[0].unionByName(parts[1])
    specs = {
        f"public.{t}": TableSpec.of(f"public.{t}", f"{k} int", k) for t,
        k in (("nation", "n_nationkey"), ("region", "r_regionkey"))
    }
    sync = Synchroniser(spark, _store_root(spark), "m", "maxwell", _MIXED, specs, loaders=2)
    for number in range(4):
        sync.batch(records.where(F.col("offset") % 4 == number), number)
    rows = [(t, x["batches"], sync.stores[t].current().count()) for t, x in sync.state.sources["m"]["tables"].items()]
    return spark.createDataFrame(rows, "target string, n_batches long, n_rows long")


@query(
    "SELECT 'crm.customer' AS source, c_custkey AS id, c_name AS name FROM customer "
    "UNION ALL SELECT 'erp.supplier', s_suppkey, s_name FROM supplier"
)
def source_union(spark, sf_dir):
    """Two sources of unlike kinds, many to one: both streams' batches end in one target."""
    spec = TableSpec.of("public.party", "source string, id bigint, name string", "source", "id")
    crm_row = F.struct(
        F.lit("crm.customer").alias("source"), F.col("c_custkey").alias("id"), F.col("c_name").alias("name")
    )
    crm = _records(_t(spark, sf_dir, "customer"), "c_custkey", "crm", _maxwell("customer", F.lit("insert"), crm_row))
    erp_row = F.struct(
        F.col("s_name").alias("NAME"), F.lit("erp.supplier").alias("source"), F.col("s_suppkey").alias("id")
    )
    body = F.struct(F.lit("c").alias("op"), F.lit(1).alias("ts_ms"), erp_row.alias("after"))
    erp = _records(
        _t(spark, sf_dir, "supplier"), "s_suppkey", "ns.public.supplier", F.to_json(F.struct(body.alias("payload")))
    )
    root, targets = _store_root(spark), {"public.party": spec}
    first = Synchroniser(spark, root, "crm", "maxwell", {"crm.shop.customer": "public.party"}, targets)
    second = Synchroniser(
        spark, root, "erp", "debezium", {"erp.public.supplier": "public.party"}, targets, stores=first.stores
    )
    first.batch(crm, 0)
    second.batch(erp, 0)
    return first.stores["public.party"].current()


@query(
    "SELECT 'maxwell' AS kind, s_suppkey AS bad FROM supplier WHERE s_suppkey%6 IN (1,2,3) "
    "UNION ALL SELECT 'debezium', s_suppkey FROM supplier WHERE s_suppkey%6 IN (1,2,3)"
)
def malformed_quarantine(spark, sf_dir):
    """Offsets set aside: cut-off and foreign text and unknown kinds; not null messages, nor tables not mapped."""
    rows = _t(spark, sf_dir, "supplier")
    case, row = F.col("s_suppkey") % 6, F.struct("s_suppkey")

    def values(good, unknown, other):
        cut = F.substr(good, F.lit(1), F.length(good) - 9)
        return F.when(case == 0, good).when(case == 1, cut).when(
            case == 2, "not json"
        ).when(case == 3, unknown).when(case == 4, other)

    def payload(op: str):
        body = F.struct(F.lit(op).alias("op"), F.lit(1).alias("ts_ms"), row.alias("after"))
        return F.to_json(F.struct(body.alias("payload")))

    shop = values(
        _maxwell("supplier", F.lit("insert"), row), _maxwell("supplier", F.lit("drop"), row),
        _maxwell("x", F.lit("insert"), row)
    )
    pg = values(payload("c"), payload("x"), F.lit('{"payload":null}'))
    found = []
    for kind, heads, topic, value in (
        ("maxwell", E.maxwell_headers, "t", shop),
        ("debezium", E.debezium_headers, "ns.shop.supplier", pg),
    ):
        records = _records(rows, "s_suppkey", topic, value)
        bad = E.broken(E.routed(heads(records, "m"), {"m.shop.supplier": "public.supplier"}))
        found.append(bad.select(F.lit(kind).alias("kind"), F.col("offset").alias("bad")))
    return found[0].unionByName(found[1])


@query(
    "SELECT md5(string_agg(n_name || chr(9) || n_nationkey || chr(9) || n_regionkey, '' ORDER BY n_nationkey)) "
    "AS checksum, count(*) AS n_rows FROM nation"
)
def table_checksum(spark, sf_dir):
    return V.ordered_checksum(_t(spark, sf_dir, "nation"), ["n_nationkey"])


_LINE = "concat_ws(chr(9), o_custkey, o_orderdate, o_orderkey, o_orderpriority, o_orderstatus, o_totalprice)"
_DIGEST = f"CAST('0x' || substr(md5({_LINE}), 1, 15) AS BIGINT)"


@query(
    f"SELECT CAST(sum({_DIGEST}) AS VARCHAR) AS sum_hash, bit_xor({_DIGEST}) AS xor_hash, count(*) AS n_rows "
    f"FROM orders"
)
def table_checksum_large(spark, sf_dir):
    return V.checksum(_t(spark, sf_dir, "orders")).withColumn("sum_hash", F.col("sum_hash").cast("string"))


_ONE = (
    "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, CAST(o_orderdate AS VARCHAR) AS o_orderdate, "
    "o_orderpriority FROM orders"
)
_TWO = (
    f"SELECT * REPLACE (CASE WHEN o_orderkey%50=0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus) "
    f"FROM ({_ONE}) WHERE o_orderkey%70<>0"
)


@query(
    f"(SELECT *, 'left' AS side FROM ({_ONE} EXCEPT ALL {_TWO})) UNION ALL (SELECT *, 'right' "
    f"FROM ({_TWO} EXCEPT ALL {_ONE}))"
)
def table_diff(spark, sf_dir):
    o = _t(spark, sf_dir, "orders").withColumn("o_orderdate", F.col("o_orderdate").cast("string"))
    other = o.where("o_orderkey % 70 <> 0").withColumn(
        "o_orderstatus", F.when(F.col("o_orderkey") % 50 == 0, "X").otherwise(F.col("o_orderstatus"))
    )
    return V.differences(o, other)


@query("SELECT concat_ws(chr(9), s_acctbal, s_name, s_nationkey, s_suppkey) AS line FROM supplier ORDER BY s_suppkey")
def dump_ordered(spark, sf_dir):
    return V.dump(_t(spark, sf_dir, "supplier"), ["s_suppkey"])


@query(
    "SELECT avg(l_linenumber) AS avg_linenumber, avg(l_partkey) AS avg_partkey, avg(l_suppkey) AS avg_suppkey "
    "FROM lineitem"
)
def avg_int_columns(spark, sf_dir):
    return _t(spark, sf_dir, "lineitem").agg(
        *[F.avg(f"l_{c}").alias(f"avg_{c}") for c in ("linenumber", "partkey", "suppkey")]
    )


_MAPPED = Config(
    [
        SourceConfig(
            "m", "maxwell", "h:1", "t", None, "g", tables={"shop.orders": "orders", "shop.lineitem": "lineitem"}
        ),
        SourceConfig("p", "debezium", "h:1", None, "ns", "g", tables={"crm.orders": "orders"}),
    ]
)


@query(
    "SELECT count(DISTINCT t) AS n_targets, least(10, count(DISTINCT t)) AS n_loaders "
    "FROM (VALUES ('orders'), ('lineitem'), ('orders')) AS x(t)"
)
def distinct_targets(spark, sf_dir):
    return spark.createDataFrame([(len(_MAPPED.targets()), _MAPPED.loaders())], "n_targets long, n_loaders long")


@query("SELECT 2 AS n_keyed, 2 AS n_mapped, TRUE AS complete")
def pk_size_check(spark, sf_dir):
    """The keys that the catalog gives, against the targets that the configuration maps; an error where one lacks."""
    keyed = {r.table_name for r in pk_columns_by_table(spark, sf_dir).select("table_name").collect()}
    S.require_keys(_MAPPED.targets(), keyed)
    return spark.createDataFrame(
        [(len(keyed), len(_MAPPED.targets()), keyed == _MAPPED.targets())],
        "n_keyed int, n_mapped int, complete boolean"
    )


_FOUR = "l_orderkey, l_partkey, l_suppkey, l_linenumber"


@query(f"""
WITH late AS (
  SELECT {_FOUR}, l_returnflag, l_linestatus FROM (SELECT *, row_number() OVER (PARTITION BY {_FOUR} ORDER BY epoch_us(l_shipdate) DESC, l_returnflag DESC) AS rn
  FROM lineitem WHERE l_linestatus IS NOT NULL AND l_orderkey%3=0) WHERE rn=1)
SELECT {_FOUR}, 'T' AS l_returnflag FROM (SELECT DISTINCT {_FOUR} FROM lineitem WHERE l_orderkey%2=0) AS t
WHERE NOT EXISTS (SELECT 1 FROM late WHERE late.l_orderkey=t.l_orderkey AND late.l_partkey=t.l_partkey AND late.l_suppkey=t.l_suppkey AND late.l_linenumber=t.l_linenumber)
UNION ALL SELECT {_FOUR}, l_returnflag FROM late WHERE l_linestatus<>'F'
""")
def composite_key_merge(spark, sf_dir):
    """Changes of every third order, compacted by four key columns and applied to a target that holds every other."""
    keys = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber"]
    items = _t(spark, sf_dir, "lineitem")
    target = items.where("l_orderkey % 2 = 0").select(*keys).distinct().withColumn("l_returnflag", F.lit("T"))
    li = items.where("l_linestatus is not null and l_orderkey % 3 = 0")
    op = F.when(F.col("l_linestatus") == "F", "D").otherwise("U")
    key = F.struct(*keys)
    seq = F.unix_micros(F.col("l_shipdate").cast("timestamp")) * 256 + F.ascii("l_returnflag")
    old_key = F.when(F.lit(False), key).alias("old_key")
    changes = li.select(
        seq.alias("seq"), op.alias("op"), key.alias("key"), old_key, F.struct(*keys, "l_returnflag").alias("tuple")
    )
    return A.apply_net(target, M.compact(changes), keys)


@query(
    "SELECT user_id, event_type, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY "
    "event_id DESC) AS rn FROM events) WHERE rn=1 AND event_type<>'error'"
)
def streaming_sync_events(spark, sf_dir):
    """A real stream over files of records, in micro-batches, into a snapshot store that is read back."""
    root = _store_root(spark)
    events = _t(spark, sf_dir, "events")
    kind = F.when(
        F.col("event_type") == "signup", "insert"
    ).when(F.col("event_type") == "error", "delete").otherwise("update")
    doc = F.struct(
        F.lit("app").alias("database"), F.lit("users").alias("table"), kind.alias("type"),
        F.unix_seconds(F.col("ts").cast("timestamp")).alias("ts"),
        F.struct("user_id", "event_type", "event_id").alias("data")
    )
    records = events.select(
        F.lit("app").alias("topic"), F.lit(0).alias("partition"), F.col("event_id").alias("offset"),
        F.to_json(doc).alias("value")
    )
    records.repartitionByRange(4, "offset").write.mode("overwrite").json(f"{root}/in")
    spec = TableSpec.of("public.users", "user_id bigint, event_type string, event_id bigint", "user_id")
    sync = Synchroniser(
        spark, f"{root}/out", "app", "maxwell", {"app.app.users": "public.users"}, {"public.users": spec}
    )
    run = sync.start(R.json_stream(spark, f"{root}/in", files_per_batch=2), f"{root}/checkpoint")
    run.awaitTermination()
    return sync.stores["public.users"].current()


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
