"""Decoding of both envelopes, with the typed fixtures, and the configuration."""

import base64
import json
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rillsync.functions import decode as D
from rillsync.operators import envelopes as E
from rillsync.sources import config as C
from rillsync.sources.schema import TableSpec
from rillsync.streaming.state import State

SCHEMA = T.StructType(
    [
        T.StructField("id", T.IntegerType()), T.StructField("alpha", T.BinaryType()),
        T.StructField("beta", T.BooleanType()), T.StructField("gamma", T.StringType(), True, {"bits": 15}),
        T.StructField("n", T.DecimalType(5, 2)), T.StructField("d", T.DateType()), T.StructField("s", T.StringType())
    ]
)
SPEC = TableSpec("public.b", SCHEMA, ("id",))
B64 = base64.b64encode


def rows(spark, values):
    return spark.createDataFrame(
        [("db.public.b", 0, i, v, i) for i, v in enumerate(values)],
        "topic string, partition int, offset long, value string, seq long"
    )


def test_maxwell(spark):
    data = {
        "id": 1, "ALPHA": B64(bytes.fromhex("1A1B1C3D1F")).decode(), "beta": 0, "gamma": 24812, "n": 10.10,
        "d": "2017-09-18", "s": 'a"\\ \n'
    }
    values = [
        json.dumps({"database": "d", "table": "b", "type": t, "ts": 5, "data": data | x, "old": o}) for t, x,
        o in (
            ("insert", {}, None), ("update", {"id": 2, "s": ""}, {"id": 1}), ("update", {"s": None}, {"s": "x"}),
            ("delete", {}, None), ("truncate", {}, None)
        )
    ]
    values += [json.dumps({"database": "d", "table": "other", "type": "insert", "ts": 1, "data": {}}), "not json", None]
    heads = E.routed(E.maxwell_headers(rows(spark, values), "m"), {"m.d.b": "public.b"})
    assert sorted(r.value for r in E.broken(heads).collect()) == sorted([values[4], "not json"])
    got = E.maxwell_changes(heads, SPEC).orderBy("seq").collect()
    assert [r.op for r in got] == ["I", "U", "U", "D"]
    t = got[0].tuple
    assert (bytes(t.alpha), t.beta, t.gamma, t.n, str(t.d), t.s) == (
        bytes.fromhex("1A1B1C3D1F"), False, "110000011101100", Decimal("10.10"), "2017-09-18", 'a"\\ \n'
    )
    assert got[0].produced_ms == 5000 and got[1].old_key.id == 1 and got[1].tuple.s == "" and got[2].old_key is None and got[2].tuple.s is None and got[3].tuple is None


def test_debezium(spark):
    row = {
        "id": 1, "alpha": B64(b"\x00\xff").decode(), "beta": True, "gamma": "7GA=", "n": "A/I=", "d": 17427,
        "s": "x\x00y"
    }
    values = [
        json.dumps(
            {"payload": {"op": o, "ts_ms": 9, "before": row if o == "d" else None, "after": None if o == "d" else row}}
        ) for o in "rcud"
    ] + ['{"payload":null}', None]
    heads = E.routed(E.debezium_headers(rows(spark, values), "p"), {"p.public.b": "public.b"})
    got = E.debezium_changes(heads, SPEC).orderBy("seq").collect()
    assert [r.op for r in got] == ["I", "I", "U", "D"]
    t = got[0].tuple
    assert (bytes(t.alpha), t.beta, t.gamma, t.n, str(t.d), t.s) == (
        b"\x00\xff", True, "110000011101100", Decimal("10.10"), "2017-09-18", "xy"
    )


def test_malformed_records_are_set_aside(spark):
    good = json.dumps({"database": "d", "table": "b", "type": "insert", "ts": 1, "data": {"id": 1}})
    shop = [good, good[:-9], "not json", "", "[]", '"x"', "{}", None, good.replace('"ts": 1', '"ts": "x"')]
    shop += [good.replace('"data": {"id": 1}', '"data": 5'), good.replace('"table": "b"', '"table": "other"')]
    heads = E.routed(E.maxwell_headers(rows(spark, shop), "m"), {"m.d.b": "public.b"})
    assert sorted(r.offset for r in E.broken(heads).collect()) == [1, 2, 3, 4, 5, 6, 8, 9]
    assert [r.offset for r in heads.where("target = 'public.b' and op is not null").collect()] == [0]
    good = json.dumps({"payload": {"op": "c", "ts_ms": 9, "before": None, "after": {"id": 1}}})
    pg = [good, good[:-9], "not json", "", '{"payload":null}', "{}", None, '{"payload":5}', good.replace('"c"', '"x"')]
    heads = E.routed(E.debezium_headers(rows(spark, pg), "p"), {"p.public.b": "public.b"})
    assert sorted(r.offset for r in E.broken(heads).collect()) == [1, 2, 3, 5, 7, 8]
    assert [r.offset for r in heads.where("op is not null").collect()] == [0]


def test_missing_column_is_an_error(spark):
    heads = E.routed(
        E.maxwell_headers(
            rows(spark, [json.dumps({"database": "d", "table": "b", "type": "insert", "ts": 1, "data": {"id": 1}})]),
            "m"
        ),
        {"m.d.b": "public.b"}
    )
    with pytest.raises(Exception, match="no member"):
        E.maxwell_changes(heads, SPEC).collect()


def test_scalar_edges(spark):
    one = spark.range(1)
    value = lambda c: one.select(c.alias("x")).first().x
    assert value(D.time_of_nanos(F.lit(0).cast("bigint"), 3)) == "00:00:00.000"
    assert value(D.time_of_nanos(F.lit(37740123000000), 3)) == "10:29:00.123"
    assert value(D.micros_of_nanos(F.lit(-1).cast("bigint"))) == -1
    assert value(D.micros_of_nanos(F.lit(1506697200012000999))) == 1506697200012000
    assert value(D.bits_of_int(F.lit(40000), 15)) == bin(40000)[2:]
    big = -(10**30)
    assert value(
        D.decimal_of_base64(F.lit(B64(big.to_bytes(13, "big", signed=True)).decode()), 38, 2)
    ) == Decimal(big).scaleb(-2)
    assert value(D.quoted_text(F.lit('a"b\\c\x00'))) == '"a\\"b\\\\c"'
    assert value(D.octal_text(F.lit(bytearray(b"a\\\x01\xff")))) == "a\\\\\\001\\377"


def test_config(tmp_path):
    (tmp_path / "config.properties").write_text(
        "# c\ndata_source = m, p\nm.type=maxwell\nm.kafka.server=h:1\nm.kafka.topic=t\np.type=debezium\np.kafka.server=h:1\np.namespace=n\n"
    )
    (tmp_path / "m.properties").write_text("d.a = public.a\nd.b = public.a\n")
    (tmp_path / "p.properties").write_text("public.c = public.c\n")
    c = C.load_config(str(tmp_path / "config.properties"))
    assert c.targets() == {"public.a", "public.c"} and c.loaders() == 2 and c.batch_rows == 50_000
    assert c.sources[1].topics() == ["n.public.c"] and c.sources[0].full_map()["m.d.a"] == "public.a"
    with pytest.raises(ValueError):
        C.table_map("a = public.a")
    limits = c.kafka_limits()
    assert (limits["minOffsetsPerTrigger"], limits["maxTriggerDelay"]) == ("50000", "10000ms")
    from rillsync.sources.transport import kafka_options

    options = kafka_options("h:1", c.sources[1].topics(), "g", limits)
    assert options["subscribe"] == "n.public.c" and options["startingOffsets"] == "earliest"


@pytest.mark.parametrize(
    "line",
    ["m.type=oracle", "m.kafka.topic=", "merge.batch.size=0", "metrics.reporter=x", "data_source=", "m.transport=x"]
)
def test_config_errors(tmp_path, line):
    good = "data_source=m\nm.type=maxwell\nm.kafka.server=h:1\nm.kafka.topic=t\n"
    (tmp_path / "m.properties").write_text("d.a = public.a\n")
    (tmp_path / "config.properties").write_text(good)
    assert C.load_config(str(tmp_path / "config.properties")).reporter == "console"
    (tmp_path / "config.properties").write_text(f"{good}{line}\n")
    with pytest.raises(ValueError):
        C.load_config(str(tmp_path / "config.properties"))


def test_state_endpoint():
    from urllib.error import HTTPError
    from urllib.request import urlopen

    s = State()
    s.done("m", "maxwell", 0, 5, 1_500_000_000_123)
    s.waiting("m", "public.a", 3)
    s.applied("m", "public.a", 3, 0.5)
    s.failed("n")
    found = s.metrics()
    assert (found["m.public.a.rows"], found["m.public.a.mean_seconds"], found["m.public.a.waiting"]) == (3, 0.5, 0)
    assert (found["All Pipeline Number"], found["All Live Pipeline Number"], found["m.RecordCount"]) == (2, 1, 5)
    seen = []
    stop = s.report(0.01, seen.append)
    while not seen:
        pass
    stop.set()
    assert json.loads(seen[0])["All Pipeline Number"] == 2
    server = s.serve("127.0.0.1", 0)
    url = f"http://127.0.0.1:{server.server_address[1]}"
    assert json.load(urlopen(f"{url}/m?pretty"))["pipelines"][0]["latest"] == "2017-07-14T02:40:00.123Z"
    assert len(json.load(urlopen(url))) == 2
    with pytest.raises(HTTPError):
        urlopen(f"{url}/none")
    server.shutdown()
