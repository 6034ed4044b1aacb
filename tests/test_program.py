"""The whole program from configuration files, over files of records: two sources, a shared target, bad records."""

import json
import threading
import time
from urllib.request import urlopen

import pytest

from rillsync.__main__ import main
from rillsync.operators.apply import SnapshotStore
from rillsync.sources.config import load_config
from rillsync.sources.schema import TableSpec, discover, existing
from rillsync.streaming import runner
from rillsync.streaming.program import Program

CONFIG = """
data_source = shop, pg
shop.type = maxwell
shop.transport = json
shop.json.path = {root}/shop
pg.type = debezium
pg.transport = json
pg.json.path = {root}/pg
merge.interval = 200
metrics.reporter = none
state.server.addr = 127.0.0.1
state.server.port = 0
target.url = file://{root}/target
"""


def shop(offset, table, kind, data, **more):
    value = {"database": "d", "table": table, "type": kind, "ts": 1_500_000_000, "data": data, **more}
    return {"topic": "shop", "partition": 0, "offset": offset, "value": json.dumps(value)}


def pg(offset, op, row, partition=0):
    payload = {"op": op, "ts_ms": 9, "before": row if op == "d" else None, "after": None if op == "d" else row}
    return {"topic": "ns.public.b", "partition": partition, "offset": offset, "value": json.dumps({"payload": payload})}


def put(folder, name, records):
    folder.mkdir(exist_ok=True)
    (folder / f".{name}").write_text("".join(json.dumps(r) + "\n" for r in records))
    (folder / f".{name}").rename(folder / name)


@pytest.fixture
def root(tmp_path):
    (tmp_path / "config.properties").write_text(CONFIG.format(root=tmp_path))
    (tmp_path / "shop.properties").write_text("d.a = public.one\nd.c = public.two\n")
    (tmp_path / "pg.properties").write_text("public.b = public.one\n")
    (tmp_path / "tables.properties").write_text(
        "public.one = id bigint, name string\npublic.one.key = id\npublic.two = x int, y int, z string\npublic.two.key = x, y\n"
    )
    put(tmp_path / "shop", "0.json", [
        shop(0, "a", "insert", {"id": 1, "name": "a"}), shop(1, "a", "update", {"ID": 2, "name": "b"}, old={"id": 1}),
        shop(2, "c", "insert", {"x": 1, "y": 1, "z": "p"}), shop(3, "c", "insert", {"x": 1, "y": 2, "z": "q"}),
        shop(4, "c", "delete", {"x": 1, "y": 1, "z": "p"}), shop(5, "other", "insert", {"id": 1}),
        {"topic": "shop", "partition": 0, "offset": 6, "value": '{"database":"d","table":"a","ty'},
    ])
    put(
        tmp_path / "pg", "0.json",
        [
            pg(0, "r", {"id": 100, "name": "x"}), pg(1, "u", {"id": 100, "name": "y"}),
            pg(2, "c", {"id": 101, "name": "z"}), pg(3, "d", {"id": 101, "name": "z"})
        ]
    )
    return tmp_path


def rows(program, target):
    return sorted(tuple(r) for r in program.stores[target].current().collect())


def test_once(spark, root):
    program = Program(spark, load_config(str(root / "config.properties")), once=True)
    assert program.run() == 0
    assert rows(program, "public.one") == [(2, "b"), (100, "y")]
    assert rows(program, "public.two") == [(1, 2, "q")]
    assert [r.offset for r in spark.read.parquet(f"file://{root}/target/_quarantine/shop").collect()] == [6]
    assert program.state.metrics()["shop.public.two.rows"] == 3
    put(root / "shop", "1.json", [shop(7, "a", "delete", {"id": 2, "name": "b"})])
    again = Program(spark, load_config(str(root / "config.properties")), once=True)  # goes on from the checkpoints
    assert again.run() == 0 and rows(again, "public.one") == [(100, "y")]


def test_live_until_stopped(spark, root):
    program = Program(spark, load_config(str(root / "config.properties")))
    ended = []
    thread = threading.Thread(target=lambda: ended.append(program.run(0.1)))
    thread.start()
    until = time.monotonic() + 60
    while time.monotonic() < until and program.state.metrics().get("shop.public.one.batches", 0) == 0:
        if program.state.metrics().get("shop.RecordCount") and program.state.metrics().get("pg.RecordCount"):
            break
        time.sleep(0.1)
    url = f"http://127.0.0.1:{program.server.server_address[1]}/shop"
    assert json.load(urlopen(url))["pipelines"][0]["state"] == "NORMAL"
    put(root / "shop", "1.json", [shop(8, "a", "insert", {"id": 9, "name": "late"})])
    while time.monotonic() < until and (9, "late") not in rows(program, "public.one"):
        time.sleep(0.2)
    program.ending.set()
    thread.join(60)
    assert ended == [0] and (9, "late") in rows(program, "public.one")
    assert not any(q.isActive for q in program.queries.values())


def test_a_failing_source_is_marked_and_the_other_goes_on(spark, root):
    put(root / "pg", "1.json", [pg(4, "c", {"id": 7})])  # lacks a column of the target
    program = Program(spark, load_config(str(root / "config.properties")), once=True)
    assert program.run() == 1 and list(program.failed()) == ["pg"]
    assert program.state.one("pg")["pipelines"][0]["state"] == "ERROR"
    assert (2, "b") in rows(program, "public.one")
    (root / "pg" / "1.json").write_text(json.dumps(pg(4, "c", {"id": 7, "name": "mended"})) + "\n")
    again = Program(spark, load_config(str(root / "config.properties")), once=True)  # the batch is done again
    assert again.run() == 0 and (7, "mended") in rows(again, "public.one")


def test_several_partitions_fail(spark, root):
    put(root / "pg", "1.json", [pg(4, "c", {"id": 7, "name": "n"}, partition=1)])
    program = Program(spark, load_config(str(root / "config.properties")), once=True)
    assert program.run() == 1 and "partition" in program.failed()["pg"]


def test_a_target_without_a_key_is_an_error(spark, root):
    (root / "tables.properties").write_text(
        "public.one = id bigint, name string\npublic.one.key = id\npublic.two = x int\n"
    )
    with pytest.raises(ValueError, match="no primary key for public.two"):
        Program(spark, load_config(str(root / "config.properties")))


def test_targets_of_the_catalog(spark, tmp_path):
    spark.sql(
        f"CREATE TABLE held (id BIGINT, name STRING) USING parquet LOCATION 'file://{tmp_path}/held' "
        "TBLPROPERTIES ('primaryKey' = 'id')"
    )
    try:
        found = discover(spark, {"held", "public.two"}, {"public.two": "x int, y int", "public.two.key": "x, y"})
        assert found["held"].keys == ("id",) and found["held"].columns == ["id", "name"]
        assert found["public.two"].keys == ("x", "y")
        assert existing(spark, ["held", "absent"]) == ["held"]
        with pytest.raises(ValueError, match="no table absent"):
            discover(spark, {"absent"}, {})
    finally:
        spark.sql("DROP TABLE held")


def test_slow_applies_tell_their_plan(spark, root, monkeypatch, caplog):
    monkeypatch.setattr(runner, "SLOW_SECONDS", 0.0)
    with caplog.at_level("WARNING"):
        assert Program(spark, load_config(str(root / "config.properties")), once=True).run() == 0
    assert any("to reach public.two" in m and "Aggregate" in m for m in caplog.messages)


def test_bad_records_without_a_quarantine_fail_the_batch(spark, tmp_path):
    spec = TableSpec.of("public.one", "id bigint, name string", "id")
    sync = runner.Synchroniser(spark, f"file://{tmp_path}", "shop", "maxwell", {"shop.d.a": "public.one"}, {"public.one": spec})
    rows = [("shop", 0, 0, "not json"), ("shop", 0, 1, shop(1, "a", "insert", {"id": 1, "name": "a"})["value"])]
    records = spark.createDataFrame(rows, "topic string, partition int, offset bigint, value string")
    with pytest.raises(ValueError, match="1 records of batch 0 of shop"):
        sync.batch(records, 0)
    assert sync.stores["public.one"].pointer()["version"] == 0  # nothing of the batch is in
    sync.batch(records.where("offset = 1"), 0)
    assert sync.stores["public.one"].current().count() == 1


def test_a_failing_target_is_caught_up_by_the_next_start(spark, root, monkeypatch):
    """One target of a batch fails: the batch is not done, and its repetition skips the target that has it."""
    real, broken = SnapshotStore.apply, []

    def failing(self, net, batch, source=""):
        if self.table.name == "public.two" and source == "shop" and not broken:
            broken.append(batch)
            raise OSError("the target is away")
        return real(self, net, batch, source)

    monkeypatch.setattr(SnapshotStore, "apply", failing)
    program = Program(spark, load_config(str(root / "config.properties")), once=True)
    assert program.run() == 1 and "the target is away" in program.failed()["shop"]
    again = Program(spark, load_config(str(root / "config.properties")), once=True)
    assert again.run() == 0 and broken == [0]
    assert rows(again, "public.one") == [(2, "b"), (100, "y")] and rows(again, "public.two") == [(1, 2, "q")]


def test_command_line(spark, root, capsys):
    assert main([str(root / "config.properties"), "--once"]) == 0
    with pytest.raises(SystemExit):
        main(["--unknown"])
    with pytest.raises(FileNotFoundError):
        main([str(root / "none.properties")])
