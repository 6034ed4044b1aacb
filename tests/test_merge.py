"""The net-change reduction, keyed apply and the snapshot store against a sequential model."""

import random

import pytest

from rillsync.operators import apply as A
from rillsync.operators import merge as M
from rillsync.operators import sinks as Z
from rillsync.sources.schema import TableSpec
from rillsync.sources.scratch import materialize, release, scratch_scope, shared_root

SPEC = TableSpec.of("public.t", "k bigint, v string", "k")
DDL = "seq long, op string, key struct<k:bigint>, old_key struct<k:bigint>, tuple struct<k:bigint,v:string>"


def random_log(rng, n, start=1):
    rows = []
    for i in range(n):
        k, op = rng.randrange(6), rng.choice("IUUD")
        old = rng.randrange(6) if op == "U" and rng.random() < 0.4 else None
        old = None if old == k else old
        rows.append((start + i, op, (k,), None if old is None else (old,), None if op == "D" else (k, f"v{start + i}")))
    return rows


def replay(state, log):
    state = dict(state)
    for _, op, (k,), old, row in log:
        if op == "U" and old is not None:
            state.pop(old[0], None)
        if op == "D":
            state.pop(k, None)
        else:
            state[k] = row[1]
    return state


def test_reduction_equals_replay(spark):
    rng = random.Random(4)
    for _ in range(6):
        log, start = random_log(rng, 14), {k: "old" for k in range(0, 6, 2)}
        target = spark.createDataFrame(list(start.items()), "k long, v string")
        net = M.compact(spark.createDataFrame(log, DDL))
        got = A.apply_net(target, net, ["k"])
        assert {r.k: r.v for r in got.collect()} == replay(start, log)
        again = A.apply_net(got, net, ["k"])
        assert sorted(map(tuple, again.collect())) == sorted(map(tuple, got.collect()))


def test_store_takes_batches_in_any_order_and_again(spark, tmp_path):
    rng = random.Random(9)
    log = random_log(rng, 20)
    batches = [log[i : i + 5] for i in range(0, 20, 5)]
    order = [2, 0, 3, 1, 2]
    store = A.SnapshotStore(spark, f"file://{tmp_path}", SPEC)
    for number, i in enumerate(order):
        assert store.apply(M.compact(spark.createDataFrame(batches[i], DDL)), number)
    assert not store.apply(M.compact(spark.createDataFrame(batches[0], DDL)), 4)
    assert {r.k: r.v for r in store.current().collect()} == replay({}, log)
    store.drop_tombstones(10**9)
    assert store.stored().where("_gone").count() == 0


def folder_bytes(path):
    return sum(f.stat().st_size for f in path.rglob("*") if f.is_file() and "_current" not in f.name)


def test_a_batch_writes_what_it_changes(spark, tmp_path):
    """Few bytes for a small batch on a large table, few parts after many batches, and the same rows as replayed."""
    store = A.SnapshotStore(spark, f"file://{tmp_path}", SPEC)
    big = [(i, "I", (i,), None, (i, f"value {i} {'x' * 40}")) for i in range(20_000)]
    store.apply(M.compact(spark.createDataFrame(big, DDL)), 0)
    base = folder_bytes(tmp_path)
    logs = [
        [(30_000 + 10 * b + j, "U", (10 * b + j,), None, (10 * b + j, f"new {b}")) for j in range(10)] for b in range(8)
    ]
    for b, log in enumerate(logs, 1):
        before = {f: f.stat().st_size for f in tmp_path.rglob("*.parquet")}
        store.apply(M.compact(spark.createDataFrame(log, DDL)), b)
        written = sum(f.stat().st_size for f in tmp_path.rglob("*.parquet") if f not in before)
        assert written < base / 10
    assert len(store.pointer()["parts"]) <= 4
    want = replay({}, big)
    for log in logs:
        want = replay(want, log)
    assert {r.k: r.v for r in store.current().collect()} == want


def test_sources_share_a_store(spark, tmp_path):
    store = A.SnapshotStore(spark, f"file://{tmp_path}", SPEC)
    one = M.compact(spark.createDataFrame([(1, "I", (1,), None, (1, "a"))], DDL))
    two = M.compact(spark.createDataFrame([(1, "I", (2,), None, (2, "b"))], DDL))
    assert store.apply(one, 0, "m") and store.apply(two, 0, "n") and not store.apply(one, 0, "m")
    assert sorted(map(tuple, store.current().collect())) == [(1, "a"), (2, "b")]


def test_database_target(spark):
    rng = random.Random(11)
    url = "jdbc:derby:memory:rillsync;create=true"
    target = Z.JdbcTarget(
        spark, url, TableSpec.of("t", "k bigint, v string", "k"), {"driver": "org.apache.derby.jdbc.EmbeddedDriver"}
    )
    target.execute(
        "CREATE TABLE t (k BIGINT PRIMARY KEY, v VARCHAR(40))", "INSERT INTO t VALUES (0, 'old'), (3, 'old')"
    )
    log = random_log(rng, 20)
    net = M.compact(spark.createDataFrame(log, DDL))
    want = replay({0: "old", 3: "old"}, log)
    for _ in range(2):
        target.apply(net)
        assert {r[0]: r[1] for r in spark.read.jdbc(url, "t", properties=target.properties).collect()} == want
    with pytest.raises(Exception):  # the second statement fails, so the first is undone
        target.execute("DELETE FROM t", "INSERT INTO t VALUES (1, 'a'), (1, 'b')")
    assert spark.read.jdbc(url, "t", properties=target.properties).count() == len(want)


def test_load_files(spark, tmp_path):
    net = M.compact(
        spark.createDataFrame(
            [(1, "I", (1,), None, (1, 'a"b')), (2, "D", (2,), None, None), (3, "I", (3,), None, (3, None))], DDL
        )
    )
    Z.write_load_files(net, f"file://{tmp_path}/b0")
    read = lambda p: sorted(r.value for r in spark.read.text(f"file://{tmp_path}/b0/{p}").collect())
    assert read("delete") == ["2"] and read("insert") == ['1|"a\\"b"', "3|"]


def test_empty_changelog(spark):
    target = spark.createDataFrame([(1, "a")], "k long, v string")
    assert A.apply_net(target, M.compact(spark.createDataFrame([], DDL)), ["k"]).collect() == target.collect()


def test_scratch_goes_with_its_scope(spark):
    before = materialize(spark.range(3), "before")
    with scratch_scope(spark) as keep:
        inner = materialize(spark.range(5), "inner")
        kept = keep(materialize(inner.where("id > 2"), "kept"))
    assert kept.count() == 2 and before.count() == 3
    with pytest.raises(Exception):
        spark.read.parquet(inner._scratch).count()
    release(before, kept)
    with pytest.raises(Exception):
        spark.read.parquet(kept._scratch).count()


def test_scratch_on_a_cluster_needs_a_shared_folder():
    class Cluster:
        class conf:
            get = staticmethod(lambda key, default: default)

        class sparkContext:
            master = "spark://host:7077"

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_root(Cluster)
