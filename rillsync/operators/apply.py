"""Keyed apply of net changes to a target, and a store of target snapshots that survives replays."""

from __future__ import annotations

import json
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rillsync.operators.merge import touched, upsert_set
from rillsync.sources.schema import TableSpec
from rillsync.sources.scratch import hadoop_path


def affected(target: DataFrame, keys: DataFrame, names: list[str]) -> DataFrame:
    """Rows of the target that a delete by these keys takes out; a null key matches nothing."""
    return target.join(keys, names, "left_semi")


def apply_net(target: DataFrame, net: DataFrame, names: list[str]) -> DataFrame:
    """The target after the changes. All keys touched are taken out first, so applying twice is applying once.
    Whether the keys are broadcast is left to the planner, which knows their size at run time. `net` is read twice:
    where it is dear to compute, pass a materialised one."""
    return target.join(touched(net), names, "left_anti").unionByName(upsert_set(net))


def rows_of(net: DataFrame, table: TableSpec) -> DataFrame:
    """Net changes as stored rows: the table's columns, _s (order of the key's last event) and _gone (removed)."""
    keys = set(table.keys)
    row = [(F.col(f"key.{c}") if c in keys else F.col(f"tuple.{c}")).alias(c) for c in table.columns]
    return net.select(*row, F.col("s").alias("_s"), (F.col("kind") == "rm").alias("_gone"))


def newest(rows: DataFrame, table: TableSpec) -> DataFrame:
    """Of stored rows, the newest of each key: one aggregation with map-side partial results."""
    keys = list(table.keys)
    rest = [c for c in (*table.columns, "_s", "_gone") if c not in keys]
    last = rows.groupBy(*keys).agg(F.max_by(F.struct(*rest), "_s").alias("_last"))
    return last.select(
        *[F.col(c) if c in keys else F.col(f"_last.{c}").alias(c) for c in (*table.columns, "_s", "_gone")]
    )


def overlaid(old: DataFrame, late: DataFrame, table: TableSpec) -> DataFrame:
    """Stored rows of a large part under those of smaller, later ones. Only rows of the large part whose keys are in
    the later ones are compared; the others pass, without a shuffle where the later keys are few enough for the
    planner to broadcast them."""
    keys = list(table.keys)
    changed = late.select(*keys).distinct()
    same = old.join(changed, keys, "left_semi")
    return old.join(changed, keys, "left_anti").unionByName(newest(same.unionByName(late), table))


class SnapshotStore:
    """A table as a few parts, Parquet folders of stored rows, and a pointer to them.

    A batch writes a part with its own net changes, nothing else. Parts are of falling size: where a part has less
    than MERGE times the rows of the next one, the two are merged, so a row is written again about once for each
    factor of MERGE by which the table is larger than a batch, and there are as few parts. A reader takes the newest
    row of each key; removed keys stay as tombstones, so late, repeated and shuffled batches end the same.

    A part is written whole and then the pointer is replaced by one atomic rename, so readers see one version or the
    other, and a batch is in it or not. Parts that a version leaves stay for one more, for readers that hold them."""

    MERGE = 4

    def __init__(self, spark: SparkSession, root: str, table: TableSpec):
        self.spark, self.table, self.root = spark, table, f"{root.rstrip('/')}/{table.name}"
        self._fs, _ = hadoop_path(spark, self.root)
        self._path = lambda p: hadoop_path(spark, p)[1]
        self._lock = threading.Lock()

    def pointer(self) -> dict:
        """version, batches: the last one applied of each source, parts: [folder, rows] from the oldest on, left:
        folders to delete."""
        at = self._path(f"{self.root}/_current")
        if not self._fs.exists(at):
            return {"version": 0, "batches": {}, "parts": [], "left": []}
        stream = self._fs.open(at)
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def _schema(self) -> T.StructType:
        return T.StructType(
            [*self.table.schema.fields, T.StructField("_s", T.LongType()), T.StructField("_gone", T.BooleanType())]
        )

    def _read(self, folders: list[str]) -> DataFrame:
        paths = [f"{self.root}/{f}" for f in folders]
        return self.spark.read.schema(self._schema()).parquet(*paths) if paths else self.spark.createDataFrame([], self._schema())

    def _merged(self, folders: list[str]) -> DataFrame:
        if len(folders) < 2:
            return self._read(folders)
        return overlaid(self._read(folders[:1]), self._read(folders[1:]), self.table)

    def stored(self) -> DataFrame:
        """The newest row of every key, with its order and tombstones."""
        return self._merged([f for f, _ in self.pointer()["parts"]])

    def current(self) -> DataFrame:
        return self.stored().where("not _gone").select(*self.table.columns)

    def _write(self, rows: DataFrame, folder: str) -> list:
        rows.write.mode("overwrite").parquet(f"{self.root}/{folder}")
        return [folder, self._read([folder]).count()]  # from the files' footers

    def _commit(self, was: dict, parts: list, batches: dict[str, int]) -> None:
        left = [f for f, _ in was["parts"] if f not in {g for g, _ in parts}]
        now = {"version": was["version"] + 1, "batches": batches, "parts": parts, "left": left}
        part = self._path(f"{self.root}/_next")
        out = self._fs.create(part, True)
        out.write(bytearray(json.dumps(now).encode()))
        out.close()
        self._replace(part, self._path(f"{self.root}/_current"))
        for folder in was["left"]:
            self._fs.delete(self._path(f"{self.root}/{folder}"), True)

    def _replace(self, new, old) -> None:
        """Rename over the old file in one step."""
        sc = self.spark.sparkContext
        how = getattr(sc._jvm.org.apache.hadoop.fs, "Options$Rename")
        kinds = sc._gateway.new_array(how, 1)
        kinds[0] = how.OVERWRITE
        context = sc._jvm.org.apache.hadoop.fs.FileContext.getFileContext(
            self._fs.getUri(), sc._jsc.hadoopConfiguration()
        )
        context.rename(self._fs.makeQualified(new), self._fs.makeQualified(old), kinds)

    def apply(self, net: DataFrame, batch: int, source: str = "") -> bool:
        """Apply a batch of a source once; False if it was applied before. One batch at a time gets in."""
        with self._lock:
            was = self.pointer()
            if batch <= was["batches"].get(source, -1):
                return False
            batches, parts = was["batches"] | {source: batch}, list(was["parts"])
            fresh = self._write(rows_of(net, self.table), f"v{was['version'] + 1}")
            if fresh[1]:
                parts.append(fresh)
            else:  # nothing but filtered changes
                self._fs.delete(self._path(f"{self.root}/{fresh[0]}"), True)
            self._commit(was, parts, batches)
            merge = 0  # how many of the last parts are to be one
            for k in range(2, len(parts) + 1):
                if parts[-k][1] < self.MERGE * sum(n for _, n in parts[len(parts) - k + 1 :]):
                    merge = k
            if merge:
                was = self.pointer()
                one = self._write(self._merged([f for f, _ in parts[-merge:]]), f"v{was['version'] + 1}")
                self._commit(was, [*parts[:-merge], one], batches)
            return True

    def drop_tombstones(self, before: int) -> None:
        """Make one part of all, without the removed keys older than the least order that can still come."""
        with self._lock:
            was = self.pointer()
            kept = self._merged([f for f, _ in was["parts"]]).where(f"not (_gone and _s < {int(before)})")
            self._commit(was, [self._write(kept, f"v{was['version'] + 1}")], was["batches"])


def optimistic_keys(net: DataFrame, target: DataFrame, names: list[str]) -> DataFrame:
    """The keys to delete first where plain inserts are known not to be there: the delete set, and of the upserts
    those that are in the target after all. The result is the same as with all touched keys."""
    explicit = net.where("del").select("key.*")
    clash = net.where("kind = 'put' and not del").select("key.*").join(target.select(*names), names, "left_semi")
    return explicit.union(clash).distinct()
