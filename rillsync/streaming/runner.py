"""The synchronisation stream: micro-batches of records, decoded, compacted by key and applied to every target."""

from __future__ import annotations

import logging
import time
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from rillsync.operators import envelopes
from rillsync.operators.apply import SnapshotStore
from rillsync.operators.merge import compact
from rillsync.sources.schema import TableSpec
from rillsync.sources.transport import one_partition_each, sequenced
from rillsync.streaming.state import SLOW_SECONDS, State

LOG = logging.getLogger(__name__)


@dataclass
class Synchroniser:
    """Applies each micro-batch to all targets, `loaders` of them side by side. A batch is done when every target has
    it (the barrier is the batch); one that is repeated after a failure is skipped by the targets that have it, and
    tombstones make any order of batches end the same. Sources that share targets in one program share their stores,
    which take one batch at a time."""

    spark: SparkSession
    root: str
    name: str
    kind: str
    tables: dict[str, str]
    targets: dict[str, TableSpec]
    quarantine: str | None = None
    state: State = field(default_factory=State)
    loaders: int = 10
    stores: dict[str, SnapshotStore] | None = None

    def __post_init__(self) -> None:
        used = sorted(set(self.tables.values()))
        missing = [t for t in used if t not in self.targets]
        if missing:
            raise ValueError(f"no table for target {', '.join(missing)}")
        if self.stores is None:
            self.stores = {n: SnapshotStore(self.spark, self.root, self.targets[n]) for n in used}

    def headers(self, records: DataFrame) -> DataFrame:
        """The envelopes of raw records, those of mapped tables and those that cannot be read."""
        heads = envelopes.maxwell_headers if self.kind == "maxwell" else envelopes.debezium_headers
        if self.kind == "debezium":
            records = one_partition_each(records)
        return envelopes.routed(heads(records, self.name), self.tables)

    def changes(self, headers: DataFrame, target: str) -> DataFrame:
        """The canonical changelog of one target."""
        decode = envelopes.maxwell_changes if self.kind == "maxwell" else envelopes.debezium_changes
        return decode(headers.where(F.col("target") == target), self.targets[target])

    def batch(self, records: DataFrame, number: int) -> None:
        records = sequenced(records) if "seq" not in records.columns else records
        # each target reads the envelopes; a lost block is read and parsed from the source again
        headers = self.headers(records).persist()
        try:
            bad = F.count_if(F.expr(envelopes.BROKEN)).alias("bad")
            facts = headers.groupBy("target").agg(
                F.count("*").alias("n"), F.max("produced_ms").alias("latest"), bad
            ).collect()
            if n_bad := sum(f.bad for f in facts):
                if self.quarantine is None:
                    raise ValueError(
                        f"{n_bad} records of batch {number} of {self.name} are not readable, of an unknown kind or without a row"
                    )
                kept = envelopes.broken(headers).select(*records.columns, "source")
                kept.write.mode("overwrite").parquet(f"{self.quarantine}/{self.name}/batch={number}")
            due = {f.target: f.n - f.bad for f in facts if f.target is not None and f.n > f.bad}
            for target, n in due.items():
                self.state.waiting(self.name, target, n)
            with ThreadPoolExecutor(max(1, min(self.loaders, len(due)))) as pool:
                list(pool.map(lambda target: self._apply(headers, target, due[target], number), due))
            latest = max((f.latest for f in facts if f.latest is not None), default=None)
            self.state.done(self.name, self.kind, number, sum(f.n for f in facts), latest)
        finally:
            headers.unpersist()

    def _apply(self, headers: DataFrame, target: str, rows: int, number: int) -> None:
        net, began = compact(self.changes(headers, target)), time.monotonic()
        self.stores[target].apply(net, number, self.name)
        took = time.monotonic() - began
        self.state.applied(self.name, target, rows, took)
        if took > SLOW_SECONDS:
            plan = net._jdf.queryExecution().simpleString()
            LOG.warning("batch %s of %s took %.1f s to reach %s: %s", number, self.name, took, target, plan)

    def start(self, records: DataFrame, checkpoint: str, interval_ms: int | None = None) -> StreamingQuery:
        """Begin the stream; without an interval it takes what there is and stops."""
        writer = records.writeStream.foreachBatch(self.batch).option(
            "checkpointLocation", checkpoint
        ).queryName(self.name)
        writer = writer.trigger(
            processingTime=f"{interval_ms} milliseconds"
        ) if interval_ms else writer.trigger(availableNow=True)
        return writer.start()
