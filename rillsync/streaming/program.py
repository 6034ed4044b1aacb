"""The whole synchroniser from one configuration: streams of all sources, state, metrics, and a graceful stop."""

from __future__ import annotations

import logging
import signal
import threading
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from rillsync.operators.apply import SnapshotStore
from rillsync.sources.config import Config, SourceConfig
from rillsync.sources.schema import discover
from rillsync.sources.transport import json_stream, kafka_stream
from rillsync.streaming.runner import Synchroniser
from rillsync.streaming.state import Listener, State

LOG = logging.getLogger(__name__)


class Program:
    """Starts a stream for each source. A source that fails is marked and not started again, the others go on; the
    program ends when none is left, when all input is done (`once`), or when it is stopped."""

    def __init__(self, spark: SparkSession, config: Config, once: bool = False):
        if not config.target.get("url"):
            raise ValueError("target.url is missing")
        self.spark, self.config, self.once = spark, config, once
        self.root = config.target["url"].rstrip("/")
        self.targets = discover(spark, config.targets(), config.schemas)
        self.stores = {n: SnapshotStore(spark, self.root, t) for n, t in self.targets.items()}
        self.state, self.listener = State(), None
        self.server = self.reporter = None
        self.queries: dict[str, StreamingQuery] = {}
        self.ending = threading.Event()

    def _records(self, source: SourceConfig) -> DataFrame:
        if source.transport == "json":
            return json_stream(self.spark, source.path)
        return kafka_stream(self.spark, source.server, source.topics(), source.group, self.config.kafka_limits())

    def synchroniser(self, source: SourceConfig) -> Synchroniser:
        return Synchroniser(
            self.spark, self.root, source.name, source.kind, source.full_map(), self.targets,
            quarantine=f"{self.root}/_quarantine", state=self.state, loaders=self.config.loaders(), stores=self.stores,
        )

    def start(self) -> None:
        self.listener = Listener(self.state)
        self.spark.streams.addListener(self.listener)
        self.server = self.state.serve(self.config.state_address, self.config.state_port)
        if self.config.reporter == "console":
            self.reporter = self.state.report(self.config.report_seconds)
        elif self.config.reporter == "jmx":
            # Spark's own streaming metrics, as the session's metrics configuration exposes them
            self.spark.conf.set("spark.sql.streaming.metricsEnabled", "true")
        for source in self.config.sources:
            self.state.began(source.name, source.kind)
            checkpoint = f"{self.root}/_checkpoints/{source.name}"
            interval = None if self.once else self.config.interval_ms
            self.queries[source.name] = self.synchroniser(source).start(self._records(source), checkpoint, interval)

    def failed(self) -> dict[str, str]:
        """The error of each source that ended with one."""
        ended = {n: q.exception() for n, q in self.queries.items() if not q.isActive}
        return {n: str(e) for n, e in ended.items() if e is not None}

    def run(self, seconds: float = 0.5) -> int:
        """Start, watch until the end, stop; 0 if no source failed."""
        self.start()
        told: set[str] = set()
        try:
            while not self.ending.wait(seconds) and any(q.isActive for q in self.queries.values()):
                for name, error in self.failed().items():
                    if name not in told:
                        told.add(name)
                        self.state.failed(name)
                        LOG.error("source %s failed: %s", name, error)
        finally:
            self.stop()
        return int(bool(self.failed()))

    def stop(self, seconds: float = 60.0) -> None:
        """Let the batches that are under way end, for so long at most, and stop everything. A batch that is cut off is
        done again by the next start, from the checkpoint."""
        self.ending.set()
        until = time.monotonic() + seconds
        for query in self.queries.values():
            while query.isActive and query.status["isTriggerActive"] and time.monotonic() < until:
                time.sleep(0.05)
            query.stop()
        for name, error in self.failed().items():
            self.state.failed(name)
        if self.listener is not None:
            self.spark.streams.removeListener(self.listener)
            self.listener = None
        if self.reporter is not None:
            self.reporter.set()
        if self.server is not None:
            self.server.shutdown()
            self.server.server_close()
            self.server = None

    def stop_on_signals(self) -> None:
        """SIGTERM and SIGINT end run() gracefully."""
        for number in (signal.SIGTERM, signal.SIGINT):
            signal.signal(number, lambda *_: self.ending.set())
