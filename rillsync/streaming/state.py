"""State and metrics of running synchronisers, as JSON over HTTP, to the console or as a DataFrame."""

from __future__ import annotations

import json
import threading
import time
from dataclasses import dataclass, field
from datetime import datetime, timezone
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer
from urllib.parse import urlsplit

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQueryListener


def _iso(ms: int | None) -> str | None:
    return None if ms is None else datetime.fromtimestamp(
        ms / 1000, timezone.utc
    ).strftime("%Y-%m-%dT%H:%M:%S.") + f"{ms % 1000:03d}Z"


#: An apply that takes longer is reported with its plan.
SLOW_SECONDS = 10.0


@dataclass
class State:
    """What each source has done: the latest change's time, the delay to its commit, rows, batches, and whether it
    runs; and for each of its targets the rows, batches, seconds and rows waiting to be applied."""

    sources: dict[str, dict] = field(default_factory=dict)
    lock: threading.Lock = field(default_factory=threading.Lock)

    def _source(self, name: str, kind: str = "") -> dict:
        new = {"kind": kind, "batch": -1, "rows": 0, "batches": 0, "latest": None, "delay": 0.0, "state": "NORMAL"}
        found = self.sources.setdefault(name, new | {"tables": {}})
        found["kind"] = kind or found["kind"]
        return found

    def began(self, name: str, kind: str) -> None:
        with self.lock:
            self._source(name, kind)["state"] = "NORMAL"

    def done(self, name: str, kind: str, batch: int, rows: int, latest_ms: int | None) -> None:
        with self.lock:
            s = self._source(name, kind)
            s["batch"], s["rows"], s["batches"], s["state"] = batch, s["rows"] + rows, s["batches"] + 1, "NORMAL"
            if latest_ms is not None:
                s["latest"] = max(latest_ms, s["latest"] or latest_ms)
                s["delay"] = max(0.0, time.time() - latest_ms / 1000)

    def waiting(self, name: str, table: str, rows: int) -> None:
        with self.lock:
            self._table(name, table)["waiting"] = rows

    def applied(self, name: str, table: str, rows: int, seconds: float) -> None:
        with self.lock:
            t = self._table(name, table)
            t["rows"], t["batches"], t["seconds"], t["waiting"] = t["rows"] + rows, t["batches"] + 1, t["seconds"] + seconds, 0

    def _table(self, name: str, table: str) -> dict:
        return self._source(name)["tables"].setdefault(table, {"rows": 0, "batches": 0, "seconds": 0.0, "waiting": 0})

    def failed(self, name: str) -> None:
        with self.lock:
            self._source(name)["state"] = "ERROR"

    def stopped(self, name: str) -> None:
        with self.lock:
            s = self._source(name)
            if s["state"] == "NORMAL":
                s["state"] = "STOP"

    def one(self, name: str) -> dict | None:
        with self.lock:
            s = self.sources.get(name)
            if s is None:
                return None
            line = {
                "name": name, "latest": _iso(s["latest"]), "delay": round(s["delay"], 3), "state": s["state"],
                "rows": s["rows"], "batch": s["batch"],
            }
            return {"source_name": name, "type": s["kind"], "pipelines": [line]}

    def all(self) -> list[dict]:
        return [self.one(n) for n in sorted(self.sources)]

    def metrics(self) -> dict[str, float]:
        """Counts and gauges over all sources, by source, and by source and target."""
        with self.lock:
            live = sum(s["state"] == "NORMAL" for s in self.sources.values())
            out = {"All Pipeline Number": len(self.sources), "All Live Pipeline Number": live}
            for n, s in self.sources.items():
                out |= {f"{n}.RecordCount": s["rows"], f"{n}.AvgDelay": s["delay"]}
                for table, t in s["tables"].items():
                    mean = t["seconds"] / t["batches"] if t["batches"] else 0.0
                    key = f"{n}.{table}"
                    out |= {f"{key}.rows": t["rows"], f"{key}.waiting": t["waiting"], f"{key}.mean_seconds": mean}
        return out

    def frame(self, spark: SparkSession) -> DataFrame:
        rows = [
            (
                s["source_name"], s["type"], p["latest"], p["delay"], p["state"], p["rows"]
            ) for s in self.all() for p in s["pipelines"]
        ]
        return spark.createDataFrame(
            rows, "source_name string, type string, latest string, delay double, state string, n_rows long"
        )

    def serve(self, address: str = "0.0.0.0", port: int = 8080) -> ThreadingHTTPServer:
        """GET / for all sources, /<source> for one, ?pretty for indented JSON; runs in a thread until shut down."""
        state = self

        class Handler(BaseHTTPRequestHandler):
            def do_GET(self) -> None:
                url = urlsplit(self.path)
                name = url.path.strip("/")
                found = state.one(name) if name else state.all()
                body = {"errorMessage": f"no source {name}"} if found is None else found
                data = json.dumps(body, indent=2 if "pretty" in url.query else None).encode()
                self.send_response(404 if found is None else 200)
                self.send_header("Content-Type", "application/json")
                self.send_header("Content-Length", str(len(data)))
                self.end_headers()
                self.wfile.write(data)

            def log_message(self, *args) -> None:
                pass

        server = ThreadingHTTPServer((address, port), Handler)
        threading.Thread(target=server.serve_forever, daemon=True).start()
        return server

    def report(self, seconds: float, emit=print) -> threading.Event:
        """Emit the metrics as a line of JSON again and again until the event is set."""
        stop = threading.Event()

        def run() -> None:
            while not stop.wait(seconds):
                emit(json.dumps(self.metrics()))

        threading.Thread(target=run, daemon=True).start()
        return stop


class Listener(StreamingQueryListener):
    """Marks a source as failed or stopped when its query ends, and keeps the last progress by query."""

    def __init__(self, state: State):
        self.state, self.progress, self.names = state, {}, {}

    def onQueryStarted(self, event) -> None:
        self.names[str(event.id)] = event.name
        if event.name:
            self.state.began(event.name, "")

    def onQueryProgress(self, event) -> None:
        self.progress[event.progress.name] = {
            "rows": event.progress.numInputRows, "duration_ms": dict(event.progress.durationMs)
        }

    def onQueryIdle(self, event) -> None:
        pass

    def onQueryTerminated(self, event) -> None:
        name = self.names.get(str(event.id)) or str(event.id)
        if event.exception:
            self.state.failed(name)
        else:
            self.state.stopped(name)
