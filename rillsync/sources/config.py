"""Configuration: a properties file with the sources, and one properties file with each source's table map."""

from __future__ import annotations

import os
import re
from dataclasses import dataclass, field

KINDS = ("maxwell", "debezium")
TRANSPORTS = ("kafka", "json")
REPORTERS = ("console", "jmx", "none")


@dataclass(frozen=True)
class SourceConfig:
    name: str
    kind: str
    server: str
    topic: str | None
    namespace: str | None
    group: str
    transport: str = "kafka"
    path: str | None = None  # of a json transport: a folder that files of records are put into
    tables: dict[str, str] = field(default_factory=dict)  # "<db or schema>.<table>" -> "<schema>.<table>"

    def full_map(self) -> dict[str, str]:
        return {f"{self.name}.{k}": v for k, v in self.tables.items()}

    def topics(self) -> list[str]:
        """One topic for Maxwell; one for each table for Debezium, under the namespace."""
        return [self.topic] if self.kind == "maxwell" else [f"{self.namespace}.{t}" for t in self.tables]


@dataclass(frozen=True)
class Config:
    sources: list[SourceConfig]
    interval_ms: int = 10_000
    batch_rows: int = 50_000
    reporter: str = "console"
    report_seconds: int = 15
    state_address: str = "0.0.0.0"
    state_port: int = 8080
    target: dict[str, str] = field(default_factory=dict)
    loader_pool: int = 10
    schemas: dict[str, str] = field(default_factory=dict)  # "<schema>.<table>" -> columns; "....key" -> its key

    def targets(self) -> set[str]:
        return {t for s in self.sources for t in s.tables.values()}

    def loaders(self) -> int:
        """Tables applied side by side: not more than there are targets."""
        return max(1, min(self.loader_pool, len(self.targets())))

    def kafka_limits(self) -> dict[str, str]:
        """A batch starts at so many rows or after the interval, whichever comes first."""
        return {
            "minOffsetsPerTrigger": str(self.batch_rows), "maxTriggerDelay": f"{self.interval_ms}ms",
            "maxOffsetsPerTrigger": str(2 * self.batch_rows)
        }


def parse_properties(text: str) -> dict[str, str]:
    """key=value or key:value lines; # and ! begin comments; a backslash at the end goes on with the next line."""
    out: dict[str, str] = {}
    for line in re.sub(r"\\\n\s*", "", text).splitlines():
        line = line.strip()
        if line and line[0] not in "#!":
            key, value = (re.split(r"\s*[=:]\s*|\s+", line, maxsplit=1) + [""])[:2]
            out[key] = value
    return out


def table_map(text: str) -> dict[str, str]:
    found = parse_properties(text)
    for k, v in found.items():
        if len(k.split(".")) != 2 or len(v.split(".")) != 2:
            raise ValueError(f"table map needs two-part names: {k} = {v}")
    return found


def load_config(path: str) -> Config:
    """The configuration of a properties file, with the files beside it: <source>.properties for each source's table
    map, and tables.properties for the columns and keys of targets that are in no catalog."""
    with open(path) as f:
        p = parse_properties(f.read())
    folder = os.path.dirname(path)

    def need(key: str) -> str:
        if not p.get(key):
            raise ValueError(f"{key} is missing")
        return p[key]

    def number(key: str, default: int, least: int = 0) -> int:
        value = int(p.get(key, default))
        if value < least:
            raise ValueError(f"{key} is {value}, which is below {least}")
        return value

    sources = []
    for name in filter(None, re.sub(r"\s", "", need("data_source")).split(",")):
        kind = need(f"{name}.type").lower()
        if kind not in KINDS:
            raise ValueError(f"unknown type {kind} of source {name}")
        transport = p.get(f"{name}.transport", "kafka")
        if transport not in TRANSPORTS:
            raise ValueError(f"unknown transport {transport} of source {name}")
        with open(os.path.join(folder, f"{name}.properties")) as f:
            tables = table_map(f.read())
        kafka = transport == "kafka"
        sources.append(
            SourceConfig(
                name, kind,
                server=need(f"{name}.kafka.server") if kafka else "",
                topic=need(f"{name}.kafka.topic") if kafka and kind == "maxwell" else None,
                namespace=need(f"{name}.namespace") if kafka and kind == "debezium" else None,
                group=p.get(f"{name}.kafka.groupid", "rillsync"),
                transport=transport,
                path=None if kafka else need(f"{name}.json.path"),
                tables=tables,
            )
        )
    reporter = p.get("metrics.reporter", "console")
    if reporter not in REPORTERS:
        raise ValueError(f"unknown reporter {reporter}")
    schemas = {}
    if os.path.exists(os.path.join(folder, "tables.properties")):
        with open(os.path.join(folder, "tables.properties")) as f:
            schemas = parse_properties(f.read())
    return Config(
        sources,
        interval_ms=number("merge.interval", 10_000, 1),
        batch_rows=number("merge.batch.size", 50_000, 1),
        reporter=reporter,
        report_seconds=number("metrics.reporter.console.interval", 15, 1),
        state_address=p.get("state.server.addr", "0.0.0.0"),
        state_port=number("state.server.port", 8080),
        target={k: p[f"target.{k}"] for k in ("url", "user", "passwd") if f"target.{k}" in p},
        loader_pool=number("loader.conn_pool.size", 10, 1),
        schemas=schemas,
    )
