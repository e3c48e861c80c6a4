"""Settings of a change feed, with the names and defaults that its users know."""

from __future__ import annotations

import socket
from collections.abc import Mapping
from dataclasses import dataclass, fields, replace
from typing import Any

# Option names that differ from the fields below.
NAMES = {
    "database.hostname": "hostname", "database.user": "user", "database.password": "password", "database.schema": "schema", "buffer_size": "buffer_size", "keep_alive": "keep_alive", "secure": "secure",
    "thread_used": "thread_used", "socket_timeout": "socket_timeout", "from_ccsid": "from_ccsid", "to_ccsid": "to_ccsid", "diagnostics_folder": "diagnostics_folder", "max_entries": "max_entries",
    "date_format": "date_format", "errors": "errors", "max_journal_timeout": "max_journal_timeout", "snapshot.mode": "snapshot_mode", "topic.prefix": "topic_prefix", "table.include.list": "tables",
    "heartbeat.interval.ms": "heartbeat_ms", "poll.interval.ms": "poll_ms", "snapshot.select.statement.overrides": "overrides",
}
MODES = ("initial", "when_needed", "schema_only", "never")


@dataclass(frozen=True)
class FeedConfig:
    hostname: str = ""
    user: str = ""
    password: str = ""
    schema: str = ""
    buffer_size: int = 131_072
    keep_alive: bool = True
    secure: bool = True
    thread_used: bool = False
    socket_timeout: int = 0
    from_ccsid: int = -1
    to_ccsid: int = -1
    diagnostics_folder: str = ""
    max_entries: int = 1_000_000
    date_format: str = "iso"
    errors: str = "full"
    max_journal_timeout: int = 60_000
    snapshot_mode: str = "initial"
    topic_prefix: str = ""
    tables: str = ""
    heartbeat_ms: int = 60_000
    poll_ms: int = 500
    overrides: str = ""

    def __post_init__(self) -> None:
        if self.snapshot_mode not in MODES:
            raise ValueError(f"snapshot.mode is one of {MODES}")
        if self.max_entries < 1 or self.buffer_size < 1:
            raise ValueError("max_entries and buffer_size are positive")
        object.__setattr__(self, "schema", self.schema.upper())
        object.__setattr__(self, "topic_prefix", self.topic_prefix or self.hostname or socket.gethostname())

    @classmethod
    def from_options(cls, options: Mapping[str, Any]) -> FeedConfig:
        """From dotted option names, or the fields' own; unknown names are left alone, as other parts read them."""
        kinds = {f.name: type(f.default) for f in fields(cls)}
        given = {}
        for k, v in options.items():
            name = NAMES.get(k, k)
            if name in kinds:
                kind = kinds[name]
                given[name] = str(v).strip().lower() == "true" if kind is bool else kind(v)
        return cls(**given)

    def with_(self, **given: Any) -> FeedConfig:
        return replace(self, **given)

    @property
    def override(self) -> tuple[int, int] | None:
        """The code page that columns are declared in and the one they are stored in, if both are set."""
        return (self.from_ccsid, self.to_ccsid) if self.from_ccsid > 0 and self.to_ccsid > 0 else None

    def reader_options(self, path: str) -> dict[str, str]:
        """Options of the journal source."""
        return {"path": path, "maxEntries": str(self.max_entries)}

    def jdbc_options(self, table: str, scheme: str) -> dict[str, str]:
        """Options of ``spark.read.format("jdbc")`` for a snapshot. The driver, and the scheme of its addresses, are not part of this package."""
        timeout = {"socket timeout": self.socket_timeout} if self.socket_timeout else {}
        asked = {"date format": self.date_format, "errors": self.errors, "keep alive": str(self.keep_alive).lower(), "secure": str(self.secure).lower(), "thread used": str(self.thread_used).lower(), **timeout}
        url = f"jdbc:{scheme}://{self.hostname};" + ";".join(f"{k}={v}" for k, v in asked.items())
        return {"url": url, "user": self.user, "password": self.password, "dbtable": f"{self.schema}.{table}" if self.schema else table}
