"""Settings of an extraction, validated up front."""

from __future__ import annotations

import os
import re
from dataclasses import dataclass, field, fields
from typing import Any

FULL_TABLE, INCREMENTAL, LOG_BASED = METHODS = ("FULL_TABLE", "INCREMENTAL", "LOG_BASED")
#: The TLS modes that Postgres clients know.
SSL_MODES = ("disable", "allow", "prefer", "require", "verify-ca", "verify-full")
SLOT_NAME = re.compile(r"(?!pg_)[A-Za-z0-9_]{1,63}")


def valid_slot_name(name: str) -> bool:
    """1 to 63 ASCII letters, digits or underscores, not beginning with ``pg_``."""
    return SLOT_NAME.fullmatch(name) is not None


@dataclass(frozen=True)
class Tunnel:
    """An SSH tunnel. The engine uses an endpoint that is already open; see ``sources.tunnel``."""

    enable: bool = False
    host: str | None = None
    username: str | None = None
    port: int = 22
    private_key: str | None = None
    private_key_password: str | None = None
    #: The open endpoint that stands for the database, reachable from all executors.
    endpoint: tuple[str, int] | None = None


@dataclass(frozen=True)
class Settings:
    """All settings; anything wrong raises ``ValueError`` here, not at first use."""

    host: str | None = None
    port: int = 5432
    user: str | None = None
    password: str | None = None
    database: str | None = None
    url: str | None = None
    replication_slot_name: str = "tidemark"
    replication_max_run_seconds: float = 600
    replication_idle_exit_seconds: float = 60
    max_record_count: int | None = None
    filter_schemas: tuple[str, ...] = ()
    dates_as_string: bool = False
    json_as_object: bool = False
    stream_options: dict[str, dict[str, Any]] = field(default_factory=dict)
    ssh_tunnel: Tunnel = field(default_factory=Tunnel)
    ssl_enable: bool = False
    ssl_client_certificate_enable: bool = False
    ssl_mode: str = "verify-full"
    ssl_certificate_authority: str = "~/.postgresql/root.crt"
    ssl_client_certificate: str = "~/.postgresql/postgresql.crt"
    ssl_client_private_key: str = "~/.postgresql/postgresql.key"
    ssl_storage_directory: str = ".secrets"
    default_replication_method: str = FULL_TABLE
    log_based_single_connection: bool = True
    auto_bootstrap_log_based: bool = False
    start_date: str | None = None
    flattening_enabled: bool = False
    flattening_max_depth: int = 1
    #: Whether columns that appear in a log are taken up; else they are left out, and their messages go to the quarantine too.
    evolve_schemas: bool = True
    #: What streams become, see ``plans.maps``.
    stream_maps: dict[str, Any] = field(default_factory=dict)
    #: Parts in which a snapshot of a stream is read, so that one that is broken off goes on where it was; 1 for a snapshot at once.
    bootstrap_chunks: int = 1

    def __post_init__(self) -> None:
        if self.url is None:
            for name in ("host", "user", "password", "database"):
                if getattr(self, name) is None:
                    raise ValueError(f"without a url, {name} is needed")
        if not valid_slot_name(self.replication_slot_name):
            raise ValueError(f"not a slot name: {self.replication_slot_name!r}")
        if self.ssl_mode not in SSL_MODES:
            raise ValueError(f"ssl_mode is none of {', '.join(SSL_MODES)}: {self.ssl_mode!r}")
        if self.ssl_client_certificate_enable and not self.ssl_client_private_key:
            raise ValueError("a client certificate needs its private key")
        if self.default_replication_method not in METHODS:
            raise ValueError(f"no such replication method: {self.default_replication_method!r}")
        if self.max_record_count is not None and self.max_record_count < 0:
            raise ValueError("max_record_count is negative")
        if self.ssh_tunnel.enable and not (self.ssh_tunnel.endpoint or self.ssh_tunnel.host):
            raise ValueError("an SSH tunnel needs a host or an open endpoint")
        for name in ("replication_max_run_seconds", "replication_idle_exit_seconds"):
            if getattr(self, name) < 0:
                raise ValueError(f"{name} is negative")

    @classmethod
    def of(cls, config: dict[str, Any]) -> Settings:
        """From a configuration dict; unknown names raise ``ValueError``."""
        config = {k: v for k, v in config.items() if v is not None}
        if "sqlalchemy_url" in config:
            config["url"] = config.pop("sqlalchemy_url")
        known = {f.name for f in fields(cls)}
        if unknown := config.keys() - known:
            raise ValueError(f"unknown settings: {', '.join(sorted(unknown))}")
        if isinstance(config.get("ssh_tunnel"), dict):
            config["ssh_tunnel"] = Tunnel(**config["ssh_tunnel"])
        if "filter_schemas" in config:
            config["filter_schemas"] = tuple(config["filter_schemas"])
        return cls(**config)

    def where(self, stream: str) -> list[str]:
        """Custom predicates of a stream, by its name."""
        return [c.strip() for c in self.stream_options.get(stream, {}).get("custom_where_clauses", []) if c.strip()]

    def path(self, name: str) -> str:
        return os.path.expanduser(getattr(self, name))


#: Settings as JSON Schema, for tools that show or check them.
def settings_schema() -> dict[str, Any]:
    kinds = {"bool": "boolean", "int": "integer", "float": "number", "str": "string"}
    found: dict[str, Any] = {}
    for f in fields(Settings):
        base = str(f.type).split(" | ")[0]
        kind = "array" if base.startswith("tuple") else "object" if base.startswith("dict") or base == "Tunnel" else kinds.get(base, "string")
        found[f.name] = {"type": [kind, "null"] if "None" in str(f.type) else [kind]}
        if isinstance(f.default, (bool, int, float, str)):
            found[f.name]["default"] = f.default
    found["replication_slot_name"]["pattern"] = "^(?!pg_)[A-Za-z0-9_]{1,63}$"
    found["ssl_mode"]["enum"] = list(SSL_MODES)
    found["default_replication_method"]["enum"] = list(METHODS)
    return {"type": "object", "properties": found}
