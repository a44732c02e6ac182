"""Where the database is, and how to reach it: one set of parameters, rendered for JDBC or as a DSN."""

from __future__ import annotations

import hashlib
import os
import stat
from collections.abc import Mapping
from dataclasses import dataclass, field, replace
from pathlib import Path
from urllib.parse import parse_qsl, quote, unquote, urlencode, urlsplit

from tidemark.config import Settings

APPLICATION = "tidemark"


@dataclass(frozen=True)
class Connection:
    host: str
    port: int
    database: str
    user: str
    password: str
    options: Mapping[str, str] = field(default_factory=dict)
    driver: str = "postgresql"

    @classmethod
    def of(cls, settings: Settings) -> Connection:
        """A url beats the single fields; a tunnel's open endpoint beats both hosts.

        A tunnel that is yet to be opened raises ``ValueError``: the database must
        not be dialled past it.  ``sources.tunnel.connected`` opens it.
        """
        found = cls.direct(settings)
        if settings.ssh_tunnel.enable:
            if not settings.ssh_tunnel.endpoint:
                raise ValueError("the SSH tunnel isn't open: use sources.tunnel.connected, or give its endpoint")
            found = found.at(*settings.ssh_tunnel.endpoint)
        return found

    @classmethod
    def direct(cls, settings: Settings) -> Connection:
        """The database itself, as a tunnel's far end dials it."""
        return cls._of_url(settings.url) if settings.url else cls(settings.host, settings.port, settings.database, settings.user, settings.password, _options(settings))

    @classmethod
    def _of_url(cls, url: str) -> Connection:
        parts = urlsplit(url)
        missing = [n for n, v in (("host", parts.hostname), ("database", parts.path.strip("/")), ("user", parts.username), ("password", parts.password)) if not v]
        if missing:
            raise ValueError(f"the url has no {', '.join(missing)}")
        options = {"application_name": APPLICATION} | dict(parse_qsl(parts.query, keep_blank_values=True))
        return cls(unquote(parts.hostname), parts.port or 5432, unquote(parts.path.lstrip("/")), unquote(parts.username), unquote(parts.password), options, parts.scheme or "postgresql")

    def at(self, host: str, port: int) -> Connection:
        """The same database by another host and port."""
        return replace(self, host=host, port=port)

    def url(self) -> str:
        """With all parts encoded."""
        query = f"?{urlencode(sorted(self.options.items()))}" if self.options else ""
        return f"{self.driver}://{quote(self.user, safe='')}:{quote(self.password, safe='')}@{self.host}:{self.port}/{quote(self.database, safe='')}{query}"

    def dsn(self) -> str:
        """``name='value'`` pairs; backslashes and quotes are escaped."""
        pairs = {"host": self.host, "port": self.port, "dbname": self.database, "user": self.user, "password": self.password} | dict(self.options)
        return " ".join(f"{k}='{_escaped(str(v))}'" for k, v in pairs.items())

    def jdbc(self) -> dict[str, str]:
        """Options of Spark's JDBC source. TLS material is given by path, so those paths must exist on all executors."""
        names = {"application_name": "ApplicationName", "sslmode": "sslmode", "sslrootcert": "sslrootcert", "sslcert": "sslcert", "sslkey": "sslkey"}
        return {"url": f"jdbc:postgresql://{self.host}:{self.port}/{quote(self.database, safe='')}", "driver": "org.postgresql.Driver", "user": self.user, "password": self.password} | {names.get(k, k): v for k, v in self.options.items()}


def _escaped(value: str) -> str:
    return value.replace("\\", "\\\\").replace("'", "\\'")


def _options(s: Settings) -> dict[str, str]:
    options = {"application_name": APPLICATION}
    if s.ssl_enable:
        options["sslmode"] = s.ssl_mode
        # With a root certificate, clients would verify in the other modes too.
        if s.ssl_mode in ("verify-ca", "verify-full"):
            options["sslrootcert"] = pem_file(s.path("ssl_certificate_authority"), s.ssl_storage_directory, "root.crt")
    if s.ssl_client_certificate_enable:
        options |= {
            "sslcert": pem_file(s.path("ssl_client_certificate"), s.ssl_storage_directory, "client.crt"),
            "sslkey": pem_file(s.path("ssl_client_private_key"), s.ssl_storage_directory, "client.key", private=True),
        }
    return options


def pem_file(value: str, folder: str, name: str, private: bool = False) -> str:
    """A path as it is; PEM text is written below ``folder``, a private key for its owner only."""
    if "-----BEGIN" not in value:
        return value
    Path(folder).mkdir(parents=True, exist_ok=True)
    path = os.path.join(folder, f"{hashlib.sha256(value.encode()).hexdigest()[:12]}-{name}")
    mode = stat.S_IRUSR | stat.S_IWUSR if private else 0o644
    with os.fdopen(os.open(path, os.O_WRONLY | os.O_CREAT | os.O_TRUNC, mode), "w") as f:
        f.write(value)
    os.chmod(path, mode)
    return path
