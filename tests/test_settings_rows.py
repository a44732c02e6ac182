"""Settings, connections, tunnels and registration, as rows against SQL that lists what they must be."""

import base64
import os
import tempfile
from collections.abc import Callable, Iterable
from dataclasses import replace

import duckdb
import pytest

from tidemark import queries as base
from tidemark.config import SSL_MODES, Settings, Tunnel, settings_schema
from tidemark.operators.dispatch import Routes
from tidemark.plans.catalog import StreamSpec
from tidemark.sources import tunnel, wal
from tidemark.sources.connection import Connection, pem_file

_URL = "postgresql://u:p@localhost/db"


def _or_error(make: Callable[[], object]) -> str:
    try:
        return str(make())
    except (ValueError, TimeoutError) as e:
        return type(e).__name__


class _Process:
    """Stands for the system's ssh."""

    def __init__(self, args: list[str]):
        self.args = args

    def terminate(self) -> None:
        pass

    def wait(self) -> None:
        pass


_WRONG = [("whole", {}), ("no host", {"host": None}), ("no database", {"database": None}), ("ssl mode", {"ssl_mode": "maybe"}), ("slot", {"replication_slot_name": "pg_x"}), ("key missing", {"ssl_client_certificate_enable": True, "ssl_client_private_key": ""}), ("method", {"default_replication_method": "X"}), ("unknown", {"nonsense": 1}), ("negative limit", {"max_record_count": -1}), ("url alone", {"url": _URL, "host": None, "user": None})]
_SETTINGS = [
    ("host", "string,null", None), ("port", "integer", "5432"), ("user", "string,null", None), ("password", "string,null", None), ("database", "string,null", None), ("url", "string,null", None), ("replication_slot_name", "string", "tidemark"), ("replication_max_run_seconds", "number", "600"), ("replication_idle_exit_seconds", "number", "60"),
    ("max_record_count", "integer,null", None), ("filter_schemas", "array", None), ("dates_as_string", "boolean", "False"), ("json_as_object", "boolean", "False"), ("stream_options", "object", None), ("ssh_tunnel", "object", None), ("ssl_enable", "boolean", "False"), ("ssl_client_certificate_enable", "boolean", "False"), ("ssl_mode", "string", "verify-full"),
    ("ssl_certificate_authority", "string", "~/.postgresql/root.crt"), ("ssl_client_certificate", "string", "~/.postgresql/postgresql.crt"), ("ssl_client_private_key", "string", "~/.postgresql/postgresql.key"), ("ssl_storage_directory", "string", ".secrets"), ("default_replication_method", "string", "FULL_TABLE"), ("log_based_single_connection", "boolean", "True"),
    ("auto_bootstrap_log_based", "boolean", "False"), ("start_date", "string,null", None), ("flattening_enabled", "boolean", "False"), ("flattening_max_depth", "integer", "1"), ("evolve_schemas", "boolean", "True"), ("stream_maps", "object", None), ("bootstrap_chunks", "integer", "1"),
]
_CONNECTIONS = [
    ("url", "postgresql+x://us%40er:p%2Fw@db1:5432/d%20b?application_name=mine&x=it%27s"), ("dsn", "host='db1' port='5432' dbname='d b' user='us@er' password='p/w' application_name='mine' x='it\\'s'"), ("jdbc", "jdbc:postgresql://db1:5432/d%20b"), ("jdbc name", "mine"),
    ("moved", "postgresql+x://us%40er:p%2Fw@relay:7/d%20b?application_name=mine&x=it%27s"), ("plain url", "postgresql://u:a%27b%5Cc@db2:5432/d?application_name=tidemark"), ("plain dsn", "host='db2' port='5432' dbname='d' user='u' password='a\\'b\\\\c' application_name='tidemark'"), ("plain name", "tidemark"),
]
_CHECKS = [(n, "True" if n in ("whole", "url alone") else "ValueError") for n, _ in _WRONG]


def replication_options(spark, sf_dir):
    routes = Routes([base.event_stream(), replace(base.event_stream(), schema="a,b", table="c.d")])
    return spark.createDataFrame(sorted(wal.replication_options(routes.add_tables).items()), "option string, value string")


def connection_forms(spark, sf_dir):
    """One set of parameters as URL, DSN and JDBC options; by another host nothing else changes; options can be overridden."""
    c = Connection.of(Settings.of({"sqlalchemy_url": "postgresql+x://us%40er:p%2Fw@db1/d%20b?application_name=mine&x=it's"}))
    plain = Connection.of(Settings(host="db2", user="u", password="a'b\\c", database="d"))
    rows = [("url", c.url()), ("dsn", c.dsn()), ("jdbc", c.jdbc()["url"]), ("jdbc name", c.jdbc()["ApplicationName"]), ("moved", c.at("relay", 7).url()), ("plain url", plain.url()), ("plain dsn", plain.dsn()), ("plain name", plain.options["application_name"])]
    return spark.createDataFrame(rows, "form string, value string")


def tls_options(spark, sf_dir):
    """Certificates by path stay paths; a root certificate is given only to the modes that verify."""
    rows = []
    for mode in SSL_MODES:
        s = Settings(host="h", user="u", password="p", database="d", ssl_enable=True, ssl_mode=mode, ssl_certificate_authority="/ca.crt", ssl_client_certificate_enable=True, ssl_client_certificate="/c.crt", ssl_client_private_key="/c.key")
        o = Connection.of(s).options
        rows.append((mode, o["sslmode"], o.get("sslrootcert"), o["sslcert"], o["sslkey"]))
    return spark.createDataFrame(rows, "mode string, sslmode string, root string, cert string, key string")


def pem_files(spark, sf_dir):
    """PEM text becomes a file, a private key for its owner only."""
    text, rows = "-----BEGIN PRIVATE KEY-----\nnot a key\n", []
    with tempfile.TemporaryDirectory() as folder:
        for name, private in (("client.crt", False), ("client.key", True)):
            path = pem_file(text, folder, name, private)
            rows.append((name, oct(os.stat(path).st_mode & 0o777), open(path).read() == text))
        rows.append((pem_file("/some/where.crt", folder, "x"), None, None))
    return spark.createDataFrame(rows, "file string, mode string, same boolean")


def ssh_key_types(spark, sf_dir):
    def openssh(kind: bytes) -> str:
        body = base64.b64encode(b"openssh-key-v1\0" + kind + b"\0" * 40).decode()
        return f"-----BEGIN OPENSSH PRIVATE KEY-----\n{body}\n-----END OPENSSH PRIVATE KEY-----\n"

    cases = {"rsa pem": "-----BEGIN RSA PRIVATE KEY-----\n", "ec pem": "-----BEGIN EC PRIVATE KEY-----\n", "dsa pem": "-----BEGIN DSA PRIVATE KEY-----\n"} | {k: openssh(k.encode()) for k in ("ssh-rsa", "ecdsa-sha2-nistp256", "ssh-ed25519", "ssh-dss")}
    return spark.createDataFrame([(name, _or_error(lambda p=pem: tunnel.key_type(p))) for name, pem in cases.items()], "key string, kind string")


def tunnel_hosts(spark, sf_dir):
    """Which host is dialled: the database, a tunnel's open endpoint, a tunnel's local port; never the database past its tunnel."""

    def dialled(t: Tunnel) -> str:
        return Connection.of(Settings(url=_URL, ssh_tunnel=t)).host

    def by_port() -> str:
        with tunnel.connected(Settings(url=_URL, ssh_tunnel=Tunnel(enable=True, host="gate", username="me")), wait=0, start=_Process) as c:
            return c.host

    def shut() -> str:
        with tunnel.connected(Settings(url=_URL, ssh_tunnel=Tunnel(enable=True, host="gate", username="me")), wait=0.2, start=_Process) as c:
            return c.host

    cases = {"none": lambda: dialled(Tunnel()), "endpoint": lambda: dialled(Tunnel(enable=True, endpoint=("relay", 7))), "not open": lambda: dialled(Tunnel(enable=True, host="gate")), "opened": by_port, "shut": shut}
    return spark.createDataFrame([(n, _or_error(f)) for n, f in cases.items()], "tunnel string, host string")


def settings_checks(spark, sf_dir):
    start = {"host": "h", "user": "u", "password": "p", "database": "d"}
    return spark.createDataFrame([(n, _or_error(lambda w=w: bool(Settings.of(start | w)))) for n, w in _WRONG], "settings string, result string")


def settings_listed(spark, sf_dir):
    props = settings_schema()["properties"]
    return spark.createDataFrame([(n, ",".join(p["type"]), str(p["default"]) if "default" in p else None) for n, p in props.items()], "name string, kinds string, value string")


def registration_checks(spark, sf_dir):
    one = base.event_stream()
    cases: dict[str, Iterable[StreamSpec]] = {"one": [one], "two": [one, replace(one, table="t")], "none": [], "twice": [one, one], "no schema": [replace(one, schema="")]}
    return spark.createDataFrame([(n, _or_error(lambda s=s: len(Routes(s).streams))) for n, s in cases.items()], "streams string, result string")


values = base._values
SQL = {
    "replication_options": r"SELECT * FROM (VALUES ('add-tables', 'public.events,a\,b.c\.d'), ('format-version', '2'), ('include-transaction', 'False')) t(option, value)",
    "connection_forms": f"SELECT * FROM (VALUES {values(_CONNECTIONS)}) t(form, value)",
    "tls_options": "SELECT mode, mode AS sslmode, CASE WHEN starts_with(mode, 'verify') THEN '/ca.crt' END AS root, '/c.crt' AS cert, '/c.key' AS key FROM (VALUES ('disable'), ('allow'), ('prefer'), ('require'), ('verify-ca'), ('verify-full')) t(mode)",
    "pem_files": "SELECT * FROM (VALUES ('client.crt', '0o644', true), ('client.key', '0o600', true), ('/some/where.crt', NULL, NULL)) t(file, mode, same)",
    "ssh_key_types": "SELECT * FROM (VALUES ('rsa pem', 'rsa'), ('ec pem', 'ecdsa'), ('dsa pem', 'ValueError'), ('ssh-rsa', 'rsa'), ('ecdsa-sha2-nistp256', 'ecdsa'), ('ssh-ed25519', 'ed25519'), ('ssh-dss', 'ValueError')) t(key, kind)",
    "tunnel_hosts": "SELECT * FROM (VALUES ('none', 'localhost'), ('endpoint', 'relay'), ('not open', 'ValueError'), ('opened', '127.0.0.1'), ('shut', 'TimeoutError')) t(tunnel, host)",
    "settings_checks": f"SELECT * FROM (VALUES {values(_CHECKS)}) t(settings, result)",
    "settings_listed": f"SELECT * FROM (VALUES {values(_SETTINGS)}) t(name, kinds, value)",
    "registration_checks": "SELECT * FROM (VALUES ('one', '1'), ('two', '2'), ('none', 'ValueError'), ('twice', 'ValueError'), ('no schema', 'ValueError')) t(streams, result)",
}


@pytest.mark.parametrize("name", SQL)
def test_rows(spark, name):
    df = globals()[name](spark, None)
    cur = duckdb.connect().execute(SQL[name])
    names = [d[0] for d in cur.description]
    assert sorted(names) == sorted(df.columns)
    assert sorted(repr(tuple(r[names.index(c)] for c in df.columns)) for r in cur.fetchall()) == sorted(repr(tuple(r)) for r in df.collect())
