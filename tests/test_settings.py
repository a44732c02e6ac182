import os
import stat

import pytest
from hypothesis import given
from hypothesis import strategies as st

from tidemark.config import SLOT_NAME, Settings, Tunnel, settings_schema, valid_slot_name
from tidemark.sources.connection import Connection, pem_file
from tidemark.sources.tunnel import command, connected, key_type, opened

BASE = {"host": "db", "user": "u", "password": "p", "database": "d"}


@given(st.from_regex(SLOT_NAME, fullmatch=True))
def test_slot_names_of_the_pattern(name):
    assert valid_slot_name(name)


@pytest.mark.parametrize("name", ["", "pg_x", "a b", "x" * 64, "ä", "slot!"])
def test_bad_slot_names(name):
    assert not valid_slot_name(name)
    with pytest.raises(ValueError):
        Settings.of(BASE | {"replication_slot_name": name})


@pytest.mark.parametrize("wrong", [{"host": None}, {"database": None}, {"user": None}, {"password": None}, {"ssl_mode": "maybe"}, {"default_replication_method": "X"}, {"nonsense": 1}, {"max_record_count": -1}, {"ssh_tunnel": {"enable": True}}, {"ssl_client_certificate_enable": True, "ssl_client_private_key": ""}])
def test_wrong_settings(wrong):
    with pytest.raises(ValueError):
        Settings.of(BASE | wrong)


def test_where_and_schema():
    s = Settings.of(BASE | {"stream_options": {"a-b": {"custom_where_clauses": [" x > 1 ", ""]}}, "filter_schemas": ["s"]})
    assert s.where("a-b") == ["x > 1"] and s.where("c") == [] and s.filter_schemas == ("s",)
    props = settings_schema()["properties"]
    assert props["port"]["default"] == 5432 and "pattern" in props["replication_slot_name"] and props["ssh_tunnel"]["type"] == ["object"]


def test_url_beats_fields():
    c = Connection.of(Settings.of(BASE | {"sqlalchemy_url": "postgresql://us%40er:p%2Fw@host2/db%20x?application_name=mine&x=1"}))
    assert (c.host, c.port, c.user, c.password, c.database) == ("host2", 5432, "us@er", "p/w", "db x")
    assert c.options == {"application_name": "mine", "x": "1"}
    assert Connection._of_url(c.url()) == c
    assert c.jdbc()["url"] == "jdbc:postgresql://host2:5432/db%20x" and c.jdbc()["ApplicationName"] == "mine"


@pytest.mark.parametrize("url", ["postgresql://u:p@h", "postgresql://u@h/d", "postgresql://h/d", "postgresql://u:p@/d"])
def test_url_without_parts(url):
    with pytest.raises(ValueError):
        Connection.of(Settings.of({"url": url}))


def test_dsn_is_escaped():
    c = Connection("h", 1, "d", "u", "it's\\x")
    assert c.dsn() == "host='h' port='1' dbname='d' user='u' password='it\\'s\\\\x'"


def test_other_host_keeps_the_driver():
    c = Connection("h", 1, "d", "u", "p", {"a": "b"}, "postgresql+x").at("i", 2)
    assert (c.host, c.port, c.driver, c.options) == ("i", 2, "postgresql+x", {"a": "b"})


def test_pem_files(tmp_path):
    pem = "-----BEGIN PRIVATE KEY-----\nnot a real key\n"
    path = pem_file(pem, str(tmp_path / "new"), "client.key", private=True)
    assert open(path).read() == pem and stat.S_IMODE(os.stat(path).st_mode) == 0o600
    assert pem_file("/some/where.crt", str(tmp_path), "x") == "/some/where.crt"
    s = Settings.of(BASE | {"ssl_enable": True, "ssl_client_certificate_enable": True, "ssl_client_private_key": pem, "ssl_storage_directory": str(tmp_path)})
    options = Connection.of(s).options
    assert options["sslmode"] == "verify-full" and not options["sslrootcert"].startswith("~") and open(options["sslkey"]).read() == pem


def test_tunnel():
    target = Connection("db", 5432, "d", "u", "p")
    s = Settings.of(BASE | {"ssh_tunnel": {"enable": True, "endpoint": ("relay", 7)}})
    assert (Connection.of(s).host, Connection.of(s).port) == ("relay", 7)
    with opened(Tunnel(), target) as c:
        assert c is target
    started = []

    class Fake:
        def __init__(self, args):
            started.append(args)

        def terminate(self):
            started.append("ended")

        def wait(self):
            pass

    with opened(Tunnel(enable=True, host="b", username="me"), target, wait=0, start=Fake) as c:
        assert c.host == "127.0.0.1" and c.port != 5432
    assert started[1] == "ended" and "StrictHostKeyChecking=no" not in started[0]
    assert command(Tunnel(host="b", username="me"), target, 9, "k")[-2:] == ["127.0.0.1:9:db:5432", "me@b"]
    assert key_type("-----BEGIN EC PRIVATE KEY-----") == "ecdsa"
    with pytest.raises(ValueError):
        key_type("-----BEGIN DSA PRIVATE KEY-----")


def test_a_database_is_not_dialled_past_its_tunnel():
    s = Settings.of(BASE | {"ssh_tunnel": {"enable": True, "host": "gate", "username": "me"}})
    with pytest.raises(ValueError):
        Connection.of(s)

    class Shut:
        def __init__(self, args):
            self.args = args

        def terminate(self):
            pass

        def wait(self):
            pass

    with connected(s, wait=0, start=Shut) as c:
        assert (c.host, c.database) == ("127.0.0.1", "d")
    with pytest.raises(TimeoutError):
        with connected(s, wait=0.2, start=Shut):
            pass


@pytest.mark.parametrize("mode", ["require", "verify-ca"])
def test_root_certificate_is_for_modes_that_verify(mode):
    options = Connection.of(Settings.of(BASE | {"ssl_enable": True, "ssl_mode": mode, "ssl_certificate_authority": "/ca"})).options
    assert options.get("sslrootcert") == ("/ca" if mode == "verify-ca" else None) and options["sslmode"] == mode
