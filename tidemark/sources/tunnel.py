"""SSH tunnels, outside the engine.

A port that only the driver can reach is no use to executors, so a tunnel is an
endpoint that all of them see.  ``opened`` starts the system's ``ssh`` where
that suffices (local runs); host keys are checked against known hosts.
"""

from __future__ import annotations

import base64
import os
import socket
import subprocess
import tempfile
import time
from collections.abc import Iterator
from contextlib import contextmanager

from tidemark.config import Settings, Tunnel
from tidemark.sources.connection import Connection

#: Names of key types in public key blobs, and PEM headers.
_TYPES = {b"ssh-rsa": "rsa", b"ecdsa-sha2": "ecdsa", b"ssh-ed25519": "ed25519"}
_HEADERS = {"RSA PRIVATE KEY": "rsa", "EC PRIVATE KEY": "ecdsa"}


def key_type(pem: str) -> str:
    """``rsa``, ``ecdsa`` or ``ed25519``; anything else raises ``ValueError``.

    OpenSSH files have the public part unencrypted, so a passphrase isn't needed.
    """
    for header, kind in _HEADERS.items():
        if f"-----BEGIN {header}-----" in pem:
            return kind
    if "-----BEGIN OPENSSH PRIVATE KEY-----" in pem:
        body = "".join(x for x in pem.splitlines() if x and "-----" not in x)
        raw = base64.b64decode(body + "=" * (-len(body) % 4))
        for name, kind in _TYPES.items():
            if name in raw[:200]:
                return kind
    raise ValueError("no key of a known type")


def command(tunnel: Tunnel, target: Connection, port: int, key_file: str | None) -> list[str]:
    return ["ssh", "-N", "-o", "ExitOnForwardFailure=yes", "-o", "BatchMode=yes", "-p", str(tunnel.port), *(["-i", key_file] if key_file else []), "-L", f"127.0.0.1:{port}:{target.host}:{target.port}", f"{tunnel.username}@{tunnel.host}"]


@contextmanager
def connected(settings: Settings, **more) -> Iterator[Connection]:
    """The settings' database, by way of their tunnel if they have one; it is closed afterwards."""
    with opened(settings.ssh_tunnel, Connection.direct(settings), **more) as found:
        yield found


@contextmanager
def opened(tunnel: Tunnel, target: Connection, wait: float = 10, start=subprocess.Popen) -> Iterator[Connection]:
    """``target`` by way of the tunnel; without one, or with an open endpoint, nothing is started."""
    if not tunnel.enable:
        yield target
        return
    if tunnel.endpoint:
        yield target.at(*tunnel.endpoint)
        return
    with socket.socket() as s:
        s.bind(("127.0.0.1", 0))
        port = s.getsockname()[1]
    with tempfile.TemporaryDirectory() as folder:
        key_file = None
        if tunnel.private_key:
            key_type(tunnel.private_key)
            key_file = os.path.join(folder, "key")
            with os.fdopen(os.open(key_file, os.O_WRONLY | os.O_CREAT, 0o600), "w") as f:
                f.write(tunnel.private_key)
        process = start(command(tunnel, target, port, key_file))
        try:
            end = time.monotonic() + wait
            while time.monotonic() < end:
                with socket.socket() as s:
                    if s.connect_ex(("127.0.0.1", port)) == 0:
                        break
                time.sleep(0.1)
            else:
                if wait:
                    raise TimeoutError(f"the SSH tunnel to {tunnel.host} didn't open within {wait} s")
            yield target.at("127.0.0.1", port)
        finally:
            process.terminate()
            process.wait()
