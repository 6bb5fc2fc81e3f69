"""Calls of all tasks of a job, held to one rate and stopped together when one of them is refused."""

from __future__ import annotations

import hmac
import json
import secrets
import select
import socket
import socketserver
import threading
import time
from collections.abc import Iterator
from contextlib import contextmanager, suppress
from dataclasses import dataclass

from pyspark.sql import SparkSession

#: Longest wait in seconds that a task is told at once, so that a refusal is heard of soon; time limit of a question; bytes of one.
HORIZON, TIME_LIMIT, QUESTION = 1.0, 60, 4096


class Unauthorized(RuntimeError):
    """The endpoint refuses the credentials; no call can succeed, so the job fails."""


class Cancelled(RuntimeError):
    """Another call was refused."""


class Unreachable(OSError):
    """The gate doesn't answer; whether a call was refused can't be known, so the task fails."""


class _Line:
    """A worker's connection to a gate, kept open: a question and its answer at a time, and news of a refusal that comes unasked."""

    def __init__(self, door: Door):
        self.door, self.lock, self.held, self.free, self.stopped = door, threading.Lock(), b"", False, False
        self.to = socket.create_connection((door.host, door.port), TIME_LIMIT)
        self.to.setsockopt(socket.IPPROTO_TCP, socket.TCP_NODELAY, 1)
        self.news = select.poll()
        self.news.register(self.to, select.POLLIN)

    def _hear(self) -> dict:
        while b"\n" not in self.held:
            if not (more := self.to.recv(QUESTION)):
                raise ConnectionError("the gate hung up")
            self.held += more
        told, self.held = self.held.split(b"\n", 1)
        told = json.loads(told)
        if not told["known"]:
            raise ValueError("the gate doesn't know the secret")
        self.stopped |= told["stop"]
        self.free = told["free"]
        return told

    def ask(self, word: str, why: str = "") -> dict:
        with self.lock:
            self.to.sendall(json.dumps({"secret": self.door.secret, "word": word, "why": why[:500]}).encode() + b"\n")
            return self._hear()

    def refused(self) -> bool:
        """Whether a refusal is known by now; nothing is sent."""
        with self.lock:
            while not self.stopped and (self.held or self.news.poll(0)):
                self._hear()
            return self.stopped

    def ended(self) -> bool:
        """Whether the gate has hung up."""
        return bool(self.news.poll(0)) and not self.to.recv(1, socket.MSG_PEEK)


_lines: dict[Door, _Line] = {}
_lines_lock = threading.Lock()


@dataclass(frozen=True)
class Door:
    """What tasks get of a gate: where it is. All calls of a worker share one connection."""

    host: str
    port: int
    secret: str

    @contextmanager
    def _line(self) -> Iterator[_Line]:
        try:
            with _lines_lock:
                for door in [d for d, line in _lines.items() if d != self and line.ended()]:
                    _lines.pop(door).to.close()
                if self not in _lines:
                    _lines[self] = _Line(self)
                line = _lines[self]
            yield line
        except (OSError, ValueError) as error:
            with _lines_lock:
                if broken := _lines.pop(self, None):
                    broken.to.close()
            if isinstance(error, ValueError):
                raise
            raise Unreachable(f"the gate at {self.host}:{self.port} doesn't answer: {error!r}") from error

    def enter(self) -> None:
        """Waits for a turn; Cancelled if a call was refused. An unreachable gate is the task's failure. A gate without a rate is asked once."""
        while True:
            with self._line() as line:
                told = {"go": True, "wait": 0} if line.free else line.ask("enter")
                stop = line.refused()
            if not stop and told["wait"]:
                time.sleep(told["wait"])
                with self._line() as line:
                    stop = line.refused()
            if stop:
                raise Cancelled("another call was refused")
            if told["go"]:
                return

    def refuse(self, why: str) -> None:
        with self._line() as line:
            line.ask("refused", why)


class _Question(socketserver.StreamRequestHandler):
    timeout = TIME_LIMIT

    def handle(self) -> None:
        gate: Gate = self.server.gate
        try:
            while raw := self.rfile.readline(QUESTION):
                asked = json.loads(raw)
                if not hmac.compare_digest(str(asked.get("secret")).encode(), gate.door.secret.encode()):
                    self.wfile.write(b'{"known": false}\n')
                    return
                self.connection.settimeout(None)  # a worker that has its leave says no more
                gate.hears(self.connection)
                first = asked["word"] == "refused" and gate.close(asked["why"])
                self.wfile.write(_line_of(gate.turn()))
                if first:
                    gate.tell()
                    gate.spark.sparkContext.cancelJobsWithTag(gate.tag)
        finally:
            gate.hears(self.connection, False)


def _line_of(told: dict) -> bytes:
    return json.dumps({"known": True, **told}).encode() + b"\n"


class _Server(socketserver.ThreadingTCPServer):
    daemon_threads, allow_reuse_address, request_queue_size = True, True, 512

    def handle_error(self, request, client_address) -> None:
        """A broken question is its task's trouble, which asks again when it is retried."""


class Gate:
    """A context in whose jobs all tasks ask, before each call, for a turn.

    per_second: calls a second over all tasks; 0: as many as there are. The first refusal stops them all: it is told to all workers at once,
    tasks that Spark retries hear it too, and the context's jobs are cancelled by their tag. The end of the context then raises Unauthorized.
    Tasks reach the driver under spark.driver.host; port 0 takes any free one. A worker keeps one connection. Where there is a rate, its
    questions, which carry a secret of the context, are a few hundred bytes for each turn; where there is none it asks once, and looks
    before each call whether a refusal has been told, so the driver's work doesn't grow with the calls.
    """

    def __init__(self, spark: SparkSession, per_second: float = 0.0, port: int = 0):
        if per_second < 0:
            raise ValueError("per_second must not be negative")
        self.spark, self.per_second, self.port, self.why = spark, per_second, port, None
        self.tag, self._lock, self._next = f"calls-{secrets.token_hex(8)}", threading.Lock(), 0.0
        self._heard: set[socket.socket] = set()

    def turn(self) -> dict:
        with self._lock:
            now = time.monotonic()
            at = max(now, self._next)
            if self.why is not None or at - now > HORIZON:
                return {"stop": self.why is not None, "go": False, "wait": HORIZON, "free": False}
            if self.per_second:
                self._next = at + 1 / self.per_second
            return {"stop": False, "go": True, "wait": at - now, "free": not self.per_second}

    def close(self, why: str) -> bool:
        """Whether this is the first refusal."""
        with self._lock:
            first, self.why = self.why is None, why if self.why is None else self.why
            return first

    def hears(self, line: socket.socket, on: bool = True) -> None:
        """Whether a worker's connection is told of a refusal."""
        with self._lock:
            (self._heard.add if on else self._heard.discard)(line)

    def tell(self) -> None:
        """The refusal goes to all workers."""
        with self._lock:
            lines = list(self._heard)
        for line in lines:
            with suppress(OSError):
                line.sendall(_line_of(self.turn()))

    def __enter__(self) -> Gate:
        conf = self.spark.sparkContext.getConf()
        host = conf.get("spark.driver.host")
        self._server = _Server((conf.get("spark.driver.bindAddress", host), self.port), _Question)
        self._server.gate, self.door = self, Door(host, self._server.server_address[1], secrets.token_hex(16))
        threading.Thread(target=self._server.serve_forever, args=(0.1,), daemon=True).start()
        self.spark.sparkContext.addJobTag(self.tag)
        return self

    def __exit__(self, kind, error, trace) -> None:
        self.spark.sparkContext.removeJobTag(self.tag)
        self._server.shutdown()
        self._server.server_close()
        with self._lock:
            lines = list(self._heard)
        for line in lines:
            with suppress(OSError):
                line.shutdown(socket.SHUT_RDWR)
        if self.why is not None:
            raise Unauthorized(self.why) from error
