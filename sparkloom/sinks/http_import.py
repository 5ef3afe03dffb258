"""Import sink: series as gzip-compressed lines of JSON, posted in batches to the endpoint that each one's labels give."""

from __future__ import annotations

import gzip
import ssl
import time
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame

from sparkloom.config import ConfigError, ImportSink, Tls
from sparkloom.operators.encode import encode
from sparkloom.registry import sink
from sparkloom.streaming.retry import next_delay


def body(lines: list[str]) -> bytes:
    return gzip.compress("".join(f"{line}\n" for line in lines).encode())


@dataclass(frozen=True)
class Request:
    """How requests are made: settings of a sink's request block, and its TLS files."""

    timeout_secs: float = 60.0
    retry_attempts: int = 5
    retry_initial_backoff_secs: float = 1.0
    tls: Tls | None = None

    @classmethod
    def of(cls, settings: ImportSink) -> Request:
        unknown = set(settings.request) - {"timeout_secs", "retry_attempts", "retry_initial_backoff_secs"}
        if unknown:
            raise ConfigError(f"unknown keys of request: {', '.join(sorted(unknown))}")
        return cls(tls=settings.tls, **settings.request)

    def context(self) -> ssl.SSLContext | None:
        if self.tls is None or not self.tls.enabled:
            return None
        made = ssl.create_default_context(cafile=self.tls.ca_file)
        made.load_cert_chain(self.tls.crt_file, self.tls.key_file)
        return made


def post(endpoint: str, lines: list[str], how: Request = Request()) -> int:
    """Status of a request, tried again after connections that fail and statuses 429 and 5xx; a bad endpoint is an error of the request, not of the query's start."""
    if urllib.parse.urlsplit(endpoint).scheme not in ("http", "https"):
        raise ValueError(f"not an endpoint: {endpoint}")
    raw, delay = body(lines), how.retry_initial_backoff_secs
    for left in range(how.retry_attempts, -1, -1):
        request = urllib.request.Request(endpoint, raw, {"Content-Encoding": "gzip"}, method="POST")
        try:
            with urllib.request.urlopen(request, timeout=how.timeout_secs, context=how.context()) as answer:
                return answer.status
        except urllib.error.HTTPError as e:
            if not left or e.code != 429 and e.code < 500:
                raise
        except OSError:
            if not left:
                raise
        time.sleep(delay)
        delay = next_delay(delay)


def healthy(url: str | None) -> bool:
    """True without an endpoint to ask; else whether a GET answers 2xx."""
    if url is None:
        return True
    try:
        with urllib.request.urlopen(url, timeout=10) as answer:
            return 200 <= answer.status < 300
    except OSError:
        return False


def send(rows: Iterator, most: int, seconds: float, how: Request = Request()) -> None:
    """Posts rows (endpoint, line): a batch goes when it has most lines, when any row comes and it is that old, and at the end."""
    held: dict[str, tuple[float, list[str]]] = {}
    for row in rows:
        _, lines = held.setdefault(row.endpoint, (time.monotonic(), []))
        lines.append(row.line)
        if len(lines) >= most:
            post(row.endpoint, held.pop(row.endpoint)[1], how)
        while held and time.monotonic() - (oldest := next(iter(held.items())))[1][0] >= seconds:  # in order of their first lines
            post(oldest[0], held.pop(oldest[0])[1], how)
    for endpoint, (_, lines) in held.items():
        post(endpoint, lines, how)


@sink("vm_import")
class HttpImport:
    def __init__(self, settings: ImportSink):
        self.settings, self.how = settings, Request.of(settings)

    def write(self, series: DataFrame) -> None:
        """Posts a batch DataFrame. A task sends the endpoints it holds, so a hot endpoint is sent by many tasks."""
        most, seconds, how = self.settings.batch_events, self.settings.batch_seconds, self.how
        encode(series, self.settings.endpoint).foreachPartition(lambda rows: send(rows, most, seconds, how))

    def start(self, series: DataFrame, checkpoint: str):  # noqa: ANN201
        """Starts a streaming query that posts each micro-batch; refuses an unhealthy service."""
        if not healthy(self.settings.healthcheck_endpoint):
            raise ConnectionError("the import service is not healthy")
        each = lambda df, _: self.write(df)
        return series.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(processingTime=f"{self.settings.batch_seconds:g} seconds").start()


def write_files(series: DataFrame, template: str, path: str) -> None:
    """The same lines as gzip files, in a folder for each endpoint."""
    lines = encode(series, template)
    lines.write.partitionBy("endpoint").option("compression", "gzip").text(path)
