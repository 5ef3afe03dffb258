"""Object stores, content hashes and uploads in parts."""

from __future__ import annotations

import base64
import hashlib
import json
import os
import re
import urllib.parse
from abc import ABC, abstractmethod
from collections.abc import Iterator
from dataclasses import dataclass, field

PART_BYTES, MAX_PARTS = 8 << 20, 10_000


class TooLarge(OSError):
    pass


def chunks(path: str, size: int = PART_BYTES) -> Iterator[bytes]:
    with open(path, "rb") as file:
        while chunk := file.read(size):
            yield chunk


def content_md5(chunk: bytes) -> str:
    return base64.b64encode(hashlib.md5(chunk).digest()).decode()


def etag(path: str, size: int = PART_BYTES, most: int = MAX_PARTS) -> str:
    """A file's entity tag, quotes included: its MD5 if it is smaller than a part, else the MD5 of its parts' MD5s and their number."""
    if os.path.getsize(path) > size * most:
        raise TooLarge(path)
    whole, digests = hashlib.md5(), []
    for chunk in chunks(path, size):
        whole.update(chunk)
        digests.append(hashlib.md5(chunk).digest())
    if os.path.getsize(path) < size:
        return f'"{whole.hexdigest()}"'
    return f'"{hashlib.md5(b"".join(digests)).hexdigest()}-{len(digests)}"'


def file_md5(path: str) -> str:
    whole = hashlib.md5()
    for chunk in chunks(path):
        whole.update(chunk)
    return base64.b64encode(whole.digest()).decode()


def form_encoded(tags: dict[str, str]) -> str:
    return urllib.parse.urlencode(sorted(tags.items()))


def range_end(header: str) -> int:
    """Last byte of a range header such as bytes=0-8388607."""
    m = re.search(r"-(\d+)$", header)
    if not m:
        raise OSError(f"not a range: {header}")
    return int(m[1])


class ObjectStore(ABC):
    """put() stores a whole file; remote_hash() is None where there is no object or its hash can't be read."""

    @abstractmethod
    def check(self) -> None: ...

    @abstractmethod
    def local_hash(self, path: str) -> str: ...

    @abstractmethod
    def remote_hash(self, bucket: str, key: str) -> str | None: ...

    @abstractmethod
    def put(self, path: str, bucket: str, key: str) -> int: ...

    def upload(self, path: str, bucket: str, key: str) -> int:
        """Bytes sent; none where the store has the same content already."""
        remote = self.remote_hash(bucket, key)
        if remote is not None and remote == self.local_hash(path):
            return 0
        return self.put(path, bucket, key)


@dataclass
class MultipartStore(ObjectStore):
    """A store that takes small files whole and larger ones in parts of 8 MiB. client has the store's calls (see FolderClient)."""

    client: object
    options: dict = field(default_factory=dict)
    tags: dict = field(default_factory=dict)
    part_bytes: int = PART_BYTES

    def check(self) -> None:
        self.client.check()

    def local_hash(self, path: str) -> str:
        return etag(path, self.part_bytes)

    def remote_hash(self, bucket: str, key: str) -> str | None:
        try:
            return self.client.head(bucket, key)
        except OSError:
            return None

    def put(self, path: str, bucket: str, key: str) -> int:
        size = os.path.getsize(path)
        options = self.options | ({"tagging": form_encoded(self.tags)} if self.tags else {})
        if size < self.part_bytes:
            raw = b"".join(chunks(path, self.part_bytes))
            self.client.put(bucket, key, raw, content_md5(raw), options)
            return len(raw)
        if size > self.part_bytes * MAX_PARTS:
            raise TooLarge(path)
        session = self.client.create(bucket, key, options)
        try:
            parts = [self.client.part(session, n, chunk, content_md5(chunk)) for n, chunk in enumerate(chunks(path, self.part_bytes), 1)]
            self.client.complete(session, parts)
        except Exception:
            self.client.abort(session)
            raise
        return size


@dataclass
class ResumableStore(ObjectStore):
    """A store that takes a file through a session, chunk after chunk; each but the last must be acknowledged to its end."""

    client: object
    headers: dict = field(default_factory=dict)
    part_bytes: int = PART_BYTES

    def check(self) -> None:
        self.client.check()

    def local_hash(self, path: str) -> str:
        return file_md5(path)

    def remote_hash(self, bucket: str, key: str) -> str | None:
        try:
            header = self.client.hash_header(bucket, key)
        except OSError:
            return None
        return header.split("md5=", 1)[1] if header and "md5=" in header else None

    def put(self, path: str, bucket: str, key: str) -> int:
        session = self.client.start(bucket, key, self.headers)
        sent = 0
        try:
            for chunk in chunks(path, self.part_bytes):
                end = sent + len(chunk) - 1
                if len(chunk) < self.part_bytes:
                    self.client.finish(session, chunk, f"bytes {sent}-{end}/{end + 1}")
                    return end + 1
                status, got = self.client.send(session, chunk, f"bytes {sent}-{end}/*")
                if status != 308 or range_end(got) != end:
                    raise OSError(f"the store has {got}, not all up to {end}")
                sent = end + 1
            self.client.finish(session, b"", f"bytes */{sent}")
            return sent
        except Exception:
            try:
                self.client.cancel(session)
            except OSError:
                pass
            raise


class FolderClient:
    """Both kinds of client over a local folder, for tests and for mounted stores."""

    def __init__(self, root: str):
        self.root = root
        self.calls: list[tuple] = []

    def _path(self, bucket: str, key: str) -> str:
        path = os.path.normpath(os.path.join(self.root, bucket, key))
        if not path.startswith(os.path.join(os.path.normpath(self.root), "")):
            raise OSError(f"not a key: {key}")
        return path

    def check(self) -> None:
        if not os.path.isdir(self.root):
            raise OSError(f"no such store: {self.root}")

    def _store(self, bucket: str, key: str, raw: bytes, tag: str) -> None:
        path = self._path(bucket, key)
        os.makedirs(os.path.dirname(path), exist_ok=True)
        for name, content in ((path, raw), (f"{path}.etag", tag.encode())):
            with open(f"{name}.part", "wb") as file:
                file.write(content)
            os.replace(f"{name}.part", name)

    def head(self, bucket: str, key: str) -> str:
        with open(f"{self._path(bucket, key)}.etag") as file:
            return file.read()

    def hash_header(self, bucket: str, key: str) -> str:
        return "crc32c=AAAAAA==,md5=" + file_md5(self._path(bucket, key))

    def put(self, bucket: str, key: str, raw: bytes, md5: str, options: dict) -> None:
        self.calls.append(("put", key, options))
        if content_md5(raw) != md5:
            raise OSError("content differs from its MD5")
        self._store(bucket, key, raw, f'"{hashlib.md5(raw).hexdigest()}"')

    def create(self, bucket: str, key: str, options: dict) -> dict:
        self.calls.append(("create", key, options))
        return {"bucket": bucket, "key": key, "parts": {}}

    def part(self, session: dict, n: int, raw: bytes, md5: str) -> tuple[int, bytes]:
        self.calls.append(("part", n))
        if content_md5(raw) != md5:
            raise OSError("content differs from its MD5")
        session["parts"][n] = raw
        return n, hashlib.md5(raw).digest()

    def complete(self, session: dict, parts: list[tuple[int, bytes]]) -> None:
        self.calls.append(("complete", len(parts)))
        tag = hashlib.md5(b"".join(d for _, d in parts)).hexdigest()
        self._store(session["bucket"], session["key"], b"".join(session["parts"][n] for n, _ in parts), f'"{tag}-{len(parts)}"')

    def abort(self, session: dict) -> None:
        self.calls.append(("abort",))

    def start(self, bucket: str, key: str, headers: dict) -> dict:
        self.calls.append(("start", key, headers))
        return {"bucket": bucket, "key": key, "raw": b""}

    def send(self, session: dict, raw: bytes, span: str) -> tuple[int, str]:
        self.calls.append(("send", span))
        session["raw"] += raw
        return 308, f"bytes=0-{len(session['raw']) - 1}"

    def finish(self, session: dict, raw: bytes, span: str) -> None:
        self.calls.append(("finish", span))
        whole = session["raw"] + raw
        self._store(session["bucket"], session["key"], whole, f'"{hashlib.md5(whole).hexdigest()}"')

    def cancel(self, session: dict) -> None:
        self.calls.append(("cancel",))


def read_checkpoints(folder: str) -> list[dict]:
    """Checkpoints of a state file of version 1. A file that was being written when its writer died is taken and put in place."""
    fresh, path = os.path.join(folder, "checkpoints.new.json"), os.path.join(folder, "checkpoints.json")
    for name in (fresh, path):
        try:
            with open(name) as file:
                state = json.load(file)
            found = state["checkpoints"] if state["version"] == "1" else None
        except (OSError, ValueError, KeyError, TypeError):
            continue
        if found is None:
            continue
        if name == fresh:
            os.replace(fresh, path)
        return found
    return []


def write_checkpoints(folder: str, checkpoints: list[dict]) -> bool:
    """Writes checkpoints in order under another name, then renames. False if nothing has changed."""
    order = lambda c: (*(c["upload_key"][k] for k in ("filename", "bucket", "object_key")), c["upload_at"], c["expire_at"])
    state = {"version": "1", "checkpoints": sorted(checkpoints, key=order)}
    if read_checkpoints(folder) == state["checkpoints"]:
        return False
    os.makedirs(folder, exist_ok=True)
    fresh = os.path.join(folder, "checkpoints.new.json")
    with open(fresh, "w") as file:
        json.dump(state, file)
        file.flush()
        os.fsync(file.fileno())
    os.replace(fresh, os.path.join(folder, "checkpoints.json"))
    return True
