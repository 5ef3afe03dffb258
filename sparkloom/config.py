"""Settings of sources and sinks, checked when they are made. Unknown keys are refused."""

from __future__ import annotations

import os
from dataclasses import dataclass, field, fields


class ConfigError(ValueError):
    pass


@dataclass(frozen=True)
class Tls:
    """Any of the three files given means that all three are, and that each can be opened."""

    ca_file: str | None = None
    crt_file: str | None = None
    key_file: str | None = None

    def __post_init__(self) -> None:
        given = [self.ca_file, self.crt_file, self.key_file]
        if any(given) and not all(given):
            raise ConfigError("ca_file, crt_file and key_file go together")
        for path in filter(None, given):
            if not os.access(path, os.R_OK):
                raise ConfigError(f"{path} can't be opened")

    @property
    def enabled(self) -> bool:
        return self.ca_file is not None


class Settings:
    #: Other names under which a key may be given.
    ALIASES: dict[str, str] = {}

    @classmethod
    def of(cls, given: dict) -> Settings:
        named = {cls.ALIASES.get(k, k): v for k, v in given.items()}
        unknown = set(named) - {f.name for f in fields(cls)}
        if unknown:
            raise ConfigError(f"unknown keys: {', '.join(sorted(unknown))}")
        try:
            return cls(**named)
        except TypeError as e:
            raise ConfigError(str(e)) from e


@dataclass(frozen=True)
class UsageSource(Settings):
    pd_address: str
    tls: Tls | None = None
    init_retry_delay_seconds: float = 1.0
    topology_fetch_interval_seconds: float = 30.0


@dataclass(frozen=True)
class ImportSink(Settings):
    endpoint: str
    healthcheck_endpoint: str | None = None
    tls: Tls | None = None
    request: dict = field(default_factory=dict)
    batch_events: int = 1000
    batch_seconds: float = 1.0


@dataclass(frozen=True)
class FileNames(Settings):
    ALIASES = {"glob_minimum_cooldown": "glob_minimum_cooldown_ms"}
    include: tuple[str, ...]
    exclude: tuple[str, ...] = ()
    glob_minimum_cooldown_ms: int = 1000


@dataclass(frozen=True)
class S3Upload(Settings):
    ALIASES = {"delay_upload": "delay_upload_secs", "expire_after": "expire_after_secs"}
    bucket: str
    options: dict = field(default_factory=dict)
    tags: dict = field(default_factory=dict)
    region: str | None = None
    endpoint: str | None = None
    tls: Tls | None = None
    auth: dict = field(default_factory=dict)
    data_dir: str | None = None
    delay_upload_secs: int = 10
    expire_after_secs: int = 1800


@dataclass(frozen=True)
class GcsUpload(Settings):
    ALIASES = {"delay_upload": "delay_upload_secs", "expire_after": "expire_after_secs"}
    bucket: str
    acl: str | None = None
    storage_class: str | None = None
    metadata: dict = field(default_factory=dict)
    auth: dict = field(default_factory=dict)
    tls: Tls | None = None
    data_dir: str | None = None
    delay_upload_secs: int = 10
    expire_after_secs: int = 1800

    def headers(self) -> dict[str, str]:
        """Request headers; a name or value that can't be one is refused."""
        out = {"x-goog-storage-class": self.storage_class or "STANDARD"}
        if self.acl:
            out["x-goog-acl"] = self.acl
        out |= {f"x-goog-meta-{k}": str(v) for k, v in self.metadata.items()}
        for k, v in out.items():
            if not k.isascii() or any(c.isspace() or ord(c) < 33 for c in k) or any(ord(c) < 32 or ord(c) > 126 for c in v):
                raise ConfigError(f"not a header: {k}")
        return out
