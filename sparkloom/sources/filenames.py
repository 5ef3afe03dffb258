"""Source of file names: regular files that match include globs and no exclude glob, listed anew at every trigger."""

from __future__ import annotations

import fnmatch
import glob
import logging
import os
import time
from collections.abc import Iterator

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition, SimpleDataSourceStreamReader

from sparkloom.config import ConfigError, FileNames
from sparkloom.registry import source

log = logging.getLogger(__name__)
SCHEMA = "message string, modified timestamp, length long"


def check_glob(pattern: str) -> str:
    if pattern.count("[") != pattern.count("]") or not pattern:
        raise ConfigError(f"not a glob: {pattern!r}")
    return pattern


def matches(settings: FileNames) -> list[str]:
    """Paths in order; ** spans folders. What can't be listed is logged and left out, names that aren't UTF-8 are left out."""
    found: set[str] = set()
    for pattern in settings.include:
        try:
            found.update(glob.iglob(check_glob(pattern), recursive=True, include_hidden=True))
        except OSError as e:
            log.error("listing %s failed: %s", pattern, e)
    gone = [check_glob(p) for p in settings.exclude]
    keep = []
    for path in sorted(found):
        try:
            path.encode("utf-8")
        except UnicodeEncodeError:
            continue
        if os.path.isfile(path) and not any(fnmatch.fnmatchcase(path, p) for p in gone):
            keep.append(path)
    return keep


def rows(settings: FileNames) -> Iterator[tuple]:
    import datetime

    for path in matches(settings):
        try:
            stat = os.stat(path)
        except OSError:
            continue  # gone since it was listed
        yield path, datetime.datetime.fromtimestamp(stat.st_mtime, datetime.UTC), stat.st_size


def settings_of(options: dict) -> FileNames:
    """Globs are given as one option each, joined by commas."""
    given = dict(options)
    for name in ("include", "exclude"):
        if name in given:
            given[name] = tuple(x for x in given[name].split(",") if x)
    for name in ("glob_minimum_cooldown_ms", "glob_minimum_cooldown"):
        if name in given:
            given[name] = int(given[name])
    return FileNames.of(given)


class _Batch(DataSourceReader):
    def __init__(self, settings: FileNames):
        self.settings = settings

    def partitions(self) -> list[InputPartition]:
        return [InputPartition(0)]

    def read(self, partition: InputPartition) -> Iterator[tuple]:
        yield from rows(self.settings)


class _Stream(SimpleDataSourceStreamReader):
    """Every trigger emits every match again, as the uploads' own state drops what is unchanged; the cooldown bounds how often."""

    def __init__(self, settings: FileNames):
        self.settings = settings
        self.last = 0.0

    def initialOffset(self) -> dict:
        return {"poll": 0}

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        wait = self.settings.glob_minimum_cooldown_ms / 1000 - (time.monotonic() - self.last)
        if self.last and wait > 0:
            time.sleep(wait)
        self.last = time.monotonic()
        found = list(rows(self.settings))
        return iter(found), {"poll": start["poll"] + 1 if found else start["poll"]}

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:
        return rows(self.settings)

    def commit(self, end: dict) -> None:
        pass


@source("filename")
class FileNameSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "filename"

    def __init__(self, options: dict):
        super().__init__(options)
        self.settings = settings_of(dict(options))

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: object) -> DataSourceReader:
        return _Batch(self.settings)

    def simpleStreamReader(self, schema: object) -> SimpleDataSourceStreamReader:
        return _Stream(self.settings)
