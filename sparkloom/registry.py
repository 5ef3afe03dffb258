"""Names of sources and sinks that an application can switch on."""

from __future__ import annotations

from pyspark.sql import SparkSession

SOURCES: dict[str, type] = {}
SINKS: dict[str, type] = {}


def source(name: str):  # noqa: ANN201
    def add(cls: type) -> type:
        SOURCES[name] = cls
        return cls

    return add


def sink(name: str):  # noqa: ANN201
    def add(cls: type) -> type:
        SINKS[name] = cls
        return cls

    return add


def register_all(spark: SparkSession) -> None:
    """Makes the sources known to spark.read.format and spark.readStream.format."""
    import sparkloom.sources.filenames  # noqa: F401
    import sparkloom.sources.usage  # noqa: F401

    for cls in SOURCES.values():
        spark.dataSource.register(cls)
