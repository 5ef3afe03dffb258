"""Scalar functions as column expressions; all of them run inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from sparkloom.functions.model import TAG_LABELS, TAG_UNKNOWN

#: Seconds that a timestamp in microseconds can hold.
MAX_SECONDS = (1 << 63) // 1_000_000 - 1


def digest_text(digest: Column) -> Column:
    """Upper-case hex; an unset digest is empty."""
    return F.coalesce(F.hex(digest), F.lit(""))


def seconds_to_timestamp(seconds: Column) -> Column:
    """Null where the seconds are out of a timestamp's range."""
    return F.when((seconds >= 0) & (seconds <= MAX_SECONDS), F.timestamp_seconds(seconds.cast("long")))


def timestamp_to_millis(ts: Column) -> Column:
    return F.unix_millis(ts)


def epoch_micros(ts: Column) -> Column:
    """Of a timestamp with or without zone; the session's zone is UTC."""
    return F.unix_micros(ts.cast("timestamp"))


def tag_label(label: Column) -> Column:
    """Name of a tag's label; unset and unknown numbers are unknown."""
    named = F
    for number, name in TAG_LABELS.items():
        named = named.when(label == number, name)
    return named.otherwise(TAG_UNKNOWN)


def text_or_replacement(raw: Column) -> Column:
    """UTF-8 text of bytes, bad sequences replaced."""
    return F.make_valid_utf8(raw.cast("string"))


def md5_base64(raw: Column) -> Column:
    return F.base64(F.unhex(F.md5(raw)))


def host_port(address: Column) -> tuple[Column, Column, Column]:
    """(host, port, error) of an address with an optional scheme. error: MissingHost, MissingPort, ParseAddress or null."""
    rest = F.regexp_replace(address, "^[A-Za-z][A-Za-z0-9+.-]*://", "")
    authority = F.regexp_extract(rest, "^[^/?#]*", 0)
    shape = r"^([A-Za-z0-9._~-]*|\[[0-9A-Fa-f:.]+\])(:([0-9]*))?$"
    host, colon, digits = (F.regexp_extract(authority, shape, i) for i in (1, 2, 3))
    number = F.when(F.length(digits) <= 5, digits.cast("int"))
    error = (
        F.when(address.isNull() | ~F.rlike(authority, F.lit(shape)) | (authority == ""), "ParseAddress")
        .when((digits != "") & (number.isNull() | (number > 65535)), "ParseAddress")
        .when(host == "", "MissingHost")
        .when((colon == "") | (digits == ""), "MissingPort")
    )
    return F.when(error.isNull(), host), F.when(error.isNull(), number), error


def header_md5(header: Column) -> Column:
    """What follows the first md5= of a hash header; null without one."""
    return F.when(F.contains(header, F.lit("md5=")), F.regexp_extract(header, r"(?s)md5=(.*)$", 1))


def form_encoded(pairs: Column) -> Column:
    """A map as key=value pairs joined by &, in order of the keys, form style (space is +)."""
    entries = F.array_sort(F.map_entries(pairs))
    return F.array_join(F.transform(entries, lambda e: F.concat(F.url_encode(e["key"]), F.lit("="), F.url_encode(e["value"]))), "&")


def with_scheme(address: str, tls: bool) -> str:
    """An address that has a scheme (the given one, else http or https by tls), one trailing slash removed."""
    if "://" not in address:
        address = ("https://" if tls else "http://") + address
    return address.removesuffix("/")
