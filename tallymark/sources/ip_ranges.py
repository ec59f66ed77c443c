"""Binary IP range dictionaries as a Spark data source.

A file begins with the first and last index entries' offsets (u32); an index entry of seven bytes is a
range's begin (u32) and its record's offset (u24); a record is the range's end (u32) and two strings.
All numbers are little-endian; strings end with a zero byte and are GB 18030. Marks before a string:
1 sends both strings elsewhere, 2 only the one it precedes.

    spark.dataSource.register(IpRangeSource)
    spark.read.format("ip_ranges").load("/path/to/file")
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

SCHEMA = "ip_begin long, ip_end long, country string, area string"
ENTRY = 7
FULL, PART = 1, 2


def _number(data: bytes, at: int, size: int) -> int:
    return int.from_bytes(data[at : at + size], "little")


def _string(data: bytes, at: int) -> tuple[str, int]:
    """The string at a place and the place after it."""
    end = data.index(b"\0", at)
    return data[at:end].decode("gb18030", "replace"), end + 1


def names_at(data: bytes, at: int) -> tuple[str, str]:
    """Both strings of a record from the place after its end."""
    if data[at] == FULL:
        at = _number(data, at + 1, 3)
    if data[at] == PART:
        country, at = _string(data, _number(data, at + 1, 3))[0], at + 4
    else:
        country, at = _string(data, at)
    if data[at] == PART:
        at = _number(data, at + 1, 3)
    return country, _string(data, at)[0]


def index_bounds(data: bytes) -> tuple[int, int] | None:
    """Offsets of the first and last entries, None for what is no such file."""
    if len(data) < 8:
        return None
    first, last = _number(data, 0, 4), _number(data, 4, 4)
    ok = first >= 8 and last >= first and (last - first) % ENTRY == 0 and last + ENTRY <= len(data)
    return (first, last) if ok else None


def entries(data: bytes, start: int = 0, stop: int | None = None) -> Iterator[tuple[int, int, str, str]]:
    """Ranges of a file's bytes; nothing for an invalid file."""
    bounds = index_bounds(data)
    if bounds is None:
        return
    n = (bounds[1] - bounds[0]) // ENTRY + 1
    for k in range(start, n if stop is None else min(stop, n)):
        at = bounds[0] + k * ENTRY
        record = _number(data, at + 4, 3)
        yield _number(data, at, 4), _number(data, record, 4), *names_at(data, record + 4)


def build(ranges: list[tuple[int, int, str, str]]) -> bytes:
    """A file of ranges in ascending order, with equal strings stored once."""
    body, seen, offsets = bytearray(8), {}, []
    for begin, end, country, area in ranges:
        offsets.append((begin, len(body)))
        body += end.to_bytes(4, "little")
        for name in (country, area):
            if name in seen:
                body += bytes([PART]) + seen[name].to_bytes(3, "little")
            else:
                seen[name] = len(body)
                body += name.encode("gb18030") + b"\0"
    first = len(body)
    for begin, at in offsets:
        body += begin.to_bytes(4, "little") + at.to_bytes(3, "little")
    body[:8] = first.to_bytes(4, "little") + (len(body) - ENTRY).to_bytes(4, "little")
    return bytes(body)


def decode_download(key: int, data: bytes) -> bytes:
    """A downloaded dictionary: the first 512 bytes are masked by a keystream, all of it is zlib."""
    head = bytearray()
    for byte in data[:0x200]:
        key = (key * 0x805 + 1) & 0xFF
        head.append(byte ^ key)
    return zlib.decompress(bytes(head) + data[0x200:])


class _Span(InputPartition):
    def __init__(self, start: int, stop: int):
        self.start, self.stop = start, stop


class IpRangeReader(DataSourceReader):
    #: Entries of a partition.
    SPAN = 100_000

    def __init__(self, data: bytes):
        self.data = data

    def partitions(self) -> list[_Span]:
        bounds = index_bounds(self.data)
        n = (bounds[1] - bounds[0]) // ENTRY + 1 if bounds else 0
        return [_Span(k, k + self.SPAN) for k in range(0, max(n, 1), self.SPAN)]

    def read(self, partition: _Span) -> Iterator[tuple]:
        yield from entries(self.data, partition.start, partition.stop)


class IpRangeSource(DataSource):
    """The file is a dictionary of some megabytes: it is read once and handed to the readers whole."""

    @classmethod
    def name(cls) -> str:
        return "ip_ranges"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> IpRangeReader:
        from pyarrow import fs

        path = self.options["path"]
        system, name = fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")
        with system.open_input_file(name) as file:
            return IpRangeReader(file.read())
