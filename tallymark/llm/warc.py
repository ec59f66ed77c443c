"""WARC archives with revisit resolution.

Headers (payload digest and length) are shuffled by digest; of equal payloads of at least ``min_bytes``
the record with the largest identifier is the response and the others revisit it, joined by digest.
Revisits are written from their headers alone. Payloads stay where they were read, but for the revisits
taken out of them: by a broadcast if there are at most ``small`` of these, by a count, else by one shuffle
on identifier and digest, of which few rows are equal. Each task then writes archives of its own, one gzip
member per record, with fresh headers: a response holds its payload, a revisit the HTTP head alone and
what it refers to. Reading back parses the archives, recomputes each response's digest, and takes a
revisit's from its headers.

The headers' hot digests can be split by adaptive execution, and the largest identifier is combined
before the shuffle. A null payload counts as empty. Rows that repeat the largest identifier are each a
response, as are rows without an identifier where no other has one. A null address is written as
``about:blank`` and control characters are percent-encoded. An empty table gives no rows. Other columns
of the input are not read.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import io
import re
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymark.llm.arrow import batched, utf8
from tallymark.session import shared_path, ship_package, staged

#: Fixed values of the WARC 1.1 format.
VERSION = b"WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
READ_SCHEMA = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())])


def base32_sha1(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload, usedforsecurity=False).digest()).decode()


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_OID, f'{page_id}:{digest}')}>"


def _address(url: str | None) -> str:
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", url) if url else "about:blank"


def record(page_id: int | None, url: str | None, payload: bytes | None, n_bytes: int, digest: str, refers_to: int | None, target: str | None, date: str) -> bytes:
    """One record, as a gzip member; digest is that of the payload, which a revisit does not hold."""
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {n_bytes}\r\n\r\n".encode()
    fields = [("WARC-Type", "response" if refers_to is None else "revisit"), ("WARC-Record-ID", record_id(page_id, digest)), ("WARC-Date", date), ("WARC-Target-URI", _address(url)), ("WARC-Payload-Digest", f"sha1:{digest}"), ("Content-Type", "application/http;msgtype=response")]
    if page_id is not None:
        fields.append(("X-Page-ID", str(page_id)))
    if refers_to is not None:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(refers_to, digest)), ("WARC-Refers-To-Target-URI", _address(target)), ("X-Refers-To-Page-ID", str(refers_to))]
    block = http + (payload if refers_to is None else b"")
    head = VERSION + b"\r\n" + "".join(f"{k}: {v}\r\n" for k, v in [*fields, ("Content-Length", str(len(block)))]).encode() + b"\r\n"
    packer = zlib.compressobj(1, zlib.DEFLATED, 31)
    return packer.compress(head + block + b"\r\n\r\n") + packer.flush()


def records(stream: io.BufferedIOBase) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record of a gzip archive."""
    with gzip.GzipFile(fileobj=stream) as plain:
        while line := plain.readline():
            if line.strip() != VERSION:
                raise ValueError(f"no record begins with {line[:40]!r}")
            fields = {}
            while (line := plain.readline().rstrip(b"\r\n")) != b"":
                name, _, value = line.decode().partition(": ")
                fields[name] = value
            yield fields, plain.read(int(fields["Content-Length"]))
            plain.read(4)


def _write(folder: str, date: str, file_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, base = fs.FileSystem.from_uri(folder)
        system.create_dir(base, recursive=True)
        file, name, n, size = None, "", 0, 0
        done: list[tuple[str, int, int]] = []
        for batch in batches:
            for page_id, url, payload, n_bytes, digest, refers_to, target in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), utf8(batch.column(2)), *(batch.column(k).to_pylist() for k in range(3, 7)), strict=True):
                if file is None:
                    name, n, size = f"{uuid.uuid4().hex}.warc.gz", 0, 0
                    file = system.open_output_stream(f"{base}/{name}", compression=None)
                made = record(page_id, url, payload, n_bytes, base64.b32encode(bytes.fromhex(digest)).decode(), refers_to, target, date)
                file.write(made)
                n, size = n + 1, size + len(made)
                if size >= file_bytes:
                    file.close()
                    done.append((f"{folder}/{name}", n, size))
                    file = None
        if file is not None:
            file.close()
            done.append((f"{folder}/{name}", n, size))
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done, strict=True)], names=["path", "n_records", "n_bytes"])

    return run


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows() -> Iterator[tuple[tuple, int]]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                system, name = fs.FileSystem.from_uri(path)
                with system.open_input_file(name) as file:
                    for fields, block in records(file):
                        http, _, payload = block.partition(b"\r\n\r\n")
                        digest = fields["WARC-Payload-Digest"].removeprefix("sha1:")
                        length = int(re.search(rb"Content-Length: (\d+)", http)[1])
                        if fields["WARC-Type"] == "response":
                            length, found = len(payload), base32_sha1(payload)
                            if found != digest:
                                raise ValueError(f"{path}: a payload does not match its digest")
                        page, refers = fields.get("X-Page-ID"), fields.get("X-Refers-To-Page-ID")
                        yield (None if page is None else int(page), length, digest, fields["WARC-Type"], None if refers is None else int(refers)), 0

    yield from batched(READ_SCHEMA, rows())


def write_archives(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", payload_col: str = "html", min_bytes: int = 0, date: str = "2024-01-01T00:00:00Z", file_bytes: int = 1 << 30, small: int = 500_000) -> DataFrame:
    """Write one record per row; one row per archive: path, n_records, n_bytes."""
    spark = pages.sparkSession
    ship_package(spark)
    payload = F.coalesce(F.col(payload_col).cast("string"), F.lit(""))
    slim = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(url_col).cast("string").alias("url"), payload.alias("payload"))
    slim = slim.select("page_id", "url", "payload", F.octet_length("payload").alias("n_bytes"), F.sha1(F.encode("payload", "UTF-8")).alias("digest"))
    headers = staged(slim.select("page_id", "url", "n_bytes", "digest", F.xxhash64("payload").alias("check")), "headers")
    key = ["digest", "n_bytes", "check"]
    first = headers.where(F.col("n_bytes") >= min_bytes).groupBy(*key).agg(F.max(F.struct("page_id", "url")).alias("original"), F.count(F.lit(1)).alias("n")).where("n > 1 and original.page_id is not null")
    equal = headers.join(first, key).where(~F.col("page_id").eqNullSafe(F.col("original.page_id")))
    revisits = staged(equal.select("page_id", "url", "n_bytes", "digest", F.col("original.page_id").alias("refers_to"), F.col("original.url").alias("target")), "revisits")
    gone = revisits.select(F.col("page_id").alias("_id"), F.col("digest").alias("_digest")).distinct()
    side = F.broadcast(gone) if revisits.count() <= small else gone
    responses = slim.join(side, F.col("page_id").eqNullSafe(F.col("_id")) & (F.col("digest") == F.col("_digest")), "left_anti")
    columns = ["page_id", "url", "payload", "n_bytes", "digest", "refers_to", "target"]
    rows = responses.withColumns({"refers_to": F.lit(None).cast("long"), "target": F.lit(None).cast("string")}).select(*columns).unionByName(revisits.withColumn("payload", F.lit(None).cast("string")).select(*columns))
    return staged(rows.mapInArrow(_write(shared_path(spark, "archives"), date, file_bytes), "path string, n_records long, n_bytes long"), "archives-manifest")


def read_archives(archives: DataFrame) -> DataFrame:
    """One row per record: page_id, payload_bytes, payload_digest, record_type, refers_to."""
    ship_package(archives.sparkSession)
    return archives.select("path").repartition(max(1, archives.count()), "path").mapInArrow(_read, "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long")
