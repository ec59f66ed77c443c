"""Token-id shards with a minimal perfect hash index.

A shard is one file: the payload (ids of 16 or 32 bits, little-endian, in ascending document
order, an end id after each), the records' table (key, occurrence, offset, number of ids), and an index
that maps a key to its record in constant time. The index is a cascade of bit arrays: a key whose slot
in level 0 no other key shares is placed there; the others go on to level 1, and so on. The number of
set bits before a key's slot is its place, so places are 0 to n - 1 without gaps, and two bits a key
suffice for a level; a trailer says where each section is. A place stores a 32-bit fingerprint of its key, so that a key that was never
written is told apart, and its record's number.

Documents are dealt out by ranges of their identifier and sorted, so a shard holds one range. Each task
writes a file of its own under a fresh name in the shared folder and reports it; only reported files
count, so retries and speculation do no harm. A document's global start is its shard's, from a running
sum over one row per shard, and its offset.

Strings of special tokens in a text give these tokens, as the tokenizers library encodes by default;
``special_as_text`` makes them ordinary text. Null text counts as empty: the end id alone. Repeated identifiers are kept: the key is the identifier
and the number of the row among its equals in the shard, ordered by the text's hash. Null identifiers
come first and have a key of their own. An empty table gives no files and no rows. Other columns of
the input are not read.
"""

from __future__ import annotations

import json
import struct
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallymark.llm.arrow import BATCH_ROWS, batched
from tallymark.llm.word_ids import encoder, slices
from tallymark.session import shared_path, ship_package, staged

MAGIC = b"TIDS0001"
_HEAD = struct.Struct("<8sQQ")  # at the end: magic, bytes of the payload, bytes of the description before it
LEVELS = 24
#: Bits of a level for each key that comes to it.
GAMMA = 2

_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB)]


def mixed(keys: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit finaliser of keys (n x 2: identifier, occurrence and null flag)."""
    with np.errstate(over="ignore"):
        x = keys[:, 0] + np.uint64(seed + 1) * _MIX[0]
        for word in (np.uint64(0), keys[:, 1]):
            x = (x ^ (x >> np.uint64(30)) ^ word) * _MIX[1]
            x = (x ^ (x >> np.uint64(27))) * _MIX[2]
            x = x ^ (x >> np.uint64(31))
    return x


class PerfectHash:
    """Minimal perfect hash over distinct keys with a stored fingerprint for each place."""

    def __init__(self, bits: list[np.ndarray], rest: np.ndarray, prints: np.ndarray, record: np.ndarray):
        self.bits, self.rest, self.prints, self.record = bits, rest, prints, record
        sums = [np.r_[0, np.cumsum(x)] for x in bits]
        firsts = np.r_[0, np.cumsum([x[-1] for x in sums])].astype(np.int64)
        self.before = [s + f for s, f in zip(sums, firsts, strict=False)]
        self.after = int(firsts[-1])

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        bits, left = [], np.arange(len(keys))
        while len(left) and len(bits) < LEVELS:
            slot = (mixed(keys[left], len(bits)) % np.uint64(GAMMA * len(left))).astype(np.int64)
            alone = np.bincount(slot, minlength=GAMMA * len(left)) == 1
            bits.append(alone)
            left = left[~alone[slot]]
        made = cls(bits, keys[left], np.zeros(0, np.uint32), np.zeros(0, np.int64))
        place = made.place(keys)
        prints, record = np.zeros(len(keys), np.uint32), np.zeros(len(keys), np.int64)
        prints[place], record[place] = cls.print_of(keys), np.arange(len(keys))
        made.prints, made.record = prints, record
        return made

    @staticmethod
    def print_of(keys: np.ndarray) -> np.ndarray:
        return (mixed(keys, 1 << 20) >> np.uint64(32)).astype(np.uint32)

    def place(self, keys: np.ndarray) -> np.ndarray:
        """The place of each key, of any for a key that was never written, or -1."""
        place, open_ = np.full(len(keys), -1, np.int64), np.arange(len(keys))
        for level, bits in enumerate(self.bits):
            slot = (mixed(keys[open_], level) % np.uint64(len(bits))).astype(np.int64)
            hit = bits[slot]
            place[open_[hit]] = self.before[level][slot[hit]]
            open_ = open_[~hit]
        for k, key in enumerate(self.rest):  # the few keys that no level told apart
            place[open_[(keys[open_] == key).all(1)]] = self.after + k
        return place

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The record of each key, -1 for one whose fingerprint is not stored."""
        if not len(self.record):
            return np.full(len(keys), -1, np.int64)
        place = self.place(keys)
        ok = (place >= 0) & (self.prints[place] == self.print_of(keys))
        return np.where(ok, self.record[place], -1)


def shard_keys(doc_ids: list[int | None]) -> np.ndarray:
    """Keys of sorted identifiers: the identifier, and its occurrence with a flag for null."""
    ids = np.array([x or 0 for x in doc_ids], np.int64)
    null = np.array([x is None for x in doc_ids], bool)
    new = np.r_[True, (ids[1:] != ids[:-1]) | (null[1:] != null[:-1])] if len(ids) else np.zeros(0, bool)
    nth = np.arange(len(ids)) - np.flatnonzero(new)[np.cumsum(new) - 1] if len(ids) else ids
    return np.stack([ids.view(np.uint64), (nth * 2 + null).astype(np.uint64)], 1)


def write_shard(file, dtype: str, doc_ids: list[int | None], counts: list[int], payload_bytes: int) -> None:
    """The sections after the payload, and the trailer."""
    keys = shard_keys(doc_ids)
    index = PerfectHash.build(keys)
    lengths = np.array(counts, np.int64)
    sections = [keys, np.r_[0, np.cumsum(lengths)[:-1]].astype(np.int64) if len(lengths) else lengths, lengths, index.rest, index.prints, index.record, *[np.packbits(x) for x in index.bits]]
    data = [np.ascontiguousarray(x).tobytes() for x in sections]
    for x in data:
        file.write(x)
    about = json.dumps({"dtype": dtype, "payload": payload_bytes, "sections": [len(x) for x in data], "bits": [len(x) for x in index.bits]}).encode()
    file.write(about + _HEAD.pack(MAGIC, payload_bytes, len(about)))


class Shard:
    """Reads one shard: records in order, or one by key."""

    def __init__(self, path: str):
        system, name = fs.FileSystem.from_uri(path)
        self.file = system.open_input_file(name)
        size = self.file.size()
        magic, _, n = _HEAD.unpack(self._at(size - _HEAD.size, _HEAD.size))
        if magic != MAGIC:
            raise ValueError(f"{path}: no token shard")
        about = json.loads(self._at(size - _HEAD.size - n, n))
        self.dtype, at, parts = about["dtype"], about["payload"], []
        for length in about["sections"]:
            parts.append(self._at(at, length))
            at += length
        self.keys = np.frombuffer(parts[0], np.uint64).reshape(-1, 2)
        self.offsets, self.counts = (np.frombuffer(x, np.int64) for x in parts[1:3])
        bits = [np.unpackbits(np.frombuffer(x, np.uint8), count=n).astype(bool) for x, n in zip(parts[6:], about["bits"], strict=True)]
        self.index = PerfectHash(bits, np.frombuffer(parts[3], np.uint64).reshape(-1, 2), np.frombuffer(parts[4], np.uint32), np.frombuffer(parts[5], np.int64))

    def _at(self, start: int, n: int) -> bytes:
        self.file.seek(start)
        return self.file.read(n)

    def payload(self, record: int) -> bytes:
        size = np.dtype(self.dtype).itemsize
        return self._at(int(self.offsets[record]) * size, int(self.counts[record]) * size)

    def checksums(self, block: int = 8 << 20) -> np.ndarray:
        """CRC-32 of each record's ids as unsigned 32-bit integers; the payload is read once, in order."""
        size, ends = np.dtype(self.dtype).itemsize, np.cumsum(self.counts)
        out, at = np.zeros(len(self.counts), np.int64), 0
        while at < len(self.counts):
            low = int(self.offsets[at])
            stop = max(at + 1, int(np.searchsorted(ends, low + block // size, "right")))
            ids = np.frombuffer(self._at(low * size, int(ends[stop - 1] - low) * size), self.dtype).astype("<u4")
            for k in range(at, stop):
                out[k] = zlib.crc32(ids[int(self.offsets[k]) - low : int(ends[k]) - low])
            at = stop
        return out

    def ids(self, doc_id: int | None, occurrence: int = 0) -> np.ndarray | None:
        """The ids of a document, or None if the shard has no such key."""
        key = np.array([[doc_id or 0, 0]], np.int64).view(np.uint64)
        key[0, 1] = occurrence * 2 + (doc_id is None)
        record = int(self.index.find(key)[0])
        return None if record < 0 else np.frombuffer(self.payload(record), self.dtype)

    def records(self, doc_ids: list[int | None]) -> Iterator[tuple[int, int, int]]:
        """(position in ``doc_ids``, occurrence, record) of all rows of these documents, each by the index and its stored key."""
        keys = np.zeros((len(doc_ids), 2), np.uint64)
        keys[:, 0] = np.array([x or 0 for x in doc_ids], np.int64).view(np.uint64)
        keys[:, 1] = [x is None for x in doc_ids]
        left, occurrence = np.arange(len(doc_ids)), 0
        while len(left):
            record = self.index.find(keys[left])
            left, record = left[record >= 0], record[record >= 0]
            same = (self.keys[record] == keys[left]).all(1)
            left, record = left[same], record[same]
            yield from ((k, occurrence, r) for k, r in zip(left.tolist(), record.tolist(), strict=True))
            keys[left, 1] += np.uint64(2)
            occurrence += 1

    def close(self) -> None:
        self.file.close()


#: One row for each shard; ``low`` and ``high`` are its least and largest identifier, null if it has only null ones.
MANIFEST = "path string, part int, nth long, n_ids long, n_docs long, low long, high long, nulls boolean"


def _written(folder: str, path: str, end_id: int, dtype: str, shard_bytes: int, shard_docs: int, special_as_text: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids_of = encoder(path, dtype, special_as_text)
        end = np.array([end_id], dtype).tobytes()
        system, base = fs.FileSystem.from_uri(folder)
        system.create_dir(base, recursive=True)
        open_: list = []

        def closed() -> pa.RecordBatch:
            name, file, doc_ids, counts, size = open_.pop()
            write_shard(file, dtype, doc_ids, counts, size)
            file.close()
            known = next((k for k, x in enumerate(doc_ids) if x is not None), None)  # sorted, nulls first
            low, high = (None, None) if known is None else (doc_ids[known], doc_ids[-1])
            values = [f"{folder}/{name}", part, nth, sum(counts), len(counts), low, high, known != 0]
            kinds = [pa.string(), pa.int32(), *[pa.int64()] * 5, pa.bool_()]
            return pa.RecordBatch.from_arrays([pa.array([x], kind) for x, kind in zip(values, kinds, strict=True)], names=[x.split()[0] for x in MANIFEST.split(", ")])

        part = nth = 0
        for batch in batches:
            doc_ids, texts, parts = batch.column(0).to_pylist(), [x or "" for x in batch.column(1).to_pylist()], batch.column(2)
            part = parts[0].as_py() if len(parts) else part
            for a, b in slices(texts):
                for doc_id, ids in zip(doc_ids[a:b], ids_of.encode(texts[a:b]), strict=True):
                    if not open_:
                        name = f"{uuid.uuid4().hex}.tids"
                        open_.append([name, system.open_output_stream(f"{base}/{name}"), [], [], 0])
                    _, file, own, counts, _ = open_[0]
                    file.write(ids + end)
                    own.append(doc_id)
                    counts.append(len(ids) // len(end) + 1)
                    open_[0][4] += len(ids) + len(end)
                    if open_[0][4] >= shard_bytes or len(own) >= shard_docs:
                        yield closed()
                        nth += 1
        if open_:
            yield closed()

    return run


def write_token_files(docs: DataFrame, tokenizer: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 0, dtype: str = "<u2", shard_bytes: int = 256 << 20, shard_docs: int = 1 << 20, special_as_text: bool = False) -> DataFrame:
    """Write the shards; one row per shard, in document order by (part, nth): MANIFEST's columns and start.

    A shard ends at ``shard_bytes`` of ids or at ``shard_docs`` documents, whichever comes first.
    """
    spark = docs.sparkSession
    ship_package(spark)
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).withColumn("h", F.xxhash64("text"))
    ordered = slim.repartitionByRange("doc_id", "h").sortWithinPartitions("doc_id", "h").select("doc_id", "text", F.spark_partition_id().alias("part"))
    made = staged(ordered.mapInArrow(_written(shared_path(spark, "tokens"), tokenizer, end_id, dtype, shard_bytes, shard_docs, special_as_text), MANIFEST), "manifest")
    running = Window.orderBy("part", "nth").rowsBetween(Window.unboundedPreceding, -1)
    return made.withColumn("start", F.coalesce(F.sum("n_ids").over(running), F.lit(0)))


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            shard = Shard(path)
            records = shard.index.find(shard.keys)  # every document through the index
            if (records < 0).any():
                raise ValueError(f"{path}: a key is missing from the index")
            null = (shard.keys[:, 1] & np.uint64(1)).astype(bool)
            crc = shard.checksums()[records].tolist()
            columns = [pa.array(shard.keys[:, 0].view(np.int64), mask=null), pa.array(shard.offsets[records] + start), pa.array(shard.counts[records]), pa.array(crc, pa.int64())]
            shard.close()
            made = pa.RecordBatch.from_arrays(columns, names=["doc_id", "start", "n_tokens", "ids_crc32"])
            for at in range(0, made.num_rows, BATCH_ROWS):
                yield made.slice(at, BATCH_ROWS)


def read_token_files(shards: DataFrame) -> DataFrame:
    """One row per document, read back through the shards' indexes: doc_id, start, n_tokens, ids_crc32."""
    ship_package(shards.sparkSession)
    return shards.select("path", "start").repartition(max(1, shards.count()), "path").mapInArrow(_read, "doc_id long, start long, n_tokens long, ids_crc32 long")


#: Shards whose ranges a lookup sends to its tasks: 24 bytes each.
MOST_SHARDS = 1 << 22
FOUND = pa.schema([("doc_id", pa.int64()), ("occurrence", pa.int64()), ("start", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.list_(pa.int64()))])


def _routed(low: np.ndarray, high: np.ndarray, nulls: np.ndarray):
    """Over distinct keys: (shard, doc_id) for each shard, by its number in document order, whose range holds the key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys = batch.column(0)
            known = keys.drop_null().to_numpy()
            first = np.searchsorted(high, known, "left")
            n = np.maximum(np.searchsorted(low, known, "right") - first, 0)
            shard = np.repeat(first - (np.cumsum(n) - n), n) + np.arange(n.sum())
            own = pa.array(np.repeat(known, n), pa.int64())
            if keys.null_count:
                shard, own = np.r_[shard, nulls], pa.concat_arrays([own, pa.nulls(len(nulls), pa.int64())])
            yield pa.RecordBatch.from_arrays([pa.array(shard.astype(np.int64)), own], names=["shard", "doc_id"])

    return run


def _looked_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Over (path, start, doc_id) sorted by path: the documents' rows; each shard is opened once."""
    path = shard = None

    def rows() -> Iterator[tuple[tuple, int]]:
        nonlocal path, shard
        for batch in batches:
            paths, starts, keys = (batch.column(k).to_pylist() for k in range(3))
            cuts = [0, *(k for k in range(1, len(paths)) if paths[k] != paths[k - 1]), len(paths)]
            for a, b in zip(cuts, cuts[1:], strict=False):
                if a == b:
                    continue
                if paths[a] != path:
                    if shard is not None:
                        shard.close()
                    path, shard = paths[a], Shard(paths[a])
                for k, occurrence, record in shard.records(keys[a:b]):
                    ids = np.frombuffer(shard.payload(record), shard.dtype).tolist()
                    yield (keys[a + k], occurrence, starts[a] + int(shard.offsets[record]), len(ids), ids), 8 * len(ids)
        if shard is not None:
            shard.close()

    yield from batched(FOUND, rows())


def find_documents(shards: DataFrame, wanted: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Keyed access over the whole table: one row per wanted document: doc_id, occurrence, start, n_tokens, ids.

    A key goes to the shards whose range in the manifest holds it, usually one, and there through the
    perfect hash to its record; only these records' ids are read. Rows that repeat an identifier are all
    found (occurrence counts them within a shard, which they share unless it is full). Repeated and null
    wanted keys count once; null finds documents without an identifier. Keys that were never written
    give no row, empty tables none at all.
    """
    spark = shards.sparkSession
    ship_package(spark)
    ordered = shards.orderBy("part", "nth").select("path", "start", "low", "high", "nulls").limit(MOST_SHARDS + 1).collect()
    if len(ordered) > MOST_SHARDS:
        raise ValueError(f"more than {MOST_SHARDS} shards: write larger ones")
    least = np.iinfo(np.int64).min
    low, high = (np.array([least if r[name] is None else r[name] for r in ordered], np.int64) for name in ("low", "high"))
    nulls = np.flatnonzero([r.nulls for r in ordered])
    keys = wanted.select(F.col(id_col).cast("long").alias("doc_id")).distinct()
    routed = keys.mapInArrow(_routed(low, high, nulls), "shard long, doc_id long")
    numbered = spark.createDataFrame([(k, r.path, r.start) for k, r in enumerate(ordered)], "_shard long, path string, start long")
    placed = routed.join(numbered, F.col("shard") == F.col("_shard")).select("path", "start", "doc_id")
    return placed.repartition("path").sortWithinPartitions("path", "doc_id").mapInArrow(_looked_up, "doc_id long, occurrence long, start long, n_tokens long, ids array<long>")
