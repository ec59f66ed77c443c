"""Exact dedup by Patricia-trie owners.

Texts are equal when they are identical after deleting every character of ``[\\x20\\x09-\\x0D]``.
Each scan task inserts its normalised texts into a compressed radix trie whose terminal nodes keep
the owner (most code points in the original text, then smallest identifier), so a text leaves a task
once per flush however many copies it has. These rows are dealt out by length and content hash and
inserted, as whole byte strings, into one trie per partition. A trie over its memory bound writes its
largest subtree to a local file; the file is worked off on its own after the input ends. Decisions go
back to the documents by a join on length and SHA-256, whose hot keys adaptive execution can split.
``first_documents`` keeps the row that stays in the terminal node, so it needs no join: each text that
leaves a task is shuffled once.

Null text counts as empty, and empty texts are equal to each other. A null identifier ranks after all
others. Rows that repeat both identifier and text length are one document: ``kept`` holds for each, and
``first_documents`` returns one of them (that of the smallest bytes), also of those without identifier.
Other columns of the input are not read, so their names cannot clash. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import os
import pickle
import struct
import tempfile
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema

from tallymark.llm.arrow import Rows, batched, utf8
from tallymark.session import ship_package

#: Fixed value: the characters that the comparison ignores.
SPACE = b" \t\n\x0b\x0c\r"

DIGEST_SCHEMA = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("text_sha256", pa.string()), ("points", pa.int64())])
TEXT_SCHEMA = pa.schema([("n_bytes", pa.int64()), ("content_hash", pa.int64()), ("body", pa.binary()), ("points", pa.int64()), ("owner", pa.int64()), ("n_rows", pa.int64())])
OWNER_SCHEMA = pa.schema([("n_bytes", pa.int64()), ("text_sha256", pa.string()), ("keep_points", pa.int64()), ("keep_id", pa.int64()), ("group_size", pa.int64())])
ROW_SCHEMA = pa.schema([("n_bytes", pa.int64()), ("content_hash", pa.int64()), ("text", pa.binary()), ("points", pa.int64()), ("owner", pa.int64()), ("n_rows", pa.int64()), ("rest", pa.binary())])
_HEAD = struct.Struct("<IqqqqI")
_TEXT = struct.Struct("<q")


class Owner:
    """What a terminal node stores: the best row so far, with what is handed on of it, and the number of rows."""

    __slots__ = ("key", "n_rows", "payload")

    def __init__(self, points: int, doc_id: int | None, n_rows: int, payload: bytes = b""):
        self.key = (-points, doc_id is None, doc_id or 0)
        self.n_rows, self.payload = n_rows, payload

    def merge(self, other: Owner) -> None:
        self.key, self.payload = min((self.key, self.payload), (other.key, other.payload))
        self.n_rows += other.n_rows

    @property
    def points(self) -> int:
        return -self.key[0]

    @property
    def doc_id(self) -> int | None:
        return None if self.key[1] else self.key[2]


class _Node:
    __slots__ = ("kids", "label", "owner")

    def __init__(self, label: bytes, owner: Owner | None = None):
        self.label, self.owner = label, owner
        self.kids: dict[int, _Node] = {}


def _shared(label: bytes, key: bytes, at: int) -> int:
    """Length of the common prefix of ``label`` and ``key[at:]``."""
    low, high = 0, min(len(label), len(key) - at)
    while low < high:
        mid = (low + high + 1) // 2
        if key.startswith(label[low:mid], at + low):
            low = mid
        else:
            high = mid - 1
    return low


class PatriciaTrie:
    """Compressed radix trie over byte strings; ``budget`` bounds the bytes of labels and rows held in memory."""

    #: Bytes of overhead that a node counts for, besides its label.
    NODE = 300

    def __init__(self, budget: int | None = None, skip: int = 0):
        self.budget, self.skip = budget, skip
        self.root = _Node(b"")
        self.held = [0] * 256
        self.size = 0
        self.files: dict[int, tuple] = {}

    def _grow(self, first: int, n: int) -> None:
        self.held[first] += n
        self.size += n

    def insert(self, key: bytes, owner: Owner) -> None:
        at = self.skip
        if at == len(key):
            self.size += self._end(self.root, owner)
            return
        first = key[at]
        if first in self.files:
            self._append(first, key, owner)
            return
        node = self.root
        while at < len(key):
            kid = node.kids.get(key[at])
            if kid is None:
                node.kids[key[at]] = _Node(key[at:], owner)
                self._grow(first, len(key) - at + self.NODE + len(owner.payload))
                break
            if not key.startswith(kid.label, at):
                cut = _shared(kid.label, key, at)
                fork = _Node(kid.label[:cut])
                kid.label = kid.label[cut:]
                fork.kids[kid.label[0]] = kid
                node.kids[key[at]] = fork
                self._grow(first, self.NODE)
                kid = fork
            node, at = kid, at + len(kid.label)
        else:
            self._grow(first, self._end(node, owner))
        if self.budget is not None and self.size > self.budget and any(self.held):
            self._spill(max(range(256), key=self.held.__getitem__))

    @staticmethod
    def _end(node: _Node, owner: Owner) -> int:
        """Give a node its owner; the bytes more that it holds."""
        if node.owner is None:
            node.owner = owner
            return len(owner.payload)
        before = len(node.owner.payload)
        node.owner.merge(owner)
        return len(node.owner.payload) - before

    def _walk(self, node: _Node, prefix: bytes) -> Iterator[tuple[bytes, Owner]]:
        stack = [(node, prefix)]
        while stack:
            node, prefix = stack.pop()
            if node.owner is not None:
                yield prefix, node.owner
            stack += [(kid, prefix + kid.label) for kid in node.kids.values()]

    def _append(self, first: int, key: bytes, owner: Owner) -> None:
        file, shared = self.files[first]
        file.write(_HEAD.pack(len(key), owner.points, -1 if owner.doc_id is None else 0, owner.doc_id or 0, owner.n_rows, len(owner.payload)) + key + owner.payload)
        if shared is None:
            self.files[first] = (file, key)
        elif not key.startswith(shared):
            self.files[first] = (file, shared[: _shared(shared, key, 0)])

    def _spill(self, first: int) -> None:
        """Write the subtree under one byte to a file of its own."""
        handle, path = tempfile.mkstemp(prefix="subtree-")
        os.unlink(path)  # the open handle keeps it
        self.files[first] = (os.fdopen(handle, "w+b"), None)
        kid = self.root.kids.pop(first)
        for rest, owner in self._walk(kid, kid.label):
            self._append(first, self._lead + rest, owner)
        self._grow(first, -self.held[first])

    #: The bytes before ``skip``, equal for all keys of a trie that reads a spilled file.
    _lead = b""

    def drain(self) -> Iterator[tuple[bytes, Owner]]:
        """All terminals, each once; then those of the spilled subtrees, one file at a time."""
        yield from self._walk(self.root, self._lead)
        self.root = _Node(b"")
        waiting, self.files = list(self.files.values()), {}
        while waiting:
            file, shared = waiting.pop()
            file.seek(0)
            part = PatriciaTrie(self.budget, len(shared))
            part._lead = shared
            while head := file.read(_HEAD.size):
                n, points, null, doc_id, n_rows, more = _HEAD.unpack(head)
                part.insert(file.read(n), Owner(points, None if null else doc_id, n_rows, file.read(more)))
            file.close()
            yield from self._walk(part.root, shared)
            waiting += part.files.values()


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        bodies = [x.translate(None, SPACE) for x in utf8(batch.column(1))]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(map(len, bodies), pa.int64()), pa.array([hashlib.sha256(x).hexdigest() for x in bodies]), pc.fill_null(pc.utf8_length(batch.column(1)), 0).cast(pa.int64())],
            schema=DIGEST_SCHEMA,
        )


def _combine(flush_bytes: int):
    """Within a scan task: one row for each text and flush."""

    def rows(trie: PatriciaTrie) -> Iterator[tuple[tuple, int]]:
        for body, owner in trie.drain():
            yield (len(body), xxhash.xxh64_intdigest(body) - (1 << 63), body, owner.points, owner.doc_id, owner.n_rows), len(body)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = PatriciaTrie()
        for batch in batches:
            points = pc.fill_null(pc.utf8_length(batch.column(1)), 0).to_pylist()
            for doc_id, text, n in zip(batch.column(0).to_pylist(), utf8(batch.column(1)), points, strict=True):
                trie.insert(text.translate(None, SPACE), Owner(n, doc_id, 1))
                if trie.size > flush_bytes:
                    yield from batched(TEXT_SCHEMA, rows(trie))
                    trie = PatriciaTrie()
        yield from batched(TEXT_SCHEMA, rows(trie))

    return run


def _own(budget: int):
    """Within a partition of lengths and hashes: the owner of each text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = PatriciaTrie(budget)
        for batch in batches:
            for body, points, owner, n_rows in zip(batch.column(2).to_pylist(), *(batch.column(k).to_pylist() for k in (3, 4, 5)), strict=True):
                trie.insert(body, Owner(points, owner, n_rows))
        out = Rows(OWNER_SCHEMA)
        for body, owner in trie.drain():
            out.add((len(body), hashlib.sha256(body).hexdigest(), owner.points, owner.doc_id, owner.n_rows))
            if out.full:
                yield out.take()
        yield from out.rest()

    return run


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", flush_bytes: int = 48 << 20, trie_bytes: int = 128 << 20) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    flush_bytes and trie_bytes bound the tries of a scan task and of a hash partition.
    """
    ship_package(docs.sparkSession)
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    texts = slim.mapInArrow(_combine(flush_bytes), "n_bytes long, content_hash long, body binary, points long, owner long, n_rows long")
    owners = texts.repartition("n_bytes", "content_hash").mapInArrow(_own(trie_bytes), "n_bytes long, text_sha256 string, keep_points long, keep_id long, group_size long")
    members = slim.mapInArrow(_digests, "doc_id long, n_bytes long, text_sha256 string, points long")
    return members.join(owners, ["n_bytes", "text_sha256"]).select(
        "doc_id", "keep_id", "group_size", (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("points") == F.col("keep_points"))).alias("kept"), "text_sha256"
    )


def _payload(text: bytes | None, rest: bytes) -> bytes:
    """A row's text and its other values as one string."""
    return _TEXT.pack(-1 if text is None else len(text)) + (text or b"") + rest


def _of_payload(payload: bytes) -> tuple[bytes | None, bytes]:
    n = _TEXT.unpack_from(payload)[0]
    return (None if n < 0 else payload[_TEXT.size : _TEXT.size + n]), payload[_TEXT.size + max(n, 0) :]


def _sliced(batches: Iterator[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """Few rows at a time, as whole rows become Python objects."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def _texts(column: pa.Array) -> list[bytes | None]:
    return column.cast(pa.large_binary()).to_pylist()


def _combine_rows(flush_bytes: int, text_at: int):
    """Within a scan task: the row that stays of each text and flush."""

    def rows(trie: PatriciaTrie) -> Iterator[tuple[tuple, int]]:
        for body, owner in trie.drain():
            text, rest = _of_payload(owner.payload)
            yield (len(body), xxhash.xxh64_intdigest(body) - (1 << 63), text, owner.points, owner.doc_id, owner.n_rows, rest), len(owner.payload)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = PatriciaTrie()
        for batch in _sliced(batches):
            *columns, ids = batch.columns
            texts = columns.pop(text_at)
            points = pc.fill_null(pc.utf8_length(texts), 0).to_pylist()
            others = [c.to_pylist() for c in columns]
            for doc_id, text, n, *rest in zip(ids.to_pylist(), _texts(texts), points, *others, strict=True):
                trie.insert((text or b"").translate(None, SPACE), Owner(n, doc_id, 1, _payload(text, pickle.dumps(rest))))
                if trie.size > flush_bytes:
                    yield from batched(ROW_SCHEMA, rows(trie))
                    trie = PatriciaTrie()
        yield from batched(ROW_SCHEMA, rows(trie))

    return run


def _own_rows(budget: int, schema: pa.Schema, text_at: int):
    """Within a partition of lengths and hashes: the row that stays of each text."""

    def rows(trie: PatriciaTrie) -> Iterator[tuple[tuple, int]]:
        for _, owner in trie.drain():
            text, rest = _of_payload(owner.payload)
            values = pickle.loads(rest)
            values.insert(text_at, None if text is None else text.decode())
            yield tuple(values), len(owner.payload)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = PatriciaTrie(budget)
        for batch in _sliced(batches):
            for text, points, owner, n_rows, rest in zip(*(batch.column(k).to_pylist() for k in range(2, 7)), strict=True):
                trie.insert((text or b"").translate(None, SPACE), Owner(points, owner, n_rows, _payload(text, rest)))
        yield from batched(schema, rows(trie))

    return run


def first_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", flush_bytes: int = 16 << 20, trie_bytes: int = 64 << 20) -> DataFrame:
    """The row that stays of each group of equal texts, with the columns of the input; the text is a string."""
    ship_package(docs.sparkSession)
    text_at = docs.columns.index(text_col)
    id_at, plain = docs.columns.index(id_col), docs.toDF(*[f"c{k}" for k in range(len(docs.columns))])  # any names may be in use
    whole = plain.select("*", F.col(f"c{id_at}").cast("long").alias("id"))
    texts = whole.mapInArrow(_combine_rows(flush_bytes, text_at), "n_bytes long, content_hash long, text binary, points long, owner long, n_rows long, rest binary")
    return texts.repartition("n_bytes", "content_hash").mapInArrow(_own_rows(trie_bytes, to_arrow_schema(docs.schema), text_at), docs.schema)
