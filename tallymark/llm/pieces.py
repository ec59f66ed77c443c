"""Exact encoding for SentencePiece models of the merge type, by backtracking, and decoding.

The library merges the two neighbours whose piece scores best, leftmost first, until none is left. Merges
on the two sides of a place do not see each other before one crosses it, so pieces are the encoding of a
text exactly if every two neighbours, merged again on their own, stay as they are; and the encoding of a
text's beginning, if it ends at a place, is unique. So one Aho-Corasick pass (over the reversed text)
tells the longest piece that begins at each character; the encoder takes it, goes to shorter ones where it
does not fit the piece before, and steps back where none fits, marking the place in a bitfield: no
encoding has a boundary there, whatever came before. Each place fails once, so a text of any length takes
linear time. Whether two neighbours fit is kept in a bounded table.

No piece of the common vocabularies has a space after another character, or a full stop or comma after a
letter, so no merge crosses the beginning of a run of spaces or such a mark after a word, and chunks
between these are encoded once and looked up afterwards. Both are read off the vocabulary; where a space
follows other characters in pieces, texts are encoded whole.

Characters without a piece become their bytes' pieces, or the unknown piece where the model has none; as in
the library, neighbouring characters that become the unknown piece are one. Null counts as empty, which has no ids and decodes to
the empty text. Repeated rows are kept, an empty table gives no rows, and other columns are not read.
"""

from __future__ import annotations

import re
import struct
from array import array
from collections.abc import Iterator
from itertools import pairwise

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from sentencepiece import SentencePieceProcessor

from tallymark.llm.word_ids import slices
from tallymark.session import ship_package

SPACE = "▁"
#: Marks that often follow a word.
MARKS = ",.;:!?"
#: Field numbers of a model file, and its kinds of pieces.
PIECES, TRAINER, NORMALIZER = 1, 2, 3
MODEL_TYPE, BYTE_FALLBACK, SPACE_AS_SUFFIX = 3, 35, 24
CHARSMAP, DUMMY_PREFIX, REMOVE_EXTRA, ESCAPE = 2, 3, 4, 5
NORMAL, UNKNOWN, BYTE, MERGES = 1, 2, 6, 2
USER_DEFINED, UNUSED = 4, 5
#: Entries of a table's newer half, and characters of a chunk in it at most.
HELD, LONGEST = 350_000, 64
#: Ids of a decoder's call at most, one text at least.
DECODED_IDS = 1 << 20

_ENCODERS: dict[str, PieceIds] = {}
_DECODERS: dict[str, PieceText] = {}


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Field numbers and values of one message."""
    at = 0

    def number() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            shift += 7
            if byte < 128:
                return value

    while at < len(data):
        tag = number()
        if tag & 7 == 0:
            yield tag >> 3, number()
        else:
            n = {1: 8, 5: 4}.get(tag & 7) or number()
            yield tag >> 3, data[at : at + n]
            at += n


class PieceModel:
    """The pieces, scores and settings of a model file of the merge type without text normalisation."""

    def __init__(self, path: str):
        self.ids: dict[str, int] = {}
        self.scores: dict[str, float] = {}
        self.bytes_of: list[bytes] = []
        self.byte_ids: dict[int, int] = {}
        self.unknown = 0
        with open(path, "rb") as file:
            fields = list(_fields(file.read()))
        settings = {f: dict(_fields(v)) for f, v in fields if f in (TRAINER, NORMALIZER)}
        trainer, normalizer = settings.get(TRAINER, {}), settings.get(NORMALIZER, {})
        plain = not normalizer.get(CHARSMAP) and not normalizer.get(REMOVE_EXTRA, 1) and normalizer.get(ESCAPE, 1) and not trainer.get(SPACE_AS_SUFFIX)
        if trainer.get(MODEL_TYPE, 1) != MERGES or not plain:
            raise ValueError(f"{path}: not a model of merges over texts as they are")
        self.prefix = bool(normalizer.get(DUMMY_PREFIX, 1))
        for k, piece in enumerate(v for f, v in fields if f == PIECES):
            part = dict(_fields(piece))
            text, kind = part[1].decode(), part.get(3, NORMAL)
            if kind in (USER_DEFINED, UNUSED):
                raise ValueError(f"{path}: user-defined and unused pieces are not supported")
            self.bytes_of.append(text.replace(SPACE, " ").encode())
            if kind == NORMAL:
                self.ids[text], self.scores[text] = k, struct.unpack("<f", part.get(2, b"\0\0\0\0"))[0]
            elif kind == BYTE:
                self.byte_ids[int(text[3:5], 16)] = k
                self.bytes_of[k] = bytes([int(text[3:5], 16)])
            elif kind == UNKNOWN:
                self.unknown = k
        self.by_bytes = bool(trainer.get(BYTE_FALLBACK)) and len(self.byte_ids) == 256

    def merged(self, text: str) -> list[str]:
        """The library's way, for short texts: the best-scored neighbours are merged, leftmost first."""
        parts = list(text)
        while True:
            best = at = None
            for k in range(len(parts) - 1):
                score = self.scores.get(parts[k] + parts[k + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, k
            if at is None:
                return parts
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def ids_of(self, pieces: list[str]) -> array:
        out, unknown = array("I"), False
        for piece in pieces:
            known = self.ids.get(piece)
            if known is None and self.by_bytes:
                out.extend(self.byte_ids[b] for b in piece.encode())
            elif known is not None or not unknown:
                out.append(self.unknown if known is None else known)
            unknown = known is None
        return out


class _Lookup(dict):
    """A bounded table that is filled when asked; entries not asked for while it filled twice are dropped."""

    def __init__(self, make, held: int):
        super().__init__()
        self.make, self.held, self.before = make, held, {}

    def __missing__(self, key):
        if len(self) >= self.held:
            self.before = dict(self)
            self.clear()
        made = self.before.get(key)
        if made is None:
            made = self.make(key)
        if len(key) <= LONGEST:
            self[key] = made
        return made


class PieceIds:
    """Encodes texts to unsigned little-endian 32-bit ids."""

    def __init__(self, path: str):
        self.model = model = PieceModel(path)
        self.longest = ahocorasick.Automaton()
        for piece in model.ids:
            self.longest.add_word(piece[::-1], piece)
        self.longest.make_automaton()
        self.chunked = model.by_bytes and not any(SPACE in piece.lstrip(SPACE) for piece in model.ids)
        before = {a for piece in model.ids for a, b in pairwise(piece) if b in MARKS}  # these share a piece with a mark after them
        word = f"[^{re.escape(''.join(sorted(before | {SPACE, *MARKS})))}]+"
        self.chunk = re.compile(f"{SPACE}+{word}(?:(?=[{MARKS}])|[^{SPACE}]*)|{SPACE}+[^{SPACE}]*|[^{SPACE}]+")
        self.fits, self.shorter = _Lookup(self._fits, HELD), _Lookup(self._shorter, HELD)
        self.known = _Lookup(self._chunk, HELD)
        self.written = {piece: k.to_bytes(4, "little") for piece, k in model.ids.items()}

    def _fits(self, pair: tuple[str, str]) -> bool:
        """Whether two neighbours (the first may be empty) stay as they are when merged again."""
        return self.model.merged(pair[0] + pair[1]) == [x for x in pair if x]

    def _shorter(self, piece: str) -> str:
        """The next shorter piece at the same place; a single character needs no piece."""
        n = len(piece) - 1
        while n > 1 and piece[:n] not in self.model.ids:
            n -= 1
        return piece[:n]

    def pieces(self, text: str) -> list[str]:
        """The pieces of an escaped text."""
        n = len(text)
        longest, ended = list(text), -1
        for end, piece in self.longest.iter(text[::-1]):
            if end != ended:  # the first that ends here is the longest
                longest[-1 - end] = piece
                ended = end
        failed, fits, shorter = None, self.fits, self.shorter
        out: list[str] = []
        at, last, piece = 0, "", longest[0] if n else ""
        while at < n:
            end = at + len(piece)
            if (failed is None or not failed[end >> 3] >> (end & 7) & 1) and fits[last, piece]:
                out.append(piece)
                at, last = end, piece
                if at < n:
                    piece = longest[at]
            elif len(piece) > 1:
                piece = shorter[piece]
            else:
                if failed is None:
                    failed = bytearray(n // 8 + 1)
                failed[at >> 3] |= 1 << (at & 7)
                piece = out.pop()
                last = out[-1] if out else ""
                at -= len(piece)
        return out

    def _chunk(self, chunk: str) -> bytes:
        pieces = self.pieces(chunk)
        try:
            return b"".join(map(self.written.__getitem__, pieces))
        except KeyError:  # a character without a piece
            return self.model.ids_of(pieces).tobytes()

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as bytes."""
        known, out = self.known.__getitem__, []
        for text in texts:
            escaped = text.replace(" ", SPACE)
            if text and self.model.prefix:
                escaped = SPACE + escaped
            if self.chunked:
                out.append(b"".join(map(known, self.chunk.findall(escaped))))
            else:
                out.append(self._chunk(escaped))
        return out


def piece_encoder(path: str) -> PieceIds:
    """The process's encoder for a model file."""
    if path not in _ENCODERS:
        _ENCODERS[path] = PieceIds(path)
    return _ENCODERS[path]


class PieceText:
    """Decodes ids as the library does: by the pieces' bytes, and by the library where ids are no plain pieces."""

    def __init__(self, path: str):
        self.library, model = SentencePieceProcessor(model_file=path), PieceModel(path)
        self.prefix = model.prefix
        self.first = set(model.ids.values())
        self.spaced = {k for piece, k in model.ids.items() if piece.startswith(SPACE)}
        plain = self.first | set(model.byte_ids.values())
        self.bytes_of = [x if k in plain else None for k, x in enumerate(model.bytes_of)]

    def decode(self, ids: list[int]) -> str:
        if not ids:
            return ""
        if ids[0] in self.first:
            try:
                text = b"".join(map(self.bytes_of.__getitem__, ids)).decode()
                return text[1:] if self.prefix and ids[0] in self.spaced else text
            except (IndexError, TypeError, UnicodeDecodeError):  # ids without bytes, or bytes that are no text
                pass
        return self.library.decode(ids)


def _decoder(path: str) -> PieceText:
    if path not in _DECODERS:
        _DECODERS[path] = PieceText(path)
    return _DECODERS[path]


def _encoded(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = piece_encoder(path)
        for batch in batches:
            texts = [x or "" for x in batch.column(1).to_pylist()]
            for a, b in slices(texts):
                found = encoder.encode(texts[a:b])
                ends = np.cumsum([0, *[len(x) // 4 for x in found]], dtype=np.int64)
                ids = pa.array(np.frombuffer(b"".join(found), "<u4").astype(np.int32))
                yield pa.RecordBatch.from_arrays([batch.column(0)[a:b], pa.ListArray.from_arrays(pa.array(ends, pa.int32()), ids)], names=["doc_id", "piece_ids"])

    return run


def encode_pieces(docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, piece_ids (array of int), as the library encodes without begin and end ids."""
    ship_package(docs.sparkSession)
    slim = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return slim.mapInArrow(_encoded(model), "doc_id long, piece_ids array<int>")


def _decoded(path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = _decoder(path)
        for batch in batches:
            ids = batch.column(1).fill_null([]) if batch.column(1).null_count else batch.column(1)
            ends = np.cumsum([0, *[x or 0 for x in pa.compute.list_value_length(ids).to_pylist()]])
            at = 0
            while at < batch.num_rows:
                stop = max(at + 1, int(np.searchsorted(ends, ends[at] + DECODED_IDS, "right")) - 1)
                part = ids.slice(at, stop - at)
                held, cuts = part.flatten().to_numpy().tolist(), (ends[at : stop + 1] - ends[at]).tolist()
                texts = [decoder.decode(held[a:b]) for a, b in pairwise(cuts)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(at, stop - at), part, pa.array(texts, pa.string())], names=["doc_id", "piece_ids", "decoded"])
                at = stop

    return run


def decode_pieces(encoded: DataFrame, model: str) -> DataFrame:
    """The rows of ``encode_pieces`` with their text: doc_id, piece_ids, decoded; null ids count as none."""
    ship_package(encoded.sparkSession)
    return encoded.select("doc_id", "piece_ids").mapInArrow(_decoded(model), "doc_id long, piece_ids array<int>, decoded string")
