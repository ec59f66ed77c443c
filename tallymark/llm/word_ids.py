"""Token ids of whole texts by a public tokenizer, with a lookup of chunks that were seen before.

The ids are those of the tokenizers library, ``encode(text, add_special_tokens=False)``. For tokenizers of
two known layouts, which are told by their files, texts are cut into chunks: these split a text into
pieces before they merge, and no piece begins inside a run of ASCII white space and what follows it up to
the next such run. So a text cut before each of these runs has the ids of its chunks, one after another.
A text with any other white space, or with an added token's string, is encoded as a whole, as there the
rule does not hold; so is every text for a tokenizer of another layout.

A new chunk of ASCII and common Latin letters is cut into pieces by the tokenizer's own pattern, whose
character classes are plain in that range, and each new piece goes to the tokenizer's merge model; any
other chunk goes through the whole tokenizer.
"""

from __future__ import annotations

import json
import os
import re

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
os.environ.setdefault("RAYON_NUM_THREADS", "1")

import numpy as np
from tokenizers import Tokenizer

# White space other than [\x20\x09-\x0D]; letters, all of them single characters in
# either case; and the two tokenizers' patterns within these characters.
OTHER_SPACE = re.compile(f"[{''.join(map(chr, (*range(0x1C, 0x20), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)))}]")
LETTERS = "A-Za-zÀ-ÖØ-öø-įı-ķĹ-ňŊ-ž"
CONTRACTIONS = "'s|'t|'re|'ve|'m|'ll|'d"
SPACED = re.compile(f"{CONTRACTIONS}| ?[{LETTERS}]+| ?[0-9]+| ?[^ \t-\r0-9{LETTERS}]+|[ \t-\r]+(?![^ \t-\r])|[ \t-\r]+")
BARE = re.compile(f"{CONTRACTIONS}|[{LETTERS}]+|[0-9]|[^ \t-\r0-9{LETTERS}]+")
PLAIN = re.compile(f"[ \t-\r!-~{LETTERS}]+")
CHUNK = re.compile("[ \t-\r]*[^ \t-\r]+|[ \t-\r]+")
#: Fixed value: how byte-level vocabularies write bytes that do not print.
PRINTED = {b: 256 + k for k, b in enumerate(x for x in range(256) if not (33 <= x <= 126 or 161 <= x <= 172 or x >= 174))}
SPACE = chr(PRINTED[32])
# What the two known layouts' files say before the merges, and whether white space has ids.
BYTE_LEVEL = {"type": "ByteLevel", "add_prefix_space": False, "trim_offsets": True, "use_regex": True}
SPLIT = {"type": "Split", "pattern": {"Regex": r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"}, "behavior": "Removed", "invert": True}
LOWER = {"type": "Sequence", "normalizers": [{"type": "NFC"}, {"type": "Replace", "pattern": {"Regex": r"\s+"}, "content": " "}, {"type": "Lowercase"}]}
LAYOUTS = [
    ({"normalizer": None, "pre_tokenizer": BYTE_LEVEL, "post_processor": None, "truncation": None, "padding": None}, None, True),
    ({"normalizer": LOWER, "pre_tokenizer": {"type": "Sequence", "pretokenizers": [SPLIT, BYTE_LEVEL | {"use_regex": False}]}, "post_processor": None, "truncation": None, "padding": None}, "</w>", False),
]
MODEL = {"type": "BPE", "dropout": None, "unk_token": None, "continuing_subword_prefix": None, "fuse_unk": False, "byte_fallback": False, "ignore_merges": False}
#: Chunks, and pieces, from which the lookups start again, and characters of each at most.
HELD = 700_000
LONGEST = 64

_ENCODERS: dict[tuple, WordIds] = {}


class _Lookup(dict):
    """Ids of short strings; others, and new ones, are made when asked for."""

    def __init__(self, make):
        super().__init__()
        self.make = make

    def __missing__(self, key: str) -> bytes:
        made = self.make(key)
        if len(key) <= LONGEST:
            self[key] = made
        return made


def keeps_space(file: dict) -> bool | None:
    """Whether white space has ids in a tokenizer of a known layout; None for another."""
    model = file["model"]
    for layout, suffix, keep_space in LAYOUTS:
        if all(file.get(k) == v for k, v in layout.items()) and all(model.get(k) == v for k, v in MODEL.items()) and (model.get("end_of_word_suffix") or None) == suffix:
            return keep_space
    return None


class WordIds:
    """Encodes texts to unsigned little-endian ids of ``dtype``.

    special_as_text: the strings of added tokens in a text are ordinary text, not these tokens.
    """

    def __init__(self, path: str, dtype: str, special_as_text: bool = False):
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = special_as_text
        file = json.loads(self.tokenizer.to_str())
        self.keep_space, self.dtype, self.held = keeps_space(file), dtype, HELD
        # Strings that would be found by their own, in whatever case; all begin with the part that is searched for first.
        added = [x["content"] for x in file["added_tokens"] if not (special_as_text and x["special"])]
        self.added = re.compile("|".join(map(re.escape, added)), re.IGNORECASE) if added else None
        self.added_start = os.path.commonprefix([re.match(r"[^\w\s]*", x)[0] for x in added])
        self.merge = self.tokenizer.model.tokenize
        n = self.tokenizer.get_vocab_size()
        if n > np.iinfo(dtype).max + 1:
            raise ValueError(f"{path}: ids do not fit {dtype}")
        ids = np.arange(n, dtype=dtype)
        self.written = [ids[k : k + 1].tobytes() for k in range(n)]
        self.known, self.pieces = _Lookup(self._chunk), _Lookup(self._piece)

    def chunks(self, text: str) -> list[str] | None:
        """The text in chunks; None if it must be encoded as a whole."""
        if self.keep_space is None or OTHER_SPACE.search(text) or (self.added and self.added_start in text and self.added.search(text)):
            return None
        return CHUNK.findall(text) if self.keep_space else text.split()

    def _whole(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.dtype).tobytes()

    def _piece(self, piece: str) -> bytes:
        printed = piece.replace(" ", SPACE) if piece.isascii() and piece.isprintable() else piece.encode().decode("latin-1").translate(PRINTED)
        written = self.written
        return b"".join([written[x.id] for x in self.merge(printed)])

    def _chunk(self, chunk: str) -> bytes:
        if PLAIN.fullmatch(chunk):
            parts = SPACED.findall(chunk) if self.keep_space else BARE.findall(chunk.lower())
            return b"".join(map(self.pieces.__getitem__, parts))
        return self._whole(chunk)

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as bytes."""
        ids = self.known.__getitem__
        out = []
        for text in texts:
            chunks = self.chunks(text)
            out.append(self._whole(text) if chunks is None else b"".join(map(ids, chunks)))
            for held in (self.known, self.pieces):
                if len(held) > self.held:
                    held.clear()
        return out


def encoder(path: str, dtype: str = "<u2", special_as_text: bool = False) -> WordIds:
    """The process's encoder for a vocabulary file."""
    key = (path, dtype, special_as_text)
    if key not in _ENCODERS:
        _ENCODERS[key] = WordIds(*key)
    return _ENCODERS[key]


def slices(texts: list[str], chars: int = 1 << 21):
    """Index ranges of at most about ``chars`` characters, one text at least."""
    start, held = 0, 0
    for k, text in enumerate(texts):
        if held and held + len(text) > chars:
            yield start, k
            start, held = k, 0
        held += len(text)
    if start < len(texts):
        yield start, len(texts)
