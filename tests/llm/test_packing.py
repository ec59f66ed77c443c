import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tallymark.llm.packing import best_fill, first_id, pack, pack_sequences
from tallymark.llm.queries import vocabulary
from tests.llm.common import AWKWARD, documents


@settings(max_examples=200, deadline=None)
@given(st.dictionaries(st.integers(1, 12), st.integers(1, 4), max_size=5), st.integers(0, 40))
def test_best_fill_is_optimal(counts, room):
    sums = {0}
    for length, n in counts.items():
        sums = {s + length * k for s in sums for k in range(n + 1)}
    fill = best_fill(counts, room)
    assert all(n <= counts[k] for k, n in fill)
    assert sum(k * n for k, n in fill) == max(s for s in sums if s <= room)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.integers(1, 70), max_size=40))
def test_every_token_is_in_one_piece_and_nothing_is_padded(lengths):
    seen = [np.zeros(n, int) for n in lengths]
    for sequence in pack(lengths, 16):
        size = sum(x[2] for x in sequence)
        assert size <= 16 and size & (size - 1) == 0
        for doc, start, n in sequence:
            assert n > 0
            seen[doc][start : start + n] += 1
    assert all((x == 1).all() for x in seen)


def test_pieces_of_awkward_documents(spark):
    from tokenizers import Tokenizer

    path = vocabulary("word_bpe_49k.json")
    tokenizer = Tokenizer.from_file(path)
    rows = [(k, r[1]) for k, r in enumerate(AWKWARD)] + [(100, "<|endoftext|> há it's Isn'T 12 a!b"), (101, "a" * 500)]
    ids = {k: np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 1], "<u4") for k, t in rows}
    found = pack_sequences(documents(spark, rows, ("start", "length", "offset")).repartition(3), path, group_docs=4).collect()
    by_sequence = {}
    left = {k: len(x) for k, x in ids.items()}
    for r in found:
        part = ids[r.doc_id][r.start : r.start + r.length]
        assert r.doc_tokens == len(ids[r.doc_id]) and zlib.crc32(part) == r.ids_crc32
        left[r.doc_id] -= r.length
        by_sequence.setdefault(r.sequence_id, []).append((r.offset, r.length))
    assert not any(left.values())
    for pieces in by_sequence.values():
        at = 0
        for offset, length in sorted(pieces):
            assert offset == at
            at += length
        assert at <= 2048
    assert len({(r.doc_id, r.start) for r in found}) == len(found)


def test_empty_table(spark):
    assert pack_sequences(documents(spark, []), vocabulary("word_bpe_49k.json")).collect() == []


def test_null_and_repeated_identifiers(spark):
    rows = [(None, "a b"), (None, "a b"), (1, "c d e"), (1, "c d e"), (1, "f")]
    found = pack_sequences(documents(spark, rows), vocabulary("word_bpe_49k.json")).collect()
    assert sorted((r.doc_id or 0, r.doc_tokens) for r in found if r.start == 0) == [(0, 3), (0, 3), (1, 2), (1, 4), (1, 4)]
    assert sum(r.length for r in found) == 16


@pytest.mark.parametrize("tails", [8, 4096])
def test_only_the_last_tail_is_short_however_rows_are_dealt(spark, tails):
    rng = np.random.default_rng(4)
    rows = [(k, " ".join(["word"] * int(n))) for k, n in enumerate(rng.integers(0, 900, 300))]
    tokens = sum(len(t.split()) + 1 for _, t in rows)
    want = tokens // 512 + bin(tokens % 512).count("1")
    for partitions in (1, 5, 40):
        found = pack_sequences(documents(spark, rows).repartition(partitions), vocabulary("word_bpe_49k.json"), window=512, group_docs=30, tails=tails).collect()
        sizes, pieces = {}, {}
        for r in found:
            sizes[r.sequence_id] = sizes.get(r.sequence_id, 0) + r.length
            pieces.setdefault(r.doc_id, []).append((r.start, r.length, r.doc_tokens))
        for held in pieces.values():
            at = 0
            for start, length, whole in sorted(held):
                assert start == at
                at += length
            assert at == whole
        assert len(pieces) == len(rows)
        assert len(sizes) == want and sum(n < 512 for n in sizes.values()) == bin(tokens % 512).count("1")


def test_identifiers_that_would_meet_are_an_error():
    assert first_id(7, (1 << 20) - 1) + (((1 << 16) - 1) << 24) + (1 << 24) - 1 == (1 << 63) - 1
    for number, partition in ((0, 1 << 20), (8, 0)):
        with pytest.raises(OverflowError):
            first_id(number, partition)
