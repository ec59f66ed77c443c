import hashlib
from collections import Counter, defaultdict

import pytest
from sentencepiece import SentencePieceProcessor
from tokenizers import Tokenizer

from tallymark.llm.alignment import align_tokens
from tallymark.llm.queries import op12_alignment, vocabulary
from tallymark.llm.word_ids import PRINTED
from tests.conftest import SMALL
from tests.llm.common import AWKWARD, documents

SIDE_A, SIDE_B = vocabulary("byte_bpe_50k.json"), vocabulary("piece_bpe_32k.model")


def spans(parts):
    at = 0
    for part in parts:
        yield at, at + len(part)
        at += len(part)


def plain(rows):
    """Every pair of tokens compared, document by document: (doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups)."""
    side_a, side_b = Tokenizer.from_file(SIDE_A), SentencePieceProcessor(model_file=SIDE_B)
    side_a.encode_special_tokens = True
    byte_of = {chr(PRINTED.get(b, b)): b for b in range(256)}
    found, held = [], Counter()
    for doc_id, text in rows:
        body = f" {text}".encode()
        a, b = side_a.encode(f" {text}", add_special_tokens=False).ids, side_b.encode(text or "")
        parts_a = [bytes(byte_of[c] for c in side_a.id_to_token(x)) for x in a]
        parts_b = [bytes([int(side_b.id_to_piece(x)[3:5], 16)]) if side_b.is_byte(x) else side_b.id_to_piece(x).replace("▁", " ").encode() for x in b]
        if not text or b"".join(parts_a) != body or b"".join(parts_b) != body:
            found.append((doc_id, 0, 0, 0, [], ""))
            continue
        spans_a, spans_b = list(spans(parts_a)), list(spans(parts_b))
        if len(a) * len(b) < 1e6:
            links = [(x, y) for x, (l1, h1) in zip(a, spans_a, strict=True) for y, (l2, h2) in zip(b, spans_b, strict=True) if l1 < h2 and l2 < h1]
        else:  # byte by byte
            of_a, of_b = ([k for k, (low, high) in enumerate(x) for _ in range(low, high)] for x in (spans_a, spans_b))
            links = [(a[x], b[y]) for x, y in dict.fromkeys(zip(of_a, of_b, strict=True))]
        groups, low = [], 0
        for cut in sorted({h for _, h in spans_a} & {h for _, h in spans_b}):
            groups.append("|".join(",".join(str(x) for x, (_, h) in zip(side, ends, strict=True) if low < h <= cut) for side, ends in ((a, spans_a), (b, spans_b))) if len(a) < 3000 else None)
            low = cut
        found.append((doc_id, len(a), len(b), len(groups), links, None if None in groups else ";".join(groups)))
        held.update(set(links))
    best = defaultdict(int)
    for (x, _), n in held.items():
        best[x] = max(best[x], n)
    return [(*row[:4], len(row[4]), sum(held[x] == best[x[0]] for x in row[4]), sum(held[x] for x in row[4]), row[5]) for row in found]


def equal(got, want):
    key = lambda r: (r[0] is None, r[0] or 0, *r[1:7])
    got, want = sorted(map(tuple, got), key=key), sorted(want, key=key)
    assert [r[:7] for r in got] == [r[:7] for r in want]
    assert all(w[7] is None or g[7] == w[7] for g, w in zip(got, want, strict=True))


ROWS = [*[r[:2] for r in AWKWARD], (20, " <|endoftext|> <s> \U0001f600 é <0x41>"), (20, " <|endoftext|> <s> \U0001f600 é <0x41>"), (21, "a ▁ b"), (22, "\n\t  x   "), (23, "naïve café, don't\r\n" * 40)]


@pytest.mark.parametrize(("slice_postings", "partitions"), [(4 << 20, 1), (2, 5)])
def test_equals_every_pair_compared(spark, slice_postings, partitions):
    docs = documents(spark, ROWS, clash=("PAIR", "row", "N_LINKS")).repartition(partitions)
    equal(align_tokens(docs, SIDE_A, SIDE_B, slice_postings=slice_postings).collect(), plain(ROWS))


def test_words_in_every_document_are_cut_into_slices(spark):
    rows = [(k, f"the same words {'again ' * (k % 3)}{k}") for k in range(300)]
    equal(align_tokens(documents(spark, rows).repartition(20), SIDE_A, SIDE_B, slice_postings=40).collect(), plain(rows))


def test_texts_without_tokens(spark):
    rows = [(1, None), (2, ""), (3, "▁")]
    assert sorted(map(tuple, align_tokens(documents(spark, rows), SIDE_A, SIDE_B).collect())) == [(k, 0, 0, 0, 0, 0, 0, "") for k in (1, 2, 3)]


def test_empty_table(spark):
    assert align_tokens(documents(spark, []), SIDE_A, SIDE_B).count() == 0


def test_query_equals_every_pair_compared(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()]
    want = {r[0]: (*r[1:7], r[7] and hashlib.sha256(r[7].encode()).hexdigest()) for r in plain(rows)}
    for row in op12_alignment(spark, SMALL).collect():
        assert tuple(row[1:7]) == want[row[0]][:6]
        assert want[row[0]][6] is None or row[7] == want[row[0]][6]
