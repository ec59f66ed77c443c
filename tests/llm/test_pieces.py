import hashlib
import random
import time

import pytest
from sentencepiece import SentencePieceProcessor

from tallymark.llm.pieces import PieceModel, decode_pieces, encode_pieces, piece_encoder
from tallymark.llm.queries import op11_pieces, vocabulary
from tests.conftest import SMALL
from tests.llm.common import AWKWARD, documents

MODEL = vocabulary("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return SentencePieceProcessor(model_file=MODEL)


def ids(text, encoder=None):
    return memoryview((encoder or piece_encoder(MODEL)).encode([text])[0]).cast("I").tolist()


def texts():
    draw = random.Random(7)
    pieces = list(PieceModel(MODEL).ids)
    for k in range(1500):
        yield [
            lambda: "".join(draw.choices(pieces, k=draw.randint(1, 12))).replace("▁", draw.choice([" ", "", "▁"])),
            lambda: "".join(draw.choice("aab bc d  e\n\t,.") for _ in range(draw.randint(0, 60))),
            lambda: "".join(chr(draw.choice([draw.randint(0, 127), draw.randint(1, 0x2FFF), draw.randint(0x10000, 0x1FFFF), 0x2581, 32])) for _ in range(draw.randint(0, 40))),
            lambda: "".join(draw.choice("thereisnocowlevelingtion") for _ in range(draw.randint(0, 300))),
        ][k % 4]()


def test_ids_equal_the_library(library):
    for text in ["", " ", "  ", "a", " a ", "<s> </s> <0x41> <unk>", "\x00", "é", *texts()]:
        assert ids(text) == library.encode(text), repr(text)


def test_whole_texts_without_chunks_equal_the_library(library):
    whole = type(piece_encoder(MODEL))(MODEL)
    whole.chunked = False
    for text in list(texts())[:300]:
        assert ids(text, whole) == library.encode(text), repr(text)


def test_steps_back_past_a_longest_match(library):
    """Somewhere the longest piece is not the encoding's, so that the encoder must step back."""
    encoder, stepped = piece_encoder(MODEL), 0
    for text in texts():
        escaped = "▁" + text.replace(" ", "▁")
        found = encoder.pieces(escaped)
        at = 0
        for piece in found:
            longest = max((n for n in range(1, 17) if escaped[at : at + n] in encoder.model.ids and len(escaped[at : at + n]) == n), default=1)
            stepped += len(piece) < longest
            at += len(piece)
        assert "".join(found) == escaped
    assert stepped > 100


def test_long_texts_take_linear_time(library):
    for text in ("ab" * 200_000, " " * 50_000, "x" * 200_000, "ÿ你" * 50_000):
        began = time.perf_counter()
        assert ids(text) == library.encode(text)
        assert time.perf_counter() - began < 20


def test_other_models_are_refused(tmp_path):
    path = tmp_path / "unigram.model"
    path.write_bytes(b"\x12\x02\x18\x01\x1a\x02\x20\x00")  # a trainer's description of kind 1
    with pytest.raises(ValueError, match="not a model of merges"):
        PieceModel(str(path))


def test_awkward_rows(spark, library):
    rows = [*AWKWARD, (11, "▁ ▁", None, None), (12, "</s><|endoftext|>", None, None)]
    found = decode_pieces(encode_pieces(documents(spark, rows, clash=("PIECE_IDS", "decoded")), MODEL), MODEL).collect()
    key = lambda x: (x[0] is None, x[0] or 0, x[1])
    want = [(r[0], library.encode(r[1] or ""), library.decode(library.encode(r[1] or ""))) for r in rows]
    assert sorted(((r.doc_id, r.piece_ids, r.decoded) for r in found), key=key) == sorted(want, key=key)


def test_decoder_takes_any_ids(spark, library):
    draw = random.Random(3)
    rows = [(k, [draw.randrange(32_000) for _ in range(draw.randint(0, 30))]) for k in range(200)] + [(200, None), (201, [0, 1, 2, 250, 251])]
    found = decode_pieces(spark.createDataFrame(rows, "doc_id long, piece_ids array<int>"), MODEL).collect()
    assert {r.doc_id: r.decoded for r in found} == {k: library.decode(x or []) for k, x in rows}


def test_empty_table(spark):
    assert decode_pieces(encode_pieces(documents(spark, []), MODEL), MODEL).count() == 0


def test_query_equals_the_library(spark, library):
    rows = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    want = {}
    for doc_id, text in rows:
        found = library.encode(text or "")
        want[doc_id] = (len(found), sha(",".join(map(str, found))), sha(library.decode(found)))
    assert {r[0]: tuple(r[1:]) for r in op11_pieces(spark, SMALL).collect()} == want
