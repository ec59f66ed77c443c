import zlib

import numpy as np
import pytest

from tallymark.llm.queries import vocabulary
from tallymark.llm.token_files import PerfectHash, Shard, find_documents, read_token_files, write_token_files
from tallymark.llm.word_ids import WordIds
from tests.llm.common import AWKWARD, documents


def tokenizer(path):
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


TEXTS = ["", " ", "  a", "a  ", "a\n\nb", "a \n b", "a  b", "a   b", "a\x1c b!\x1c", "it's  'll we'Re", "1 22  333", "x\t\t y z", "<|endoftext|> x", "hello <|endoftext|> world", "a<|startoftext|>", "<|ENDOFTEXT|>", "<|endoftext", "<|x", "é́ é Σς ΟΔΟΣ", "😀 a😀b  😀", "\r\n\r\n x", "a" * 300 + "  " + "b" * 70]


@pytest.mark.parametrize("special_as_text", [False, True])
@pytest.mark.parametrize(("name", "keep_space"), [("byte_bpe_50k.json", True), ("word_bpe_49k.json", False)])
def test_chunks_give_the_ids_of_whole_texts(name, keep_space, special_as_text):
    path = vocabulary(name)
    whole, chunked = tokenizer(path), WordIds(path, "<u2", special_as_text)
    whole.encode_special_tokens = special_as_text
    assert chunked.keep_space is keep_space
    texts = TEXTS + [a + b for a in TEXTS for b in TEXTS]
    assert [np.frombuffer(x, "<u2").tolist() for x in chunked.encode(texts)] == [whole.encode(t, add_special_tokens=False).ids for t in texts]


def test_round_trip_of_awkward_documents(spark):
    path = vocabulary("byte_bpe_50k.json")
    whole = tokenizer(path)
    docs = documents(spark, AWKWARD, ("start", "path", "part", "h"))
    shards = write_token_files(docs.repartition(3), path, shard_bytes=200)
    found = sorted(map(tuple, read_token_files(shards).collect()), key=lambda r: r[1])
    rows = sorted(((r[0], whole.encode(r[1] or "", add_special_tokens=False).ids + [0]) for r in AWKWARD), key=lambda r: (r[0] is not None, r[0] or 0))
    at, want = 0, []
    for doc_id, ids in rows:
        want.append((doc_id, at, len(ids), zlib.crc32(np.array(ids, "<u4"))))
        at += len(ids)
    assert found == want
    assert shards.count() > 1
    for row in shards.collect():
        shard = Shard(row.path)
        for doc_id, ids in rows:
            got = shard.ids(doc_id)
            assert got is None or got.tolist() == ids
        assert shard.ids(987654321) is None
        shard.close()


def test_perfect_hash_is_minimal():
    for n in (0, 1, 2, 1000, 20_000):
        keys = np.stack([np.arange(n, dtype=np.uint64) * np.uint64(7919), np.zeros(n, np.uint64)], 1)
        index = PerfectHash.build(keys)
        assert sorted(index.place(keys).tolist()) == list(range(n))
        assert index.find(keys).tolist() == list(range(n))
        others = keys + np.uint64(3)
        if n:
            assert (index.find(others) >= 0).mean() < 0.01


def test_empty_table(spark):
    assert read_token_files(write_token_files(documents(spark, []), vocabulary("byte_bpe_50k.json"))).collect() == []


def test_special_strings_give_what_the_library_gives():
    for name in ("byte_bpe_50k.json", "word_bpe_49k.json"):
        text = "hello <|endoftext|> world"
        want = tokenizer(vocabulary(name)).encode(text, add_special_tokens=False).ids
        assert np.frombuffer(WordIds(vocabulary(name), "<u2").encode([text])[0], "<u2").tolist() == want and len(want) in (3, 4)


def test_a_tokenizer_of_another_layout_encodes_whole_texts(tmp_path):
    """The same vocabulary with a normalizer that the lookup of chunks does not know."""
    import json

    file = json.loads(open(vocabulary("byte_bpe_50k.json"), encoding="utf8").read())
    file["normalizer"] = {"type": "Prepend", "prepend": "_"}
    (tmp_path / "other.json").write_text(json.dumps(file))
    ours, whole = WordIds(f"{tmp_path}/other.json", "<u2"), tokenizer(f"{tmp_path}/other.json")
    assert ours.keep_space is None
    assert [np.frombuffer(x, "<u2").tolist() for x in ours.encode(TEXTS)] == [whole.encode(t, add_special_tokens=False).ids for t in TEXTS]


def test_documents_are_found_by_key_over_all_shards(spark):
    path = vocabulary("byte_bpe_50k.json")
    whole = tokenizer(path)
    rows = AWKWARD + [(None, "another"), (8, "a third eight")] + [(k * 3, f"text {k}") for k in range(20, 300)]
    shards = write_token_files(documents(spark, rows).repartition(5), path, shard_bytes=300)
    assert shards.count() > 5
    wanted = [None, 8, 8, 7, 60, 61, 897, -5, 10**12, None]
    found = find_documents(shards, documents(spark, [(k, "x") for k in wanted], ("path", "start", "shard"))).collect()
    want = sorted((r[0] or 0, whole.encode(r[1] or "", add_special_tokens=False).ids + [0]) for r in rows if r[0] in wanted)
    assert sorted((r.doc_id or 0, r.ids) for r in found) == want
    places = {(r.doc_id, r.start, r.n_tokens) for r in read_token_files(shards).collect()}
    assert all((r.doc_id, r.start, r.n_tokens) in places for r in found)
    assert find_documents(shards, documents(spark, [])).collect() == []
    assert find_documents(write_token_files(documents(spark, []), path), documents(spark, [(1, "x"), (None, "x")])).collect() == []


def test_shards_of_empty_documents_end_at_their_number(spark):
    shards = write_token_files(documents(spark, [(k, None if k % 2 else "") for k in range(5000)]), vocabulary("byte_bpe_50k.json"), shard_docs=300)
    sizes = [r.n_docs for r in shards.collect()]
    assert max(sizes) == 300 and sum(sizes) == 5000
    found = sorted((r.doc_id, r.start, r.n_tokens) for r in read_token_files(shards).collect())
    assert found == [(k, k, 1) for k in range(5000)]
