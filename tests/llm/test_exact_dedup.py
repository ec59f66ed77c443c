import hashlib
import re

from hypothesis import given, settings
from hypothesis import strategies as st

from tallymark.llm.exact_dedup import Owner, PatriciaTrie, exact_dedup, first_documents
from tests.llm.common import AWKWARD, documents


def brute(rows):
    groups = {}
    for doc_id, text in rows:
        norm = re.sub(r"[\x20\x09-\x0D]", "", text or "")
        groups.setdefault(norm, []).append((-len(text or ""), doc_id is None, doc_id or 0))
    out = []
    for doc_id, text in rows:
        norm = re.sub(r"[\x20\x09-\x0D]", "", text or "")
        best = min(groups[norm])
        keep = None if best[1] else best[2]
        out.append((doc_id, keep, len(groups[norm]), doc_id == keep and -len(text or "") == best[0], hashlib.sha256(norm.encode()).hexdigest()))
    return sorted(map(repr, out))


def test_awkward_rows_match_brute_force(spark):
    rows = [r[:2] for r in AWKWARD]
    found = exact_dedup(documents(spark, AWKWARD, ("keep_id", "group_size", "kept", "n_bytes", "points", "body")))
    assert sorted(repr(tuple(r)) for r in found.collect()) == brute(rows)


def test_hot_copies_in_small_tries(spark):
    rows = [(k, "same text here" + " " * (k % 3)) for k in range(300)] + [(1000 + k, f"text {k % 50}") for k in range(200)]
    found = exact_dedup(documents(spark, rows).repartition(7), flush_bytes=2000, trie_bytes=3000)
    assert sorted(repr(tuple(r)) for r in found.collect()) == brute(rows)


def test_empty_table(spark):
    assert exact_dedup(documents(spark, [])).collect() == []


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.binary(max_size=6), st.integers(0, 3)), max_size=60), st.sampled_from([None, 1, 700, 3000]))
def test_trie_equals_a_dictionary(pairs, budget):
    trie, want = PatriciaTrie(budget), {}
    for k, (key, points) in enumerate(pairs):
        trie.insert(key, Owner(points, k, 1))
        best, n = want.get(key, ((0, 0), 0))
        want[key] = (min(best, (-points, k)) if n else (-points, k), n + 1)
    found = {key: ((-o.points, o.doc_id), o.n_rows) for key, o in trie.drain()}
    assert found == want


def test_deep_chains_of_prefixes_are_worked_off():
    trie = PatriciaTrie(1)
    for k in range(1500):
        trie.insert(b"a" * (k + 1), Owner(0, k, 1, b"row"))
    assert sorted(len(key) for key, o in trie.drain() if o.payload == b"row") == list(range(1, 1501))


def test_first_documents_keep_whole_rows(spark):
    rows = [(k % 40, f"text {k % 25}" + " " * (k % 3)) for k in range(300)]
    docs = documents(spark, rows, ("n_rows",))
    found = first_documents(docs.repartition(7), flush_bytes=2000, trie_bytes=3000).collect()
    best = {}
    for doc_id, text in rows:
        best[text.strip()] = min(best.get(text.strip(), (0, 0)), (-len(text), doc_id))
    assert sorted((-len(r.text), r.doc_id, r.text.strip(), r.n_rows) for r in found) == sorted((*v, k, 1) for k, v in best.items())
    assert first_documents(documents(spark, [])).collect() == []
