import random

import numpy as np
import pytest

import corpus_pipeline
from tallymark.llm.gray_index import gray_rank, majority
from tallymark.llm.simhash import simhash_near_dedup
from tallymark.llm import wording
from tallymark.llm.wording import CELLS, Unit, alike, rarest, shingles
from tests.conftest import SMALL
from tests.llm.common import AWKWARD, documents


def runs(text):
    w = text.lower().split()
    return {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))}


def jaccard(a, b):
    a, b = runs(a), runs(b)
    return len(a & b) / len(a | b)


def groups(rows, similarity=0.8):
    """The smallest identifier of each row's group, by all pairs."""
    root = {r[0]: r[0] for r in rows if r[0] is not None}
    sets = {k: runs(t or "") for k, t in rows if k is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in sets:
        for b in sets:
            if a < b and len(sets[a] & sets[b]) >= similarity * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {k: find(k) for k in root}


def planted(n=60):
    """Pairs with a known similarity between 0.6 and 0.97, and texts like no other."""
    rng = random.Random(7)
    word = lambda: "".join(rng.choices("abcdefghijklmnop", k=6))
    rows = []
    for k in range(n):
        words = [word() for _ in range(rng.choice((60, 200, 900)))]
        changed = list(words)
        for _ in range(rng.randint(1, max(1, len(words) // 25))):
            changed[rng.randrange(len(words))] = word()
        rows += [(3 * k, " ".join(words)), (3 * k + 1, " ".join(changed)), (3 * k + 2, " ".join(word() for _ in range(80)))]
    return rows


def chained(n=160):
    """One large group whose members drift apart, so that only neighbours are alike, and others near it that are not."""
    rng = random.Random(11)
    word = lambda: "".join(rng.choices("abcdefgh", k=5))
    words, rows = [word() for _ in range(120)], []
    for k in range(n):
        rows.append((k, " ".join(words)))
        words = list(words)
        for _ in range(1 if k % 10 else 4):
            words[rng.randrange(len(words))] = word()
    return rows


def test_pipeline_passes_one_of_each_planted_pair_to_mixing(spark):
    rows = planted()
    text = dict(rows)
    near = [k for k in range(0, len(rows), 3) if jaccard(text[k], text[k + 1]) >= 0.8]
    assert sum(jaccard(text[k], text[k + 1]) < 0.95 for k in near) >= 10
    assert len(near) < len(rows) // 3
    docs = documents(spark, rows)
    for name, stage in corpus_pipeline.STAGES[1:]:
        if name == "mixing":
            break
        docs = stage(spark, docs, "")
    assert {r.doc_id for r in docs.collect()} == set(text) - {k + 1 for k in near}


def test_recall_on_the_test_documents_is_whole(spark):
    docs = spark.read.parquet(f"{SMALL.replace('0.001', '0.01')}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    found = {r.doc_id: r.component_id for r in simhash_near_dedup(docs, words=5, similarity=0.8).collect()}
    assert found == groups(rows)


def test_against_all_pairs_and_awkward_rows(spark):
    rows = [*((r[0], r[1]) for r in AWKWARD), *[(k + 100, t) for k, t in planted(15)], (90, "a b c d e f g h i j k"), (91, "A b c d e f g  h i j k l"), (92, "z")]
    found = simhash_near_dedup(documents(spark, rows, ("node", "least", "root", "part")), words=5, similarity=0.8).collect()
    assert len(found) == len(rows)
    assert {r.doc_id: r.component_id for r in found if r.doc_id is not None} == groups(rows)
    assert [r.component_id for r in found if r.doc_id is None] == [None]
    assert all(r.first == (r.doc_id == r.component_id) for r in found)
    assert simhash_near_dedup(documents(spark, []), words=5, similarity=0.8).collect() == []


@pytest.mark.parametrize("unit_rows", [4, 24])
def test_groups_beyond_one_unit_lose_no_link(spark, unit_rows):
    rows = chained()
    want = groups(rows)
    assert 1 < len(set(want.values())) < 40
    found = simhash_near_dedup(documents(spark, rows), words=5, similarity=0.8, unit_rows=unit_rows, small=unit_rows).collect()
    assert {r.doc_id: r.component_id for r in found} == want


def templated(n=600):
    """Pages of one template: 100 common words and 60 of their own; every tenth has a near copy."""
    rng = random.Random(5)
    word = lambda: "".join(rng.choices("abcdefghijklmnop", k=6))
    common = [word() for _ in range(100)]
    rows = []
    for k in range(n):
        own = [word() for _ in range(60)]
        rows.append((2 * k, " ".join(common + own)))
        if k % 10 == 0:
            own[rng.randrange(60)] = word()
            rows.append((2 * k + 1, " ".join(common + own)))
    return rows


@pytest.mark.parametrize("unit_rows", [7, 50])
def test_pages_of_one_template_are_not_sent_to_every_unit(spark, monkeypatch, unit_rows):
    rows, seen = templated(), []
    across = wording.across

    def counted(parted, *rest):
        found = across(parted, *rest)
        seen.append((parted.count(), found.count()))
        return found

    monkeypatch.setattr(wording, "across", counted)
    found = {r.doc_id: r.component_id for r in simhash_near_dedup(documents(spark, rows), words=5, similarity=0.8, unit_rows=unit_rows).collect()}
    assert found == {k: k - k % 2 for k, _ in rows}
    (nodes, sent), = seen
    assert nodes > 400 and sent < 2 * nodes


@pytest.mark.parametrize("unit_rows", [4, 24])
def test_sets_meet_by_their_rarest_hashes(spark, monkeypatch, unit_rows):
    """Two chains that share half of their words, so that most nodes lie outside the largest part."""
    left = chained(90)
    words = left[0][1].split()[:60]
    rng = random.Random(2)
    rows = left + [(1000 + k, " ".join(words + [rng.choice("xyz") + str(rng.randrange(4)) for _ in range(40)])) for k in range(90)]
    rows += [(2000 + k, t.replace("x1", "y1", 1)) for k, t in rows[90:130]]
    ways = []
    postings = wording._postings
    monkeypatch.setattr(wording, "_postings", lambda *a: ways.append(1) or postings(*a))
    found = simhash_near_dedup(documents(spark, rows), words=5, similarity=0.8, unit_rows=unit_rows).collect()
    assert {r.doc_id: r.component_id for r in found} == groups(rows)
    assert ways


def test_sets_alike_share_one_of_their_rarest_hashes():
    rng = np.random.default_rng(8)
    base = rng.integers(0, 1 << 63, 300, dtype=np.uint64)
    counts = rng.integers(0, 5, CELLS)
    pairs = 0
    for _ in range(400):
        n = int(rng.integers(1, 300))
        a = np.unique(base[:n])
        b = np.setdiff1d(a, rng.choice(a, int(n * rng.uniform(0, 0.25)), replace=False))
        if len(b) and alike(a, b, 0.8):
            pairs += 1
            assert np.intersect1d(rarest(-5, a, counts, 0.8), rarest(-5, b, counts, 0.8)).size
    assert pairs > 200 and len(rarest(3, np.zeros(0, np.uint64), counts, 0.8)) == 0


def test_one_row_of_each_group_is_first(spark):
    text = " ".join(f"w{k}" for k in range(60))
    rows = [(7, text + " a"), (7, text + " b"), (9, text), (None, text + " c"), (None, "other"), (None, "OTHER")]
    found = simhash_near_dedup(documents(spark, rows), words=5, similarity=0.8).collect()
    assert sorted((r.component_id or 0, r.doc_id or 0) for r in found if r.first) == [(0, 0), (7, 7)]


def test_links_of_a_unit_against_all_pairs():
    rng = np.random.default_rng(3)
    base = rng.integers(0, 1 << 63, 400, dtype=np.uint64)
    sets = []
    for _ in range(120):
        own = base[rng.random(400) < rng.choice([0.3, 0.8, 0.9, 0.97])]
        sets.append(np.unique(np.r_[own, rng.integers(0, 1 << 63, rng.integers(0, 40), dtype=np.uint64)]))
    fps = np.array([majority(x.tolist()) for x in sets], np.uint64)
    order = np.argsort(gray_rank(fps))
    sets, fps = [sets[k] for k in order], fps[order]

    def parts(pairs):
        label = list(range(len(sets)))
        for a, b in pairs:
            label = [label[a] if x == label[b] else x for x in label]
        return sorted(sorted(k for k, x in enumerate(label) if x == y) for y in set(label))

    every = [(a, b) for a in range(len(sets)) for b in range(a) if len(set(sets[a].tolist()) & set(sets[b].tolist())) >= 0.8 * len(set(sets[a].tolist()) | set(sets[b].tolist()))]
    found = list(Unit(fps, sets, np.arange(len(sets)), 0.8, 28).links())
    assert parts(found) == parts(every) and len(found) == len(sets) - len(parts(every))
    assert 1 < len(parts(every)) < len(sets)


def test_similarity_is_inclusive():
    a = shingles(b"a b c d e f g h")  # 4 shingles, one more in the other
    assert alike(a, shingles(b"a b c d e f g h i"), 0.8)
    assert not alike(a, shingles(b"a b c d e f g h i j"), 0.8)
