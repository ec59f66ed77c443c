import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash

from tallymark.llm import simhash
from tallymark.llm.gray_index import Forest, GrayIndex, bucket_links, fingerprint, gray_rank
from tallymark.llm.simhash import fingerprint_links, simhash_near_dedup
from tests.llm.common import AWKWARD, documents


def naive_fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[k : k + 3]) for k in range(len(words) - 2)] or [" ".join(words)]
    bits = Counter()
    for s in shingles:
        h = xxhash.xxh64_intdigest(s.encode(), 42)
        bits.update(k for k in range(64) if h >> k & 1)
    return sum(1 << k for k in range(64) if 2 * bits[k] > len(shingles))


def naive_components(values, distance=2):
    forest = Forest(len(values))
    for a in range(len(values)):
        for b in range(a):
            if (values[a] ^ values[b]).bit_count() <= distance:
                forest.join(a, b)
    return [forest.find(k) for k in range(len(values))]


def expected(rows):
    prints = [naive_fingerprint(t) for _, t in rows]
    roots = naive_components(prints)
    least = {}
    for root, (doc_id, _) in zip(roots, rows, strict=True):
        least[root] = min((x for x in (least.get(root), doc_id) if x is not None), default=None)
    return sorted(map(repr, [(d, f"{p:016x}", least[r]) for (d, _), p, r in zip(rows, prints, roots, strict=True)]))


def test_fingerprint():
    for _, text, *_ in AWKWARD:
        assert fingerprint((text or "").encode()) == naive_fingerprint(text)


def test_gray_rank_is_the_inverse_of_the_gray_code():
    values = np.array([0, 1, 2, 3, 12345, 2**64 - 1, 2**63], np.uint64)
    assert (gray_rank(values ^ (values >> np.uint64(1))) == values).all()


def test_awkward_rows_match_brute_force(spark):
    found = simhash_near_dedup(documents(spark, AWKWARD, ("fingerprint", "component_id", "fp", "root")))
    assert sorted(repr(tuple(r)[:3]) for r in found.collect()) == expected([r[:2] for r in AWKWARD])


@pytest.mark.parametrize("bucket_rows", [4, 1024])
def test_near_copies_in_hot_buckets(spark, bucket_rows):
    rng = random.Random(5)
    base = [rng.choice("abcdefghij") * rng.randint(1, 4) for _ in range(400)]
    rows = []
    for k in range(120):
        words = list(base)
        for _ in range(k % 4):
            words[rng.randrange(400)] = f"w{rng.randrange(50)}"
        rows.append((k, " ".join(words)))
    rows += [(1000 + k, " ".join(rng.choice(base) for _ in range(5))) for k in range(60)]
    found = simhash_near_dedup(documents(spark, rows), bucket_rows=bucket_rows)
    assert sorted(repr(tuple(r)[:3]) for r in found.collect()) == expected(rows)


def test_index_finds_all_pairs_within_a_bucket():
    rng = np.random.default_rng(3)
    centre = rng.integers(0, 2**63, 12, dtype=np.uint64)
    values = np.unique(np.concatenate([centre ^ (np.uint64(1) << rng.integers(0, 64, 12).astype(np.uint64)) ^ (np.uint64(1) << rng.integers(0, 64, 12).astype(np.uint64)) for _ in range(20)]))
    values = values[np.argsort(gray_rank(values))]
    a, b = GrayIndex(values, np.zeros(len(values), np.int64)).search(0, len(values), 2)
    want = {(i, j) for i in range(len(values)) for j in range(i + 1, len(values)) if int(values[i] ^ values[j]).bit_count() <= 2}
    assert set(zip(a.tolist(), b.tolist(), strict=True)) == want
    u, v = bucket_links(np.zeros(len(values), np.uint64), np.zeros(len(values), np.uint64), values, 2)
    assert len(u) == len(values) - len(set(naive_components(values.tolist())))


def test_links_of_a_dense_ball(spark):
    values = [0] + [1 << k for k in range(64)] + [(1 << a) | (1 << b) for a in range(0, 64, 3) for b in range(a)]
    nodes = spark.createDataFrame([(simhash._signed(x),) for x in set(values)], "fp long")
    links = fingerprint_links(nodes, bucket_rows=8).collect()
    forest, place = Forest(len(set(values))), {simhash._signed(x): k for k, x in enumerate(set(values))}
    for r in links:
        forest.join(place[r.u], place[r.v])
    assert len({forest.find(k) for k in range(len(place))}) == 1


def test_empty_table(spark):
    assert simhash_near_dedup(documents(spark, [])).collect() == []
