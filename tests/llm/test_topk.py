import math
import random

import pytest

from tallymark.llm.topk import top_k

SCHEMA = "vec_id long, embedding array<float>, label int, score long, rank int"


def brute(rows, k=10):
    ok = {}
    for vec_id, x in rows:
        if vec_id is not None and x is not None and all(c is not None and math.isfinite(c) for c in x):
            ok[vec_id] = [math.floor(1024 * c) for c in x]
    out = []
    for q, a in ok.items():
        if q % 100 == 0:
            scored = sorted((-sum(x * y for x, y in zip(a, b, strict=False)), v) for v, b in ok.items() if v != q)[:k]
            out += [(q, n, v, -s) for n, (s, v) in enumerate(scored, 1)]
    return sorted(out)


def frame(spark, rows):
    return spark.createDataFrame([(*r, 0, 1, 2) for r in rows], SCHEMA)


def unit(rng, d):
    x = [rng.gauss(0, 1) for _ in range(d)]
    n = math.sqrt(sum(c * c for c in x))
    return [float(int(c / n * 2**14)) / 2**14 for c in x]


def test_matches_brute_force_with_common_vectors(spark):
    rng = random.Random(7)
    same = unit(rng, 24)
    rows = [(k, same if k % 3 == 0 else unit(rng, 24)) for k in range(600)]
    found = top_k(frame(spark, rows), query_block=3, row_block=100)
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in found.collect()) == brute(rows)


def test_awkward_vectors(spark):
    rows = [(0, [1.0, 2.0]), (100, [-1.5, 0.0]), (1, None), (2, [None, 1.0]), (3, [float("nan"), 1.0]), (4, [float("inf"), 1.0]), (5, []), (None, [1.0, 1.0]), (6, [0.25]), (7, [1.0, 2.0]), (8, [1.0, 2.0]), (-100, [0.5, -0.5])]
    found = top_k(frame(spark, rows))
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in found.collect()) == brute(rows)


def test_large_components_stay_exact(spark):
    rows = [(0, [2.0**20, 1.0]), (1, [2.0**20, 3.0]), (2, [2.0**20, 4.0]), (3, [1e30, 0.0])]
    found = {(r.query_id, r["rank"]): (r.vec_id, r.score) for r in top_k(frame(spark, rows)).collect()}
    assert found[0, 1] == (3, 2**63 - 1)
    assert found[0, 2][0] == 2 and found[0, 2][1] - found[0, 3][1] == 1024 * 1024


def test_empty_table(spark):
    assert top_k(frame(spark, [])).collect() == []


def test_parts_that_cancel_and_repeated_rows(spark):
    """Parts of more than a long whose sum is small; two lists of two dimensions."""
    big = 2.0**100
    rows = [(0, [1.0, 0.0, 1.0, 0.0]), (1, [big, 0.0, -big, 0.0]), (2, [0.5, 0.0, 0.0, 0.0]), (2, [0.5, 0.0, 0.0, 0.0]), (3, [-big, 0.0, 0.0, 0.0]), (4, [big, 0.0, 0.0, 0.0])]
    found = {r.vec_id: r.score for r in top_k(frame(spark, rows)).collect()}
    assert found == {1: 0, 2: 512 * 1024, 3: -(2**63), 4: 2**63 - 1}


@pytest.mark.parametrize("lists", [1, 2, 3, 5])
def test_long_vectors_and_any_number_of_lists(spark, lists):
    rng = random.Random(9)
    rows = [(k, [c * (1 + k % 7) for c in unit(rng, rng.choice((40, 64, 70)))]) for k in range(400)]
    found = top_k(frame(spark, rows), lists=lists, query_block=2, row_block=60)
    assert sorted((r.query_id, r["rank"], r.vec_id, r.score) for r in found.collect()) == brute(rows)
