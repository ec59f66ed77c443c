import numpy as np
import pytest
from pyspark.sql import functions as F

from tallymark.operators.towers import ITEM, USER, _cut, _step, _unit, counted, shuffled_pairs, train_towers

CLUSTERS = [(u, i) for u in range(24) for i in range(24) if u % 3 == i % 3 and (u + i) % 4]


def frame(spark, pairs):
    return spark.createDataFrame([(u, f"i{i}", 1) for u, i in pairs], "user long, item string, KEY int")


def test_pairs_come_nearer_than_shuffled_ones(spark):
    towers = train_towers(frame(spark, CLUSTERS), steps=6, dims=8)
    own = counted(frame(spark, CLUSTERS))
    mean = lambda pairs: towers.similarity(pairs).agg(F.avg("similarity")).first()[0]
    others = shuffled_pairs(own, 2, seed=99)
    assert mean(own) > mean(others) + 0.4
    assert towers.losses[-1] < 0.5 * towers.losses[0]
    # What was left out of a cluster is nearer than what lies in another.
    unseen = frame(spark, [(u, i) for u in range(24) for i in range(24) if u % 3 == i % 3 and not (u + i) % 4])
    apart = frame(spark, [(u, i) for u in range(24) for i in range(24) if u % 3 != i % 3])
    assert mean(unseen) > mean(apart) + 0.2
    assert towers.similarity(frame(spark, [(0, 999)])).count() == 0


@pytest.mark.parametrize("broadcast", [True, False])
def test_a_step_against_numpy(spark, broadcast):
    draw = np.random.default_rng(4)
    unit = lambda x: x / np.linalg.norm(x)
    vec = {(s, k): unit(draw.normal(size=3)) for s, names in ((USER, "ab"), (ITEM, "xyz")) for k in names}
    speed = {k: draw.normal(size=3) for k in vec}
    rows = [("a", "x", 1.0, 2.0), ("a", "y", 0.0, 1.0), ("b", "x", 1.0, 3.0), ("b", "y", 1.0, 1.0)]
    want = {}
    for (side, key), own in vec.items():
        total, weight = np.zeros(3), 0.0
        for u, i, y, w in rows:
            if key == (u, i)[side]:
                other = vec[1 - side, (i, u)[side]]
                c = own @ other
                total, weight = total + (y - c) * w * (other - c * own), weight + w
        s = 0.5 * speed[side, key] + total / weight if weight else speed[side, key]
        want[side, key] = unit(own + 2.0 * s)
    table = spark.createDataFrame([(*k, v.tolist(), speed[k].tolist(), 0.0, 0.0) for k, v in vec.items()], "side int, key string, vec array<double>, speed array<double>, loss double, weight double")
    found = _step(table, spark.createDataFrame(rows, "user string, item string, y double, w double"), 3, 2.0, 0.5, broadcast, 4).collect()
    assert {(r.side, r.key) for r in found} == set(want)
    assert all(r.vec == pytest.approx(want[r.side, r.key].tolist()) for r in found)


def test_ways_to_join_agree_and_awkward_pairs(spark):
    pairs = frame(spark, [*CLUSTERS[:40], *CLUSTERS[:5], (None, 3), (7, 7)])
    near = {(r.side, r.key): r.vec for r in train_towers(pairs, steps=2, dims=4).table.collect()}
    far = {(r.side, r.key): r.vec for r in train_towers(pairs, steps=2, dims=4, small=0, salts=3).table.collect()}
    assert near.keys() == far.keys() and all(far[k] == pytest.approx(near[k]) for k in near)
    assert {r.n for r in counted(pairs).collect()} == {1, 2}
    empty = train_towers(pairs.limit(0))
    assert empty.losses == [] and empty.table.count() == 0 and empty.similarity(pairs).count() == 0
    one = train_towers(frame(spark, [(1, 1)]), steps=2)
    assert one.table.count() == 2 and len(one.losses) == 2


def test_shuffled_pairs_are_others_of_the_same_users(spark):
    own = counted(frame(spark, CLUSTERS))
    found = {(r.user, r.item) for r in shuffled_pairs(own, 3).collect()}
    pairs = {(r.user, r.item) for r in own.collect()}
    assert found and not found & pairs
    assert {u for u, _ in found} <= {u for u, _ in pairs} and {i for _, i in found} <= {i for _, i in pairs}


def test_a_step_handles_keys_of_chunks_not_pairs(spark):
    # A user and an item of 600 pairs each, and 600 users of two.
    pairs = [("hub", f"i{k}") for k in range(600)] + [(f"u{k}", "top") for k in range(600)] + [(f"u{k}", f"i{k % 5}") for k in range(600)]
    rows = spark.createDataFrame([(u, i, float(k % 2), 1.0 + k % 3) for k, (u, i) in enumerate(pairs)], "user string, item string, y double, w double")
    chunks = _cut(rows, 100).collect()
    found = [(c.users[u], c.items[i], y, w) for c in chunks for u, i, y, w in zip(c.of_user, c.of_item, c.y, c.w, strict=True)]
    assert sorted(found) == sorted(map(tuple, rows.collect()))
    assert max(len(c.y) for c in chunks) == 100 and len({c.chunk for c in chunks}) == len(chunks) >= 18
    assert all(len(set(keys)) == len(keys) for c in chunks for keys in (c.users, c.items))
    assert sum(len(c.users) for c in chunks) <= 601 + len(chunks)
    assert sum("hub" in c.users for c in chunks) >= 6 and sum("top" in c.items for c in chunks) >= 12
    assert [c.y for c in _cut(rows.limit(0), 100).collect()] == []


def test_chunks_of_any_size_give_the_same_towers(spark):
    near = train_towers(frame(spark, CLUSTERS), steps=2, dims=4)
    want = {(r.side, r.key): r.vec for r in near.table.collect()}
    for unit in (1, 7):
        towers = train_towers(frame(spark, CLUSTERS), steps=2, dims=4, small=0, unit=unit)
        assert {(r.side, r.key): pytest.approx(r.vec) for r in towers.table.collect()} == want
        assert towers.losses == pytest.approx(near.losses)


def test_each_side_is_broadcast_by_its_own_size_and_lengths_are_taken_once(spark):
    pairs = [(u, u % 3) for u in range(50)]
    towers = train_towers(frame(spark, pairs), steps=1, dims=4, small=10)
    assert towers.keys == {USER: 50, ITEM: 3} and towers.pairs.count() == 50
    scored = towers.similarity(towers.pairs)
    plan = scored._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("strategy=broadcast") == 1 and scored.count() == 50
    vectors = spark.createDataFrame([([3.0, 4.0],), ([0.0, 0.0],)], "vec array<double>").select(_unit(F.col("vec")).alias("unit"))
    assert vectors._jdf.queryExecution().optimizedPlan().toString().count("aggregate(") == 1
    assert [r.unit for r in vectors.collect()] == [[0.6, 0.8], [0.0, 0.0]]
