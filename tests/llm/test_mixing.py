import random
import re
from bisect import bisect_right
from fractions import Fraction

from pyspark.sql import functions as F

from tallymark.llm.mixing import GOLDEN, golden_point, mix_sources, mixed_documents, plan_mix, with_targets
from tests.llm.common import AWKWARD, documents


def targets(sizes, weights=(5, 2, 1), share=1.0, repeats=3):
    """A plain model: sources above their stop are stopped and the rest is shared again, until none is above."""
    order = sorted(sizes, key=lambda s: (s is None, s.encode("utf-32-be") if s is not None else b""))
    weight = {s: weights[k % len(weights)] for k, s in enumerate(order)}
    left, open_, out = Fraction(share) * sum(sizes.values()), set(order), {}
    while open_:
        whole = sum(weight[s] for s in open_)
        above = [s for s in open_ if left * weight[s] > repeats * sizes[s] * whole]
        if not above:
            return {s: float(out.get(s, left * weight[s] / whole)) for s in order}
        for s in above:
            out[s] = Fraction(repeats * sizes[s])
        open_ -= set(above)
        left -= sum(out[s] for s in above)
    return {s: float(out[s]) for s in order}


def model(mix, block_words=256, least_blocks=256):
    """What a mix takes of each document, in plain Python from its sizes and hashes."""
    rows = [r for r in mix.sized.collect() if r["size"]]
    sizes = {}
    for r in mix.sized.collect():
        sizes[r.source] = sizes.get(r.source, 0) + r["size"]
    goal = targets(sizes)
    order = [s for s in goal if sizes[s]]
    blocks = {s: max(1, min(sizes[s], max(-(-sizes[s] // block_words), least_blocks))) for s in order}
    fine = [int(goal[s] * blocks[s] / sizes[s] * (1 << 20)) for s in order]
    total = sum(fine)
    edges = [sum(fine[:k]) * (1 << 62) // total for k in range(len(fine))]
    times, ranks = {}, dict.fromkeys(order, 0)
    for slot in range(round(total / (1 << 20))):
        s = order[bisect_right(edges, slot * GOLDEN % (1 << 64) // 4) - 1]
        if ranks[s] < 3 * blocks[s]:
            key = (s, ranks[s] % blocks[s])
            times[key] = times.get(key, 0) + 1
        ranks[s] += 1
    out = []
    for s in order:
        at = 0
        for r in sorted((r for r in rows if r.source == s), key=lambda r: ((r.spread >> 20) % mix.n_ranges, r.spread, r.doc_id is not None, r.doc_id or 0, r.text_hash)):
            words = [((w + 1) * blocks[s] - 1) // sizes[s] for w in range(at, at + r["size"])]
            out.append((r.doc_id or 0, r["size"], sizes[s], sum(times.get((s, b), 0) for b in words)))
            at += r["size"]
    return sorted(out + [(r.doc_id or 0, 0, sizes[r.source], 0) for r in mix.sized.collect() if not r["size"]])


def corpus():
    rows = [(k, " ".join(["w"] * (1 + k * 37 % 400)), "en", f"s{k % 3}") for k in range(400)]
    return rows + [(1000 + k, "a b\nc " * 5, "en", "tiny") for k in range(8)] + [(2000, "", "en", "s0"), (2001, None, "en", None)]


def found_targets(spark, sizes, **options):
    frame = spark.createDataFrame(list(sizes.items()), "source string, source_size long")
    return {r.source: r.target for r in with_targets(frame, **options).collect()}


def test_targets_stop_at_the_cap(spark):
    made = found_targets(spark, {"a": 10, "b": 1000, "c": 1000, None: 0})
    assert made["a"] == 30 and made[None] == 0
    assert abs(sum(made.values()) - 2010) < 1e-6
    assert abs(made["b"] / made["c"] - 2) < 1e-9
    assert found_targets(spark, {}) == {} and found_targets(spark, {"a": 0}) == {"a": 0.0}
    assert found_targets(spark, {"z": 80, "é": 80, None: 80}) == {"z": 150.0, "é": 60.0, None: 30.0}
    rng = random.Random(3)
    for share in (0.3, 1.0, 2.9, 4.0):
        sizes = {None if k == 7 else f"s{k}": rng.choice([0, 1, 5, 100, 4000, 90000]) for k in range(40)}
        want, got = targets(sizes, share=share), found_targets(spark, sizes, share=share)
        assert set(got) == set(want) and all(abs(got[s] - want[s]) <= 1 + 1e-9 * want[s] for s in want)


def test_taken_words_are_those_of_a_plain_model(spark):
    docs = documents(spark, corpus() + [(None, "a b c", "en", "s1"), (5, "x " * 90, "en", "s1"), (5, "x " * 90, "en", "s1")])
    mix = plan_mix(docs)
    found = mix.taken().collect()
    assert sorted((r.doc_id or 0, r["size"], r.source_size, r.taken) for r in found) == model(mix)


def test_many_sources_and_a_tiny_share(spark):
    """More sources than documents of any other test, and one whose share is below 2**-32."""
    rows = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("a b c d").alias("text"), F.concat(F.lit("s"), "id").alias("source"))
    found = {r.doc_id: r for r in mix_sources(rows).collect()}
    assert len(found) == 3000
    assert abs(sum(r.taken for r in found.values()) - 12000) < 200
    want = targets({f"s{k}": 4 for k in range(3000)})
    assert all(abs(r.target - want[f"s{k}"]) < 1e-9 for k, r in found.items())
    sizes = {"a": 10**15, "b": 10**15, "c": 1}
    made = found_targets(spark, sizes)
    assert made["c"] == 3.0


def test_a_source_of_a_tiny_share_gets_its_slots(spark):
    """Points at 62 bits: 200,000 slots from far on fall into a share of 2**-16 as often as they should."""
    far = 1 << 45
    points = spark.range(far, far + 200_000).select(golden_point("id").alias("p")).where(f"p < {1 << 46}").count()
    assert abs(points - 200_000 / 65536) <= 2
    got = [r.p for r in spark.createDataFrame([(k,) for k in (0, 1, 2**31, 2**40 + 5, 2**62)], "id long").select(golden_point("id").alias("p")).collect()]
    assert got == [k * GOLDEN % (1 << 64) // 4 for k in (0, 1, 2**31, 2**40 + 5, 2**62)]


def test_taken_words_come_near_the_targets(spark):
    rows = corpus()
    found = mix_sources(documents(spark, rows, ("size", "taken", "target", "block", "part")).repartition(5)).collect()
    again = mix_sources(documents(spark, rows[::-1])).collect()
    assert sorted(map(tuple, found)) == sorted(map(tuple, again))
    source = {r[0]: r[3] for r in rows}
    size = {r[0]: len(re.findall(r"[^\x20\x09-\x0D]+", r[1] or "")) for r in rows}
    taken, goal = {}, {}
    for r in found:
        assert r["size"] == size[r.doc_id] and 0 <= r.taken <= 3 * r["size"]
        taken[source[r.doc_id]] = taken.get(source[r.doc_id], 0) + r.taken
        goal[source[r.doc_id]] = r.target
    assert len(found) == len(rows)
    for s, words in taken.items():
        assert abs(words - goal[s]) <= max(0.02 * goal[s], 3)


def test_schedule_interleaves_and_ranks_without_gaps(spark):
    mix = plan_mix(documents(spark, corpus()))
    by = {}
    for r in mix.schedule().orderBy("slot").collect():
        by.setdefault(r.source, []).append(r["rank"])
    assert all(ranks == list(range(len(ranks))) for ranks in by.values())
    points = sorted(r.p / 2**62 for r in spark.range(1000).select(golden_point("id").alias("p")).collect())
    assert max(b - a for a, b in zip(points, points[1:], strict=False)) < 0.003


def test_mixed_documents_hold_the_taken_words(spark):
    docs = documents(spark, corpus(), ("mix_words",))
    taken = {r.doc_id: r.taken for r in mix_sources(docs).collect()}
    got, texts = {}, {r[0]: r[1] for r in corpus()}
    mixed = mixed_documents(docs)
    assert mixed.columns == docs.columns
    for r in mixed.collect():
        assert texts[r.doc_id].startswith(r.text)
        got[r.doc_id] = got.get(r.doc_id, 0) + len(re.findall(r"[^\x20\x09-\x0D]+", r.text))
    assert got == {k: v for k, v in taken.items() if v}


def test_awkward_rows_and_empty_tables(spark):
    found = mix_sources(documents(spark, AWKWARD)).collect()
    assert len(found) == len(AWKWARD) and all(0 <= r.taken <= 3 * r["size"] for r in found)
    assert mix_sources(documents(spark, [])).collect() == []
    assert [r.taken for r in mix_sources(documents(spark, [(1, None, "en", "a")])).collect()] == [0]
    assert mixed_documents(documents(spark, [])).collect() == []


def test_exact_repeats_share_what_they_take(spark):
    rows = [(1, "a b c d e f g h", "en", "big")] * 6 + [(k, f"w{k} " * 40, "en", "other") for k in range(2, 30)]
    docs = documents(spark, rows)
    taken = sum(r.taken for r in mix_sources(docs).collect())
    assert sum(len(r.text.split()) for r in mixed_documents(docs).collect()) == taken


def test_documents_without_identifiers_are_spread_over_ranges(spark):
    mix = plan_mix(documents(spark, [(None, f"w {k}", "en", "a") for k in range(2000)]), range_docs=100)
    parts = {r[0]: r[1] for r in mix.sized.groupBy(F.pmod(F.shiftright("spread", 20), F.lit(mix.n_ranges))).count().collect()}
    assert len(parts) == mix.n_ranges and max(parts.values()) < 200
    assert sum(r.taken for r in mix_sources(documents(spark, [(None, f"w {k}", "en", "a") for k in range(2000)])).collect()) == 4000
