import random
import time
import tracemalloc

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallymark.operators import matches as matching
from tallymark.operators.matches import has_match, matched_words, matches

WORDS = ["a", "aa", "ab", "字符", "\U0001f600", "b\nc", ""]
TEXTS = ["", "aaab", "x字符aa", "\U0001f600\U0001f600 ab", "b\nc", None, "nothing", "aaab"]


def plain(text, words):
    found = [(i + len(w), -len(w), w) for w in set(words) if w for i in range(len(text)) if text.startswith(w, i)]
    return [(w, end + minus, end) for end, minus, w in sorted(found)]


@pytest.fixture(scope="module")
def frame(spark):
    return spark.createDataFrame(list(enumerate(TEXTS)), "id int, text string")


def test_places(frame):
    for row in frame.select("text", matches(F.col("text"), WORDS).alias("m")).collect():
        assert row.m is None if row.text is None else [tuple(x) for x in row.m] == plain(row.text, WORDS)


def test_words_and_any(frame):
    for row in frame.select("text", matched_words(F.col("text"), WORDS).alias("w"), has_match(F.col("text"), WORDS).alias("any")).collect():
        if row.text is None:
            assert row.w is None and row.any is None
        else:
            assert row.w == sorted({w for w, *_ in plain(row.text, WORDS)}) and row.any == bool(row.w)


def test_no_words_and_no_rows(frame):
    none = frame.select(matches(F.col("text"), [""]).alias("m"), matched_words(F.col("text"), []).alias("w"), has_match(F.col("text"), []).alias("any")).collect()
    assert {(str(r.m), str(r.w), r.any) for r in none} == {("[]", "[]", False), ("None", "None", None)}
    assert frame.limit(0).select(matches(F.col("text"), WORDS)).collect() == []


def test_random_words(spark):
    draw = random.Random(3)
    words = ["".join(draw.choices("abc", k=draw.randint(1, 4))) for _ in range(30)]
    texts = ["".join(draw.choices("abcd", k=draw.randint(0, 50))) for _ in range(100)]
    rows = spark.createDataFrame([(x,) for x in texts], "text string").select("text", matches(F.col("text"), words).alias("m")).collect()
    assert all([tuple(x) for x in r.m] == plain(r.text, words) for r in rows)


def test_many_words_leave_the_plan_small(spark):
    words = [f"word{k}" for k in range(50_000)]
    began = time.perf_counter()
    found = spark.range(200).select(matches(F.concat(F.lit("x word"), F.col("id").cast("string")), words).alias("m"))
    assert len(found._jdf.queryExecution().executedPlan().toString()) < 3000
    assert sum(len(r.m) for r in found.collect()) == 10 + 90 * 2 + 100 * 3
    assert time.perf_counter() - began < 30


def test_an_automaton_is_built_once_a_process(monkeypatch):
    monkeypatch.setattr(matching, "_AUTOMATA", {})
    one = matching.automaton_of("k", ["a"])
    assert matching.automaton_of("k", ["a"]) is one
    for k in range(matching.KEPT):
        matching.automaton_of(f"k{k}", ["b"])
    assert "k" not in matching._AUTOMATA and len(matching._AUTOMATA) == matching.KEPT


def test_a_run_of_matches_is_handed_on_when_it_is_full(spark, monkeypatch):
    """Texts whose matches, a dict each, were all held at once; now a run's are numbers, and a run ends between texts."""
    batches, udf = [], F.arrow_udf
    monkeypatch.setattr(F, "arrow_udf", lambda kind: lambda f: batches.append(f) or udf(kind)(f))
    matches(F.col("x"), ["ab", "b"])
    texts = pa.array(["ab" * 40_000, None, "", "b", *["ab" * 30_000] * 20])
    sizes = [(len(x), len(x.flatten())) for x in batches[0](iter([texts]))]
    assert sum(n for n, _ in sizes) == len(texts) and max(m for _, m in sizes) < (1 << 17) + 80_000 and len(sizes) > 5
    tracemalloc.start()
    for _ in batches[0](iter([texts])):
        pass
    assert tracemalloc.get_traced_memory()[1] < 30_000_000
    tracemalloc.stop()
