import time

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallymark.operators import programs
from tallymark.operators.programs import RuleProgram, program_user_tags, with_program_slots, with_program_tags
from tallymark.operators.rules import compile_rules
from tests.test_rules import naive_slots, naive_tags, parsed

WORDS = st.sampled_from(["a", "b", "ab", "aa", "字符", "c d"])
APPS = st.sampled_from(["x", "y", "z"])


def _chain(part, marks):
    return st.builds(lambda first, rest: first + "".join(m + p for m, p in rest), part, st.lists(st.tuples(st.sampled_from(marks), part), max_size=4))


ITEM = st.one_of(_chain(WORDS, "+-"), st.builds(lambda x, low, n: f"{{{x}}}[{low}-{low + n}]", _chain(WORDS, "+-,"), st.integers(0, 2), st.integers(0, 3)))
ATOM = st.one_of(
    st.builds(lambda apps, q, items: f"data_word={apps}:{q}:{','.join(items)}", st.sampled_from(["all", "x", "x,y"]), st.sampled_from("012"), st.lists(ITEM, min_size=1, max_size=3)),
    st.builds(lambda kind, x: f"{kind}={x}", st.sampled_from(["apps_days", "apps_freq", "apps_list"]), _chain(APPS, "+-,")),
)
RULE = st.one_of(ATOM, st.builds(lambda x: f"!{x}", ATOM), st.builds(lambda x: f"({x})\r1-3\f", _chain(ATOM, "&|")), _chain(ATOM, "&|"))
LINE = st.builds(lambda app, text, flag: f"{app}:1:{text}{flag}", APPS, st.text("abcd 字符", max_size=12), st.sampled_from(["", ":0", ":1"]))
RECORD = st.builds(lambda app, freq: f"{app}:{freq}:1:0", APPS, st.sampled_from(["", "0", "3", "x"]))


@settings(max_examples=300, deadline=None)
@given(st.lists(RULE, min_size=1, max_size=4), st.lists(LINE, max_size=4), st.lists(RECORD, max_size=3))
def test_program_equals_plain_python(rules, lines, records):
    compiled = compile_rules(rules)
    program = RuleProgram(compiled)
    own = [(r.split(":")[0], int(r.split(":")[1]) if r.split(":")[1].isdigit() else None) for r in records]
    (slots,) = program.slot_rows([[parsed(x) for x in lines]], [own])
    want = naive_slots(compiled, lines, records)
    assert slots[:, 0].tolist() == want
    assert program.tag_rows(slots)[:, 0].tolist() == naive_tags(compiled, want)


def frame(spark, rows, clash=""):
    return spark.createDataFrame(rows, f"userid long, data array<string>, apps array<string>, `Tags, x{clash}` int, place int")


ROWS = [(1, ["x:1:ab", None, "y:1:a:1"], ["x:3::", None], 1, 2), (2, None, None, None, None), (2, [], [], 0, 0), (None, ["z:1:b"], None, 0, 0), (1, ["x:1:ab"], None, 5, 5)]
RULES = ["data_word=all:0:a,b", "!data_word=all:0:a & apps_list=x", "apps_freq=x", "!apps_days=y"]


@pytest.mark.parametrize("cells", [1, 1 << 22])
def test_frames(spark, monkeypatch, cells):
    monkeypatch.setattr(programs, "CELLS", cells)
    compiled = compile_rules(RULES)
    found = with_program_tags(frame(spark, ROWS), RULES, "data", "apps").collect()
    assert len(found) == len(ROWS)
    for row in found:
        want = naive_tags(compiled, naive_slots(compiled, row.data, row.apps))
        assert [tuple(x) for x in row.tags] == [(k, x) for k, x in enumerate(want) if x]
        assert row.asDict().keys() >= {"userid", "Tags, x", "place"}


def test_two_phases(spark):
    compiled = compile_rules(RULES)
    found = program_user_tags(with_program_slots(frame(spark, ROWS).drop("Tags, x"), RULES, "data", "apps"), RULES).collect()
    for row in found:
        own = [naive_slots(compiled, d, a) for u, d, a, *_ in ROWS if u == row.userid]
        summed = np.sum(own, 0).tolist()
        assert [tuple(x) for x in row.slots] == [(k, x) for k, x in enumerate(summed) if x]
        assert [tuple(x) for x in row.tags] == [(k, x) for k, x in enumerate(naive_tags(compiled, summed)) if x]
    assert {r.userid for r in found} == {1, None}


def test_no_rows(spark):
    assert with_program_tags(frame(spark, []), RULES).collect() == []
    assert program_user_tags(with_program_slots(frame(spark, []), RULES), RULES).collect() == []


def test_sizes_of_real_rule_sets(spark):
    """A rule of 100,000 apps, 100,000 app atoms in one rule, and 10,000 rules: seconds, and one step in the plan."""
    apps = ",".join(f"app{k}" for k in range(100_000))
    rules = [f"data_word={apps}:1:字 符", f"apps_freq={apps}", *[f"data_word=all:0:w{k}+v{k},{{u{k}}}[1-2]" for k in range(10_000)]]
    began = time.perf_counter()
    lines = [f"app{k}:123:k0w7v7{'两个字 符' * 3}:1" for k in range(10_000)]
    rows = spark.createDataFrame([(1, lines, ["app5:4::"]), (2, ["nobody:1:字 符:1"], None)], "userid long, data array<string>, apps array<string>")
    found = with_program_tags(rows, rules, "data", "apps")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert len(plan) < 5000
    got = {r.userid: [tuple(x) for x in r.tags] for r in found.select("userid", "tags").collect()}
    assert got == {1: [(0, 30_000), (1, 10_004), (9, 10_000)], 2: []}
    assert time.perf_counter() - began < 60


def test_long_chains_need_no_recursion():
    program = RuleProgram(compile_rules(["data_word=all:0:" + ",".join(f"w{k}" for k in range(5000)), "&".join(["data_word=all:0:a"] * 300)]))
    (slots,) = program.slot_rows([[("x", "w1w22 a", False)]], [[]])
    assert program.tag_rows(slots)[:, 0].tolist() == [3, 1]


def test_plan_keeps_columns(spark):
    found = with_program_tags(frame(spark, ROWS), RULES, "data", None, out="found")
    assert found.columns == ["userid", "data", "apps", "Tags, x", "place", "found"]
    assert found.select(F.size("found")).count() == len(ROWS)


def test_layers_are_evaluated_in_bounded_parts():
    """One layer of thousands of nodes was gathered at once, beyond any cache."""
    words = [a + b for a in "bcdfghjk" for b in "aeiou"]
    program = programs.RuleProgram(compile_rules([f"data_word=all:0:{a}+{b}" for a in words for b in words]))
    assert max(len(outs) for _, outs, *_ in program.row.layers) <= 256 and sum(len(outs) for _, outs, *_ in program.row.layers) >= 700
