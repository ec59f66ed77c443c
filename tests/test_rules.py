import re

import pyarrow as pa
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallymark.operators.rules import RuleSyntaxError, compile_rules, evaluate, slot_values, tag_values
from tallymark.operators.tagging import LabelExtractor, TagExtractor, UserTagger, row_tag_map, row_tags, sub_scores, tag_map, user_tags, with_label, with_tags


def parsed(line):
    part = line.split(":", 2)
    if len(part) < 3:
        return part[0], "", False
    corpus, query = part[2], False
    if re.search(r"(?s):[01]$", line) and re.match(r"(?s)^[^:]*:[^:]*:.*:[01]$", line):
        query, corpus = line.endswith(":1"), corpus[:-2]
    return part[0], corpus, query


def naive_slots(rules, data, apps=None):
    """Slots of one row by plain Python."""
    lines = [parsed(x) for x in data or [] if x is not None]
    records = [x.split(":") for x in apps or [] if x is not None]

    def count(c):
        if c.kind == "data_word":
            if c.query not in ("0", "1"):
                return 0
            return sum(len(re.findall(f"(?={re.escape(c.word)})", corpus)) for app, corpus, q in lines if (c.apps is None or app in c.apps) and (q or c.query == "0"))
        hits = sum(app == c.word for app, *_ in lines)
        mine = [r for r in records if r[0] == c.word]
        freq = [int(r[1]) if len(r) > 1 and r[1].isdigit() else 0 for r in mine]
        if c.kind == "apps_freq":
            return hits + sum(freq)
        if c.kind == "apps_days":
            return min(hits, 1) + sum(f > 0 for f in freq)
        return int(bool(hits or mine))

    return [evaluate(s.expr, count) for s in rules.slots]


def naive_tags(rules, slots):
    return [evaluate(t, lambda s: slots[s.number]) for t in rules.tags]


def rows(spark, *data):
    return spark.createDataFrame([(k, d, None, "20240101") for k, d in enumerate(data)], "userid long, data array<string>, apps array<string>, date string")


GOLDEN_1 = "data_word=app1,app2:0:k1,k2+k3,{k4,k5}[2-3]"


@pytest.mark.parametrize(
    ("rule", "data", "slots", "tag"),
    [
        (GOLDEN_1, ["app1:0:k1k1k2:1", "app2:0:k3k4k5:0"], [2, 1, 2], 5),
        ("apps_list=a | apps_list=b & apps_list=c", ["a:0:x"], [1, 0, 0], 0),
        ("data_word=all:0:aa", ["x:0:aaaa"], [3], 3),
        ("data_word=all:1:k1", ["x:0:k1:1", "x:0:k1", "x:0:k1:0"], [1], 1),
        ("!data_word=all:0:zz", ["x:0:a"], [0], 1),
        ("apps_days=a", ["a:0:", "a:0:", "b:0:"], [1], 1),
        ("apps_freq=a", ["a:0:", "a:0:", "b:0:"], [2], 2),
        ("data_word=all:0:a-b,c", ["x:0:aac"], [2, 1], 3),
        ("data_word=all:0:a-b,c", ["x:0:aacb"], [0, 1], 1),
        ("data_word=:0:w", ["any:0:w"], [1], 1),  # empty apps are all
        ("data_word=all:0:{a}[3],b-c", ["x:0:aabb"], [2, 2], 2),  # a range ends at its bracket
        ("data_word=all:0:{a}[-4]", ["x:0:aaaaa"], [5], 0),
        ("data_word=all:0:a[1]", ["x:0:aa[1]"], [1], 1),  # brackets without braces are text
        ("data_word=all:0:{a,b}[2-3],c", ["x:0:ac"], [1, 1], 1),  # a leading group keeps its own range
        ("data_word=all:0:k1+k2", ["x:0:k1k2"], [1], 1),  # a lone combination has a slot
        (r"data_word=all:0:a\+\-b", ["x:0:a+-b"], [1], 1),  # both characters are escaped
        ("(data_word=all:0:a )  ", ["x:0:a"], [1], 1),  # blanks are ignored
        ("data_word=all:0:a=b", ["x:0:a=b"], [1], 1),  # cut at the first equals sign
        ("data_word=all:0:k", ["x:0:k:0"], [1], 1),
        ("data_word=all:0::0", ["x:0:k:0"], [0], 0),  # a trailing flag is no text
        ("(data_word=all:0:a|data_word=all:0:b)\r2-3\f", ["x:0:aab"], [2, 1], 3),
        ("data_word=all:2:a", ["x:0:a:1"], [0], 0),
    ],
)
def test_goldens(spark, rule, data, slots, tag):
    compiled = compile_rules([rule])
    assert naive_slots(compiled, data) == slots and naive_tags(compiled, slots) == [tag]
    for matcher in ("native", "arrow"):
        found = rows(spark, data).select(slot_values(compiled, F.col("data"), matcher=matcher).alias("s")).select("s", tag_values(compiled, F.col("s")).alias("t")).first()
        assert (found.s, found.t) == (slots, [tag])


@pytest.mark.parametrize("rule", ["digit=3", "data_word=all:0:", "(data_word=all:0:a", "data_word=all:0:{a", "data_word=all:0:a}", "data_word=all:0:a)", "data_word=all", "apps_list=a &", "data_word=all:0:{a}[x]", ""])
def test_bad_rules(rule):
    with pytest.raises(RuleSyntaxError):
        compile_rules([rule])


WORDS = st.sampled_from(["a", "aa", "ab", "b", "é", "c."])
ATOMS = st.one_of(
    st.builds(lambda app, q, w: f"data_word={app}:{q}:{w}", st.sampled_from(["all", "x", "x,y", ""]), st.sampled_from("01"), st.one_of(WORDS, st.builds("{}+{}".format, WORDS, WORDS), st.builds("{}-{},{}".format, WORDS, WORDS, WORDS), st.builds("{{{},{}}}[{}-3]".format, WORDS, WORDS, st.integers(0, 2)))),
    st.builds(lambda k, a: f"apps_{k}={a}", st.sampled_from(["days", "freq", "list"]), st.sampled_from(["x", "y", "x+y", "x-y"])),
)
RULES = st.recursive(ATOMS, lambda r: st.one_of(st.builds("({}|{})".format, r, r), st.builds("({}&{})".format, r, r), st.builds("!({})".format, r), st.builds("({})\r1-3\f".format, r)), max_leaves=3)
LINES = st.lists(st.builds("{}:1:{}{}".format, st.sampled_from(["x", "y", "z"]), st.text("abéc.:1", max_size=8), st.sampled_from(["", ":0", ":1"])), max_size=4)


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(RULES, min_size=1, max_size=3), st.lists(st.one_of(st.none(), LINES), min_size=1, max_size=5))
def test_both_matchers_equal_plain_python(spark, rules, data):
    compiled = compile_rules(rules)
    want = {k: naive_slots(compiled, d) for k, d in enumerate(data)}
    for matcher in ("native", "arrow"):
        found = rows(spark, *data).select("userid", slot_values(compiled, F.col("data"), F.col("apps"), matcher).alias("s")).select("userid", "s", tag_values(compiled, F.col("s")).alias("t")).collect()
        assert {r.userid: r.s for r in found} == want
        assert {r.userid: r.t for r in found} == {k: naive_tags(compiled, s) for k, s in want.items()}


def test_app_records(spark):
    frame = spark.createDataFrame([(1, None, ["a:2:1.5:0", "a:3:1:1", "b:0:1:0", None, "bad", "c:x:1:0"], "d")], "userid long, data array<string>, apps array<string>, date string")
    found = row_tags(frame, ["apps_days=a", "apps_freq=a", "apps_list=b", "apps_days=b", "apps_freq=c", "apps_list=bad"]).first()
    assert found.tags == [2, 5, 1, 0, 0, 1]


def test_combinations_are_per_row_and_ranges_after_the_sum(spark):
    two = spark.createDataFrame([("u", ["app1:0:k1k1k2:1"], "1"), ("u", ["app2:0:k3k4k5:0"], "2")], "userid string, data array<string>, date string")
    found = user_tags(sub_scores(two, [GOLDEN_1]), [GOLDEN_1]).first()
    assert (found.sub_scores, found.tags) == ([2, 0, 2], [4])
    days = spark.createDataFrame([("u", ["x:0:k1k1"], "1"), ("u", ["x:0:k1"], "2")], two.schema)
    rule = ["data_word=all:0:{k1}[3]"]
    assert row_tags(days, rule).count() == 0
    assert user_tags(sub_scores(days, rule), rule).first().tags == [3]
    assert user_tags(sub_scores(days, rule, as_vector=True), rule).first().tags == [3]
    assert user_tags(sub_scores(days, ["!data_word=all:0:zz"]), ["!data_word=all:0:zz"]).count() == 0
    apps = spark.createDataFrame([("u", ["a:0:"], "1"), ("u", ["b:0:"], "2")], two.schema)
    assert user_tags(sub_scores(apps, ["apps_list=a+b"]), ["apps_list=a+b"]).first().tags == [1]


def test_labels_need_a_strict_winner(spark):
    rules = ["data_word=all:0:a", "data_word=all:0:b"]
    found = with_label(rows(spark, ["x:0:abab"], ["x:0:"], ["x:0:abbb"], None), rules)
    assert [(r.userid, r.tags, r.label) for r in found.collect()] == [(2, [1, 3], 1.0)]
    with pytest.raises(ValueError):
        with_label(rows(spark, []), rules[:1])


def test_maps_and_transformers(spark, tmp_path):
    rules, names = ["data_word=all:0:a", "data_word=all:0:b"], ["t_a", "t_b"]
    frame = rows(spark, ["x:0:aab"], ["x:0:b"], ["x:0:z"])
    assert {r.userid: r.tags for r in row_tag_map(frame, rules, names).collect()} == {0: {"t_a": 2, "t_b": 1}, 1: {"t_b": 1}}
    tagger = UserTagger(tagRules=rules)
    tagger.save(f"{tmp_path}/tagger")
    again = UserTagger.load(f"{tmp_path}/tagger")
    assert again.transform(frame).columns == ["userid", "tags", "date"]
    tagged = again.tag_users(again.sub_scores(frame))
    assert {r.userid: r.tags for r in again.tags_to_map(tagged, names).collect()} == {0: {"t_a": 2, "t_b": 1}, 1: {"t_b": 1}}
    assert {r.userid: r.tags for r in again.tag_directly(frame, names).collect()} == {r.userid: r.tags for r in tag_map(tagged, names).collect()}
    assert [r.scores for r in TagExtractor(tagRules=rules).transform(frame).orderBy("userid").collect()] == [[2, 1], [0, 1], [0, 0]]
    assert [r.label for r in LabelExtractor(tagRules=rules).transform(frame).orderBy("userid").collect()] == [0.0, 1.0]
    assert with_tags(frame.limit(0), rules).collect() == []


def test_wide_rules_sum_by_exploding(spark):
    rules = [f"apps_list={','.join(f'a{k}' for k in range(300))}"]
    frame = rows(spark, ["a7:0:", "a299:0:"], ["a7:0:"], None).withColumn("userid", F.lit("u"))
    found = user_tags(sub_scores(frame, rules), rules).first()
    assert found.tags == [3] and found.sub_scores[7] == 2 and found.sub_scores[299] == 1


def test_counts_are_handed_on_in_bounded_runs(spark, monkeypatch):
    """Lines of a whole batch were Python objects at once."""
    from tallymark.operators import rules

    made, udf = [], rules.F.arrow_udf
    monkeypatch.setattr(rules.F, "arrow_udf", lambda kind: lambda f: made.append(f) or udf(kind)(f))
    monkeypatch.setattr(rules, "RUN_COUNTS", 6)
    rules._matcher([c for c in rules.compile_rules(["data_word=all:0:ab,b,c"]).counters() if c.kind == "data_word"])
    rows = [None, [], *[[{"app": "x", "corpus": "abcab", "is_query": False}]] * 5]
    kind = pa.list_(pa.struct([("app", pa.string()), ("corpus", pa.string()), ("is_query", pa.bool_())]))
    found = [x.to_pylist() for x in made[0](iter([pa.array(rows, kind)]))]
    assert len(found) == 4 and sum(found, []) == [[0, 0, 0]] * 2 + [[2, 2, 1]] * 5
