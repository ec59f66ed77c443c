import re
from collections import Counter
from itertools import permutations

import duckdb
import pytest

from tallymark.llm.filter_audit import filter_audit, settled_masks, text_mask
from tallymark.llm.queries import oracle_sql
from tests.llm.common import AWKWARD, documents

LABELS = "doc_id long, quality int, toxic int"
SOME_LABELS = [(4, 1, 0), (5, 1, 1), (5, 0, None), (7, None, 1), (8, 1, 0), (None, 1, 1), (99, 1, 1)]


def plain(rows, labels):
    """Every order applied to every row."""
    good, toxic = ({i for i, *x in labels if i is not None and x[k] == 1} for k in (0, 1))
    table = [(i, t or "", s or "") for i, t, _, s in (*[(*r, *[None] * (4 - len(r))) for r in rows],)]
    fails = []
    for doc_id, text, _ in table:
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        fails.append({
            "A": len(words) < 50,
            "B": 100 * len(set(words)) < 65 * len(words),
            "C": 100 * len(re.findall("[A-Z]", text)) > 5 * len(text),
            "D": bool(re.search("[#$%&*|]", text)),
            "E": any(t == text and i is not None and (doc_id is None or i < doc_id) for i, t, _ in table),
        })
    out = {}
    for part in {s for _, _, s in table}:
        own = [(r[0], f) for r, f in zip(table, fails, strict=True) if r[2] == part]
        removed_by = Counter()
        for order in permutations("ABCDE"):
            left = own
            for step, letter in enumerate(order, 1):
                gone, kept = [i for i, f in left if f[letter]], [x for x in left if not x[1][letter]]
                redundant = sum(f[letter] and any(f[x] for x in order[: step - 1]) for _, f in own)
                unique = sum(f[letter] and sum(f.values()) == 1 for _, f in own)
                out[part, "".join(order), step] = [len(kept), len(gone), redundant, unique, sum(i in good for i in gone), sum(i in toxic for i in gone)]
                removed_by[letter] += len(gone)
                left = kept
        for (p, order, step), row in out.items():
            if p == part:
                row.append(removed_by[order[step - 1]])
    return out


WORDS = " ".join(f"word{k}" for k in range(60))
ROWS = [
    *AWKWARD, (None, WORDS, None, "a"), (30, WORDS, None, "a"), (31, WORDS, None, None), (31, WORDS, None, "a"), (29, WORDS + " ", None, "b"), (32, WORDS.upper(), None, "b"), (33, WORDS + " #1", None, "b"),
    (34, "a " * 60, None, ""), (30, WORDS, None, "b"), (None, "no identifier", None, None), (35, "\x1c".join("abc"), None, "a"), (36, " ".join("abc"), None, "a"),
]


def found(frame):
    return {tuple(r[:3]): list(r[3:]) for r in frame.collect()}


@pytest.mark.parametrize("partitions", [1, 7])
def test_equals_every_order_applied(spark, partitions):
    docs = documents(spark, ROWS, clash=("PART", "mask", "good")).repartition(partitions)
    assert found(filter_audit(docs, spark.createDataFrame(SOME_LABELS, LABELS))) == plain(ROWS, SOME_LABELS)


def test_sql_equals_every_order_applied(spark):
    con = duckdb.connect()
    con.execute("create table documents (doc_id bigint, text varchar, lang varchar, source varchar); create table labels (doc_id bigint, quality int, toxic int)")
    con.executemany("insert into documents values (?, ?, ?, ?)", [list(r) for r in ROWS])
    con.executemany("insert into labels values (?, ?, ?)", [list(r) for r in SOME_LABELS])
    rows = con.execute(oracle_sql()["op13_filter_audit"]).fetchall()
    assert {tuple(r[:3]): list(r[3:]) for r in rows} == plain(ROWS, SOME_LABELS)


def test_a_text_of_a_third_of_all_rows(spark):
    """One text in many tasks and flushes: salted owners, then one, find a single smallest identifier."""
    rows = [(k, WORDS if k % 3 else f"{WORDS} {k}", None, f"s{k % 4}") for k in range(900, 0, -1)]
    masks = settled_masks(documents(spark, rows).repartition(30), "doc_id", "text", "source", flush_bytes=1000)
    kept = {r.doc_id for r in masks.collect() if not r.mask & 16}
    assert kept == {1, *range(3, 901, 3)}
    assert sum(r.n for r in masks.collect()) == 900


def test_words_are_cut_at_ascii_space_only():
    assert text_mask("\x1c ".join(f"w{k}" for k in range(50))) & 1 == 0
    assert text_mask("\x1c".join(f"w{k}" for k in range(50))) & 1 == 1
    assert text_mask("") == 1


def test_empty_tables(spark):
    empty = spark.createDataFrame([], LABELS)
    assert filter_audit(documents(spark, []), empty).count() == 0
    assert found(filter_audit(documents(spark, ROWS[:6]), empty)) == plain(ROWS[:6], [])
