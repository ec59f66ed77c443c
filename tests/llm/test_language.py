from collections import Counter
from zlib import crc32

from tallymark.llm.language import PROFILE, identify_language
from tests.conftest import SMALL
from tests.llm.common import AWKWARD, documents


def naive_grams(text):
    cleaned = "".join(c.lower() if c.isalpha() and len(c.lower()) == 1 else c if c.isalpha() else "\x01" for c in f"\x01{text}\x01")
    while "\x01\x01" in cleaned:
        cleaned = cleaned.replace("\x01\x01", "\x01")
    if cleaned == "\x01":
        return Counter()
    counts = Counter(c for c in cleaned if c != "\x01")
    for n in (2, 3):
        counts.update(cleaned[k : k + n] for k in range(len(cleaned) - n + 1))
    return counts


def code(gram):
    out = 0
    for c in gram:
        out = out << 21 | ord(c)
    return out


def ranking(counts):
    return [g for g, _ in sorted(((code(g), n) for g, n in counts.items()), key=lambda x: (-x[1], x[0]))[:PROFILE]]


def brute(rows):
    profiles = {}
    for doc_id, text, lang in rows:
        if doc_id is not None and crc32(str(doc_id).encode()) % 4 != 2 and lang is not None:
            profiles.setdefault(lang, Counter()).update(naive_grams(text or ""))
    ranks = {k: {g: n for n, g in enumerate(ranking(v))} for k, v in profiles.items()}
    out = []
    for doc_id, text, _ in rows:
        mine = ranking(naive_grams(text or ""))
        held = doc_id is not None and crc32(str(doc_id).encode()) % 4 == 2
        if not mine or not ranks:
            out.append((doc_id, held, "und", 0.0))
            continue
        apart = {k: sum(abs(n - r[g]) if g in r else PROFILE for n, g in enumerate(mine)) for k, r in ranks.items()}
        best = min(sorted(apart), key=apart.get)
        out.append((doc_id, held, best, round(1 - apart[best] / (PROFILE * len(mine)), 9)))
    return sorted(map(repr, out))


def test_matches_a_naive_model(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    rows = [(r.doc_id, r.text, r.lang) for r in docs.collect()]
    found = identify_language(docs).collect()
    assert sorted(repr((r[0], r[1], r[2], round(r[3], 9))) for r in found) == brute(rows)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet(SMALL.replace("0.001", "0.01") + "/documents.parquet")
    truth = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    held = [r for r in identify_language(docs).collect() if r.held_out]
    assert len(held) > 150
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) / len(held) > 0.97


def test_awkward_rows(spark):
    rows = [r[:3] for r in AWKWARD]
    found = identify_language(documents(spark, AWKWARD, ("score", "lang_pred", "held_out"))).collect()
    assert sorted(repr((r[0], r[1], r[2], round(r[3], 9))) for r in found) == brute(rows)
    unlabelled = identify_language(documents(spark, [(1, "some text"), (2, None)])).collect()
    assert {(r.lang_pred, r.score) for r in unlabelled} == {("und", 0.0)}
    assert identify_language(documents(spark, [])).collect() == []


def test_ties_go_to_the_smaller_name(spark):
    rows = [(k, "same words here", lang) for k, lang in enumerate(["zz", "aa", "mm"] * 12)]
    assert {r.lang_pred for r in identify_language(documents(spark, rows)).collect()} == {"aa"}


def test_any_number_of_labels(spark):
    """Each of 1,500 labels has a text of its own."""
    word = lambda k: "".join(chr(97 + k // 26**n % 26) for n in range(3))
    rows = [(k, f"{word(k % 1500)} " * 3, f"l{k % 1500}") for k in range(6000)]
    found = {r.doc_id: r for r in identify_language(documents(spark, rows)).collect()}
    learned = {lang for k, _, lang in rows if crc32(str(k).encode()) % 4 != 2}
    assert len(learned) > 1400
    assert all(found[k].lang_pred == lang for k, _, lang in rows if lang in learned)
