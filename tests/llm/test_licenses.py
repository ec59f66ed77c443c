import random
import re
from collections import Counter

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallymark.llm.licenses import TEMPLATES, Scanner, alignment, plain, scan_licenses
from tests.conftest import SMALL
from tests.llm.common import AWKWARD, documents


def test_each_template_is_found_in_running_text(spark):
    rows = [(k, f"Some words before it.\n{text}\nand others follow " * 2) for k, text in enumerate(TEMPLATES.values())]
    found = {}
    for r in scan_licenses(documents(spark, rows)).collect():
        assert r.changed_words == 0
        found.setdefault(r.doc_id, []).append(r.license)
    assert found == {k: [name] * 2 for k, name in enumerate(TEMPLATES)}


def test_each_template_is_found_with_any_white_space_between_its_words(spark):
    wrapped = [(name, gap.join(text.split())) for name, text in TEMPLATES.items() for gap in ("\n", "\t", "  ", "\r\n")]
    found = scan_licenses(documents(spark, list(enumerate(text for _, text in wrapped)))).collect()
    assert sorted((r.doc_id, r.license, r.changed_words) for r in found) == [(k, name, 0) for k, (name, _) in enumerate(wrapped)]


def test_changed_wording_is_reported_and_other_text_left_alone(spark):
    rows = [
        (1, "x " * 50 + "this WORK is licensed under the\n  GNU General Public Licence, version 3" + " y" * 50),
        (2, "the license of the software has no notice and the copyright is not named"),
        (3, "Licensed under the Business License, Version 9."),
        (4, None),
        (5, "license " * 3000),
    ]
    found = scan_licenses(documents(spark, rows, ("license", "passage"))).collect()
    assert [(r.doc_id, r.first_word, r.n_words, r.license, r.changed_words, r.removed, r.added) for r in found] == [(1, 50, 12, "GPL-3.0", 1, "license", "licence")]


def test_finds_what_a_plain_search_finds(spark):
    docs = spark.read.parquet(SMALL.replace("0.001", "0.01") + "/documents.parquet")
    short = {k: v for k, v in TEMPLATES.items() if k in ("Apache-2.0", "MIT", "GPL-3.0", "CC-BY-NC-4.0")}
    want = sorted((r.doc_id, k) for r in docs.collect() for k, v in short.items() for _ in re.findall(re.escape(v), r.text or ""))
    found = sorted((r.doc_id, r.license) for r in scan_licenses(docs).where(F.col("changed_words") == 0).collect())
    assert found == want and want


def test_ranking_is_by_saved_bytes():
    scanner = Scanner(TEMPLATES, 0.15)
    block = "a b c released under the mit license and so on".split()
    assert scanner.ranked(block)[0][1] == "MIT"


def test_awkward_rows_and_empty_table(spark):
    assert scan_licenses(documents(spark, AWKWARD)).collect() == []
    assert scan_licenses(documents(spark, [])).collect() == []


def test_conditions_tell_notices_with_one_opening_apart(spark):
    two, three, mit = (TEMPLATES[k] for k in ("BSD-2-Clause", "BSD-3-Clause", "MIT-permission"))
    warranty = " THIS SOFTWARE IS PROVIDED AS IS, WITHOUT WARRANTY OF ANY KIND."
    texts = [two + warranty, three + warranty, mit + warranty, two.split(" 1. ")[0] + " 1. Something else is asked for here, in words that no notice has.", mit.split(", including")[0] + warranty]
    found = scan_licenses(documents(spark, list(enumerate(texts)))).collect()
    assert sorted((r.doc_id, r.license, r.changed_words) for r in found) == [(0, "BSD-2-Clause", 0), (1, "BSD-3-Clause", 0), (2, "MIT-permission", 0), (3, "BSD-opening", 0), (4, "MIT-opening", 0)]


def levenshtein(a, b):
    row = list(range(len(b) + 1))
    for k, x in enumerate(a, 1):
        row, before = [k], row
        for j, y in enumerate(b, 1):
            row.append(min(before[j] + 1, row[-1] + 1, before[j - 1] + (x != y)))
    return row[-1]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from("abcd"), min_size=1, max_size=7), st.lists(st.sampled_from("abcde"), max_size=9))
def test_alignment_has_the_fewest_changes(own, block):
    changed, first, end, removed, added = alignment(own, block)
    least = min(levenshtein(own, block[a:b]) for a in range(len(block) + 1) for b in range(a, len(block) + 1))
    assert levenshtein(own, block[first:end]) == least == changed <= len(removed) + len(added)
    assert max(len(removed), len(added)) <= least
    assert Counter(own) + Counter(added) == Counter(block[first:end]) + Counter(removed)


def test_scan_finds_what_an_exhaustive_comparison_finds():
    """Every template with words removed, added and replaced, in running text: against an alignment with all of it, without cues or blocks."""
    rng, scanner = random.Random(3), Scanner(TEMPLATES, 0.15)
    filler = "the cat sat on a mat and some other words of this text were not about anything".split()
    n_found = n_none = 0
    for name, text in TEMPLATES.items():
        for share in (0.0, 0.05, 0.1, 0.14, 0.2, 0.3):
            words = text.split()
            for _ in range(int(share * len(words))):
                at, kind = rng.randrange(len(words)), rng.randrange(3)
                words[at : at + (kind != 1)] = [] if kind == 0 else [f"changed{rng.randrange(9)}"]
            around = [" ".join(rng.choices(filler, k=rng.randint(0, 300))) for _ in range(2)]
            whole = rng.choice(["\n", " ", "\t\r\n"]).join([around[0], *words, around[1]])
            plains = [plain(w) for w in whole.split()]
            fits = {}
            for other, own in scanner.words.items():
                changed, first, end, *_ = alignment(own, plains)
                if changed <= scanner.slack[other]:
                    fits[other] = (changed, first, end - first)
            found = list(scanner.scan(whole))
            assert bool(found) == bool(fits), (name, share)
            for first, n, license_, _, changed, *_ in found:
                assert license_ in fits
                if fits[license_][1:] == (first, n):
                    assert changed == fits[license_][0]
            n_found, n_none = n_found + bool(found), n_none + (not found)
            if share == 0.0:
                assert [(f[2], f[4]) for f in found] == [(name, 0)]
    assert n_found > 60 and n_none > 20


def test_own_templates_ties_and_repeated_rows(spark):
    own = {"B": "zorp quux blim frab", "A": "Zorp quux, blim frab!", "empty": " ", "one": "xyzzyplugh"}
    rows = [(1, "so zorp\nquux blim frab it is"), (1, "so zorp\nquux blim frab it is"), (2, "say xyzzyplugh twice: XYZZYPLUGH."), (3, "zorp quux frab")]
    found = scan_licenses(documents(spark, rows), templates=own).collect()
    assert sorted((r.doc_id, r.first_word, r.license, r.changed_words) for r in found) == [(1, 1, "A", 0), (1, 1, "A", 0), (2, 1, "one", 0), (2, 3, "one", 0)]
    assert scan_licenses(documents(spark, rows), templates={}).collect() == []


def test_unlicense_across_a_line_break(spark):
    text = "This is free and unencumbered software released into the public\ndomain."
    assert [r.license for r in scan_licenses(documents(spark, [(1, text)])).collect()] == ["Unlicense"]
