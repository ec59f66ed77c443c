import hashlib
import html

import pytest

from tallymark.llm.chat import format_chats, read_chats, write_chats

SCHEMA = "conv_id long, turn long, role string, text string, example long, final boolean"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 5, True) for r in rows], SCHEMA)


ROWS = [
    (1, 0, "system", "be kind"),
    (1, 1, "user", "<turn> & \"x\" &lt; \\n"),
    (1, 2, "assistant", "ok </turn>\n<turn role=\"user\">"),
    (1, 3, "user", "more"),
    (1, 4, "assistant", None),
    (2, 1, "assistant", "only 你好"),
    (2, 0, None, ""),
    (2, 2, "user", "tail"),
    (3, 0, "user", "no reply"),
    (None, None, 'a"<', "x"),
    (None, 1, "assistant", "y"),
    (4, 0, "assistant", "same"),
    (4, 0, "assistant", "same"),
    (-7, 0, "user", r"\### Assistant: </turn> ok"),
    (-7, 1, "assistant", r"\### Assistant: </turn> ok"),
]


def test_round_trip(spark):
    found = {r.conv_id: r for r in read_chats(write_chats(frame(spark, ROWS).repartition(3))).collect()}
    by = {}
    for conv, turn, role, text in ROWS:
        by.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    assert found.keys() == by.keys()
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for conv, turns in by.items():
        turns.sort()
        loss = "".join(t for *_, role, t in turns if role == "assistant")
        assert found[conv].n_turns == len(turns)
        assert found[conv].turns_sha256 == sha("".join(f"{role}\n{t}\n" for *_, role, t in turns))
        assert (found[conv].loss_chars, found[conv].loss_sha256) == (len(loss), sha(loss))


def test_each_reply_is_the_only_text_under_its_mask(spark):
    rows = sorted((r for r in format_chats(frame(spark, ROWS)).collect() if r.conv_id == 1), key=lambda r: r.example)
    assert [html.unescape(r.formatted[r.loss_start : r.loss_end]) for r in rows] == [ROWS[2][3], ""]
    assert rows[1].formatted.startswith(rows[0].formatted)
    assert [r.final for r in rows] == [False, True]


def test_empty_table(spark):
    assert read_chats(write_chats(frame(spark, []))).collect() == []


@pytest.mark.parametrize("unit_chars", [1, 60, 2000])
def test_long_conversations_are_written_by_several_tasks(spark, unit_chars):
    rows = [*ROWS, *((9, k, ("user", "assistant", "assistant")[k % 3], f"turn {k} <" * (1 + k % 5)) for k in range(70)), *((10, k, "user", f"no reply {k}") for k in range(20)), (11, 0, "assistant", "long " * 5000)]
    whole, parts = (format_chats(frame(spark, rows), unit_chars=n) for n in (1 << 40, unit_chars))
    assert sorted(map(repr, parts.collect())) == sorted(map(repr, whole.collect()))
    assert sum(r.formatted_chars for r in read_chats(parts).collect()) == sum(len(r.formatted) for r in whole.collect())
