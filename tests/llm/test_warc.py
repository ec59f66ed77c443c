import base64
import hashlib

from pyarrow import fs

from tallymark.llm.warc import read_archives, records, write_archives

ROWS = [(1, "http://a/ x", "same"), (5, "http://b/", "same"), (3, None, "same"), (2, "http://c/", None), (4, "http://d/", ""), (6, "http://e/", "ünique\r\n\r\nHTTP/1.1"), (None, "http://f/", "same"), (None, None, "none has an id"), (7, "u", "twice"), (7, "u", "twice"), (8, "u", "twice " * 20_000)]


def frame(spark, rows):
    return spark.createDataFrame([(*r, "d", 1) for r in rows], "page_id long, url string, html string, digest string, n_bytes int")


def expected(rows, least=0):
    out = []
    for page, _, text in rows:
        data = (text or "").encode()
        same = [p for p, _, t in rows if (t or "") == (text or "") and p is not None]
        original = max(same) if same and len(data) >= least else None
        revisit = original is not None and page != original
        out.append((page, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "revisit" if revisit else "response", original if revisit else None))
    return sorted(map(repr, out))


def test_round_trip(spark):
    archives = write_archives(frame(spark, ROWS).repartition(3), file_bytes=500)
    assert sorted(repr(tuple(r)) for r in read_archives(archives).collect()) == expected(ROWS)
    assert archives.count() > 3


def test_many_revisits_are_taken_out_by_a_shuffle(spark):
    found = read_archives(write_archives(frame(spark, ROWS), small=0))
    assert sorted(repr(tuple(r)) for r in found.collect()) == expected(ROWS)


def test_small_payloads_stay_responses(spark):
    found = read_archives(write_archives(frame(spark, ROWS), min_bytes=4))
    assert sorted(repr(tuple(r)) for r in found.collect()) == expected(ROWS, 4)


def test_revisits_hold_no_payload(spark):
    for row in write_archives(frame(spark, ROWS[:3])).collect():
        system, name = fs.FileSystem.from_uri(row.path)
        with system.open_input_file(name) as file:
            for fields, block in records(file):
                assert block.endswith(b"same") == (fields["WARC-Type"] == "response")
                assert ("WARC-Refers-To" in fields) == (fields["WARC-Type"] == "revisit")


def test_empty_table(spark):
    assert read_archives(write_archives(frame(spark, []))).collect() == []
