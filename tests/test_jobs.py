import subprocess
import sys
from pathlib import Path

import duckdb
import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from pyspark.ml.feature import VectorAssembler
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from tallymark.functions.ids import from_long_form
from tallymark.operators.features import LineEncoder
from tallymark.operators.learners import StackingClassifier, StackingModel, sparse_logistic
from tallymark.plans import catalog, cli
from tallymark.plans.paths import JobPaths
from tallymark.plans.training import TrainingJob
from tallymark.sources import ip_ranges, readers, writers
from tallymark.streaming.tags import tag_stream, tag_windows
from tests.conftest import SMALL

ROOT = Path(__file__).resolve().parent.parent


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for file in Path(SMALL).glob("*.parquet"):
        connection.execute(f"create view {file.stem} as select * from '{file}'")
    return connection


@pytest.mark.parametrize("name", list(catalog.QUERIES))
def test_queries_equal_their_sql(spark, duck, name):
    found = catalog.QUERIES[name](spark, SMALL)
    rows = found.collect()
    if name not in catalog.SQL:
        return
    want = duck.execute(catalog.SQL[name])
    columns = [c[0] for c in want.description]
    assert sorted(columns) == sorted(found.columns)
    assert sorted(repr(tuple(r[c] for c in columns)) for r in rows) == sorted(map(repr, want.fetchall()))


def test_sums_of_apps_do_not_depend_on_splits(spark, tmp_path):
    """Ten times 0.1 is below 1 in order and 1 in two halves; values may be null, all of an app's too."""
    path = tmp_path / "events.parquet"
    path.mkdir()
    rows = [(k, 1, "click", 0.1) for k in range(10)] + [(10, 1, "view", None), (11, 2, "error", None), (12, 2, "error", 3.5), (13, 2, "signup", 1.0), (14, 3, "view", float("inf"))]
    for k in range(0, len(rows), 5):
        pq.write_table(pa.table(dict(zip(("event_id", "user_id", "event_type", "value"), map(list, zip(*rows[k : k + 5], strict=True)), strict=True))), path / f"part-{k:02d}.parquet")
    found = catalog.QUERIES["app_multi_hot"](spark, str(tmp_path))
    connection = duckdb.connect()
    connection.execute(f"set threads=1; create view events as select * from '{path}/*.parquet'")
    want = connection.execute(catalog.SQL["app_multi_hot"])
    columns = [c[0] for c in want.description]
    got = {r.userid: r for r in found.collect()}
    assert sorted(repr(tuple(r[c] for c in columns)) for r in got.values()) == sorted(map(repr, want.fetchall()))
    assert got[1].dur_click == 0.0 and got[1].has_view == 1.0 and got[2].dur_error == 3.0


def test_sums_of_apps_are_in_order_of_rows(spark, tmp_path):
    """Identifiers that fall, repeat or are null: 1 + 1e16 - 1e16 is 0 in order of rows and 1 from the last on."""
    path = tmp_path / "events.parquet"
    path.mkdir()
    values = [1.0, 1e16, -1e16, 5.25]
    rows = [(e, user, "click", v) for user, ids in ((1, [4, 3, 2, 1]), (2, [7] * 4), (3, [None] * 4), (None, [1, 2, 2, None])) for e, v in zip(ids, values, strict=True)]
    for k in range(0, len(rows), 3):
        columns = dict(zip(("event_id", "user_id", "event_type", "value"), map(list, zip(*rows[k : k + 3], strict=True)), strict=True))
        pq.write_table(pa.table(columns, schema=pa.schema([("event_id", pa.int64()), ("user_id", pa.int64()), ("event_type", pa.string()), ("value", pa.float64())])), path / f"part-{k:02d}.parquet")
    found = catalog.QUERIES["app_multi_hot"](spark, str(tmp_path)).collect()
    connection = duckdb.connect()
    connection.execute(f"set threads=1; create view events as select * from '{path}/*.parquet'")
    want = connection.execute(catalog.SQL["app_multi_hot"])
    columns = [c[0] for c in want.description]
    assert sorted(repr(tuple(r[c] for c in columns)) for r in found) == sorted(map(repr, want.fetchall()))
    assert {(r.freq_click, r.dur_click) for r in found} == {(4.0, 5.0)}


def test_automaton_equals_expressions_over_documents(spark):
    from tallymark.operators.rules import compile_rules, slot_values

    rules = compile_rules(["data_word=all:0:the,ing,the+ing", "data_word=src1,src2:0:er-que"])
    lines = catalog._document_lines(lambda t: spark.read.parquet(f"{SMALL}/{t}.parquet"))
    a, b = (lines.select("userid", slot_values(rules, F.col("data"), matcher=m).alias("s")).orderBy("userid").collect() for m in ("native", "arrow"))
    assert a == b


def test_files(spark, tmp_path):
    frame = spark.createDataFrame([("a", Vectors.dense(1, 0)), ("b", Vectors.dense(0, 2))], ["k", "v"])
    writers.orc(frame, f"{tmp_path}/orc", files=1)
    assert readers.orc(spark, f"{tmp_path}/orc", frame.schema).orderBy("k").collect() == frame.collect()
    writers.parquet(frame.select("k", F.lit(1).alias("n")), f"{tmp_path}/parquet", ["k"])
    assert {r.k for r in spark.read.parquet(f"{tmp_path}/parquet").collect()} == {"a", "b"}
    writers.text(frame.unionByName(frame), "k", f"{tmp_path}/text")
    assert sorted(r.value for r in readers.text(spark, f"{tmp_path}/text").collect()) == ["a", "b"]
    (tmp_path / "pairs.txt").write_text("a\t1\nb\t2\t3\nc\na\t4\n")
    assert readers.key_value_map(spark, f"{tmp_path}/pairs.txt") == {"a": "4"}
    (tmp_path / "local.txt").write_text(" a = 1=2 \n")
    assert readers.local_map(f"{tmp_path}/local.txt", "=") == {"a": "1=2"}
    with pytest.raises(ValueError):
        readers.local_map(f"{tmp_path}/pairs.txt", "=")
    (tmp_path / "vocab.txt").write_text("<PAD>\n x\n \ny\n\n")
    assert {r.token: r.id for r in readers.numbered_lines(spark, f"{tmp_path}/vocab.txt").collect()} == {"<PAD>": 0, "x": 1, "": 4, "y": 3}
    (tmp_path / "places.csv").write_text("name,lng\na,1.5\nb,x\n")
    assert [r.lng for r in readers.csv(spark, f"{tmp_path}/places.csv", "name string, lng double").collect()] == [1.5, None]
    (tmp_path / "geo").mkdir()
    (tmp_path / "geo/a.json").write_text('[{"features": [{"properties": {"name": "p"}, "geometry": {"type": "Polygon", "coordinates": []}}]}]')
    assert readers.geojson_shapes(spark, f"{tmp_path}/geo") == {"p": {"type": "Polygon", "coordinates": []}}
    assert readers.json_dictionary(f"{tmp_path}/geo/a.json")[0]["features"]
    assert readers.exists(spark, f"{tmp_path}/geo") and not readers.exists(spark, f"{tmp_path}/none")
    frame.createOrReplaceTempView("some_rows")
    assert [tuple(r) for r in readers.table(spark, "some_rows", ["k"], "k = 'a'").collect()] == [("a",)]
    assert writers.lines(frame.orderBy("k"), "k", f"{tmp_path}/lines") == 2 and (tmp_path / "lines").read_text() == "a\nb\n"
    with pytest.raises(ValueError):
        writers.lines(frame, "k", f"{tmp_path}/lines", most=1)
    scores = spark.createDataFrame([(0.0,), (0.5,)], "prob double")
    assert [writers.above(scores, t).count() for t in (None, 0.0, 0.5)] == [2, 1, 0]
    writers.long_form(spark.createDataFrame([("u", 1, "x")], "id string, a int, b string"), "id", f"{tmp_path}/long")
    assert tuple(from_long_form(spark.read.parquet(f"{tmp_path}/long"), ["a", "b"]).first()) == ("u", "1", "x")


def test_line_numbers_do_not_depend_on_splits(spark, tmp_path):
    words = [f" w{k * 7919 % 701}\r" if k % 5 else "" for k in range(3000)]
    (tmp_path / "vocab.txt").write_bytes("\n".join(words).encode())
    want = {w.strip(" "): k for k, w in enumerate(words)}
    size = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for most in ("128MB", "1000", "97"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", most)
            assert {r.token: r.id for r in readers.numbered_lines(spark, f"{tmp_path}/vocab.txt").collect()} == want
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
    (tmp_path / "empty.txt").write_text("")
    assert readers.numbered_lines(spark, f"{tmp_path}/empty.txt").collect() == []


def test_ip_dictionary(spark, tmp_path):
    ranges = [(0, 9, "中国", "a"), (10, 20, "广东省深圳市", "a"), (30, 40, "中国", "")]
    data = ip_ranges.build(ranges)
    assert list(ip_ranges.entries(data)) == ranges
    jump = bytes([ip_ranges.FULL, 4, 0, 0]) + bytes([ip_ranges.PART, 11, 0, 0]) + b"z\0x" + "好\0".encode("gb18030")
    assert ip_ranges.names_at(jump, 0) == ("好", "z")
    (tmp_path / "ip.dat").write_bytes(data)
    spark.dataSource.register(ip_ranges.IpRangeSource)
    assert sorted(map(tuple, spark.read.format("ip_ranges").load(f"{tmp_path}/ip.dat").collect())) == ranges
    assert list(ip_ranges.entries(b"bad")) == [] == list(ip_ranges.entries(b"\xff" * 40))
    import zlib

    packed, key, masked = zlib.compress(data), 77, bytearray()
    state = key
    for byte in packed[:0x200]:
        state = (state * 0x805 + 1) & 0xFF
        masked.append(byte ^ state)
    assert ip_ranges.decode_download(key, bytes(masked) + packed[0x200:]) == data


def test_training_job(spark, tmp_path):
    lines = [(f"u{k}", f"2024010{1 + k % 3}", [f"a:1:{'good' if k % 2 else 'bad'} {k}"], "store") for k in range(60)]
    apps = [(f"u{k}", "20240102", [f"app{k % 2}:0:{k}:1:x"]) for k in range(0, 70)]
    encoder = LineEncoder(vocabulary=["<PAD>", "<UNK>", "<EDL>", "<QUERY>", "<NOTQUERY>", *"abdgo"], appNames=["app0", "app1"], maxLength=12)
    job = TrainingJob(spark, JobPaths(f"{tmp_path}/root", "demo", "20240103"), spark.createDataFrame(lines, "userid string, date string, data array<string>, fr string"), spark.createDataFrame(apps, "userid string, date string, applist array<string>"), encoder, only_public=True)
    job.sample(["data_word=all:0:bad", "data_word=all:0:good"])
    job.train_convert()
    train, test = job.train_df(), job.test_df()
    assert train.count() + test.count() == 60 and train.count() > 25
    assembler = VectorAssembler(inputCols=["applist", "appfreq"], outputCol="features")
    model = StackingClassifier([sparse_logistic(regParam=0.001)], sparse_logistic(regParam=0.001)).fit(assembler.transform(train))
    model.save(job.paths.model)

    class Loaded:
        def __init__(self, path):
            self.model = StackingModel.load(path)

        def transform(self, frame):
            return self.model.transform(assembler.transform(frame))

    job.run("20240103", Loaded, f"{tmp_path}/saved", threshold=0.5)
    result = readers.orc(spark, job.paths.result)
    assert result.count() == 70
    saved = from_long_form(spark.read.parquet(f"{tmp_path}/saved"), ["prediction", "prob"])
    assert 0 < saved.count() <= 70



def test_command_line(spark, tmp_path):
    spark.createDataFrame([("u", ["x:0:good good"], "20240101"), ("u", ["x:0:good"], "20240102"), ("v", ["x:0:none"], "20240101")], "userid string, data array<string>, date string").write.parquet(f"{tmp_path}/lines")
    arguments = ["user_tags", f"{tmp_path}/out", '["t"]', '["data_word=all:0:good"]', "--lines", f"{tmp_path}/lines"]
    cli.main([*arguments, "--end_date", "20240101"])
    assert [(r.userid, r.tags) for r in spark.read.parquet(f"{tmp_path}/out").collect()] == [("u", {"t": 2})]
    cli.main([*arguments, "--mode", "user"])
    assert [(r.userid, r.tags) for r in spark.read.parquet(f"{tmp_path}/out").collect()] == [("u", {"t": 3})]
    for bad in ("{", "{}", "[1]", str(["x"] * 1001).replace("'", '"')):
        with pytest.raises(SystemExit):
            cli.main(["user_tags", "x", bad, "[]", "--lines", "y"])


def test_streams(spark, tmp_path):
    rows = spark.createDataFrame([("u", ["x:0:good"], "2024-01-01 10:00:00"), ("u", ["x:0:good good"], "2024-01-01 11:00:00"), ("v", ["x:0:none"], "2024-01-03 10:00:00")], "userid string, data array<string>, t string").select("userid", "data", F.col("t").cast("timestamp").alias("time"))
    rows.write.parquet(f"{tmp_path}/in")
    rules, names = ["data_word=all:0:good"], ["t"]
    for make, mode in ((lambda s: tag_stream(s, rules, names), "append"), (lambda s: tag_windows(s, rules, names), "complete")):
        stream = make(spark.readStream.schema(rows.schema).parquet(f"{tmp_path}/in"))
        query = stream.writeStream.format("memory").queryName(f"out_{mode}").outputMode(mode).start()
        query.processAllAvailable()
        query.stop()
    assert sorted(r.tags["t"] for r in spark.table("out_append").collect()) == [1, 2]
    assert [(r.userid, r.tags) for r in spark.table("out_complete").collect()] == [("u", {"t": 3})]


def test_entry_works_without_the_optional_operators(tmp_path):
    """In a copy of the repository without them, the entry imports and has the other queries."""
    import shutil

    shutil.copytree(ROOT / "tallymark", tmp_path / "tallymark", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(ROOT / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'rule_tag_direct' in q and not any(k.startswith('op1_') for k in q) and set(e.oracle_sql()) <= set(q)"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True, env={"PATH": "/usr/bin:/bin", "PYTHONPATH": ""})


@pytest.mark.parametrize("name", ["rule_tag_direct", "rule_combo_threshold", "rule_query_flag", "rule_many_words", "rule_two_phase", "rule_sub_scores", "rule_app_atoms", "sample_label_argmax", "label_then_merge", "merge_then_label"])
def test_lines_are_parsed_and_counted_once_a_row(spark, name):
    """No filter of the optimised plan parses lines or records, and the automaton runs at most once."""
    plan = catalog.QUERIES[name](spark, SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert not [x for x in plan.split("\n") if "Filter" in x and ("substring_index" in x or "split(" in x)]
    assert plan.count("ArrowEvalPython") <= 1 and (plan.count("ArrowEvalPython") == 1 or name != "rule_many_words")
