import math
import os
import random
import subprocess
import sys
from pathlib import Path

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from tallymark.operators import evaluation, features, samples
from tallymark.operators.arrays import latest_merge, merge_sum_maps, strict_argmax, sum_arrays, sum_maps
from tallymark.operators.learners import BatchModel, NetworkClassifier, StackingClassifier, StackingModel, gram_classifier, probabilities, sparse_logistic, to_bytes
from tallymark.operators.lookups import city_centres, city_of, college_places, hash_lookup, in_polygon, range_lookup, within_radius


def test_arrays_and_maps(spark):
    frame = spark.createDataFrame([("u", [1, 2]), ("u", [3, None]), ("v", None), (None, [5, 5])], "k string, s array<int>")
    assert {r.k: r.s for r in sum_arrays(frame, "k", "s", 2).collect()} == {"u": [4, 2], "v": [0, 0], None: [5, 5]}
    maps = spark.createDataFrame([("u", {"a": 1.0}), ("u", {"a": 2.0, "b": 1.0}), ("v", None)], "k string, m map<string,double>")
    assert {r.k: r.m for r in sum_maps(maps, "k", "m").collect()} == {"u": {"a": 3.0, "b": 1.0}, "v": {}}
    assert spark.range(1).select(merge_sum_maps(F.create_map(F.lit("a"), F.lit(1.0)), F.create_map(F.lit("b"), F.lit(2.0))).alias("m")).first().m == {"a": 1.0, "b": 2.0}
    best = lambda x: spark.createDataFrame([(x,)], "x array<int>").select(strict_argmax(F.col("x"))).first()[0]
    assert [best(x) for x in ([1, 3], [2, 2], [0, 0], [5], [], None)] == [1.0, None, None, None, None, None]


def test_latest_merge(spark):
    rows = [("u", "1", ["a", "b"], "old", [1]), ("u", "3", ["d"], "new", [2]), ("u", "2", ["c"], "mid", None), ("v", "1", None, "x", [1]), (None, "1", ["z"], "n", [1])]
    frame = spark.createDataFrame(rows, "k string, date string, data array<string>, what string, tags array<int>")
    found = {r.k: (r.date, r.what, r.data, r.tags) for r in latest_merge(frame, "k", "date", "data", 3, "tags", 1).collect()}
    assert found == {"u": ("3", "new", ["b", "c", "d"], [3]), "v": ("1", "x", [], [1]), None: ("1", "n", ["z"], [1])}
    assert latest_merge(frame.repartition(4), "k", "date", "data", 3).orderBy("k").collect() == latest_merge(frame.coalesce(1), "k", "date", "data", 3).orderBy("k").collect()


def test_within_radius(spark):
    rng = random.Random(1)
    users = [(k % 150, 100 + rng.random() * 3, 30 + rng.random() * 3) for k in range(300)] + [(999, None, 1.0)]
    places = [(100 + rng.random() * 3, 30 + rng.random() * 3) for _ in range(25)] + [(None, None)]
    u = spark.createDataFrame(users, "aid long, lng double, lat double")
    p = spark.createDataFrame(places, "lng double, lat double")

    def sphere(a, b, c, d):
        h = math.sin(math.radians(b - d) / 2) ** 2 + math.cos(math.radians(b)) * math.cos(math.radians(d)) * math.sin(math.radians(a - c) / 2) ** 2
        return 2 * 6370996.81 * math.asin(math.sqrt(h))

    for metres in (500.0, 8000.0, 60000.0):
        want = sorted({k for k, x, y in users[:-1] for a, b in places[:-1] if sphere(x, y, a, b) <= metres})
        assert sorted(r.aid for r in within_radius(u, p, metres, metric="haversine").collect()) == want
    sizes = [within_radius(u, p, m).count() for m in (500.0, 5000.0, 50000.0)]
    assert sizes == sorted(sizes) and sizes[-1] > sizes[0]


def test_cities(spark):
    square = lambda x, y: {"type": "Polygon", "coordinates": [[[x, y], [x + 1, y], [x + 1, y + 1], [x, y + 1]]]}
    centres, shapes = {"a": (100.5, 30.5), "b": (101.5, 30.5), "c": (102.5, 30.5), "d": (110.0, 30.5)}, {"a": square(100, 30), "b": {"type": "MultiPolygon", "coordinates": [square(101, 30)["coordinates"]]}}
    frame = spark.createDataFrame([(100.9, 30.5), (101.01, 30.9), (102.5, 30.5), (10.0, 10.0), (None, 1.0)], "lng double, lat double")
    of = lambda **o: [r[0] for r in frame.select(city_of(F.col("lng"), F.col("lat"), centres, shapes, **o)).collect()]
    assert of() == ["a", "b", "c", "foreign", None]
    assert of(fallback="last")[2] == "a"
    assert not in_polygon(0.5, 0.5, [[(0, 0), (1, 0), (1, 1), (0, 1)], [(0.2, 0.2), (0.8, 0.2), (0.8, 0.8), (0.2, 0.8)]])
    kind = "districts array<struct<name:string,center:struct<longitude:double,latitude:double>,districts:array<struct<name:string,center:struct<longitude:double,latitude:double>>>>>"
    nested = spark.createDataFrame([([("北京市", (116.4, 39.9), [("北京城区", (1.0, 2.0))]), ("广东省", (113.0, 23.0), [("深圳市", (114.0, 22.5))])],)], kind)
    assert {(r.province, r.city, r.lng) for r in city_centres(nested).collect()} == {("北京", "北京", 116.4), ("广东省", "深圳", 114.0)}


def test_range_lookup(spark):
    ranges = [(10, 20, "a"), (30, 70_000, "b"), (15, 16, "c"), (2**33, 2**33 + 5, "d"), (2**33 + 3, 2**33 + 3, "e"), (10, 20, "a")]
    values = [5, 10, 14, 15, 16, 17, 20, 21, 30, 65_536, 70_000, 70_001, 2**33, 2**33 + 3, 2**33 + 4, None]
    found = range_lookup(spark.createDataFrame([(v,) for v in values], "v long"), spark.createDataFrame(ranges, "ip_begin long, ip_end long, name string"), "v")

    def want(v):
        best = max((r for r in ranges if v is not None and r[0] <= v), default=None)
        return best[2] if best and v <= best[1] else None

    assert sorted(((r.v, r.name) for r in found.collect()), key=str) == sorted(((v, want(v)) for v in values), key=str)


def test_range_lookup_of_wide_ranges(spark):
    ranges = [(0, 9, "a"), (10, 2**48, "b"), (2**40, 2**40 + 1, "c"), (2**60, 2**62, "d"), (2**62 + 7, 2**62 + 8, "e")]
    values = [9, 10, 70_000, 2**39 + 5, 2**40, 2**40 + 1, 2**40 + 2, 2**48, 2**48 + 1, 2**60 - 1, 2**60, 2**61 + 3, 2**62, 2**62 + 1, 2**62 + 8, None]
    found = range_lookup(spark.createDataFrame([(v, "x") for v in values], "v long, name_ string"), spark.createDataFrame(ranges, "ip_begin long, ip_end long, name string"), "v")

    def want(v):
        best = max((r for r in ranges if v is not None and r[0] <= v), default=None)
        return best if best and v <= best[1] else (None, None, None)

    assert found.columns == ["v", "name_", "ip_begin", "ip_end", "name"]
    assert sorted(((r.v, r.ip_begin, r.ip_end, r.name) for r in found.collect()), key=str) == sorted(((v, *want(v)) for v in values), key=str)


def test_functions_work_where_executors_lack_the_package(tmp_path):
    """The driver finds the package by a path of its own, which is not the workers'."""
    script = f"""
import sys
sys.path.insert(0, {str(Path(__file__).resolve().parents[1])!r})
from pyspark.sql import SparkSession, functions as F
spark = SparkSession.builder.master("local[1]").config("spark.ui.enabled", "false").getOrCreate()
from tallymark.functions.des import des_decrypt, des_encrypt
from tallymark.operators import tagging
lines = spark.createDataFrame([("u", ["0:app:ab cd ef"], "1")], "userid string, data array<string>, date string")
print(tagging.row_tags(lines, ["data_word=:0:ab,cd,ef"]).collect())
print("back", lines.select(des_decrypt(des_encrypt(F.lit("text"), b"12345678"), b"12345678")).first()[0])
"""
    (tmp_path / "job.py").write_text(script)
    env = {k: v for k, v in os.environ.items() if k != "PYTHONPATH"}
    done = subprocess.run([sys.executable, str(tmp_path / "job.py")], cwd=tmp_path, env=env, capture_output=True, text=True, timeout=240)
    assert "back text" in done.stdout, done.stderr[-2000:]


def test_hash_lookup_and_colleges(spark):
    rows = spark.createDataFrame([("a",), ("z",), (None,)], "k string")
    for small in (0, 10):
        assert {(r.k, r.v) for r in hash_lookup(rows, spark.createDataFrame([("a", 2), ("a", 1)], "k string, v int"), "k", "v", 9, small).collect()} == {("a", 2), ("z", 9), (None, 9)}
    data = [("北大（本部）", "北大宿舍", "x", "宿舍", None), ("北大（本部）", "北大东门", "x", "门", None), ("清华", "清华站", "x", None, "bus"), ("清华", "别处", "x", "门", None), ("技术", "技术学院", "教育培训;中学", None, None), ("技术", "高校", "教育培训;高等院校", None, None), ("（括号", "任何", None, "食堂", None)]
    places = spark.createDataFrame(data, "search_word string, name string, std_tag string, di_tag string, cp string")
    assert sorted(r.name for r in college_places(places).collect()) == sorted(["北大宿舍", "清华站", "技术学院", "高校", "任何"])


def test_encoder(spark):
    vocabulary = ["<PAD>", "<UNK>", "<EDL>", "<QUERY>", "<NOTQUERY>", "，", "b"]
    encoder = features.Encoder(features.vocabulary_of(vocabulary), {"appX": 0, "appY": 1}, max_length=6)
    plain = features.Encoder(features.vocabulary_of(vocabulary), max_length=6)
    assert plain.line_ids(["appX:1:，:1"]) == [1, 4, 5, 2, 0, 0]
    assert encoder.line_ids(["appY:1:bz"]) == [8, 5, 6, 1, 2, 0]
    assert encoder.line_ids(None) == [0] * 6 == encoder.line_ids([None, "bad", "a:b"])
    assert features.Encoder({}, max_length=3, pad=False, need_app=False, need_query=False).line_ids(["a:1:xy:z"]) == [1, 1, 2]
    frame = spark.createDataFrame([(["appX:0:5:12.5:x", "appX:2::3:x", "appY:1:z:1:x", "other:0:1:1:x", "bad", None], ["appY:1:t"]), (None, None)], "apps array<string>, data array<string>")
    found = frame.select(encoder.app_features(F.col("apps")).alias("f"), encoder.app_features(F.col("apps"), F.col("data"), sparse=True).alias("g"), encoder.app_index(F.col("apps")).alias("i"), encoder.lines_vector(F.col("data")).alias("v")).collect()
    assert tuple(found[0].f) == ([1.0, 0.0], [0.0, 0.0], [3.0, 0.0], [-1.0, 0.0])
    assert found[0].g.list == Vectors.sparse(2, {0: 1.0, 1: 1.0}) and found[1].g.list == Vectors.sparse(2, {})
    assert found[0].i == [0, 0] and found[1].i == [0, 0]
    assert list(found[0].v) == [8.0, 5.0, 1.0, 2.0, 0.0, 0.0]
    stage = features.LineEncoder(vocabulary=vocabulary, appNames=["appX"], maxLength=4)
    assert stage.transform(frame.withColumnRenamed("apps", "applist")).columns == ["applist", "data", "appfreq", "appdur", "appsys"]
    assert stage.setNeedPadZero(False).encoder().pad is False
    assert stage.transform(spark.range(1)).columns == ["id"]
    dense = spark.createDataFrame([(Vectors.dense(0, 2, 0),)], ["v"])
    assert dense.select(features.dense_to_sparse(F.col("v")).alias("s")).first().s == Vectors.sparse(3, {1: 2.0})
    assert spark.range(1).select(features.list_to_sparse(F.array(F.lit(0), F.lit(3))).alias("s")).first().s == Vectors.sparse(2, {1: 3.0})
    assert features.vectors_to_arrays(dense, ["v"]).first().v == [0.0, 2.0, 0.0]
    assert dense.select(features.largest_probability(F.col("v"))).first()[0] == 2.0
    assert spark.range(1).select(features.cosine(F.array(F.lit(0.0)), F.array(F.lit(1.0)))).first()[0] is None


def test_dictionaries(spark):
    frame = spark.createDataFrame([(["b:1", "a:2", "b", None], "x"), (["a"], None), (None, "y")], "apps array<string>, c string")
    assert [tuple(r) for r in features.top_names(frame, "apps", 2).collect()] == [("a", 2), ("b", 2)]
    assert sorted(map(tuple, features.category_dictionary(frame, ["c"]).collect())) == [("c", "-1", 0), ("c", "x", 1), ("c", "y", 2)]


def test_samples(spark):
    frame = spark.createDataFrame([(k, float(k % 4 == 0)) for k in range(2000)], "k long, label double")
    counts = {r.label: r["count"] for r in samples.balanced(frame, 1000).groupBy("label").count().collect()}
    assert counts[1.0] == 500 and 900 < counts[0.0] < 1100
    assert samples.balanced(frame.where("label = 0"), 10**9).count() == 1500
    a, b = samples.hash_split(frame, "k")
    assert a.count() + b.count() == 2000 and 1300 < a.count() < 1500 and not set(a.collect()) & set(b.collect())
    assert a.collect() == samples.hash_split(frame.repartition(7), "k")[0].orderBy("k").collect()
    assert 300 < samples.uniform(frame, 0.2).count() < 500
    assert sum(x.count() for x in samples.random_split(frame, [0.7, 0.3])) == 2000
    assert samples.epochs(frame, 3).count() == 6000 and samples.epochs(frame, 0).count() == 0
    assert sorted(samples.shuffled(frame).collect()) == sorted(frame.collect()) != samples.shuffled(frame).collect()
    for size in (0, 1, 2, 50, 5000):
        assert sorted(samples.buffered_shuffle(range(300), buffer_size=size, seed=1)) == list(range(300))
    assert sorted(samples.buffered_shuffle([1, 2], lambda x: [x] * x, 10)) == [1, 2, 2]
    dates = spark.createDataFrame([("20231229", "ok"), ("20231230", "x"), ("20240101", "my oem x"), ("20240102", None), ("20240103", "ok")], "date string, fr string")
    assert [r.date for r in dates.where(samples.last_days(F.col("date"), "20240102", 4)).collect()] == ["20231230", "20240101", "20240102"]
    assert [r.date for r in dates.where(samples.public_version(F.col("fr"))).collect()] == ["20231229", "20240103"]


def test_evaluation(spark):
    rows = spark.createDataFrame([(0, 0.1, 0), (1, 0.4, 0), (1, 0.35, 1), (0, 0.8, 1), (None, 0.5, 1), (1, None, 1)], "label int, score double, prediction int")
    assert evaluation.rank_auc(rows).first().auc == 0.5
    rng = random.Random(2)
    data = [(rng.random() < 0.3, round(rng.random(), 2)) for _ in range(500)]
    frame = spark.createDataFrame([(int(y), s) for y, s in data], "label int, score double")
    wins = [(a > b) + 0.5 * (a == b) for y, a in data if y for z, b in data if not z]
    for chunks in (1, 7, 256):
        assert evaluation.rank_auc(frame, chunks=chunks).first().auc == pytest.approx(sum(wins) / len(wins))
    assert evaluation.binned_auc(frame, 100_000).first().auc == pytest.approx(sum(wins) / len(wins))
    curve = evaluation.roc(frame, 50).orderBy("bin").collect()
    assert curve[0].tpr == curve[0].fpr == 1.0 and all(a.tpr >= b.tpr for a, b in zip(curve, curve[1:], strict=False))
    assert evaluation.rank_auc(frame.where("label = 1")).first().auc is None and evaluation.binned_auc(frame.limit(0)).first().auc is None
    assert evaluation.rank_auc(frame.limit(0)).first().auc is None
    matrix, accuracy = evaluation.confusion_matrix(rows.where("label is not null"), 3)
    assert matrix[0] == [0.5, 0.5, 0.0] and matrix[1] == pytest.approx([1 / 3, 2 / 3, 0.0]) and all(map(math.isnan, matrix[2])) and accuracy == 0.6


def test_stacking(spark, tmp_path):
    rng = random.Random(3)
    rows = [(k, Vectors.dense(x := rng.gauss(0, 1), rng.gauss(0, 1)), float(x > 0)) for k in range(120)]
    frame = spark.createDataFrame(rows, ["id", "features", "label"])
    for folds in (0, 2):
        model = StackingClassifier([sparse_logistic(regParam=0.001), sparse_logistic(regParam=0.01)], sparse_logistic(regParam=0.001), folds=folds).fit(frame)
        found = model.transform(frame)
        assert set(found.columns) == {"id", "features", "label", "rawPrediction", "probability", "prediction", "prob"}
        assert found.where("prediction = label").count() > 100
    model.save(f"{tmp_path}/stack")
    again = StackingModel.load(f"{tmp_path}/stack").transform(frame)
    assert [r.prob for r in again.orderBy("id").collect()] == [r.prob for r in found.orderBy("id").collect()]


def test_batch_model(spark, tmp_path):
    model = BatchModel(network=to_bytes([np.array([[1.0, -1.0], [0.0, 1.0], [1.0, 0.0]])], [np.array([0.0, 0.5])]), inputCols=["a", "v"], batchSize=2)
    frame = spark.createDataFrame([(float(k), Vectors.dense(1, k % 2)) for k in range(5)], ["a", "v"])
    model.save(f"{tmp_path}/batch")
    for r in BatchModel.load(f"{tmp_path}/batch").setBatchSize(3).transform(frame).collect():
        raw = [r.a + r.v[1], -r.a + r.v[0] + 0.5]
        assert list(r.rawPrediction) == pytest.approx(raw) and r.prediction == float(np.argmax(raw))
        assert list(r.probability) == pytest.approx(probabilities(np.array([raw]))[0].tolist())
    assert probabilities(np.array([[0.0]])).tolist() == [[0.5, 0.5]]
    labelled = frame.withColumn("label", (F.col("a") > 2).cast("double"))
    fitted = NetworkClassifier.from_conf({"input_cols": ["a", "v"], "hidden": [4], "epochs": 30}).fit(labelled)
    assert {"prediction", "probability", "rawPrediction"} <= set(fitted.transform(labelled).columns)
    own = NetworkClassifier(["a", "v"], train=lambda rows, options: to_bytes([np.ones((3, 2))], [np.zeros(2)])).fit(labelled)
    assert isinstance(own, BatchModel) and own.transform(labelled).count() == 5


def test_gram_classifier(spark):
    frame = spark.createDataFrame([(list(t), float("ab" in t)) for t in ("abab", "babab", "cdcd", "dcdcd")], "data array<string>, label double")
    found = gram_classifier(widths=(2, 3), size=64).fit(frame).transform(frame)
    assert found.where("prediction = label").count() == 4


def test_within_radius_on_the_sphere_at_any_latitude_and_across_the_meridian(spark):
    def apart(a, b):
        (x, y), (u, v) = np.radians(a), np.radians(b)
        return 2 * 6370996.81 * np.arcsin(np.sqrt(min(1.0, np.sin((y - v) / 2) ** 2 + np.cos(y) * np.cos(v) * np.sin((x - u) / 2) ** 2)))

    rng = random.Random(4)
    users = [(1, 0.0, 62.9), (2, 179.9, 10.0), (3, -179.95, -45.0), (4, 10.0, 89.9), *[(k, rng.uniform(-180, 180), math.degrees(math.asin(rng.uniform(-1, 1)))) for k in range(10, 400)]]
    places = [(20.0, 62.9), (-179.9, 10.0), (179.95, -45.0), (-170.0, 89.9), *[(rng.uniform(-180, 180), math.degrees(math.asin(rng.uniform(-1, 1)))) for _ in range(12)]]
    u, p = spark.createDataFrame(users, "aid long, lng double, lat double"), spark.createDataFrame(places, "lng double, lat double")
    for metres in (30_000.0, 1_000_000.0, 1_100_000.0, 7_000_000.0):
        want = sorted(k for k, x, y in users if any(apart((x, y), q) <= metres for q in places))
        assert sorted(r.aid for r in within_radius(u, p, metres, metric="haversine").collect()) == want
