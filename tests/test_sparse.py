import time

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from tallymark.operators import features
from tallymark.operators.sparse import number_of, numbers_of, sparse_list, to_dense, to_vector

LISTS = [[0.0, 1.5, 0.0, -2.0], [], [0.0, 0.0], None, [3.0], [0.0, float("inf")], [0.0, None, 1.0]]


@pytest.fixture(scope="module")
def lists(spark):
    return spark.createDataFrame([(k, x) for k, x in enumerate(LISTS)], "k int, x array<double>")


def test_lists_to_vectors_and_back(lists):
    rows = lists.select("x", to_vector(sparse_list(F.col("x"))).alias("v"), to_dense(sparse_list(F.col("x"))).alias("d")).collect()
    for row in rows:
        if row.x is None:
            assert row.v is None and row.d is None
        else:
            want = [x or 0.0 for x in row.x]
            assert row.v == Vectors.sparse(len(want), {k: x for k, x in enumerate(want) if x}) and row.d == want


def test_vectors_take_no_python_worker(lists):
    found = lists.select(features.list_to_sparse(F.col("x")).alias("a"))
    found = found.select("a", features.dense_to_sparse(F.col("a")).alias("b"))
    assert "Python" not in found._jdf.queryExecution().executedPlan().toString()
    assert all(r.a == r.b for r in found.collect())


def test_numbers(spark):
    frame = spark.createDataFrame([(["a", "x", None, "b"], "b"), ([], "x"), (None, None)], "names array<string>, name string")
    rows = frame.select(numbers_of(F.col("names"), {"a": 7, "b": 2}, 1).alias("n"), number_of(F.col("name"), {"b": 2}).alias("one")).collect()
    assert [(r.n, r.one) for r in rows] == [([7, 1, 1, 2], 2), ([], None), ([], None)]


def plain(records, lines, places):
    """What the encoder says of records, row by row."""
    found = ({}, {}, {}, {})
    for record in records or []:
        part = record.split(":") if record is not None else []
        if len(part) < 4 or part[0] not in places:
            continue
        try:
            values = 1.0, float(part[2] or 0), float(part[3] or 0), -1.0 if part[1] in ("", "2") else float(part[1])
        except ValueError:
            continue
        for target, value in zip(found, values, strict=True):
            target[places[part[0]]] = value
    for line in lines or []:
        if line is not None and line.split(":")[0] in places:
            found[0][places[line.split(":")[0]]] = 1.0
    return [Vectors.sparse(len(places), {k: v for k, v in x.items() if v}) for x in found]


RECORDS = [
    (["a:1:2:3:x", "b::::", "a:0:5:0.5", None, "c:2:1e2:-1"], ["b:1:t", "zz", None]), (["a:1:x:3", "a:1:2", "q:1:1:1", "b: 1 :+2:.5"], None), (None, ["c:1"]), ([], []), (None, None), (["c:1:1:1", "c:0:0:0"], ["c"]),
    (["b:1:2.:3d", "c:y:1:1", "a:1:nan:inf"], []),
]


def test_app_features_equal_the_plain_encoder(spark):
    places = {"a": 0, "b": 1, "c": 2}
    frame = spark.createDataFrame(RECORDS, "apps array<string>, data array<string>").repartition(1)
    encoder = features.Encoder({}, places)
    found = frame.select("apps", "data", encoder.app_features(F.col("apps"), F.col("data"), sparse=True).alias("s"), encoder.app_features(F.col("apps"), F.col("data")).alias("d"))
    assert "BatchEvalPython" not in found._jdf.queryExecution().executedPlan().toString()
    for row in found.collect():
        for made, dense, want in zip(row.s, row.d, plain(row.apps, row.data, places), strict=True):
            np.testing.assert_equal(made.toArray(), want.toArray())
            np.testing.assert_equal(dense, want.toArray().tolist())
    assert found.limit(0).collect() == []


def test_dictionaries_of_a_hundred_thousand(spark):
    names = {f"app{k}": k for k in range(100_000)}
    began = time.perf_counter()
    frame = spark.createDataFrame([([f"app{k}:1:{k}:2:x" for k in range(99_990, 100_010)], "app77777")] * 50, "apps array<string>, name string")
    encoder = features.Encoder({}, names, categories={"one": names, "two": {"x": 0, "-1": 1}}, app_length=30)
    found = frame.select(encoder.app_index(F.col("apps")).alias("i"), encoder.profile_sparse({"one": F.col("name")}).alias("p"), F.size(encoder.profile({"one": F.col("name")})).alias("n"), encoder.app_features(F.col("apps"), sparse=True)["freq"].alias("f"))
    assert len(found._jdf.queryExecution().executedPlan().toString()) < 30_000
    for row in found.collect():
        assert row.i == [*range(99_990, 100_000), *[features.UNKNOWN] * 10, *[features.PAD] * 10]
        assert row.p.asDict() == {"size": 100_002, "indices": [77_777, 100_001], "values": [1.0, 1.0]} and row.n == 100_002
        assert row.f == Vectors.sparse(100_000, {k: float(k) for k in range(99_990, 100_000)})
    assert time.perf_counter() - began < 60
