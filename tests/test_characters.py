import time

import numpy as np
import pytest

from pyspark.sql import functions as F

from tallymark.operators import characters
from tallymark.operators.characters import CharClassifier, CharNetwork, character_windows, window_count
from tallymark.operators.learners import BatchModel
from tallymark.operators.trainer import Plan

TEXTS = ["", None, "a", "abcd", "abcdefgh", "abcdefghi", "é😀 " * 7, "x\ny\tz" * 40]


def test_gradients_equal_differences():
    draw = np.random.default_rng(3)
    network = CharNetwork(7, 3, (2, 3), 4, 5)
    weights, x, y = network.start(2), draw.integers(0, 7, (300, 9)).astype(float), draw.integers(0, 3, 300)
    _, found = network.gradients(weights, x, y)
    for w, slope in zip(weights, found, strict=True):
        for at in list(np.ndindex(w.shape))[:9]:
            kept, losses = w[at], []
            for d in (1e-7, -1e-7):
                w[at] = kept + d
                losses.append(network.gradients(weights, x, y)[0])
            w[at] = kept
            assert slope[at] == pytest.approx((losses[0] - losses[1]) / 2e-7, rel=1e-3, abs=1e-3)


def test_lookups_equal_a_plain_convolution():
    draw = np.random.default_rng(5)
    network = CharNetwork(11, 2, (3, 4), 6, 2)
    weights, ids = network.start(1), draw.integers(0, 11, (5, 12))
    for row, got in zip(ids, network.forward(weights, ids.astype(float)), strict=True):
        pooled = []
        for k, width in enumerate(network.widths):
            kernel, bias = weights[1 + 2 * k], weights[2 + 2 * k]
            for c in range(2):
                pooled.append(max(sum(float(weights[0][row[p + j]] @ kernel[j][:, c]) for j in range(width)) for p in range(12 - width + 1)) + bias[c])
        np.testing.assert_allclose(got, np.array(pooled) @ weights[-2] + weights[-1])


def test_windows_of_a_long_text_take_time_by_its_length(spark):
    """Cut anew for each window, the text's characters were made 2 x 8,000 times."""
    text = "ein langer Text, " * 120_000
    frame = spark.createDataFrame([(text,), (None,), ("ab",)], "text string")
    began = time.perf_counter()
    found = frame.select(F.size(character_windows(F.col("text"))), window_count(F.col("text"), 256, 5), F.element_at(character_windows(F.col("text")), -1)).collect()
    assert time.perf_counter() - began < 30
    assert [tuple(r[:2]) for r in found] == [(8096, 8096), (1, 1), (1, 1)]
    codes = [1 + ord(c) % 1023 for c in text[252 * 8095 :]]
    assert found[0][2] == codes + [0] * (256 - len(codes))


def test_windows_hold_every_run_of_characters(spark):
    frame = spark.createDataFrame(list(enumerate(TEXTS)), "k int, text string")
    for k, text, windows in frame.select("k", "text", character_windows(F.col("text"), 8, 3, 1024)).collect():
        codes = [1 + ord(c) % 1023 for c in text or ""]
        assert all(len(w) == 8 for w in windows) and len(windows) == max(1, -(-(len(codes) - 2) // 6))
        want = {tuple(codes[a : a + 3]) for a in range(len(codes) - 2)} or {tuple(codes)}
        runs = {tuple(w[a : a + 3]) for w in windows for a in range(6)}
        assert want <= runs or {tuple(windows[0][: len(codes)])} == want
        assert {r for r in runs if 0 not in r} <= want


def test_a_network_is_fitted_on_every_window(spark, monkeypatch):
    """Of more than 8,000 windows the fit took a sample."""
    taken = []
    monkeypatch.setattr(characters, "train", lambda rows, network, inputs, label, plan, *_: taken.append((rows.select(*inputs, label).count(), plan.batch_rows)))
    frame = spark.createDataFrame([("".join(chr(97 + (k * j) % 25) for j in range(40_000)), k % 2) for k in range(60)] + [("left out", None)], "text string, label int")
    n = frame.where("label is not null").agg(F.sum(window_count(F.col("text"), 256, 5))).first()[0]
    CharClassifier(CharNetwork()).fit(frame)
    assert n > 9_000 and taken == [(n, -(-n // 6))]


def test_runs_of_a_large_alphabet_are_pooled_as_those_of_a_small_one(monkeypatch):
    """Runs are numbered by a table or by sorting."""
    network, ids = CharNetwork(1024, 2, (1, 4, 7), 3, 2), np.random.default_rng(7).integers(0, 1024, (40, 30))
    weights, y = network.start(3), np.arange(40) % 2
    loss, found = network.gradients(weights, ids, y)
    monkeypatch.setattr(characters, "TABLE", 1)
    again, same = network.gradients(weights, ids, y)
    assert loss == again and all((a == b).all() for a, b in zip(found, same, strict=True))
    shares = [[weights[0] @ kernel for kernel in weights[1 + 2 * k]] for k in range(3)]
    for row, got in zip(ids, network.forward(weights, ids), strict=True):
        pooled = [max(sum(shares[k][at][row[p + at], c] for at in range(w)) for p in range(30 - w + 1)) + weights[2 + 2 * k][c] for k, w in enumerate((1, 4, 7)) for c in range(2)]
        np.testing.assert_allclose(got, np.array(pooled) @ weights[-2] + weights[-1])


def test_whole_texts_are_told_apart_by_a_saved_model(spark, tmp_path):
    """Only a text's end tells its class, far behind the first window."""
    rows = [(k, "la le li lo lu " * 30 + ("xyz" if k % 2 else "pqr") * 20, k % 2) for k in range(80)] + [(100, None, None), (101, "", None)]
    frame = spark.createDataFrame(rows, "id long, text string, label int").withColumns({"window": F.lit(1), "prediction": F.lit("clash")})
    classifier = CharClassifier(CharNetwork(256, 2, (3,), 4, 8), size=64, plan=Plan(epochs=10, rate=0.1))
    model = classifier.model(classifier.fit(frame, ranks=1))  # most windows are those of both classes and tell nothing
    model.save(f"{tmp_path}/model")
    loaded = BatchModel.load(f"{tmp_path}/model")
    every = {r.id: r.prediction for r in classifier.predict(loaded, frame, "id").collect()}
    assert set(every) == {r[0] for r in rows} and all(every[k] == k % 2 for k in range(80))
    first = {r.id: r.prediction for r in classifier.predict(loaded, frame.withColumn("text", F.left("text", F.lit(450))), "id").collect()}
    assert len({first[k] for k in range(80)}) == 1
    assert classifier.predict(loaded, frame.limit(0), "id").collect() == []
