import os

import numpy as np
import pytest

from tallymark.operators.learners import BatchModel, NetworkClassifier
from tallymark.operators.trainer import DenseNetwork, Plan, State, advance, barrier_training, last_state, save_state, train
from tests.conftest import SMALL

PLAN = Plan(epochs=2, batch_rows=250, rate=0.5, save_steps=1)


@pytest.fixture(scope="module")
def rows(spark):
    return spark.read.parquet(f"{SMALL}/embeddings.parquet").selectExpr("embedding", "int(embedding[0] > 0) as label")


@pytest.fixture(scope="module")
def whole(rows):
    return train(rows, DenseNetwork((64, 8, 2)), ["embedding"], plan=PLAN, ranks=4)


def test_gradients_equal_differences():
    draw = np.random.default_rng(1)
    network = DenseNetwork((5, 4, 3))
    weights, x, y = network.start(2), draw.normal(size=(20, 5)), draw.integers(0, 3, 20)
    _, found = network.gradients(weights, x, y)
    for w, slope in zip(weights, found, strict=True):
        for at in list(np.ndindex(w.shape))[:7]:
            kept, losses = w[at], []
            for d in (1e-6, -1e-6):
                w[at] = kept + d
                losses.append(network.gradients(weights, x, y)[0])
            w[at] = kept
            assert slope[at] == pytest.approx((losses[0] - losses[1]) / 2e-6, abs=1e-4)


def test_one_and_four_ranks_give_the_same_weights(rows, whole):
    alone = train(rows.repartition(3), DenseNetwork((64, 8, 2)), ["embedding"], plan=PLAN, ranks=1)
    assert len(alone.losses) == len(whole.losses) == 4
    for a, b in zip(alone.weights, whole.weights, strict=True):
        np.testing.assert_allclose(a, b, rtol=1e-9, atol=1e-12)


def test_a_lost_run_goes_on_from_its_last_state(spark, rows, whole, tmp_path):
    folder = f"file://{tmp_path}"
    (tmp_path / "die").touch()
    network = DenseNetwork((64, 8, 2))
    with pytest.raises(Exception, match="lost"):
        train(rows, _bound(network, str(tmp_path)), ["embedding"], plan=PLAN, ranks=2, folder=folder)
    left = last_state(folder)
    assert 0 < len(left.losses) < 4
    (tmp_path / "die").unlink()
    done = train(rows, network, ["embedding"], plan=PLAN, ranks=2, folder=folder)
    for a, b in zip(done.weights, whole.weights, strict=True):
        np.testing.assert_allclose(a, b, rtol=1e-9, atol=1e-12)
    assert train(rows, network, ["embedding"], plan=PLAN, ranks=2, folder=folder).losses == done.losses  # nothing left to do


def _bound(network, folder):
    """The network, failing once two states are saved and while the folder's mark is there."""

    class Carried(DenseNetwork):
        def gradients(self, weights, x, y):
            states = sum(name.startswith("state-") for name in os.listdir(folder))
            if states >= 2 and os.path.exists(f"{folder}/die"):
                raise RuntimeError("lost")
            return super().gradients(weights, x, y)

    return Carried(network.sizes)


def test_all_ranks_stop_together_when_patience_ends(rows):
    state = train(rows, DenseNetwork((64, 2)), ["embedding"], plan=Plan(epochs=5, batch_rows=250, rate=0.0, patience=1), ranks=2)
    assert state.stopped and len(state.losses) < 10


def test_steps_without_rows_change_nothing():
    network = DenseNetwork((2, 2))
    state = State(network.start(1), [np.zeros((2, 2)), np.zeros(2)], network.start(1))
    import base64

    empty = base64.b64encode(np.zeros(8).tobytes()).decode()
    advance(state, Plan(), [empty, empty])
    assert state.step == 1 and not state.losses and all((a == b).all() for a, b in zip(state.weights, network.start(1), strict=True))


def test_states_survive_packing(tmp_path):
    network = DenseNetwork((3, 2))
    state = State(network.start(1), network.start(2), network.start(3), 4, 5, 0.25, 6, True, [1.0, 0.25])
    save_state(f"file://{tmp_path}", state)
    again = last_state(f"file://{tmp_path}")
    assert again.pack() == state.pack() and last_state(f"file://{tmp_path}/none") is None


def test_rows_with_nulls_and_no_rows(spark):
    rows = spark.createDataFrame([([1.0, 0.0], 1), (None, 1), ([0.0, 1.0], None), ([0.0, 1.0], 0)], "x array<double>, y int")
    state = train(rows, DenseNetwork((2, 2)), ["x"], "y", Plan(epochs=1), ranks=2)
    assert len(state.losses) == 1
    assert train(rows.limit(0), DenseNetwork((2, 2)), ["x"], "y", Plan(epochs=1), ranks=2).losses == []


def test_network_classifier_takes_the_trainer(rows):
    model = NetworkClassifier(["embedding"], hidden=(), epochs=8, batch_size=1000, train=lambda *x: barrier_training(*x, rate=8.0)).fit(rows)
    assert isinstance(model, BatchModel)
    assert model.transform(rows).where("prediction = label").count() > 0.8 * rows.count()
