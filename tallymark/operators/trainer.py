"""Data-parallel training of numpy networks in barrier stages.

A row belongs to a step of an epoch by its hash, whatever partition holds it, so any number of ranks walks
through the same batches. Each rank reads its rows in the order of steps (sorted on disk where memory ends),
adds up gradients a bounded block at a time, and shares the sums by ``BarrierTaskContext.allGather``; every
rank adds them in rank order and takes the same step. Loss, patience and the best weights follow from what is
shared, so all ranks stop at the same step.

The state (weights, momentum, best loss so far, patience used) goes to a file in the shared folder every
``save_steps`` steps and after each epoch. A run that finds such files goes on from the last one: the epoch's rows before
its step are filtered out. A barrier stage that loses an executor is repeated from the state it began with.

Spark's barrier takes about a second, so a step should have that much work: ``batch_rows`` is the rows of all ranks.
"""

from __future__ import annotations

import base64
import io
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass, field
from typing import Protocol

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import BarrierTaskContext
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from tallymark.operators.learners import probabilities, to_bytes
from tallymark.session import shared_path, ship_package, staged

#: Rows whose gradients are computed at once.
BLOCK_ROWS = 2048
#: Spark's setting by which shuffle files are deleted at the end of their query.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


class Network(Protocol):
    """What the trainer asks of a network."""

    def start(self, seed: int) -> list[np.ndarray]: ...

    def gradients(self, weights: list[np.ndarray], x: np.ndarray, y: np.ndarray) -> tuple[float, list[np.ndarray]]:
        """The sum of the rows' losses, and its gradients."""
        ...


def loss_and_slope(raw: np.ndarray, y: np.ndarray) -> tuple[float, np.ndarray]:
    """Cross entropy summed over rows of raw outputs, and its slope by them."""
    p = probabilities(raw)
    rows = np.arange(len(y))
    loss = -np.log(np.maximum(p[rows, y], 1e-300)).sum()
    p[rows, y] -= 1
    return float(loss), p


@dataclass(frozen=True)
class DenseNetwork:
    """Layers with ReLU between them; weights and biases alternate."""

    sizes: tuple[int, ...]

    def start(self, seed: int) -> list[np.ndarray]:
        draw = np.random.default_rng(seed)
        return [x for a, b in zip(self.sizes, self.sizes[1:], strict=False) for x in (draw.normal(0, np.sqrt(2 / a), (a, b)), np.zeros(b))]

    def gradients(self, weights: list[np.ndarray], x: np.ndarray, y: np.ndarray) -> tuple[float, list[np.ndarray]]:
        inputs = []
        for k in range(0, len(weights), 2):
            inputs.append(x)
            x = x @ weights[k] + weights[k + 1]
            x = np.maximum(x, 0) if k + 2 < len(weights) else x
        loss, slope = loss_and_slope(x, y)
        found: list[np.ndarray] = []
        for k in range(len(weights) - 2, -1, -2):
            found = [inputs[k // 2].T @ slope, slope.sum(0), *found]
            slope = (slope @ weights[k].T) * (inputs[k // 2] > 0)
        return loss, found

    def to_bytes(self, weights: list[np.ndarray]) -> bytes:
        return to_bytes(weights[::2], weights[1::2])


@dataclass
class State:
    """Where training stands: the next step, weights, momentum, the best weights and the steps without a better loss."""

    weights: list[np.ndarray]
    speed: list[np.ndarray]
    best: list[np.ndarray]
    epoch: int = 0
    step: int = 0
    best_loss: float = float("inf")
    waited: int = 0
    stopped: bool = False
    losses: list[float] = field(default_factory=list)

    def pack(self) -> bytes:
        out = io.BytesIO()
        arrays = {f"{name}{k}": x for name in ("weights", "speed", "best") for k, x in enumerate(getattr(self, name))}
        np.savez(out, n=len(self.weights), at=[self.epoch, self.step, self.waited, self.stopped], loss=self.best_loss, losses=self.losses, **arrays)
        return out.getvalue()

    @classmethod
    def unpack(cls, data: bytes) -> State:
        found = np.load(io.BytesIO(data))
        lists = [[found[f"{name}{k}"] for k in range(int(found["n"]))] for name in ("weights", "speed", "best")]
        epoch, step, waited, stopped = (int(x) for x in found["at"])
        return cls(*lists, epoch, step, float(found["loss"]), waited, bool(stopped), found["losses"].tolist())


@dataclass(frozen=True)
class Plan:
    """How to train."""

    epochs: int = 10
    batch_rows: int = 1000
    rate: float = 0.05
    momentum: float = 0.9
    patience: int = 10_000
    save_steps: int = 1000
    seed: int = 17


def save_state(folder: str, state: State) -> None:
    """A file appears under its name only when it is whole."""
    system, base = fs.FileSystem.from_uri(folder)
    system.create_dir(base, recursive=True)
    part = f"{base}/part-{uuid.uuid4().hex}"
    with system.open_output_stream(part) as file:
        file.write(state.pack())
    system.move(part, f"{base}/state-{state.epoch:08d}-{state.step:012d}")


def last_state(folder: str) -> State | None:
    system, base = fs.FileSystem.from_uri(folder)
    names = sorted(x.path for x in system.get_file_info(fs.FileSelector(base, allow_not_found=True)) if x.base_name.startswith("state-"))
    if not names:
        return None
    with system.open_input_stream(names[-1]) as file:
        return State.unpack(file.read())


class _Step:
    """A rank's sums over the rows of one step."""

    def __init__(self, weights: list[np.ndarray]):
        self.sums, self.loss, self.rows = [np.zeros_like(w) for w in weights], 0.0, 0

    def add(self, network: Network, weights: list[np.ndarray], x: np.ndarray, y: np.ndarray) -> None:
        for k in range(0, len(y), BLOCK_ROWS):
            loss, found = network.gradients(weights, x[k : k + BLOCK_ROWS], y[k : k + BLOCK_ROWS])
            self.loss += loss
            for total, more in zip(self.sums, found, strict=True):
                total += more
        self.rows += len(y)

    def message(self) -> str:
        return base64.b64encode(np.concatenate([[self.loss, self.rows], *[x.ravel() for x in self.sums]]).tobytes()).decode()


def advance(state: State, plan: Plan, messages: list[str]) -> None:
    """One step of every rank: the same sums in the same order give the same weights everywhere."""
    total = sum(np.frombuffer(base64.b64decode(m)) for m in messages)
    loss, rows = total[0], total[1]
    state.step += 1
    if not rows:
        return
    at = 2
    before = [w.copy() for w in state.weights]
    for k, w in enumerate(state.weights):
        slope = total[at : at + w.size].reshape(w.shape) / rows
        at += w.size
        state.speed[k] = plan.momentum * state.speed[k] - plan.rate * slope
        state.weights[k] = w + state.speed[k]
    state.losses.append(float(loss / rows))
    if state.losses[-1] < state.best_loss:
        state.best_loss, state.best, state.waited = state.losses[-1], before, 0
    else:
        state.waited += 1
        state.stopped = state.waited > plan.patience


def _epoch(network: Network, plan: Plan, packed: bytes, steps: int, folder: str):
    """Within a rank: all steps of an epoch from the state's on; every rank returns the state, packed by the first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context, state = BarrierTaskContext.get(), State.unpack(packed)
        rank = context.partitionId()
        own = _Step(state.weights)

        def close() -> None:
            nonlocal own
            advance(state, plan, context.allGather(own.message()))
            own = _Step(state.weights)
            if rank == 0 and state.step % plan.save_steps == 0 and state.step < steps and not state.stopped:
                save_state(folder, state)

        for batch in batches:
            step = batch.column(0).to_numpy()
            y = batch.column(2).to_numpy().astype(np.int64)
            x = np.stack(batch.column(1).to_numpy(zero_copy_only=False)) if len(y) else np.zeros((0, 0))
            for low, high in _runs(step):
                while state.step < step[low] and not state.stopped:
                    close()
                if state.stopped:
                    break
                own.add(network, state.weights, x[low:high], y[low:high])
            if state.stopped:
                break
        while state.step < steps and not state.stopped:
            close()
        yield pa.RecordBatch.from_arrays([pa.array([rank], pa.int32()), pa.array([state.pack() if rank == 0 else None], pa.binary())], names=["rank", "state"])

    return run


def _runs(values: np.ndarray) -> Iterator[tuple[int, int]]:
    ends = [*(np.flatnonzero(values[1:] != values[:-1]) + 1).tolist(), len(values)] if len(values) else []
    yield from zip([0, *ends], ends, strict=False)


def _numbers(frame: DataFrame, name: str) -> Column:
    kind = frame.schema[name].dataType
    if isinstance(kind, VectorUDT):
        return vector_to_array(name)
    if kind.typeName() == "array":
        return F.col(name) if isinstance(kind.elementType, IntegralType) else F.col(name).cast("array<double>")
    return F.array(F.col(name).cast("double"))


def train(frame: DataFrame, network: Network, inputs: list[str], label: str = "label", plan: Plan = Plan(), ranks: int | None = None, folder: str | None = None) -> State:  # noqa: B008
    """Train a network on rows whose inputs and label are not null; ``best`` holds the weights of the least loss.

    ranks: tasks that run at once (the session's parallelism). folder: where states are kept and looked for.
    """
    spark = frame.sparkSession
    ship_package(spark)
    ranks, folder = ranks or spark.sparkContext.defaultParallelism, folder or shared_path(spark, "training")
    state = last_state(folder)
    if state is not None and (state.stopped or state.epoch >= plan.epochs):
        return state
    rows = frame.select(F.concat(*[_numbers(frame, x) for x in inputs]).alias("x"), F.col(label).cast("int").alias("y"))
    rows = staged(rows.where("x is not null and y is not null"), "training-rows")
    steps = max(1, -(-rows.count() // plan.batch_rows))
    if state is None:
        weights = network.start(plan.seed)
        state = State(weights, [np.zeros_like(w) for w in weights], weights)
    with _shuffles_deleted(spark):
        while state.epoch < plan.epochs and not state.stopped:
            step = F.pmod(F.xxhash64(F.col("x").cast("array<double>"), "y", F.lit(plan.seed), F.lit(state.epoch)), F.lit(steps)).alias("step")  # the same for whole numbers of any type
            own = rows.select(step, "x", "y").where(F.col("step") >= state.step).repartition(ranks).sortWithinPartitions("step")
            found = own.mapInArrow(_epoch(network, plan, state.pack(), steps, folder), "rank int, state binary", barrier=True)
            packed = next((r.state for r in found.collect() if r.state is not None), None)
            if packed is not None:  # None: no row is left, so Spark ran no task
                state = State.unpack(packed)
            if not state.stopped:
                state.epoch, state.step = state.epoch + 1, 0
            save_state(folder, state)
    return state


@contextmanager
def _shuffles_deleted(spark: SparkSession) -> Iterator[None]:
    """Within, a query's shuffle files go when it ends: each epoch deals all rows out anew."""
    kept = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.unset(CLEANUP) if kept is None else spark.conf.set(CLEANUP, kept)


def barrier_training(rows: DataFrame, options: dict, rate: float = 0.05) -> bytes:
    """A function for ``NetworkClassifier(train=...)``: a dense network, fitted by ``train``, as npz bytes."""
    first = rows.select(F.size(F.concat(*[_numbers(rows, x) for x in options["input_cols"]]))).first()
    network = DenseNetwork((first[0] if first else 1, *options["hidden"], options["classes"]))
    plan = Plan(epochs=options["epochs"], batch_rows=options["batch_size"], rate=rate, seed=options["seed"])
    return network.to_bytes(train(rows, network, options["input_cols"], options["label"], plan).best)
