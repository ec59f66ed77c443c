"""A character network: embeddings, convolutions of several widths, the largest value of each channel, a dense layer.

Whole texts of any length are cut into overlapping windows of one size, each a row of character codes; windows overlap by
one character less than the widest convolution, so each run of characters that it can see lies in some window. A text's
prediction is the class with the largest sum of its windows' log probabilities.

``CharNetwork`` is trained by ``trainer.train`` and applied by ``learners.BatchModel``. A convolution is looked up, not
multiplied out: a character's share of a channel is one entry of (characters x channels) for each place of the kernel, and
shares are summed once for each different run of three characters in a block of rows, of which there are few in text.
There is no dropout, as gradients must not depend on the rank that computes them.

Null and empty texts have one window of padding only. Codes of characters beyond the table fall together with others.
"""

from __future__ import annotations

import io
from collections.abc import Iterator
from dataclasses import dataclass, replace
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymark.operators.learners import BatchModel
from tallymark.operators.trainer import Plan, State, loss_and_slope, train
from tallymark.session import ship_active

#: Rows that are convolved at once.
BLOCK = 1024
#: Characters of a run whose shares are summed once a block.
RUN = 3
#: Keys that are numbered by a table of all that there may be; beyond, by sorting.
TABLE = 1 << 21
#: Codes of windows that a batch holds before it is handed on; a text's windows stay together.
CODES = 1 << 20


class Runs(NamedTuple):
    """The different runs of characters of one width in a block of rows, and which of them begins at each place of each row."""

    codes: np.ndarray
    at: np.ndarray


def _numbered(keys: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The different keys below ``size`` in order, and the number of each key among them."""
    if size > TABLE:
        found, number = np.unique(keys, return_inverse=True)
        return found, number.reshape(keys.shape).astype(np.int32)
    marked = np.zeros(size, bool)
    marked[keys] = True
    found = np.flatnonzero(marked)
    numbers = np.empty(size, np.int32)
    numbers[found] = np.arange(len(found))
    return found, numbers[keys]


def _runs_of(ids: np.ndarray, widest: int) -> list[Runs]:
    """Runs of 1 to RUN characters, or to the widest; a run is numbered by that of one character less and its last."""
    ids = np.ascontiguousarray(ids.T)
    letters, own = _numbered(ids, int(ids.max(initial=0)) + 1)
    found = [Runs(letters[:, None], own)]
    for width in range(2, min(RUN, widest) + 1):
        codes, at = found[-1]
        keys, at = _numbered(at[:-1].astype(np.int64) * len(letters) + own[width - 1 :], len(codes) * len(letters))
        found.append(Runs(np.column_stack([codes[keys // len(letters)], letters[keys % len(letters)]]), at))
    return found


def _largest(tables: list[tuple[np.ndarray, np.ndarray]], places: int, where: bool) -> tuple[np.ndarray, np.ndarray | None]:
    """Each row's largest sums of the tables' entries over its places, and the first place of each, if asked for."""
    kind = np.min_scalar_type(places)
    rows, channels = tables[0][1].shape[1], tables[0][0].shape[1]
    best = np.full((rows, channels), -np.inf)
    sums, more, larger = np.empty_like(best), np.empty_like(best), np.empty(best.shape, bool)
    found = np.zeros((rows, channels), kind) if where else None
    for place in range(places):
        for k, (table, at) in enumerate(tables):
            np.take(table, at[place], 0, out=more if k else sums, mode="clip")  # numbers are in range; to raise, it would copy
            if k:
                sums += more
        if where:
            np.greater(sums, best, out=larger)
            np.maximum(found, larger * kind.type(place), out=found)
        np.maximum(best, sums, out=best)
    return best, found if found is None else found.astype(np.int64)


@dataclass(frozen=True)
class CharNetwork:
    """Codes 0 to chars - 1 to raw outputs; weights are the embeddings, a kernel and bias a width, and the dense layer's two."""

    chars: int = 1024
    outputs: int = 2
    widths: tuple[int, ...] = (3, 5)
    embed: int = 16
    channels: int = 16

    def start(self, seed: int) -> list[np.ndarray]:
        draw = np.random.default_rng(seed)
        kernels = [x for w in self.widths for x in (draw.normal(0, 1 / np.sqrt(w * self.embed), (w, self.embed, self.channels)), np.zeros(self.channels))]
        inputs = self.channels * len(self.widths)
        return [draw.normal(0, 0.5, (self.chars, self.embed)), *kernels, draw.normal(0, 1 / np.sqrt(inputs), (inputs, self.outputs)), np.zeros(self.outputs)]

    def pooled(self, weights: list[np.ndarray], ids: np.ndarray, places: bool = False) -> tuple[np.ndarray, list[np.ndarray]]:
        """Each channel's largest value (rows x channels of all widths), and where its kernel begins there, if asked for."""
        runs, values, found = _runs_of(ids, max(self.widths)), [], []
        for k, width in enumerate(self.widths):
            tables = []
            for start in range(0, width, RUN):
                own = runs[min(RUN, width - start) - 1]
                shares = sum((weights[0] @ weights[1 + 2 * k][start + at])[own.codes[:, at]] for at in range(own.codes.shape[1]))
                tables.append((shares, own.at[start:]))
            best, place = _largest(tables, ids.shape[1] - width + 1, places)
            values.append(best + weights[2 + 2 * k])
            found.append(place)
        return np.concatenate(values, 1), found

    def forward(self, weights: list[np.ndarray], x: np.ndarray) -> np.ndarray:
        ids = x.astype(np.int32)
        parts = [self.pooled(weights, ids[a : a + BLOCK])[0] @ weights[-2] + weights[-1] for a in range(0, len(ids), BLOCK)]
        return np.concatenate(parts) if parts else np.zeros((0, self.outputs))

    def gradients(self, weights: list[np.ndarray], x: np.ndarray, y: np.ndarray) -> tuple[float, list[np.ndarray]]:
        total, found = 0.0, [np.zeros_like(w) for w in weights]
        channel = np.arange(self.channels)
        for a in range(0, len(y), BLOCK):
            ids = x[a : a + BLOCK].astype(np.int32)
            values, places = self.pooled(weights, ids, places=True)
            loss, slope = loss_and_slope(values @ weights[-2] + weights[-1], y[a : a + BLOCK])
            total += loss
            found[-2] += values.T @ slope
            found[-1] += slope.sum(0)
            back = slope @ weights[-2].T
            for k, width in enumerate(self.widths):
                own = back[:, k * self.channels : (k + 1) * self.channels]
                found[2 + 2 * k] += own.sum(0)
                for at in range(width):
                    codes = np.take_along_axis(ids, places[k] + at, 1).astype(np.int64)  # the character that each channel saw
                    shares = np.bincount((codes * self.channels + channel).ravel(), own.ravel(), self.chars * self.channels).reshape(-1, self.channels)
                    found[1 + 2 * k][at] += weights[0].T @ shares
                    found[0] += shares @ weights[1 + 2 * k][at].T
        return total, found

    def to_bytes(self, weights: list[np.ndarray]) -> bytes:
        out = io.BytesIO()
        np.savez(out, characters=len(weights), widths=self.widths, **{f"a{k}": w for k, w in enumerate(weights)})
        return out.getvalue()

    @staticmethod
    def runner(found):
        """A function from rows of codes to raw outputs, of a network's loaded file."""
        weights = [found[f"a{k}"] for k in range(int(found["characters"]))]
        chars, embed = weights[0].shape
        network = CharNetwork(chars, len(weights[-1]), tuple(int(w) for w in found["widths"]), embed, len(weights[2]))
        return lambda x: network.forward(weights, x)


def _windows(text: str | None, size: int, step: int, chars: int) -> np.ndarray:
    """A text's windows as rows."""
    points = np.frombuffer((text or "").encode("utf-32-le"), "<u4")
    n = max(1, -(-(len(points) - (size - step)) // step))
    codes = np.zeros((n - 1) * step + size, np.int32)
    codes[: len(points)] = 1 + points % (chars - 1)
    return np.lib.stride_tricks.sliding_window_view(codes, size)[::step]


def _nested(windows: list[np.ndarray], size: int) -> pa.Array:
    ends = np.cumsum([0, *[len(w) for w in windows]])
    rows = pa.ListArray.from_arrays(pa.array(np.arange(ends[-1] + 1) * size, pa.int32()), pa.array(np.concatenate(windows).ravel()))
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), rows)


def character_windows(text: Column, size: int = 256, widest: int = 5, chars: int = 1024) -> Column:
    """array<array<int>>: the windows of a text, each ``size`` codes; 0 pads, a character's code is 1 and up."""
    step = size - widest + 1
    ship_active()

    @F.arrow_udf("array<array<int>>")
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            own, held = [], 0
            for x in batch:
                own.append(_windows(x.as_py(), size, step, chars))
                held += own[-1].size
                if held >= CODES:
                    yield _nested(own, size)
                    own, held = [], 0
            if own:
                yield _nested(own, size)

    return run(text.cast("string"))


def window_count(text: Column, size: int, widest: int) -> Column:
    """How many windows character_windows gives."""
    return F.greatest(F.ceil((F.length(F.coalesce(text, F.lit(""))) - F.lit(widest - 1)) / (size - widest + 1)), F.lit(1))


def windows_of(frame: DataFrame, text_col: str, size: int, widest: int, chars: int) -> DataFrame:
    """The rows of frame without the text, one for each window, which is column ``window``."""
    kept = [c for c in frame.columns if c != text_col]
    return frame.select(*kept, F.explode(character_windows(F.col(text_col), size, widest, chars)).alias("window"))


@dataclass
class CharClassifier:
    """Tells a class of whole texts; fitted on all their windows, in ``steps`` steps an epoch however many there are."""

    network: CharNetwork
    size: int = 256
    steps: int = 6
    plan: Plan = Plan(epochs=5, rate=0.1)

    def fit(self, frame: DataFrame, text_col: str = "text", label: str = "label", ranks: int | None = None, folder: str | None = None) -> State:
        """Train on (text, label); labels are 0 to outputs - 1, null ones are left out."""
        labelled = frame.where(F.col(label).isNotNull()).select(F.col(text_col).alias("text"), F.col(label).cast("int").alias("label"))
        widest = max(self.network.widths)
        rows = windows_of(labelled, "text", self.size, widest, self.network.chars)
        if self.network.chars <= 1 << 15:
            rows = rows.withColumn("window", F.col("window").cast("array<smallint>"))  # half as much to deal out each epoch
        n = labelled.agg(F.sum(window_count(F.col("text"), self.size, widest))).first()[0] or 0
        return train(rows, self.network, ["window"], "label", replace(self.plan, batch_rows=max(1, -(-n // self.steps))), ranks, folder)

    def model(self, state: State) -> BatchModel:
        return BatchModel(network=self.network.to_bytes(state.best), inputCols=["window"])

    def predict(self, model: BatchModel, frame: DataFrame, id_col: str, text_col: str = "text") -> DataFrame:
        """(id, prediction int) for every row's whole text; rows that share an identifier are one text's parts."""
        rows = windows_of(frame.select(id_col, F.col(text_col).alias("text")), "text", self.size, max(self.network.widths), self.network.chars)
        each = model.transform(rows).select(id_col, vector_to_array("probability").alias("p"))
        sums = [F.sum(F.log(F.greatest(F.col("p")[k], F.lit(1e-300)))).alias(f"s{k}") for k in range(self.network.outputs)]
        scores = F.array(*[F.col(f"s{k}") for k in range(self.network.outputs)])
        return each.groupBy(id_col).agg(*sums).select(id_col, (F.array_position(scores, F.array_max(scores)) - 1).cast("int").alias("prediction"))
