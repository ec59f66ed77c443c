"""Classifiers: stacking, and batch prediction by a model that travels as bytes."""

from __future__ import annotations

import base64
import io
import json
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark import keyword_only
from pyspark.ml import Estimator, Model, Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import HashingTF, NGram, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import MapType

from tallymark.operators.features import largest_probability
from tallymark.session import ship_package

STACKED = "_stacking_features"


def _renamed(stage, k: int):
    """A base learner or model whose outputs are numbered."""
    return stage.copy({stage.rawPredictionCol: f"_rawPred_{k}", stage.predictionCol: f"_pred_{k}", stage.probabilityCol: f"_prob_{k}"})


class StackingModel(Model, MLWritable, MLReadable):
    """Base models, then a model of their probabilities; ``prob`` is the largest of its probabilities."""

    def __init__(self, models: PipelineModel | None = None, meta_model: PipelineModel | None = None):
        super().__init__()
        self.models, self.meta_model = models, meta_model

    def _transform(self, dataset: DataFrame) -> DataFrame:
        found = self.meta_model.transform(self.models.transform(dataset))
        inner = [c for c in found.columns if c == STACKED or c.startswith(("_rawPred_", "_pred_", "_prob_"))]
        return found.withColumn("prob", largest_probability(F.col("probability"))).drop(*inner)

    def write(self) -> MLWriter:
        return _StackingWriter(self)

    @classmethod
    def read(cls) -> MLReader:
        return _StackingReader()


class _StackingWriter(MLWriter):
    def __init__(self, model: StackingModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        for name, part in (("models", self.model.models), ("meta_model", self.model.meta_model)):
            writer = part.write()
            (writer.overwrite() if self.shouldOverwrite else writer).save(f"{path}/{name}")


class _StackingReader(MLReader):
    def load(self, path: str) -> StackingModel:
        return StackingModel(PipelineModel.load(f"{path}/models"), PipelineModel.load(f"{path}/meta_model"))


class StackingClassifier(Estimator):
    """Fits base classifiers on a frame and a meta classifier on their probabilities.

    ``folds`` of 0 fits both on the same rows. With more, the meta classifier learns from
    probabilities of base models that did not see the row, and the base models are then fitted on all.
    """

    def __init__(self, classifiers: list[Estimator], meta_classifier: Estimator, folds: int = 0, seed: int = 17):
        super().__init__()
        self.classifiers, self.meta_classifier, self.folds, self.seed = classifiers, meta_classifier, folds, seed

    def _fit(self, dataset: DataFrame) -> StackingModel:
        bases = [_renamed(c, k) for k, c in enumerate(self.classifiers)]
        fit = lambda rows: PipelineModel([b.fit(rows) for b in bases])
        models = fit(dataset)
        if self.folds:
            # By hash, so that folds are the same however often and in what order the rows are read.
            hashed = [F.col(f"`{c.name}`") for c in dataset.schema if not isinstance(c.dataType, MapType)]
            fold = F.pmod(F.xxhash64(F.lit(self.seed), *hashed), F.lit(self.folds))
            parts = [dataset.where(fold == k) for k in range(self.folds)]
            scored = None
            for k, part in enumerate(parts):
                others = [p for j, p in enumerate(parts) if j != k]
                rest = others[0]
                for p in others[1:]:
                    rest = rest.unionByName(p)
                own = fit(rest).transform(part)
                scored = own if scored is None else scored.unionByName(own)
        else:
            scored = models.transform(dataset)
        assembler = VectorAssembler(inputCols=[f"_prob_{k}" for k in range(len(bases))], outputCol=STACKED)
        meta = self.meta_classifier.copy({self.meta_classifier.featuresCol: STACKED})
        return StackingModel(models, Pipeline(stages=[assembler, meta]).fit(scored))


def boosted_trees(features: str = "features", label: str = "label", **options) -> GBTClassifier:
    return GBTClassifier(featuresCol=features, labelCol=label, **({"stepSize": 0.05, "maxIter": 100, "maxDepth": 5, "seed": 17} | options))


def sparse_logistic(features: str = "features", label: str = "label", **options) -> LogisticRegression:
    return LogisticRegression(featuresCol=features, labelCol=label, **({"regParam": 0.1, "elasticNetParam": 1.0} | options))


def gram_classifier(ids: str = "data", label: str = "label", widths: tuple[int, ...] = (3, 5, 7), size: int = 1 << 16) -> Pipeline:
    """Hashed n-grams of an array<string> of tokens, of each width, into logistic regression."""
    stages = []
    for n in widths:
        stages += [NGram(n=n, inputCol=ids, outputCol=f"_grams_{n}"), HashingTF(numFeatures=size, inputCol=f"_grams_{n}", outputCol=f"_hashed_{n}")]
    assembler = VectorAssembler(inputCols=[f"_hashed_{n}" for n in widths], outputCol="_gram_features")
    return Pipeline(stages=[*stages, assembler, LogisticRegression(featuresCol="_gram_features", labelCol=label, regParam=0.01)])


def to_bytes(weights: list[np.ndarray], biases: list[np.ndarray]) -> bytes:
    """A feed-forward network's arrays as npz bytes."""
    out = io.BytesIO()
    np.savez(out, n=len(weights), **{f"w{k}": w for k, w in enumerate(weights)}, **{f"b{k}": b for k, b in enumerate(biases)})
    return out.getvalue()


def _network(data: bytes):
    """A function from a batch of features to raw outputs: an npz network with ReLU or over characters, or an ONNX model."""
    if data[:2] == b"PK":
        found = np.load(io.BytesIO(data))
        if "characters" in found:
            from tallymark.operators.characters import CharNetwork

            return CharNetwork.runner(found)
        layers = [(found[f"w{k}"], found[f"b{k}"]) for k in range(int(found["n"]))]

        def run(x: np.ndarray) -> np.ndarray:
            for k, (w, b) in enumerate(layers):
                x = x @ w + b
                x = np.maximum(x, 0) if k + 1 < len(layers) else x
            return x

        return run
    import onnxruntime

    session = onnxruntime.InferenceSession(data, providers=["CPUExecutionProvider"])
    name = session.get_inputs()[0].name
    return lambda x: session.run(None, {name: x.astype(np.float32)})[0]


def probabilities(raw: np.ndarray) -> np.ndarray:
    """Rows of raw outputs as probabilities: softmax, or for one output a sigmoid's two classes."""
    if raw.shape[1] == 1:
        p = 1 / (1 + np.exp(-raw[:, 0]))
        return np.stack([1 - p, p], 1)
    e = np.exp(raw - raw.max(1, keepdims=True))
    return e / e.sum(1, keepdims=True)


class BatchModel(Model, DefaultParamsReadable, DefaultParamsWritable):
    """Adds rawPrediction, prediction and probability by a network on executors, a batch at a time.

    Input columns are numbers, arrays or vectors, joined to one feature row; a null counts as no
    finite value and is an error, as is a failing batch.
    """

    network = Param(Params._dummy(), "network", "the model's bytes in base 64", TypeConverters.toString)
    inputCols = Param(Params._dummy(), "inputCols", "feature columns", TypeConverters.toListString)
    batchSize = Param(Params._dummy(), "batchSize", "rows of a batch", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, network=None, inputCols=None, batchSize=1000):
        super().__init__()
        self._setDefault(batchSize=1000)
        given = dict(self._input_kwargs)
        if isinstance(given.get("network"), bytes):
            given["network"] = base64.b64encode(given["network"]).decode()
        self._set(**given)

    def setBatchSize(self, value: int) -> BatchModel:
        return self._set(batchSize=value)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        ship_package(dataset.sparkSession)
        data, size = base64.b64decode(self.getOrDefault(self.network)), self.getOrDefault(self.batchSize)
        columns = []
        for name in self.getOrDefault(self.inputCols):
            kind = dataset.schema[name].dataType
            if isinstance(kind, VectorUDT):
                columns.append(vector_to_array(name))
            elif kind.typeName() == "array":
                columns.append(F.col(name).cast("array<double>"))
            else:
                columns.append(F.array(F.col(name).cast("double")))

        @F.pandas_udf("raw array<double>, prob array<double>")
        def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
            run = _network(data)
            for batch in batches:
                raws = [np.asarray(run(np.stack(batch.iloc[k : k + size].to_list()))) for k in range(0, len(batch), size)]
                raw = np.concatenate([x.reshape(len(x), -1) for x in raws]) if raws else np.zeros((0, 1))
                yield pd.DataFrame({"raw": list(raw.astype(float)), "prob": list(probabilities(raw.astype(float)))})

        found = dataset.withColumn("_predicted", predict(F.concat(*columns)))
        first = (F.array_position("_predicted.prob", F.array_max("_predicted.prob")) - 1).cast("double")
        return found.withColumns({"rawPrediction": array_to_vector("_predicted.raw"), "prediction": first, "probability": array_to_vector("_predicted.prob")}).drop("_predicted")


class NetworkClassifier(Estimator):
    """A multi-layer network behind one interface: fitted by Spark, or by ``train`` on a distributor.

    train: a function of (frame, options) that returns the network's bytes for BatchModel, such as one
    that runs a GPU framework. Without it, Spark's multilayer perceptron is fitted.
    """

    def __init__(self, input_cols: list[str], label: str = "label", hidden: tuple[int, ...] = (16,), classes: int = 2, epochs: int = 100, batch_size: int = 1000, train=None, seed: int = 17):
        super().__init__()
        self.input_cols, self.label, self.hidden, self.classes, self.epochs, self.batch_size, self.train, self.seed = input_cols, label, hidden, classes, epochs, batch_size, train, seed

    @classmethod
    def from_conf(cls, conf: dict | str) -> NetworkClassifier:
        return cls(**(json.loads(conf) if isinstance(conf, str) else conf))

    def _fit(self, dataset: DataFrame) -> Model:
        if self.train is not None:
            return BatchModel(network=self.train(dataset, vars(self)), inputCols=self.input_cols, batchSize=self.batch_size)
        from pyspark.ml.classification import MultilayerPerceptronClassifier

        assembler = VectorAssembler(inputCols=self.input_cols, outputCol="_network_features")
        width = assembler.transform(dataset).select(F.size(vector_to_array("_network_features"))).first()[0]
        network = MultilayerPerceptronClassifier(featuresCol="_network_features", labelCol=self.label, layers=[width, *self.hidden, self.classes], maxIter=self.epochs, seed=self.seed)
        return Pipeline(stages=[assembler, network]).fit(dataset)
