"""Registered queries of encoders and models, with SQL where their result is plain arithmetic."""

from __future__ import annotations

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymark.operators import features
from tallymark.operators.characters import CharClassifier, CharNetwork
from tallymark.operators.learners import BatchModel, StackingClassifier, StackingModel, boosted_trees, sparse_logistic, to_bytes
from tallymark.operators.towers import shuffled_pairs, train_towers
from tallymark.operators.trainer import DenseNetwork, Plan, last_state, train
from tallymark.plans.catalog import _APPS, _VOCABULARY_SQL, VOCABULARY, fixed, fixed_sql, register
from tallymark.session import shared_path

_IDS_SQL = f"""
v as (select {_VOCABULARY_SQL} as m),
x as (select doc_id, list_concat(list_concat([1, 5], [coalesce(m[c], 1) for c in string_split(split_part(coalesce(text, ''), ':', 1), '') if c <> '']), [2])[1:64] as ids from documents, v)
"""


def _lines(read) -> DataFrame:
    line = F.concat(F.coalesce("source", F.lit("")), F.lit(":"), F.col("doc_id").cast("string"), F.lit(":"), F.coalesce("text", F.lit("")))
    return read("documents").select("doc_id", F.array(line).alias("data"))


@register(f"with {_IDS_SQL} select doc_id, 64::int as n, list_sum(ids)::bigint as total from x")
def line_vectors(read) -> DataFrame:
    encoder = features.Encoder(features.vocabulary_of(VOCABULARY), max_length=64, lines=len(VOCABULARY))
    found = _lines(read).select("doc_id", vector_to_array(encoder.lines_vector(F.col("data"))).alias("v"))
    return found.select("doc_id", F.size("v").alias("n"), F.aggregate("v", F.lit(0.0), lambda a, x: a + x).cast("long").alias("total"))


def _app_records(read) -> DataFrame:
    each = read("events").groupBy(F.col("user_id").alias("userid"), "event_type").agg(F.count(F.lit(1)).alias("n"))
    record = F.concat_ws(":", "event_type", F.lit("1"), F.col("n").cast("string"), F.lit(""), F.lit("x"))
    return each.groupBy("userid").agg(F.sort_array(F.collect_list(record)).alias("applist"))


def _counts(values: str) -> str:
    return f"with e as (select user_id as userid, event_type, count(*) as n from events group by 1, 2) select userid, {values} from e group by userid"


@register(_counts(", ".join(f"coalesce(max(1.0::double) filter (event_type = '{a}'), 0.0) as has_{a}" for a in _APPS)))
def app_list(read) -> DataFrame:
    encoder = features.Encoder({}, {a: k for k, a in enumerate(_APPS)})
    found = _app_records(read).select("userid", encoder.app_list(F.col("applist")).alias("v"))
    return found.select("userid", *[F.col("v")[k].alias(f"has_{a}") for k, a in enumerate(_APPS)])


_SPARSE = ", ".join(f"coalesce(max(1.0::double) filter (event_type = '{a}'), {1.0 if a == 'click' else 0.0}) as has_{a}, coalesce(max(n::double) filter (event_type = '{a}'), 0.0) as freq_{a}, coalesce(max(1.0::double) filter (event_type = '{a}'), 0.0) as sys_{a}" for a in _APPS)


@register(_counts(_SPARSE))
def app_sparse_with_lines(read) -> DataFrame:
    """Sparse vectors of app records, and of a line whose app is in the list too."""
    encoder = features.Encoder({}, {a: k for k, a in enumerate(_APPS)})
    found = _app_records(read).select("userid", encoder.app_features(F.col("applist"), F.array(F.lit("click:1:x")), sparse=True).alias("f"))
    arrays = features.vectors_to_arrays(found.select("userid", "f.list", "f.freq", "f.sys"), ["list", "freq", "sys"])
    return arrays.select("userid", *[F.col(c)[k].alias(f"{name}_{a}") for k, a in enumerate(_APPS) for c, name in (("list", "has"), ("freq", "freq"), ("sys", "sys"))])


@register(_counts("32::int as n, 1::bigint as ends, coalesce(max(n::double) filter (event_type = 'view'), 0.0) as freq_view"))
def line_encoder_stage(read) -> DataFrame:
    """The encoder as a saved and loaded pipeline stage."""
    rows = _app_records(read).withColumn("data", F.array(F.lit("click:1:x:1")))
    stage = features.LineEncoder(vocabulary=VOCABULARY, appNames=_APPS, maxLength=32)
    path = shared_path(rows.sparkSession, "stage")
    stage.save(path)
    found = features.LineEncoder.load(path).transform(rows)
    ends = F.size(F.filter("data", lambda x: x == features.END)).cast("long")
    return found.select("userid", F.size("data").alias("n"), ends.alias("ends"), vector_to_array("appfreq")[_APPS.index("view")].alias("freq_view"))


@register("select vec_id, len([x for x in embedding if abs(x) > 0.125])::int as stored, 64::int as n from embeddings")
def sparse_vectors(read) -> DataFrame:
    """Lists and dense vectors to sparse ones and back; the count of what is stored does not change."""
    cut = F.transform("embedding", lambda x: F.when(F.abs(x) > 0.125, x.cast("double")).otherwise(0.0))
    rows = read("embeddings").select("vec_id", cut.alias("x"))
    both = rows.select("vec_id", features.list_to_sparse(F.col("x")).alias("a"), features.dense_to_sparse(array_to_vector("x")).alias("b"))
    arrays = features.vectors_to_arrays(both, ["a", "b"]).where("a = b")
    return arrays.select("vec_id", F.size(F.filter("a", lambda x: x != 0)).alias("stored"), F.size("a").alias("n"))


@register(f"select vec_id, {fixed_sql('list_max(embedding::double[])', 6)} as largest from embeddings")
def largest_probability(read) -> DataFrame:
    return read("embeddings").select("vec_id", fixed(features.largest_probability(array_to_vector(F.col("embedding").cast("array<double>"))), 6).alias("largest"))


@register("""
with q as (select embedding as e from embeddings order by vec_id limit 1), s as (select vec_id, list_cosine_similarity(embedding::double[], q.e::double[]) as c from embeddings, q)
select vec_id, case when c >= 0.5 then 1.0::double else 0.0::double end as category from s
""")
def similar_category(read) -> DataFrame:
    vectors = read("embeddings")
    first = vectors.agg(F.min_by("embedding", "vec_id")).first()[0] or []
    one = F.array(*[F.lit(float(x)) for x in first]).cast("array<double>")
    return vectors.select("vec_id", features.is_similar(F.col("embedding"), one).alias("category"))


@register(f"""
with s as (select vec_id, list_sum([embedding[i]::double * (i % 3 - 1) for i in range(1, 65)]) as a, list_sum([embedding[i]::double * (i % 2) for i in range(1, 65)]) as b from embeddings)
select vec_id, case when a >= b then 0.0::double else 1.0::double end as prediction, {fixed_sql("1 / (1 + exp(-abs(a - b)))", 6)} as prob from s
""")
def batch_predict(read) -> DataFrame:
    """A network of one layer, saved, loaded and run a batch at a time on executors."""
    place = np.arange(1, 65)
    model = BatchModel(network=to_bytes([np.stack([place % 3 - 1, place % 2], 1).astype(float)], [np.zeros(2)]), inputCols=["embedding"], batchSize=64)
    rows = read("embeddings").select("vec_id", "embedding")
    path = shared_path(rows.sparkSession, "network")
    model.save(path)
    found = BatchModel.load(path).setBatchSize(100).transform(rows)
    return found.select("vec_id", "prediction", fixed(features.largest_probability(F.col("probability")), 6).alias("prob"))


@register("select count(*) as n, true as logistic, true as trees, true as stacked, true as reloaded from embeddings")
def learners_on_separable_rows(read) -> DataFrame:
    """Labels that one component tells: each learner finds them, and saved models predict as before."""
    rows = read("embeddings").select("vec_id", array_to_vector(F.col("embedding").cast("array<double>")).alias("features"), (F.col("embedding")[0] > 0).cast("double").alias("label"))
    spark = rows.sparkSession
    right = lambda found: found.where("prediction = label").count() / max(found.count(), 1)
    logistic, trees = sparse_logistic(regParam=0.001), boosted_trees(maxIter=3, maxDepth=2, stepSize=0.3)
    stacked = StackingClassifier([logistic, trees], sparse_logistic(regParam=0.001)).fit(rows)
    path = shared_path(spark, "models")
    stacked.save(f"{path}/stacked")
    again = StackingModel.load(f"{path}/stacked").transform(rows)
    simple = Pipeline(stages=[VectorAssembler(inputCols=["features"], outputCol="assembled"), sparse_logistic("assembled", regParam=0.001)]).fit(rows)
    simple.save(f"{path}/simple")
    loaded = PipelineModel.load(f"{path}/simple").transform(rows)
    same = again.select("vec_id", "prediction").exceptAll(stacked.transform(rows).select("vec_id", "prediction")).isEmpty()
    scores = (rows.count(), right(loaded) >= 0.95, right(trees.fit(rows).transform(rows)) >= 0.95, right(again) >= 0.95, same)
    return spark.createDataFrame([scores], "n long, logistic boolean, trees boolean, stacked boolean, reloaded boolean")


@register("select count(*) as n, true as accurate, true as falling, true as kept from embeddings")
def network_by_barrier(read) -> DataFrame:
    """A network trained by all ranks of barrier stages, its states in the shared folder: which side of 0 a component lies on."""
    rows = read("embeddings").select("vec_id", "embedding", (F.col("embedding")[0] > 0).cast("int").alias("label"))
    network, folder = DenseNetwork((64, 2)), shared_path(rows.sparkSession, "network-states")
    state = train(rows, network, ["embedding"], plan=Plan(epochs=16, batch_rows=1 << 20, rate=8.0), folder=folder)
    found = BatchModel(network=network.to_bytes(state.best), inputCols=["embedding"]).transform(rows)
    n, right = found.agg(F.count("*"), F.count_if(F.col("prediction") == F.col("label"))).first()
    scores = (n, right >= 0.95 * n, state.best_loss < 0.5 * state.losses[0], last_state(folder).losses == state.losses)
    return rows.sparkSession.createDataFrame([scores], "n long, accurate boolean, falling boolean, kept boolean")


@register("select count(*) as n, true as accurate, true as of_each from documents where lang is not null")
def character_network(read) -> DataFrame:
    """Languages of whole texts by a network over characters, fitted on three documents of four: of the rest 0.95 are right, of each language 0.75."""
    docs = read("documents").select("doc_id", "text", "lang", (F.pmod(F.xxhash64("doc_id"), F.lit(4)) == 0).alias("held_out"))
    names = sorted(r.lang for r in docs.where("lang is not null").groupBy("lang").count().limit(1001).collect())
    if len(names) > 1000:
        raise ValueError("more than 1000 languages for one layer of outputs")
    labelled = docs.withColumn("label", F.array_position(F.array(*[F.lit(x) for x in names]).cast("array<string>"), F.col("lang")).cast("int") - 1)
    classifier = CharClassifier(CharNetwork(outputs=max(len(names), 2)))
    model = classifier.model(classifier.fit(labelled.where(~F.col("held_out"))))
    each = labelled.where("lang is not null").join(classifier.predict(model, docs, "doc_id"), "doc_id")
    right, held_out = F.count_if(F.col("held_out") & (F.col("prediction") == F.col("label"))), F.count_if("held_out")
    of = each.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), right.alias("right"), held_out.alias("held_out"))
    enough = (F.sum("right") >= 0.95 * F.sum("held_out")).alias("accurate")
    return of.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), F.coalesce(enough, F.lit(True)).alias("accurate"), F.coalesce(F.every(F.col("right") >= 0.75 * F.col("held_out")), F.lit(True)).alias("of_each"))


@register("select count(*) as n, true as apart, true as falling from events where event_type = 'click'")
def two_towers(read) -> DataFrame:
    """Users and what they clicked on: clicked pairs have a mean similarity at least 0.1 above that of shuffled ones, drawn anew."""
    clicks = read("events").where("event_type = 'click'").select("user_id", F.get_json_object("props", "$.k").alias("k"))
    towers = train_towers(clicks, "user_id", "k")
    own = towers.pairs
    mean = lambda pairs: towers.similarity(pairs).agg(F.avg("similarity")).first()[0] or 0.0
    none = not towers.losses
    scores = (clicks.count(), none or mean(own) >= mean(shuffled_pairs(own, 1, seed=1009)) + 0.1, none or towers.losses[-1] < towers.losses[0])
    return clicks.sparkSession.createDataFrame([scores], "n long, apart boolean, falling boolean")
