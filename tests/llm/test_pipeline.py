import random
import string

import corpus_pipeline
from tallymark.llm.exact_dedup import exact_dedup
from tallymark.llm.language import identify_language
from tallymark.llm.mixing import mix_sources
from tallymark.llm.simhash import simhash_near_dedup
from tests.conftest import SMALL
from tallymark.llm.simhash import first_of_near_copies
from tests.llm.common import AWKWARD, documents


def test_each_stage_applies_its_decisions(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    columns = docs.columns
    stages = dict(corpus_pipeline.STAGES)
    ids = lambda frame: sorted(r.doc_id for r in frame.select("doc_id").collect())
    a = stages["language_id"](spark, docs, SMALL)
    assert ids(a) == sorted(r.doc_id for r in identify_language(docs).collect() if r.lang_pred != "und" and r.score >= corpus_pipeline.MIN_LANGUAGE_SCORE)
    b = stages["exact_dedup"](spark, a, SMALL)
    assert ids(b) == sorted(r.doc_id for r in exact_dedup(a).collect() if r.kept)
    c = stages["simhash_near_dedup"](spark, b, SMALL)
    assert ids(c) == sorted({r.component_id for r in simhash_near_dedup(b, words=5, similarity=0.8).collect()})
    d = stages["mixing"](spark, c, SMALL)
    taken = sum(r.taken for r in mix_sources(c).collect())
    assert sum(len(r.text.split()) for r in d.collect()) == taken
    assert a.columns == b.columns == c.columns == d.columns == columns
    e = stages["packing"](spark, d, SMALL)
    assert e.count() >= d.count()


def test_stages_are_the_five_dealt_ones():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "exact_dedup", "simhash_near_dedup", "mixing", "packing"]


def test_one_row_of_each_group_stays_whatever_the_identifiers(spark):
    rows = [(1, "x"), (1, "x"), (2, "x"), (None, "y"), (None, "y"), (3, "x z"), (3, "x z "), (3, None), (4, " ")]
    docs = documents(spark, rows, ("n_bytes", "points", "gone_id", "_text"))
    kept = corpus_pipeline.exact_copies(spark, docs.repartition(3), "")
    assert kept.columns == docs.columns
    assert sorted(((r.doc_id or 0, r.text, r.gone_id) for r in kept.collect()), key=repr) == sorted([(1, "x", 1), (0, "y", 1), (3, "x z ", 1), (4, " ", 1)], key=repr)
    near = corpus_pipeline.near_copies(spark, kept, "")
    assert near.columns == docs.columns and near.count() == 4


def test_whole_run_and_awkward_rows(spark, tmp_path):
    documents(spark, AWKWARD).write.parquet(f"{tmp_path}/documents.parquet")
    rows = corpus_pipeline.run(spark, str(tmp_path)).collect()
    assert rows and all(r.length > 0 for r in rows)


def test_empty_table(spark, tmp_path):
    documents(spark, []).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


FOREIGN = [
    "Kaikki ihmiset syntyvät vapaina ja tasavertaisina arvoltaan ja oikeuksiltaan. Heille on annettu järki ja omatunto, ja heidän on toimittava toisiaan kohtaan veljeyden hengessä.",
    "Wszyscy ludzie rodzą się wolni i równi pod względem swej godności i swych praw. Są oni obdarzeni rozumem i sumieniem i powinni postępować wobec innych w duchu braterstwa.",
    "Todos os seres humanos nascem livres e iguais em dignidade e em direitos. Dotados de razão e de consciência, devem agir uns para com os outros em espírito de fraternidade.",
    "Tutti gli esseri umani nascono liberi ed eguali in dignità e diritti. Essi sono dotati di ragione e di coscienza e devono agire gli uni verso gli altri in spirito di fratellanza.",
    "Alle mensen worden vrij en gelijk in waardigheid en rechten geboren. Zij zijn begiftigd met verstand en geweten, en behoren zich jegens elkander in een geest van broederschap te gedragen.",
]


def test_language_stage_parts_learned_languages_from_others_and_noise(spark):
    docs = spark.read.parquet(f"{SMALL.replace('0.001', '0.01')}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars")
    rng = random.Random(5)
    letters = " ".join("".join(rng.choices(string.ascii_lowercase, k=rng.randint(2, 9))) for _ in range(200))
    base64 = "".join(rng.choices(string.ascii_letters + string.digits + "+/", k=2000))
    others = documents(spark, [(-1 - k, text) for k, text in enumerate([*FOREIGN, letters, base64])])
    kept = {r.doc_id for r in corpus_pipeline.language_id(spark, docs.unionByName(others), "").select("doc_id").collect()}
    assert not {k for k in kept if k < 0}
    assert kept == {r.doc_id for r in docs.collect() if any(c.isalpha() for c in r.text or "")}


def test_near_copies_with_clashing_names_in_other_case(spark):
    docs = documents(spark, [(1, "x"), (2, "y")], ("GONE_ID", "Gone_hash"))
    for frame in (docs, docs.limit(0)):
        kept = first_of_near_copies(frame, words=5, similarity=0.8)
        assert kept.columns == docs.columns and kept.count() == frame.count()
