"""Stages of the corpus pipeline against brute force, on awkward rows and clashing column names."""

import random
import re

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as pipeline
from tests.llm.test_operators import set_of, words

SCHEMA = ("doc_id long, text string, lang string, source string, n_chars long, _found int, _later string, _key string, "
          "_replaced int, rejected string, component int")


def rows_of(texts):
    return [(i, t, "en", "s", None if t is None else len(t), i, "later", "key", 3, "no", 9) for i, t in texts]


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """The side tables that the stages read."""
    folder = str(tmp_path_factory.mktemp("pipeline"))
    rng = random.Random(2)
    bad = [words(rng, 30) + " vile" + ("scum " if i % 2 else " filth ") + words(rng, 5) for i in range(40)]
    good = [words(rng, 36) for _ in range(80)]
    labelled = [(i, t, int(i < 40)) for i, t in enumerate(bad + good)]
    spark.createDataFrame([(i, 1, y) for i, _, y in labelled], "doc_id long, quality int, toxic int").write.parquet(
        folder + "/labels.parquet")
    spark.createDataFrame([(1, "What is the capital city of the largest country that lies on two continents?")],
                          "item_id long, text string").write.parquet(folder + "/benchmark.parquet")
    return folder, labelled


def frame(spark, texts):
    return spark.createDataFrame(rows_of(texts), SCHEMA)


def test_toxic_documents_go_and_all_others_stay(spark, tables):
    folder, labelled = tables
    extra = [(900, None), (901, ""), (902, " \n"), (None, "plain words here")]
    docs = frame(spark, [(i, t) for i, t, _ in labelled] + extra)
    kept = pipeline.drop_toxic(spark, docs, folder)
    assert kept.columns == docs.columns
    ids = {r.doc_id for r in kept.collect()}
    assert ids == {i for i, _, y in labelled if not y} | {900, 901, 902, None}
    assert pipeline.drop_toxic(spark, docs.limit(0), folder).count() == 0


def test_a_rare_class_is_in_the_sample(spark):
    from bandwise.llm.common import bounded_classes

    df = spark.range(20_000).select("id", (F.col("id") < 10).cast("int").alias("y"))
    sample = bounded_classes(df, 1000, 50, "id", F.col("y") > 0)
    assert sample.where("y = 1").count() == 10 and 800 < sample.count() < 1200


def test_one_document_of_each_group_stays(spark, tables):
    rng = random.Random(4)
    texts = [(i, words(rng, 60)) for i in range(12)]
    texts += [(20 + i, t) for i, t in texts[:4]]  # exact copies
    texts += [(40 + i, " ".join([*t.split()[:-2], "new", "end"])) for i, t in texts[:6]]
    texts += [(60, None), (61, ""), (62, "two words"), (63, "two words"), (None, "two words"), (64, words(rng, 30_000))]
    docs = frame(spark, texts).unionByName(frame(spark, texts[:1]))  # a row repeated whole
    kept = pipeline.drop_near_copies(spark, docs, tables[0])
    assert kept.columns == docs.columns
    sets = {i: set_of(t, 5) for i, t in texts if i is not None}
    group = {}
    for i in sorted(sets):  # groups of these texts are cliques
        near = [j for j in group if sets[i] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]
        group[i] = group[min(near)] if near else i
    assert sorted(r.doc_id for r in kept.where("doc_id is not null").collect()) == sorted({*group.values()})
    assert pipeline.drop_near_copies(spark, docs.limit(0), tables[0]).count() == 0


def test_contaminated_documents_go(spark, tables):
    item = "What is the capital city of the largest country that lies on two continents?"
    rng = random.Random(6)
    texts = [(1, item), (2, words(rng, 50) + ". " + item + " " + words(rng, 50)), (3, words(rng, 80)), (4, None), (5, ""),
             (None, item), (6, "What is the capital city of France?"), (7, words(rng, 20_000))]
    docs = frame(spark, texts)
    kept = pipeline.drop_contaminated(spark, docs, tables[0])
    assert kept.columns == docs.columns
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in kept.collect()) == [
        (False, 3), (False, 4), (False, 5), (False, 6), (False, 7), (True, 0)]
    assert pipeline.drop_contaminated(spark, docs.limit(0), tables[0]).count() == 0


def test_private_data_is_replaced_and_other_columns_stay(spark, tables):
    texts = [(1, "mail anna.weber@example.com or 8.8.8.8"), (2, "nothing here"), (3, None), (4, ""),
             (5, "again anna.weber@example.com"), (None, "call +1 583 555-8469"), (6, "x " * 40_000 + "anna.weber@example.com")]
    docs = frame(spark, texts)
    out = pipeline.replace_private(spark, docs, tables[0])
    assert out.columns == docs.columns and out.schema.simpleString() == docs.schema.simpleString()
    got = {r.doc_id: r for r in out.collect()}
    before = {r[0]: r for r in rows_of(texts)}
    for i, r in got.items():
        assert (r._found, r._later, r._key, r._replaced, r.rejected, r.component) == before[i][5:]
        assert r.n_chars == (None if r.text is None else len(r.text))
        assert not re.search("anna|8\\.8\\.8\\.8|583", r.text or "")
    assert [got[i].text for i in (2, 3, 4)] == ["nothing here", None, ""]
    mails = [re.search(r"\S+@\S+", got[i].text).group() for i in (1, 5, 6)]
    assert len(set(mails)) == 1
    assert pipeline.replace_private(spark, docs.limit(0), tables[0]).count() == 0


def test_every_stage_takes_texts_in_small_batches(spark, tables):
    key, docs = "spark.sql.execution.arrow.maxRecordsPerBatch", frame(spark, [(200, "a b"), (201, None)])

    def sizes(batches):
        yield from (b.slice(0, 1).set_column(0, "id", pa.array([b.num_rows])) for b in batches)

    try:
        for _, stage in pipeline.STAGES:
            spark.conf.unset(key)
            stage(spark, docs, tables[0])
            assert [r.id for r in spark.range(0, 2500, 1, 1).mapInArrow(sizes, "id long").collect()] == [1000, 1000, 500]
        spark.conf.set(key, "70")
        pipeline.pack(spark, docs, tables[0])
        assert spark.conf.get(key) == "70"
    finally:
        spark.conf.unset(key)


def test_run_chains_the_stages(spark, tables, tmp_path):
    folder, labelled = tables
    rng = random.Random(9)
    clean = words(rng, 60)
    item = "What is the capital city of the largest country that lies on two continents?"
    texts = [(i, t) for i, t, _ in labelled] + [(200, clean), (201, clean), (202, item), (203, "ask anna.weber@example.com"), (204, None)]
    path = str(tmp_path / "all")
    for name in ("labels", "benchmark"):
        spark.read.parquet(f"{folder}/{name}.parquet").write.parquet(f"{path}/{name}.parquet")
    frame(spark, texts).write.parquet(f"{path}/documents.parquet")
    pieces = pipeline.run(spark, path).collect()
    assert {p.doc_id for p in pieces} == {i for i, _, y in labelled if not y} | {200, 203, 204}
    assert all(sum(p.length for p in pieces if p.doc_id == i) == next(p.doc_tokens for p in pieces if p.doc_id == i)
               for i in (200, 203, 204))
