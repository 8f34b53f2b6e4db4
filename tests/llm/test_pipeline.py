import random

import pytest

import corpus_pipeline
from ratevane.llm import exact_dedup, langid, packing, simhash, toxicity
from tests.llm.test_toxicity import corpus


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    at = tmp_path_factory.mktemp("sf")
    docs, labels = corpus(random.Random(3), 900)
    docs += [(1000 + i, docs[i][1].upper()) for i in range(1, 40)] + [(2000, None), (2001, "12 34"), (2002, ""), (2003, "the m0r0n and")]
    docs += [(3000, " ".join(f"house{i} water" for i in range(300))), (3001, " ".join(f"house{i} water" for i in range(300)) + " end")]
    spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in docs], "doc_id bigint, text string, lang string, source string, n_chars bigint").write.parquet(f"{at}/documents.parquet")
    spark.createDataFrame(labels, "doc_id bigint, toxic int").write.parquet(f"{at}/labels.parquet")
    return str(at)


def test_each_stage_is_its_operator(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    labels = spark.read.parquet(f"{folder}/labels.parquet")
    ids = lambda df: sorted(r.doc_id for r in df.select("doc_id").collect())
    step = corpus_pipeline.drop_toxic(spark, docs, folder)
    assert step.columns == docs.columns
    assert ids(step) == ids(toxicity.toxicity_of(docs, labels).where("predicted = 0"))
    assert not {0, 5, 10, 2003} & set(ids(step))
    after = corpus_pipeline.drop_unidentified(spark, step, folder)
    assert after.columns == docs.columns and ids(after) == ids(langid.languages_of(step).where("not rejected"))
    assert not {2000, 2001, 2002} & set(ids(after)) and len(ids(after)) >= len(ids(step)) - 5
    unique = corpus_pipeline.drop_exact_copies(spark, after, folder)
    assert unique.columns == docs.columns and ids(unique) == ids(exact_dedup.exact_dedup(after).where("kept"))
    assert 1001 in ids(unique) and 1 not in ids(unique)
    near = corpus_pipeline.drop_near_copies(spark, unique, folder)
    assert near.columns == docs.columns and ids(near) == ids(simhash.simhash_groups(unique).where("doc_id = component_id"))
    assert 3000 in ids(near) and 3001 not in ids(near)
    packed = corpus_pipeline.pack(spark, near, folder)
    assert ids(packed) == ids(near) and sorted(map(tuple, packed.collect())) == sorted(map(tuple, packing.pack(near).collect()))


def test_run(spark, folder):
    rows = corpus_pipeline.run(spark, folder).collect()
    assert len(rows) > 500 and len({(r.bucket, r.batch, r.slot) for r in rows}) == len(rows)


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def test_stages_of_odd_rows(spark, folder, docs):
    """Nulls, repeated ids, ties, long texts and columns with the names that the operators use inside: each stage keeps whole rows, and none twice."""
    step = docs
    whole = {tuple(r) for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        step = stage(spark, step, folder)
        rows = [tuple(r) for r in step.collect()]
        assert step.columns == docs.columns and set(rows) <= whole and len(rows) == len(set(rows)), name
        whole = set(rows)
    packed = corpus_pipeline.pack(spark, step, folder).collect()
    assert len(packed) == len(whole) and len({(r.bucket, r.batch, r.slot) for r in packed}) == len(packed)


def test_copies_with_one_id_over_several_texts(spark, folder):
    rows = [(5, "same text of some length here"), (9, "same text of some length here"), (5, "a text found nowhere else at all"), (None, "same TEXT of some length here"), (7, "yet another one"), (7, "yet another one")]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    unique = corpus_pipeline.drop_exact_copies(spark, df, folder)
    assert sorted((r.doc_id, lower(r.text)) for r in unique.collect()) == [(5, rows[2][1]), (7, rows[4][1]), (9, rows[0][1])]
    near = corpus_pipeline.drop_near_copies(spark, df, folder)
    assert {lower(r.text) for r in near.collect()} == {lower(t) for _, t in rows} and near.count() == 3


def test_stages_of_no_rows(spark, folder, none):
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, folder).collect() == [], name
