"""The pipeline's stages one after another, each against a plain version of its decision."""

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from tests.llm.test_ngram_join import plain_components
from tradeweave.llm.line_rules import LineRules, judge
from tradeweave.llm.packing import Encoder
from tradeweave.llm.queries import BYTE_BPE, table, tokenizer_path
from tradeweave.session import stage

DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def steps(spark):
    docs, out = table(spark, DATA, "documents"), []
    for _, apply in P.STAGES:
        docs = stage(apply(spark, docs, DATA))
        out.append(docs)
    return out


def texts(df):
    return {r["doc_id"]: r["text"] for r in df.collect()}


def test_stages_keep_the_columns(spark, steps):
    assert [name for name, _ in P.STAGES] == ["quality_rules", "quality_classifier", "near_duplicates", "source_mix", "packed_sequences"]
    for df in steps[:-1]:
        assert df.dtypes == table(spark, DATA, "documents").dtypes


def test_rules_keep_what_they_should(spark, steps):
    judged = {i: judge(t, LineRules()) for i, t in texts(table(spark, DATA, "documents")).items()}
    assert texts(steps[0]) == {i: j[8] for i, j in judged.items() if j[6]}
    assert all(r["n_chars"] == len(r["text"]) for r in steps[0].collect())


def test_classifier_keeps_good_documents(spark, steps):
    good = table(spark, DATA, "labels").filter("quality = 1").select("doc_id")
    before, after = steps[0].join(good, "doc_id").count(), steps[1].join(good, "doc_id").count()
    assert after >= 0.97 * before and set(texts(steps[1]).items()) <= set(texts(steps[0]).items())


def test_one_document_of_each_group_stays(steps):
    want = {d for d, _, least in plain_components(list(texts(steps[1]).items())) if d == least}
    assert set(texts(steps[2])) == want and steps[2].count() == len(want)


def test_mix_takes_whole_copies_near_the_targets(steps):
    from tradeweave.llm.mixing import mix
    told = mix(steps[2]).toPandas()
    got = {r["doc_id"]: r["count"] for r in steps[3].groupBy("doc_id").count().collect()}
    assert got == {i: c for i, c in zip(told.doc_id, told.copies) if c}
    by = told.assign(taken=told["size"] * told.copies).groupby("source").agg(taken=("taken", "sum"), target=("target", "first"),
                                                                            most=("size", "max"))
    assert (np.abs(by.taken - by.target) <= by.most).all()


def test_packing_holds_every_copy_whole(steps):
    encoder, rows = Encoder.load(tokenizer_path(BYTE_BPE)), steps[4].toPandas()
    assert rows.groupby("sequence_id").length.sum().max() <= 1024
    tokens = sum(len(encoder.encode(r["text"])) // 4 + 1 for r in steps[3].collect())
    assert rows.length.sum() == tokens and (rows.piece == 0).sum() == steps[3].count()


def test_repeated_and_awkward_rows(spark, awkward, nothing):
    docs = awkward.select(*P.COLUMNS)
    assert P.near_duplicates(spark, docs, DATA).count() == len(
        {(d, t) for d, t in [(r["doc_id"], r["text"]) for r in docs.collect()] if d not in (6, 50)})
    empty = nothing.select(*P.COLUMNS)
    for _, apply in P.STAGES:
        empty = apply(spark, empty, DATA)
    assert empty.count() == 0 and F is not None


def test_null_and_repeated_ids_leave_one_document_of_a_group(spark):
    x, y = " ".join(f"w{i}" for i in range(60)), " ".join(f"v{i}" for i in range(60))
    rows = [(None, x), (5, x), (None, ""), (None, y), (None, y + " end"), (7, "other words of another text here"), (7, x + " more"), (None, "")]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long")
    got = sorted((r["doc_id"] or 0, r["text"]) for r in P.near_duplicates(spark, docs.repartition(3), DATA).collect())
    assert got[0] == (0, "") and got[1][1] in (y, y + " end")
    assert got[2:] == [(5, x), (7, "other words of another text here")]
