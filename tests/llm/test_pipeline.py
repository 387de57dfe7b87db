"""Each stage of the pipeline against a brute-force version over its own input."""

from collections import Counter

import duckdb
import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from enrolmeter.llm import mixing, quality_net
from enrolmeter.llm.bpe import VOCABULARY

from ..conftest import SMALL
from .test_line_dedup import brute as brute_lines
from .test_python import LIBRARY, brute_groups

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    """The pipeline's input and what each stage made of its predecessor's rows."""
    folder = tmp_path_factory.mktemp("stages")
    docs, out = spark.read.parquet(f"{SMALL}/documents.parquet"), []
    for number, (_, stage) in enumerate(corpus_pipeline.STAGES):
        stage(spark, docs, SMALL).write.parquet(f"{folder}/{number}")
        out.append((docs, spark.read.parquet(f"{folder}/{number}")))
        docs = out[-1][1]
    return out


def rows(df):
    return Counter(map(tuple, df.select(*COLUMNS).collect()))


def test_all_but_the_last_return_the_columns_of_documents(stages):
    assert len(stages) == 5
    assert all(after.columns == COLUMNS for _, after in stages[:-1])


def test_rejected_documents_go(spark, stages):
    before, after = stages[0]
    net = quality_net.train(before, spark.read.parquet(f"{SMALL}/labels.parquet"))
    kept = before.toPandas()
    if not isinstance(net, float):
        kept = kept[quality_net._scores(kept["text"].fillna(""), net) >= quality_net.THRESHOLD]
    assert {r.doc_id for r in after.collect()} == set(kept["doc_id"])
    assert 0 < after.count() <= before.count() and not rows(after) - rows(before)


def test_repeated_lines_go(stages):
    before, after = stages[1]
    expected = brute_lines([(r.doc_id, r.text) for r in before.collect()])
    got = sorted(((r.doc_id, r.text, r.n_chars) for r in after.collect()), key=repr)
    assert got == sorted(((i, text, len(text)) for i, _, _, text in expected), key=repr)


def test_one_document_of_each_group_stays(stages):
    before, after = stages[2]
    groups = brute_groups([(r.doc_id, r.text) for r in before.collect()], 5)
    assert sorted(r.doc_id for r in after.collect()) == sorted(i for i, _, _, kept in groups if kept)
    assert not rows(after) - rows(before)


def test_mixture_is_that_of_the_plain_sql(stages):
    before, after = stages[3]
    duck = duckdb.connect()
    documents = before.toPandas()  # noqa: F841
    duck.register("documents", documents)
    names = ", ".join(COLUMNS)
    expected = Counter(duck.execute(f"SELECT {names} FROM ({mixing.ORACLE})").fetchall())
    assert rows(after) == expected


def test_tokens_are_those_of_the_library(stages):
    before, after = stages[4]
    assert VOCABULARY in public_tokenizers.path(VOCABULARY)
    got = after.collect()
    assert all(r.ids == LIBRARY.encode_ordinary(r.text) and r.n_tokens == len(r.ids) and r.round_trip for r in got)
    assert rows(after) == rows(before)


CLASHING = ("score", "n_lines", "n_dropped", "kept", "n_shingles", "component_id", "copy", "shuffle_key", "row")


def test_columns_of_the_input_outlive_every_stage(spark, stages):
    """Names that operators add, as columns of other use."""
    docs = stages[0][0].select("*", *(F.concat(F.lit(f"{c}:"), F.col("doc_id")).alias(c) for c in CLASHING))
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs.limit(60), SMALL)
        got = docs.collect()
        assert got and all(r[c] == f"{c}:{r.doc_id}" for r in got for c in CLASHING)
        docs = spark.createDataFrame(got, docs.schema)


def test_empty_tables_pass_through(spark, tmp_path):
    for name in ("documents", "labels"):
        spark.read.parquet(f"{SMALL}/{name}.parquet").limit(0).write.parquet(f"{tmp_path}/{name}.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_run_is_the_stages_in_a_row(spark, stages):
    got = corpus_pipeline.run(spark, SMALL)
    assert got.columns == stages[-1][1].columns
    assert Counter((r.doc_id, r.n_tokens) for r in got.collect()) == Counter(
        (r.doc_id, r.n_tokens) for r in stages[-1][1].collect()
    )
