"""The pipeline and the registered queries on the smallest tables."""

import os

import pytest

import compare
import corpus_pipeline
from marlstone.llm import exact_dedup, ngram_join, quality_rules, secrets
from marlstone.llm.common import staged
from marlstone.llm.oracles import ORACLES
from marlstone.llm.queries import QUERIES
from tests.llm.conftest import by_row
from tests.llm.test_ngram_join import brute as brute_components
from tests.llm.test_quality_rules import brute as brute_quality

SF_DIR = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables not there")
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_one_query_per_operator():
    import __spark_entry__

    numbers = [int(name[2:].split("_")[0]) for name in QUERIES]
    assert sorted(numbers) == list(range(1, 14))
    assert set(QUERIES) | {"pipeline"} <= set(__spark_entry__.queries())


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, name):
    count, problems = compare.differences(spark, compare.connect(SF_DIR), name, SF_DIR)
    assert not problems and count > 0


# Phrases are not rows of a table; their SQL above reads it whole.
@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"op13_phrase_mining"}))
def test_whole_tables(spark, name):
    source = {"op4": "pages", "op11": "conversations"}.get(name.split("_")[0], "documents")
    rows = spark.read.parquet(f"{SF_DIR}/{source}.parquet")
    rows = rows.select("conv_id").distinct().count() if name.startswith("op11") else rows.count()
    found = QUERIES[name](spark, SF_DIR).count()
    assert found >= rows if name.startswith("op6") else found == rows


def test_each_stage_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    texts = {r.doc_id: r.text for r in docs.collect()}
    stages = dict(corpus_pipeline.STAGES)

    def step(name, docs):
        done = staged(stages[name](spark, docs, SF_DIR), "test")
        assert done.columns == COLUMNS
        assert done.where("n_chars <> length(text)").count() == 0
        return done, {r.doc_id: r.text for r in done.collect()}

    docs, left = step("quality rules", docs)
    texts = {i: brute_quality(t)[-1] for i, t in texts.items() if brute_quality(t)[6]}
    assert left == texts
    docs, left = step("exact dedup", docs)
    by_text = {}
    for i in sorted(texts):
        by_text[texts[i]] = i
    texts = {i: t for t, i in by_text.items()}
    assert left == texts
    docs, left = step("n-gram Jaccard join", docs)
    found = brute_components(sorted(texts.items()))[0]
    texts = {i: texts[i] for i, _, c in found if i == c}
    assert left == texts
    docs, left = step("secret scans", docs)
    texts = {i: secrets.redact(t, secrets.secret_spans(t)) for i, t in texts.items()}
    assert left == texts
    packed = stages["packing"](spark, docs, SF_DIR).collect()
    assert {p.doc_id for p in packed} == set(texts)


def test_run(spark):
    packed = corpus_pipeline.run(spark, SF_DIR)
    assert {"doc_id", "start", "length", "sequence_id", "offset"} <= set(packed.columns)
    assert packed.count() > 0


def test_stages_take_an_empty_table(spark):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").where("false")
    for _, stage in corpus_pipeline.STAGES:
        docs = staged(stage(spark, docs, SF_DIR), "empty")
        assert docs.count() == 0


def test_operators_do_not_read_other_columns(spark):
    docs = spark.createDataFrame([(1, "some text here.", 5)], "doc_id int, text string, n_chars int")
    for run in (exact_dedup.survivors, ngram_join.one_per_component, secrets.redacted):
        assert by_row(run(docs)) == [(1, "some text here.", 5)]
    assert quality_rules.cleaned(docs).count() == 0


def test_slices_hold_all_rows():
    import pyarrow as pa

    from marlstone.llm.common import in_slices

    texts = ["a" * 5, None, "b" * 30, "", "c" * 9, "d" * 9, "e"]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], names=["text"])
    slices = [s["text"].to_pylist() for s in in_slices(iter([batch]), "text", 20)]
    assert sum(slices, []) == texts
    assert all(len(s) == 1 or sum(len(t or "") for t in s) <= 20 for s in slices)
    assert list(in_slices(iter([batch.slice(0, 0)]), "text")) == []
