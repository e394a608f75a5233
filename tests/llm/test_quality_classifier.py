import os
import zlib

import numpy as np
import pytest

from marlstone.llm import quality_classifier as classifier
from tests.llm.conftest import prose


def held(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 3 == 1


def sample(n):
    """Plain prose, and three kinds of junk."""
    rows = []
    for i in range(n):
        text = prose(i, 20 + i % 150)
        kind = i % 6
        if kind == 3:
            text = " ".join(w + "***" for w in text.split())
        elif kind == 4:
            text = text.upper().replace(" ", "!! ")
        elif kind == 5:
            text = " | ".join(text.split())
        rows.append((i, text, int(kind < 3)))
    return rows


@pytest.fixture(scope="module")
def tables(spark):
    rows = sample(900)
    docs = spark.createDataFrame([r[:2] for r in rows], "doc_id bigint, text string")
    labels = spark.createDataFrame([(r[0], r[2], 0) for r in rows], "doc_id bigint, quality int, toxic int")
    return rows, docs.repartition(4), labels


def test_held_out_accuracy(tables):
    rows, docs, labels = tables
    found = {r.doc_id: r for r in classifier.classify(docs, labels).collect()}
    assert len(found) == len(rows)
    own = [(found[i], q) for i, _, q in rows if held(i)]
    assert all(f.held_out for f, _ in own) and not any(
        found[i].held_out for i, _, _ in rows if not held(i)
    )
    assert np.mean([f.predicted == q for f, q in own]) > 0.97
    assert all(f.predicted == int(f.score >= 0.5) and 0 <= f.score <= 1 for f in found.values())


def test_held_out_labels_change_nothing(tables):
    rows, docs, labels = tables
    from pyspark.sql import functions as F

    flipped = labels.withColumn(
        "quality", F.when(classifier.held_out(F.col("doc_id")), 1 - F.col("quality"))
        .otherwise(F.col("quality"))
    )
    a = {r.doc_id: r.score for r in classifier.classify(docs, labels).collect()}
    b = {r.doc_id: r.score for r in classifier.classify(docs, flipped).collect()}
    assert a == pytest.approx(b, abs=1e-9)


def test_model_matches_dense_formula(tables, spark):
    rows, docs, labels = tables
    x = np.array([classifier.statistics(t) for _, t, _ in rows])
    y = np.array([q for _, _, q in rows])
    frame = classifier.features(docs).join(labels.withColumnRenamed("quality", "label"), "doc_id")
    model = classifier.fit(frame)
    z = (x - x.mean(axis=0)) / x.std(axis=0)
    scatters = [np.cov(z[y == c].T, bias=True) for c in (0, 1)]
    pooled = sum((y == c).mean() * s for c, s in zip((0, 1), scatters))
    densities = []
    for c, s in zip((0, 1), scatters):
        s = (1 - classifier.TO_POOLED) * s + classifier.TO_POOLED * pooled
        s = (1 - classifier.TO_DIAGONAL) * s + classifier.TO_DIAGONAL * np.diag(np.diag(s))
        s += classifier.RIDGE * np.eye(len(s))
        away = z - z[y == c].mean(axis=0)
        distance = np.einsum("ij,jk,ik->i", away, np.linalg.inv(s), away)
        densities.append(np.log((y == c).mean()) - 0.5 * (distance + np.linalg.slogdet(s)[1]))
    expected = 1 / (1 + np.exp(np.clip(densities[0] - densities[1], -700, 700)))
    assert model.scores(x) == pytest.approx(expected, abs=1e-6)


def test_edge_cases(edge_docs, no_docs, tables, spark):
    _, _, labels = tables
    found = classifier.classify(edge_docs, labels).collect()
    assert len(found) == edge_docs.count()
    assert all(0 <= r.score <= 1 for r in found)
    assert classifier.classify(no_docs, labels).count() == 0


def test_without_labels_of_both_classes(tables, spark):
    _, docs, labels = tables
    none = classifier.classify(docs, labels.where("quality = 7"))
    assert {r.score for r in none.collect()} == {0.5}
    ones = labels.where("quality = 1")
    n = ones.where(~classifier.held_out(ones.doc_id)).count()
    assert {r.score for r in classifier.classify(docs, ones).collect()} == {(n + 1) / (n + 2)}


SF_DIR = "/root/testdata/sf0.01"


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="test tables not there")
def test_on_the_tables(spark):
    from marlstone.llm.queries import QUERIES

    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    found = QUERIES["op5_quality_classifier"](spark, SF_DIR).join(labels, "doc_id").collect()
    own = [r for r in found if r.held_out]
    assert np.mean([r.predicted == r.quality for r in own]) > 0.97
