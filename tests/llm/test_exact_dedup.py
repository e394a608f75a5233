import hashlib
from collections import defaultdict

import pytest

from marlstone.llm.exact_dedup import exact_dedup, survivors
from tests.llm.conftest import by_row


def brute(rows, best):
    groups = defaultdict(list)
    for i, text in rows:
        groups[text or ""].append(i)
    out = []
    for text, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = best(known) if known else None
        sha = hashlib.sha256(text.encode()).hexdigest()
        kept_once = False
        for i in sorted(ids, key=lambda x: (x is None, x)):
            kept = i == keep and not kept_once
            kept_once |= kept
            out.append((i, keep, len(ids), kept, sha))
    return sorted(out, key=repr)


@pytest.mark.parametrize("keep,best", [("largest", max), ("smallest", min)])
def test_matches_brute_force(edge_docs, keep, best):
    rows = [(r.doc_id, r.text) for r in edge_docs.collect()]
    assert by_row(exact_dedup(edge_docs, keep=keep)) == brute(rows, best)


def test_empty_table(no_docs):
    assert exact_dedup(no_docs).count() == 0
    assert survivors(no_docs).columns == no_docs.columns


def test_a_hot_group_crosses_partitions(spark):
    rows = [(i, "same text") for i in range(4000)] + [(i, f"text {i}") for i in range(4000, 5000)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)
    assert by_row(exact_dedup(df)) == brute(rows, max)


def test_equal_heads_are_told_apart(spark):
    head = "h" * 100
    rows = [(i, head + str(i % 7)) for i in range(300)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    assert by_row(exact_dedup(df)) == brute(rows, max)


def test_survivors_keep_columns(edge_docs):
    left = survivors(edge_docs)
    assert left.schema.simpleString() == edge_docs.schema.simpleString()
    texts = [r.text or "" for r in edge_docs.collect()]
    assert left.count() == len(set(texts))


def test_other_normalisation(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(1, "A b"), (2, "a B"), (3, "c")], "doc_id bigint, text string")
    found = exact_dedup(df, normalise=F.lower)
    assert by_row(found, "doc_id", "keep_id") == [(1, 2), (2, 2), (3, 3)]


def test_unknown_choice(no_docs):
    with pytest.raises(ValueError):
        exact_dedup(no_docs, keep="any")
