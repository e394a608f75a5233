import re
from collections import Counter

from marlstone.llm import quality_rules as rules
from tests.conftest import plan_of
from tests.llm.conftest import by_row

SPACE = " \t\n\x0b\x0c\r"


def fails(line):
    n = len(re.findall(r"[^\x20\x09-\x0D]+", line))
    last = line.rstrip(SPACE + rules.CLOSERS)[-1:]
    fragment = last not in rules.SENTENCE_ENDS and (
        n < 10 or not re.search(rules.SENTENCE_MARK, line)
    )
    return (
        fragment
        or 3 * len(re.findall(rules.MARK_RUN, line)) > n
        or len(re.findall(rules.MENU_MARK, line)) >= 3
        or any(x in line.lower() for x in rules.BOILERPLATE)
    )


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    seen = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if seen[w] > 1 for k in range(5)}
    lines = [x for x in text.split("\n") if x.strip(SPACE)]
    bad = [x for x in lines if fails(x)]
    lost = sum(len(re.findall(r"[^\x20\x09-\x0D]+", x)) for x in bad)
    n, rep = len(words), len(covered)
    base = n < 10 or 100 * rep > 20 * n
    clean = "\n".join(x for x in text.split("\n") if not x.strip(SPACE) or not fails(x))
    return (
        n, sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)), rep, base, not base and 100 * lost <= 50 * n,
        len(bad), lost, clean if bad else text,
    )


COLUMNS = (
    "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept",
    "n_failed_lines", "n_lost_words", "clean_text",
)


def test_matches_brute_force(edge_docs):
    found = by_row(rules.quality_rules(edge_docs), "doc_id", *COLUMNS)
    rows = [(r.doc_id, *brute(r.text)) for r in edge_docs.collect()]
    assert found == sorted(rows, key=repr)


def test_repeated_windows_overlap(spark):
    texts = ["a b c d e f a b c d e f", "a a a a a a a", "a b c d e a b c d", "a b c d e"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    found = [n for _, n in by_row(rules.quality_rules(df), "doc_id", "n_repeat_words")]
    assert found == [12, 7, 0, 0]


def test_lines_by_rule(spark):
    lines = {
        "A whole sentence stands here.": False, 'He said "so it is."': False,
        "no end at all": True, "All rights reserved.": True, "Home | News | About | Help": True,
        "wow!! such!! news!!": True, "Is it? Then this one goes on with no end in sight": False,
        "ten words that never end and hold no mark either so": True,
    }
    df = spark.createDataFrame([(k,) for k in lines], "x string")
    from pyspark.sql import functions as F

    found = {r.x: r.bad for r in df.select("x", rules.line_fails(F.col("x")).alias("bad")).collect()}
    assert found == lines


def test_empty_table(no_docs):
    assert rules.quality_rules(no_docs).count() == 0
    assert rules.cleaned(no_docs).columns == no_docs.columns


def test_cleaned_keeps_columns_and_clean_documents(edge_docs):
    left = rules.cleaned(edge_docs)
    assert left.schema.simpleString() == edge_docs.schema.simpleString()
    expected = [
        (r.doc_id, brute(r.text)[-1]) for r in edge_docs.collect() if brute(r.text)[6]
    ]
    assert by_row(left, "doc_id", "text") == sorted(expected, key=repr)


def test_native_without_a_shuffle(edge_docs, spark):
    df = spark.range(3).selectExpr("id doc_id", "string(id) text")
    plan = plan_of(rules.quality_rules(df))
    assert "Exchange" not in plan and "Python" not in plan
