import random

import pytest

from marlstone.llm.common import find_package

SCHEMA = (
    "doc_id bigint, text string, kept string, part string, row string, key string, sid string, "
    "component string, spans string, `a.b` string, n_chars bigint"
)


@pytest.fixture(autouse=True)
def package_path(spark):
    find_package(spark)


def prose(seed: int, n_words: int) -> str:
    pick = random.Random(seed)
    stems = ["the", "of", "Ation", "ther", "écho", "ing", "and", "Über", "en", "ble", "日本"]
    words = ["".join(pick.choices(stems, k=pick.randint(1, 3))) for _ in range(n_words)]
    lines, line = [], []
    for word in words:
        line.append(word)
        if pick.random() < 0.08:
            lines.append(" ".join(line) + ".")
            line = []
    return "\n".join([*lines, " ".join(line) + "."])


EDGE_TEXTS = [
    None, "", " ", "\n\n", "\t", "one", "one two three four", "ONE two Three four",
    prose(1, 80), prose(1, 80), prose(2, 120), prose(2, 120) + " more", prose(3, 6000),
    "x" * 20000, "same words here now then " * 30, "A\x00b c d e\x85f　g h  i ",
    "<|endoftext|> and  two spaces ▁ marks ▁▁x", "menu | home | about | more | end",
    "THIS!! IS!! ALL!! LOUD!! AND!! STILL!! GOES!! ON!! AND!! ON!! NOW!!",
]


@pytest.fixture
def edge_docs(spark):
    """Nulls, empty and long texts, repeated rows and ids, null ids, names that clash."""
    rows = [(i, t, *["x"] * 8, len(t or "")) for i, t in enumerate(EDGE_TEXTS)]
    rows += [rows[8], rows[8], (None, prose(1, 80), *[None] * 8, None), (None, None, *["y"] * 9)]
    rows[-1] = (None, None, *["y"] * 8, 0)
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


def by_row(df, *cols):
    """Rows as sorted tuples, nulls and all."""
    return sorted((tuple(r) for r in df.select(*(cols or df.columns)).collect()), key=repr)
