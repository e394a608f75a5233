import random
import re
import uuid
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from marlstone.llm import double_array, phrase_mining
from marlstone.llm.phrase_mining import Block, phrases
from tests.llm.conftest import EDGE_TEXTS

SCHEMA = "doc_id long, text string, lang string, word string, n long, w1 string, `a.b` int"


def plain(rows, least=10, percent=50, best=2000):
    """What the operator returns, from (text, lang) rows."""
    counts, total = Counter(), Counter()
    for text, lang in rows:
        lang = "und" if lang is None else lang
        low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", low):
            words = re.findall("[^ \t]+", piece)
            total[lang] += len(words)
            for k in (1, 2, 3):
                for at in range(len(words) - k + 1):
                    counts[lang, tuple(words[at : at + k])] += 1
    found = {key: n for key, n in counts.items() if len(key[1]) > 1 and n >= least}
    longer = Counter()
    for (lang, words), a in found.items():
        if len(words) == 3:
            for part in (words[:2], words[1:]):
                longer[lang, part] = max(longer[lang, part], a)
    by_language = {}
    for (lang, words), a in found.items():
        if longer[lang, words] and 100 * longer[lang, words] >= percent * a:
            continue
        cuts = []
        for k in range(1, len(words)):
            left, right = counts[lang, words[:k]], counts[lang, words[k:]]
            cuts.append((1_000_000 * a * a // (left * right), k, left, right))
        score, _, left, right = min(cuts)
        by_language.setdefault(lang, []).append((score, a, " ".join(words), left, right))
    out = []
    for lang, some in by_language.items():
        some.sort(key=lambda x: (-x[0], -x[1], x[2].encode()))
        out += [
            (lang, n, phrase, a, left, right, total[lang], score)
            for n, (score, a, phrase, left, right) in enumerate(some[:best], 1)
        ]
    return sorted(out)


def corpus(seed, docs, words=12):
    pick = random.Random(seed)
    stems = ["The", "of", "é", "ñu", "x-y", "日本", "a's", "And", "zz", "q", "r", "s"][:words]
    stems = [*stems, "New york city", "of course not", "zz top"]
    marks = [" ", " ", " ", "  ", "\t", ". ", "\n", ",", "\r\n", " ; ", "\x0b"]
    rows = []
    for n in range(docs):
        size = pick.choice([0, 1, 2, 5, 40, 200])
        text = "".join(pick.choice(stems) + pick.choice(marks) for _ in range(size))
        rows.append((n, pick.choice([text, text, text + " ", None]), pick.choice(["en", "de", None, ""])))
    rows += [rows[3]] * 20
    return [(*r, "w", 3, "x", 7) for r in rows]


def results(df, **options):
    found = phrases(df, **{"cell_bits": 18, **options})
    assert found.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return sorted(tuple(r) for r in found.collect())


def test_equals_brute_force(spark):
    rows = corpus(1, 800, words=8)
    wanted = plain([r[1:3] for r in rows])
    assert len(wanted) > 100 and {len(w[2].split(" ")) for w in wanted} == {2, 3}
    df = spark.createDataFrame(rows, SCHEMA)
    assert results(df.repartition(3), cell_bits=phrase_mining.CELL_BITS) == wanted
    # A sketch that proves next to nothing, and many small tries, give the same.
    assert results(df, cell_bits=8, shard_phrases=150) == wanted


def test_other_limits(spark):
    rows = corpus(2, 300, words=6)
    df = spark.createDataFrame(rows, SCHEMA)
    wanted = plain([r[1:3] for r in rows], least=4, percent=90, best=7)
    assert results(df, least_count=4, inside_percent=90, best=7) == wanted


def test_texts_are_read_twice_however_many_shards(spark, tmp_path):
    rows = corpus(3, 300, words=8)
    folder = str(tmp_path)

    def noted(batches):
        open(f"{folder}/{uuid.uuid4().hex}", "w").close()
        yield from batches

    df = spark.createDataFrame(rows, SCHEMA).select("text", "lang").coalesce(1)
    found = results(df.mapInArrow(noted, df.schema), shard_phrases=20)
    assert found == plain([r[1:3] for r in rows]) and len(found) > 40
    assert len(list(tmp_path.iterdir())) == 2


@pytest.mark.parametrize("size", [0, 1, 5000])
def test_sketch_cells_are_packed_and_added_up(size):
    pick = np.random.default_rng(size)
    own_bits = phrase_mining.SKETCH_BITS - phrase_mining.RANGE_BITS
    cells = pick.integers(0, 1 << own_bits, size, dtype=np.uint64)
    counts = pick.integers(1, 256, size, dtype=np.uint64)
    rows = phrase_mining._added([cells << np.uint64(8) | counts])
    assert dict(zip((rows >> np.uint64(8)).tolist(), (rows & np.uint64(255)).tolist())) == dict(
        zip(cells.tolist(), counts.tolist())
    )
    assert np.array_equal(phrase_mining._dense(phrase_mining._sparse(rows, own_bits)), rows)
    twice = phrase_mining._added([rows, rows])
    assert len(twice) == size
    assert np.array_equal(twice & np.uint64(255), np.minimum(2 * (rows & np.uint64(255)), 255))


def test_edges(spark, edge_docs, no_docs):
    assert phrases(no_docs, lang_col="kept").collect() == []
    rows = [(r.text, r.kept) for r in edge_docs.select("text", "kept").collect()]
    assert len(rows) > len(EDGE_TEXTS)
    assert results(edge_docs, lang_col="kept", least_count=2) == plain(rows, least=2)


def test_one_word_without_end(spark):
    rows = [(1, "x" * 300_000 + " y z", "en", "w", 3, "x", 7)] * 10
    [(lang, rank, phrase, a, left, right, n, score)] = results(spark.createDataFrame(rows, SCHEMA))
    assert (lang, rank, a, left, right, n, score) == ("en", 1, 10, 10, 10, 30, 1_000_000)
    assert phrase == "x" * 300_000 + " y z"


def test_scores_beyond_64_bits(spark):
    totals = spark.createDataFrame([("en", 90_000_000_000_000)], "lang string, n long")
    a, left, right = 30_000_000_000_007, 40_000_000_000_003, 70_000_000_000_001
    found = spark.createDataFrame(
        [("en", "a", "b", None, a, left, right, None, None)],
        "lang string, w1 string, w2 string, w3 string, a long, l1 long, r1 long, l2 long, r2 long",
    )
    [row] = phrase_mining._scored(found, totals, 50, 5).collect()
    assert (row.l, row.r) == (left, right) and row.score == 1_000_000 * a * a // (left * right)


def test_long_texts_are_cut_between_pieces(monkeypatch):
    text = "a b. c d e\n" * 50 + "f g h " * 100
    batch = pa.RecordBatch.from_pydict({"lang": ["en"], "text": [text]})
    whole = Block.of("en", text.encode().translate(phrase_mining.PLAIN))
    monkeypatch.setattr(phrase_mining, "BLOCK", 64)
    parts = list(phrase_mining.blocks([batch]))
    assert len(parts) > 5
    words = [(b.words[int(n)].as_py(), bool(e)) for b in parts for n, e in zip(b.number, b.ends)]
    assert words == [(whole.words[int(n)].as_py(), bool(e)) for n, e in zip(whole.number, whole.ends)]


@pytest.mark.parametrize("seed", range(6))
def test_double_array_counts_all_positions(seed):
    pick = random.Random(seed)
    names = [f"w{n}" for n in range([1, 3, 8, 40, 200, 900][seed])]
    wanted = sorted({tuple(pick.choices(names, k=pick.choice([1, 2, 3]))) for _ in range(2000)})
    columns = [pa.array([p[k] if k < len(p) else None for p in wanted], pa.string()) for k in range(3)]
    trie = double_array.build(columns, np.arange(1, len(wanted) + 1))
    assert sorted(trie.phrase[trie.phrase > 0]) == list(range(1, len(wanted) + 1))
    text = pick.choices([*names, "elsewhere"], k=3000)
    ends = np.array([pick.random() < 0.2 for _ in text])
    ends[-1] = True
    times = trie.occurrences(trie.symbols(pa.array(text)), ends, 3)
    found = {wanted[trie.phrase[s] - 1]: int(times[s]) for s in np.flatnonzero(trie.phrase) if times[s]}
    known, counted = set(wanted), Counter()
    for at in range(len(text)):
        for k in (1, 2, 3):
            phrase = tuple(text[at : at + k])
            if len(phrase) == k and not ends[at : at + k - 1].any() and phrase in known:
                counted[phrase] += 1
    assert found == counted
