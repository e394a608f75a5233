import random
from collections import Counter

import numpy as np
import pytest

from marlstone.llm import ngram_join as join
from marlstone.llm.cell_sketch import without_ids
from marlstone.llm.connected import components
from tests.llm.conftest import by_row, prose

LOWER = {c: c + 32 for c in range(65, 91)}
SPACE = " \t\n\x0b\x0c\r"


def words_of(text):
    for c in SPACE:
        text = (text or "").replace(c, " ")
    return [w for w in text.translate(LOWER).split(" ") if w]


def shingle_set(text):
    words = words_of(text)
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def brute(rows):
    sets = [shingle_set(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(i):
        while parent[i] != i:
            i = parent[i]
        return i

    links = set()
    for i, a in enumerate(sets):
        for j in range(i):
            if a and sets[j] and 100 * len(a & sets[j]) >= 80 * len(a | sets[j]):
                links.add((j, i))
                parent[root(i)] = root(j)
    groups = {}
    for i, (doc_id, _) in enumerate(rows):
        groups.setdefault(root(i), []).append(doc_id)
    names = {
        k: min((d for d in ids if d is not None), default=None) for k, ids in groups.items()
    }
    out = [(d, len(sets[i]), names[root(i)]) for i, (d, _) in enumerate(rows)]
    return sorted(out, key=repr), links


def near_copies(seed=4, bases=6, copies=25):
    """Groups of near copies with more or less edits, and texts that share a long passage."""
    pick = random.Random(seed)
    texts = []
    for b in range(bases):
        words = prose(100 + b, 160).split()
        for _ in range(copies):
            own = list(words)
            for _ in range(pick.randint(0, 6)):
                own[pick.randrange(len(own))] = f"w{pick.randrange(10**6)}"
            texts.append(" ".join(own))
    passage = prose(50, 90)
    texts += [f"{prose(200 + k, pick.randint(3, 40))} {passage}" for k in range(40)]
    texts += [prose(300 + k, pick.randint(1, 60)) for k in range(60)]
    pick.shuffle(texts)
    return list(enumerate(texts))


def frame(spark, rows):
    return spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)


@pytest.mark.parametrize("rounds", [0, 2])
def test_matches_brute_force(spark, rounds):
    rows = near_copies()
    found = join.near_duplicates(frame(spark, rows), pivot_rounds=rounds)
    assert by_row(found) == brute(rows)[0]


def test_all_links(spark):
    rows = near_copies(seed=9, bases=3, copies=20)
    rows += [(1000 + i, t) for i, t in rows[:30]]
    links, sets = join.similar_sets(frame(spark, rows))
    docs = {}
    for r in sets.where("sid is not null").collect():
        docs.setdefault(r.sid, []).append(r.doc_id)
    found = by_row(links)
    assert len(found) == len(set(found)) and all(a < b for a, b in found)
    pairs = {tuple(sorted((x, y))) for a, b in found for x in docs[a] for y in docs[b]}
    pairs |= {(x, y) for ids in docs.values() for x in ids for y in ids if x < y}
    ids = [i for i, _ in rows]
    assert pairs == {tuple(sorted((ids[a], ids[b]))) for a, b in brute(rows)[1]}


def test_edge_cases(edge_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in edge_docs.collect()]
    assert by_row(join.near_duplicates(edge_docs)) == brute(rows)[0]
    assert join.near_duplicates(no_docs).count() == 0
    assert join.one_per_component(no_docs).schema.simpleString() == no_docs.schema.simpleString()


def test_the_threshold_is_exact(spark):
    base = [f"w{i}" for i in range(40)]
    rows = []
    for n, cut in enumerate((0, 6, 7, 8, 9)):
        rows.append((n, " ".join(base[cut:])))
    assert by_row(join.near_duplicates(frame(spark, rows))) == brute(rows)[0]


def test_one_per_component(edge_docs):
    left = join.one_per_component(edge_docs)
    assert left.schema.simpleString() == edge_docs.schema.simpleString()
    rows = [(r.doc_id, r.text) for r in edge_docs.collect()]
    stays = {i for i, n, c in brute(rows)[0] if i is None or i == c}
    expected = [(i, t) for i, t in rows if i in stays or i is None]
    assert by_row(left, "doc_id", "text") == sorted(expected, key=repr)


def test_prefix_holds_what_a_partner_must_share():
    for size in range(1, 300):
        need = -(-80 * size // 100)
        assert join.prefix_size(size) == size - need + 1


def test_reaches_and_its_bound():
    pick = random.Random(2)
    for _ in range(3000):
        whole = range(pick.randint(1, 200))
        a = set(pick.sample(whole, pick.randint(1, len(whole))))
        b = {x for x in a if pick.random() < 0.93} | {pick.randrange(900, 950)}
        x, y = (
            np.unique(np.array(sorted(s), np.uint64) * np.uint64(0xD1B54A32D192ED03))
            for s in (a, b)
        )
        assert join.reaches(x, y) == (100 * len(a & b) >= 80 * len(a | b))
        assert join.suffix_overlap(*map(join.part_sizes, (x, y))) >= len(a & b)


def test_shingles_count_distinct_windows():
    for text in ("a b c d e a b c d e a", "A B c", "é É a b c d", "a\x85b c d e f", " \n "):
        assert len(join.shingles(text)) == len(shingle_set(text))
    assert list(join.shingles("A b C")) == list(join.shingles("a B c"))


def test_components(spark):
    pick = random.Random(7)
    edges = [(pick.randrange(400), pick.randrange(400)) for _ in range(260)]
    edges += [(1000 + i, 1001 + i) for i in range(60)] + [(2000, 2000 + i) for i in range(1, 80)]
    found = dict(by_row(components(spark.createDataFrame(edges, "a bigint, b bigint"))))
    least = {}
    for a, b in edges:
        least.setdefault(a, a)
        least.setdefault(b, b)
    for _ in range(500):
        for a, b in edges:
            least[a] = least[b] = min(least[a], least[b])
    assert {n: found.get(n, n) for n in least} == least
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def test_without_ids(spark):
    df = spark.createDataFrame([(i, "t") for i in range(500)] + [(None, "n")], "id int, key string")
    gone = df.select(df.id.alias("doc_id")).where("doc_id % 3 = 0")
    left = without_ids(df, gone, "id")
    assert left.columns == ["id", "key"]
    assert Counter(r.id for r in left.collect()) == Counter(
        [i for i in range(500) if i % 3] + [None]
    )
