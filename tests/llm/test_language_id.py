import random
import zlib
from itertools import product

import numpy as np
import pytest

from marlstone.llm import language_id as ids
from marlstone.llm.queries import QUERIES
from tests.llm.conftest import EDGE_TEXTS

EN = "The quick brown fox jumps over the lazy dog while they were thinking about that with nothing"
DE = "Der schnelle braune Fuchs springt über den faulen Hund und die Katze schläft nicht auf dem Dach"
RU = "Быстрая коричневая лиса прыгает через ленивую собаку и потом снова бежит домой"
EL = "Η γρήγορη καφέ αλεπού πηδάει πάνω από το τεμπέλικο σκυλί και μετά γυρίζει σπίτι"


@pytest.fixture(scope="module")
def languages(spark):
    rows = [(t, lang) for lang, t in (("en", EN), ("de", DE), ("ru", RU), ("el", EL))] * 3
    rows += [(None, "fr"), ("mot", None)]
    return ids.learn(spark.createDataFrame(rows, "text string, lang string"))


def best_by_trying(scores, penalty):
    def worth(path):
        return sum(scores[n, x] for n, x in enumerate(path)) - penalty * sum(
            a != b for a, b in zip(path, path[1:])
        )

    return max(map(worth, product(range(scores.shape[1]), repeat=len(scores)))), worth


def test_labelling_is_the_best_there_is():
    pick = np.random.default_rng(4)
    counts = np.array([3, 0, 6, 1, 5, 0])
    scores = pick.normal(size=(counts.sum(), 3)) * 2
    labels = ids.best_labels(scores, counts, 1.5)
    at = 0
    for n in counts:
        best, worth = best_by_trying(scores[at : at + n], 1.5) if n else (0, lambda p: 0)
        assert worth(labels[at : at + n]) == pytest.approx(best)
        at += n


def test_words_pieces_and_counts():
    text = "Ab, c日本かな\0x1y " + "z" * 600 + "Я²"
    words = ids.words_of(ids.code_points(text))
    found = [text[a:b] for a, b in zip(words.starts, words.ends)]
    assert found == ["Ab", "c", "日本", "かな", "x", "y", "z" * 256, "z" * 256, "z" * 88, "Я"]
    assert np.diff(np.append(words.first, len(words.pairs))).tolist() == [len(w) + 1 for w in found]
    # One letter after the same two (or after a word's start) is counted alike, in any case.
    one, two = ids.words_of(ids.code_points("The bathe")), ids.words_of(ids.code_points("tHE"))
    assert set(two.triples[2:]) <= set(one.triples[4:])
    assert one.triples[:4].tolist() == two.triples.tolist()
    pick = random.Random(1)
    for _ in range(50):
        codes = ids.code_points("".join(pick.choices("aaab  \0", k=pick.randint(0, 60))))
        parts = list(ids.pieces(codes, 7))
        assert b"".join(p.tobytes() for _, p in parts) == codes.tobytes()
        split = [codes[o + a : o + b].tobytes() for o, p in parts
                 for a, b in zip(ids.words_of(p).starts, ids.words_of(p).ends)]
        whole = ids.words_of(codes)
        assert split == [codes[a:b].tobytes() for a, b in zip(whole.starts, whole.ends)]


def test_scripts_narrow_and_spans_follow_the_text(spark, languages):
    assert languages.names == ["de", "el", "en", "ru"]
    latin, cyrillic = 1, 3
    assert languages.allowed[latin].tolist() == [True, False, True, False]
    assert languages.allowed[cyrillic].tolist() == [False, False, False, True]
    text = "12 " + EN + ". " + RU + " — " + DE + "! "
    [(lang, score, spans)] = ids.label_texts(languages, [text], 8.0)
    assert [s["lang"] for s in spans] == ["en", "ru", "de"]
    assert [text[s["start"] : s["end"]] for s in spans] == [EN, RU, DE]
    letters = {x: sum(map(str.isalpha, t)) for x, t in (("en", EN), ("ru", RU), ("de", DE))}
    assert lang == max(letters, key=letters.get)
    assert score == pytest.approx(max(letters.values()) / sum(letters.values()))


def test_alone_or_together_the_same(languages):
    texts = [EN, "", None, RU + EN, "123", DE * 40, EL, "ß", "日本", "\ud800 x", EN.upper()]
    together = ids.label_texts(languages, texts, 8.0)
    assert together == [ids.label_texts(languages, [t], 8.0)[0] for t in texts]
    assert [x[0] for x in together][:5] == ["en", "und", "und", "en", "und"]
    assert all(0 <= x[1] <= 1 for x in together)


def test_edges(spark, edge_docs, no_docs, languages):
    found = ids.label_languages(edge_docs, languages).collect()
    assert len(found) == len(EDGE_TEXTS) + 4
    by_id = {r.doc_id: r for r in found if r.doc_id is not None}
    for n, text in enumerate(EDGE_TEXTS):
        has_letter = any(map(str.isalpha, text or ""))
        assert (by_id[n].lang_pred == "und") == (not has_letter)
    assert ids.label_languages(no_docs, languages).collect() == []
    nothing = ids.learn(no_docs.selectExpr("text", "kept AS lang"))
    assert {r.lang_pred for r in ids.label_languages(edge_docs, nothing).collect()} == {"und"}


def test_partitions_do_not_matter(spark, languages):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text")
    runs = [
        sorted(map(repr, ids.label_languages(docs.repartition(n), languages).collect()))
        for n in (1, 7)
    ]
    assert runs[0] == runs[1]


def test_held_out_documents_get_their_language(spark):
    found = QUERIES["op12_language_id"](spark, "/root/testdata/sf0.01")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet").select("doc_id", "lang")
    rows = found.join(docs, "doc_id").collect()
    assert len(rows) == 1000
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang == r.lang_pred for r in held) >= 0.98 * len(held) > 100
