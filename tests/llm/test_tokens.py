import hashlib
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from marlstone.llm import packing, sentencepiece_codec, token_counts, token_files
from marlstone.llm.byte_bpe import Encoder, default_path
from marlstone.llm.merges import Merges
from marlstone.llm.queries import QUERIES
from marlstone.session import scratch_dir
from tests.llm.conftest import EDGE_TEXTS, by_row, prose

SCRAPS = [
    " ", "  ", "a", "th", "e", "\n", "\t", "▁", "é", "日本", "\U0001f600", "\x00", "0", ".", " the",
    "\r", "\xa0", " ", "　", "'s", " '", "\x85", "\x1c", " \n", "²", "Ⅷ", "ª", "﻿",
    "<|endoftext|>", "<s>", "Á",
]


def scrappy(n, seed=1):
    pick = random.Random(seed)
    return ["".join(pick.choices(SCRAPS, k=pick.randint(0, 14))) for _ in range(n)]


@pytest.fixture(scope="module")
def bpe():
    return Encoder(default_path())


def ids_of(bpe, texts):
    return [x.ids for x in bpe.tokenizer.encode_batch(texts, add_special_tokens=False)]


def plain_words(n, seed=2):
    """Texts of words, marks, line ends and single blanks, near the edges of what counts as plain."""
    pick = random.Random(seed)
    letters = "aetionhs" * 4 + "XÉéßüÀÖØöøÿ×÷ªºµĀſƀɏɐΩя'0_"
    texts = []
    for _ in range(n):
        text = ""
        for _ in range(pick.randint(0, 12)):
            word = "".join(pick.choices(letters, k=pick.choice([1, 2, 3, 5, 9, 14, 70])))
            marks = "".join(pick.choices(".,;:!?()[]{}*'\"-_~", k=pick.choice([0, 0, 0, 1, 2, 5])))
            text += word + marks + pick.choice([" ", " ", " ", "\n", "\n\n", "  ", "\r\n", ""])
        texts.append(text)
    return texts


def test_plain_words_equal_the_library(bpe):
    assert bpe.merges is not None
    texts = plain_words(4000)
    found = [np.frombuffer(x, bpe.dtype).tolist() for x in bpe.encode(texts)]
    assert found == ids_of(bpe, texts)


def test_merges_go_by_rank_then_place():
    pairs = np.array([[1, 1], [2, 3], [3, 4], [5, 1], [6, 4]])
    merges = Merges(pairs, np.array([5, 6, 7, 8, 9]))
    words = [[1, 1, 1], [2, 3, 4], [3, 4], [1], [1, 1, 1, 1, 1], [4, 2, 3, 4, 4], [9, 9]]
    starts = np.cumsum([0, *map(len, words[:-1])])
    flat, begin, size = merges.merged(np.concatenate(words), starts)
    made = [flat[b : b + n].tolist() for b, n in zip(begin, size)]
    assert made == [[8], [9], [7], [1], [5, 8], [4, 9, 4], [9, 9]]
    assert merges.rank(np.array([6, 1, 4]), np.array([4, 1, 6])).tolist()[:2] == [4, 0]


def test_arrays_with_nulls_offsets_and_nothing(bpe):
    texts = ["one two", None, "", "x\ny", "a  b", "three"]
    for array in (pa.array(texts), pa.array(["zz", *texts]).slice(1), pa.array([], pa.string())):
        ids, ends = bpe.encode_array(array)
        split = [x.tolist() for x in np.split(ids, ends)][: len(array)]
        assert split == ids_of(bpe, [x or "" for x in array.to_pylist()])


def test_byte_bpe_equals_the_library(bpe):
    texts = scrappy(4000) + [t or "" for t in EDGE_TEXTS]
    found = [np.frombuffer(x, bpe.dtype).tolist() for x in bpe.encode(texts)]
    assert found == ids_of(bpe, texts)
    assert [np.frombuffer(x, bpe.dtype).tolist() for x in bpe.encode(texts)] == found


def test_sentencepiece_equals_the_library():
    codec = sentencepiece_codec.Codec(sentencepiece_codec.default_path())
    texts = scrappy(4000, 2) + [t or "" for t in EDGE_TEXTS] + ["word" * 40 + " again"]
    ids = codec.model.encode(texts, num_threads=1)
    found, decoded = codec.run(texts)
    assert [np.frombuffer(x, "<i4").tolist() for x in found] == ids
    assert decoded == [codec.model.decode(x) for x in ids]
    codec.parts = False
    assert codec.run(texts) == (found, decoded)


def test_sentencepiece_query(spark, edge_docs, no_docs, tmp_path):
    edge_docs.write.parquet(str(tmp_path / "documents.parquet"))
    model = sentencepiece_codec.codec(sentencepiece_codec.default_path()).model
    expected = []
    for row in edge_docs.collect():
        ids = model.encode(row.text or "")
        digest = hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        decoded = hashlib.sha256(model.decode(ids).encode()).hexdigest()
        expected.append((row.doc_id, len(ids), digest, decoded))
    found = by_row(QUERIES["op7_sentencepiece"](spark, str(tmp_path)))
    assert found == sorted(expected, key=repr)
    assert sentencepiece_codec.encode_decode(no_docs).count() == 0


def test_ranks_round_trip():
    pick = np.random.default_rng(1)
    for size in (1, 2, 3, 4, 5, 1000):
        ranks = pick.integers(0, [1 << 32, 300, 70000][size % 3], size, dtype=np.uint64)
        control, data = token_files.encode_ranks(ranks)
        assert len(control) == -(-size // 4)
        assert token_files.decode_ranks(control, data, size).tolist() == ranks.tolist()


def test_frequent_ids_take_one_byte():
    control, data = token_files.encode_ranks(np.arange(256))
    assert len(data) == 256 and set(control) == {0}


def expected_files(bpe, rows):
    out, start = [], 0
    for doc_id, text in sorted(rows, key=lambda r: (r[0] is not None, r[0])):
        ids = np.array([*ids_of(bpe, [text or ""])[0], 2], "<u4")
        out.append((doc_id, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_token_files_query(spark, bpe, tmp_path):
    rows = [(i * 8 % 301, t) for i, t in enumerate((EDGE_TEXTS + scrappy(250, 3))[:260])]
    rows.append((None, "no id"))
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    df.write.parquet(str(tmp_path / "documents.parquet"))
    found = by_row(QUERIES["op9_token_files"](spark, str(tmp_path)))
    assert found == sorted(expected_files(bpe, rows), key=repr)


def test_token_files_edge_cases(spark, bpe, edge_docs, no_docs):
    path = scratch_dir(spark, "files")
    token_files.write_token_files(edge_docs, path)
    found = token_files.read_token_files(spark, path).collect()
    texts = sorted((r.doc_id is not None, r.doc_id, r.text or "") for r in edge_docs.collect()
                   if r.doc_id is not None)
    assert len(found) == edge_docs.count()
    total = 0
    for row in sorted(found, key=lambda r: r.start):
        assert row.start == total and len(row.ids) == 4 * row.n_tokens
        total += row.n_tokens
    ids = {(r.doc_id, bytes(r.ids)) for r in found if r.doc_id is not None}
    assert ids == {
        (i, np.array([*ids_of(bpe, [t])[0], 2], "<u4").tobytes()) for _, i, t in texts
    }
    empty = scratch_dir(spark, "files")
    token_files.write_token_files(no_docs, empty)
    assert token_files.read_token_files(spark, empty).count() == 0


def test_fullest_is_the_best_subset_sum():
    pick = random.Random(6)
    for _ in range(300):
        counts = {pick.randint(1, 30): pick.randint(1, 4) for _ in range(pick.randint(1, 6))}
        room = pick.randint(1, 60)
        sums = {0}
        for size, n in counts.items():
            sums = {s + k * size for s in sums for k in range(n + 1)}
        used = packing.fullest(counts, room)
        assert sum(s * n for s, n in used.items()) == max(s for s in sums if s <= room)
        assert all(0 < n <= counts[s] for s, n in used.items())


def test_plan_places_every_length_once():
    pick = random.Random(8)
    histogram = {pick.randint(1, 64): pick.randint(1, 500) for _ in range(40)}
    rows = packing.plan(histogram, 64)
    room, placed = {}, dict.fromkeys(histogram, 0)
    starts = {}
    for row in rows:
        starts.setdefault(row[0], []).append(row)
    for size, own in starts.items():
        own.sort(key=lambda r: r[1])
        ends = [r[1] for r in own[1:]] + [histogram[size]]
        assert own[0][1] == 0
        for (_, first, sequence, uses, _, _), end in zip(own, ends):
            for rank in range(first, end):
                s = sequence + (rank - first) // uses
                room[s] = room.get(s, 0) + size
                placed[size] += 1
    assert placed == histogram
    assert max(room.values()) <= 64 and sorted(room) == list(range(len(room)))
    waste = 64 * len(room) - sum(room.values())
    assert waste < 0.03 * 64 * len(room)


def check_packing(bpe, rows, pieces, window=2048):
    by_doc, sequences = {}, {}
    for p in pieces:
        ids = np.frombuffer(p.ids, "<u4")
        assert len(ids) == p.length and zlib.crc32(bytes(p.ids)) == p.ids_crc32
        by_doc.setdefault(p.doc_id, []).append((p.start, ids, p.doc_tokens))
        sequences.setdefault(p.sequence_id, []).append((p.offset, p.length, p.padded_length))
    expected = {}
    for doc_id, text in rows:
        expected.setdefault(doc_id, []).append([*ids_of(bpe, [text or ""])[0], 1])
    for doc_id, texts in expected.items():
        got = sorted((start, total, ids.tolist()) for start, ids, total in by_doc[doc_id])
        want = sorted(
            (at, len(t), t[at : at + window]) for t in texts for at in range(0, len(t), window)
        )
        assert got == want
    for parts in sequences.values():
        at = 0
        for offset, length, padded in sorted(parts):
            assert offset == at
            at += length
        assert at <= window and padded == (at if at & (at - 1) == 0 else window)
    return sequences


def test_packing(spark, bpe):
    rows = [(i, prose(i, 3 + i * 13 % 700)) for i in range(400)] + [(400, prose(1, 9000))]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    pieces = packing.pack(df).collect()
    sequences = check_packing(bpe, rows, pieces)
    total = sum(p.length for p in pieces)
    assert len(sequences) * 2048 - total < 3 * 2048


def test_packing_edge_cases(bpe, edge_docs, no_docs):
    rows = [(r.doc_id, r.text) for r in edge_docs.collect()]
    check_packing(bpe, rows, packing.pack(edge_docs).collect())
    assert packing.pack(no_docs).count() == 0


def test_many_documents_of_one_length(spark, bpe):
    rows = [(i, "same") for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)
    sequences = check_packing(bpe, rows, packing.pack(df).collect())
    assert len(sequences) == 3


def brute_count(word, scores, unknown):
    best = [(0.0, 0)]
    for end in range(1, len(word) + 1):
        options = [
            (best[a][0] + scores[word[a:end]], -(best[a][1] + 1))
            for a in range(end) if word[a:end] in scores
        ]
        if word[end - 1] not in scores:
            cost = len(word[end - 1].encode())
            options.append((best[end - 1][0] + unknown, -(best[end - 1][1] + cost)))
        score, tokens = max(options)
        best.append((score, -tokens))
    return best[-1][1]


def test_trie_counts_match_brute_force():
    trie = token_counts.Trie(
        token_counts.zipf_scores(token_counts.pieces_by_rank(sentencepiece_codec.default_path()))
    )
    words = {w for t in scrappy(300, 4) + [prose(4, 400)] for w in token_counts.pre_tokens(t)}
    words.add("▁" + "long" * 40)
    for _ in range(2):
        for word in words:
            assert trie.count(word) == brute_count(word, trie.scores, trie.unknown)
        trie.clear()


def test_a_full_trie_starts_again(monkeypatch):
    monkeypatch.setattr(token_counts, "TRIE_NODES", 20)
    trie = token_counts.Trie({"a": -1.0, "ab": -1.5, "b": -1.0, "c": -2.0, "abc": -4.0})
    words = ["abc", "abab", "cab", "bca", "aabb", "é", "abé"] * 3
    assert [trie.count(w) for w in words] == [
        brute_count(w, trie.scores, trie.unknown) for w in words
    ]


def test_shared_beginnings_share_nodes():
    trie = token_counts.Trie({"a": -1.0, "b": -1.0})
    trie.count("aab")
    trie.count("aaa")
    assert len(trie.best) == 1 + 4


def test_token_counts(edge_docs, no_docs):
    trie = token_counts.trie(sentencepiece_codec.default_path())
    expected = []
    for row in edge_docs.collect():
        words = token_counts.pre_tokens(row.text or "")
        tokens = sum(brute_count(w, trie.scores, trie.unknown) for w in set(words)
                     for _ in range(words.count(w)) if len(w) < 100) if row.text else 0
        long = [w for w in words if len(w) >= 100]
        tokens += sum(trie.count(w) for w in long)
        expected.append((row.doc_id, len(words), tokens))
    assert by_row(token_counts.token_counts(edge_docs)) == sorted(expected, key=repr)
    assert token_counts.token_counts(no_docs).count() == 0


def test_runs_of_spaces_are_segmented_whole():
    path = sentencepiece_codec.default_path()
    trie = token_counts.trie(path)
    scores = token_counts.zipf_scores(token_counts.pieces_by_rank(path))
    texts = ["def f():\n    return  1", "a        b", "  lead", "tail   ", " ", " " * 40 + "x y", "a▁ b"]
    for text in [*texts, *scrappy(60, 9)]:
        found = sum(map(trie.count, token_counts.pre_tokens(text)))
        whole = "▁" + text.replace(" ", "▁")
        assert found == (brute_count(whole, scores, trie.unknown) if text else 0)
    assert token_counts.pre_tokens("a  b ") == ["▁a", "▁▁b", "▁"]
