"""Token counts under a unigram model, worked out along a trie of distinct pre-tokens.

The best segmentation of a prefix does not depend on what follows it, so pre-tokens with a common
beginning share their forward scores: each trie node holds the best score of its prefix and the
number of tokens that reach it, worked out once from the nodes above. The node a pre-token ends at
thus stores its count. A text's count is the sum over its pre-tokens.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame

from marlstone.llm.common import id_and_text, in_slices
from marlstone.llm.sentencepiece_codec import MARK, default_path

# Bounds a worker's trie, and with it the table of counts, to about 350 MB; a full one is started
# again, which changes no count.
TRIE_NODES = 1_000_000
# What an unknown character scores below the worst piece; it counts a token for each byte.
UNKNOWN_BELOW = 10.0
# A longer pre-token (text without spaces) is run through by itself and leaves no nodes.
KEPT_CHARS = 64
MARKED_WORD = re.compile(f"{MARK}+[^{MARK}]*")


def zipf_scores(pieces: list[str]) -> dict[str, float]:
    """Log probabilities by Zipf's law: a piece of rank r is taken to occur 1 / r as often."""
    total = math.log(sum(1 / r for r in range(1, len(pieces) + 1)))
    return {piece: -math.log(r) - total for r, piece in enumerate(pieces, 1)}


def pieces_by_rank(path: str) -> list[str]:
    """The text pieces of a sentencepiece vocabulary in their order, without special ones."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    ids = range(model.get_piece_size())
    skip = (model.is_control, model.is_unknown, model.is_byte, model.is_unused)
    return [model.id_to_piece(i) for i in ids if not any(f(i) for f in skip)]


class Trie:
    """Forward scores and counts by prefix. Ties go to fewer tokens."""

    def __init__(self, scores: dict[str, float]):
        self.scores = scores
        self.unknown = min(scores.values(), default=0.0) - UNKNOWN_BELOW
        lengths: dict[str, set[int]] = {}
        for piece in scores:
            lengths.setdefault(piece[-1], set()).add(len(piece))
        # How long the pieces are that end in a character, so that only these are tried.
        self.lengths = {c: sorted(x) for c, x in lengths.items()}
        self.clear()

    def clear(self) -> None:
        self.children: list[dict[str, int] | None] = [None]
        self.best: list[tuple[float, int]] = [(0.0, 0)]
        self.counts: dict[str, int] = {}

    def count(self, word: str) -> int:
        """Tokens of the best segmentation, from the terminal node if the word came before."""
        found = self.counts.get(word)
        if found is None:
            found = self._insert(word) if len(word) <= KEPT_CHARS else self._run(word)
        return found

    def _insert(self, word: str) -> int:
        if len(self.best) > TRIE_NODES:
            self.clear()
        node, path = 0, [self.best[0]]
        for at, char in enumerate(word, 1):
            below = self.children[node]
            if below is None:
                below = self.children[node] = {}
            child = below.get(char)
            if child is None:
                child = below[char] = len(self.best)
                self.children.append(None)
                self.best.append(self._forward(word, at, path))
            node = child
            path.append(self.best[node])
        self.counts[word] = path[-1][1]
        return path[-1][1]

    def _run(self, word: str) -> int:
        path = [(0.0, 0)]
        for at in range(1, len(word) + 1):
            path.append(self._forward(word, at, path))
        return path[-1][1]

    def _forward(self, word: str, at: int, path: list[tuple[float, int]]) -> tuple[float, int]:
        """The best (score, tokens) over the pieces that end at `at`."""
        char = word[at - 1]
        before = path[at - 1]
        best = None
        for size in self.lengths.get(char, ()):
            if size > at:
                break
            score = self.scores.get(word[at - size : at])
            if score is not None:
                score += path[at - size][0]
                tokens = path[at - size][1] + 1
                if best is None or score > best[0] or score == best[0] and tokens < best[1]:
                    best = (score, tokens)
        if best is None or char not in self.scores:
            spelt = (before[0] + self.unknown, before[1] + len(char.encode("utf-8")))
            if best is None or spelt[0] > best[0]:
                best = spelt
        return best


def pre_tokens(text: str) -> list[str]:
    """Words, each with the markers for all spaces before it: no piece crosses from a word into one.

    One space is put in front of the text; spaces at its end are a pre-token by themselves.
    """
    if not text:
        return []
    if MARK in text:
        text = text.replace(MARK, " ")
    if "  " in text or text[0] == " " or text[-1] == " ":
        return MARKED_WORD.findall(MARK + text.replace(" ", MARK))
    return [MARK + w for w in text.split(" ")]


@lru_cache(maxsize=2)
def trie(path: str) -> Trie:
    """One trie per worker process, kept from task to task."""
    return Trie(zipf_scores(pieces_by_rank(path)))


def token_counts(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: str | None = None
) -> DataFrame:
    """One row per document: doc_id, n_pretokens, n_tokens.

    Pre-tokens are words with a marker in front for each space before them; their tokens are those
    of the most probable segmentation, ties going to fewer tokens, and a character no piece holds
    counts one per byte. A null text counts as empty and has none. Rows are counted each for itself,
    so repeated rows come out repeated; other columns are ignored; an empty table gives an empty
    result.
    """
    model = model or default_path()
    rows = id_and_text(df, id_col, text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = trie(model)
        for batch in in_slices(batches, "text"):
            n_words, n_tokens = [], []
            for text in batch["text"].to_pylist():
                words = pre_tokens(text or "")
                n_words.append(len(words))
                n_tokens.append(sum(map(own.count, words)))
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(n_words, pa.int64()), pa.array(n_tokens, pa.int64())],
                names=["doc_id", "n_pretokens", "n_tokens"],
            )

    return rows.mapInArrow(count, f"doc_id {kind}, n_pretokens bigint, n_tokens bigint")
