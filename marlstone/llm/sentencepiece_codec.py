"""SentencePiece ids and their decoding, each distinct marked word worked out once.

Where no piece of the vocabulary has a whitespace marker behind another character, no merge can
cross the place before a run of markers, and a text falls into marked words that are segmented
apart. Each distinct word is given to the sentencepiece library once; the ids and the decoded
string stand in a table, and a text's words are put together again by their position.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from marlstone.llm.common import id_and_text, in_slices

MARK = "▁"
# Bounds the table of a worker to about 250 MB; a full table is started again.
TABLE_ENTRIES = 800_000
# Longer words, as in text without spaces, are not worth keeping.
KEPT_CHARS = 64
MARKED_WORD = re.compile(r" +[^ ]*")


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


@lru_cache(maxsize=2)
def codec(path: str) -> Codec:
    """One codec per worker process, kept from task to task."""
    return Codec(path)


class Codec:
    def __init__(self, path: str):
        import sentencepiece

        self.model = sentencepiece.SentencePieceProcessor(model_file=path)
        pieces = [self.model.id_to_piece(i) for i in range(self.model.get_piece_size())]
        # Words part only if markers lead every piece, a text gets one marker in front, and the
        # model changes nothing else about it.
        probe = " a  b\tÁ "
        self.parts = not any(MARK in p.lstrip(MARK) for p in pieces) and (
            self.model.decode(self.model.encode(probe)) == probe
            and self.model.encode_as_pieces("a")[0].startswith(MARK)
        )
        # A piece to stand before a word in decoding, so that its first space is kept.
        self.before = self.model.encode("a")
        self.table: dict[str, tuple[bytes, str]] = {}

    def run(self, texts: list[str]) -> tuple[list[bytes], list[str]]:
        """Ids as little-endian 32-bit integers, and the decoded text, of each text."""
        if not self.parts:
            ids = self.model.encode(texts, num_threads=1)
            return [np.array(x, "<i4").tobytes() for x in ids], [self.model.decode(x) for x in ids]
        split = [marked_words(t) for t in texts]
        if len(self.table) > TABLE_ENTRIES:
            self.table = {}
        new = sorted({w for words in split for w in words if w not in self.table})
        found = dict(zip(new, self._segment(new)))
        self.table.update((w, x) for w, x in found.items() if len(w) <= KEPT_CHARS)
        if any(len(w) > KEPT_CHARS for w in new):
            return self._join(split, {**self.table, **found})
        return self._join(split, self.table)

    def _join(self, split, table) -> tuple[list[bytes], list[str]]:
        ids, decoded = [], []
        for words in split:
            entries = [table[w] for w in words]
            ids.append(b"".join([e[0] for e in entries]))
            # The marker put in front of the text is taken off again.
            decoded.append("".join([e[1] for e in entries])[1:])
        return ids, decoded

    def _segment(self, words: list[str]) -> list[tuple[bytes, str]]:
        """A word has its spaces in front; the library adds the first of them itself."""
        ids = self.model.encode([w[1:] for w in words], num_threads=1)
        # A single space is a marker alone, which the library would not add to an empty text.
        ids = [x if w != " " else [self.model.piece_to_id(MARK)] for w, x in zip(words, ids)]
        lead = len(self.model.decode(self.before))
        return [
            (np.array(x, "<i4").tobytes(), self.model.decode([*self.before, *x])[lead:])
            for x in ids
        ]


def marked_words(text: str) -> list[str]:
    """The words of a text with one space put in front, each with the spaces before it."""
    if not text:
        return []
    if MARK in text:
        text = text.replace(MARK, " ")
    if "  " in text or text[0] == " " or text[-1] == " ":
        return MARKED_WORD.findall(" " + text)
    return [" " + w for w in text.split(" ")]


def encode_decode(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", model: str | None = None
) -> DataFrame:
    """One row per document: doc_id, ids (array of int), decoded.

    No begin or end ids, no sampling. A null text counts as empty and has no ids. Rows are handled
    each for itself, so repeated rows and ids come out repeated; other columns are ignored; an
    empty table gives an empty result. The ids are the library's for the whole text, and `decoded`
    is what its decode gives for them.
    """
    model = model or default_path()
    rows = id_and_text(df, id_col, text_col)
    kind = rows.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(model)
        for batch in in_slices(batches, "text"):
            ids, decoded = own.run([t or "" for t in batch["text"].to_pylist()])
            ends = np.cumsum([0, *(len(x) // 4 for x in ids)])
            lists = pa.ListArray.from_arrays(
                pa.array(ends, pa.int32()), pa.array(np.frombuffer(b"".join(ids), "<i4"))
            )
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], lists, pa.array(decoded, pa.string())],
                names=["doc_id", "ids", "decoded"],
            )

    return rows.mapInArrow(run, f"doc_id {kind}, ids array<int>, decoded string")
