"""Ids of a byte-level BPE tokenizer, worked out for the distinct pieces of many texts at once.

The tokenizer never merges across the place before a blank or line feed that has a non-space after
it, nor behind such a line feed, so a text falls into pieces that can be encoded apart. A piece that
is a word of Latin letters, perhaps with ASCII punctuation behind it, is cut by the tokenizer's
pattern between the two, and the merges of all of these are made side by side. Other pieces are
encoded by the `tokenizers` library, many to a call; texts with other spacing, or with the string
of a special token in them, go to the library whole. Nothing is kept from one slice to the next.
"""

from __future__ import annotations

import json
import os
from functools import lru_cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from marlstone.llm.merges import Merges

os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")

MISSES_AT_ONCE = 20_000
# Longer words have many merges one after the other, and are left to the library.
LONGEST_WORD = 64

# What the bytes of a plain word can be.
OTHER, LETTER, MARK = range(3)
ASCII_LETTERS = [*range(65, 91), *range(97, 123)]
ASCII_MARKS = [*range(33, 48), *range(58, 65), *range(91, 97), *range(123, 127)]
KIND = np.zeros(256, np.uint8)
KIND[ASCII_LETTERS], KIND[ASCII_MARKS] = LETTER, MARK


def byte_letters() -> dict[int, str]:
    """The letter that stands for each byte in a byte-level vocabulary.

    Printable bytes stand for themselves, the others for the letters from 256 on, in order.
    """
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in plain]
    return {b: chr(b) for b in plain} | {b: chr(256 + n) for n, b in enumerate(others)}


def kinds_of(letters: np.ndarray) -> np.ndarray:
    """Letter, mark or other, byte by byte.

    Of two-byte characters those from U+00C0 to U+024F are letters, but for two signs.
    """
    kinds = KIND[letters]
    lead = (letters >= 0xC3) & (letters <= 0xC9)
    second = np.append(letters[1:], 0)
    sign = (letters == 0xC3) & ((second == 0x97) | (second == 0xB7))
    lead &= ~sign & ~((letters == 0xC9) & (second >= 0x90))
    kinds[lead] = LETTER
    kinds[1:][lead[:-1]] = LETTER
    return kinds


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder per worker process, kept from task to task."""
    return Encoder(path)


class Encoder:
    def __init__(self, path: str):
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        added = self.tokenizer.get_added_tokens_decoder().values()
        self.special = tuple(token.content for token in added)
        size = self.tokenizer.get_vocab_size()
        self.dtype = np.dtype("<u2" if size <= 1 << 16 else "<u4")
        self.mark, self.line_feed = self._whole(["\t", "\n"])
        self.merges = self._merges()

    def _merges(self) -> Merges | None:
        """The merges of a byte-level model that cuts texts by the usual pattern, else None."""
        given = json.loads(self.tokenizer.to_str())
        model, cut = given["model"], given["pre_tokenizer"] or {}
        usual = {"type": "ByteLevel", "add_prefix_space": False, "use_regex": True}
        odd = ("dropout", "continuing_subword_prefix", "end_of_word_suffix", "ignore_merges")
        if given["normalizer"] or not usual.items() <= cut.items() or model["type"] != "BPE":
            return None
        vocabulary, letters = model["vocab"], byte_letters()
        if any(model.get(name) for name in odd) or any(x not in vocabulary for x in letters.values()):
            return None
        self.byte_ids = np.array([vocabulary[letters[b]] for b in range(256)])
        pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        numbers = np.array([[vocabulary[a], vocabulary[b]] for a, b in pairs]).reshape(-1, 2)
        return Merges(numbers, np.array([vocabulary[a + b] for a, b in pairs], np.int64))

    def _whole(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(x.ids, self.dtype).tobytes() for x in found]

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian integers of `dtype`."""
        ids, ends = self.encode_array(pa.array(texts, pa.large_string()))
        raw, size = ids.tobytes(), self.dtype.itemsize
        return [raw[a * size : b * size] for a, b in zip([0, *ends[:-1]], ends)]

    def encode_array(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after the other, and where each text's end; nulls are empty."""
        texts = pc.fill_null(texts.cast(pa.large_string()), "")
        count = len(texts)
        offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset :][: count + 1]
        data = texts.buffers()[2] or pa.py_buffer(b"")
        letters = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]]
        starts = offsets[:-1] - offsets[0]
        # A piece begins with a text, a blank or a line feed.
        cut = (letters == 32) | (letters == 10)
        cut[starts[starts < len(letters)]] = True
        cuts = np.flatnonzero(cut)
        buffers = [None, pa.py_buffer(np.append(cuts, len(letters))), pa.py_buffer(letters)]
        pieces = pa.Array.from_buffers(pa.large_string(), len(cuts), buffers).dictionary_encode()
        place = pieces.indices.to_numpy().astype(np.int64)
        flat, begin, size = self._distinct(pieces.dictionary)

        text_of = np.searchsorted(starts, cuts, side="right") - 1
        whole = set(text_of[size[place] < 0].tolist()) if (size < 0).any() else set()
        raw = memoryview(letters)
        if any(s.encode() in raw.tobytes() for s in self.special):
            whole |= {n for n, t in enumerate(texts.to_pylist()) if any(s in t for s in self.special)}
        chosen = sorted(whole)
        extra = self._whole([texts[n].as_py() for n in chosen]) if chosen else []

        # The ids of the distinct pieces, then those of the texts encoded whole.
        known = len(size)
        if chosen:
            more = np.array([len(x) for x in extra], np.int64) // self.dtype.itemsize
            begin = np.concatenate([begin, len(flat) + np.cumsum(more) - more])
            size = np.concatenate([size, more])
            flat = np.concatenate([flat, np.frombuffer(b"".join(extra), self.dtype)])
        if chosen:
            is_whole = np.zeros(count, bool)
            is_whole[chosen] = True
            kept = ~is_whole[text_of]
            place = np.concatenate([place[kept], known + np.arange(len(chosen))])
            text_of = np.concatenate([text_of[kept], np.array(chosen)])
            order = np.argsort(text_of, kind="stable")
            place, text_of = place[order], text_of[order]
        sizes = size[place]
        ids = flat[gathered(begin[place], sizes)]
        return ids, np.cumsum(np.bincount(text_of, sizes, count).astype(np.int64))

    def _distinct(self, pieces: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of distinct pieces, and where each one's begin and how many it has.

        A size of -1 marks a piece the text has to be encoded whole for: one with more white space
        behind its blank or line feed, or none.
        """
        count = len(pieces)
        if not count:
            return np.zeros(0, self.dtype), np.zeros(0, np.int64), np.zeros(0, np.int64)
        offsets = np.frombuffer(pieces.buffers()[1], np.int64)[pieces.offset :][: count + 1]
        letters = np.frombuffer(pieces.buffers()[2], np.uint8)[: offsets[-1]]
        starts, ends = offsets[:-1], offsets[1:]
        lead = letters[starts]
        spaced, line = lead == 32, lead == 10
        first = starts + (spaced | line)
        plain = np.zeros(count, bool)
        if self.merges is not None:
            plain = self._plain(letters, first, ends)
        odd = np.flatnonzero(~plain)
        found = self._odd(pieces.take(pa.array(odd)).to_pylist())
        begin, size = np.zeros(count, np.int64), np.zeros(count, np.int64)
        known = np.array([-1 if x is None else len(x) for x in found], np.int64)
        size[odd] = np.where(known < 0, -1, known // self.dtype.itemsize)
        held = np.maximum(size[odd], 0)
        begin[odd] = np.cumsum(held) - held
        flat = np.frombuffer(b"".join(x or b"" for x in found), self.dtype)
        if not plain.any():
            return flat, begin, size

        # Letters with the blank before them, then marks: two words each, the second often empty.
        kinds = kinds_of(letters)
        own = np.flatnonzero(plain)
        marks = np.concatenate([[0], np.cumsum(kinds == MARK)])
        bound = ends[own] - (marks[ends[own]] - marks[first[own]])
        word = starts[own] + line[own]
        wanted = np.stack([word, bound], 1).ravel()
        lengths = np.stack([bound - word, ends[own] - bound], 1).ravel()
        real = lengths > 0
        wanted, lengths = wanted[real], lengths[real]
        symbols = self.byte_ids[letters[gathered(wanted, lengths)]]
        made, at, sizes = self.merges.merged(symbols, np.cumsum(lengths) - lengths)
        # Both words of a piece one after the other, a line feed's id before them.
        feed = int(np.frombuffer(self.line_feed, self.dtype)[0])
        made = np.append(made, feed)
        owner = np.repeat(np.arange(len(own)), 2)[real]
        place = np.concatenate([owner, np.flatnonzero(line[own])])
        at = np.concatenate([at, np.full(len(place) - len(owner), len(made) - 1)])
        sizes = np.concatenate([sizes, np.ones(len(place) - len(owner), np.int64)])
        turn = np.concatenate([np.ones(len(owner), np.int8), np.zeros(len(place) - len(owner), np.int8)])
        order = np.lexsort((turn, place))
        plain_ids = made[gathered(at[order], sizes[order])].astype(self.dtype)
        total = np.bincount(place, sizes, len(own)).astype(np.int64)
        size[own] = total
        begin[own] = len(flat) + np.cumsum(total) - total
        return np.concatenate([flat, plain_ids]), begin, size

    def _plain(self, letters: np.ndarray, first: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Which pieces are letters, one at least, and then marks, from their first byte on."""
        kinds = kinds_of(letters)
        at = np.minimum(first, len(letters) - 1)
        others = np.concatenate([[0], np.cumsum(kinds == OTHER)])
        back = np.zeros(len(letters) + 1, np.int64)
        back[2:] = np.cumsum((kinds[1:] == LETTER) & (kinds[:-1] == MARK))
        after = np.minimum(at + 1, len(letters))
        return (
            (first < ends)
            & (kinds[at] == LETTER)
            & (others[ends] == others[at])
            & (back[ends] == back[after])
            & (ends - first <= LONGEST_WORD)
        )

    def _odd(self, pieces: list[str]) -> list[bytes | None]:
        """The ids of other pieces from the library; None where a text has to be encoded whole."""
        found: dict[str, bytes] = {}
        heads = [x for x in pieces if x[0] not in " \n"]
        words = [x[1:] for x in pieces if x[0] == " " and len(x) > 1 and not x[1].isspace()]
        lines = [x[1:] for x in pieces if x[0] == "\n" and len(x) > 1 and not x[1].isspace()]
        for some, lead, before in ((heads, "", b""), (words, " ", b""), (lines, "", self.line_feed)):
            fresh: dict[str, bytes] = {}
            self._fill(fresh, some, lead)
            mark = "\n" if before else lead
            found.update((mark + x, before + ids) for x, ids in fresh.items())
        return [found.get(x) for x in pieces]

    def _fill(self, into: dict[str, bytes], pieces: list[str], lead: str) -> None:
        """Encode pieces many to a call, told apart by tabs, which no other id stands for."""
        plain, odd = [], []
        for x in pieces:
            (odd if not x or "\t" in x or x[0].isspace() or x[-1].isspace() else plain).append(x)
        for at in range(0, len(plain), MISSES_AT_ONCE):
            some = plain[at : at + MISSES_AT_ONCE]
            joined = "".join(f"\t{lead}{x}" for x in some) + "\t"
            ids = np.frombuffer(self._whole([joined])[0], self.dtype)
            cuts = np.flatnonzero(ids == np.frombuffer(self.mark, self.dtype)[0])
            if len(cuts) != len(some) + 1:
                odd += some
                continue
            into.update(
                (x, ids[a + 1 : b].tobytes()) for x, a, b in zip(some, cuts[:-1], cuts[1:])
            )
        if odd:
            into.update(zip(odd, self._whole([lead + x for x in odd])))


def gathered(begin: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places of runs that begin somewhere and have some length, run after run."""
    before = np.cumsum(sizes) - sizes
    return np.repeat(begin - before, sizes) + np.arange(int(sizes.sum()))
