"""The languages of a text, span by span.

A word is a run of letters of one script. Each language has counts of letter triples and of the
pairs they begin with, in a fixed number of cells, and of letters per script. A word's script
narrows the languages it may be in; its score in each of these is the log probability of its
letters given the two before. The best labelling of a text's words, with a penalty for every change
of language, is found by Viterbi's method for all texts of a slice at once, word by word.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from marlstone.llm.common import SLICE_BYTES, col, in_slices

UNKNOWN = "und"
CELLS = 1 << 16
# Of each script's letters, a language that may be written in it holds this share of its own.
SCRIPT_SHARE = 0.01
SMOOTHING, ALPHABET = 0.1, 100
SWITCH_PENALTY = 8.0
# A word outside its candidates; far beyond what all penalties of a long text could weigh.
RULED_OUT = -1e9
# Runs of letters of one script are cut into words of this many letters at most.
LONGEST_WORD = 256
# Characters scored at a time.
PIECE = 1 << 20

# Blocks of the Unicode standard by script. Letters elsewhere are one more script.
SCRIPTS = (
    ("Latin", ((0x41, 0x24F), (0x250, 0x2AF), (0x1E00, 0x1EFF), (0xFF21, 0xFF5A))),
    ("Greek", ((0x370, 0x3FF), (0x1F00, 0x1FFF))),
    ("Cyrillic", ((0x400, 0x52F), (0x1C80, 0x1C8F), (0x2DE0, 0x2DFF), (0xA640, 0xA69F))),
    ("Armenian", ((0x530, 0x58F),)),
    ("Hebrew", ((0x590, 0x5FF),)),
    ("Arabic", ((0x600, 0x6FF), (0x750, 0x77F), (0x8A0, 0x8FF), (0xFB50, 0xFDFF), (0xFE70, 0xFEFF))),
    ("Devanagari", ((0x900, 0x97F),)),
    ("Bengali", ((0x980, 0x9FF),)),
    ("Gurmukhi", ((0xA00, 0xA7F),)),
    ("Gujarati", ((0xA80, 0xAFF),)),
    ("Tamil", ((0xB80, 0xBFF),)),
    ("Telugu", ((0xC00, 0xC7F),)),
    ("Kannada", ((0xC80, 0xCFF),)),
    ("Malayalam", ((0xD00, 0xD7F),)),
    ("Sinhala", ((0xD80, 0xDFF),)),
    ("Thai", ((0xE00, 0xE7F),)),
    ("Lao", ((0xE80, 0xEFF),)),
    ("Georgian", ((0x10A0, 0x10FF), (0x1C90, 0x1CBF))),
    ("Ethiopic", ((0x1200, 0x139F),)),
    ("Khmer", ((0x1780, 0x17FF),)),
    ("Hangul", ((0x1100, 0x11FF), (0x3130, 0x318F), (0xAC00, 0xD7AF))),
    ("Hiragana", ((0x3040, 0x309F),)),
    ("Katakana", ((0x30A0, 0x30FF), (0xFF66, 0xFF9D))),
    ("Han", ((0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0x20000, 0x323AF))),
)
OTHER = len(SCRIPTS) + 1

PAIR, TRIPLE, SCRIPT = range(3)
COUNTED = "lang string, kind int, cell int, n long"


@lru_cache(maxsize=1)
def tables() -> tuple[np.ndarray, np.ndarray]:
    """Per code point: its script (0 for what is no letter), and it in lower case."""
    points = range(0x110000)
    script = np.fromiter((chr(c).isalpha() for c in points), np.uint8, 0x110000) * np.uint8(OTHER)
    for number, (_, blocks) in enumerate(SCRIPTS, 1):
        for first, last in blocks:
            block = script[first : last + 1]
            block[block > 0] = number
    lower = np.arange(0x110000, dtype=np.uint32)
    for c in np.flatnonzero(script):
        small = chr(c).lower()
        if len(small) == 1:
            lower[c] = ord(small)
    return script, lower


@dataclass
class Words:
    """The words of a run of code points, with their letter pairs and triples in cells."""

    starts: np.ndarray
    ends: np.ndarray
    scripts: np.ndarray
    first: np.ndarray  # where each word's part of `pairs` and `triples` begins
    pairs: np.ndarray
    triples: np.ndarray


def words_of(codes: np.ndarray) -> Words:
    script, lower = tables()
    scripts = script[codes]
    at = np.flatnonzero(scripts)
    own = scripts[at]
    new = np.ones(len(at), bool)
    new[1:] = (at[1:] != at[:-1] + 1) | (own[1:] != own[:-1])
    heads = np.flatnonzero(new)
    within = np.arange(len(at)) - np.repeat(heads, np.diff(np.append(heads, len(at))))
    new |= (within % LONGEST_WORD == 0) & (within > 0)
    heads = np.flatnonzero(new)
    tails = np.append(heads[1:], len(at))[: len(heads)] - 1
    number = np.cumsum(new) - 1
    # All words in a row, a zero before the first and after each.
    line = np.zeros(len(at) + len(heads) + 1, np.uint64)
    line[np.arange(len(at)) + number + 1] = lower[codes[at]]
    before = line[:-1]
    two_before = np.concatenate([np.zeros(1, np.uint64), line[:-2]]) if len(line) > 1 else line[:0]
    two_before = np.where(before == 0, np.uint64(0), two_before)
    mixed = two_before * np.uint64(0x9E3779B97F4A7C15) + before * np.uint64(0xC2B2AE3D27D4EB4F)
    pairs = _cell(mixed)
    triples = _cell(mixed + line[1:] * np.uint64(0x165667B19E3779F9))
    return Words(
        at[heads], at[tails] + 1, own[heads], heads + np.arange(len(heads)), pairs, triples
    )


def _cell(mixed: np.ndarray) -> np.ndarray:
    mixed = (mixed ^ (mixed >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return (mixed >> np.uint64(48)).astype(np.int64)


def code_points(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def pieces(codes: np.ndarray, size: int = PIECE) -> Iterator[tuple[int, np.ndarray]]:
    """`codes` in parts that end where no letter stands, with their offsets."""
    script, _ = tables()
    begin = 0
    while begin < len(codes):
        end = begin + size
        while end < len(codes):
            gaps = np.flatnonzero(script[codes[end - size : end]] == 0)
            if len(gaps):
                end += int(gaps[-1]) + 1 - size
                break
            end += size
        end = min(end, len(codes))
        yield begin, codes[begin:end]
        begin = end


def learn(
    train: DataFrame, text_col: str = "text", lang_col: str = "lang"
) -> Languages:
    """Counts of all rows of `train` with a text and a language.

    What comes to the driver is bounded by the languages times the cells. Repeated rows count
    again; other columns are ignored; an empty table gives no languages.
    """
    known = train.select(col(lang_col).cast("string").alias("lang"), col(text_col).alias("text"))
    known = known.where("lang is not null and text is not null")
    rows = known.mapInArrow(_count, COUNTED).groupBy("lang", "kind", "cell").agg(F.sum("n").alias("n"))
    found = rows.toArrow()
    langs = sorted(set(found["lang"].to_pylist()))
    place = {lang: n for n, lang in enumerate(langs)}
    row = np.array([place[x] for x in found["lang"].to_pylist()], np.int64)
    kind, cell, n = (found[c].to_numpy() for c in ("kind", "cell", "n"))

    def counts(wanted: int, width: int) -> np.ndarray:
        table = np.zeros((len(langs), width))
        own = kind == wanted
        table[row[own], cell[own]] = n[own]
        return table

    return Languages.of(langs, counts(PAIR, CELLS), counts(TRIPLE, CELLS), counts(SCRIPT, OTHER + 1))


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[str, list[np.ndarray]] = {}
    for batch in in_slices(batches, "text"):
        for lang, texts in _by_language(batch):
            held = total.setdefault(
                lang, [np.zeros(CELLS, np.int64), np.zeros(CELLS, np.int64), np.zeros(OTHER + 1, np.int64)]
            )
            for _, part in pieces(code_points("\0".join(texts))):
                words = words_of(part)
                held[PAIR] += np.bincount(words.pairs, minlength=CELLS)
                held[TRIPLE] += np.bincount(words.triples, minlength=CELLS)
                letters = words.ends - words.starts
                held[SCRIPT] += np.bincount(words.scripts, letters, OTHER + 1).astype(np.int64)
    for lang, tables_ in total.items():
        for kind, counts in enumerate(tables_):
            used = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([lang] * len(used), pa.string()),
                    pa.array(np.full(len(used), kind, np.int32)),
                    pa.array(used.astype(np.int32)),
                    pa.array(counts[used]),
                ],
                names=["lang", "kind", "cell", "n"],
            )


def _by_language(batch: pa.RecordBatch) -> list[tuple[str, list[str]]]:
    texts: dict[str, list[str]] = {}
    for lang, text in zip(batch["lang"].to_pylist(), batch["text"].to_pylist()):
        texts.setdefault(lang, []).append(text)
    return list(texts.items())


@dataclass
class Languages:
    """What a task needs to label texts, by language in order of name."""

    names: list[str]
    pairs: np.ndarray  # log counts by language and cell, smoothed
    triples: np.ndarray
    allowed: np.ndarray  # by script and language

    @classmethod
    def of(cls, names, pairs, triples, scripts) -> Languages:
        shares = scripts / np.maximum(scripts.sum(axis=1, keepdims=True), 1)
        allowed = (shares >= SCRIPT_SHARE).T
        allowed[~allowed.any(axis=1)] = True
        return cls(
            names,
            np.log(pairs + SMOOTHING * ALPHABET).astype(np.float32),
            np.log(triples + SMOOTHING).astype(np.float32),
            allowed,
        )

    def scores(self, words: Words) -> np.ndarray:
        """Log probability of each word in each language."""
        table = np.zeros((len(words.starts), len(self.names)))
        if not len(words.starts):
            return table
        for n in range(len(self.names)):
            own = self.triples[n][words.triples].astype(np.float64)
            own -= self.pairs[n][words.pairs]
            table[:, n] = np.add.reduceat(own, words.first)
        table[~self.allowed[words.scripts]] = RULED_OUT
        return table


def best_labels(scores: np.ndarray, counts: np.ndarray, penalty: float) -> np.ndarray:
    """The language of each word, texts one after the other with `counts` words each.

    The labelling with the highest sum of scores less a penalty per change. The texts step forward
    together, longest first, so each step is a few operations on arrays. Of equal ways the one
    that stays wins, then the first language.
    """
    total, width = scores.shape
    order = np.argsort(-counts, kind="stable")
    offsets = (np.cumsum(counts) - counts)[order]
    lengths = counts[order]
    steps = int(lengths[0]) if len(lengths) else 0
    active = np.searchsorted(-lengths, -np.arange(steps), side="left")
    came_from = np.zeros((total, width), np.uint8 if width < 256 else np.uint16)
    labels = np.zeros(total, np.int64)
    value = np.zeros((len(lengths), width))
    languages = np.arange(width)
    for step in range(steps):
        live = active[step]
        at = offsets[:live] + step
        if step:
            here = value[:live]
            top = here.argmax(axis=1)
            moved = here[np.arange(live), top] - penalty
            stays = here >= moved[:, None]
            came_from[at] = np.where(stays, languages, top[:, None])
            value[:live] = np.maximum(here, moved[:, None]) + scores[at]
        else:
            value[:live] = scores[at]
    state = value.argmax(axis=1)
    for step in range(steps - 1, -1, -1):
        live = active[step]
        at = offsets[:live] + step
        labels[at] = state[:live]
        if step:
            state[:live] = came_from[at, state[:live]]
    return labels


def label_languages(
    df: DataFrame,
    languages: Languages,
    id_col: str = "doc_id",
    text_col: str = "text",
    penalty: float = SWITCH_PENALTY,
) -> DataFrame:
    """One row per input row: doc_id, lang_pred, score, spans.

    `spans` lists where the labelling changes: start and end (code points, end exclusive, from the
    first letter of its first word to the last of its last) and language. `lang_pred` is the
    language that labels most letters, the first by name of equals, and `score` its share of them.
    A null text, one without a letter, and any text where no language was learnt gives `und`, 0
    and no spans. Repeated rows are labelled alike; other columns are ignored; an empty table
    gives an empty result.
    """
    rows = df.select(col(id_col).alias("doc_id"), col(text_col).cast("string").alias("text"))
    span = T.StructType().add("start", "long").add("end", "long").add("lang", "string")
    fields = T.StructType([rows.schema["doc_id"]])
    fields = fields.add("lang_pred", "string").add("score", "double").add("spans", T.ArrayType(span))
    shared = df.sparkSession.sparkContext.broadcast(languages)
    limit = max(SLICE_BYTES * 4 // max(len(languages.names), 4), 1 << 16)

    def label(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema

        schema = to_arrow_schema(fields)
        for batch in in_slices(batches, "text", limit):
            found = label_texts(shared.value, batch["text"].to_pylist(), penalty)
            columns = [batch["doc_id"].cast(schema.field("doc_id").type)]
            columns += [pa.array(x, schema.field(n + 1).type) for n, x in enumerate(zip(*found))]
            if batch.num_rows:
                yield pa.RecordBatch.from_arrays(columns, schema=schema)

    return rows.mapInArrow(label, fields)


def label_texts(languages: Languages, texts: list[str | None], penalty: float) -> list[tuple]:
    """`lang_pred`, `score` and `spans` of each text."""
    texts = [x or "" for x in texts]
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    begins = np.cumsum(sizes + 1) - sizes - 1
    starts, ends, scores = [], [], []
    for offset, part in pieces(code_points("\0".join(texts))):
        words = words_of(part)
        starts.append(words.starts + offset)
        ends.append(words.ends + offset)
        scores.append(languages.scores(words))
    if not languages.names or not sum(map(len, starts)):
        return [(UNKNOWN, 0.0, [])] * len(texts)
    start, end = np.concatenate(starts), np.concatenate(ends)
    # Texts begin in order; an empty one has the next one's place and no words.
    text_of = np.searchsorted(begins, start, side="right") - 1
    counts = np.bincount(text_of, minlength=len(texts))
    labels = best_labels(np.concatenate(scores), counts, penalty)
    width = len(languages.names)
    weights = np.bincount(
        text_of * width + labels, end - start, len(texts) * width
    ).reshape(-1, width)
    changes = np.flatnonzero((np.diff(labels) != 0) | (np.diff(text_of) != 0)) + 1
    heads = np.concatenate([[0], changes])
    tails = np.concatenate([changes, [len(labels)]]) - 1
    spans: list[list[dict]] = [[] for _ in texts]
    for n, a, b, name in zip(text_of[heads], start[heads], end[tails], labels[heads]):
        spans[n].append(
            {"start": int(a - begins[n]), "end": int(b - begins[n]), "lang": languages.names[name]}
        )
    top = weights.argmax(axis=1)
    letters = weights.sum(axis=1)
    return [
        (languages.names[t], float(weights[n, t] / letters[n]), spans[n])
        if letters[n]
        else (UNKNOWN, 0.0, [])
        for n, t in enumerate(top)
    ]


def held_out(doc_id: Column) -> Column:
    """The fold that nothing is learnt from. A null id is not in it."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))
