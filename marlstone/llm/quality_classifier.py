"""Document quality by a regularised quadratic discriminant.

Each text becomes a few statistics, transformed towards a normal shape. Counts, sums and sums of
products per class are added up over the tasks; means and covariances follow from them, and each
class covariance is shrunk towards the pooled one and towards its diagonal. A score compares the
two normal log densities, whose Mahalanobis distances come from Cholesky factors made once.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from marlstone.llm.common import col, id_and_text, in_slices, staged

FEATURES = (
    "log_chars", "log_words", "word_chars", "line_words", "symbols", "capitals", "exclamations",
    "bars", "digits", "sentence_ends", "distinct_words", "repeated_lines",
)
# How far a class covariance is drawn to the pooled one, and then to its own diagonal.
TO_POOLED, TO_DIAGONAL, RIDGE = 0.2, 0.01, 1e-3

_CLASSES = {
    "symbols": b"#*$%&|<>", "exclamations": b"!", "bars": b"|", "digits": b"0123456789",
    "capitals": bytes(range(65, 91)), "sentence_ends": b".?", "letters": bytes(range(97, 123)),
}
_MASKS = {name: np.isin(np.arange(256), list(chars)) for name, chars in _CLASSES.items()}


def share(part: float, whole: float) -> float:
    """A share as a log odds, half a case added to both sides so that 0 and 1 stay finite."""
    return math.log((part + 0.5) / (whole - part + 0.5))


def statistics(text: str) -> list[float]:
    """`FEATURES` of one text; an empty text has finite ones too."""
    raw = np.frombuffer(text.encode("utf-8"), np.uint8)
    seen = np.bincount(raw, minlength=256)
    n = {name: int(seen[mask].sum()) for name, mask in _MASKS.items()}
    words, lines = text.split(), [x for x in text.split("\n") if x and not x.isspace()]
    letters = n["capitals"] + n["letters"]
    return [
        math.log1p(len(text)),
        math.log1p(len(words)),
        math.log1p(sum(map(len, words)) / max(len(words), 1)),
        math.log1p(len(words) / max(len(lines), 1)),
        share(n["symbols"], len(raw)),
        share(n["capitals"], letters),
        share(n["exclamations"], max(len(words), n["exclamations"])),
        share(n["bars"], max(len(words), n["bars"])),
        share(n["digits"], len(raw)),
        share(n["sentence_ends"], max(len(words), n["sentence_ends"])),
        share(len(set(words)), len(words)),
        share(len(lines) - len(set(lines)), len(lines)),
    ]


def features(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and the statistics of each text (array of double); a null text counts as empty."""
    rows = id_and_text(df, id_col, text_col)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in in_slices(batches, "text"):
            found = [statistics(t or "") for t in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(found, pa.list_(pa.float64()))], names=["doc_id", "x"]
            )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(measure, f"doc_id {kind}, x array<double>")


@dataclass
class Model:
    """Class means and Cholesky factors over standardised statistics, class 0 then class 1."""

    centre: np.ndarray
    scale: np.ndarray
    means: list[np.ndarray]
    factors: list[np.ndarray]
    log_priors: list[float]

    def scores(self, x: np.ndarray) -> np.ndarray:
        """The probability of class 1 for each row."""
        z = (x - self.centre) / self.scale
        densities = []
        for mean, factor, prior in zip(self.means, self.factors, self.log_priors):
            away = np.linalg.solve(factor, (z - mean).T)
            log_det = np.log(np.diag(factor)).sum()
            densities.append(prior - log_det - 0.5 * (away**2).sum(axis=0))
        gap = np.clip(densities[0] - densities[1], -700, 700)
        return 1 / (1 + np.exp(gap))


@dataclass
class Constant:
    """What is left to say where a class has no labelled rows: the smoothed share of class 1."""

    value: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        return np.full(len(x), self.value)


def fit(
    labelled: DataFrame,
    to_pooled: float = TO_POOLED,
    to_diagonal: float = TO_DIAGONAL,
    ridge: float = RIDGE,
) -> Model | Constant:
    """A model from columns `x` and `label` (0 or 1; other labels and nulls are left out).

    Every labelled row counts; a row that is there twice counts twice. Only one row of sums per
    class comes to the driver.
    """
    width = len(FEATURES)

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, 1 + width + width * width))
        for batch in batches:
            x = np.array(batch["x"].flatten()).reshape(-1, width)
            label = np.array(batch["label"])
            for c in (0, 1):
                own = x[label == c]
                total[c] += np.concatenate([[len(own)], own.sum(axis=0), (own.T @ own).ravel()])
        yield pa.RecordBatch.from_arrays(
            [pa.array([0, 1], pa.int32()), pa.array(list(total), pa.list_(pa.float64()))],
            names=["label", "sums"],
        )

    known = labelled.where("label in (0, 1)").select("x", F.col("label").cast("int"))
    parts = known.mapInArrow(sums, "label int, sums array<double>")
    rows = (
        parts.select("label", F.posexplode("sums").alias("at", "value"))
        .groupBy("label", "at")
        .agg(F.sum("value").alias("value"))
        .collect()
    )
    total = np.zeros((2, 1 + width + width * width))
    for row in rows:
        total[row.label, row.at] = row.value
    counts = total[:, 0]
    if counts.min() < 1:
        return Constant(float((counts[1] + 1) / (counts.sum() + 2)))
    both = total.sum(axis=0)
    centre = both[1 : width + 1] / both[0]
    spread = np.diag(both[width + 1 :].reshape(width, width)) / both[0] - centre**2
    scale = np.sqrt(np.maximum(spread, 1e-12))
    means, scatters = [], []
    for n, own in zip(counts, total):
        mean = own[1 : width + 1] / n
        second = own[width + 1 :].reshape(width, width) / n
        scatters.append((second - np.outer(mean, mean)) / np.outer(scale, scale))
        means.append((mean - centre) / scale)
    pooled = sum(n * s for n, s in zip(counts, scatters)) / counts.sum()
    factors = []
    for scatter in scatters:
        shrunk = (1 - to_pooled) * scatter + to_pooled * pooled
        shrunk = (1 - to_diagonal) * shrunk + to_diagonal * np.diag(np.diag(shrunk))
        factors.append(np.linalg.cholesky(shrunk + ridge * np.eye(width)))
    return Model(centre, scale, means, factors, list(np.log(counts / counts.sum())))


def held_out(doc_id: Column) -> Column:
    """The fold that no label is learnt from."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def classify(
    df: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted.

    Only labels outside the held-out fold are learnt from; the text is all a score is made of. Null
    and empty texts are scored like any other. Without labels of both classes each score is the
    smoothed share of class 1. Repeated rows are scored alike; other columns are ignored; an empty
    table gives an empty result.
    """
    measured = staged(features(df, id_col, text_col), "quality-features")
    known = labels.select(col(id_col).alias("doc_id"), col(label_col).alias("label"))
    training = measured.join(known.where(~held_out(F.col("doc_id"))), "doc_id")
    model = fit(training)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array(batch["x"].flatten()).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(model.scores(x), pa.float64())],
                names=["doc_id", "score"],
            )

    kind = measured.schema["doc_id"].dataType.simpleString()
    scored = measured.mapInArrow(score, f"doc_id {kind}, score double")
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )
