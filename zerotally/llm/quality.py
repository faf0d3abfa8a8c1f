"""Quality by compression: a text that a dictionary of good text packs better than one of bad text scores high.

The difference of the two sizes over the length of the text, with the rate under the good dictionary beside it (a text
that repeats itself is small under both), goes through a logistic curve fitted on labelled texts that are in neither
dictionary and weighted to the labels' shares.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from zerotally.llm.compression import Sizer, build_dictionary, labelled_sample, sampled_parts, sizers
from zerotally.llm.frames import binary_text
from zerotally.workspace import materialise

#: Labelled texts of each class that are looked at: the first fill the dictionaries, the others fit the curve.
TEXTS_PER_CLASS = 1500
THRESHOLD = 0.3


@dataclass(frozen=True)
class QualityModel:
    good: bytes
    bad: bytes
    curve: tuple[float, float, float]  # intercept, difference, good rate


def features(good: Sizer, bad: Sizer, text: bytes) -> tuple[float, float]:
    n, g, b = max(1, len(text)), good.size(text), bad.size(text)
    return (b - g) / n, g / n


def fit_curve(x: Sequence[tuple[float, float]], y: Sequence[int], weight: Sequence[float], ridge: float = 1e-3,
              steps: int = 100) -> tuple[float, float, float]:
    """Weighted logistic regression by Newton steps; coefficients for the features as they are."""
    if not len(x):
        return 0.0, 1.0, 0.0
    a = np.asarray(x, float)
    mid, width = a.mean(0), np.maximum(a.std(0), 1e-9)
    z = np.column_stack([np.ones(len(a)), (a - mid) / width])
    y, w = np.asarray(y, float), np.asarray(weight, float) / np.sum(weight)
    b = np.zeros(3)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ b, -30, 30)))
        step = np.linalg.solve((z * (w * p * (1 - p))[:, None]).T @ z + ridge * np.eye(3), z.T @ (w * (p - y)) + ridge * b)
        b = b - step
        if np.abs(step).max() < 1e-10:
            break
    slope = b[1:] / width
    return float(b[0] - slope @ mid), float(slope[0]), float(slope[1])


def train(labels: DataFrame, texts: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "quality", per_class: int = TEXTS_PER_CLASS) -> QualityModel:
    """Model from the labels 0 and 1 of documents in `texts`; other labels are left out. The sizes that the curve is fitted
    to are those of whole texts, found in tasks."""
    label = F.when(F.col(label_col).isin(0, 1), F.col(label_col))
    sample, counts = labelled_sample(labels, id_col, text_col, label, per_class, texts)
    sample = materialise(sample, "labelled")
    parts, kinds, used = sampled_parts(sample), {}, set()
    for name in ("0", "1"):
        own = parts.get(name, [])
        kinds[name], n = build_dictionary(part for _, part in own[:max(1, len(own) // 2)])
        used |= {(name, *key) for key, _ in own[:n]}

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        good, bad = sizers([kinds["1"], kinds["0"]])
        for batch in batches:
            keys = list(zip(*(batch.column(i).to_pylist() for i in range(3))))
            found = [(k[0], *features(good, bad, text)) for k, text in zip(keys, binary_text(batch)) if k not in used]
            yield pa.RecordBatch.from_pylist([{"label": n, "difference": d, "rate": r} for n, d, r in found], schema=rows)

    rows = pa.schema([("label", pa.string()), ("difference", pa.float64()), ("rate", pa.float64())])
    found = sorted(map(tuple, sample.mapInArrow(measure, "label string, difference double, rate double").collect()))
    share = {name: sum(r[0] == name for r in found) for name in counts}
    return QualityModel(kinds["1"], kinds["0"], fit_curve([r[1:] for r in found], [int(r[0]) for r in found],
                                                          [counts[r[0]] / share[r[0]] for r in found]))


def score_quality(docs: DataFrame, model: QualityModel, id_col: str = "doc_id", text_col: str = "text",
                  held_out: Column | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: doc_id, held_out, score, predicted, difference.

    Null counts as the empty text, which has both features 0 and so the curve's own share. Whole texts count, however
    long; repeated rows are scored each; a table without rows gives none.
    """
    kinds, curve = [model.good, model.bad], model.curve

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        good, bad = sizers(kinds)
        for batch in batches:
            x = np.array([features(good, bad, text) for text in binary_text(batch)], float).reshape(-1, 2)
            score = 1 / (1 + np.exp(-np.clip(curve[0] + x @ np.array(curve[1:]), -700, 700)))
            yield pa.RecordBatch.from_pydict({"doc_id": batch.column(0), "held_out": batch.column(2), "score": score,
                                              "predicted": (score >= threshold).astype("int32"), "difference": x[:, 0]},
                                             schema=out)

    out = pa.schema([("doc_id", pa.int64()), ("held_out", pa.bool_()), ("score", pa.float64()),
                     ("predicted", pa.int32()), ("difference", pa.float64())])
    held = held_out if held_out is not None else F.lit(False)
    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), held.alias("held_out"))
            .mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int, difference double"))


def keep_good(docs: DataFrame, model: QualityModel, text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """The rows of `docs`, all columns as they are, whose text scores at least `threshold`; null counts as empty."""
    kinds, curve = [model.good, model.bad], model.curve

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        good, bad = sizers(kinds)
        for batch in batches:
            x = np.array([features(good, bad, text) for text in binary_text(batch, text_col)], float).reshape(-1, 2)
            score = 1 / (1 + np.exp(-np.clip(curve[0] + x @ np.array(curve[1:]), -700, 700)))
            yield batch.filter(pa.array(score >= threshold))

    return docs.mapInArrow(run, docs.schema)
