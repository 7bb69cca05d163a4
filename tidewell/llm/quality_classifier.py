"""Quality scores: ridge regression on random Fourier features of document statistics, calibrated isotonically.

Statistics of every whole text are computed in one pass and staged as one short array per document. Labelled rows
outside the held-out fold are joined by id; the bounded number of them that is fitted on (FITTED,
by hash of the id) gives partial normal equations per task, of fixed size, which the
driver adds up and solves. Calibration pools adjacent violators over a fixed grid of raw scores,
whose label counts Spark sums.

An empty or null text has statistics of its own (all zero) and a score like any other. Without labels, or with one class
only, every score is the share of label 1 (a half without labels). Null labels are not learned from. Repeated rows are scored
each for itself; repeated labels each count.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidewell.llm.common import fold, release, staged, unstage

FITTED = 400_000  # labelled rows that a fit uses, about
FEATURES = 256
RIDGE = 1e-4
GRID = 1024
THRESHOLD = 0.3
ROWS = 1024  # scored at a time
TASKS = 16  # partial normal equations, half a MB each
STATISTICS = 17
_SYMBOLS = np.zeros(256, bool)
_SYMBOLS[list(b"#*$%&|<>!@^~=+{}[]_\\")] = True
_CLASSES = {
    "upper": np.arange(256)[65:91],
    "lower": np.arange(256)[97:123],
    "digit": np.arange(256)[48:58],
    "stop": np.array(list(b".,;:?")),
    "high": np.arange(256)[128:],
    "blank": np.array([32, 9, 10, 11, 12, 13]),
}


def statistics(text: str | None) -> list[float]:
    """Shares of byte classes, repetition of words and lines, lengths and entropy of a whole text."""
    raw = (text or "").encode("utf-8", "surrogatepass")
    words = raw.split()
    if not words:
        return [0.0] * STATISTICS
    counts = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    share = counts / len(raw)
    present = share[share > 0]
    lines = [line for line in raw.split(b"\n") if line.strip()]
    frequency = Counter(words)
    number, distinct = len(words), len(frequency)
    bare = sum(n for word, n in frequency.items() if _SYMBOLS[word[-1]])
    shouted = sum(n for word, n in frequency.items() if len(word) > 1 and word.isupper())
    return [
        np.log1p(len(raw)),
        np.log1p(number),
        np.log1p(len(raw) / number),
        *(float(share[places].sum()) for places in _CLASSES.values()),
        float(share[_SYMBOLS].sum()),
        distinct / number,
        np.log1p(number / distinct),
        frequency.most_common(1)[0][1] / number,
        1 - len(set(lines)) / len(lines),
        bare / number,
        shouted / number,
        float(-(present * np.log(present)).sum()),
    ]


@dataclass
class Model:
    """Scales, random features, weights and calibration."""

    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    raw: np.ndarray  # calibration: raw scores and the shares of label 1 there
    share: np.ndarray
    base: float

    def features(self, statistics: np.ndarray) -> np.ndarray:
        """Cosine features whose inner products approximate a Gaussian kernel; a constant is the last."""
        draw = np.random.default_rng(3)
        directions = draw.normal(0, 1 / np.sqrt(STATISTICS), (STATISTICS, FEATURES))
        phases = draw.uniform(0, 2 * np.pi, FEATURES)
        standard = np.clip((statistics - self.mean) / self.scale, -6, 6)
        cosines = np.sqrt(2 / FEATURES) * np.cos(standard @ directions + phases)
        return np.hstack([cosines, np.ones((len(cosines), 1))])

    def raw_scores(self, statistics: np.ndarray) -> np.ndarray:
        return self.features(statistics) @ self.weights

    def scores(self, statistics: np.ndarray) -> np.ndarray:
        if not len(self.raw):
            return np.full(len(statistics), self.base)
        return np.clip(np.interp(self.raw_scores(statistics), self.raw, self.share), 0, 1)


def pooled(values: np.ndarray, weights: np.ndarray) -> np.ndarray:
    """Non-decreasing fit by pooling adjacent violators."""
    blocks: list[list[float]] = []
    for value, weight in zip(values, weights):
        blocks.append([value, weight, 1])
        while len(blocks) > 1 and blocks[-2][0] >= blocks[-1][0]:
            last, before = blocks.pop(), blocks[-1]
            total = before[1] + last[1]
            before[0] = (before[0] * before[1] + last[0] * last[1]) / total
            before[1], before[2] = total, before[2] + last[2]
    return np.concatenate([np.full(int(n), value) for value, _, n in blocks]) if blocks else np.zeros(0)


def stacked(column) -> np.ndarray:
    return np.stack(column.to_numpy()).astype(float) if len(column) else np.zeros((0, STATISTICS))


def with_statistics(docs: DataFrame) -> DataFrame:
    """``docs`` with the array ``statistics`` of its text."""

    @F.pandas_udf("array<double>")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        release()
        for texts in batches:
            yield pd.Series([statistics(text) for text in texts], dtype=object)

    return docs.withColumn("statistics", of("text"))


def fit(rows: DataFrame, labels: DataFrame, target: str = "quality") -> Model:
    """A model from rows (doc_id, statistics) and labels (doc_id, target), outside the held-out fold."""
    labels = labels.where(F.col(target).isNotNull() & (fold(F.col("doc_id")) != 0))
    whole = known = staged(
        rows.join(labels.select("doc_id", F.col(target).cast("double").alias("y")), "doc_id").select(
            "doc_id", "statistics", "y"
        )
    )
    total = known.count()
    if total > FITTED:
        known = known.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int(FITTED / total * (1 << 20)))
    moments = known.agg(
        F.avg("y").alias("y"),
        *[F.avg(F.col("statistics")[i]).alias(f"m{i}") for i in range(STATISTICS)],
        *[F.stddev_pop(F.col("statistics")[i]).alias(f"s{i}") for i in range(STATISTICS)],
    ).first()
    if moments["y"] is None or moments["y"] in (0.0, 1.0):
        unstage(whole)
        none, base = np.zeros(STATISTICS), 0.5 if moments["y"] is None else moments["y"]
        return Model(none, none + 1, np.zeros(FEATURES + 1), none[:0], none[:0], base)
    mean = np.array([moments[f"m{i}"] for i in range(STATISTICS)])
    scale = np.array([moments[f"s{i}"] for i in range(STATISTICS)])
    blank = Model(mean, np.where(scale > 1e-9, scale, 1), np.zeros(FEATURES + 1), mean[:0], mean[:0], moments["y"])

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = FEATURES + 1
        gram, moment = np.zeros((size, size)), np.zeros(size)
        for batch in batches:
            z, y = blank.features(stacked(batch.column("statistics").to_pandas())), batch.column("y").to_numpy()
            gram += z.T @ z
            moment += z.T @ y
        yield pa.RecordBatch.from_arrays([pa.array([gram.tobytes()]), pa.array([moment.tobytes()])], names=["gram", "moment"])

    parts = known.coalesce(TASKS).mapInArrow(summed, "gram binary, moment binary").collect()
    gram = sum(np.frombuffer(part.gram) for part in parts).reshape(FEATURES + 1, FEATURES + 1)
    moment = sum(np.frombuffer(part.moment) for part in parts)
    penalty = RIDGE * gram[-1, -1] * np.eye(FEATURES + 1)
    penalty[-1, -1] = 0
    blank.weights = np.linalg.solve(gram + penalty, moment)

    @F.pandas_udf("double")
    def raw(column: pd.Series) -> pd.Series:
        return pd.Series(blank.raw_scores(stacked(column)))

    cells = (
        known.select(F.floor(F.least(F.greatest(raw("statistics"), F.lit(-1)), F.lit(2)) * GRID).alias("cell"), "y")
        .groupBy("cell")
        .agg(F.count("*").alias("n"), F.sum("y").alias("ones"))
        .orderBy("cell")
        .toPandas()
    )
    unstage(whole)
    number, ones = cells["n"].to_numpy(float), cells["ones"].to_numpy(float)
    blank.raw = (cells["cell"].to_numpy(float) + 0.5) / GRID
    blank.share = pooled(ones / number, number)
    return blank


def scored(rows: DataFrame, model: Model) -> DataFrame:
    """``rows`` with ``score`` in place of ``statistics``."""
    shared = rows.sparkSession.sparkContext.broadcast(model)  # fixed size

    @F.pandas_udf("double")
    def score(column: pd.Series) -> pd.Series:
        return pd.Series(shared.value.scores(stacked(column)))

    return rows.withColumn("score", score("statistics")).drop("statistics")


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, held_out, score, predicted) of every document of (doc_id, text)."""
    rows = staged(with_statistics(docs.select("doc_id", "text")).select("doc_id", "statistics"))
    return scored(rows, fit(rows, labels)).select(
        "doc_id",
        (fold(F.col("doc_id")) == 0).alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )


def keep_good(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the classifier does not reject, with all their columns."""
    rows = staged(with_statistics(docs.select("doc_id", "text")).select("doc_id", "statistics"))
    shared = docs.sparkSession.sparkContext.broadcast(fit(rows, labels))  # fixed size
    unstage(rows)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:  # statistics and score in one worker per task
        release()
        for texts in batches:
            found = np.array([statistics(text) for text in texts]).reshape(-1, STATISTICS)
            parts = [shared.value.scores(found[at : at + ROWS]) for at in range(0, len(found), ROWS)]
            yield pd.Series(np.concatenate(parts) if parts else np.zeros(0))

    return docs.where(score("text") >= THRESHOLD)
