"""Language of a text by a small convolutional network over its bytes.

Filters of several widths run over fixed-length windows of the UTF-8 bytes, each is pooled by its
maximum, and a softmax over the pooled values gives the window's language. The network is trained in
numpy on windows of a bounded number of labelled texts per language (about SAMPLE, by hash of the id), outside the
held-out fold; only those windows reach the driver. A text's languages are the means over all its windows, short last one included.

A trained filter is a sum of one table row per byte of its width, so tasks add rows of byte and byte-pair tables
instead of multiplying embeddings.

A null text, or one without a letter, is ``und`` with score 0. A null lang is not learned from; without any labelled text
all are ``und``. Repeated rows are each predicted.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from tidewell.llm.common import fold

LENGTH = 256  # bytes of a window
WIDTHS = (2, 3, 4)
FILTERS = 8  # of each width
EMBEDDING = 8
SAMPLE = 400  # texts per language, expected
PER_TEXT = 4  # windows of a text that are learned from
LANGUAGES = 64  # languages that are learned, the most frequent
EPOCHS = 12
BATCH = 64
CHUNK = 64  # windows at once, small enough for the processor's cache


def windows(raw: bytes) -> np.ndarray:
    """All windows of a text, the last one filled with blanks."""
    count = max(1, -(-len(raw) // LENGTH))
    return np.frombuffer(raw.ljust(count * LENGTH), np.uint8).reshape(count, LENGTH)


@dataclass
class Network:
    languages: list[str]
    embedding: np.ndarray  # (256, EMBEDDING)
    filters: list[np.ndarray]  # per width (width, EMBEDDING, FILTERS)
    biases: list[np.ndarray]
    weights: np.ndarray  # (all filters, languages)
    intercept: np.ndarray
    row_tables: list | None = None  # made once per task

    def tables(self) -> list[tuple[np.ndarray, np.ndarray | None]]:
        """Per width the tables of its first byte pair and of what follows: a byte, a pair or nothing."""
        pair = np.arange(1 << 16)
        out = []
        for width, kernel in zip(WIDTHS, self.filters):
            rows = np.einsum("be,wef->wbf", self.embedding, kernel).astype(np.float32)
            first = rows[0][pair >> 8] + rows[1][pair & 255]
            rest = None if width == 2 else rows[2] if width == 3 else rows[2][pair >> 8] + rows[3][pair & 255]
            out.append((first, rest))
        return out

    def shares(self, bytes_: np.ndarray, tables) -> np.ndarray:
        """Language shares of every window."""
        columns = np.ascontiguousarray(bytes_.T).astype(np.intp)  # places first, so that pooling runs over long rows
        pairs = (columns[:-1] << 8) | columns[1:]
        pooled = []
        for width, bias, (first, rest) in zip(WIDTHS, self.biases, tables):
            sums = first.take(pairs[: LENGTH - width + 1], axis=0)
            if rest is not None:
                sums += rest.take(columns[2:] if width == 3 else pairs[2:], axis=0)
            pooled.append(np.maximum(sums.max(axis=0) + bias, 0))
        return softmax(np.hstack(pooled) @ self.weights + self.intercept)

    def predict(self, texts: list[str | None]) -> tuple[list[str], list[float]]:
        """Language and score of every text, from all its windows."""
        if self.row_tables is None:
            self.row_tables = self.tables()
        tables, owners, rows = self.row_tables, [], []
        total = np.zeros((len(texts), max(1, len(self.languages))))

        def flush() -> None:
            if rows:
                np.add.at(total, np.concatenate(owners), self.shares(np.concatenate(rows), tables))
                owners.clear(), rows.clear()

        waiting = 0
        for number, text in enumerate(texts):
            if not self.languages or not text or not any(map(str.isalpha, text)):
                continue
            found = windows(text.encode("utf-8", "surrogatepass"))
            for at in range(0, len(found), CHUNK):
                rows.append(found[at : at + CHUNK])
                owners.append(np.full(len(rows[-1]), number))
                waiting += len(rows[-1])
                if waiting >= CHUNK:
                    flush()
                    waiting = 0
        flush()
        sums = total.sum(axis=1)
        best = total.argmax(axis=1)
        names = [self.languages[place] if some else "und" for place, some in zip(best, sums)]
        scores = [float(row[place] / some) if some else 0.0 for row, place, some in zip(total, best, sums)]
        return names, scores


def softmax(values: np.ndarray) -> np.ndarray:
    values = np.exp(values - values.max(axis=1, keepdims=True))
    return values / values.sum(axis=1, keepdims=True)


def learned_windows(text: str) -> np.ndarray:
    """At most PER_TEXT windows of a text, spread evenly over it."""
    found = windows(text.encode("utf-8", "surrogatepass"))
    return found[np.linspace(0, len(found) - 1, min(PER_TEXT, len(found))).astype(int)]


def train(inputs: list[np.ndarray], langs: list[str]) -> Network:
    """A network fitted by Adam to the windows of each text; the draws are fixed."""
    languages = sorted(set(langs))
    draw = np.random.default_rng(11)
    targets = [np.full(len(found), languages.index(lang)) for found, lang in zip(inputs, langs)]
    count = FILTERS * len(WIDTHS)
    network = Network(
        languages,
        draw.normal(0, 0.5, (256, EMBEDDING)),
        [draw.normal(0, 1 / np.sqrt(width * EMBEDDING), (width, EMBEDDING, FILTERS)) for width in WIDTHS],
        [np.zeros(FILTERS) for _ in WIDTHS],
        draw.normal(0, 1 / np.sqrt(count), (count, max(1, len(languages)))),
        np.zeros(max(1, len(languages))),
    )
    if not languages:
        return network
    x, y = np.concatenate(inputs), np.concatenate(targets)
    share = np.bincount(y, minlength=len(languages)) / len(y)
    parameters = [network.embedding, *network.filters, *network.biases, network.weights, network.intercept]
    first, second = [np.zeros_like(p) for p in parameters], [np.zeros_like(p) for p in parameters]
    step = 0
    for _ in range(max(EPOCHS, -(-200 * BATCH // len(x)))):
        order = draw.permutation(len(x))
        for at in range(0, len(order), BATCH):
            chosen = order[at : at + BATCH]
            step += 1
            for p, gradient, m, v in zip(parameters, gradients(network, x[chosen], y[chosen], share), first, second):
                m += 0.1 * (gradient - m)
                v += 0.001 * (gradient**2 - v)
                p -= 0.004 * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.999**step)) + 1e-8)
    return network


def gradients(network: Network, x: np.ndarray, y: np.ndarray, share: np.ndarray) -> list[np.ndarray]:
    """Of the cross entropy, languages weighted alike, by every parameter. Pooling passes them to the place of the maximum only."""
    number, columns = len(x), np.ascontiguousarray(x.T).astype(np.intp)
    pooled, places = [], []
    for width, kernel, bias in zip(WIDTHS, network.filters, network.biases):
        stop = LENGTH - width + 1
        sums = sum((network.embedding @ kernel[tap]).take(columns[tap : tap + stop], axis=0) for tap in range(width))
        sums = sums.transpose(1, 0, 2)
        places.append(sums.argmax(axis=1))
        pooled.append(np.take_along_axis(sums, places[-1][:, None], axis=1)[:, 0] + bias)
    active = np.hstack(pooled)
    hidden = np.maximum(active, 0)
    error = softmax(hidden @ network.weights + network.intercept)
    error[np.arange(number), y] -= 1
    error *= (1 / (share[y] * len(share) * number))[:, None]
    back = (error @ network.weights.T) * (active > 0)
    embedding = np.zeros_like(network.embedding)
    kernels, biases = [], []
    for place, (width, kernel) in enumerate(zip(WIDTHS, network.filters)):
        part = back[:, place * FILTERS : (place + 1) * FILTERS]
        kernel_gradient = np.zeros_like(kernel)
        for tap in range(width):
            at = np.take_along_axis(x, places[place] + tap, axis=1)  # (windows, filters)
            kernel_gradient[tap] = np.einsum("nfe,nf->ef", network.embedding[at], part)
            np.add.at(embedding, at, part[:, :, None] * kernel[tap].T[None])
        kernels.append(kernel_gradient)
        biases.append(part.sum(axis=0))
    return [embedding, *kernels, *biases, hidden.T @ error, error.sum(axis=0)]


def learned(docs: DataFrame) -> Network:
    """A network from (doc_id, text, lang). A language's texts are those whose id hashes below its share of SAMPLE, so nothing is ranked."""
    rows = docs.where(F.col("lang").isNotNull() & F.col("doc_id").isNotNull() & (fold(F.col("doc_id")) != 0))
    counts = rows.groupBy("lang").agg(F.approx_count_distinct("doc_id").alias("ids"))
    names = counts.orderBy(F.desc("ids"), "lang").limit(LANGUAGES)
    unit = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 32)) / float(1 << 32)
    known = rows.join(F.broadcast(names), "lang").where(unit * F.col("ids") < SAMPLE)  # LANGUAGES rows at most
    texts = known.where("text rlike '\\\\p{L}'").groupBy("lang", "doc_id").agg(F.min("text").alias("text"))

    @F.udf("array<binary>", useArrow=True)
    def spread(text: str) -> list[bytes]:
        return [window.tobytes() for window in learned_windows(text)]

    found = sorted(tuple(row) for row in texts.select("lang", "doc_id", spread("text").alias("windows")).collect())
    return train([np.frombuffer(b"".join(parts), np.uint8).reshape(-1, LENGTH) for _, _, parts in found], [lang for lang, _, _ in found])


def languages(docs: DataFrame) -> DataFrame:
    """(doc_id, held_out, lang_pred, score) of every document of (doc_id, text, lang)."""
    network = docs.sparkSession.sparkContext.broadcast(learned(docs))  # fixed size

    @F.pandas_udf("struct<lang_pred:string,score:double>")
    def predicted(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for texts in batches:
            names, scores = network.value.predict(texts.tolist())
            yield pd.DataFrame({"lang_pred": pd.Series(names, dtype=object), "score": pd.Series(scores, dtype=float)})

    held_out = (fold(F.col("doc_id")) == 0).alias("held_out")
    return docs.select("doc_id", held_out, predicted("text").alias("p")).select("doc_id", "held_out", "p.*")
