"""Fingerprints by a threshold-scaled sketch, and likenesses between documents of any two lengths.

A text's fingerprint keeps every hash of its five-word shingles that lies below a fixed fraction of the hash range, so
its size follows the text and two fingerprints sample the same shingles. Fingerprints merge by union, and the share of
the smaller one's hashes that the other holds estimates containment, however unequal the texts. If no hash lies below
the fraction the least one is kept (of a union: the least of both), so that short texts have fingerprints too.

Words are ``[^\\x20\\x09-\\x0D]+``, unchanged; fewer than five words are one shingle. A null text counts as empty; a
text without words has an empty fingerprint, which equals another empty one and shares nothing with the rest.

``edited`` compares each document with the next one in descending id (after the last: the first): documents are dealt
to sorted ranges, and the first row of a range is also sent to the range before it, so every text is shuffled once and
a task holds two texts at a time. Null ids come last; equal ids are ordered by a hash of their text, repeated rows lie
next to each other. A single document is its own next one; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
import re
from bisect import bisect_right
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

SHINGLE = 5
FRACTION = 4  # one hash in so many is kept
BITS = 32
SEED = 7
CHUNK = 1 << 18  # words that are hashed at once
SPREAD = 4  # ranges per partition of the shuffle, so that partitions hold evenly many rows
COLUMNS = (
    "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)
_WORDS = re.compile(r"[^ \t-\r]+")


def _mixed(values: np.ndarray) -> np.ndarray:
    """Sums of word hashes spread evenly over 64 bits (the finalizer of splitmix64)."""
    values = values ^ (values >> np.uint64(30))
    values = values * np.uint64(0xBF58476D1CE4E5B9)
    values = values ^ (values >> np.uint64(27))
    values = values * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def _shingle_hashes(words: np.ndarray) -> np.ndarray:
    """32-bit hashes of all runs of five word hashes, or of the whole shorter sequence."""
    width = min(SHINGLE, len(words))
    total = np.zeros(len(words) - width + 1, np.uint64)
    for place in range(width):
        total = total * np.uint64(0x9E3779B97F4A7C15) + words[place : place + len(total)]
    return (_mixed(total) >> np.uint64(64 - BITS)).astype(np.uint32)


def _word_hashes(text: str) -> Iterator[np.ndarray]:
    """Word hashes in chunks, each with the last four of the chunk before."""
    found, carried = [], np.zeros(0, np.uint64)
    for match in _WORDS.finditer(text):
        found.append(xxhash.xxh64_intdigest(match[0].encode("utf-8", "surrogatepass"), SEED))
        if len(found) == CHUNK:
            carried = np.concatenate([carried, np.array(found, np.uint64)])
            yield carried
            found, carried = [], carried[1 - SHINGLE :]
    if found:
        yield np.concatenate([carried, np.array(found, np.uint64)])


def merged(*sketches: np.ndarray) -> np.ndarray:
    """The sketch of the shingles of all: sorted distinct hashes below the threshold, else the least one."""
    together = np.unique(np.concatenate(sketches)) if sketches else np.zeros(0, np.uint32)
    below = together[: np.searchsorted(together, np.uint32((1 << BITS) // FRACTION))]
    return below if len(below) else together[:1]


def sketch(text: str) -> np.ndarray:
    return merged(*[merged(_shingle_hashes(words)) for words in _word_hashes(text)])


def containment(a: np.ndarray, b: np.ndarray) -> float:
    """How much of the smaller sketch the other holds; 1 for two empty ones."""
    least = min(len(a), len(b))
    if not least:
        return float(len(a) == len(b))
    return len(np.intersect1d(a, b, assume_unique=True)) / least


def written(sketch: np.ndarray) -> str:
    """Eight hex digits per hash, ascending."""
    return sketch.astype(">u4").tobytes().hex()


def read(fingerprint: str) -> np.ndarray:
    return np.frombuffer(bytes.fromhex(fingerprint), ">u4").astype(np.uint32)


def range_heads(docs: DataFrame) -> list[tuple]:
    """First keys (doc_id, text hash) of evenly filled ranges: ``SPREAD`` per partition of a range sort of the keys alone."""
    keys = docs.select("doc_id", F.xxhash64("text").alias("h"))
    order = [F.desc_nulls_last("doc_id"), F.asc("h")]
    partitions = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    lain = keys.repartitionByRange(partitions, *order).sortWithinPartitions(*order)

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [batch for batch in batches if batch.num_rows]
        if held:
            rows = pa.Table.from_batches(held)
            yield from rows.take(pa.array(np.unique(np.arange(SPREAD) * rows.num_rows // SPREAD))).to_batches()

    return sorted({_rank(row.doc_id, row.h) for row in lain.mapInArrow(spread, keys.schema).collect()})


def _rank(doc_id: int | None, h: int) -> tuple:
    return (doc_id is None, -(doc_id or 0), h)


def _followed(docs: DataFrame) -> DataFrame:
    """(doc_id, text) in sorted ranges; the last row of each range is the first of the next one."""
    heads = range_heads(docs)

    @F.pandas_udf("array<int>")
    def ranges(doc_id: pd.Series, h: pd.Series) -> pd.Series:
        """The row's range, and the one before it if the row is the first of a range."""
        found = []
        for one, digest in zip(doc_id, h):
            rank = _rank(None if pd.isna(one) else int(one), digest)
            place = bisect_right(heads, rank) - 1
            found.append([place, (place - 1) % len(heads)] if heads[place] == rank else [place])
        return pd.Series(found)

    keyed = docs.select("doc_id", "text", F.xxhash64("text").alias("h"))
    dealt = keyed.withColumn("ranges", ranges(F.col("doc_id").cast("string"), "h"))
    rows = dealt.select("doc_id", "text", "h", F.posexplode("ranges").alias("borrowed", "range"))
    order = ["range", "borrowed", F.desc_nulls_last("doc_id"), "h"]
    return rows.repartition("range").sortWithinPartitions(*order).select("range", "borrowed", "doc_id", "text")


def _edited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    names = [field.split()[0] for field in COLUMNS.split(", ")]
    before, done = None, []  # (range, doc_id, text, sketch) that waits for its next document
    for batch in batches:
        part, borrowed, ids = (batch.column(place).to_pylist() for place in range(3))
        for group, lent, doc_id, value in zip(part, borrowed, ids, batch.column(3)):
            if before is None and lent:
                continue  # further copies of a borrowed row
            text = value.as_py() or ""
            now = sketch(text)
            if before is not None and before[0] == group:
                done.append(_compared(*before[1:], text, now))
            before = None if lent else (group, doc_id, text, now)
            if len(done) == 1000:
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), types)], names=names)
                done = []
    if done:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), types)], names=names)


def _compared(doc_id: int | None, text: str, own: np.ndarray, following: str, following_sketch: np.ndarray) -> tuple:
    half = len(text) // 2
    changed = text[: len(text) - half] + following[:half]
    edited = own if changed == text else sketch(changed)
    digest = hashlib.sha256(changed.encode("utf-8", "surrogatepass")).hexdigest()
    likeness = containment(own, edited), containment(own, following_sketch)
    return (doc_id, len(text), digest, written(own), written(edited), *likeness)


def edited(docs: DataFrame) -> DataFrame:
    """One row per document of (doc_id, text): its fingerprint beside that of its edited text and its next document's."""
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return _followed(docs).mapInArrow(_edited, COLUMNS)
