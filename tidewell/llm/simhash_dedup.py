"""Near-duplicate groups by SimHash, with candidates from Golay-code fuzzy hashing.

A fingerprint's 64 bits are three segments of 23, 23 and 18 bits. Two fingerprints
that differ in at most two bits leave one segment untouched, and one of the next
segment's bits at most is wrong in at least one of the three cyclic orders (segment
s exact, segment s+1 nearly so). The perfect binary Golay code [23,12,7] maps any
23-bit word to its one codeword within three bits. A word that differs in a bit or
not at all lies in the other's ball of radius one, so the codeword of the one is
among the codewords of the other's ball, of which there are one or six. Hence each fingerprint
asks under three keys and is filed under at most eighteen, and an equi-join finds
every pair; a bit count verifies it.

Empty or null texts have fingerprint zero, which links like any other. Rows that
repeat share a fingerprint and hence a group. A null id stays null in the result and names no group;
a group of null ids only has a null component_id.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, functions as F

from tidewell.llm.common import components, release, staged, unstage

SEED = 42
SHINGLE = 3
RADIUS = 2
BROADCAST = 500_000  # names of two numbers that may be broadcast
CHUNK = 1 << 16  # shingles whose bits are unpacked at once

# The Golay code's generator polynomial x^11+x^10+x^6+x^5+x^4+x^2+1, and the segments (shift, bits).
GENERATOR = 0b110001110101
SEGMENTS = ((41, 23), (18, 23), (0, 18))


def _remainders(words: np.ndarray) -> np.ndarray:
    """Remainder by the generator of each 23-bit word."""
    out = words
    for place in range(22, 10, -1):
        out = np.where(out >> place & 1, out ^ GENERATOR << (place - 11), out)
    return out


def golay_tables() -> tuple[np.ndarray, np.ndarray]:
    """Remainders of the twelve upper bits of a word, and the error pattern of each of the 2,048 remainders."""
    upper = _remainders(np.arange(0, 1 << 23, 1 << 11, dtype=np.int64))  # not of all words: every worker makes them
    errors = np.zeros(1 << 11, dtype=np.int64)
    single = [1 << i for i in range(23)]
    patterns = [0, *single]
    patterns += [a | b for i, a in enumerate(single) for b in single[i + 1 :]]
    patterns += [a | b | c for i, a in enumerate(single) for j, b in enumerate(single[i + 1 :], i + 1) for c in single[j + 1 :]]
    words = np.array(patterns, dtype=np.int64)
    errors[upper[words >> 11] ^ (words & 0x7FF)] = words
    return upper, errors


_tables: list[tuple[np.ndarray, np.ndarray]] = []


def codewords(words: np.ndarray) -> np.ndarray:
    """The twelve message bits of the codeword nearest to each 23-bit word."""
    if not _tables:
        _tables.append(golay_tables())
    upper, errors = _tables[0]
    return (words ^ errors[upper[words >> 11] ^ (words & 0x7FF)]) >> 11


def keys(prints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Per fingerprint the three keys it asks under, and the 72 (at most 18 different) it is filed under."""
    parts = [(prints >> shift) & ((1 << bits) - 1) for shift, bits in SEGMENTS]
    flips = np.array([0, *(1 << i for i in range(23))], dtype=np.int64)
    asked, filed = [], []
    for place, exact in enumerate(parts):
        near = parts[(place + 1) % 3]
        head = (np.int64(place) << 35) | (exact << 12)
        asked.append(head | codewords(near))
        filed.append(head[:, None] | codewords(near[:, None] ^ flips))
    return np.stack(asked, axis=1), np.concatenate(filed, axis=1)


def simhash(text: str | None, shingle: int = SHINGLE) -> int:
    """Majority bits of the XXH64 of every word shingle, as a signed 64-bit integer."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()  # bytes: A-Z and ASCII blanks only
    if not words:
        return 0
    size = min(shingle, len(words))
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    count = len(words) - size + 1
    firsts, lasts = starts[:count].tolist(), ends[size - 1 :].tolist()
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, count, CHUNK):
        digests = b"".join(
            [xxhash.xxh64_digest(line[a:b], SEED) for a, b in zip(firsts[at : at + CHUNK], lasts[at : at + CHUNK])]
        )
        bits = np.unpackbits(np.frombuffer(digests, np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > count).tobytes(), "big", signed=True)


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, text_hash, fp) of every document."""

    @F.pandas_udf("long")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        release()
        for texts in batches:
            yield pd.Series([simhash(text, shingle) for text in texts], dtype="int64")

    return docs.select("doc_id", F.xxhash64("text").alias("text_hash"), of("text").alias("fp"))


def links(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """Pairs (a, b), a < b, of the distinct ``fp`` that differ in at most ``radius`` bits, radius at most two."""
    if not 0 <= radius <= RADIUS:
        raise ValueError("the keys guarantee two differing bits at most")

    @F.pandas_udf("struct<asked:array<bigint>,filed:array<bigint>>")
    def keyed(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for series in batches:
            asked, filed = keys(series.to_numpy(np.int64))
            yield pd.DataFrame({"asked": list(asked), "filed": [np.unique(row) for row in filed]})

    both = prints.select("fp", keyed("fp").alias("k"))
    ask = both.select(F.col("fp").alias("a"), F.explode("k.asked").alias("key"))
    file = both.select(F.col("fp").alias("b"), F.explode("k.filed").alias("key"))
    return (
        ask.join(file, "key")
        .where((F.col("a") < F.col("b")) & (F.bit_count(F.col("a").bitwiseXOR(F.col("b"))) <= radius))
        .select("a", "b")
        .distinct()
    )


def grouped(prints: DataFrame, radius: int = RADIUS) -> DataFrame:
    """The rows of :func:`fingerprints` with the root fingerprint and the smallest id of their group."""
    least = prints.groupBy("fp").agg(F.min("doc_id").alias("least_id"))
    reached = components(links(least.select("fp"), radius))
    rooted = least.join(reached, least.fp == reached.node, "left").select(
        "fp", "least_id", F.coalesce("root", "fp").alias("root")
    )
    named = rooted.groupBy("root").agg(F.min("least_id").alias("component_id"))
    group = rooted.join(named, "root").select("fp", "root", "component_id")
    return prints.join(group, "fp")


def near_duplicate_groups(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every document of (doc_id, text)."""
    return grouped(staged(fingerprints(docs, shingle)), radius).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def keep_one(docs: DataFrame, shingle: int = SHINGLE, radius: int = RADIUS) -> DataFrame:
    """The document with the smallest id of each near-duplicate group, with all its columns.

    Where rows of a group share that id the one with the smallest text hash stays, and of rows that share both the
    smallest row. Rows with a null id all stay, as nothing can name them.
    """
    prints = staged(fingerprints(docs, shingle))
    groups = staged(grouped(prints, radius).select("doc_id", "text_hash", "root").where("doc_id IS NOT NULL"))
    me = F.struct("doc_id", "text_hash")
    firsts = groups.groupBy("root").agg(F.min(me).alias("first"))
    counted = groups.groupBy("root", "doc_id", "text_hash").agg(F.count("*").alias("times")).join(firsts, "root")
    # what does not stay as it is: other members, and first ones that occur more than once
    rest = staged(counted.where((me != F.col("first")) | (F.col("times") > 1)).select(
        me.alias("name"), (me == F.col("first")).alias("repeated")
    ))
    unstage(prints, groups)
    named = docs.select(F.struct("doc_id", F.xxhash64("text").alias("text_hash")).alias("name"), F.struct(*docs.columns).alias("row"))
    others = F.broadcast(rest) if rest.count() <= BROADCAST else rest
    kept = named.join(others, "name", "left_anti").select("row")
    again = named.join(others.where("repeated"), "name", "left_semi").groupBy("name").agg(F.min("row").alias("row"))
    return kept.unionByName(again.select("row")).select("row.*")
