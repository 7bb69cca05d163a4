"""Benchmark passages in documents, by SimHash of windows as long as the items.

Only a window that shares a word shingle with an item can be similar to it. So each
document's shingles are looked up in those of the benchmark, and around every hit windows of
the item's size, at every place, get a SimHash. A multi-index over six blocks of the
fingerprint finds all items within RADIUS bits: of six blocks one differs in at
most RADIUS / 6 bits, and each item is filed under all such values of each block. The multiset (weighted)
Jaccard similarity of the shingles themselves decides.

Documents are read once per block of items and never shuffled; a block of the benchmark is what is
broadcast, and holds a bounded number of items (BLOCK). Words are compared case-folded, in every script.
Null or empty texts and items match nothing. An item shorter than a shingle is one shingle. A document
shorter than an item is one window. Repeated documents each match; repeated items too; a null id stays null.
"""

from __future__ import annotations

from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidewell.llm.common import kept
from tidewell.llm.substring_dedup import run_hashes, word_hashes

SHINGLE = 5
SIMILARITY = 0.8
RADIUS = 17
BLOCK = 4096  # items held by a task at a time, about
STARTS = 4096  # windows fingerprinted at a time
# (shift, bits) of the six blocks of a fingerprint
BLOCKS = ((53, 11), (42, 11), (31, 11), (20, 11), (10, 10), (0, 10))
SCHEMA = "doc_id bigint, item_id bigint, start bigint, stop bigint, similarity double"


def words_of(text: str | None) -> list[bytes]:
    return (text or "").casefold().encode("utf-8", "surrogatepass").split()


def shingles(words: list[bytes], size: int) -> Counter:
    return Counter(tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1)))


def similarity(a: Counter, b: Counter) -> float:
    """Weighted Jaccard similarity of two multisets."""
    common = sum((a & b).values())
    return common / (sum(a.values()) + sum(b.values()) - common)


def window_prints(hashes: np.ndarray, starts: np.ndarray, count: int) -> np.ndarray:
    """SimHash of ``count`` consecutive shingle hashes from each start."""
    first, last = int(starts[0]), int(starts[-1]) + count
    bits = np.unpackbits(hashes[first:last].astype(">u8").view(np.uint8).reshape(-1, 8), axis=1)
    sums = np.zeros((len(bits) + 1, 64), np.int32)
    np.cumsum(bits, axis=0, out=sums[1:])
    ones = sums[starts - first + count] - sums[starts - first]
    return np.packbits(2 * ones > count, axis=1).view(">u8").astype(np.uint64).ravel()


class Items:
    """A block of benchmark items with their shingles, fingerprints and multi-index."""

    def __init__(self, rows: list[tuple[int | None, str | None]], size: int = SHINGLE, least: float = SIMILARITY):
        self.least = least
        self.ids, self.words, self.sizes = [], [], []
        owners: dict[int, dict[int, list[int]]] = defaultdict(lambda: defaultdict(list))
        prints = []
        for item_id, text in rows:
            words = words_of(text)
            if not words:
                continue
            run, number = min(size, len(words)), len(self.ids)
            hashes = run_hashes(word_hashes(words), run, 5)
            for value in set(hashes.tolist()):
                owners[run][value].append(number)
            prints.append(window_prints(hashes, np.array([0]), len(hashes))[0])
            self.ids.append(item_id)
            self.words.append(words)
            self.sizes.append(run)
        self.prints = np.array(prints, np.uint64)
        self.owners = {run: dict(found) for run, found in owners.items()}
        self.known = {run: np.sort(np.array(list(found), np.uint64)) for run, found in owners.items()}
        self.maps = {run: self.bitmap(found) for run, found in self.known.items()}
        self.index = [self.filed(shift, bits) for shift, bits in BLOCKS]

    @staticmethod
    def bitmap(values: np.ndarray) -> np.ndarray:
        """Which low 22 bits occur: a first, cheap look before the sorted search."""
        out = np.zeros(1 << 22, bool)
        out[(values & np.uint64((1 << 22) - 1)).astype(np.int64)] = True
        return out

    def filed(self, shift: int, bits: int) -> list[np.ndarray]:
        """Per value of a block the items whose block lies within RADIUS / 6 bits."""
        flips = [0]
        for number in range(1, RADIUS // len(BLOCKS) + 1):
            flips += [sum(1 << place for place in places) for places in combinations(range(bits), number)]
        values = ((self.prints >> np.uint64(shift)) & np.uint64((1 << bits) - 1)).astype(np.int64)
        keys = (values[:, None] ^ np.array(flips)).ravel()
        order = np.argsort(keys, kind="stable")
        owner = np.repeat(np.arange(len(values)), len(flips))[order]
        return np.split(owner, np.searchsorted(keys[order], np.arange(1, 1 << bits)))

    def hits(self, hashes: np.ndarray, run: int) -> np.ndarray:
        places = np.flatnonzero(self.maps[run][(hashes & np.uint64((1 << 22) - 1)).astype(np.int64)])
        known = self.known[run]
        at = np.minimum(np.searchsorted(known, hashes[places]), len(known) - 1)
        return places[known[at] == hashes[places]]

    def matches(self, text: str | None) -> list[tuple[int | None, int, int, float]]:
        """(item_id, start, stop, similarity) of the best window of each item that is similar enough."""
        words = words_of(text)
        best: dict[int, tuple[float, int, int]] = {}
        hashed = word_hashes(words) if words else None
        for run in self.owners:
            if len(words) < run:
                continue
            hashes = run_hashes(hashed, run, 5)
            windows: dict[int, list[np.ndarray]] = defaultdict(list)
            for place in self.hits(hashes, run).tolist():
                for size in {len(self.words[owner]) for owner in self.owners[run][int(hashes[place])]}:
                    size = min(size, len(words))
                    starts = np.arange(max(0, place - size + run), min(place, len(words) - size) + 1)
                    windows[size].append(starts)
            for size, found in windows.items():
                starts = np.unique(np.concatenate(found))
                for at in range(0, len(starts), STARTS):
                    for part in np.split(starts[at : at + STARTS], np.flatnonzero(np.diff(starts[at : at + STARTS]) > STARTS) + 1):
                        self.verify(words, hashes, part, size, run, best)
        return [(self.ids[item], start, stop, value) for item, (value, start, stop) in sorted(best.items())]

    def verify(self, words, hashes, starts, size, run, best) -> None:
        for start, print_ in zip(starts.tolist(), window_prints(hashes, starts, size - run + 1)):
            near = {
                item
                for (shift, bits), filed in zip(BLOCKS, self.index)
                for item in filed[int(print_) >> shift & (1 << bits) - 1].tolist()
                if (int(print_) ^ int(self.prints[item])).bit_count() <= RADIUS
            }
            for item in near:
                if self.sizes[item] != run or min(len(self.words[item]), len(words)) != size or best.get(item, (0,))[0] == 1:
                    continue
                value = similarity(shingles(words[start : start + size], run), shingles(self.words[item], run))
                if value >= self.least and value > best.get(item, (0,))[0]:
                    best[item] = (value, start, start + size)


def blocks(items: DataFrame) -> Iterator[tuple[str, list[tuple]]]:
    """The benchmark's items, some thousand at a time, each with a name for the block."""
    number = max(1, -(-items.count() // BLOCK))
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(number))
    for block in range(number):
        rows = [tuple(row) for row in items.where(part == block).select("item_id", "text").collect()]
        yield f"{hash(tuple(rows))}", rows


def built(name: str, rows: list[tuple]) -> Items:
    """The index of a block, made once per Python worker."""
    return kept(("decontamination", name), lambda: Items(rows))


def leaked_passages(docs: DataFrame, items: DataFrame) -> DataFrame:
    """(doc_id, item_id, start, stop, similarity): documents of (doc_id, text) and the items they hold, words [start, stop)."""
    out = None
    for name, rows in blocks(items):
        shared = docs.sparkSession.sparkContext.broadcast(rows)

        def found(batches: Iterator[pa.RecordBatch], name=name, shared=shared) -> Iterator[pa.RecordBatch]:
            index = built(name, shared.value)
            types = [pa.int64()] * 4 + [pa.float64()]
            for batch in batches:
                columns: list[list] = [[] for _ in types]
                for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                    for match in index.matches(text.as_py()):
                        for column, value in zip(columns, (doc_id, *match)):
                            column.append(value)
                names = [field.split()[0] for field in SCHEMA.split(", ")]
                yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

        part = docs.select("doc_id", "text").mapInArrow(found, SCHEMA)
        out = part if out is None else out.union(part)
    return out


def _is_clean(name: str, shared) -> Column:
    @F.pandas_udf("boolean")
    def clean(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        index = built(name, shared.value)
        for texts in batches:
            yield pd.Series([not index.matches(text) for text in texts], dtype=bool)

    return clean("text")


def without_leaks(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The documents that hold no benchmark item, with all their columns."""
    for name, rows in blocks(items):
        docs = docs.where(_is_clean(name, docs.sparkSession.sparkContext.broadcast(rows)))
    return docs
