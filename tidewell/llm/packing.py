"""Hierarchical packing of documents into context windows of several sizes.

Each document's ids end with an end id. Whole windows of the longest size are cut
off first; what is left of a document is routed to the smallest tier (512, 1024,
2048, 4096) that holds it. A window is opened for the longest waiting rest, its
gap is filled with the longest shorter rests that fit, and the last gap with the
head of the shortest rest, whose tail goes back to wait. Every window is thus full, a
power of two, and needs no padding. A task's last, open window is cut along the
binary digits of its length. Finally windows are dealt to step groups, longest
first to the lightest group, so that the groups of a task hold nearly equal tokens.

No shuffle: each task packs its own split with a bounded number of waiting ids, and
sequence and step ids carry the task's number. A null text counts as empty (one
piece: the end id alone); a null id stays null; repeated rows are packed each for itself.
Words are split at ASCII blanks, at which the tokenizer splits too, so ids of distinct
words are looked up once and remembered up to a bound.
"""

from __future__ import annotations

import heapq
import os
import re
import zlib
from bisect import bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame

from tidewell.llm.common import kept

TIERS = (512, 1024, 2048, 4096)
WAITING = 1 << 20  # ids that wait in a task before its rests are packed
STEP = 1 << 16  # tokens of a step group
REMEMBERED = 250_000  # words, and parts of words, of a generation; a task remembers two generations of each
SCHEMA = (
    "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, "
    "offset bigint, tier int, step_group bigint"
)
# The tokenizer's split rule, written out for lower-case Latin-1 characters.
_PARTS = re.compile(
    "'s|'t|'re|'ve|'m|'ll|'d|[a-zªµºß-öø-ÿ]+|[0-9²³¹¼½¾]|[^\x85\xa00-9²³¹¼½¾a-zªµºß-öø-ÿ]+"
)


class Memory(dict):
    """What was used of late: when a generation is full it is kept as the old one, and what is asked for again moves on."""

    def __init__(self):
        super().__init__()
        self.old: dict[str | bytes, bytes] = {}

    def __missing__(self, key: str | bytes) -> bytes | None:
        value = self.old.get(key)
        if value is not None:
            self[key] = value
        return value

    def turn(self) -> None:
        if len(self) > REMEMBERED:
            self.old = dict(self)
            self.clear()


class WordIds(Memory):
    """Little-endian 32-bit ids of a text, word by word.

    A word of Latin-1 characters is lower-cased and split here by the tokenizer's own rule, so that
    its ids are looked up by parts that many words share; other words, and those that may hold
    special strings, are encoded as they are.
    """

    def __init__(self, path: str):
        super().__init__()
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer, self.plain = Tokenizer.from_file(path), Tokenizer.from_file(path)
        self.plain.normalizer = None  # parts are lower-cased Latin-1 already, which the normalizer leaves as it is
        vocabulary = self.tokenizer.get_vocab(with_added_tokens=True)
        self.closes = np.zeros(max(vocabulary.values()) + 1, bool)
        self.closes[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self.parts = Memory()

    def learn_parts(self, parts: list[str]) -> None:
        """Ids of parts: encoded as one line of words, divided where a word closes."""
        ids = np.array(self.plain.encode_batch_fast([" ".join(parts)], add_special_tokens=False)[0].ids, "<u4")
        ends = (4 * (np.flatnonzero(self.closes[ids]) + 1)).tolist()
        if len(ends) != len(parts):
            raise ValueError("the tokenizer does not close each part once")
        line, at = ids.tobytes(), 0
        for part, end in zip(parts, ends):
            self.parts[part] = line[at:end]
            at = end

    def learn(self, words: set[bytes]) -> None:
        split, other = {}, []
        for word in words:
            text = word.decode()
            if max(text) <= "\xff" and "<|" not in text:
                split[word] = parts_of(text.lower())
            else:
                other.append(word)
        new = {part for parts in split.values() for part in parts if self.parts[part] is None}
        if new:
            self.learn_parts(list(new))
        for word, parts in split.items():
            self[word] = self.parts[parts[0]] if len(parts) == 1 else b"".join([self.parts[part] for part in parts])
        texts = [word.decode() for word in other]
        for word, found in zip(other, self.tokenizer.encode_batch(texts, add_special_tokens=False)):
            self[word] = np.array(found.ids, "<u4").tobytes()

    def encode(self, text: str) -> bytes:
        words = text.encode().split()  # bytes: at ASCII blanks only
        found = list(map(self.__getitem__, words))
        if None in found:
            self.learn({word for word, ids in zip(words, found) if ids is None})
            found = [self[word] if ids is None else ids for word, ids in zip(words, found)]
        self.turn()
        self.parts.turn()
        return b"".join(found)


def parts_of(word: str) -> list[str]:
    """The tokenizer's split of a lower-case Latin-1 word; most are letters, perhaps with one mark at the end."""
    if word.isalpha():
        return [word]
    if word[-1] in ".,;:!?" and word[:-1].isalpha():
        return [word[:-1], word[-1]]
    return _PARTS.findall(word)


def word_ids(path: str) -> WordIds:
    return kept(("packing", path), lambda: WordIds(path))


class Packer:
    """The waiting rests of one task. A rest is (length, number, doc_id, start, ids, document tokens)."""

    def __init__(self, task: int):
        self.base = task << 33
        self.sequences = self.steps = self.number = self.tokens = 0
        self.rests: list[tuple] = []

    def add(self, doc_id: int | None, ids: bytes) -> list[tuple]:
        """Whole windows of one document as sequences; the rest waits."""
        total, whole = len(ids) // 4, []
        size = TIERS[-1]
        for start in range(0, total - size + 1, size):
            whole.append([(size, 0, doc_id, start, ids[4 * start : 4 * (start + size)], total)])
        done = total // size * size
        if done < total:
            self.wait(doc_id, done, ids[4 * done :], total)
        return whole

    def wait(self, doc_id: int | None, start: int, ids: bytes, total: int) -> None:
        self.number += 1
        self.tokens += len(ids) // 4
        insort(self.rests, (len(ids) // 4, self.number, doc_id, start, ids, total), key=lambda rest: rest[:2])

    def take(self, place: int) -> tuple:
        rest = self.rests.pop(place)
        self.tokens -= rest[0]
        return rest

    def cut(self, rest: tuple, length: int) -> tuple:
        """The head of a rest; its tail waits again."""
        _, number, doc_id, start, ids, total = rest
        self.wait(doc_id, start + length, ids[4 * length :], total)
        return (length, number, doc_id, start, ids[: 4 * length], total)

    def pack(self, last: bool) -> list[list[tuple]]:
        """Full windows from the waiting rests; only an open window's parts wait on, or are laid out if ``last``."""
        full = []
        while self.rests:
            window = [self.take(-1)]
            size = next(tier for tier in TIERS if tier >= window[0][0])
            gap = size - window[0][0]
            while gap and self.rests:
                fitting = bisect_right(self.rests, gap, key=lambda rest: rest[0])
                rest = self.take(fitting - 1) if fitting else self.cut(self.take(0), gap)
                window.append(rest)
                gap -= rest[0]
            if not gap:
                full.append(window)
            elif last:
                full += self.laid_out(window)
            else:
                for _, _, doc_id, start, ids, total in window:
                    self.wait(doc_id, start, ids, total)
                break
        return full

    @staticmethod
    def laid_out(parts: list[tuple]) -> list[list[tuple]]:
        """Parts of an open window as sequences whose lengths are the binary digits of the whole length."""
        left, out = sum(part[0] for part in parts), []
        parts = parts[::-1]
        while left:
            gap = 1 << (left.bit_length() - 1)
            left -= gap
            window = []
            while gap:
                length, number, doc_id, start, ids, total = parts.pop()
                if length > gap:
                    parts.append((length - gap, number, doc_id, start + gap, ids[4 * gap :], total))
                    length, ids = gap, ids[: 4 * gap]
                window.append((length, number, doc_id, start, ids, total))
                gap -= length
            out.append(window)
        return out

    def rows(self, windows: list[list[tuple]]) -> pa.RecordBatch:
        """Pieces with their sequence, offset and step group."""
        sizes = [sum(part[0] for part in window) for window in windows]
        groups = [(0, group) for group in range(max(1, round(sum(sizes) / STEP)))]
        columns: list[list] = [[] for _ in range(9)]
        for place in sorted(range(len(windows)), key=lambda place: -sizes[place]):
            load, group = heapq.heappop(groups)
            heapq.heappush(groups, (load + sizes[place], group))
            offset = 0
            for length, _, doc_id, start, ids, total in windows[place]:
                values = (
                    doc_id, start, length, zlib.crc32(ids), total, self.base + self.sequences, offset,
                    sizes[place], self.base + self.steps + group,
                )
                for column, value in zip(columns, values):
                    column.append(value)
                offset += length
            self.sequences += 1
        self.steps += len(groups)
        types = [pa.int64()] * 7 + [pa.int32(), pa.int64()]
        names = [field.split()[0] for field in SCHEMA.split(", ")]
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)


def pack(docs: DataFrame, tokenizer: str, end_id: int = 2) -> DataFrame:
    """One row per piece of every document of (doc_id, text)."""
    end = end_id.to_bytes(4, "little")

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, packer = word_ids(tokenizer), Packer(TaskContext.get().partitionId())
        windows: list[list[tuple]] = []
        for batch in batches:
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                windows += packer.add(doc_id, ids.encode(text.as_py() or "") + end)
                if packer.tokens >= WAITING:
                    windows += packer.pack(last=False)
                if len(windows) >= 512:
                    yield packer.rows(windows)
                    windows = []
        windows += packer.pack(last=True)
        if windows:
            yield packer.rows(windows)

    return docs.select("doc_id", "text").mapInArrow(packed, SCHEMA)
