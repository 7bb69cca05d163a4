"""Removal of word windows that an earlier document already has.

The k-mers of k consecutive words are the edges of a De Bruijn graph of the corpus;
only edges that two documents share can be repeats. So the graph is kept sparse:

1. Every document hands on its minimizers: the least hash of short word runs in each
   k-word window. Equal windows have equal minimizers, so a window can only
   repeat where its minimizer is in two documents.
2. Windows under a shared minimizer are the edges (hash of k words, document, place). An
   edge's source is the smallest document that has it; a join tells every other
   document of it.
3. Edges that follow each other in a document and have one source compact into a path, a
   maximal repeated span, by a window over the document's own places.
4. Spans go back to their texts by document and text hash, and the words they cover are left out.

Hashes of windows are 64 bits with 32 further bits that must agree too. Frequent minimizers and windows are summed before
they are shuffled and joined as ordinary keys, so adaptive skew joins can split them.

A null or empty text has no words. Documents with null ids take no part: nothing is smaller, and they keep all words. Rows
that repeat an id count as one document and never remove each other's words. Texts of fewer than k words are kept whole.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from numpy.lib.stride_tricks import sliding_window_view
from pyspark.sql import DataFrame, Window, functions as F

from tidewell.llm.common import release, staged, unstage

WINDOW = 13
RUN = 6


def words_of(text: str | None) -> list[bytes]:
    """Words between ASCII blanks, unchanged, as UTF-8."""
    return (text or "").encode("utf-8", "surrogatepass").split()


def _factors(count: int, seed: int) -> list[np.uint64]:
    """Odd 64-bit factors, one for each place of a run."""
    return [np.uint64(xxhash.xxh64_intdigest(b"%d" % place, seed) | 1) for place in range(count)]


def _mixed(values: np.ndarray) -> np.ndarray:
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def run_hashes(words: np.ndarray, size: int, seed: int) -> np.ndarray:
    """Hash of every ``size`` consecutive word hashes."""
    count = len(words) - size + 1
    out = np.zeros(max(0, count), dtype=np.uint64)
    if count > 0:
        for place, factor in enumerate(_factors(size, seed)):
            out += words[place : place + count] * factor
    return _mixed(out)


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def minimizers(hashes: np.ndarray, window: int, run: int) -> np.ndarray:
    """Of every window of words, the least hash of its runs."""
    return sliding_window_view(run_hashes(hashes, run, 1), window - run + 1).min(axis=1).view(np.int64)


def _batch(names: list[str], columns: list[list[np.ndarray]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in columns], names=names)


def shared_minimizers(docs: DataFrame, window: int, run: int) -> DataFrame:
    """(doc_id, shared): the minimizers of each document that another document has too."""

    def sketched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        release()
        for batch in batches:
            columns: list[list[np.ndarray]] = [[np.zeros(0, np.int64)], [np.zeros(0, np.int64)]]
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                words = words_of(text.as_py())
                if len(words) >= window:
                    found = np.unique(minimizers(word_hashes(words), window, run))
                    columns[0].append(np.full(len(found), doc_id, np.int64))
                    columns[1].append(found)
            yield _batch(["doc_id", "m"], columns)

    each = staged(docs.select("doc_id", "text").mapInArrow(sketched, "doc_id bigint, m bigint"))
    span = each.groupBy("m").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
    shared = span.where("first < last").select("m")
    out = staged(each.join(shared, "m").groupBy("doc_id").agg(F.collect_set("m").alias("shared")))
    unstage(each)
    return out


def edges(docs: DataFrame, shared: DataFrame, window: int, run: int) -> DataFrame:
    """(doc_id, text_hash, place, h, g): every window under a shared minimizer; h and g together are its hash."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["doc_id", "text_hash", "place", "h", "g"]
        for batch in batches:
            columns: list[list[np.ndarray]] = [[np.zeros(0, t)] for t in ("i8", "i8", "i4", "i8", "i4")]
            size = 0
            rows = zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2), batch.column(3))
            for doc_id, text_hash, text, common in rows:
                words = words_of(text.as_py())
                if len(words) < window:
                    continue
                hashes = word_hashes(words)
                places = np.flatnonzero(np.isin(minimizers(hashes, window, run), common.values.to_numpy()))
                columns[0].append(np.full(len(places), doc_id, np.int64))
                columns[1].append(np.full(len(places), text_hash, np.int64))
                columns[2].append(places.astype("i4"))
                columns[3].append(run_hashes(hashes, window, 2).view(np.int64)[places])
                columns[4].append((run_hashes(hashes, window, 3)[places] >> np.uint64(32)).astype("u4").view("i4"))
                size += len(places)
                if size > 1 << 18:
                    yield _batch(names, columns)
                    columns, size = [[column[0][:0]] for column in columns], 0
            yield _batch(names, columns)

    texts = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text").join(shared, "doc_id")
    return texts.mapInArrow(cut, "doc_id bigint, text_hash bigint, place int, h bigint, g int")


def repeated_spans(docs: DataFrame, window: int = WINDOW, run: int = RUN) -> DataFrame:
    """(doc_id, text_hash, start, stop, source): word ranges [start, stop) that ``source``, a smaller id, has too."""
    docs = docs.where(F.col("doc_id").isNotNull())
    shared = shared_minimizers(docs, window, run)
    found = staged(edges(docs, shared, window, run))
    unstage(shared)
    first = found.groupBy("h", "g").agg(F.min("doc_id").alias("source"), F.max("doc_id").alias("last"))
    sources = staged(first.where("source < last").select("h", "g", "source"))
    joined = found.join(sources, ["h", "g"]).where("doc_id > source")
    later = staged(joined.select("doc_id", "text_hash", "place", "source"))
    unstage(found, sources)
    path = Window.partitionBy("doc_id", "text_hash", "source").orderBy("place")
    islands = later.distinct().withColumn("path", F.col("place") - F.row_number().over(path))
    spans = islands.groupBy("doc_id", "text_hash", "source", "path").agg(
        F.min("place").alias("start"), (F.max("place") + window).alias("stop")
    )
    out = staged(spans.select("doc_id", "text_hash", "start", "stop", "source"))
    unstage(later)
    return out


def without_spans(docs: DataFrame, spans: DataFrame) -> DataFrame:
    """``docs`` with n_words, n_removed and kept_text (kept words joined by a space; null where nothing is removed)."""
    ranges = spans.groupBy("doc_id", "text_hash").agg(F.collect_list(F.struct("start", "stop")).alias("removed_spans"))
    marked = docs.withColumn("text_hash", F.xxhash64("text")).join(ranges, ["doc_id", "text_hash"], "left")

    @F.udf("struct<n_words:bigint,n_removed:bigint,kept_text:string,kept_sha256:string>", useArrow=True)
    def cut(text: str | None, removed: list | None):
        words = words_of(text)
        if not removed:
            return len(words), 0, None, hashlib.sha256(b" ".join(words)).hexdigest()
        covered = np.zeros(len(words) + 1, np.int64)
        for start, stop in ((span["start"], span["stop"]) for span in removed):
            covered[start] += 1
            covered[stop] -= 1
        keep = np.cumsum(covered[:-1]) == 0
        kept = b" ".join([word for word, stays in zip(words, keep.tolist()) if stays])
        return len(words), int(len(words) - keep.sum()), kept.decode("utf-8", "surrogatepass"), hashlib.sha256(kept).hexdigest()

    return marked.withColumn("cut", cut("text", "removed_spans")).select(*docs.columns, "cut.*")


def substring_digest(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) of every document of (doc_id, text)."""
    spans = repeated_spans(docs.select("doc_id", "text"), window)
    return without_spans(docs.select("doc_id", "text"), spans).select("doc_id", "n_words", "n_removed", "kept_sha256")
