"""Token counts by pre-token frequencies.

The tokenizer never merges across a blank that follows a non-blank, nor across a
line end, so a text falls apart into pre-tokens whose counts add up. Each distinct
pre-token of the corpus is encoded once and only the number of its pieces is kept. Documents meet
the counts by a join: the most frequent pre-tokens, a bounded number, are
joined inside the tasks that read the texts; the others by a shuffle on the
pre-token. Sums are per row, so repeated rows and null ids keep rows of their own. A
null or empty text has no bytes and no tokens.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tidewell.llm.common import kept, staged

FREQUENT = 1 << 17  # pre-tokens that are broadcast: about 3 MB
COUNTED = 1 << 18  # distinct pre-tokens a task adds up before it hands them on
LIMIT = 4096
_PRE_TOKENS = re.compile("[ ▁]*[^ ▁\n]+|[ ▁]+|\n")


def pre_tokens(text: str | None) -> list[str]:
    """Blanks with the word after them, line ends alone; the tokenizer puts a blank before every text."""
    return _PRE_TOKENS.findall(" " + text) if text else []


class Pieces:
    """Number of pieces of a pre-token."""

    def __init__(self, path: str):
        import sentencepiece
        from sentencepiece import sentencepiece_model_pb2

        with open(path, "rb") as file:
            model = sentencepiece_model_pb2.ModelProto.FromString(file.read())
        for piece in model.pieces:
            if "\n" in piece.piece or re.search("[^▁]▁", piece.piece):
                raise ValueError(f"a piece crosses pre-tokens: {piece.piece!r}")
        model.normalizer_spec.add_dummy_prefix = False  # pre_tokens puts it
        self.model = sentencepiece.SentencePieceProcessor(model_proto=model.SerializeToString())

    def count(self, words: list[str]) -> list[int]:
        return [len(ids) for ids in self.model.encode(words, num_threads=1)]


def pieces(path: str) -> Pieces:
    return kept(("token_counts", path), lambda: Pieces(path))


def vocabulary(docs: DataFrame, model: str) -> DataFrame:
    """(word, n, pieces): every distinct pre-token with its frequency and its number of pieces."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[str] = Counter()

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array(list(total), pa.string()), pa.array(list(total.values()), pa.int64())], names=["word", "n"]
            )

        for batch in batches:
            for text in batch.column(0):
                total.update(pre_tokens(text.as_py()))
                if len(total) > COUNTED:
                    yield out()
                    total.clear()
        yield out()

    def measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = pieces(model)
        for batch in batches:
            numbers = found.count(batch.column("word").to_pylist())
            yield pa.RecordBatch.from_arrays(
                [batch.column("word"), batch.column("n"), pa.array(numbers, pa.int64())], names=["word", "n", "pieces"]
            )

    words = docs.select("text").mapInArrow(counted, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))
    return words.mapInArrow(measured, "word string, n bigint, pieces bigint")


def most_frequent(known: DataFrame) -> pd.DataFrame:
    """The most frequent pre-tokens, FREQUENT at most: those above the lowest sixteenth of a power of two that allows it.

    Two small sums find the bound, so that tasks send the driver the chosen rows only.
    """
    step = F.floor(F.log2("n") * 16)
    chosen, bound = 0, None
    for row in known.groupBy(step.alias("step")).count().orderBy(F.desc("step")).collect():
        chosen += row["count"]
        if chosen > FREQUENT:
            break
        bound = row["step"]
    kept = known.where(step >= bound) if bound is not None else known.limit(0)
    return kept.select("word", "pieces").toPandas()


def token_counts(docs: DataFrame, model: str, limit: int = LIMIT) -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every document of (doc_id, text)."""
    spark = docs.sparkSession
    known = staged(vocabulary(docs, model))
    top = most_frequent(known)
    frequent = spark.sparkContext.broadcast(dict(zip(top["word"].tolist(), top["pieces"].tolist())))

    def split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common = frequent.value
        types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64()]
        names = ["row", "doc_id", "n_bytes", "tokens", "word", "times"]
        for batch in batches:
            columns: list[list] = [[] for _ in types]
            for row, doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2)):
                text = text.as_py() or ""
                tokens, words, times = 0, [], []
                for word, n in Counter(pre_tokens(text)).items():
                    if (found := common.get(word)) is not None:
                        tokens += n * found
                    else:
                        words.append(word)
                        times.append(n)
                if not words:  # no pre-token has this form, so it meets nothing, and such rows spread evenly
                    words, times = [f"\n{row}"], [0]
                rest = [None] * (len(words) - 1)
                values = ([row] * len(words), [doc_id, *rest], [len(text.encode()), *rest], [tokens, *rest], words, times)
                for column, value in zip(columns, values):
                    column += value
                if len(columns[0]) > 1 << 17:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)
                    columns = [[] for _ in types]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    rare = docs.select(F.monotonically_increasing_id().alias("row"), "doc_id", "text").mapInArrow(
        split, "row bigint, doc_id bigint, n_bytes bigint, tokens bigint, word string, times bigint"
    )
    joined = rare.join(known.select("word", "pieces"), "word", "left")
    tokens = F.coalesce("tokens", F.lit(0)) + F.col("times") * F.coalesce("pieces", F.lit(0))
    summed = joined.groupBy("row").agg(
        F.max("doc_id").alias("doc_id"), F.max("n_bytes").alias("n_bytes"), F.sum(tokens).alias("n_tokens")
    )
    return summed.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
