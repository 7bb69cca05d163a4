"""Spelling variants: words that differ by one inserted, deleted or replaced code point, and the form each rare one stands for.

Dense prefix-suffix tiling: two words of lengths at most m and at least m - 1 differ by a single edit exactly if
their common prefix and common suffix together reach m - 1, where m is the longer length. Words are laid out as
padded code-point matrices, and blocks of rows are compared with each other whole.

Which blocks meet: the common prefix of such a pair is as long as the place of its edit. A window [lo, hi) of
places fixes the first lo and the last m - hi code points, so words are filed under both halves of [0, m) for both
lengths m they can have as the longer partner's. A group with more than ``GROUP`` words is filed again under the
halves of its window; at one place a group holds no more words than the alphabet has letters, so every group ends
up bounded and no pair is lost. A pair is reported in the one window that holds its edit.

Null texts hold no words; a null id counts as the empty text; repeated rows count as often as they occur; empty
tables give no rows. Words of any length are compared whole, with blocks bounded in code points.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from tidewell.llm.common import staged, unstage

LETTERS = "A-Za-zÀ-ÿ"  # all at most U+00FF, so a code point is a byte of the matrices
SHORTEST = 7  # code points of a word
RARE = 31  # one in so many runs loses a code point
LEAST = 2  # occurrences of a word
RATIO = 10  # a form occurs at least so many times as often
GROUP = 512  # words of a group that is compared as it is
BLOCK = 128  # rows of a block, for words of up to CELLS / BLOCK code points
CELLS = 1 << 15  # code points of a block
FRAME = ["m", "lo", "hi", "key"]
PAIRS = "word string, near string, near_n bigint"


def lower_ascii(run: Column) -> Column:
    """A-Z in lower case and nothing else."""
    upper = "".join(map(chr, range(ord("A"), ord("Z") + 1)))
    return F.when(run.rlike("[À-Þ]"), F.translate(run, upper, upper.lower())).otherwise(F.lower(run))


def misspelt_words(docs: DataFrame) -> DataFrame:
    """(word, n): runs of letters, of which every thirty-first by hash lost a code point; runs too short to count stay in the scan."""
    runs = F.regexp_extract_all(F.coalesce("text", F.lit("")), F.lit(f"([{LETTERS}]{{{SHORTEST},}})"), 1)
    one = docs.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.explode(runs).alias("run"))
    one = one.select("id", lower_ascii(F.col("run")).alias("run"))
    hashed = one.select("run", F.crc32(F.concat_ws(":", "id", "run").cast("binary")).alias("h"))
    at = (F.col("h") % F.length("run")).cast("int")
    cut = F.concat(F.substr("run", F.lit(1), at), F.substr("run", at + 2))
    words = hashed.select(F.when(F.col("h") % RARE == 0, cut).otherwise(F.col("run")).alias("word"))
    counts = words.where(F.length("word") >= SHORTEST).groupBy("word").agg(F.count("*").alias("n"))
    return counts.where(F.col("n") >= LEAST)


def _framed(rows: DataFrame, frames: Column) -> DataFrame:
    """Rows filed under each (m, lo, hi), with a key of the code points that the window fixes."""
    rows = rows.select("word", "n", F.explode(frames).alias("frame")).select("word", "n", "frame.*")
    head, tail = F.substr("word", F.lit(1), F.col("lo")), F.substr("word", F.length("word") - F.col("m") + F.col("hi") + 1)
    return rows.withColumn("key", F.xxhash64("m", "lo", "hi", head, tail))


def _halves(m: Column, lo: Column, hi: Column) -> list[Column]:
    middle = F.floor((lo + hi) / 2).cast("int")
    bounds = ((lo, middle), (middle, hi))
    return [F.struct(m.alias("m"), a.cast("int").alias("lo"), b.cast("int").alias("hi")) for a, b in bounds]


def filed(words: DataFrame) -> tuple[DataFrame, list[DataFrame]]:
    """(word, n, m, lo, hi, key) in groups of at most ``GROUP`` words, and the staged tables to free afterwards."""
    length, zero, helpers = F.length("word"), F.lit(0), []
    frames = F.array(*[half for m in (length, length + 1) for half in _halves(m, zero, m)])
    rows, parts = _framed(words, frames), []
    while True:
        crowd = staged(rows.groupBy(*FRAME).count().where((F.col("count") > GROUP) & (F.col("hi") - F.col("lo") > 1)).drop("count"))
        helpers.append(crowd)
        if crowd.isEmpty():
            parts.append(rows)
            break
        parts.append(rows.join(crowd, FRAME, "left_anti").select("word", "n", *FRAME))
        halves = F.array(*_halves(F.col("m"), F.col("lo"), F.col("hi")))
        rows = staged(_framed(rows.join(crowd, FRAME, "left_semi"), halves))
        helpers.append(rows)
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole, helpers


class Block:
    """Words of one longer length m: code points aligned left and right, the window and the group of each row."""

    def __init__(self, m: int, rows: list[tuple]):
        self.words, self.n, self.lo, self.hi, self.group = zip(*rows)
        codes = [word.encode("latin-1") for word in self.words]
        self.lengths = np.array([len(code) for code in codes])
        self.left = np.frombuffer(b"".join(code.ljust(m, b"\0") for code in codes), np.uint8).reshape(-1, m).T.copy()
        self.right = np.frombuffer(b"".join(code.rjust(m, b"\0") for code in codes), np.uint8).reshape(-1, m).T.copy()
        self.m, self.groups = m, np.array(self.group)


def _common(a: np.ndarray, b: np.ndarray, places: range) -> np.ndarray:
    """How many code points every row of a shares with every row of b, from the first of ``places`` on."""
    alive = np.ones((a.shape[1], b.shape[1]), bool)
    found = np.zeros(alive.shape, np.uint8 if len(places) < 256 else np.int32)
    for place in places:
        alive &= a[place][:, None] == b[place][None, :]
        if not alive.any():
            break
        found += alive
    return found


def compared(a: Block, b: Block) -> Iterator[tuple[str, str, int]]:
    """Both directions of each single edit between two blocks (or within one) whose edit lies in their group's window."""
    m = a.m
    prefix = _common(a.left, b.left, range(m))
    suffix = _common(a.right, b.right, range(m - 1, -1, -1))
    close = (prefix.astype(np.int32) + suffix >= m - 1) & (a.groups[:, None] == b.groups[None, :])
    close &= np.maximum(a.lengths[:, None], b.lengths[None, :]) == m
    if a is b:
        close = np.triu(close, 1)
    for i, j in zip(*np.nonzero(close)):
        if a.lo[i] <= prefix[i, j] < a.hi[i] and a.words[i] != b.words[j]:
            yield a.words[i], b.words[j], b.n[j]
            yield b.words[j], a.words[i], a.n[i]


def _tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come sorted by group. Blocks are filled across groups of one m; blocks that hold rows of one group meet."""
    names = [field.split()[0] for field in PAIRS.split(", ")]
    types = [pa.string(), pa.string(), pa.int64()]
    found: list[tuple] = []
    before: list[Block] = []  # earlier blocks whose last group may go on
    rows: list[tuple] = []
    m = 0

    def close_block() -> None:
        nonlocal before
        if not rows:
            return
        block = Block(m, rows)
        before = [old for old in before if old.group[-1] == block.group[0]]
        for other in (*before, block):
            found.extend(compared(other, block))
        before.append(block)
        rows.clear()

    def drained() -> pa.RecordBatch:
        columns = list(zip(*found)) or [(), (), ()]
        found.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types)], names=names)

    for batch in batches:
        for word, n, longer, lo, hi, key in zip(*[column.to_pylist() for column in batch.columns]):
            if longer != m or len(rows) >= min(BLOCK, max(1, CELLS // longer)):
                close_block()
                if longer != m:
                    before, m = [], longer
            rows.append((word, n, lo, hi, hash((lo, hi, key))))
        if len(found) > 10_000:
            yield drained()
    close_block()
    yield drained()


def near_words(words: DataFrame) -> DataFrame:
    """(word, n_near, best): per word with a partner the number of its near words and the one of largest n (ties: the smallest)."""
    rows, helpers = filed(words)
    sorted_rows = rows.select("word", "n", *FRAME).repartition(*FRAME).sortWithinPartitions(*FRAME, "word")
    pairs = sorted_rows.mapInArrow(_tiles, PAIRS)
    best = F.min(F.struct((-F.col("near_n")).alias("less"), "near"))
    near = staged(pairs.groupBy("word").agg(F.count("*").alias("n_near"), best.alias("best")))
    unstage(*helpers)
    return near


def roots(links: DataFrame) -> DataFrame:
    """(word, root) of (word, form): forms are followed by doubling; each step's n is ten times the last, so chains are short."""
    found = staged(links.select("word", F.col("form").alias("root")))
    while True:
        following = found.select(F.col("word").alias("root"), F.col("root").alias("further"))
        if found.join(following, "root", "left_semi").isEmpty():
            return found
        longer = found.join(following, "root", "left").select("word", F.coalesce("further", "root").alias("root"))
        after = staged(longer)
        unstage(found)
        found = after


def variant_groups(words: DataFrame) -> DataFrame:
    """word, form, root, n, n_near, form_n of every row of (word, n); words are distinct."""
    words = staged(words.select("word", "n"))
    near = near_words(words)
    joined = words.join(near, "word", "left")
    is_form = -F.col("best.less") >= F.col("n") * RATIO
    told = staged(
        joined.select(
            "word",
            F.when(is_form, F.col("best.near")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"),
            F.when(is_form, -F.col("best.less")).alias("form_n"),
        )
    )
    unstage(near, words)
    ends = roots(told.where("form IS NOT NULL"))
    return told.join(ends, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n"
    )


# The same in SQL: words by crc32's table; single edits are equal words once one place is cut out of one or both.
ORACLE = """
WITH RECURSIVE crc AS (
  SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_prepend(i, range(8)),
      lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
    FROM range(256) AS r(i))),
found AS (
  SELECT coalesce(doc_id::VARCHAR, '') AS id,
    unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-zÀ-ÿ]{7,}')) AS run FROM documents),
runs AS (
  SELECT id, translate(run, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM found),
often AS (SELECT id, run, count(*) AS times FROM runs GROUP BY id, run),
hashed AS (
  SELECT run, times, xor(list_reduce(list_prepend(4294967295, flatten(list_transform(string_split(id || ':' || run, ''),
      lambda x: CASE WHEN unicode(x) < 128 THEN [unicode(x)::BIGINT] ELSE [(192 + (unicode(x) >> 6))::BIGINT, (128 + (unicode(x) & 63))::BIGINT] END))),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) AS h
  FROM often, crc),
spelt AS (
  SELECT times, CASE WHEN h % 31 = 0 THEN left(run, (h % length(run))::INT) || substr(run, (h % length(run))::INT + 2) ELSE run END AS word
  FROM hashed),
words AS (SELECT word, sum(times)::BIGINT AS n FROM spelt WHERE length(word) >= 7 GROUP BY word HAVING sum(times) >= 2),
places AS (SELECT word, unnest(range(length(word))) AS place FROM words),
cuts AS (SELECT word, place, left(word, place::INT) || substr(word, place::INT + 2) AS rest FROM places),
near AS (
  SELECT DISTINCT a.word, b.word AS near FROM cuts AS a JOIN cuts AS b ON a.place = b.place AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT c.word, w.word FROM cuts AS c JOIN words AS w ON c.rest = w.word
  UNION SELECT w.word, c.word FROM cuts AS c JOIN words AS w ON c.rest = w.word),
ranked AS (
  SELECT near.word, near.near, v.n, count(*) OVER (PARTITION BY near.word) AS n_near,
    row_number() OVER (PARTITION BY near.word ORDER BY v.n DESC, near.near) AS place
  FROM near JOIN words AS v ON near.near = v.word),
linked AS (
  SELECT w.word, w.n, coalesce(r.n_near, 0) AS n_near, CASE WHEN r.n >= 10 * w.n THEN r.near END AS form,
    CASE WHEN r.n >= 10 * w.n THEN r.n END AS form_n
  FROM words AS w LEFT JOIN ranked AS r ON w.word = r.word AND r.place = 1),
followed AS (
  SELECT word, form, 0 AS step FROM linked WHERE form IS NOT NULL
  UNION ALL
  SELECT f.word, l.form, step + 1 FROM followed AS f JOIN linked AS l ON f.form = l.word WHERE l.form IS NOT NULL),
ends AS (SELECT word, max_by(form, step) AS root FROM followed GROUP BY word)
SELECT word, form, coalesce(root, word) AS root, n, n_near, form_n FROM linked LEFT JOIN ends USING (word)
"""
