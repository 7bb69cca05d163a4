"""Quality rules in built-in functions: counts of words, symbols and repetition, and a likelihood ratio of hashed n-grams.

Word and word-pair hashes fall into BUCKETS buckets. Two multinomials over the buckets, of all documents and of a trusted
target (all documents labelled good), give a logarithm of their ratio per bucket. The target is counted in two halves by a
hash of the id, and every document, trusted or not, is scored by the half that it is not in, so none is judged by
its own words. A half is smoothed towards the corpus by as many n-grams as it has different buckets (Witten and Bell), so
the smoothing fits any size. A document's mean of the logarithms decides: the threshold is the mean that all but
LOST_PERCENT in a hundred of the trusted documents reach, which pass the base rules and were scored in the same way.
Logarithms and means are rounded to integers, so the verdict is the same whatever order sums run in.

The bucket array of a document is computed once and staged beside its counts; the passes after it read that table. Only
bucket counts (combined per task) and a histogram of means are shuffled, both of bounded size. ``_let`` binds an
intermediate array to a name, as an array used twice in nested functions would else be computed again for each element.

A null or empty text has zeros and fails by its length. Without labels there is no target, the ratio is zero
everywhere and the base rules decide alone. Repeated rows are each judged; null ids are never trusted.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, functions as F

from tidewell.llm.common import staged, unstage

BUCKETS = 1 << 16
UNIT = 1_000_000
STEP = 1_000  # millionths of a mean per step of the histogram
LOST_PERCENT = 2  # trusted documents that the threshold may lose
BROADCAST = 500_000  # ids that may be broadcast
WINDOW = 8
LEAST_WORDS = 20
REPEATED_PERCENT = 30
BLANKS = "\t\n\x0b\x0c\r "
SYMBOLS = "#*$%&|<>"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _next(values: Column, step: int, join: Callable[[Column, Column], Column]) -> Column:
    """``join`` of each element and the one ``step`` further on."""
    count = F.greatest(F.size(values) - step, F.lit(0))
    return F.zip_with(F.slice(values, F.lit(1), count), F.slice(values, F.lit(step + 1), count), join)


def words(text: Column) -> Column:
    return F.filter(F.split(F.coalesce(text, F.lit("")), "[\\x20\\x09-\\x0D]+"), lambda word: word != "")


def repeated_words(words_: Column, window: int = WINDOW) -> Column:
    """Words covered by windows that occur twice or more in the array of words; ``window`` is a power of two."""
    hashes = F.transform(words_, lambda word: F.xxhash64(word))
    def doubled(step: int) -> Callable[[Column], Column]:
        return lambda h: _next(h, step, lambda a, b: F.xxhash64(a, b))

    step = 1
    while step < window:
        hashes = _let(hashes, doubled(step))
        step *= 2

    def covered(places: Column) -> Column:
        zero = F.struct(F.lit(0).alias("stop"), F.lit(0).alias("total"))

        def add(so_far: Column, place: Column) -> Column:
            stop = place + window
            return F.struct(stop.alias("stop"), (so_far.total + stop - F.greatest(so_far.stop, place)).alias("total"))

        return F.aggregate(places, zero, add, lambda last: last.total)

    def repeats(h: Column) -> Column:
        ordered = F.sort_array(F.transform(h, lambda value, place: F.struct(value.alias("h"), place.alias("p"))))
        pairs = _let(ordered, lambda o: _next(o, 1, lambda a, b: F.when(a.h == b.h, F.array(a.p, b.p))))
        places = F.flatten(F.filter(pairs, lambda pair: pair.isNotNull()))
        return F.when(F.size(F.array_distinct(h)) == F.size(h), 0).otherwise(covered(F.sort_array(F.array_distinct(places))))

    return _let(hashes, repeats).cast("bigint")


def buckets(words_: Column) -> Column:
    """Bucket of every word and of every pair of words that follow each other."""
    hashes = F.transform(words_, lambda word: F.conv(F.substring(F.md5(word.cast("binary")), 1, 8), 16, 10).cast("bigint"))
    return _let(
        hashes,
        lambda h: F.concat(
            F.transform(h, lambda a: (a % BUCKETS).cast("int")), _next(h, 1, lambda a, b: ((a * 31 + b + 7) % BUCKETS).cast("int"))
        ),
    )


def half(doc_id: Column) -> Column:
    """0 or 1 by the first hex digit of the id's MD5; a null id counts as the empty text."""
    digit = F.substring(F.md5(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), 1, 1)
    return F.when(digit < "8", 0).otherwise(1)


def counted(docs: DataFrame) -> DataFrame:
    """(doc_id, half, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, grams) of every document."""
    text = F.coalesce("text", F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda line: line.rlike("[^\\x20\\x09-\\x0D]"))

    def of_words(found: Column) -> Column:
        return F.struct(
            F.size(found).cast("bigint").alias("n_words"),
            repeated_words(found).alias("n_repeat_words"),
            buckets(found).alias("grams"),
        )

    found = docs.select(
        "doc_id",
        _let(words(text), of_words).alias("w"),
        F.length(F.translate(text, BLANKS, "")).cast("bigint").alias("word_chars"),
        (F.length(text) - F.length(F.translate(text, SYMBOLS, ""))).cast("bigint").alias("n_symbols"),
        _let(lines, lambda found: F.size(found) - F.size(F.array_distinct(found))).cast("bigint").alias("n_dup_lines"),
    ).select("doc_id", half(F.col("doc_id")).alias("half"), "w.n_words", "word_chars", "n_symbols", "n_dup_lines", "w.n_repeat_words", "w.grams")
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > REPEATED_PERCENT * F.col("n_words"))
    return found.withColumn("base_failed", failed)


def marked(rows: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows with ``trusted`` (1 or null): labelled good."""
    good = labels.where((F.col("quality") == 1) & F.col("doc_id").isNotNull()).select("doc_id").distinct()
    ids = staged(good.withColumn("trusted", F.lit(1)))
    return rows.join(F.broadcast(ids) if ids.count() <= BROADCAST else ids, "doc_id", "left")


def log_ratios(rows: DataFrame) -> list[int]:
    """Per half and bucket the logarithm, in millionths, of the other half's target share over the corpus' share."""
    grams = rows.select((F.col("trusted") * F.col("half")).alias("half"), F.explode("grams").alias("bucket"))
    targets = [F.count_if(F.col("half") == number).alias(f"target_{number}") for number in (0, 1)]
    counts = grams.groupBy("bucket").agg(F.count("*").alias("raw"), *targets).collect()
    raw, out = sum(row.raw for row in counts), [0] * (2 * BUCKETS)
    for number in (0, 1):
        target = sum(row[f"target_{1 - number}"] for row in counts)
        different = sum(row[f"target_{1 - number}"] > 0 for row in counts)
        for row in counts if target else ():
            smoothed = (row[f"target_{1 - number}"] + different * row.raw / raw) / (target + different)
            out[number * BUCKETS + row.bucket] = math.floor(UNIT * math.log(smoothed / (row.raw / raw)) + 0.5)
    return out


def threshold(scored: DataFrame) -> int | None:
    """The greatest step that at most ``LOST_PERCENT`` in a hundred trusted documents fall short of; None without any."""
    steps = scored.where("trusted = 1 AND NOT base_failed").groupBy("step").count().orderBy("step").collect()
    total, below, found = sum(row["count"] for row in steps), 0, None
    for row in steps:
        if 100 * below <= LOST_PERCENT * total:
            found = row.step
        below += row["count"]
    return found


def judged(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, log_ratio, base_failed, kept) of every document."""
    found = staged(counted(docs.select("doc_id", "text")))
    rows = marked(found, labels.select("doc_id", "quality"))
    ratios = F.split(F.lit(",".join(map(str, log_ratios(rows)))), ",").cast("array<int>")
    first = F.col("half") * BUCKETS
    total = _let(first, lambda at: F.aggregate("grams", F.lit(0).cast("bigint"), lambda so_far, bucket: so_far + F.get(ratios, at + bucket)))
    step = F.floor(F.col("log_ratio") / ((2 * F.col("n_words") - 1) * STEP)).alias("step")
    scored = staged(rows.withColumn("log_ratio", total).drop("grams").select("*", step))
    unstage(found)
    least = threshold(scored)
    likely = F.lit(True) if least is None else F.col("step") >= least
    return scored.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "log_ratio", "base_failed",
        (~F.col("base_failed") & likely).alias("kept"),
    )


ORACLE = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t,
    list_filter(string_split_regex(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda w: w <> '') AS ws
  FROM documents),
w AS (SELECT r, doc_id, unnest(ws) AS w, generate_subscripts(ws, 1) AS p FROM d),
h AS (SELECT r, doc_id, p, w, ('0x' || md5(w)[1:8])::BIGINT AS h FROM w),
n AS (SELECT r, doc_id, h, lead(h) OVER (PARTITION BY r ORDER BY p) AS g FROM h),
grams AS (
  SELECT r, doc_id, h % {BUCKETS} AS b FROM n
  UNION ALL SELECT r, doc_id, (h * 31 + g + 7) % {BUCKETS} FROM n WHERE g IS NOT NULL),
trusted AS (SELECT DISTINCT doc_id FROM labels WHERE quality = 1 AND doc_id IS NOT NULL),
sides AS (
  SELECT r, CASE WHEN md5(coalesce(CAST(doc_id AS VARCHAR), ''))[1:1] < '8' THEN 0 ELSE 1 END AS half,
    doc_id IN (SELECT doc_id FROM trusted) AS good FROM d),
c AS (
  SELECT b, count(*) AS n, count(*) FILTER (good AND half = 0) AS t0, count(*) FILTER (good AND half = 1) AS t1
  FROM grams JOIN sides USING (r) GROUP BY b),
s AS (
  SELECT sum(n) AS raw, sum(t0) AS target0, sum(t1) AS target1, count(*) FILTER (t0 > 0) AS different0,
    count(*) FILTER (t1 > 0) AS different1 FROM c),
other AS (
  SELECT b, 0 AS half, n, raw, t1 AS t, target1 AS target, different1 AS different FROM c, s
  UNION ALL SELECT b, 1, n, raw, t0, target0, different0 FROM c, s),
ratio AS (
  SELECT b, half, CASE WHEN target > 0 THEN CAST(floor({UNIT} * ln(
    ((t + different::DOUBLE * n / raw) / (target + different)) / (n::DOUBLE / raw)) + 0.5) AS BIGINT) ELSE 0 END AS v
  FROM other),
score AS (
  SELECT r, CAST(sum(v) AS BIGINT) AS v FROM grams JOIN sides USING (r) JOIN ratio USING (b, half) GROUP BY r),
win AS (
  SELECT r, p, list(w) OVER (PARTITION BY r ORDER BY p ROWS BETWEEN CURRENT ROW AND {WINDOW - 1} FOLLOWING) AS k FROM w),
rep AS (SELECT r, p FROM (SELECT r, p, count(*) OVER (PARTITION BY r, k) AS c FROM win WHERE len(k) = {WINDOW}) WHERE c > 1),
cov AS (
  SELECT r, sum(least({WINDOW}, coalesce(nx - p, {WINDOW}))) AS n
  FROM (SELECT r, p, lead(p) OVER (PARTITION BY r ORDER BY p) AS nx FROM rep) GROUP BY r),
ln AS (
  SELECT r, count(*) - count(DISTINCT l) AS n FROM (SELECT r, unnest(string_split(t, chr(10))) AS l FROM d)
  WHERE regexp_matches(l, '[^\\x20\\x09-\\x0D]') GROUP BY r),
f AS (
  SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words,
    CAST(length(translate(t, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13), '')) AS BIGINT) AS word_chars,
    CAST(length(t) - length(translate(t, '{SYMBOLS}', '')) AS BIGINT) AS n_symbols,
    CAST(coalesce(ln.n, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(cov.n, 0) AS BIGINT) AS n_repeat_words,
    CAST(coalesce(score.v, 0) AS BIGINT) AS log_ratio, good,
    len(ws) < {LEAST_WORDS} OR 100 * coalesce(cov.n, 0) > {REPEATED_PERCENT} * len(ws) AS base_failed,
    CAST(floor(coalesce(score.v, 0)::DOUBLE / ((2 * len(ws) - 1) * {STEP})) AS BIGINT) AS step
  FROM d JOIN sides USING (r) LEFT JOIN ln USING (r) LEFT JOIN cov USING (r) LEFT JOIN score USING (r)),
steps AS (SELECT step, count(*) AS c FROM f WHERE good AND NOT base_failed GROUP BY step),
least AS (
  SELECT max(step) AS least FROM (
    SELECT step, sum(c) OVER (ORDER BY step) - c AS below, sum(c) OVER () AS total FROM steps)
  WHERE 100 * below <= {LOST_PERCENT} * total)
SELECT * EXCLUDE (good, step, least), NOT base_failed AND step >= coalesce(least, step) AS kept FROM f, least
"""
