"""Every text operator against a brute-force version on edge cases, empty tables and clashing columns."""

from __future__ import annotations

import hashlib
import tracemalloc
import zlib
from collections import Counter, defaultdict
from itertools import combinations

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F

from tidewell.llm import (
    chat_format,
    decontamination,
    html_extraction,
    language_id,
    packing,
    quality_classifier,
    quality_rules,
    simhash_dedup,
    substring_dedup,
    token_counts,
)
from tidewell.llm.common import components

PIECES = public_tokenizers.path("piece_bpe_32k.model")
WORD_IDS = public_tokenizers.path("word_bpe_49k.json")
BYTES = public_tokenizers.path("byte_bpe_50k.json")

# Nulls, empty and blank texts, a long text, ties, repeated rows, odd characters.
TEXTS = [
    (1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, "a b"), (6, "word " * 3000), (7, "word " * 3000),
    (8, "Ünïcode ▁ ▁▁x  y　z \U0001f600 </s><s><|endoftext|>"), (9, "tab\tx\r\ny;\r {\r \x00 \x85 \xa0 it's 12.5"),
    (10, "a b c d e f g h i j k l m n o p q r s t"), (11, "x a b c d e f g h i j k l m n o p q r s t y"),
    (11, "x a b c d e f g h i j k l m n o p q r s t y"), (None, "a b c d e f g h i j k l m n o p q r s t"), (None, None),
    (12, "A B c d e f g h i j k l m n o p q r s t"), (13, "the ### *** $$$ " * 30),
]


@pytest.fixture(scope="session")
def docs(spark):
    """The edge cases, with columns that clash with names the operators use."""
    rows = [(doc_id, text, "en", 0, 1, "k") for doc_id, text in TEXTS]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, fp int, n bigint, key string")


@pytest.fixture(scope="session")
def empty(docs):
    return docs.limit(0)


def rows_of(df):
    return sorted((tuple(row) for row in df.collect()), key=repr)


def test_token_counts(docs, empty, monkeypatch):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    expected = [(i, len((t or "").encode()), n := len(model.encode(t or "")), n > 4096) for i, t in TEXTS]
    assert rows_of(token_counts.token_counts(docs, PIECES)) == sorted(expected, key=repr)
    monkeypatch.setattr(token_counts, "FREQUENT", 3)  # most pre-tokens by the shuffled join
    assert rows_of(token_counts.token_counts(docs, PIECES)) == sorted(expected, key=repr)
    assert token_counts.token_counts(empty, PIECES).count() == 0


def test_packing(docs, empty):
    from tokenizers import Tokenizer

    model = Tokenizer.from_file(WORD_IDS)
    pieces = packing.pack(docs.where("doc_id <> 11"), WORD_IDS).collect()
    found, sequences = defaultdict(list), defaultdict(list)
    for row in pieces:
        found[row.doc_id].append(row)
        sequences[row.sequence_id].append((row.offset, row.length))
    texts = {i: t for i, t in TEXTS if i not in (None, 11)}
    assert set(found) == set(texts)
    for doc_id, parts in found.items():
        ids, at = model.encode(texts[doc_id] or "", add_special_tokens=False).ids + [2], 0
        for row in sorted(parts, key=lambda row: row.start):
            raw = np.array(ids[row.start : row.start + row.length], "<u4").tobytes()
            assert row.start == at and row.ids_crc32 == zlib.crc32(raw) and row.doc_tokens == len(ids)
            at += row.length
        assert at == len(ids)
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= 4096 and at & (at - 1) == 0  # every window is full
    assert packing.pack(docs, WORD_IDS).groupBy().sum("length").first()[0] > 0
    assert packing.pack(empty, WORD_IDS).count() == 0


def test_simhash_groups(docs, empty):
    prints = {(i, t): simhash_dedup.simhash(t) & (2**64 - 1) for i, t in TEXTS}
    root = {fp: fp for fp in prints.values()}
    for _ in range(len(root)):
        for a, b in combinations(root, 2):
            if (a ^ b).bit_count() <= 2:
                root[a] = root[b] = min(root[a], root[b])
    least = {}
    for (i, t), fp in prints.items():
        if i is not None:
            least[root[fp]] = min(i, least.get(root[fp], i))
    expected = [(i, f"{prints[i, t]:016x}", least.get(root[prints[i, t]])) for i, t in TEXTS]
    assert rows_of(simhash_dedup.near_duplicate_groups(docs)) == sorted(expected, key=repr)
    assert simhash_dedup.near_duplicate_groups(empty).count() == 0
    kept = simhash_dedup.keep_one(docs)
    assert kept.columns == docs.columns
    ids = [row.doc_id for row in kept.collect() if row.doc_id is not None]
    assert sorted(ids) == sorted({group for _, _, group in expected if group is not None})


def simhash_kept(rows):
    """The rows that stay: of each group linked by two bits the one of smallest id (ties: text hash), and all without an id."""
    import itertools

    prints = [simhash_dedup.simhash(row[1]) & (2**64 - 1) for row in rows]
    root = {fp: fp for fp in prints}
    changed = True
    while changed:
        changed = False
        for a, b in itertools.combinations(root, 2):
            if (a ^ b).bit_count() <= 2 and root[a] != root[b]:
                root[a] = root[b] = min(root[a], root[b])
                changed = True
    groups = defaultdict(list)
    for row, fp in zip(rows, prints):
        if row[0] is not None:
            groups[root[fp]].append(row)
    ids = {group: min(row[0] for row in members) for group, members in groups.items()}
    return [{row for row in members if row[0] == ids[group]} for group, members in groups.items()]


def test_near_dedup_keeps_one_of_each_group(spark, docs, empty):
    draw = np.random.default_rng(3)
    texts = []
    for group in range(60):
        words = [f"v{n}" for n in draw.integers(0, 500, draw.integers(40, 400))]
        for copy in range(draw.integers(1, 9)):  # exact copies, and edits of the one before
            texts.append((int(draw.integers(0, 20_000)) + 20_000 * group, " ".join(words)))
            if copy % 2:
                words = [*words]
                words[draw.integers(0, len(words))] = f"e{draw.integers(0, 10**6)}"
    texts += [(7, "one id with this text of some words"), (7, "one id with a quite different text here"), (8, ""), (9, None), (9, None)]
    rows = spark.createDataFrame([(*row, "n", "r", 0) for row in texts], "doc_id bigint, text string, name string, row string, times int")
    kept = simhash_dedup.keep_one(rows)
    assert kept.columns == rows.columns
    found, expected = Counter((row.doc_id, row.text) for row in kept.collect()), simhash_kept(texts)
    assert sum(found.values()) == len(expected) and len(expected) < len(texts) - 60
    for members in expected:
        assert sum(found[row] for row in members) == 1
    assert sum(row.doc_id is None for row in simhash_dedup.keep_one(docs).collect()) == sum(i is None for i, _ in TEXTS)
    assert simhash_dedup.keep_one(empty).count() == 0


def test_golay_keys_meet_within_two_bits():
    draw = np.random.default_rng(5)
    prints = draw.integers(-(2**63), 2**63 - 1, 200)
    for count in (0, 1, 2):
        other = prints.copy()
        for place in range(len(other)):
            for bit in draw.choice(64, count, replace=False):
                other[place] ^= np.int64(np.uint64(1) << np.uint64(bit))
        asked, _ = simhash_dedup.keys(prints)
        _, filed = simhash_dedup.keys(other)
        assert all(set(a) & set(f) for a, f in zip(asked.tolist(), filed.tolist()))


def test_golay_tables_are_small_to_make():
    tracemalloc.start()
    upper, errors = simhash_dedup.golay_tables()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 4 << 20  # from all 2^23 words it was 268 MB, in every Python worker

    def remainder(word):
        while word.bit_length() > 11:
            word ^= simhash_dedup.GENERATOR << (word.bit_length() - 12)
        return word

    assert upper.tolist() == [remainder(head << 11) for head in range(1 << 12)]
    assert all(remainder(error) == place and error.bit_count() <= 3 for place, error in enumerate(errors.tolist()))


def test_components(spark):
    edges = [(i, i + 1) for i in range(0, 40)] + [(100, 99), (100, 98), (200, 200)]
    found = {row.node: row.root for row in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert found == {**{i: 0 for i in range(41)}, 98: 98, 99: 98, 100: 98}


def test_substring_dedup(docs, empty):
    first = {}
    for i, t in TEXTS:
        words = (t or "").encode().split()
        for at in range(len(words) - 12) if i is not None else ():
            window = tuple(words[at : at + 13])
            first[window] = min(i, first.get(window, i))
    expected = []
    for i, t in TEXTS:
        words = (t or "").encode().split()
        gone = set()
        for at in range(len(words) - 12) if i is not None else ():
            if first[tuple(words[at : at + 13])] < i:
                gone.update(range(at, at + 13))
        kept = b" ".join(word for at, word in enumerate(words) if at not in gone)
        expected.append((i, len(words), len(gone), hashlib.sha256(kept).hexdigest()))
    assert rows_of(substring_dedup.substring_digest(docs)) == sorted(expected, key=repr)
    assert substring_dedup.substring_digest(empty).count() == 0


def test_decontamination(spark, docs, empty):
    item = " ".join(f"w{n}" for n in range(30))
    items = spark.createDataFrame([(1, item), (2, None), (3, ""), (None, "q r s T")], "item_id bigint, text string")
    texts = [(1, f"x y {item} z"), (2, item.upper()), (3, " ".join(f"w{n}" for n in range(28))), (4, "q r s t"),
             (5, " ".join(f"w{n}" for n in range(20))), (6, None), (6, ""), (None, item)]
    leaks = decontamination.leaked_passages(spark.createDataFrame(texts, "doc_id bigint, text string"), items)
    found = {(row.doc_id, row.item_id): (row.start, row.stop, row.similarity) for row in leaks.collect()}
    assert set(found) == {(1, 1), (2, 1), (3, 1), (4, None), (None, 1)}
    assert found[1, 1] == (2, 32, 1.0) and 0.8 <= found[3, 1][2] < 1
    spanish = "años después, el niño compró ñoquis y piñones en la estación del león"
    shouted = spark.createDataFrame([(1, f"x {spanish.upper()} y")], "doc_id bigint, text string")
    folded = decontamination.leaked_passages(shouted, spark.createDataFrame([(9, spanish)], "item_id bigint, text string"))
    assert [(row.start, row.stop, row.similarity) for row in folded.collect()] == [(1, 14, 1.0)]
    assert decontamination.leaked_passages(empty, items).count() == 0
    assert decontamination.leaked_passages(docs, items.limit(0)).count() == 0
    clean = decontamination.without_leaks(docs, items)
    assert clean.columns == docs.columns and clean.count() == 11  # five rows hold the four-word item


def test_quality_classifier(spark, docs, empty):
    good = [(n, f"a sentence of {n} calm words and then some more of them here") for n in range(100, 160)]
    poor = [(n, f"BUY ### NOW *** {n} " * 12) for n in range(200, 260)]
    texts = spark.createDataFrame(good + poor, "doc_id bigint, text string").union(docs.select("doc_id", "text"))
    labels = spark.createDataFrame([(n, int(n < 200)) for n, _ in good + poor] + [(1, None)], "doc_id bigint, quality int")
    rows = quality_classifier.quality_scores(texts, labels).collect()
    assert len(rows) == len(TEXTS) + 120 and all(0 <= row.score <= 1 for row in rows)
    held = [row for row in rows if row.held_out and row.doc_id and row.doc_id >= 100]
    assert held and all(row.predicted == int(row.doc_id < 200) for row in held)
    none = quality_classifier.quality_scores(docs, labels.limit(0)).collect()
    assert {row.score for row in none} == {0.5} and len(none) == len(TEXTS)
    assert quality_classifier.quality_scores(empty, labels).count() == 0
    assert quality_classifier.keep_good(docs, labels.limit(0)).columns == docs.columns


def test_pooled_is_the_isotonic_fit():
    assert quality_classifier.pooled(np.array([1.0, 0, 2, 1]), np.ones(4)).tolist() == [0.5, 0.5, 1.5, 1.5]


def test_quality_rules(spark, docs, empty):
    labels = spark.createDataFrame([(10, 1), (12, 1), (13, 0), (None, 1)], "doc_id bigint, quality int")
    found = quality_rules.judged(docs, labels).collect()
    assert len(found) == len(TEXTS)
    expected = []
    for i, t in TEXTS:
        words = [word.decode() for word in (t or "").encode().split()]
        windows = Counter(tuple(words[at : at + 8]) for at in range(len(words) - 7))
        covered = {at + k for at in range(len(words) - 7) if windows[tuple(words[at : at + 8])] > 1 for k in range(8)}
        lines = [line for line in (t or "").split("\n") if line.encode().split()]
        symbols = sum((t or "").count(c) for c in "#*$%&|<>")
        failed = len(words) < 20 or 100 * len(covered) > 30 * len(words)
        expected.append((i, len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(covered), failed))
    names = ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert sorted((tuple(row[name] for name in names) for row in found), key=repr) == sorted(expected, key=repr)
    assert all(row.kept for row in found if row.doc_id in (10, 12)) and not any(row.kept for row in found if row.base_failed)
    assert quality_rules.judged(empty, labels).count() == 0
    assert quality_rules.judged(docs, labels.limit(0)).where("kept = base_failed").count() == 0


def test_no_document_is_judged_by_its_own_words(spark):
    """A trusted document scores alike with and without its own label, so trusted and other good documents fare alike."""
    draw = np.random.default_rng(1)
    rows = [(n, " ".join(f"w{k}" for k in draw.zipf(1.4, 60) % 3000)) for n in range(300)] + [(300 + n, f"x{n} " * 3 + "# $ % " * 20) for n in range(30)]
    docs = spark.createDataFrame([(*row, 1, "t") for row in rows], "doc_id bigint, text string, trusted int, grams string")
    labels = [(n, 1) for n in range(200)]

    def judged(labels):
        return {row.doc_id: row for row in quality_rules.judged(docs, spark.createDataFrame(labels, "doc_id bigint, quality int")).collect()}

    whole = judged(labels)
    assert judged([label for label in labels if label[0] != 17])[17].log_ratio == whole[17].log_ratio
    shares = [sum(whole[n].kept for n in ids) / len(ids) for ids in (range(200), range(200, 300))]
    assert shares[0] >= 0.97 and abs(shares[0] - shares[1]) < 0.06
    assert not any(whole[n].kept for n in range(300, 330))


@pytest.mark.parametrize("size", ["sf0.001", "sf0.01", "sf0.1"])
def test_rules_keep_the_same_share_at_every_size(size):
    """By the query's SQL, which equals the query: good labels that pass the base rules, and unlabelled documents."""
    import duckdb

    con = duckdb.connect()
    for name in ("documents", "labels"):
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '/root/testdata/{size}/{name}.parquet'")
    shares = dict(con.execute(f"""
        SELECT coalesce(quality, 2), avg(kept::INT) FROM ({quality_rules.ORACLE}) LEFT JOIN labels USING (doc_id)
        WHERE NOT base_failed GROUP BY 1""").fetchall())  # fmt: skip
    assert shares[1] >= 0.97 and 0.88 <= shares[2] <= 0.96 and shares[0] <= 0.1


def test_language_id(spark, docs, empty):
    words = {"aa": "the of and that with ", "bb": "der und nicht über für ", "cc": "señor niño año qué más "}
    texts = [(n, words[lang] * (1 + n % 40), lang) for n, lang in zip(range(100, 400), list(words) * 100)]
    rows = spark.createDataFrame(texts, "doc_id bigint, text string, lang string")
    odd = docs.select("doc_id", "text").selectExpr("doc_id", "text", "cast(null as string) lang")
    found = language_id.languages(rows.union(odd)).collect()
    truth = {doc_id: lang for doc_id, _, lang in texts}
    known = [row for row in found if row.doc_id in truth]
    assert len(found) == 300 + len(TEXTS) and all(row.lang_pred == truth[row.doc_id] for row in known)
    assert {row.doc_id for row in found if row.lang_pred == "und"} == {1, 2, 3, None}
    assert {row.lang_pred for row in language_id.languages(odd).collect()} == {"und"}
    assert language_id.languages(rows.limit(0)).count() == 0


def test_html_extraction(spark):
    page = (
        "<html><head><title>T</title><style>p{}</style></head><body><nav><ul><li>Menu</li></ul></nav><header>H</header>"
        "<div class='cookie-notice'>C</div><article><h1>A &amp; b</h1><p>One\n two<br>three<p>Four &lt;x&gt; <b>bold</b>"
        "<script>var t='</p>';</script><form>F</form><aside>S</aside><section><p>Five</p></section>"
        "<div class='comments'><p>Reader</p></div></article><footer>&copy;</footer>"
    )
    plain = "<body><div class=menu>M</div><p>Only</p><table><tr><td>cell</td></tr></table>"
    rows = [(1, "http://a.org/1", page), (2, "https://A.org/2", page), (3, "b", plain), (4, None, None), (5, "http://c/", ""),
            (5, "http://c/", ""), (6, "http://a.org/3", "<article><p>Short")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    found = rows_of(html_extraction.main_texts(pages, html_extraction.wrappers(pages)).select("page_id", "text", "n_chars"))
    text = "A & b\n\nOne two three\n\nFour <x> bold\n\nFive"
    expected = [(1, text), (2, text), (3, "Only\n\ncell"), (4, ""), (5, ""), (5, ""), (6, "Short")]
    assert found == [(number, found_text, len(found_text)) for number, found_text in expected]
    assert html_extraction.wrappers(pages.limit(0)).count() == 0


def test_html_of_mixed_hosts_and_marked_bodies(spark):
    rows = [(1, "http://a.org/1", "<body><p>Out<article><p>New</article>"), (2, "http://a.org/2", "<body><div><p>Old</div><footer>F</footer>"),
            (3, "http://b.org/1", "<body class='no-sidebar comments-open'><p>Body</p><div class='sidebar'><p>S</div>"),
            (4, "http://b.org/2", "<body class='has-sidebar'><article class='related'><p>Art</p></article><p>Out")]
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string")
    found = rows_of(html_extraction.main_texts(pages, html_extraction.wrappers(pages)).select("page_id", "text"))
    assert found == [(1, "New"), (2, "Old"), (3, "Body"), (4, "Art")]


def test_expressions_align():
    one = html_extraction.structure(html_extraction.read("<article><p>a<p>b</article>"))
    two = html_extraction.structure(html_extraction.read("<article><h1>t</h1><p>a</article>"))
    assert html_extraction.written(html_extraction.aligned(one, two)) == "<article (#article/h1)? (#article/p)+ >article"
    groups = html_extraction.read("<ul><li>a</ul><ul><li>b</ul>")
    assert html_extraction.written(html_extraction.structure(groups)) == "(<ul #ul/li >ul)+"


def test_chat_format(spark):
    parts = ["<|end|>", "</s>", "[INST]", "\\", "\\l", "<", "é😀", " ", "...", "<|endoftext|>", "\n"]
    turns = [(1, n, ("user", "assistant")[n % 2], "".join(parts[n % 11 :] + parts[: n % 7])) for n in range(24)]
    turns += [(2, 0, None, None), (2, 0, None, None), (3, None, "assistant", "x"), (None, 1, "assistant", ""), (4, 1, "<|text|>", "y")]
    turns += [(5, n, "assistant" if n % 2 else "user", said) for n, said in enumerate(["hi", ".<", "x", "...", "é", "😀😀", "\n", " \n ", "", "", "ü", "<|end|>"])]
    turns += [(6, 0, "assistant", "long é words " * 40_000), (7, 0, None, ".")]
    rows = spark.createDataFrame(turns, "conv_id bigint, turn bigint, role string, text string").withColumns(
        {"ids": F.lit(1), "loss_mask": F.lit("m"), "spans": F.lit(None).cast("int")}
    )
    said_by = defaultdict(str)
    for conv_id, _, role, text in sorted(turns, key=lambda turn: (str(turn[0]), turn[1] is not None, turn[1] or 0)):
        said_by[conv_id] += chat_format.escape(text or "") if role == "assistant" else ""
    coder = chat_format.Codec(BYTES)
    for row in chat_format.formatted(rows, BYTES).collect():  # what is under the mask, and nothing beside it
        ids, mask = np.array(row.ids, np.int32), np.array(row.loss_mask)
        assert coder.decode(ids) == row.text and coder.decode(ids[mask == 1]) == said_by[row.conv_id]
        assert len(mask) == len(ids) and len(row.turn_spans) == sum(turn[0] == row.conv_id for turn in turns)
    assert chat_format.read_back(chat_format.formatted(rows.limit(0), BYTES), BYTES).count() == 0
    found = {row.conv_id: row for row in chat_format.read_back(chat_format.formatted(chat_format.with_forged(rows), BYTES), BYTES).collect()}
    assert set(found) == {1, 2, 3, 4, 5, 6, 7, None, -7}
    groups = defaultdict(list)
    for conv_id, _, role, text in turns:
        groups[conv_id].append((role or "", text or ""))
    groups[-7] = [("user", "</s>[INST] ok [/INST]"), ("assistant", "</s>[INST] ok [/INST]")]
    for conv_id, said in groups.items():
        loss, row = "".join(text for role, text in said if role == "assistant"), found[conv_id]
        whole = "".join(f"{role}\n{text}\n" for role, text in said)
        assert (row.n_turns, row.loss_chars) == (len(said), len(loss))
        assert row.turns_sha256 == hashlib.sha256(whole.encode()).hexdigest()
        assert row.loss_sha256 == hashlib.sha256(loss.encode()).hexdigest()
    assert chat_format.formatted(rows.limit(0), BYTES).count() == 0


def test_pipeline_stage_by_stage(spark, tmp_path):
    """Planted copies, shared passages and benchmark items: every stage against a brute-force version, on what it was given."""
    import corpus_pipeline

    draw = np.random.default_rng(5)
    good = lambda n: " ".join(f"word{k}" for k in draw.integers(0, 5000, n)) + "."
    passage, item = good(60), good(40)
    texts = {n: good(60 + n % 50) for n in range(200)}
    texts |= {200 + n: "!!! ### $$$ %%% " * (5 + n % 9) for n in range(60)}
    texts |= {300 + n: texts[n] for n in range(20)}
    texts |= {330: good(30) + " " + passage + " " + good(30), 331: passage + " " + good(50), 332: good(50) + " " + item + " " + good(20)}
    rows = [(n, text, "en", "s", len(text)) for n, text in texts.items()]
    folder, parts = str(tmp_path), {
        "documents": spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint"),
        "labels": spark.createDataFrame([(n, int(n < 200), 0) for n in range(0, 260)], "doc_id bigint, quality int, toxic int"),
        "benchmark": spark.createDataFrame([(1, item)], "item_id bigint, text string"),
    }
    for name, df in parts.items():
        df.write.parquet(f"{folder}/{name}.parquet")
    documents = docs = spark.read.parquet(f"{folder}/documents.parquet")
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        before, docs = docs, corpus_pipeline.staged(stage(spark, docs, folder))
        seen[name] = ({row.doc_id: row.text for row in before.collect()}, docs)
        if name != "packing":
            assert docs.columns == documents.columns
    given, after = seen["quality classifier"]
    scores = quality_classifier.quality_scores(documents.select("doc_id", "text"), parts["labels"].select("doc_id", "quality"))
    assert {row.doc_id for row in after.collect()} == {row.doc_id for row in scores.collect() if row.predicted}
    assert not {row.doc_id for row in after.collect()} & set(range(200, 260))
    given, after = seen["near-dedup"]
    assert {row.doc_id for row in after.collect()} == {min(row[0] for row in rows) for rows in simhash_kept(list(given.items()))}
    given, after = seen["substring dedup"]
    windows, cut = {}, {}
    for n in sorted(given):
        words, covered = given[n].split(), set()
        for at in range(len(words) - 12):
            key = tuple(words[at : at + 13])
            if windows.setdefault(key, n) < n:
                covered |= set(range(at, at + 13))
        cut[n] = " ".join(word for k, word in enumerate(words) if k not in covered)
    assert {row.doc_id: row.text for row in after.collect()} == cut and all(row.n_chars == len(row.text) for row in after.collect())
    assert passage not in cut[331] and passage in cut[330]
    given, after = seen["benchmark decontamination"]
    assert {row.doc_id: row.text for row in after.collect()} == {n: text for n, text in given.items() if item not in text}
    from tokenizers import Tokenizer

    model, pieces = Tokenizer.from_file(WORD_IDS), defaultdict(list)
    given, after = seen["packing"]
    for row in after.collect():
        pieces[row.doc_id].append(row)
    assert set(pieces) == set(given)
    for n, found in pieces.items():
        ids, at = model.encode(given[n], add_special_tokens=False).ids + [2], 0
        for row in sorted(found, key=lambda row: row.start):
            assert row.start == at and row.ids_crc32 == zlib.crc32(np.array(ids[at : at + row.length], "<u4").tobytes())
            at += row.length
        assert at == len(ids)


def test_pipeline_over_given_tables(spark):
    import corpus_pipeline

    assert corpus_pipeline.run(spark, "/root/testdata/sf0.001").count() > 0


def test_the_wrapper_decides_what_is_template(spark):
    """The same page parts count or not by what the other pages of the host hold."""
    page = "<body><div><div><p>Call us</div><section><p>{}<p>b</section></div>"
    rows = [(n, "http://a.org/", page.format(f"text {n}")) for n in range(6)]  # one place, one text: template
    rows += [(n + 10, "http://b.org/", page.format(f"text {n}")) for n in range(4)]  # too few pages
    rows += [(n + 20, "http://c.org/", page.format("same")) for n in range(6)]  # no block differs
    rows += [(n + 30, "http://d.org/", page.format(f"text {n}").replace("Call us", "Call us<p>now" * (n < 2) or "Call us")) for n in range(6)]
    rows += [(n + 40, "http://e.org/", page.format(f"text {n}").replace("Call us", str(n % 2))) for n in range(6)]  # it differs
    rows += [(n + 50, "http://f.org/", f"<article><div><p>Call us</div><p>text {n}<p>b</article>") for n in range(6)]  # the article's
    pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(3)
    found = dict(rows_of(html_extraction.main_texts(pages, html_extraction.wrappers(pages)).select("page_id", "text")))
    assert [found[n] for n in range(6)] == [f"text {n}\n\nb" for n in range(6)]
    assert [found[n + 10] for n in range(4)] == [f"Call us\n\ntext {n}\n\nb" for n in range(4)]
    assert {found[n + 20] for n in range(6)} == {"Call us\n\nsame\n\nb"}
    assert found[30] == "Call us\n\nnow\n\ntext 0\n\nb" and found[35] == "Call us\n\ntext 5\n\nb"
    assert [found[n + 40] for n in range(6)] == [f"{n % 2}\n\ntext {n}\n\nb" for n in range(6)]
    assert [found[n + 50] for n in range(6)] == [f"Call us\n\ntext {n}\n\nb" for n in range(6)]
