"""Fingerprints, spelling variants and the manifest against brute-force versions, and the text queries against their SQL."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import pytest

from compare import canonical
from conftest import SF
from tidewell.llm import merkle_manifest, scaled_sketch, spelling_variants
from tidewell.llm.queries import ORACLE, QUERIES

SCHEMA = "doc_id bigint, source string, lang string, n_chars bigint, text string, n bigint, key string, tree int, _at int, h int, range int"
CLASHING = (1, "k", 2, 3, 4, 5)

# Nulls in every column, empty, blank and long texts, ties, repeated rows, odd characters.
ROWS = [
    (7, "s", "en", 3, "abc"), (7, "s", "en", 3, "abc"), (7, "t", "en", 3, "abd"), (3, "s", "en", None, ""), (None, "s", "en", 1, "x"),
    (None, None, None, None, None), (1, "s", None, 5, "a b c d e f g"), (2, "", "", 0, " \n\t "), (9, "s", "de", 7, "grün ß 語 \U0001f600"),
    (12, "s", "en", 11, "word " * 4000), (13, "s", "en", 11, "word " * 4001), (-5, "s", "zz", -1, "a-b"), (40, "s", "en", 2, "one two three four five six seven"),
] + [(100 + i, "src", "en" if i % 3 else "fr", i, f"text number {i} of many " * (i % 4)) for i in range(30)]


@pytest.fixture(scope="session")
def rows(spark):
    return spark.createDataFrame([row + CLASHING for row in ROWS], SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def none(rows):
    return rows.limit(0)


def sorted_rows(df):
    return sorted((tuple(row) for row in df.collect()), key=repr)


# --- manifest -----------------------------------------------------------------------------------


def H(*texts):
    return hashlib.sha256("".join(texts).encode()).hexdigest()


def leaf_of(row, more=0):
    doc_id, source, lang, n_chars, text = row
    n_chars = None if n_chars is None else n_chars + more
    return H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)])


def levels_of(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([H(*levels[-1][at : at + 2]) for at in range(0, len(levels[-1]), 2)])
    return levels


def path_of(levels, place):
    path = []
    for nodes in levels[:-1]:
        first, slot = place // 2 * 2, place % 2
        run = nodes[first : first + 2]
        path.append((run[:slot], run[slot + 1 :]))
        place //= 2
    return path


def manifest_of(rows):
    by_lang = defaultdict(list)
    for row in rows:
        by_lang[row[2]].append(row)
    langs = sorted(by_lang, key=lambda lang: (lang is not None, (lang or "").encode()))
    trees = {}
    for lang in langs:
        by_lang[lang].sort(key=lambda row: (row[0] is not None, row[0] or 0, leaf_of(row)))
        trees[lang] = levels_of([leaf_of(row) for row in by_lang[lang]])
    top, out = levels_of([trees[lang][-1][0] for lang in langs]), []
    for number, lang in enumerate(langs):
        for place, row in enumerate(by_lang[lang]):
            path = path_of(trees[lang], place) + path_of(top, number)
            hit = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 7 == 0
            digest = leaf_of(row, int(hit))
            for left, right in path:
                digest = H(*left, digest, *right)
            proof = H(*[text for left, right in path for text in left + right])
            out.append((row[0], leaf_of(row), trees[lang][-1][0], top[-1][0], proof, digest, digest == top[-1][0]))
    return sorted(out, key=repr)


@pytest.mark.parametrize("levels", [1, 2, 8])
def test_manifest(rows, none, levels):
    """With one or two levels to a block the trees are many blocks deep and wide."""
    found = sorted_rows(merkle_manifest.manifest(rows, levels))
    assert found == manifest_of(ROWS)
    assert any(not row[-1] for row in found) and any(row[-1] for row in found)
    assert merkle_manifest.manifest(none, levels).count() == 0


def test_folding_resumes_kept_states():
    nodes = [H(str(n)).encode() for n in range(11)]
    tree = merkle_manifest.Tree(nodes, len(nodes), 8)
    assert tree.root.decode() == levels_of([node.decode() for node in nodes])[-1][0]
    for place, node in enumerate(nodes):
        assert tree.fold(place, node) == tree.root
        other = nodes[:place] + [b"other"] + nodes[place + 1 :]
        assert tree.fold(place, b"other") == merkle_manifest.Tree(other, len(other), 8).root
        above = merkle_manifest.Above(merkle_manifest._text(tree.siblings(place)))
        assert above.fold(b"other") == tree.fold(place, b"other")


def test_manifest_of_one_document(spark):
    row = (5, "s", "en", 1, "t")
    one = spark.createDataFrame([row + CLASHING], SCHEMA)
    assert sorted_rows(merkle_manifest.manifest(one)) == manifest_of([row])


# --- fingerprints -------------------------------------------------------------------------------


def shingles_of(text):
    words = re.findall(r"[^ \t-\r]+", text)
    return {tuple(words[at : at + 5]) for at in range(max(1, len(words) - 4))} if words else set()


def test_fingerprints_of_edited_texts(rows, none):
    ordered = sorted({(row[0] is None, -(row[0] or 0), row[4] or "") for row in ROWS})
    assert len(ordered) == len({row[0] for row in ROWS}) + 1 + 1  # one id has two texts, and so has the null id
    found = defaultdict(set)
    for row in scaled_sketch.edited(rows).collect():
        found[row.doc_id, row.fingerprint].add(tuple(row)[1:])
    assert scaled_sketch.edited(rows).count() == len(ROWS)
    following = defaultdict(set)  # every text that may come next: ids descend, equal ids are ordered by a hash
    ids = sorted({row[0] for row in ROWS}, key=lambda i: (i is None, -(i or 0)))
    texts = defaultdict(list)
    for row in ROWS:
        texts[row[0]].append(row[4] or "")
    for place, doc_id in enumerate(ids):
        for text in texts[doc_id]:
            own = texts[doc_id] if len(texts[doc_id]) > 1 else []
            following[doc_id, text] = set(own) | set(texts[ids[(place + 1) % len(ids)]])
    for (doc_id, text), nexts in following.items():
        sketch, half, allowed = scaled_sketch.sketch(text), len(text) // 2, set()
        for other in nexts:
            changed = text[: len(text) - half] + other[:half]
            edited, sketch_of_other = scaled_sketch.sketch(changed), scaled_sketch.sketch(other)
            allowed.add((
                len(text), hashlib.sha256(changed.encode()).hexdigest(), scaled_sketch.written(sketch), scaled_sketch.written(edited),
                scaled_sketch.containment(sketch, edited), scaled_sketch.containment(sketch, sketch_of_other),
            ))
        mine = {row for row in found[doc_id, scaled_sketch.written(sketch)] if row[0] == len(text)}
        assert mine and mine <= allowed
    assert scaled_sketch.edited(none).count() == 0


def test_one_document_is_its_own_next(spark):
    one = spark.createDataFrame([(5, "a b c d e f g h")], "doc_id bigint, text string")
    row = scaled_sketch.edited(one).first()
    assert row.edited_sha256 == H("a b c d a b c d") and row.near_next == 1.0


def test_sketches_merge_and_estimate_containment(monkeypatch):
    long = " ".join(f"w{n * n % 9973}" for n in range(20_000))
    part = " ".join(long.split()[5_000:6_000])
    a, b = scaled_sketch.sketch(long), scaled_sketch.sketch(part)
    assert scaled_sketch.containment(a, b) == 1.0 == scaled_sketch.containment(b, a)
    other = " ".join(f"v{n}" for n in range(3_000))
    half = scaled_sketch.sketch(part + " " + other)
    truth = len(shingles_of(part + " " + other) & shingles_of(long)) / len(shingles_of(part + " " + other))
    assert abs(len(set(half) & set(a)) / len(half) - truth) < 0.05
    united = {int(h) for h in scaled_sketch.merged(a, half)}
    assert united == {int(h) for h in a} | {int(h) for h in half}
    assert list(scaled_sketch.read(scaled_sketch.written(a))) == list(a)
    for text in ("", " ", "one", "a b c d", "a b c d e", "x y z x y z x y z"):
        assert len(scaled_sketch.sketch(text)) >= bool(text.strip())
    monkeypatch.setattr(scaled_sketch, "CHUNK", 7)  # shingles across chunk borders are not lost
    assert list(scaled_sketch.sketch(part)) == list(b)


# --- spelling variants --------------------------------------------------------------------------

WORDS = "interest interests intrest interestt Interest interesting receive recieve receives RECEIVE Ärger ärgerlich Ärgerlich naïveté naiveté aaaaaaa aaaaaaaa aaaaaaaaa"
VARIANTS = [
    (1, f"{WORDS} " * 2), (2, None), (3, ""), (4, "short words only"), (None, "interest " * 300), (None, "interest, receive; ärgerlich×2 " * 40),
    (5, "intereste " * 25 + "inter×est interäst " * 3), (5, "intereste " * 25), (6, "a" * 3000), (7, "a" * 3000), (8, "b" + "a" * 2999 + " " + "a" * 2999),
    (9, "b" + "a" * 2999 + " " + "a" * 2999), *((100 + n, f"{WORDS} receive interest " * 3) for n in range(60)),
    *((500 + n, f"pattern{chr(97 + a)}ed pattern{chr(97 + b)}ed ") for n, (a, b) in enumerate((a, b) for a in range(26) for b in range(0, 26, 5))),
]


def variants_of(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 31 == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += 1
    words = {word: n for word, n in counts.items() if len(word) >= 7 and n >= 2}

    def near(a, b):
        if abs(len(a) - len(b)) > 1 or a == b:
            return False
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        a, b = sorted((a, b), key=len)
        return any(b[:k] + b[k + 1 :] == a for k in range(len(b)))

    nears = {a: [b for b in words if near(a, b)] for a in words}
    forms = {}
    for word, found in nears.items():
        best = min(found, key=lambda b: (-words[b], b), default=None)
        if best is not None and words[best] >= 10 * words[word]:
            forms[word] = best
    out = []
    for word, n in words.items():
        root = word
        while root in forms:
            root = forms[root]
        form = forms.get(word)
        out.append((word, form, root, n, len(nears[word]), words[form] if form else None))
    return sorted(out, key=repr)


@pytest.mark.parametrize("group", [3, 512])
def test_variants(spark, monkeypatch, group):
    """With three words to a group windows are halved down to single places."""
    monkeypatch.setattr(spelling_variants, "GROUP", group)
    docs = spark.createDataFrame([row + CLASHING for row in VARIANTS], "doc_id bigint, text string, word int, n string, m int, key int, lo int, hi int")
    found = sorted_rows(spelling_variants.variant_groups(spelling_variants.misspelt_words(docs)))
    assert found == variants_of(VARIANTS)
    assert sum(row[1] is not None for row in found) > 5
    assert spelling_variants.variant_groups(spelling_variants.misspelt_words(docs.limit(0))).count() == 0


def test_forms_are_followed_to_the_last(spark):
    chain = spark.createDataFrame([(f"w{n}", f"w{n + 1}") for n in range(9)], "word string, form string")
    assert sorted_rows(spelling_variants.roots(chain)) == [(f"w{n}", "w9") for n in range(9)]


def test_blocks_report_each_edit_once():
    rows = [(word, n, 0, 8, 1) for n, word in enumerate(["abcdefg", "abcdefgh", "abxdefgh", "abcdefgx", "zbcdefgh", "bcdefgh"])]
    block = spelling_variants.Block(8, rows)
    pairs = Counter((a, b) for a, b, _ in spelling_variants.compared(block, block))
    assert set(pairs.values()) == {1}
    assert ("abcdefg", "abcdefgh") in pairs and ("bcdefgh", "abcdefgh") in pairs and ("abcdefg", "bcdefgh") not in pairs


# --- SQL ----------------------------------------------------------------------------------------


@pytest.mark.parametrize("name", list(ORACLE))
def test_text_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for table in ("documents", "labels"):
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    found = con.execute(ORACLE[name])
    expected = canonical([column[0] for column in found.description], found.fetchall())
    df = QUERIES[name](spark, SF)
    assert canonical(df.columns, [tuple(row) for row in df.collect()]) == expected
