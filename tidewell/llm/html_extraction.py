"""Main text of web pages by wrappers: union-free regular expressions inferred per host.

A page is a stream of tokens: containers that open and close, and blocks, each a slot of text. Adjacent repetitions
become repeated groups. A host's streams are aligned one after another with the expression so far: what agrees stays, a block
that is repeated on either side becomes a repetition, what only one side has becomes optional. The result describes all
pages of the host. The wrapper decides what is template: a block that every page of the host has exactly once, at one place and with
the same text, while other blocks differ (``EVIDENCE`` pages at least), is no slot. Blocks under article or main are never template. Of
the slots those count that do not lie under a menu, header, footer, sidebar, notice, advert, form or comments. A page's text is that of
its blocks in such slots: those under an article or main container if the page has any, else all.

Each task folds the pages it reads into one expression per host, a page of a known structure costing a comparison of its texts' hashes; the partial
expressions, not the pages, are shuffled, first to several keys per host and then to one. Expressions grow with the kinds of
structure, not with pages. Slots are joined to pages by host, which is broadcast only where Spark finds it small.

A null or empty html has empty text; a null url, or one without a host, belongs to the host ''. Repeated pages are each
extracted. An unclosed container ends with the page or with its parent, an unclosed block with the next one.
"""

from __future__ import annotations

import json
import re
from collections import Counter
from collections.abc import Iterator
from difflib import SequenceMatcher
from html.parser import HTMLParser
from zlib import crc32

import pandas as pd
from pyspark.sql import DataFrame, functions as F

PARTS = 16  # keys per host in the first merge
HOSTS = 20_000  # expressions a task holds
KNOWN = 5_000  # structures of a host that a task remembers
PERIOD = 8  # tokens of a repeated group, at most
LAYOUT = "host string, wrapper string, pages bigint"
EVIDENCE = 5  # pages of a host that show what is template, at least

CONTAINERS = frozenset(
    "html head body article main section nav header footer aside div form ul ol dl table tbody thead tfoot figure "
    "fieldset details dialog menu search blockquote noscript template iframe object svg select button textarea".split()
)
BLOCKS = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd td th tr pre figcaption summary caption address legend title option".split())
SILENT = frozenset("script style noscript template iframe object svg head select button textarea title option".split())
APART = frozenset("nav header footer aside form menu search dialog".split()) | SILENT
MAIN = frozenset(("article", "main"))
WHOLE = frozenset(("html", "body", "article", "main"))  # never marked
# Names in class, id or role that mark a part as not the article's.
MARKS = frozenset(
    "ad ads advert advertisement advertising sponsor sponsored promo banner cookie cookies consent notice gdpr popup modal overlay "
    "nav navbar navigation menu breadcrumb breadcrumbs header masthead footer sidebar aside widget comment comments "
    "disqus reply replies share sharing social related recommended newsletter subscribe signup login search pagination "
    "contentinfo complementary form".split()
)
_NAMES = re.compile("[a-z]+")


class Reader(HTMLParser):
    """Stream of a page: ('<', container), ('>', container) and ('#', path, text); a path is a block and its containers."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.stream: list[tuple] = []
        self.open: list[str] = []
        self.marked: list[str] = []  # the open containers with their marks
        self.block = ""
        self.pieces: list[str] = []
        self.silent = ""

    def end_block(self) -> None:
        text = " ".join("".join(self.pieces).split())
        self.pieces.clear()
        if text:
            inside = [name for name in self.marked if name not in ("html", "body")]
            self.stream.append(("#", "/".join([*inside, self.block]), text))
        self.block = ""

    def handle_starttag(self, tag: str, attrs: list) -> None:
        if tag in ("script", "style"):
            self.silent = tag
        elif tag in CONTAINERS:
            self.end_block()
            found = _NAMES.findall(" ".join(value or "" for name, value in attrs if name in ("class", "id", "role")).lower())
            marked = [] if tag in WHOLE else sorted(MARKS.intersection(found))
            self.open.append(tag)
            self.marked.append(".".join([tag, *marked]))
            self.stream.append(("<", self.marked[-1]))
        elif tag in BLOCKS:
            self.end_block()
            self.block = tag
        elif tag in ("br", "hr"):
            self.pieces.append(" ")

    def handle_startendtag(self, tag: str, attrs: list) -> None:
        self.handle_starttag(tag, attrs)
        if tag in CONTAINERS:
            self.handle_endtag(tag)

    def handle_endtag(self, tag: str) -> None:
        if tag == self.silent:
            self.silent = ""
        elif tag in CONTAINERS and tag in self.open:
            self.end_block()
            while True:
                last = self.open.pop()
                self.marked.pop()
                self.stream.append((">", last))
                if last == tag:
                    break
        elif tag in BLOCKS:
            self.end_block()

    def handle_data(self, data: str) -> None:
        if not self.silent:
            self.pieces.append(data)


def read(html: str | None) -> list[tuple]:
    reader = Reader()
    reader.feed(html or "")
    reader.close()
    reader.end_block()
    return reader.stream + [(">", tag) for tag in reversed(reader.open)]


# An expression is a list of [token or list of tokens, repeated, optional, text]; a token is '<name', '>name' or '#path'. The text
# is a hash of what a block, or a repetition, says on all pages, None where they differ.


def structure(stream: list[tuple]) -> list[list]:
    """The stream without texts, adjacent repetitions folded into repeated groups."""
    items: list[list] = []
    for token in stream:
        name = token[0] + token[1]
        if items and items[-1][0] == name and name[0] == "#":
            items[-1][1:] = [True, False, hashed(items[-1][3], token[2])]
        else:
            items.append([name, False, False, hashed(token[2]) if name[0] == "#" else None])
    for period in range(2, PERIOD + 1):
        at, out = 0, []
        while at < len(items):
            group = items[at : at + period]
            following, end = [item[0] for item in group], at + period
            while len(group) == period and [item[0] for item in items[end : end + period]] == following:
                end += period
            if end > at + period and all(isinstance(token, str) for token in following) and balanced(following):
                out.append([following, True, False, hashed(*[item[3] or "" for item in items[at:end]])])
                at = end
            else:
                out.append(items[at])
                at += 1
        items = out
    return items


def hashed(*texts: str) -> str:
    return f"{crc32('|'.join(texts).encode('utf-8', 'surrogatepass'))}.{sum(map(len, texts))}"


def balanced(tokens: list[str]) -> bool:
    """Whether containers that open in the group close in it."""
    depth = 0
    for token in tokens:
        depth += (token[0] == "<") - (token[0] == ">")
        if depth < 0:
            return False
    return depth == 0


def aligned(left: list[list], right: list[list]) -> list[list]:
    """One expression for both: agreement stays, repetition of either side holds for both, the rest is optional."""
    def keys(items: list[list]) -> list[str]:
        return [item[0] if isinstance(item[0], str) else json.dumps(item[0]) for item in items]

    out: list[list] = []
    for kind, a, b, c, d in SequenceMatcher(None, keys(left), keys(right), autojunk=False).get_opcodes():
        if kind == "equal":
            out += [[x[0], x[1] or y[1], x[2] or y[2], agreed(x[3], y[3])] for x, y in zip(left[a:b], right[c:d])]
        else:
            out += [[item[0], item[1], True, None] for item in left[a:b] + right[c:d]]
    return out


def agreed(left: str | None, right: str | None) -> str | None:
    return left if left == right else None


def written(expression: list[list]) -> str:
    """The expression as text: ( )+ repeats and ( )? may be absent."""
    out = []
    for token, repeated, optional, _ in expression:
        text = token if isinstance(token, str) else " ".join(token)
        mark = "+" * repeated + "?" * optional
        out.append(f"({text}){mark}" if mark else text)
    return " ".join(out)


def template(expression: list[list], pages: int) -> set[str]:
    """Blocks that are the same on all pages of a host: neither repeated nor optional, at one place, of one text, and not under article or main.

    Nothing is known to be template while no block differs or few pages were seen.
    """
    places = Counter(token for item in expression for token in ([item[0]] if isinstance(item[0], str) else item[0]))
    blocks = [item for item in expression if not isinstance(item[0], str) or item[0][0] == "#"]
    if pages < EVIDENCE or all(item[3] is not None for item in blocks):
        return set()
    fixed = {item[0] for item in blocks if item[3] is not None and not item[1] and not item[2]}
    return {token for token in fixed if places[token] == 1 and MAIN.isdisjoint(token[1:].split("/"))}


def slots(expression: list[list], pages: int) -> list[str]:
    """Paths of the slots that may hold main text of a host's pages."""
    tokens = {token for item in expression for token in ([item[0]] if isinstance(item[0], str) else item[0])} - template(expression, pages)
    paths = [(token[1:], [part.split(".") for part in token[1:].split("/")]) for token in sorted(tokens) if token[0] == "#"]
    return [path for path, parts in paths if not any(part[0] in APART or len(part) > 1 for part in parts)]


def text_of(stream: list[tuple], content: set[str]) -> str:
    """Blocks of the slots in page order, those under article or main if the page has any there."""
    blocks = [token for token in stream if token[0] == "#" and token[1] in content]
    inside = [token for token in blocks if not MAIN.isdisjoint(token[1].split("/"))]
    return "\n\n".join(token[2] for token in inside or blocks)


def host(url):
    return F.coalesce(F.lower(F.regexp_extract(url, "^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1)), F.lit(""))


def wrappers(pages: DataFrame) -> DataFrame:
    """(host, wrapper, pages, slots) of every host of (url, html); ``wrapper`` is the expression in JSON, ``pages`` how many it describes."""

    def folded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found: dict[str, list] = {}
        known: dict[str, dict[str, list]] = {}  # texts by structure
        counts: Counter = Counter()

        def out() -> pd.DataFrame:
            for name, structures in known.items():
                for key, texts in structures.items():
                    items = [[*item, text] for item, text in zip(json.loads(key), texts)]
                    found[name] = aligned(found[name], items) if name in found else items
            wrappers = [json.dumps(found[name]) for name in found]
            return pd.DataFrame({"host": list(found), "wrapper": wrappers, "pages": [counts[name] for name in found]}, dtype=object)

        for batch in batches:
            for name, html in zip(batch["host"], batch["html"]):
                items = structure(read(html))
                counts[name] += 1
                key, texts = json.dumps([item[:3] for item in items]), [item[3] for item in items]
                seen = known.setdefault(name, {})
                if key in seen:
                    seen[key] = [agreed(former, text) for former, text in zip(seen[key], texts)]
                elif len(seen) < KNOWN:
                    seen[key] = texts
                else:
                    found[name] = aligned(found[name], items) if name in found else items
            if len(known) > HOSTS:
                yield out()
                found, known, counts = {}, {}, Counter()
        yield out()

    def merged(group: pd.DataFrame) -> pd.DataFrame:
        expression: list = []
        for place, item in enumerate(sorted(set(group["wrapper"]))):
            expression = aligned(expression, json.loads(item)) if place else json.loads(item)
        of_host = {"host": group["host"].iloc[:1].tolist(), "wrapper": [json.dumps(expression)], "pages": [int(group["pages"].sum())]}
        return pd.DataFrame(of_host, dtype=object)

    @F.pandas_udf("array<string>")
    def judged(items: pd.Series, pages: pd.Series) -> pd.Series:
        return pd.Series([slots(json.loads(item), count) for item, count in zip(items, pages)], dtype=object)

    partial = pages.select(host(F.col("url")).alias("host"), "html").mapInPandas(folded, LAYOUT)
    salted = partial.withColumn("part", F.pmod(F.xxhash64("wrapper"), F.lit(PARTS)))
    some = salted.groupBy("host", "part").applyInPandas(merged, LAYOUT)
    whole = some.groupBy("host").applyInPandas(merged, LAYOUT)
    return whole.withColumn("slots", judged("wrapper", "pages"))


def main_texts(pages: DataFrame, found: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every page of (page_id, url, html), by the wrappers of the hosts."""

    @F.pandas_udf("string")
    def extracted(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for htmls, contents in batches:
            yield pd.Series(
                [text_of(read(html), set(content if content is not None else ())) for html, content in zip(htmls, contents)], dtype=object
            )

    joined = pages.withColumn("host", host(F.col("url"))).join(found.select("host", "slots"), "host", "left")
    texts = joined.select("page_id", "url", extracted("html", "slots").alias("text"))
    return texts.withColumn("n_chars", F.length("text").cast("bigint"))
