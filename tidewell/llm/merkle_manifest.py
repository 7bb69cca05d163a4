"""Merkle manifest of a dataset: a tree of digests per language over its documents, and one tree over the languages.

SHA midstate tree: every parent keeps a copy of its hash's state before each of its child slots. A replaced child is
folded by resuming the state of its slot with the new digest and the siblings to its right; what lies left of it is
never hashed again. States live in the task that builds a tree, so trees are built in aligned blocks of
``ARITY ** LEVELS`` nodes, one block after another in a task; above a block, each level's state before the block's
slot is made once from the path that came down, and serves all of the block's leaves.

Documents get their places by a range sort with counts per sorted partition, so a language of any size is divided
evenly. Passes upward reduce blocks to their root until one node is left per language and then one in all; passes
downward hand each block its path (one row), and the last of them writes each document's proof and folded root.

Documents ascend by doc_id; a null id comes first and is never tampered with, equal ids are ordered by their leaf.
Null values are ``-`` in a leaf, empty and long texts are hashed whole, repeated rows are leaves of their own; a null
language is a tree of its own and comes first. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from tidewell.llm.common import staged, unstage

ARITY = 2
LEVELS = 8  # levels of a block's tree
TAMPERED = 7  # one of so many ids by crc32
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
SMALL = 100_000  # rows of a side that may be broadcast: a number, a language and two counts each
NODES = "tree bigint, pos bigint, size bigint, digest string"
PATHS = "tree bigint, pos bigint, path string"
PROOFS = "doc_id bigint, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean"


def leaf(values: dict[str, Column]) -> Column:
    """H of the fields, each with its length, so that no two rows share an input."""
    parts = []
    for name in FIELDS:
        text = values[name].cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def leaves(docs: DataFrame) -> DataFrame:
    """(lang, doc_id, leaf, changed): the leaf as it is, and as it is after tampering (else null)."""
    now = {name: F.col(name) for name in FIELDS}
    after = now | {"n_chars": F.try_add(F.col("n_chars"), F.lit(1))}
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % TAMPERED == 0
    return docs.select("lang", "doc_id", leaf(now).alias("leaf"), F.when(hit, leaf(after)).alias("changed"))


def positioned(rows: DataFrame, tree: str, *order: str) -> DataFrame:
    """The rows with their place ``pos`` in their tree's order (nulls first) and the tree's ``size``.

    Sorted ranges are numbered as they lie; a range's first number per tree and the counts of the ranges before it
    give the places, so no task sees more than its range.
    """
    keys = [F.asc_nulls_first(name) for name in (tree, *order)]
    lain = rows.repartitionByRange(*keys).sortWithinPartitions(*keys)
    numbered = staged(lain.withColumn("_at", F.monotonically_increasing_id()))
    part = F.shiftright("_at", 33)
    counts = numbered.groupBy(part.alias("_part"), F.col(tree).alias("_tree")).agg(F.count("*").alias("n"), F.min("_at").alias("first"))
    whole = Window.partitionBy("_tree")
    starts = counts.select(
        "_part",
        "_tree",
        (F.sum("n").over(whole.orderBy("_part")) - F.col("n") - F.col("first")).alias("_shift"),
        F.sum("n").over(whole).alias("size"),
    )
    joined = numbered.join(small(starts), (part == F.col("_part")) & F.col(tree).eqNullSafe(F.col("_tree")))
    return joined.select(*rows.columns, (F.col("_at") + F.col("_shift")).alias("pos"), "size")


def small(df: DataFrame) -> DataFrame:
    """Staged, and broadcast only if its rows were counted to be few."""
    df = staged(df)
    return F.broadcast(df) if df.count() <= SMALL else df


def _digest(*texts: bytes) -> bytes:
    return hashlib.sha256(b"".join(texts)).hexdigest().encode()


class Tree:
    """A block's tree. ``states[level][parent][slot]`` is the parent's hash before that slot."""

    def __init__(self, nodes: list[bytes], size: int, levels: int):
        """``size``: nodes of the whole tree. If they fit one block it ends with one node, else a block has all ``levels``."""
        self.rows, self.states = [nodes], []
        alone = size <= ARITY**levels
        while len(nodes) > 1 if alone else len(self.states) < levels:
            above, states = [], []
            for at in range(0, len(nodes), ARITY):
                state, before = hashlib.sha256(), []
                for child in nodes[at : at + ARITY]:
                    before.append(state.copy())
                    state.update(child)
                states.append(before)
                above.append(state.hexdigest().encode())
            self.rows.append(above)
            self.states.append(states)
            nodes = above

    @property
    def root(self) -> bytes:
        return self.rows[-1][0]

    def siblings(self, place: int) -> list[tuple[int, list[bytes]]]:
        """Per level the slot of the node and the other nodes of its run."""
        out = []
        for nodes in self.rows[:-1]:
            first, slot = place // ARITY * ARITY, place % ARITY
            run = nodes[first : first + ARITY]
            out.append((slot, run[:slot] + run[slot + 1 :]))
            place //= ARITY
        return out

    def fold(self, place: int, digest: bytes) -> bytes:
        """The root if the node at ``place`` were ``digest``: kept states go on with it and its right siblings."""
        for nodes, states in zip(self.rows, self.states):
            parent, slot = divmod(place, ARITY)
            state = states[parent][slot].copy()
            state.update(digest)
            for right in nodes[place + 1 : (parent + 1) * ARITY]:
                state.update(right)
            digest, place = state.hexdigest().encode(), parent
        return digest


class Above:
    """The levels over a block: one kept state before the block's slot and the right siblings per level."""

    def __init__(self, path: str):
        self.levels, self.siblings = [], b""
        for level in path.split(";") if path else []:
            slot, _, rest = level.partition(":")
            others = rest.encode().split(b",") if rest else []
            state = hashlib.sha256(b"".join(others[: int(slot)]))
            self.levels.append((state, b"".join(others[int(slot) :])))
            self.siblings += b"".join(others)

    def fold(self, digest: bytes) -> bytes:
        for before, right in self.levels:
            state = before.copy()
            state.update(digest)
            state.update(right)
            digest = state.hexdigest().encode()
        return digest


def _text(levels: list[tuple[int, list[bytes]]]) -> str:
    return ";".join(f"{slot}:{b','.join(others).decode()}" for slot, others in levels)


def _arrow(schema: str, rows: list[tuple]) -> pa.RecordBatch:
    kinds = {"bigint": pa.int64(), "string": pa.string(), "boolean": pa.bool_()}
    fields = [field.split() for field in schema.split(", ")]
    columns = list(zip(*rows)) or [()] * len(fields)
    return pa.RecordBatch.from_arrays([pa.array(c, kinds[k]) for c, (_, k) in zip(columns, fields)], names=[n for n, _ in fields])


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[int, int], list[tuple]]]:
    """Rows (tree, block, ...) come sorted; one list per block."""
    key, rows = None, []
    for batch in batches:
        for row in zip(*[column.to_pylist() for column in batch.columns]):
            if row[:2] != key:
                if rows:
                    yield key, rows
                key, rows = row[:2], []
            rows.append(row)
    if rows:
        yield key, rows


def _block(levels: int) -> Column:
    return F.expr(f"pos div {ARITY**levels}").alias("block")


def lifted(nodes: DataFrame, levels: int) -> DataFrame:
    """The roots of all blocks, as the nodes of the next pass."""

    def reduce(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = []
        for (tree, block), rows in _blocks(batches):
            size = rows[0][3]
            root = Tree([row[4].encode() for row in rows], size, levels).root
            out.append((tree, block, -(-size // ARITY**levels), root.decode()))
            if len(out) > 10_000:
                yield _arrow(NODES, out)
                out = []
        yield _arrow(NODES, out)

    rows = nodes.select("tree", _block(levels), "pos", "size", "digest")
    return rows.repartition("tree", "block").sortWithinPartitions("tree", "block", "pos").mapInArrow(reduce, NODES)


def reduced(nodes: DataFrame, levels: int) -> list[DataFrame]:
    """The nodes and the staged nodes of each pass above them, up to one node per tree."""
    passes = [nodes]
    while True:
        passes.append(staged(lifted(passes[-1], levels)))
        if (passes[-1].agg(F.max("size")).first()[0] or 1) == 1:
            return passes


def _under(nodes: DataFrame, paths: DataFrame, levels: int, *more: str) -> DataFrame:
    """Blocks as sorted rows, each led by the row of its path."""
    rows = nodes.select("tree", _block(levels), "pos", "size", "digest", *more, F.lit(None).cast("string").alias("path"))
    nothing = {name: F.lit(None).cast(nodes.schema[name].dataType) for name in ("size", "digest", *more)}
    heads = paths.select("tree", F.col("pos").alias("block"), F.lit(-1).cast("bigint").alias("pos"), "path")
    heads = heads.withColumns(nothing).select(*rows.columns)
    return rows.unionByName(heads).repartition("tree", "block").sortWithinPartitions("tree", "block", "pos")


def handed_down(nodes: DataFrame, paths: DataFrame, levels: int) -> DataFrame:
    """(tree, pos, path) of every node: its siblings in the block and above."""

    def extend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (tree, _), (head, *rows) in _blocks(batches):
            block = Tree([row[4].encode() for row in rows], rows[0][3], levels)
            own = (_text(block.siblings(place)) for place in range(len(rows)))
            yield _arrow(PATHS, [(tree, row[2], ";".join(filter(None, (path, head[5])))) for row, path in zip(rows, own)])

    return _under(nodes, paths, levels).mapInArrow(extend, PATHS)


def proofs(leaves: DataFrame, paths: DataFrame, root: str, levels: int) -> DataFrame:
    """The last pass: proof and folded root of every leaf; ``paths`` starts with its tree's subroot and a blank."""

    def prove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, (head, *rows) in _blocks(batches):
            subroot, _, path = head[7].partition(" ")
            block, above = Tree([row[4].encode() for row in rows], rows[0][3], levels), Above(path)
            out = []
            for place, row in enumerate(rows):
                siblings = b"".join(b"".join(others) for _, others in block.siblings(place))
                changed = (row[6] or row[4]).encode()
                folded = above.fold(block.fold(place, changed)).decode()
                proof = _digest(siblings, above.siblings).decode()
                out.append((row[5], row[4], subroot, root, proof, folded, folded == root))
            yield _arrow(PROOFS, out)

    return _under(leaves, paths, levels, "doc_id", "changed").mapInArrow(prove, PROOFS)


def manifest(docs: DataFrame, levels: int = LEVELS) -> DataFrame:
    """One row per document of (doc_id, source, lang, n_chars, text): leaf, subroot, root, proof and folded root."""
    placed = staged(positioned(leaves(docs), "lang", "doc_id", "leaf"))
    sizes = staged(placed.groupBy("lang").agg(F.max("size").alias("leaves")).withColumn("_one", F.lit(0)))
    languages = sizes.count()
    if not languages:
        return docs.sparkSession.createDataFrame([], PROOFS)
    trees = positioned(sizes, "_one", "lang").select(F.col("lang").alias("_lang"), F.col("pos").alias("tree"))
    numbered = placed.join(small(trees), F.col("lang").eqNullSafe(F.col("_lang")))
    nodes = staged(numbered.select("tree", "pos", "size", F.col("leaf").alias("digest"), "doc_id", "changed"))
    unstage(placed)
    passes = reduced(nodes, levels)
    subroots = passes[-1]
    zero = F.lit(0).cast("bigint")
    forest = subroots.select(
        zero.alias("tree"), F.col("tree").alias("pos"), F.lit(languages).cast("bigint").alias("size"), "digest"
    )
    upper = reduced(forest, levels)
    root = upper[-1].first()["digest"]
    paths = upper[-1].select("tree", "pos", F.lit("").alias("path"))
    for below in upper[-2::-1]:
        paths = staged(handed_down(below, paths, levels))
    paths = paths.select(F.col("pos").alias("tree"), zero.alias("pos"), "path")
    for below in passes[-2:0:-1]:
        paths = staged(handed_down(below, paths, levels))
    named = paths.join(subroots.select("tree", F.col("digest").alias("subroot")), "tree")
    return proofs(nodes, named.select("tree", "pos", F.concat_ws(" ", "subroot", "path").alias("path")), root, levels)


# The same in SQL: crc32 by its table, trees by recursion over levels, siblings by place.
ORACLE = """
WITH RECURSIVE crc AS (
  SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_prepend(i, range(8)),
      lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS c
    FROM range(256) AS r(i))),
ids AS (
  SELECT doc_id, xor(list_reduce(list_prepend(4294967295, list_transform(string_split(doc_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
    lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 7 = 0 AS hit
  FROM (SELECT DISTINCT doc_id FROM documents WHERE doc_id IS NOT NULL), crc),
fields AS (
  SELECT d.doc_id, lang, coalesce(hit AND n_chars IS NOT NULL, false) AS hit,
    coalesce(strlen(d.doc_id::VARCHAR) || ':' || d.doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
      || coalesce(strlen(lang) || ':' || lang, '-') AS head,
    coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS n,
    coalesce(strlen((n_chars + 1)::VARCHAR) || ':' || (n_chars + 1), '-') AS n1,
    coalesce(strlen(text) || ':' || text, '-') AS body
  FROM documents AS d LEFT JOIN ids ON d.doc_id = ids.doc_id),
leaf AS (
  SELECT doc_id, lang, sha256(head || n || body) AS leaf, CASE WHEN hit THEN sha256(head || n1 || body) END AS changed
  FROM fields),
placed AS (
  SELECT *, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree,
    row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos
  FROM leaf),
up AS (
  SELECT 0 AS level, tree, pos, leaf AS digest FROM placed
  UNION ALL
  SELECT level + 1, tree, pos // 2, sha256(string_agg(digest, '' ORDER BY pos))
  FROM (SELECT *, max(pos) OVER (PARTITION BY tree) AS last FROM up) WHERE last > 0
  GROUP BY level, tree, pos // 2),
heights AS (SELECT tree, max(level) AS height FROM up GROUP BY tree),
subroots AS (SELECT tree, digest AS subroot, height FROM up JOIN heights USING (tree) WHERE level = height),
top AS (
  SELECT 0 AS level, tree AS pos, subroot AS digest FROM subroots
  UNION ALL
  SELECT level + 1, pos // 2, sha256(string_agg(digest, '' ORDER BY pos))
  FROM (SELECT *, max(pos) OVER () AS last FROM top) WHERE last > 0
  GROUP BY level, pos // 2),
ends AS (SELECT max(level) AS top_height, max_by(digest, level) AS root FROM top),
steps AS (
  SELECT p.tree, p.pos, l.level, xor(p.pos >> l.level, 1) AS other, (p.pos >> l.level) % 2 AS slot, false AS high
  FROM placed AS p JOIN heights AS h USING (tree), range(64) AS l(level) WHERE l.level < h.height
  UNION ALL
  SELECT p.tree, p.pos, h.height + l.level, xor(p.tree >> l.level, 1), (p.tree >> l.level) % 2, true
  FROM placed AS p JOIN heights AS h USING (tree), ends, range(64) AS l(level) WHERE l.level < top_height),
sides AS (
  SELECT s.tree, s.pos, s.level, s.slot, coalesce(u.digest, t.digest, '') AS sibling
  FROM steps AS s JOIN heights AS h USING (tree)
  LEFT JOIN up AS u ON NOT s.high AND u.tree = s.tree AND u.level = s.level AND u.pos = s.other
  LEFT JOIN top AS t ON s.high AND t.level = s.level - h.height AND t.pos = s.other),
paths AS (
  SELECT tree, pos, sha256(string_agg(sibling, '' ORDER BY level)) AS proof, list(sibling ORDER BY level) AS siblings,
    list(slot ORDER BY level) AS slots
  FROM sides GROUP BY tree, pos),
folded AS (
  SELECT tree, pos, 0 AS level, coalesce(changed, leaf) AS digest FROM placed
  UNION ALL
  SELECT f.tree, f.pos, level + 1, sha256(CASE WHEN slots[level + 1] = 1 THEN siblings[level + 1] || digest ELSE digest || siblings[level + 1] END)
  FROM folded AS f JOIN paths AS p ON f.tree = p.tree AND f.pos = p.pos WHERE level < len(slots)),
done AS (SELECT tree, pos, max_by(digest, level) AS folded_root FROM folded GROUP BY tree, pos)
SELECT doc_id, leaf, subroot, root, coalesce(proof, sha256('')) AS proof_sha256, folded_root, folded_root = root AS verified
FROM placed JOIN subroots USING (tree) JOIN done USING (tree, pos) LEFT JOIN paths USING (tree, pos), ends
"""
