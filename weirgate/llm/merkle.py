"""Merkle manifest of a table: a tree for each source, a tree over the sources, and a proof for every row.

A row's leaf is the hash of its fields. The leaves of a source lie in order of ``doc_id`` (equal rows and
ids by their leaf), every three neighbours become one node, level by level until one is left, the subroot;
subroots in order of the source become the root the same way. A proof is the list of a leaf's siblings up
to the root. ``verified`` folds the row's leaf, or that of a second version of the row, with the siblings
of the first and compares what comes out with the root.

A superblock is 3^7 neighbouring leaves. Going up, superblocks are reduced to their nodes, these nodes in
superblocks of their own, until each source has one; the table shrinks by 2,187 a round. Going down, each
superblock is given only the outer siblings of its own node: nodes and that one row are cogrouped by
superblock, and one pass finishes the local reduction, joins local and outer siblings to proofs and folds
them. So no task holds more than one superblock, whatever a source's share of the rows, and the root
reaches the rows on the same way. Places come from a range partitioning by (source, doc_id, leaf, row
number), which also splits equal rows, and from counts by partition and source.

Null fields are ``-``; the null source comes first, null ids come first in their source. Repeated rows are
leaves of their own. Long texts are hashed where they are read; only digests move. An empty table gives
no rows. Other columns are ignored whatever their names.
"""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weirgate.session import cut_lineage

ARITY = 3
#: Levels of one superblock.
LEVELS = 7
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def joined_hash(digests: list[bytes]) -> bytes:
    """sha256 over the digests as lowercase hex text."""
    return hashlib.sha256("".join([d.hex() for d in digests]).encode()).digest()


def field(value: Column) -> Column:
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(**changed: Column) -> Column:
    """Digest of a row of documents, some fields replaced."""
    return F.unhex(F.sha2(F.concat(*[field(changed.get(name, F.col(name))) for name in FIELDS]), 256))


def placed(rows: DataFrame, group: str, order: list[str]) -> DataFrame:
    """Rows with ``pos``, their place from 0 in their group, and ``n``, the rows of the group."""
    order = [group, *order]
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id())
    # Numbers are read from the written table, so they hold whatever is lost later.
    at = cut_lineage(ranged)
    at = at.withColumns({"part": F.shiftright("at", 33), "row": F.col("at").bitwiseAND(F.lit((1 << 33) - 1))}).drop("at")
    cells = at.groupBy(group, "part").agg(F.min("row").alias("first"), F.count(F.lit(1)).alias("rows"))
    whole = Window.partitionBy(group)
    before = F.coalesce(F.sum("rows").over(whole.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    cells = cells.select(group, "part", (before - F.col("first")).alias("shift"), F.sum("rows").over(whole).alias("n"))
    return at.join(cells, [group, "part"]).withColumn("pos", F.col("row") + F.col("shift")).drop("part", "row", "shift")


class Block:
    """The nodes of one superblock by level; ``n`` nodes of its tree decide how far it reaches."""

    def __init__(self, nodes: list[bytes], n: int, arity: int, levels: int) -> None:
        self.arity = arity
        self.levels = [nodes]
        while len(self.levels) <= levels if n > arity**levels else len(self.levels[-1]) > 1:
            low = self.levels[-1]
            self.levels.append([joined_hash(low[i : i + arity]) for i in range(0, len(low), arity)])

    def path(self, i: int) -> list[tuple[int, list[bytes]]]:
        """For each level: the node's place among its run and its siblings."""
        out = []
        for level in self.levels[:-1]:
            first = i - i % self.arity
            out.append((i - first, level[first:i] + level[i + 1 : first + self.arity]))
            i //= self.arity
        return out


def fold(node: bytes, path: list[tuple[int, list[bytes]]]) -> bytes:
    for place, siblings in path:
        node = joined_hash([*siblings[:place], node, *siblings[place:]])
    return node


def raised(nodes: DataFrame, arity: int, levels: int) -> DataFrame:
    """``tree``, ``pos``, ``n`` and ``node`` of the superblocks of a level."""
    size = arity**levels

    def work(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("pos")
        n, pos = int(part["n"].iloc[0]), int(part["pos"].iloc[0])
        top = Block(list(part["node"]), n, arity, levels).levels[-1][0]
        return pd.DataFrame({"tree": [part["tree"].iloc[0]], "pos": [pos // size], "n": [-(-n // size)], "node": [top]})

    blocks = nodes.select("tree", "pos", "n", "node", F.floor(F.col("pos") / size).alias("block"))
    return cut_lineage(blocks.groupBy("tree", "block").applyInPandas(work, "tree string, pos long, n long, node binary"))


_PATH = "path array<struct<place:int,siblings:array<binary>>>"


def _levels(entry) -> list[tuple[int, list[bytes]]]:
    return [(step["place"], list(step["siblings"])) for step in entry]


def lowered(nodes: DataFrame, above: DataFrame, arity: int, levels: int) -> DataFrame:
    """``tree``, ``pos``, ``path`` to the root, ``subroot`` and ``root`` of a level's nodes from those of its superblocks."""
    size = arity**levels

    def work(part: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("pos")
        block = Block(list(part["node"]), int(part["n"].iloc[0]), arity, levels)
        rest = _levels(outer["path"].iloc[0])
        steps = [[{"place": p, "siblings": s} for p, s in block.path(i) + rest] for i in range(len(part))]
        return pd.DataFrame({"tree": part["tree"], "pos": part["pos"], "path": pd.Series(steps, part.index), "subroot": outer["subroot"].iloc[0], "root": outer["root"].iloc[0]})

    blocks = nodes.select("tree", "pos", "n", "node", F.floor(F.col("pos") / size).alias("block"))
    both = blocks.groupBy("tree", "block").cogroup(above.groupBy("tree", "pos"))
    return cut_lineage(both.applyInPandas(work, f"tree string, pos long, {_PATH}, subroot binary, root binary"))


def _raised_to_one(nodes: DataFrame, arity: int, levels: int) -> list[DataFrame]:
    """The levels of superblocks above the nodes, the last with one node a tree."""
    out = []
    while True:
        nodes = raised(nodes, arity, levels)
        out.append(nodes)
        if nodes.filter("n > 1").isEmpty():
            return out


def manifest(docs: DataFrame, second: dict[str, Column] | None = None, when: Column | None = None, arity: int = ARITY, levels: int = LEVELS) -> DataFrame:
    """``doc_id``, ``leaf``, ``subroot``, ``root``, ``proof``, ``folded_root`` (hex) and ``verified`` of every row.

    ``proof`` has the siblings from the leaf to the root, as hex. Where ``when`` holds, the fields in
    ``second`` are what is folded with the proof of the first version.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    again = F.when(when, leaf_hash(**(second or {}))) if when is not None else F.lit(None).cast("binary")
    # A name of the tree that sorts like the source, null first.
    tree = F.coalesce(F.concat(F.lit("s"), F.col("source").cast("string")), F.lit("-"))
    rows = docs.select(tree.alias("tree"), "doc_id", leaf_hash().alias("node"), again.alias("again"), F.monotonically_increasing_id().alias("salt"))
    # Written first: the sampling of the ranges reads digests, not texts.
    leaves = placed(cut_lineage(rows), "tree", ["doc_id", "node", "salt"]).drop("salt")
    leaves = cut_lineage(leaves)
    below = [leaves, *_raised_to_one(leaves, arity, levels)]

    subroots = below[-1].select(F.lit("").alias("tree"), F.col("tree").alias("source"), "node")
    subroots = cut_lineage(placed(subroots, "tree", ["source"]))
    top = [subroots, *_raised_to_one(subroots, arity, levels)]
    none = F.array().cast("array<struct<place:int,siblings:array<binary>>>")
    paths = top[-1].select("tree", "pos", none.alias("path"), F.lit(b"").alias("subroot"), F.col("node").alias("root"))
    for nodes in reversed(top[:-1]):
        paths = lowered(nodes, paths, arity, levels)
    paths = subroots.drop("tree").join(paths.drop("tree", "subroot"), "pos").select(F.col("source").alias("tree"), F.lit(0).cast("long").alias("pos"), "path", F.col("node").alias("subroot"), "root")
    for nodes in reversed(below[1:-1]):
        paths = lowered(nodes, paths, arity, levels)

    size = arity**levels

    def work(part: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("pos")
        block = Block(list(part["node"]), int(part["n"].iloc[0]), arity, levels)
        rest = _levels(outer["path"].iloc[0])
        root = outer["root"].iloc[0]
        proofs, folded = [], []
        for i, (node, other) in enumerate(zip(part["node"], part["again"])):
            path = block.path(i) + rest
            proofs.append([s.hex() for _, siblings in path for s in siblings])
            folded.append(fold(node if other is None else other, path))
        return pd.DataFrame(
            {
                "doc_id": part["doc_id"],
                "leaf": [x.hex() for x in part["node"]],
                "subroot": outer["subroot"].iloc[0].hex(),
                "root": root.hex(),
                "proof": pd.Series(proofs, part.index),
                "folded_root": [x.hex() for x in folded],
                "verified": [x == root for x in folded],
            }
        )

    blocks = leaves.select("tree", "pos", "n", "node", "again", "doc_id", F.floor(F.col("pos") / size).alias("block"))
    both = blocks.groupBy("tree", "block").cogroup(paths.groupBy("tree", "pos"))
    return both.applyInPandas(work, f"doc_id {kind}, leaf string, subroot string, root string, proof array<string>, folded_root string, verified boolean")


def tampered(docs: DataFrame, levels: int = LEVELS) -> DataFrame:
    """The manifest where the second version of every other row (crc32 of the id as text) has lost its line feeds.

    Rows without an id have no second version.
    """
    even = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    return manifest(docs, {"text": F.replace(F.col("text").cast("string"), F.lit("\n"), F.lit(""))}, even, levels=levels)


def digest(found: DataFrame) -> DataFrame:
    """The contract's columns."""
    return found.select("doc_id", "leaf", "subroot", "root", F.sha2(F.array_join("proof", ""), 256).alias("proof_sha256"), "folded_root", "verified")


#: One recursion up the trees, one that folds; crc32 byte by byte from its table.
SQL = r"""
WITH RECURSIVE entries AS (
  SELECT list(list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) ORDER BY i) AS crc
  FROM range(256) t(i)
), d AS (
  SELECT doc_id, source, lang, n_chars, text, row_number() OVER () AS r,
         xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length(doc_id::VARCHAR) + 1), lambda k: unicode(substr(doc_id::VARCHAR, k, 1))::BIGINT)),
             lambda c, b: xor(c >> 8, crc[(xor(c, b) % 256) + 1])), 4294967295) % 2 = 0 AS tampered
  FROM documents, entries
), fields AS (
  SELECT r, doc_id, source,
         concat(coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-'), coalesce(strlen(source) || ':' || source, '-'),
                coalesce(strlen(lang) || ':' || lang, '-'), coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-')) AS head,
         text, CASE WHEN tampered THEN replace(text, chr(10), '') ELSE text END AS other
  FROM d
), leaves AS (
  SELECT r, doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
         sha256(head || coalesce(strlen(other) || ':' || other, '-')) AS other FROM fields
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf, r) - 1 AS pos, count(*) OVER (PARTITION BY source) AS n FROM leaves
), tree(lvl, source, pos, node, n) AS (
  SELECT 0, source, pos, leaf, n FROM placed
  UNION ALL
  SELECT lvl + 1, source, pos // 3, sha256(string_agg(node, '' ORDER BY pos)), (any_value(n) + 2) // 3 FROM tree WHERE n > 1 GROUP BY lvl, source, pos // 3
), subroots AS (
  SELECT source, node, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS pos, count(*) OVER () AS n FROM tree WHERE n = 1
), upper(lvl, pos, node, n) AS (
  SELECT 0, pos, node, n FROM subroots
  UNION ALL
  SELECT lvl + 1, pos // 3, sha256(string_agg(node, '' ORDER BY pos)), (any_value(n) + 2) // 3 FROM upper WHERE n > 1 GROUP BY lvl, pos // 3
), steps AS (
  SELECT p.r, 0 AS part, t.lvl, t.pos AS seat, t.node, t.pos = p.pos // (3 ** t.lvl)::BIGINT AS own
  FROM placed p JOIN tree t ON t.source IS NOT DISTINCT FROM p.source AND t.n > 1 AND t.pos // 3 = p.pos // (3 ** (t.lvl + 1))::BIGINT
  UNION ALL
  SELECT p.r, 1, u.lvl, u.pos, u.node, u.pos = s.pos // (3 ** u.lvl)::BIGINT
  FROM placed p JOIN subroots s ON s.source IS NOT DISTINCT FROM p.source JOIN upper u ON u.n > 1 AND u.pos // 3 = s.pos // (3 ** (u.lvl + 1))::BIGINT
), numbered AS (
  SELECT *, dense_rank() OVER (PARTITION BY r ORDER BY part, lvl) AS step FROM steps
), proofs AS (
  SELECT r, string_agg(node, '' ORDER BY step, seat) AS proof FROM numbered WHERE NOT own GROUP BY r
), folds(r, step, node) AS (
  SELECT r, 0::BIGINT, other FROM placed
  UNION ALL
  SELECT f.r, f.step + 1, sha256(string_agg(CASE WHEN s.own THEN f.node ELSE s.node END, '' ORDER BY s.seat))
  FROM folds f JOIN numbered s ON s.r = f.r AND s.step = f.step + 1 GROUP BY f.r, f.step
), folded AS (
  SELECT r, arg_max(node, step) AS node FROM folds GROUP BY r
)
SELECT p.doc_id, p.leaf, s.node AS subroot, u.node AS root, sha256(coalesce(proof, '')) AS proof_sha256,
       f.node AS folded_root, f.node = u.node AS verified
FROM placed p JOIN subroots s ON s.source IS NOT DISTINCT FROM p.source JOIN upper u ON u.n = 1
JOIN folded f ON f.r = p.r LEFT JOIN proofs q ON q.r = p.r
"""
