"""Merkle manifest of a dataset: only every few levels of its trees are stored, proofs recompute what lies between.

Rows of one group form a tree, the groups' roots a last one. A level is stored as blocks of ``2 ** EVERY`` consecutive nodes:
what is above a block, up to the next stored level, follows from the block alone.
"""

from __future__ import annotations

import hashlib
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, StringType

from tidemart.llm.common import load, ranked, small_batches, staged

#: Levels from one that is stored to the next.
EVERY = 6
#: Groups that are broadcast; more of them are joined.
BROADCAST_GROUPS = 100_000
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


class Manifest(NamedTuple):
    """Stored levels, lowest first, of the trees of rows and of the tree of groups, and a table with the one root.

    A level holds (tree, block, n, items, nodes): ``n`` is how many nodes the tree has there, ``items`` the rows' ids and
    carried digests at the lowest level, ``nodes`` the block's digests in order.
    """

    rows: list[DataFrame]
    groups: list[DataFrame]
    root: DataFrame


def field(value: Column) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(fields: list[Column]) -> Column:
    return F.sha2(F.concat(*map(field, fields)), 256)


def _pairs(nodes: list[bytes]) -> list[bytes]:
    """The level above: each two nodes in turn, a last one alone, hashed as hexadecimal text."""
    text = [node.hex().encode() for node in nodes]
    return [hashlib.sha256(b"".join(text[i:i + 2])).digest() for i in range(0, len(text), 2)]


@F.pandas_udf(BinaryType())
def climbed(nodes: pd.Series, levels: pd.Series) -> pd.Series:
    """The node that many levels above a block."""
    def top(block: list[bytes], steps: int) -> bytes:
        for _ in range(steps):
            block = _pairs(block)
        return block[0]

    return pd.Series([top(list(block), steps) for block, steps in zip(nodes, levels, strict=True)], dtype=object)


@F.pandas_udf(ArrayType(ArrayType(StringType())))
def siblings(nodes: pd.Series, levels: pd.Series) -> pd.Series:
    """For each node of a block the siblings from it to that many levels above; interior nodes are made anew.

    A sibling to the left reads ``<`` and its digest, one to the right ``>`` and its digest; an empty text is a level at which
    the node is alone.
    """
    def proofs(block: list[bytes], steps: int) -> list[list[str]]:
        found = [[] for _ in block]
        for level in range(steps):
            beside = ["<>"[i % 2] + node.hex() for i, node in enumerate(block)]
            for place, proof in enumerate(found):
                other = (place >> level) ^ 1
                proof.append(beside[other] if other < len(beside) else "")
            block = _pairs(block)
        return found

    return pd.Series([proofs(list(block), steps) for block, steps in zip(nodes, levels, strict=True)], dtype=object)


def _levels_above() -> Column:
    """How far a block reaches: to the next stored level, or to the top of its tree."""
    return F.when(F.col("n") > 1 << EVERY, F.lit(EVERY)).otherwise(F.ceil(F.log2(F.col("n").cast("double"))).cast("int"))


def _forest(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """Stored levels of all trees, and (tree, node) with their roots; ``nodes`` has tree, pos, n, item and node."""
    item, levels, tops = nodes.schema["item"].dataType, [], None
    while True:
        block = F.shiftright("pos", EVERY)
        found = nodes.groupBy("tree", block.alias("block"), "n").agg(
            F.array_sort(F.collect_list(F.struct("pos", "item", "node"))).alias("found"))
        levels.append(staged(found.select("tree", "block", "n", F.col("found.item").alias("items"),
                                          F.col("found.node").alias("nodes"))))
        above = staged(levels[-1].select("tree", F.col("block").alias("pos"), "n",
                                         climbed("nodes", _levels_above()).alias("node")))
        done = above.filter(F.col("n") <= 1 << EVERY).select("tree", "node")
        tops = done if tops is None else tops.unionAll(done)
        more = above.filter(F.col("n") > 1 << EVERY)
        if more.isEmpty():
            return levels, tops
        more = more.withColumn("n", F.shiftright(F.col("n") + ((1 << EVERY) - 1), EVERY))
        nodes = more.select("tree", "pos", "n", F.lit(None).cast(item).alias("item"), "node")


def _with_groups(rows: DataFrame, groups: DataFrame) -> DataFrame:
    """``rows`` with what belongs to their tree; few groups are broadcast, many are joined and a hot one is split."""
    few = groups.limit(BROADCAST_GROUPS + 1).count() <= BROADCAST_GROUPS
    return rows.join(F.broadcast(groups) if few else groups, "tree")


def _numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """``rows`` with their place in their tree and the size of the tree. Trees follow each other in ``order``."""
    places = ranked(rows, [F.col(c).asc_nulls_first() for c in order], "at")
    sizes = staged(places.groupBy("tree").agg(F.min("at").alias("begin"), F.count("*").alias("n")))
    return _with_groups(places, sizes).withColumn("pos", F.col("at") - F.col("begin")).drop("at", "begin")


def build(docs: DataFrame, id_col: str = "doc_id", group_col: str = "lang", fields: tuple[str, ...] = FIELDS,
          carried: Column | None = None) -> Manifest:
    """The manifest of ``docs``: a tree per group over its rows in ascending order of id, one tree over the groups.

    ``carried`` is a digest kept beside each row's own, null by default. Rows with a null id come first, those of a null group
    form a group of their own that comes first, and rows that share an id are ordered by their digest. Empty texts are values
    of 0 bytes. Equal rows are leaves of their own. An empty table has no root. Columns not among ``fields`` are ignored.
    """
    small_batches(docs.sparkSession)
    own = F.unhex(leaf_digest([F.col(c) for c in fields]))
    carried = F.lit(None).cast("string") if carried is None else carried
    rows = docs.select(F.col(group_col).cast("string").alias("group"), field(F.col(group_col)).alias("tree"),
                       F.col(id_col).alias("id"), own.alias("node"), F.unhex(carried).alias("carried"))
    rows = _numbered(staged(rows), ["group", "id", "node"])
    levels, tops = _forest(rows.select("tree", "pos", "n", F.struct("group", "id", "carried").alias("item"), "node"))

    # A group's name follows from any of its rows.
    names = levels[0].filter("block = 0").select("tree", F.col("items")[0]["group"].alias("group"))
    roots = staged(tops.join(names, "tree").withColumnRenamed("tree", "member").withColumn("tree", F.lit("")))
    roots = _numbered(roots, ["group"])
    upper, root = _forest(roots.select("tree", "pos", "n", F.col("member").alias("item"), "node"))
    return Manifest(levels, upper, root.select(F.lower(F.hex("node")).alias("root")))


def _proofs(levels: list[DataFrame], tops: DataFrame) -> DataFrame:
    """(tree, item, node, proof) of all lowest nodes; ``tops`` has tree and the proof of its root."""
    above, found = None, None
    for stored in reversed(levels):
        parents = tops.select("tree", F.lit(0).cast("long").alias("pos"), F.lit(True).alias("top"), "proof")
        if above is not None:
            parents = parents.unionAll(above.select("tree", "pos", F.lit(False).alias("top"), "proof"))
        blocks = stored.select("tree", F.col("block").alias("pos"), (F.col("n") <= 1 << EVERY).alias("top"), "items",
                               "nodes", siblings("nodes", _levels_above()).alias("own"))
        each = blocks.join(parents, ["tree", "pos", "top"]).select(
            "tree", "pos", "proof", F.posexplode(F.arrays_zip("items", "nodes", "own")).alias("at", "it"))
        found = each.select("tree", ((F.col("pos") * (1 << EVERY)) + F.col("at")).alias("pos"),
                            F.col("it.items").alias("item"), F.col("it.nodes").alias("node"),
                            F.concat("it.own", "proof").alias("proof"))
        above = found
    return found


def proofs(manifest: Manifest) -> DataFrame:
    """One row per row of the dataset: id, group, leaf, carried, subroot and its proof, the siblings from the leaf to the root.

    Nothing above the stored levels is kept: each block's interior is made from its nodes, read off and dropped.
    """
    top = manifest.groups[-1].sparkSession.createDataFrame([("", [])], "tree string, proof array<string>")
    groups = _proofs(manifest.groups, top).select(
        F.col("item").alias("tree"), F.lower(F.hex("node")).alias("subroot"), "proof")
    groups = staged(groups)
    rows = _with_groups(_proofs(manifest.rows, groups.select("tree", "proof")), groups.select("tree", "subroot"))
    digest = lambda c: F.lower(F.hex(c))
    return rows.select(F.col("item.id").alias("id"), F.col("item.group").alias("group"), digest("node").alias("leaf"),
                       digest("item.carried").alias("carried"), "subroot", "proof")


def folded(leaf: Column, proof: Column) -> Column:
    """The root that ``leaf`` leads to along ``proof``."""
    other = lambda step: F.substring(step, 2, 64)
    return F.aggregate(proof, leaf, lambda node, step: F.sha2(
        F.when(step.startswith("<"), F.concat(other(step), node)).otherwise(F.concat(node, other(step))), 256))


def op11_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's proof, recomputed from its own leaf or, for about a seventh, from one with a character more."""
    docs = load(spark, sf_dir, "documents")
    changed = leaf_digest([F.col(c) + 1 if c == "n_chars" else F.col(c) for c in FIELDS])
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0
    manifest = build(docs, carried=F.when(chosen, changed))
    rows = proofs(manifest).join(F.broadcast(manifest.root))  # one row
    path = F.array_join(F.transform("proof", lambda step: F.substring(step, 2, 64)), "")
    out = rows.select(F.col("id").alias("doc_id"), "leaf", "subroot", "root", F.sha2(path, 256).alias("proof_sha256"),
                      folded(F.coalesce("carried", "leaf"), F.col("proof")).alias("folded_root"))
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))


ORACLE = r"""
WITH RECURSIVE crc AS (
    SELECT doc_id, 4294967295 - list_reduce(list_concat([4294967295::BIGINT], list_transform(
        range(8 * strlen(doc_id::VARCHAR)), lambda k: ((ascii(substr(doc_id::VARCHAR, (k // 8 + 1)::BIGINT, 1)) >> (k % 8)) & 1)::BIGINT)),
        lambda c, b: xor(c >> 1, 3988292384 * (xor(c, b) & 1))) AS crc
    FROM documents),
rows AS (
    SELECT doc_id, lang, coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-')
               || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-') AS head,
           n_chars, coalesce(strlen(text) || ':' || text, '-') AS tail, crc
    FROM documents JOIN crc USING (doc_id)),
leaves AS (
    SELECT doc_id, lang, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST) - 1 AS pos,
           sha256(head || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') || tail) AS leaf,
           sha256(head || coalesce(strlen((n_chars + 1)::VARCHAR) || ':' || (n_chars + 1), '-') || tail) AS other, crc
    FROM rows),
trees(lang, level, nodes) AS (
    SELECT lang, 0, list(leaf ORDER BY pos) FROM leaves GROUP BY lang
    UNION ALL
    SELECT lang, level + 1, list_transform(range(1, len(nodes) + 1, 2),
           lambda i: sha256(nodes[i] || coalesce(nodes[i + 1], ''))) FROM trees WHERE len(nodes) > 1),
subroots AS (
    SELECT lang, nodes[1] AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS pos FROM trees WHERE len(nodes) = 1),
upper(level, nodes) AS (
    SELECT 0, list(subroot ORDER BY pos) FROM subroots
    UNION ALL
    SELECT level + 1, list_transform(range(1, len(nodes) + 1, 2),
           lambda i: sha256(nodes[i] || coalesce(nodes[i + 1], ''))) FROM upper WHERE len(nodes) > 1),
paths AS (
    SELECT doc_id, level, pos // (1 << level) AS place, nodes
    FROM leaves JOIN trees ON trees.lang IS NOT DISTINCT FROM leaves.lang WHERE len(nodes) > 1
    UNION ALL
    SELECT doc_id, 1000 + level, subroots.pos // (1 << level), nodes
    FROM leaves JOIN subroots ON subroots.lang IS NOT DISTINCT FROM leaves.lang, upper WHERE len(nodes) > 1),
proofs AS (
    SELECT doc_id, list(CASE WHEN place % 2 = 1 THEN '<' || nodes[place] ELSE '>' || coalesce(nodes[place + 2], '') END
                        ORDER BY level) AS proof FROM paths GROUP BY doc_id),
found AS (
    SELECT l.doc_id, leaf, subroot, (SELECT nodes[1] FROM upper WHERE len(nodes) = 1) AS root,
           sha256(coalesce(list_aggregate(list_transform(proof, lambda s: s[2:]), 'string_agg', ''), '')) AS proof_sha256,
           list_reduce(list_concat([CASE WHEN crc % 7 = 0 THEN other ELSE leaf END], coalesce(proof, [])),
               lambda n, s: sha256(CASE WHEN s[1] = '<' THEN s[2:] || n ELSE n || s[2:] END)) AS folded_root
    FROM leaves l JOIN subroots ON subroots.lang IS NOT DISTINCT FROM l.lang LEFT JOIN proofs USING (doc_id))
SELECT *, folded_root = root AS verified FROM found"""
