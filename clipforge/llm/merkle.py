"""Merkle manifest of a table: a leaf per row, a tree per source, a tree over the sources.

Every 16 consecutive nodes become their hash until one is left. The tree is held as
aligned blocks of 16 ** 3 leaves: one task hashes the levels inside a block, the block
roots are the leaves of the next, 4,096 times smaller table, which is cut into blocks
again, until each source has one node; the sources' nodes make one more such tree. So
neither a hot source nor the whole tree is ever held by one task or the driver.

On the way down each block learns the path from its root to the root of the table: for
every level the siblings to the left and to the right. A changed leaf makes a version of
the tree that shares every untouched node: its task copies the three ancestors inside the
block only, and the version goes on through the copied upper levels, down to a new root.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from clipforge.llm.common import broadcast_if_small, stored
from clipforge.operators.ordering import positions

FANOUT = 16
#: Levels that one task hashes at once: a block has FANOUT ** LEVELS leaves.
LEVELS = 3

PATH = "array<struct<before: string, after: string>>"
_PATH = pa.list_(pa.struct([("before", pa.string()), ("after", pa.string())]))


def node_hash(*parts: str) -> str:
    """Lowercase hex SHA-256 of the concatenated parts."""
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_hash(*columns: Column) -> Column:
    """The hash of a row: each value with its UTF-8 byte count before it, ``-`` for null."""
    part = lambda c: F.coalesce(F.concat(F.octet_length(c.cast("string")).cast("string"), F.lit(":"), c.cast("string")), F.lit("-"))
    return F.sha2(F.concat(*[part(c) for c in columns]), 256)


def _block_levels(nodes: list[str], total: int) -> list[list[str]]:
    """The levels of a block, its leaves first and its root last. The only block of a tree
    ends with the first single node; a block among others always has all its levels."""
    levels = [nodes]
    alone = total <= FANOUT ** LEVELS
    while len(levels) <= LEVELS and not (alone and len(levels[-1]) == 1):
        low = levels[-1]
        levels.append([node_hash(*low[i:i + FANOUT]) for i in range(0, len(low), FANOUT)])
    return levels


def _inner_path(levels: list[list[str]], at: int) -> list[tuple[str, str]]:
    """(siblings before, siblings after) per level from a block's leaf to the block's root."""
    path = []
    for level in levels[:-1]:
        run = at - at % FANOUT
        path.append(("".join(level[run:at]), "".join(level[at + 1:run + FANOUT])))
        at //= FANOUT
    return path


def _ordered(rows: pa.Table) -> pa.Table:
    return rows.sort_by("pos").combine_chunks()


def _root_of_block(rows: pa.Table) -> pa.Table:
    rows = _ordered(rows)
    root = _block_levels(rows["hash"].to_pylist(), rows["total"][0].as_py())[-1][0]
    return pa.table({"tree": rows["tree"][:1], "pos": rows["block"][:1], "total": rows["blocks"][:1], "hash": pa.array([root])})


def _paths(rows: pa.Table, above: pa.Table) -> pa.Table:
    """The whole path of every leaf of a block, from its block's path."""
    rows = _ordered(rows)
    levels = _block_levels(rows["hash"].to_pylist(), rows["total"][0].as_py())
    top = [(p["before"], p["after"]) for p in above["path"][0].as_py()]
    whole = [[{"before": b, "after": a} for b, a in _inner_path(levels, i) + top] for i in range(rows.num_rows)]
    return pa.table({"tree": rows["tree"], "pos": rows["pos"], "path": pa.array(whole, _PATH)})


def _prove(rows: pa.Table, above: pa.Table) -> pa.Table:
    """For every leaf of a block: the hash of its proof, and the root of the version in which
    only this leaf is replaced (by itself where nothing changed)."""
    rows = _ordered(rows)
    levels = _block_levels(rows["hash"].to_pylist(), rows["total"][0].as_py())
    top = [(p["before"], p["after"]) for p in above["path"][0].as_py()]
    upper = "".join(b + a for b, a in top)
    proofs, roots = [], []
    for i, (leaf, changed) in enumerate(zip(levels[0], rows["changed"].to_pylist(), strict=True)):
        inner = _inner_path(levels, i)
        proofs.append(node_hash(*(b + a for b, a in inner), upper))
        node = changed or leaf
        for before, after in inner:  # ancestors copied inside the block
            node = node_hash(before, node, after)
        for before, after in top:  # and above it
            node = node_hash(before, node, after)
        roots.append(node)
    n = rows.num_rows
    return pa.table({"doc_id": rows["doc_id"], "leaf": rows["hash"], "subroot": pa.array(above["subroot"].to_pylist() * n, pa.string()),
                     "proof_sha256": pa.array(proofs, pa.string()), "folded_root": pa.array(roots, pa.string())})


def _blocks(nodes: DataFrame) -> DataFrame:
    size = FANOUT ** LEVELS
    return (nodes.withColumn("block", F.expr(f"pos div {size}"))
            .withColumn("blocks", F.expr(f"(total + {size - 1}) div {size}")))


def _climb(nodes: DataFrame) -> list[DataFrame]:
    """The written tables of nodes of every block level: (tree, pos, total, hash), the last
    with one node per tree. The root of a tree of one block stays in the tables above it."""
    tables = [stored(nodes, "merkle_nodes")]
    while True:
        tables.append(stored(_blocks(tables[-1]).groupBy("tree", "block").applyInArrow(
            _root_of_block, "tree long, pos long, total long, hash string"), "merkle_nodes"))
        if tables[-1].where("total > 1").isEmpty():
            return tables


def _with_paths(nodes: DataFrame, above: DataFrame) -> DataFrame:
    """(tree, pos, path) of nodes, from the paths of their blocks' roots."""
    return (_blocks(nodes).groupBy("tree", "block").cogroup(above.withColumnRenamed("pos", "block").groupBy("tree", "block"))
            .applyInArrow(_paths, f"tree long, pos long, path {PATH}"))


def _descend(tables: list[DataFrame], paths: DataFrame) -> DataFrame:
    """(tree, pos, path) of the blocks of the lowest table, from the paths (tree, path) of the trees' roots."""
    found = paths.select("tree", F.lit(0).cast("long").alias("pos"), "path")
    for nodes in reversed(tables[1:-1]):
        found = stored(_with_paths(nodes, found), "merkle_paths")
    return found


def manifest(docs: DataFrame, tampered: Column, id_col: str = "doc_id", source: str = "source",
             columns: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"), text: str = "text") -> DataFrame:
    """doc_id, leaf, subroot, root, proof_sha256, folded_root, verified of every row.

    ``tampered`` marks the rows whose ``text`` is lower-cased (A-Z) for the version that only
    they change; all others fold their own leaf. ``verified`` is false exactly where the
    version's root differs. Leaves of a source ascend by id, null first; rows of the same
    source and id are ordered by their leaf, so the set of results does not depend on the
    layout of the input. A null source is a source of its own, before the others; an empty table gives
    no rows. Extra columns are ignored."""
    lowered = lambda c: F.translate(F.col(c), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz") if c == text else F.col(c)
    leaves = stored(docs.select(
        F.col(id_col).alias("doc_id"), F.col(source).alias("source"), leaf_hash(*[F.col(c) for c in columns]).alias("hash"),
        F.when(F.coalesce(tampered, F.lit(False)), leaf_hash(*[lowered(c) for c in columns])).alias("changed")), "merkle_leaves")

    sources = positions(leaves.groupBy("source").agg(F.count(F.lit(1)).alias("total")), ["source"], out_col="tree")
    sources = stored(sources.select(F.col("source").alias("_source"), F.col("tree").cast("long").alias("tree"), "total"), "merkle_sources")
    bound = sources.agg(F.coalesce(F.max(F.octet_length("_source")), F.lit(0))).first()[0] + 64  # names have any length
    of = leaves.join(broadcast_if_small(sources, bound), F.col("source").eqNullSafe(F.col("_source"))).drop("source", "_source")
    numbered = positions(of, ["doc_id", "hash", "changed"], ["tree"]).withColumn("pos", (F.col("pos") - 1).cast("long"))

    tables = _climb(numbered.select("tree", "pos", "total", "hash"))
    tops = _climb(tables[-1].select(F.lit(0).cast("long").alias("tree"), (F.col("tree") - 1).alias("pos"), F.lit(sources.count()).cast("long").alias("total"), "hash"))
    first = tops[-1].first()
    root = F.lit(first["hash"] if first else None).cast("string")

    above_sources = _descend(tops, tops[-1].select("tree", F.array().cast(PATH).alias("path")))
    of_source = stored(_with_paths(tops[0], above_sources), "merkle_paths")
    above = _descend(tables, of_source.select((F.col("pos") + 1).alias("tree"), "path"))
    above = above.join(tables[-1].select("tree", F.col("hash").alias("subroot")), "tree")

    proven = (_blocks(numbered).groupBy("tree", "block")
              .cogroup(above.withColumnRenamed("pos", "block").groupBy("tree", "block"))
              .applyInArrow(_prove, f"doc_id {docs.schema[id_col].dataType.simpleString()}, leaf string, subroot string, proof_sha256 string, folded_root string"))
    return proven.select("doc_id", "leaf", "subroot", root.alias("root"), "proof_sha256", "folded_root", F.col("folded_root").eqNullSafe(root).alias("verified"))
