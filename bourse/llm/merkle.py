"""Merkle manifest of a dataset by cogrouped subtree exchange.

Every row is a leaf: the SHA-256 of its fields, each ``-`` if null, else its
byte count, ``:`` and its value. Leaves of a group (a language) stand in the
order of their id; while a group has several nodes, every two consecutive ones
(the last may stand alone) become the hash of their hex digests. The groups'
roots, ordered by group, null first, make a tree of the same kind above them.

Positions come from a range partitioning of the leaves, written down with the
partition of each row, and one count for each partition and group, so that no
group is ordered in one task. A superblock is a run of 2**LEVELS nodes of one
tree. Climbing, each superblock is reduced to one node by itself, round after
round, until every tree has one. Descending, the nodes of a superblock meet the
outer nodes they need (the siblings on the way from their superblock to the
root) in one cogroup, where the local reduction is finished, proofs are joined
and the observed leaves folded with the original siblings. A task holds one
superblock, however large a group is; rounds grow with the logarithm of the
largest tree.

Results for odd rows: null fields hash as ``-``; a null id stands first in its
group and is never tampered with by the query; rows that repeat an id follow
the order of their digests; equal rows are leaves each; a single row is its own
root and its proof the hash of nothing; an empty table gives an empty table;
columns that are no field are not read.
"""

from __future__ import annotations

from collections.abc import Sequence
from hashlib import sha256

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import stage, unstage

#: Levels of a superblock: a task holds up to 2**LEVELS nodes.
LEVELS = 9
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(values: Sequence[Column]) -> Column:
    """The leaf of a row's fields."""
    def written(value: Column) -> Column:
        s = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(s).cast("string"), F.lit(":"), s), F.lit("-"))

    return F.sha2(F.concat(*map(written, values)), 256)


def leaves(df: DataFrame, fields: Sequence[str], id_col: str, group_col: str, observed: dict[str, Column]) -> DataFrame:
    """``id grp leaf seen``; ``seen`` is the leaf of the observed row where an
    observed field differs, else null."""
    changed = F.lit(False)
    for name, value in observed.items():
        changed = changed | ~value.eqNullSafe(F.col(name))
    seen = F.when(changed, digest([observed.get(f, F.col(f)) for f in fields]))
    return df.select(F.col(id_col).alias("id"), F.col(group_col).alias("grp"), digest([F.col(f) for f in fields]).alias("leaf"), seen.alias("seen"))


def _in_order(df: DataFrame, order: Sequence[str], name: str) -> DataFrame:
    """``df`` range-partitioned and sorted, with each row's partition ``part``
    and its place ``at`` in it, as written down."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [F.col(c).asc_nulls_first() for c in order]
    part = F.spark_partition_id()
    rows = df.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
    return stage(rows.select("*", part.alias("part"), (F.monotonically_increasing_id() - F.shiftleft(part.cast("long"), 33)).alias("at")), name)


def _positions(ordered: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of rows in the order of ``grp`` and then others: ``grp tree size``, the
    groups numbered in order, and the nodes ``tree pos size`` with the rows'
    columns, the id as text, which pandas leaves as it is. The windows see one row
    for each partition (and group)."""
    runs = ordered.groupBy("part", "grp").agg(F.count("*").alias("n"), F.min("at").alias("first"))
    earlier = Window.partitionBy("grp").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    runs = stage(runs.select("part", "grp", "n", (F.coalesce(F.sum("n").over(earlier), F.lit(0)) - F.col("first")).alias("shift")), "merkle-runs")
    groups = _in_order(runs.groupBy("grp").agg(F.sum("n").alias("size")), ["grp"], "merkle-groups")
    sizes = groups.groupBy("part").agg(F.count("*").alias("n"))
    before = sizes.select("part", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"))
    trees = stage(groups.join(before, "part").select("grp", (F.col("before") + F.col("at")).alias("tree"), "size"), "merkle-trees")
    unstage(groups)
    runs = runs.join(trees.withColumnRenamed("grp", "g"), F.col("grp").eqNullSafe(F.col("g"))).select(F.col("part").alias("p"), F.col("grp").alias("g"), "shift", "tree", "size")
    rows = ordered.join(runs, (F.col("part") == F.col("p")) & F.col("grp").eqNullSafe(F.col("g")))
    return trees, rows.select("tree", (F.col("at") + F.col("shift")).alias("pos"), "size", F.col("id").cast("string").alias("id"), F.col("leaf").alias("digest"), "seen")


def _h(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def _reduce(nodes: list[str], size: int, bits: int) -> list[list[str]]:
    """The levels of a superblock of a tree of ``size`` nodes, from its nodes
    to the one that stands for it."""
    levels, left = [nodes], bits if size > 1 << bits else (size - 1).bit_length()
    for _ in range(left):
        nodes = [_h("".join(nodes[i:i + 2])) for i in range(0, len(nodes), 2)]
        levels.append(nodes)
    return levels


def _paths(levels: list[list[str]], outer: str) -> list[str]:
    """For each node the way up: per level ``L`` or ``R`` and the sibling on
    that side, or ``-``, joined by commas."""
    out = [[] for _ in levels[0]]
    for k, nodes in enumerate(levels[:-1]):
        for i, path in enumerate(out):
            j = (i >> k) ^ 1
            path.append("-" if j >= len(nodes) else ("L" if j & 1 == 0 else "R") + nodes[j])
    return [",".join(path + [outer] if outer else path) for path in out]


def proof(path: str) -> str:
    """The hash of a path's siblings."""
    return _h(path.translate({ord(c): None for c in "LR-,"}))


def fold(leaf: str, path: str) -> str:
    """The root that a leaf gives with its siblings."""
    for step in path.split(",") if path else ():
        leaf = _h(step[1:] + leaf if step[0] == "L" else leaf + step[1:])
    return leaf


_NODE = "tree long, pos long, size long, digest string"
_OUTER = "tree long, pos long, path string, subroot string, root string"


def _block(df: DataFrame, bits: int) -> DataFrame:
    return df.withColumn("block", F.shiftright("pos", bits))


def _climb(nodes: DataFrame, largest: int, bits: int) -> list[DataFrame]:
    """The nodes (staged), then the superblocks' nodes, and so on until every
    tree has one node."""
    def reduce(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("pos")
        tree, pos, size = (int(pdf[c].iat[0]) for c in ("tree", "pos", "size"))
        top = _reduce(pdf["digest"].tolist(), size, bits)[-1][0]
        return pd.DataFrame({"tree": [tree], "pos": [pos >> bits], "size": [((size - 1) >> bits) + 1], "digest": [top]})

    levels = [nodes]
    while largest > 1:
        below = _block(levels[-1].select("tree", "pos", "size", "digest"), bits)
        levels.append(stage(below.groupBy("tree", "block").applyInPandas(reduce, _NODE), "merkle-level"))
        largest = ((largest - 1) >> bits) + 1
    return levels


def _meet(below: DataFrame, outer: DataFrame, finish, schema: str, bits: int) -> DataFrame:
    """Superblocks of nodes cogrouped with their outer nodes; ``finish`` makes
    the rows of one superblock from its nodes, their paths and the outer row."""
    def join(nodes: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        nodes = nodes.sort_values("pos")
        top = above.iloc[0]
        paths = _paths(_reduce(nodes["digest"].tolist(), int(nodes["size"].iat[0]), bits), top["path"])
        return finish(nodes, paths, top["subroot"], top["root"])

    outer = outer.withColumnRenamed("pos", "block")
    return _block(below, bits).groupBy("tree", "block").cogroup(outer.groupBy("tree", "block")).applyInPandas(join, schema)


def _descend(levels: list[DataFrame], outer: DataFrame, bits: int) -> DataFrame:
    """The outer nodes of every superblock of the lowest level."""
    def ways(nodes, paths, subroot, root):
        return pd.DataFrame({"tree": nodes["tree"], "pos": nodes["pos"], "path": paths, "subroot": subroot, "root": root})

    for below in reversed(levels[1:-1]):
        outer = stage(_meet(below, outer, ways, _OUTER, bits), "merkle-outer")
    return outer


def manifest(df: DataFrame, fields: Sequence[str] = FIELDS, id_col: str = "doc_id", group_col: str = "lang", observed: dict[str, Column] | None = None,
             levels: int = LEVELS) -> DataFrame:
    """``doc_id leaf subroot root proof_sha256 folded_root verified`` per row.

    ``observed`` gives fields as they are found now: such a row's leaf is
    folded with the original siblings, and is verified where that leads to the
    root. Without it every row is folded as it is."""
    kind = dict(df.dtypes)[id_col]
    raw = stage(leaves(df, fields, id_col, group_col, observed or {}), "merkle-leaves")
    ordered = _in_order(raw, ["grp", "id", "leaf"], "merkle-order")
    unstage(raw)
    trees, nodes = _positions(ordered)
    nodes = stage(nodes, "merkle-nodes")
    unstage(ordered)
    count, largest = trees.agg(F.count("*"), F.coalesce(F.max("size"), F.lit(0))).first()
    inner = _climb(nodes, largest, levels)

    # the groups' roots are the nodes of the tree above
    subroots = inner[-1].select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("pos"), F.lit(count).cast("long").alias("size"), "digest")
    upper = _climb(stage(subroots, "merkle-subroots"), count, levels)
    top = upper[-1].select("tree", "pos", F.lit("").alias("path"), F.lit("").alias("subroot"), F.col("digest").alias("root"))

    def of_trees(nodes, paths, _, root):
        return pd.DataFrame({"tree": nodes["pos"], "pos": 0, "path": paths, "subroot": nodes["digest"], "root": root})

    outer = stage(_meet(upper[0], _descend(upper, top, levels), of_trees, _OUTER, levels), "merkle-outer")

    def of_leaves(nodes, paths, subroot, root):
        folded = [fold(leaf if seen is None else seen, path) for leaf, seen, path in zip(nodes["digest"], nodes["seen"], paths)]
        return pd.DataFrame({"doc_id": nodes["id"], "leaf": nodes["digest"], "subroot": subroot, "root": root, "proof_sha256": list(map(proof, paths)),
                             "folded_root": folded, "verified": [f == root for f in folded]})

    out = _meet(inner[0], _descend(inner, outer, levels), of_leaves, "doc_id string, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean", levels)
    return out.withColumn("doc_id", F.col("doc_id").cast(kind))
