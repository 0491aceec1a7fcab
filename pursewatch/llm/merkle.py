"""Merkle manifest of a dataset, with an Octopus multiproof for each partition of leaves."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from pursewatch.llm.common import stored

#: Levels that one task climbs at a time; a leaf partition holds the leaves below one node of it.
HEIGHT = 12
#: Partitions that may ask for one stored copy of a node are about 2 to the power of this.
ASKED = 10

NODES = "tree string, level int, index long, digest string, n long"
PROOF = "array<struct<left: boolean, digest: string>>"
#: The tree whose leaves are the roots of all others; their names begin with ``-`` or ``=``.
ROOTS = ""


def digest(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_digest(fields: Sequence[Column]) -> Column:
    """SHA-256 in lower-case hex of the fields, each ``-`` if null, else UTF-8 byte count, ``:``, value."""
    told = []
    for c in fields:
        text = c.cast("string")
        full = F.concat(F.octet_length(text).cast("string"), F.lit(":"), text)
        told.append(F.when(c.isNull(), F.lit("-")).otherwise(full))
    return F.sha2(F.concat(*told), 256)


@dataclass
class Forest:
    """Trees side by side. ``leaves`` has tree, position, n_leaves, digest and kept; ``nodes`` the
    inner nodes with their tree, level, index, digest and the number ``n`` of nodes on the level."""

    leaves: DataFrame
    nodes: DataFrame
    height: int

    def tops(self) -> DataFrame:
        """tree, digest: the root of every tree."""
        alone = self.leaves.where("n_leaves = 1").select("tree", "digest")
        return alone.unionByName(self.nodes.where("n = 1").select("tree", "digest"))


@dataclass
class Manifest:
    """``trees`` of the rows, ``roots`` over the trees' roots, and the digest of everything."""

    trees: Forest
    roots: Forest
    root: str | None


def _placed(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """The rows with their ``position`` in their tree and its ``n_leaves``.

    Rows are dealt into ranges of (tree, order) and sorted there; a place is the place in the range
    plus the rows of the tree in the ranges before, of which there is one count per range.
    """
    dealt = rows.withColumn("row", F.monotonically_increasing_id())
    dealt = dealt.repartitionByRange("tree", *order, "row").sortWithinPartitions("tree", *order, "row")
    laid = stored(dealt.withColumn("at", F.monotonically_increasing_id()).drop("row"), "ordered")
    # the number of the task is in the upper bits
    laid = laid.withColumn("range", F.shiftright("at", 33))
    own = laid.groupBy("tree", "range").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("held"))
    tree = Window.partitionBy("tree")
    before = tree.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    starts = own.select(
        "tree",
        "range",
        (F.coalesce(F.sum("held").over(before), F.lit(0)) - F.col("first")).alias("shift"),
        F.sum("held").over(tree).alias("n_leaves"),
    )
    placed = laid.join(stored(starts, "starts"), ["tree", "range"])
    return placed.withColumn("position", F.col("at") + F.col("shift")).drop("at", "range", "shift")


def _climber(level: int, height: int) -> Callable[[pa.Table], pa.Table]:
    """The nodes above a run of nodes that all lie below one node ``height`` levels higher."""

    def climb(table: pa.Table) -> pa.Table:
        table = table.sort_by("index")
        tree, first, n = (table.column(c)[0].as_py() for c in ("tree", "index", "n"))
        below = table.column("digest").to_pylist()
        out = []
        for k in range(level + 1, level + height + 1):
            if n == 1:
                break
            below = [digest("".join(below[i : i + 2])) for i in range(0, len(below), 2)]
            first, n = first >> 1, (n + 1) // 2
            size = len(below)
            out.append(
                pa.table(
                    {
                        "tree": pa.array([tree] * size, pa.string()),
                        "level": pa.array([k] * size, pa.int32()),
                        "index": pa.array(range(first, first + size), pa.int64()),
                        "digest": pa.array(below, pa.string()),
                        "n": pa.array([n] * size, pa.int64()),
                    }
                )
            )
        return pa.concat_tables(out)

    return climb


def _grown(leaves: DataFrame, height: int) -> Forest:
    """Every inner node, ``height`` levels a round; a round's rows are 2**height times fewer."""
    most = leaves.agg(F.max("n_leaves")).first()[0] or 0
    now = leaves.select("tree", F.col("position").alias("index"), "digest", F.col("n_leaves").alias("n"))
    level, rounds = 0, []
    while most > 1 or not rounds:
        below = now.where("n > 1").groupBy("tree", F.shiftright("index", height).alias("block"))
        rounds.append(stored(below.applyInArrow(_climber(level, height), NODES), "nodes"))
        level += height
        now = rounds[-1].where(F.col("level") == level)
        most = -(-most // 2**height)
    return Forest(leaves, reduce(DataFrame.unionByName, rounds), height)


def build(
    docs: DataFrame,
    fields: Sequence[str],
    group_col: str,
    id_col: str,
    keep: Mapping[str, Column] | None = None,
    height: int = HEIGHT,
) -> Manifest:
    """One tree per value of ``group_col`` over its rows by ``id_col``, and one over their roots.

    A row's leaf is ``leaf_digest`` of its ``fields``. Every two consecutive nodes become the
    digest of their digests' text, a last one alone that of its own. Trees are ordered by their
    value, null first, then by UTF-8 bytes; leaves by id, null first, then by digest. ``keep`` adds
    named values to each leaf. Rows that are repeated are leaves of their own; an empty table has
    no trees and the root None. Only the root reaches the driver.
    """
    kept = [c.alias(name) for name, c in (keep or {}).items()]
    rows = docs.select(
        F.coalesce(F.concat(F.lit("="), F.col(group_col).cast("string")), F.lit("-")).alias("tree"),
        F.col(id_col).alias("id"),
        leaf_digest([F.col(c) for c in fields]).alias("digest"),
        (F.struct(*kept) if kept else F.lit(None).cast("boolean")).alias("kept"),
    )
    leaves = stored(_placed(stored(rows, "leaves"), ["id", "digest"]), "placed")
    trees = _grown(leaves, height)
    named = trees.tops().select(F.lit(ROOTS).alias("tree"), F.col("tree").alias("id"), "digest")
    named = named.withColumn("kept", F.lit(None).cast("boolean"))
    roots = _grown(stored(_placed(stored(named, "tops"), ["id"]), "placed"), height)
    root = roots.tops().first()
    return Manifest(trees, roots, root.digest if root else None)


def missing(places: np.ndarray, n: int) -> list[tuple[int, np.ndarray]]:
    """Per level the nodes that leaves at ``places`` of ``n`` need and do not derive themselves.

    On each level these are the siblings that are no ancestor of one of the leaves: the smallest
    set from which the proofs of all of them can be made (Ramabaja and Avdullahu, 2020).
    """
    out, level, known = [], 0, np.unique(places)
    while n > 1:
        beside = known ^ 1
        out.append((level, beside[(beside < n) & ~np.isin(beside, known, assume_unique=True)]))
        known, n, level = np.unique(known >> 1), (n + 1) // 2, level + 1
    return out


def _ask(table: pa.Table) -> pa.Table:
    tree, block = table.column("tree")[0], table.column("block")[0]
    n = table.column("n_leaves")[0].as_py()
    needs = missing(table.column("position").to_numpy(), n)
    index = np.concatenate([i for _, i in needs]) if needs else np.zeros(0, np.int64)
    level = np.repeat([k for k, _ in needs], [len(i) for _, i in needs]) if needs else index
    return pa.table(
        {
            "tree": pa.array([tree.as_py()] * len(index), pa.string()),
            "block": pa.array([block.as_py()] * len(index), pa.int64()),
            "level": pa.array(level, pa.int32()),
            "index": pa.array(index, pa.int64()),
        }
    )


def _copies(height: int) -> Column:
    """How many copies of a node are held, by its level: so that few partitions ask for each."""
    return F.pow(F.lit(2), F.greatest(F.col("level") - (height + ASKED), F.lit(0))).cast("long")


def _expander(columns: Sequence[str]) -> Callable[[pa.Table, pa.Table], pa.Table]:
    """Proofs of a partition's leaves, from the leaves and the nodes that were fetched for them."""

    def expand(leaves: pa.Table, fetched: pa.Table) -> pa.Table:
        place = leaves.column("position").to_pylist()
        n = leaves.column("n_leaves")[0].as_py()
        nodes: dict[tuple[int, int], str] = {}
        above: list[dict] = []
        for level, index, text, path in zip(
            *(fetched.column(c).to_pylist() for c in ("level", "index", "digest", "path")), strict=True
        ):
            if level < 0:
                above = path
            else:
                nodes[level, index] = text
        nodes.update(((0, p), d) for p, d in zip(place, leaves.column("digest").to_pylist(), strict=True))
        sizes = [n]
        while sizes[-1] > 1:
            sizes.append((sizes[-1] + 1) // 2)
        known = set(place)
        for k, size in enumerate(sizes[:-1]):
            known = {i >> 1 for i in known}
            for i in known:
                both = [nodes[k, j] for j in (2 * i, 2 * i + 1) if j < size]
                nodes[k + 1, i] = digest("".join(both))
        left, beside = [], []
        for p in place:
            for k, size in enumerate(sizes[:-1]):
                i = p >> k
                left.append(i & 1 == 1)
                beside.append(nodes[k, i ^ 1] if i ^ 1 < size else None)
            left += [s["left"] for s in above]
            beside += [s["digest"] for s in above]
        each = len(sizes) - 1 + len(above)
        steps = pa.StructArray.from_arrays([pa.array(left, pa.bool_()), pa.array(beside, pa.string())], ["left", "digest"])
        proof = pa.ListArray.from_arrays(pa.array(np.arange(len(place) + 1) * each, pa.int32()), steps)
        out = leaves.select(list(columns))
        top = pa.array([nodes[len(sizes) - 1, 0]] * len(place), pa.string())
        return out.append_column("top", top).append_column("proof", proof)

    return expand


def _proved(forest: Forest, wanted: DataFrame, above: DataFrame | None) -> DataFrame:
    """``wanted`` leaves with ``top`` and ``proof``; ``above`` has tree and path, how proofs go on."""
    h = forest.height
    rows = wanted.withColumn("block", F.shiftright("position", h))
    places = rows.select("tree", "block", "position", "n_leaves")
    asked = places.groupBy("tree", "block").applyInArrow(_ask, "tree string, block long, level int, index long")
    copies = _copies(h)
    asked = stored(asked.withColumn("copy", F.col("block") % copies), "asked")
    # as many as a tree has levels at most
    levels = [r.level for r in asked.select("level").distinct().collect()]
    given = forest.nodes.where(F.col("level").isin(levels)).drop("n")
    if 0 in levels:
        ground = forest.leaves.select("tree", F.lit(0).alias("level"), F.col("position").alias("index"), "digest")
        given = given.unionByName(ground)
    given = given.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), copies - 1)))
    fetched = asked.join(given, ["tree", "level", "index", "copy"])
    fetched = fetched.select("tree", "block", "level", "index", "digest", F.lit(None).cast(PROOF).alias("path"))
    if above is not None:
        # a path per partition; a tree of many has as many copies of it as its partitions need
        shares = F.shiftright("n_leaves", h + ASKED) + 1
        blocks = rows.select("tree", "block", "n_leaves").distinct().withColumn("share", F.col("block") % shares)
        sizes = blocks.select("tree", "share").distinct()
        paths = blocks.join(sizes.join(above, "tree"), ["tree", "share"])
        none = F.lit(None)
        paths = paths.select(
            "tree", "block", F.lit(-1).alias("level"), none.cast("long").alias("index"), none.cast("string").alias("digest"), "path"
        )
        fetched = fetched.unionByName(paths)
    columns = [c for c in wanted.columns if c != "n_leaves"]
    schema = wanted.select(*columns, F.lit("").alias("top"), F.lit(None).cast(PROOF).alias("proof")).schema
    by = ("tree", "block")
    return rows.groupBy(*by).cogroup(fetched.groupBy(*by)).applyInArrow(_expander(columns), schema)


def prove(manifest: Manifest, wanted: DataFrame | None = None) -> DataFrame:
    """Proofs of the manifest's leaves, or of those of its leaves that ``wanted`` holds.

    Returns tree, position, id, digest, kept, top (the root of the leaf's tree) and proof: from the
    leaf to the manifest's root the node beside, null where there is none, and whether it is the
    left one. ``fold`` leads from a leaf and its proof to the root.

    Leaves are taken in partitions below one node. Each first finds from its leaves' places alone
    which nodes it will miss; these are fetched in one join; inner nodes that its leaves share are
    derived once, and the single proofs are read off them. Nodes near a root, which all partitions
    ask for, are held in copies, so that no key of the join has more than about 2**``ASKED`` rows.
    """
    tops = _proved(manifest.roots, manifest.roots.leaves, None)
    above = stored(tops.select(F.col("id").alias("tree"), F.col("proof").alias("path")), "paths")
    return _proved(manifest.trees, manifest.trees.leaves if wanted is None else wanted, above)


def fold(leaf: Column, proof: Column) -> Column:
    """The root that a leaf's digest and a proof lead to."""

    def step(own: Column, s: Column) -> Column:
        beside = F.coalesce(s["digest"], F.lit(""))
        return F.sha2(F.when(s["left"], F.concat(beside, own)).otherwise(F.concat(own, beside)), 256)

    return F.aggregate(proof, leaf, step)


def proof_digest(proof: Column) -> Column:
    """Digest of a proof's nodes from leaf to root, as one text."""
    return F.sha2(F.array_join(F.transform(proof, lambda s: s["digest"]), ""), 256)
