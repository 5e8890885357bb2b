"""Merkle manifest of a dataset: a tree per language, a tree of their roots, and proofs from octopus multiproofs.

Leaves of a group are numbered in their order and dealt in blocks of 2^`height` places. A block's subtree is made in its task; the
levels above are made by the same step over the blocks' nodes, so a step never sees more than one block. For proofs, each
block names the nodes that its leaves need and can't be derived from them (their minimal union, an octopus multiproof),
gets them in one join, derives all shared inner nodes, and expands the proof of each leaf by itself.
"""
from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F, types as T

from .common import column, cut
from ..sources.sinks import stage

HEIGHT = 14


def field(value: Column) -> Column:
    """A value as the leaves have it: `-` if null, else its length in UTF-8 bytes, `:`, and the value."""
    text = value.cast("string")
    return F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(*values: Column) -> Column:
    """Lower-case hex SHA-256 of the values one after the other."""
    return F.sha2(F.concat(*map(field, values)).cast("binary"), 256)


def above(*digests: str) -> str:
    """The node over one or two nodes."""
    return hashlib.sha256("".join(digests).encode()).hexdigest()


def levels_of(count: int) -> int:
    """Levels above the leaves of a tree of `count` leaves."""
    return max(0, count - 1).bit_length()


def subtree(digests: list[str], levels: int) -> list[list[str]]:
    """All levels over consecutive leaves that begin at a multiple of 2^`levels`; a last node without a neighbour goes up alone."""
    out = [digests]
    for _ in range(levels):
        below = out[-1]
        out.append([above(*below[i:i + 2]) for i in range(0, len(below), 2)])
    return out


def missing(places: np.ndarray, count: int) -> list[tuple[int, int]]:
    """The least set of nodes (level, place) that proofs of the leaves at `places` need beside what they give themselves."""
    at, out, level = np.unique(places), [], 0
    while count > 1:
        beside = np.setdiff1d(at ^ 1, at, assume_unique=True)
        out += [(level, int(i)) for i in beside if i < count]
        at, count, level = np.unique(at >> 1), -(-count // 2), level + 1
    return out


def numbered(leaves: DataFrame, order: list[str]) -> DataFrame:
    """`leaves` (with `tree`, a string) with `place`: numbers from 0 within a tree, by `order`, nulls first.

    Rows are sorted in ranges over all tasks. Each range tells the driver only how many rows it has of its first tree and
    of its last one, so a tree of any size is numbered without a task that holds it.
    """
    spark = leaves.sparkSession
    ranged = cut(leaves.repartitionByRange("tree", *order).sortWithinPartitions("tree", *order))

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first = last = None
        n_first = n_last = 0
        for batch in batches:
            trees = batch.column("tree").dictionary_encode()
            for name, n in zip(trees.dictionary.to_pylist(), np.bincount(trees.indices.to_numpy(), minlength=len(trees.dictionary)).tolist()):
                first = name if first is None else first
                n_first += n if name == first else 0
                last, n_last = name, (n_last + n if name == last else n)
        if first is not None:
            yield pa.RecordBatch.from_arrays([pa.array([TaskContext.get().partitionId()]), pa.array([first]), pa.array([n_first]),
                                              pa.array([last]), pa.array([n_last])], ["part", "first", "n_first", "last", "n_last"])

    rows = sorted(ranged.select("tree").mapInArrow(ends, "part long, first string, n_first long, last string, n_last long").collect())
    before, tree, so_far = {}, None, 0
    for part, first, n_first, last, n_last in rows:
        before[part] = so_far if first == tree else 0
        so_far = before[part] + n_first if last == first else n_last
        tree = last
    at = ranged.columns.index("tree")

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, place = None, before.get(TaskContext.get().partitionId(), 0)
        for batch in batches:
            places = []
            for name in batch.column(at).to_pylist():
                if tree is not None and name != tree:
                    place = 0
                tree = name
                places.append(place)
                place += 1
            yield batch.append_column("place", pa.array(places, pa.int64()))

    return ranged.mapInArrow(number, T.StructType(ranged.schema.fields + [T.StructField("place", T.LongType())]))


NODES = "tree string, level int, place long, digest string"


def _step(low: int, height: int) -> Callable[[pa.Table], pa.Table]:
    """Nodes above those of level `low` in one block."""
    def run(table: pa.Table) -> pa.Table:
        place = table.column("place").to_numpy()
        order = np.argsort(place)
        digests, first = table.column("digest").take(pa.array(order)).to_pylist(), int(place[order[0]])
        # Only the first block of a tree may be its last one too, and then its top is the root.
        made = subtree(digests, height if first or len(digests) == 1 << height else levels_of(len(digests)))
        # What lies below the tops of the first blocks is made again where it is needed.
        shown = [(low + k, (first >> k) + i, d) for k, nodes in enumerate(made) if (k if low else k == len(made) - 1)
                 for i, d in enumerate(nodes)]
        columns = list(zip(*shown)) if shown else [()] * 3
        return pa.table([pa.array([table.column("tree")[0].as_py()] * len(shown), pa.string()),
                         *[pa.array(c, k) for c, k in zip(columns, (pa.int32(), pa.int64(), pa.string()))]],
                        names=["tree", "level", "place", "digest"])
    return run


def upper_nodes(leaves: DataFrame, most: int, height: int = HEIGHT) -> DataFrame:
    """`tree`, `level`, `place`, `digest` of the nodes at the top of every block and of all above them, roots included.

    `leaves` has `tree`, `place` and `digest`; the largest tree has `most` of them. One step for every `height` levels: three
    steps make a tree of four million million leaves.
    """
    now, parts = leaves.select("tree", "place", "digest"), []
    for low in range(0, max(1, levels_of(most)), height):
        blocks = now.groupBy("tree", F.shiftright("place", height))
        parts.append(stage(leaves.sparkSession, blocks.applyInArrow(_step(low, height), NODES), "nodes"))
        now = parts[-1].where(F.col("level") == low + height).select("tree", "place", "digest")
    out = parts[0]
    for more in parts[1:]:
        out = out.unionByName(more)
    return out


def _up(node: str, beside: tuple[str | None, bool]) -> str:
    """The node above one whose neighbour, if any, lies to the right or not."""
    other, right = beside
    return above(node) if other is None else above(node, other) if right else above(other, node)


def prove(leaves: DataFrame, nodes: DataFrame, sizes: DataFrame, tops: DataFrame | None = None, height: int = HEIGHT,
          siblings: bool = True) -> DataFrame:
    """Proofs of `leaves` (`id`, `tree`, `place`, `digest`, `changed`): `id`, `tree`, `place`, `leaf`, and

    `subroot`, the root of the tree; `root`, that of the tree of trees; `proof_sha256`, the digest of the siblings from the
    leaf to the root one after the other, and if asked for `siblings`, these themselves; `folded_root`, what `changed` (or, if
    null, the leaf) and the siblings give; `verified`, whether that is the root.

    `nodes` are those of `upper_nodes`, `sizes` has `tree` and `n`. `tops` has for each tree its `place` among `n` trees and the
    `siblings` of its root; without it the trees stand alone.
    """
    known = leaves.schema["id"]
    fields = [("id", known.dataType), ("tree", T.StringType()), ("place", T.LongType())]
    fields += [(c, T.StringType()) for c in ("leaf", "subroot", "root", "proof_sha256", "folded_root")] + [("verified", T.BooleanType())]
    fields += [("siblings", T.ArrayType(T.StringType()))] if siblings else []
    blocks = sizes.select("tree", "n", F.explode(F.sequence(F.lit(0).cast("long"), F.shiftright(F.col("n") - 1, height))).alias("block"))

    def name_missing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [(tree, block, *node) for tree, n, block in zip(*[batch.column(c).to_pylist() for c in ("tree", "n", "block")])
                    for node in missing(np.arange(block << height, min(n, block + 1 << height)), n)]
            columns = list(zip(*rows)) if rows else [()] * 4
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, (pa.string(), pa.int64(), pa.int32(), pa.int64()))],
                                             ["tree", "block", "level", "place"])

    asked = blocks.mapInArrow(name_missing, "tree string, block long, level int, place long")
    given = (asked.join(nodes, ["tree", "level", "place"]).groupBy("tree", "block")
             .agg(F.collect_list(F.struct("level", "place", "digest")).alias("given")))
    if tops is None:
        top = [F.lit(0).cast("long").alias("at"), F.lit(1).cast("long").alias("among"), F.array().cast("array<string>").alias("top")]
        each = blocks.select("*", *top)
    else:
        each = blocks.join(tops.select("tree", F.col("place").alias("at"), F.col("n").alias("among"), F.col("siblings").alias("top")), "tree")
    each = each.join(given, ["tree", "block"], "left")

    def expand(left: pa.Table, right: pa.Table) -> pa.Table:
        n, block, at, among, top, got = (right.column(c)[0].as_py() for c in ("n", "block", "at", "among", "top", "given"))
        fetched = {(g["level"], g["place"]): g["digest"] for g in got or []}
        left = left.take(pa.array(np.argsort(left.column("place").to_numpy())))
        digests, changed = left.column("digest").to_pylist(), left.column("changed").to_pylist()
        local = subtree(digests, min(height, levels_of(n)))
        # The way from the block's top to the root is the same for all its leaves and derived once.
        level = len(local) - 1
        path: list[tuple[str | None, bool]] = []
        place, count = block, -(-n // (1 << level))
        while count > 1:
            path.append((fetched[level, place ^ 1] if place ^ 1 < count else None, place % 2 == 0))
            place, count, level = place >> 1, -(-count // 2), level + 1
        node = local[-1][0]
        for step in path:
            node = _up(node, step)
        subroot, rest = node, iter(top)
        while among > 1:
            path.append((next(rest) if at ^ 1 < among else None, at % 2 == 0))
            node = _up(node, path[-1])
            at, among = at >> 1, -(-among // 2)
        shared = [s for s, _ in path if s is not None]
        tail = "".join(shared)
        proofs, folded, lists = [], [], []
        for i, other in enumerate(changed):
            own = []
            for k, row in enumerate(local[:-1]):
                beside = i >> k ^ 1
                own.append((row[beside] if beside < len(row) else None, beside % 2 == 1))
            told = [s for s, _ in own if s is not None]
            proofs.append(hashlib.sha256(("".join(told) + tail).encode()).hexdigest())
            if other is not None:
                for step in own + path:
                    other = _up(other, step)
            folded.append(node if other is None else other)
            if siblings:
                lists.append(told + shared)
        k = len(digests)
        arrays = [left.column(c) for c in ("id", "tree", "place", "digest")]
        arrays += [pa.array(c, pa.string()) for c in ([subroot] * k, [node] * k, proofs, folded)] + [pa.array([f == node for f in folded], pa.bool_())]
        arrays += [pa.array(lists, pa.list_(pa.string()))] if siblings else []
        return pa.table(arrays, names=[f[0] for f in fields])

    own = leaves.select("id", "tree", "place", "digest", "changed", F.shiftright("place", height).alias("block"))
    return own.groupBy("tree", "block").cogroup(each.groupBy("tree", "block")).applyInArrow(
        expand, T.StructType([T.StructField(*f) for f in fields]))


def manifest(docs: DataFrame, fields: tuple[str, ...] = ("doc_id", "source", "lang", "n_chars", "text"), changed: dict[str, Column] | None = None,
             tree_col: str = "lang", id_col: str = "doc_id", height: int = HEIGHT, siblings: bool = True) -> DataFrame:
    """A proof for each row of `docs`: `id`, `tree` (`=` and the value of `tree_col`, empty if null), and the columns of `prove`.

    A leaf is the digest of `fields`, the leaves of a tree ascend by id (nulls first, equal ids by digest), the trees by their value
    (null first, by bytes). `changed` has other values for some fields, as expressions: where they make another leaf, its path is
    folded in place of the original's. Repeated rows are leaves of their own. Null and empty texts differ; a very long text
    is one value of a task and is not shuffled, only digests are. An empty table gives an empty table; other columns are
    not looked at. Apart from counts of ranges and trees nothing goes through the driver.
    """
    values = {c: column(c) for c in fields}
    digest = leaf(*values.values())
    other = F.lit(None).cast("string")
    if changed:
        touched = F.lit(False)
        for c, new in changed.items():
            touched = touched | ~new.eqNullSafe(values[c])
        other = F.when(touched, leaf(*(values | changed).values()))
    name = F.when(column(tree_col).isNull(), "").otherwise(F.concat(F.lit("="), column(tree_col).cast("string")))
    made = docs.select(column(id_col).alias("id"), name.alias("tree"), digest.alias("digest"), other.alias("changed"),
                       F.monotonically_increasing_id().alias("salt"))
    leaves = numbered(made, ["id", "digest", "salt"])
    nodes, sizes = _top(leaves, height)
    roots = nodes.join(sizes, "tree").where((F.col("place") == 0) & (F.col("level") == _levels("n"))).select("tree", "digest")
    trees = numbered(roots.select(F.lit("").alias("tree"), F.col("tree").alias("id"), "digest", F.lit(None).cast("string").alias("changed")), ["id"])
    upper, one = _top(trees, height)
    tops = prove(trees, upper, one, height=height).join(one, "tree").select(F.col("id").alias("tree"), "place", "n", "siblings")
    return prove(leaves, nodes, sizes, stage(docs.sparkSession, tops, "tops"), height, siblings)


def _levels(n: str) -> Column:
    """Levels above the leaves, exactly: the digits of n - 1 in base two."""
    return F.when(F.col(n) <= 1, 0).otherwise(F.length(F.bin(F.col(n) - 1)))


def _top(leaves: DataFrame, height: int) -> tuple[DataFrame, DataFrame]:
    sizes = stage(leaves.sparkSession, leaves.groupBy("tree").agg(F.count("*").alias("n")), "sizes")
    return upper_nodes(leaves, sizes.agg(F.max("n")).first()[0] or 0, height), sizes
