"""Near copies among embeddings by sorted projection passes.

In each pass the vectors are ordered by the concatenated bits of random projections and each is compared with its
neighbours within a window; verified pairs of all passes are joined to components. The projections are cut at medians of
a sample, cell by cell, so that the cells of dense groups are as small as the others. Passes are added until the recall
against brute force on sampled rows meets the aim. The members of a component are compared block by block to count their links.
"""
from __future__ import annotations

import logging
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .ann import cosine, matrix, normed, usable
from .common import cut, mix, partitions
from .components import connected_components

BITS = 64
log = logging.getLogger(__name__)


def passes_for(count: int, window: int, least: float, miss: float = 1e-2) -> int:
    """Passes after which a pair at cosine `least` has been missed by all with probability `miss` or less.

    A pass finds it if the two agree in as many leading bits as spread evenly lying rows over windows.
    """
    agree = 1 - np.arccos(least) / np.pi
    prefix = max(1.0, np.log2(max(2, count) / window) + 1)
    return max(4, int(np.ceil(np.log(miss) / np.log1p(-(agree ** prefix)))))


def projections(dim: int, turn: int, seed: int) -> np.ndarray:
    return np.random.default_rng([seed, turn]).normal(size=(dim, BITS))


def thresholds(sample: np.ndarray, turn: int, seed: int, least: int = 8) -> tuple[list[np.ndarray], np.ndarray]:
    """Where to cut the projections: for each level of a tree the medians of its cells, as deep as the sample leaves
    `least` rows to a cell, and for the bits below the means of the last cells."""
    across = sample @ projections(sample.shape[1], turn, seed)
    depth = max(0, int(np.log2(max(1, len(sample)) / least)))
    cell, levels = np.zeros(len(sample), dtype=np.int64), []
    for level in range(depth):
        order = np.lexsort((across[:, level], cell))
        counts = np.bincount(cell, minlength=1 << level)
        at = np.minimum(np.cumsum(counts) - counts + counts // 2, len(sample) - 1)
        levels.append(np.where(counts > 0, across[order[at], level], 0.0))
        cell = cell * 2 + (across[:, level] >= levels[-1][cell])
    means = np.zeros((1 << depth, BITS - depth))
    np.add.at(means, cell, across[:, depth:])
    return levels, means / np.maximum(1, np.bincount(cell, minlength=1 << depth))[:, None]


def sort_keys(x: np.ndarray, turn: int, seed: int, cuts: tuple[list[np.ndarray], np.ndarray]) -> np.ndarray:
    """64 bits as one number that sorts lexicographically."""
    across, (levels, means) = x @ projections(x.shape[1], turn, seed), cuts
    cell, bits = np.zeros(len(x), dtype=np.int64), np.empty(across.shape, dtype=bool)
    for level, values in enumerate(levels):
        bits[:, level] = across[:, level] >= values[cell]
        cell = cell * 2 + bits[:, level]
    bits[:, len(levels):] = across[:, len(levels):] >= means[cell]
    return np.packbits(bits, axis=1, bitorder="big").view(">u8").ravel().astype(np.uint64)


def _join(root: np.ndarray, p: np.ndarray, q: np.ndarray) -> list[np.ndarray]:
    """Union the trees of the pairs (p, q); the pairs that joined two trees, which form a forest."""
    used = []
    while True:
        a, b = root[p], root[q]
        live = a != b
        if not live.any():
            return used
        p, q, a, b = p[live], q[live], a[live], b[live]
        # Every larger root goes below a smaller one, by one pair each.
        high, at = np.unique(np.maximum(a, b), return_index=True)
        used.append(np.stack([p[at], q[at]]))
        root[high] = np.minimum(a, b)[at]
        while (root != root[root]).any():
            root[:] = root[root]


def _window_links(nodes: np.ndarray, x: np.ndarray, window: int, least: float, rows: int = 512) -> np.ndarray:
    """A forest over the verified pairs of sorted rows, as two rows of nodes. Values too near the bound to be told by a
    matrix product are worked out pair by pair, as in the count of links."""
    unit, root, links = normed(x), np.arange(len(x)), []
    for i in range(0, len(x) - 1, rows):
        own = unit[i:i + rows]
        s = own @ unit[i + 1:i + len(own) + window].T
        p, q = np.nonzero(s >= least - 1e-9)
        inside = (q >= p) & (q < p + window)
        p, q = p[inside], q[inside]
        sure = s[p, q] >= least + 1e-9
        p, q = p + i, q + i + 1
        sure[~sure] = cosine(x[p[~sure]], x[q[~sure]]) >= least
        links += _join(root, p[sure], q[sure])
    return nodes[np.concatenate(links, axis=1)] if links else np.zeros((2, 0), dtype=np.int64)


def near_copies(vectors: DataFrame, least: float = 0.95, window: int = 128, block: int = 512, seed: int = 6,
                aim: float = 0.99, sampled: int = 4096, probes: int = 2048, per_probe: int = 32, id_col: str = "vec_id",
                vec_col: str = "embedding") -> DataFrame:
    """`vec_id`, `n_links`, `component_id`, `kept`, one row per input row.

    Vectors link at a cosine (double precision) of `least` or more. Equal vectors are one node with a count, so their
    links are counted without being listed. Vectors that are null, zero or hold null or non-finite components, and
    rows without an id, link with nothing. A component is named by its smallest id. Rows of one id that have equal
    vectors are counted as several vectors; an id that comes with different vectors joins their components, and each
    row has the links of its own vector. An empty table gives an empty table; other columns are not looked at.

    The number of passes follows the number of rows at first. The links of `probes` rows are counted by brute force, and
    `per_probe` of each, those with the least hashes, are listed, which bounds the list in dense directions too. While less than `aim` of the
    links (listed ones stand for all of their probe), or of those of a mean probe, lie within one component, passes are added.
    The sample only decides when to stop; links and components come from all rows. (Even an order by
    chance finds a pair in 2 * `window` of as many passes as rows, so this ends.) The passes of a round are one sort by
    (pass, key), dealt by ranges, so that a dense group is split like any other; the few pairs across the end of a range
    are left to the other passes.
    """
    spark = vectors.sparkSession
    rows = usable(vectors, id_col, vec_col)
    nodes = cut(rows.groupBy("v").agg(F.min("vec_id").alias("node"), F.count("*").alias("copies"))
                .withColumn("dim", F.size("v")))
    count = nodes.count()
    first = passes_for(count, window, least)
    kind = rows.schema["v"].dataType.simpleString()
    drawn = nodes.orderBy(F.xxhash64(F.lit(seed), "node")).limit(sampled).select("node", "dim", "v").toArrow()
    samples, asked = {}, {}
    for d in np.unique(drawn.column("dim").to_numpy()).tolist():
        own = drawn.filter(pa.array(drawn.column("dim").to_numpy() == d))
        samples[d] = normed(matrix(own.column("v").combine_chunks()))
        few = max(1, min(len(samples[d]), probes * len(samples[d]) // drawn.num_rows))
        asked[d] = own.column("node").to_numpy()[:few]
    shared = spark.sparkContext.broadcast((samples, asked))

    def look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Of each probe the `per_probe` links of a task with the least hashes; one of them bears the number of all."""
        a, b, h = (np.zeros(0, dtype=t) for t in (np.int64, np.int64, np.uint64))
        held: dict[int, int] = {}
        for whole in batches:
            for i in range(0, whole.num_rows, 4096):
                batch = whole.slice(i, 4096)
                dims = batch.column("dim").to_numpy()
                for dim in np.unique(dims).tolist():
                    if dim in shared.value[1]:
                        part, names = batch.filter(pa.array(dims == dim)), shared.value[1][dim]
                        ids = part.column("node").to_numpy()
                        p, q = np.nonzero(normed(matrix(part.column("v"))) @ shared.value[0][dim][:len(names)].T >= least + 1e-9)
                        other = ids[p] != names[q]
                        p, q = p[other], q[other]
                        for k, n in enumerate(np.bincount(q, minlength=len(names)).tolist()):
                            if n:
                                held[int(names[k])] = held.get(int(names[k]), 0) + n
                        a, b = np.append(a, names[q]), np.append(b, ids[p])
                        h = np.append(h, mix(names[q].view(np.uint64) ^ mix(ids[p].view(np.uint64))))
                order = np.lexsort((h, a))
                a, b, h = a[order], b[order], h[order]
                begins = np.flatnonzero(np.append(True, a[1:] != a[:-1])) if len(a) else np.zeros(0, dtype=np.int64)
                place = np.arange(len(a)) - np.repeat(begins, np.diff(np.append(begins, len(a))))
                a, b, h = (x[place < per_probe] for x in (a, b, h))
        n = np.zeros(len(a), dtype=np.int64)
        first = np.unique(a, return_index=True)[1]
        n[first] = [held[i] for i in a[first].tolist()]
        for i in range(0, len(a), 65_536):
            yield pa.RecordBatch.from_arrays([pa.array(x[i:i + 65_536]) for x in (a, b, h.view(np.int64), n)], ["a", "b", "h", "n"])

    listed = cut(nodes.mapInArrow(look_up, "a long, b long, h long, n long"))
    least_hashes = Window.partitionBy("a").orderBy("h", "b")
    truth = cut(listed.withColumn("r", F.row_number().over(least_hashes)).where(F.col("r") <= per_probe).select("a", "b")
                .join(listed.groupBy("a").agg(F.sum("n").alias("n")), "a"))

    def keyed(turns: range) -> DataFrame:
        # Bounded by the sample: some hundred kilobytes for a pass.
        known = spark.sparkContext.broadcast({(d, t): thresholds(x, t, seed) for d, x in samples.items() for t in turns})

        def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for whole in batches:
                for i in range(0, whole.num_rows, 2048):
                    batch = whole.slice(i, 2048)
                    dims = batch.column("dim").to_numpy()
                    for dim in np.unique(dims).tolist():
                        part = batch.filter(pa.array(dims == dim))
                        x = normed(matrix(part.column("v")))
                        for turn in turns:
                            cuts = known.value.get((dim, turn)) or thresholds(np.zeros((0, dim)), turn, seed)
                            key = sort_keys(x, turn, seed, cuts)
                            yield pa.RecordBatch.from_arrays(
                                [part.column("dim"), pa.array(np.full(len(key), turn, dtype=np.int32)),
                                 pa.array((key ^ np.uint64(1 << 63)).view(np.int64)), part.column("node"), part.column("v")],
                                ["dim", "turn", "key", "node", "v"])
        return nodes.mapInArrow(keys, f"dim int, turn int, key long, node long, v {kind}")

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted; the last `window` rows are kept to meet the next ones of their pass."""
        carried = None
        for batch in batches:
            for i in range(0, batch.num_rows, 4096):
                part = pa.Table.from_batches([batch.slice(i, 4096)])
                table = pa.concat_tables([carried, part]) if carried is not None else part
                turn = table.column("turn").to_numpy().astype(np.int64) << 32 | table.column("dim").to_numpy()
                bounds = np.append(np.flatnonzero(np.append(True, turn[1:] != turn[:-1])), len(turn))
                links = [np.zeros((2, 0), dtype=np.int64)]
                for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
                    own = table.slice(a, b - a)
                    links.append(_window_links(own.column("node").to_numpy(), matrix(own.column("v").combine_chunks()), window, least))
                carried = table.slice(max(0, table.num_rows - window))
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in np.concatenate(links, axis=1)], ["a", "b"])

    # Ids that occur with several vectors hold their nodes together.
    several = rows.groupBy("vec_id").agg(F.min("v").alias("x"), F.max("v").alias("y")).where("x <> y").select("vec_id")
    same = (rows.join(several, "vec_id", "left_semi").join(nodes.select("v", "node"), "v")
            .select(F.col("vec_id").alias("a"), F.col("node").alias("b")))

    def recall(groups: DataFrame) -> float:
        """Of the links of the probes, or of those of a mean probe, the smaller share that lies within a component, as drawn."""
        ends = truth.join(groups.select(F.col("node").alias("a"), F.col("component").alias("x")), "a", "left").join(
            groups.select(F.col("node").alias("b"), F.col("component").alias("y")), "b", "left")
        together = F.coalesce("x", "a") == F.coalesce("y", "b")
        found = (ends.groupBy("a").agg(F.avg(together.cast("int")).alias("share"), F.first("n").alias("n"))
                 .agg(F.sum(F.col("share") * F.col("n")) / F.sum("n"), F.avg("share")).first())
        return 1.0 if found[0] is None else min(found)

    edges, done, step = same, 0, first
    while True:
        parts = max(partitions(spark), -(-count * step // 50_000))
        links = (keyed(range(done, done + step)).repartitionByRange(parts, "dim", "turn", "key", "node")
                 .sortWithinPartitions("dim", "turn", "key", "node").mapInArrow(compare, "a long, b long").distinct())
        groups = cut(connected_components(edges.unionAll(links)))
        done, reached = done + step, recall(groups)
        log.info("%d passes, recall %.4f on sampled rows", done, reached)
        if reached >= aim:
            break
        edges, step = groups.select(F.col("node").alias("a"), F.col("component").alias("b")), max(first, done // 2)
    roots = groups.select("component").distinct().select(F.col("component").alias("node"), "component")
    members = cut(groups.unionAll(roots).join(nodes, "node").select("component", "dim", "node", "copies", "v"))
    sizes = members.groupBy("component", "dim").agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    cut_up = (members.join(sizes, ["component", "dim"])
              .withColumn("i", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int")))
    # Block i meets every block j of its component; `own` marks the side whose links are counted.
    meeting = cut_up.withColumn("j", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    left = meeting.select("component", "dim", "i", "j", "node", "v")
    # New names, as both sides come from one frame.
    right = meeting.select(*[F.col(a).alias(b) for a, b in (
        ("component", "component_"), ("dim", "dim_"), ("j", "i_"), ("i", "j_"), ("node", "node_"), ("copies", "copies"), ("v", "v_"))])

    def count_links(own: pa.Table, other: pa.Table) -> pa.Table:
        ids = own.column("node").to_numpy()
        out = np.zeros(len(ids), dtype=np.int64)
        if own.num_rows and other.num_rows:
            raw, against = matrix(own.column("v").combine_chunks()), matrix(other.column("v_").combine_chunks())
            names, copies = other.column("node_").to_numpy(), other.column("copies").to_numpy()
            a, b = normed(raw), normed(against)
            for i in range(0, len(a), 512):
                s = a[i:i + 512] @ b.T
                near = s >= least
                for p, q in zip(*np.nonzero(np.abs(s - least) < 1e-9)):
                    near[p, q] = cosine(raw[i + p:i + p + 1], against[q:q + 1])[0] >= least
                near &= ids[i:i + 512, None] != names[None, :]
                out[i:i + 512] = near @ copies
        return pa.table([pa.array(ids), pa.array(out)], names=["node", "n"])

    counted = (left.groupBy("component", "dim", "i", "j").cogroup(right.groupBy("component_", "dim_", "i_", "j_"))
               .applyInArrow(count_links, "node long, n long").groupBy("node").agg(F.sum("n").alias("others")))
    named = (nodes.join(groups, "node", "left").join(counted, "node", "left")
             .select("v", F.coalesce("component", "node").alias("component_id"),
                     (F.coalesce("others", F.lit(0)) + F.col("copies") - 1).alias("n_links")))
    every = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).alias("v"))
    fit = rows.join(named, "v").select("vec_id", "n_links", "component_id")
    out = every.select("vec_id").exceptAll(rows.select("vec_id")).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return fit.unionAll(out).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
