"""Approximate nearest neighbours by learned partitions.

The neighbour graph of a bounded sample is cut into balanced parts; a small classifier learns the parts and then
places every vector. A query is compared with the vectors of its most probable parts, as many as the sample shows
to be needed for the wanted recall.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .common import cut


def usable(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """`vec_id`, `v`: vectors without null or non-finite components and not zero; null ids are left out."""
    v = F.col("v")
    bad = F.exists(v, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return (vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).alias("v"))
            .where(F.col("vec_id").isNotNull() & v.isNotNull() & (F.size(v) > 0))
            .where(~bad & F.exists(v, lambda x: x != 0)))


def matrix(column: pa.Array) -> np.ndarray:
    """Rows of a list column whose lists all have one length."""
    n = len(column)
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(n, -1) if n else np.zeros((0, 0))


def normed(x: np.ndarray) -> np.ndarray:
    """Rows of length one; scaled by the largest component first, so that squares neither vanish nor overflow."""
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def cosine(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Row by row; the same two rows give the same number wherever they stand."""
    return (normed(x) * normed(y)).sum(axis=1)


def neighbour_graph(x: np.ndarray, k: int) -> np.ndarray:
    """The k nearest rows of each row by cosine."""
    out = np.empty((len(x), k), dtype=np.int64)
    for i in range(0, len(x), 1024):
        s = x[i:i + 1024] @ x.T
        s[np.arange(len(s)), np.arange(i, i + len(s))] = -np.inf
        out[i:i + 1024] = np.argpartition(-s, k - 1, axis=1)[:, :k]
    return out


def balanced_parts(x: np.ndarray, graph: np.ndarray, parts: int, rounds: int = 12, slack: float = 1.05,
                   seed: int = 1) -> np.ndarray:
    """A part per row of the sample: halves along the widest direction first, then moves to where most neighbours
    are, while no part exceeds its share by more than `slack`."""
    part = np.zeros(len(x), dtype=np.int64)
    pieces = [np.arange(len(x))]
    while len(pieces) < parts:
        pieces.sort(key=len)
        rows = pieces.pop()
        centred = x[rows] - x[rows].mean(axis=0)
        _, axes = np.linalg.eigh(centred.T @ centred)
        order = rows[np.argsort(centred @ axes[:, -1], kind="stable")]
        pieces += [order[:len(order) // 2], order[len(order) // 2:]]
    for i, rows in enumerate(pieces):
        part[rows] = i
    most = int(np.ceil(slack * len(x) / parts))
    rng = np.random.default_rng(seed)
    for _ in range(rounds):
        votes = np.zeros((len(x), parts), dtype=np.int32)
        for column in (graph[:, j] for j in range(graph.shape[1])):
            np.add.at(votes, (np.arange(len(x)), part[column]), 1)
            np.add.at(votes, (column, part), 1)
        best = votes.argmax(axis=1)
        gain = votes[np.arange(len(x)), best] - votes[np.arange(len(x)), part]
        wish = np.flatnonzero(gain > 0)
        wish = wish[np.lexsort((rng.random(len(wish)), -gain[wish]))]
        sizes = np.bincount(part, minlength=parts)
        moved = 0
        for i in wish.tolist():
            if sizes[best[i]] < most:
                sizes[part[i]] -= 1
                sizes[best[i]] += 1
                part[i] = best[i]
                moved += 1
        if not moved:
            break
    return part


def forward(w: list[np.ndarray], x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hidden layer and probabilities of the parts."""
    h = np.maximum(x @ w[0] * x.shape[1] ** 0.5 + w[1], 0)
    z = h @ w[2] + w[3]
    z = np.exp(z - z.max(axis=1, keepdims=True))
    return h, z / z.sum(axis=1, keepdims=True)


def probable(w: list[np.ndarray], x: np.ndarray) -> np.ndarray:
    """Parts from the most probable on."""
    return np.argsort(-forward(w, x)[1], axis=1, kind="stable")


class Router:
    """A network with one hidden layer that gives the probabilities of the parts."""

    def __init__(self, dim: int, parts: int, hidden: int = 128, seed: int = 1):
        rng = np.random.default_rng(seed)
        self.w = [rng.normal(0, dim ** -0.5, (dim, hidden)), np.zeros(hidden),
                  rng.normal(0, hidden ** -0.5, (hidden, parts)), np.zeros(parts)]

    def fit(self, x: np.ndarray, target: np.ndarray, epochs: int = 25, batch: int = 256, rate: float = 0.003,
            seed: int = 2) -> None:
        rng = np.random.default_rng(seed)
        mean, square = [np.zeros_like(w) for w in self.w], [np.zeros_like(w) for w in self.w]
        step = 0
        for _ in range(epochs):
            order = rng.permutation(len(x))
            for i in range(0, len(x), batch):
                a, t = x[order[i:i + batch]], target[order[i:i + batch]]
                h, p = forward(self.w, a)
                out = (p - t) / len(a)
                back = (out @ self.w[2].T) * (h > 0)
                grads = [a.T @ back * x.shape[1] ** 0.5, back.sum(axis=0), h.T @ out, out.sum(axis=0)]
                step += 1
                for j, g in enumerate(grads):
                    mean[j] += 0.1 * (g - mean[j])
                    square[j] += 0.001 * (g * g - square[j])
                    self.w[j] -= rate * (mean[j] / (1 - 0.9 ** step)) / (np.sqrt(square[j] / (1 - 0.999 ** step)) + 1e-8)


def fit(x: np.ndarray, parts: int, recall: float, k: int = 10) -> tuple[Router, int]:
    """Router of the sample `x` (rows of length one) and the number of parts a query has to look into.

    That number is the least one that reaches `recall` of the sample's own neighbours on a quarter held out from training.
    """
    parts = max(1, min(parts, len(x) // 8))
    router = Router(x.shape[1], parts)
    if parts == 1:
        return router, 1
    k = min(k, len(x) - 1)
    graph = neighbour_graph(x, k)
    part = balanced_parts(x, graph, parts)
    target = np.zeros((len(x), parts))
    for column in [np.arange(len(x))] * k + [graph[:, j] for j in range(k)]:
        np.add.at(target, (np.arange(len(x)), part[column]), 0.5 / k)
    held = np.arange(len(x)) % 4 == 0
    router.fit(x[~held], target[~held])
    order = probable(router.w, x)
    place = order[:, 0]
    position = np.argsort(order, axis=1)
    near = graph[held][:, :5]
    needed = np.take_along_axis(position[held], place[near], axis=1)
    share = np.cumsum(np.bincount(needed.ravel(), minlength=parts)) / needed.size
    return router, int(np.argmax(share >= recall)) + 1


def search(vectors: DataFrame, every: int = 50, k: int = 5, sample: int = 8000, rows_per_part: int = 800, most_parts: int = 256,
           recall: float = 0.96, block: int = 4096, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """`query_id`, `rank`, `vec_id`, `score`: the k nearest found of every vector whose id is divisible by `every`.

    Nearness is the cosine in double precision, ties go to the smaller id; a query's own row is no candidate.
    Equal vectors are searched as one, with their k + 1 smallest ids, as no more of them can be among the k nearest;
    so copies cost nothing. Rows that share an id are no candidates of it. Vectors whose length differs
    from the most frequent one are compared with nothing. If the looked-at parts hold fewer than k candidates, the query
    looks into all parts. The sample for the graph and the classifier is bounded (`sample` rows); all rows are indexed.

    Parts are cut into blocks of rows and of queries by their counts, so that a task holds one block of each.
    """
    spark = vectors.sparkSession
    rows = usable(vectors, id_col, vec_col).distinct()
    lengths = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    schema = "query_id long, rank int, vec_id long, score double"
    if lengths is None:
        return spark.createDataFrame([], schema)
    dim = lengths[0]
    kind = rows.schema["v"].dataType.simpleString()
    ranked = Window.partitionBy("v").orderBy("vec_id")
    first = rows.where(F.size("v") == dim).withColumn("r", F.row_number().over(ranked)).where(F.col("r") <= k + 1)
    kept = (first.groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")))
    asked = rows.where((F.size("v") == dim) & (F.col("vec_id") % every == 0)).groupBy("v").agg(F.count("*").alias("n"))
    index = cut(kept.join(asked.select("v", F.lit(True).alias("asks")), "v", "left")
                .select(F.col("ids")[0].alias("node"), "v", "ids", F.coalesce("asks", F.lit(False)).alias("asks")))
    total = index.count()
    drawn = index.where(F.pmod(F.xxhash64(F.lit(1), "node"), F.lit(1 << 20)) < int((1 << 20) * min(1.0, 1.3 * sample / total)) + 1)
    x = normed(np.array([r[0] for r in drawn.select("v").limit(sample).collect()] or [[1.0] * dim]))
    router, probes = fit(x, min(most_parts, -(-total // rows_per_part)), recall)
    parts = router.w[3].shape[0]
    shared = spark.sparkContext.broadcast(router.w)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            order = probable(shared.value, normed(matrix(batch.column("v")))) if batch.num_rows else np.zeros((0, parts))
            whole = batch.column("asks").to_pylist()
            lists = [o if a else o[:1] for o, a in zip(order.astype(np.int32), whole)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in ("node", "v", "ids", "asks")]
                + [pa.array(lists, pa.list_(pa.int32()))], ["node", "v", "ids", "asks", "parts"])

    placed = cut(index.mapInArrow(place, f"node long, v {kind}, ids array<long>, asks boolean, parts array<int>"))
    sizes = placed.groupBy(F.col("parts")[0].alias("part")).agg(F.sum(F.size("ids")).alias("ids"), F.count("*").alias("rows")).collect()
    held = {r["part"]: r["ids"] for r in sizes}                      # at most `most_parts` rows
    chunks = {r["part"]: -(-r["rows"] // block) for r in sizes}
    counts = F.create_map(*[F.lit(x) for p in range(parts) for x in (p, held.get(p, 0))])
    pieces = F.create_map(*[F.lit(x) for p in range(parts) for x in (p, chunks.get(p, 1))])
    enough = F.aggregate(F.slice("parts", 1, probes), F.lit(0).cast("long"), lambda a, p: a + counts[p]) >= k + 1
    looked = F.when(enough, F.slice("parts", 1, probes)).otherwise(F.col("parts"))
    salt = F.xxhash64(F.lit(2), "node")
    looking = placed.where("asks").select("node", "v", F.explode(looked).alias("part"))
    asking = {r["part"]: r["n"] for r in looking.groupBy("part").agg(F.count("*").alias("n")).collect()}
    turns = F.create_map(*[F.lit(x) for p in range(parts) for x in (p, -(-asking.get(p, 1) // block))])
    here = F.col("part")
    candidates = (placed.select(F.col("parts")[0].alias("part"), "node", "v", "ids")
                  .withColumn("chunk", F.pmod(salt, pieces[here]).cast("int"))
                  .withColumn("turn", F.explode(F.sequence(F.lit(0), turns[here] - 1))))
    queries = (looking.withColumn("turn", F.pmod(salt, turns[here]).cast("int"))
               .withColumn("chunk", F.explode(F.sequence(F.lit(0), pieces[here] - 1)))
               # New names, as both sides come from one frame.
               .select(*[F.col(c).alias(f"{c}_") for c in ("part", "chunk", "turn", "node", "v")]))

    def compare(left: pa.Table, right: pa.Table) -> pa.Table:
        """The k + 1 nearest ids to each query among the rows of a chunk."""
        out: list[tuple] = []
        if left.num_rows and right.num_rows:
            c, ids = normed(matrix(left.column("v").combine_chunks())), left.column("ids").to_pylist()
            raw = matrix(left.column("v").combine_chunks())
            asking = matrix(right.column("v_").combine_chunks())
            nodes = right.column("node_").to_pylist()
            take = min(k + 1, len(c))
            for i in range(0, len(asking), 512):
                s = normed(asking[i:i + 512]) @ c.T
                least = -np.partition(-s, take - 1, axis=1)[:, take - 1]
                rows_, cols = np.nonzero(s >= least[:, None] - 1e-9)
                score = cosine(asking[i + rows_], raw[cols])
                # By query, score and smallest id; the ids of equal vectors follow each other.
                smallest = np.array([x[0] for x in ids])[cols]
                taken = np.zeros(min(512, len(asking) - i), dtype=int)
                for j in np.lexsort((smallest, -score, rows_)).tolist():
                    q = int(rows_[j])
                    if taken[q] < k + 1:
                        taken[q] += 1
                        out.append((nodes[i + q], ids[cols[j]], float(score[j])))
        columns = list(zip(*out)) if out else [(), (), ()]
        return pa.table([pa.array(columns[0], pa.int64()), pa.array(columns[1], pa.list_(pa.int64())), pa.array(columns[2], pa.float64())],
                        names=["node", "ids", "score"])

    found = (candidates.groupBy("part", "chunk", "turn").cogroup(queries.groupBy("part_", "chunk_", "turn_"))
             .applyInArrow(compare, "node long, ids array<long>, score double")
             .select("node", "score", F.explode("ids").alias("vec_id")))
    best = Window.partitionBy("node").orderBy(F.desc("score"), "vec_id")
    top = found.withColumn("r", F.row_number().over(best)).where(F.col("r") <= k + 1).drop("r")
    # From distinct vectors back to the rows that ask.
    asks = (rows.where((F.size("v") == dim) & (F.col("vec_id") % every == 0)).select(F.col("vec_id").alias("query_id"), "v").distinct()
            .join(index.where("asks").select("node", "v"), "v").select("query_id", "node"))
    mine = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (asks.join(top, "node").where("vec_id <> query_id")
            .groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
            .withColumn("rank", F.row_number().over(mine)).where(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int"), "vec_id", "score"))
