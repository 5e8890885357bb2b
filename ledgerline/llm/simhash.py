"""Near-duplicate documents by SimHash fingerprints and Golay-code keys.

A fingerprint of 64 bits is cut into segments of 23, 23 and 18 bits. The perfect Golay code has, for each
23-bit word, one codeword within distance 3 and (if that distance is 3) five more at distance 4. Two words
that differ in at most two bits always share one of these codewords: the word halfway between them lies
within 3 of some codeword, hence both lie within 4 of it. If two fingerprints differ in at most four bits,
two of the three segments differ in at most two bits together. So the keys are pairs of codeword indices,
for each of the three pairs of segments: at most 3 x 36 keys, 84 on average, of 24 bits.
"""
from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from .common import column, cut, free, mix, texts
from .components import connected_components

# Fixed: generator polynomial of the binary Golay code, x^11 + x^9 + x^7 + x^6 + x^5 + x + 1.
GENERATOR = 0b101011100011
SEGMENTS = ((0, 23), (23, 23), (46, 18))


def golay_tables() -> tuple[np.ndarray, np.ndarray]:
    """Remainders of the single bits, and for each of 2048 syndromes its six error patterns (short rows repeat)."""
    def remainder(word: int) -> int:
        for shift in range(22, 10, -1):
            if word >> shift & 1:
                word ^= GENERATOR << (shift - 11)
        return word

    bits = np.array([remainder(1 << i) for i in range(23)], dtype=np.uint32)
    rows: list[list[int]] = [[] for _ in range(2048)]
    for weight in range(5):
        for places in itertools.combinations(range(23), weight):
            syndrome = 0
            for i in places:
                syndrome ^= int(bits[i])
            rows[syndrome].append(sum(1 << i for i in places))
    return bits, np.array([(r + r[:1] * 6)[:6] for r in rows], dtype=np.uint32)


GOLAY = golay_tables()


def segment_keys(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codeword indices (12 bits) near 23-bit words, six columns, and which of them are not repeats."""
    bits, patterns = GOLAY
    syndrome = np.zeros(len(words), dtype=np.uint32)
    for i in range(23):
        syndrome ^= np.where(words >> np.uint32(i) & np.uint32(1), bits[i], np.uint32(0))
    near = patterns[syndrome]
    fresh = np.ones(near.shape, dtype=bool)
    fresh[:, 1:] = near[:, 1:] != near[:, :1]
    return (words[:, None] ^ near) >> np.uint32(11), fresh


def golay_keys(fingerprints: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, key) of all keys of an array of 64-bit fingerprints; keys have 26 bits."""
    parts = [segment_keys((fingerprints >> np.uint64(a) & np.uint64((1 << n) - 1)).astype(np.uint32))
             for a, n in SEGMENTS]
    rows, keys = [], []
    for pair, (i, j) in enumerate(((0, 1), (0, 2), (1, 2))):
        (x, xf), (y, yf) = parts[i], parts[j]
        keep = xf[:, :, None] & yf[:, None, :]
        key = (x[:, :, None] << np.uint32(12) | y[:, None, :]) | np.uint32(pair << 24)
        rows.append(np.nonzero(keep)[0])
        keys.append(key[keep])
    return np.concatenate(rows), np.concatenate(keys)


def shingle_hashes(text: bytes, size: int) -> np.ndarray:
    """XXH64 (seed 42) of the word shingles in order, A-Z lower-cased; repeats are kept."""
    words = text.lower().split()
    if not words:
        return np.zeros(0, dtype=np.uint64)
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), dtype=np.int64, count=len(words))
    ends = np.cumsum(lengths + 1) - 1
    size = min(size, len(words))
    digest = xxhash.xxh64_intdigest
    first, last = (ends - lengths)[:len(words) - size + 1].tolist(), ends[size - 1:].tolist()
    return np.fromiter((digest(joined[a:b], 42) for a, b in zip(first, last)), dtype=np.uint64, count=len(first))


def majority(hashes: np.ndarray) -> int:
    """Bits that are set in more than half of the hashes."""
    counts = np.zeros(64, dtype=np.int64)
    for i in range(0, len(hashes), 1 << 14):
        part = np.ascontiguousarray(hashes[i:i + (1 << 14)], dtype="<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 4, words: int = 1, sketch: int = 0, sketch_shingle: int = 5,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`doc_id`, `mark` (hash of the text), `prints` (array of `words` fingerprints), `least` (the `sketch` smallest hashes
    of shingles of `sketch_shingle` words, packed).

    Null and empty texts have the fingerprint zero. The first fingerprint is made of the hashes as they are,
    any further ones of the hashes mixed anew.
    """
    def one(text: bytes) -> tuple[list[int], bytes]:
        h = shingle_hashes(text, shingle)
        prints, again = [], h
        for _ in range(words):
            prints.append(_signed(majority(again)))
            again = mix(again + np.uint64(0x9E3779B97F4A7C15))
        least = b""
        if sketch:
            whole = mix(shingle_hashes(text, sketch_shingle)) >> np.uint64(32)
            least = np.unique(whole)[:sketch].astype("<u4").tobytes()
        return prints, least

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            made = [one(t) for t in texts(batch, "text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("mark"), pa.array([m[0] for m in made], pa.list_(pa.int64())),
                 pa.array([m[1] for m in made], pa.binary())], ["doc_id", "mark", "prints", "least"])

    text = F.col(text_col).cast("string")
    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.xxhash64(text).alias("mark"), text.alias("text"))
            .mapInArrow(run, "doc_id long, mark long, prints array<long>, least binary"))


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _forest(prints: np.ndarray, most: int) -> list[tuple[int, int]]:
    """Links that join all rows within `most` bits of each other, directly or in steps: a row that is
    joined already is compared no more, so that a dense group takes about one comparison a row."""
    links, queue, left = [], [0], np.arange(1, len(prints))
    while left.size:
        if not queue:
            queue, left = [int(left[0])], left[1:]
            continue
        pivot = queue.pop()
        near = np.bitwise_count(prints[left] ^ prints[pivot]).sum(axis=1) <= most
        if near.any():
            hit = left[near].tolist()
            links += [(pivot, x) for x in hit]
            queue += hit
            left = left[~near]
    return links


def linked_in_runs(keys: np.ndarray, nodes: np.ndarray, prints: np.ndarray, most: int) -> np.ndarray:
    """Links (node, node) that join what rows of equal key join within `most` bits; rows are sorted here."""
    order = np.lexsort((nodes, keys))
    keys, nodes, prints = keys[order], nodes[order], prints[order]
    cuts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
    lengths = np.diff(np.append(cuts, len(keys)))
    keep = np.repeat(lengths > 1, lengths)
    keys, nodes, prints = keys[keep], nodes[keep], prints[keep]
    lengths = lengths[lengths > 1]
    starts = np.cumsum(lengths) - lengths
    if not len(lengths):
        return np.zeros((0, 2), dtype=np.int64)
    run = np.repeat(np.arange(len(lengths)), lengths)
    small = 32
    linked, two = np.zeros(len(lengths), dtype=bool), []
    at = np.flatnonzero((lengths <= small)[run])
    for step in range(1, small):
        at = at[at + step < len(keys)]
        at = at[run[at] == run[at + step]]
        if not at.size:
            break
        hit = at[np.bitwise_count(prints[at] ^ prints[at + step]).sum(axis=1) <= most]
        linked[run[hit]] = True
        two.append(hit[lengths[run[hit]] == 2])
    pairs = np.concatenate(two) if two else np.zeros(0, dtype=np.int64)
    links = [np.stack([nodes[pairs], nodes[pairs + 1]], axis=1)] if pairs.size else []
    done: set[bytes] = set()
    for k in np.flatnonzero((linked & (lengths > 2)) | (lengths > small)).tolist():
        a, n = int(starts[k]), int(lengths[k])
        members = nodes[a:a + n].tobytes()
        if members in done:
            continue
        if n <= small:
            done.add(members)
        links.append(np.array([(nodes[a + i], nodes[a + j]) for i, j in _forest(prints[a:a + n], most)],
                              dtype=np.int64).reshape(-1, 2))
    return spanning(np.unique(np.concatenate(links), axis=0)) if links else np.zeros((0, 2), dtype=np.int64)


def spanning(links: np.ndarray) -> np.ndarray:
    """The links that join what was not joined by those before."""
    names, ends = np.unique(links, return_inverse=True)
    root = list(range(len(names)))
    kept = []
    for k, (a, b) in enumerate(ends.reshape(-1, 2).tolist()):
        while root[a] != a:
            root[a] = root[root[a]]
            a = root[a]
        while root[b] != b:
            root[b] = root[root[b]]
            b = root[b]
        if a != b:
            root[max(a, b)] = min(a, b)
            kept.append(k)
    return links[kept]


def candidate_links(nodes: DataFrame, words: int, levels: tuple[int, ...]) -> DataFrame:
    """`a`, `b`: links between nodes (`node`, `prints`) that share a key and differ in few bits.

    For each level, what is joined by links of at most so many bits stays joined by the links of at most so many bits
    that are returned. Keys are dealt over parts that grow with the number of nodes; a part returns a forest per level,
    so no group's pairs are all emitted.
    """
    record = np.dtype([("key", "<u4"), ("node", "<i8"), ("prints", "<u8", (words,))])
    count = nodes.count()
    parts = max(6, -(-count * 84 * words // 1_500_000))

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for i in range(0, whole.num_rows, 4096):
                batch = whole.slice(i, 4096)
                ids = batch.column("node").to_numpy(zero_copy_only=False)
                prints = (batch.column("prints").flatten().to_numpy(zero_copy_only=False)
                          .reshape(-1, words).view(np.uint64))
                rows, keys = [], []
                for w in range(words):
                    r, k = golay_keys(prints[:, w])
                    rows.append(r)
                    keys.append(k | np.uint32(w << 26))
                row, key = np.concatenate(rows), np.concatenate(keys)
                part = (mix(key.astype(np.uint64)) % np.uint64(parts)).astype(np.int64)
                out = np.empty(len(key), dtype=record)
                out["key"], out["node"], out["prints"] = key, ids[row], prints[row]
                order = np.argsort(part, kind="stable")
                part, out = part[order], out[order]
                cuts = np.flatnonzero(np.concatenate([[True], part[1:] != part[:-1]])) if len(part) else []
                blobs = [x.tobytes() for x in np.split(out, cuts[1:])] if len(part) else []
                yield pa.RecordBatch.from_arrays([pa.array(part[cuts] if len(part) else [], pa.int64()),
                                                  pa.array(blobs, pa.binary())], ["part", "rows"])

    def link(table: pa.Table) -> pa.Table:
        rows = np.frombuffer(b"".join(table.column("rows").to_pylist()), dtype=record)
        found = np.concatenate([linked_in_runs(rows["key"], rows["node"], rows["prints"], most) for most in levels])
        return pa.table({"a": pa.array(found[:, 0]), "b": pa.array(found[:, 1])})

    return (nodes.mapInArrow(emit, "part long, rows binary")
            .groupBy("part").applyInArrow(link, "a long, b long").distinct())


def simhash_groups(docs: DataFrame, shingle: int = 4, most: int = 4,
                   id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`doc_id`, `fingerprint` (16 hex digits), `component_id`, `kept`.

    Documents whose fingerprints differ in at most `most` (up to 4) bits are linked, equal ones included;
    a component is named by its smallest id. Documents with equal fingerprints are one node, so copies cost
    no links. Null and empty texts share the fingerprint zero; a row without an id belongs to no component
    (null) and is not kept; repeated ids share a row's fate if their fingerprints do. A very long text costs its length. An
    empty table gives an empty table; other columns are not looked at.
    """
    prints = cut(fingerprints(docs, shingle, id_col=id_col, text_col=text_col).select("doc_id", F.col("prints")[0].alias("p")))
    nodes = cut(prints.where("doc_id is not null").groupBy("p").agg(F.min("doc_id").alias("node")))
    repeated = (prints.where("doc_id is not null").groupBy("doc_id").agg(F.min("p").alias("x"), F.max("p").alias("y"))
                .where("x <> y").select("doc_id"))
    # An id that comes with several fingerprints joins their groups.
    same = (prints.join(repeated, "doc_id", "left_semi").join(nodes, "p")
            .select(F.col("doc_id").alias("a"), F.col("node").alias("b")))
    links = candidate_links(nodes.select("node", F.array("p").alias("prints")), 1, (most,)).unionAll(same)
    groups = connected_components(links)
    named = nodes.join(groups, "node", "left").select("p", F.coalesce("component", "node").alias("component_id"))
    return (prints.join(named, "p", "left")
            .select("doc_id", F.lower(F.lpad(F.hex("p"), 16, "0")).alias("fingerprint"),
                    F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"))
            .withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(False))))


def keep_one(docs: DataFrame, shingle: int = 4, most: int = 4) -> DataFrame:
    """The rows of `docs` that are the first of their group; columns unchanged whatever they are called or hold.

    Groups are those of `simhash_groups`, but of rows: two rows of one id are in one group only if their fingerprints are.
    A group keeps its row of smallest id (and of these the one with the smallest hash of its text), once: of rows with
    equal id and text the one whose JSON sorts first. Null and empty texts share the fingerprint zero and are a group.
    Rows without an id have no group and stay. An empty table gives an empty table.
    """
    mark, row = free(docs.columns, "_mark", "_row")
    rows = fingerprints(docs, shingle).where("doc_id is not null").select("doc_id", "mark", F.col("prints")[0].alias("p"))
    pairs = cut(rows.groupBy("doc_id", "mark").agg(F.count("*").alias("n"), F.min("p").alias("p")))
    nodes = cut(pairs.groupBy("p").agg(F.min(F.struct("doc_id", "mark")).alias("first")))
    groups = connected_components(candidate_links(nodes.select(F.col("p").alias("node"), F.array("p").alias("prints")), 1, (most,)))
    firsts = (nodes.join(groups.withColumnRenamed("node", "p"), "p", "left").groupBy(F.coalesce("component", "p").alias("group"))
              .agg(F.min("first").alias("first")).select("first.doc_id", "first.mark"))
    marked = docs.withColumn(mark, F.xxhash64(F.col("text").cast("string")))

    def of(found: DataFrame) -> DataFrame:
        return found.select("doc_id", F.col("mark").alias(mark))

    repeated = pairs.where("n > 1")
    out = of(pairs.join(firsts, ["doc_id", "mark"], "left_anti").unionAll(repeated)).distinct()
    left = marked.join(out, ["doc_id", mark], "left_anti").drop(mark)
    once = (marked.join(of(repeated.join(firsts, ["doc_id", "mark"], "left_semi")), ["doc_id", mark], "left_semi")
            .withColumn(row, F.struct(*[column(c) for c in docs.columns])).groupBy("doc_id", mark)
            .agg(F.min_by(row, F.to_json(row)).alias(row)))
    return left.select(*[column(c) for c in docs.columns]).unionAll(
        once.select(*[F.col(row).getField(c).alias(c) for c in docs.columns]))
