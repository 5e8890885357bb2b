"""Texts in blocks by ranges of their ids, and exchanges of sorted hashes between blocks.

A block is small enough for one task. What repeats within it is settled there; what may repeat elsewhere is sent,
each value once per block, to buckets of the value space, and the bucket answers a bit per value. Blocks follow the order of ids,
so "in a document before" is "in a block before" there. The texts are shuffled once: every later step joins the
answers to the same exchange.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, functions as F

from .common import partitions

CUTS = 64


class Blocks:
    """`texts`: block, doc_id, text; `packed`: block and compressed groups of its documents; `size`: bytes in all."""

    def __init__(self, docs: DataFrame, block_bytes: int, per_bucket: int, id_col: str = "doc_id", text_col: str = "text"):
        named = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
        ends = [i / CUTS for i in range(CUTS + 1)]
        stats = named.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0)),
                          F.percentile_approx("doc_id", ends, 10_000)).first()
        self.size = stats[0]
        self.count = max(1, -(-self.size // block_bytes))
        wanted = max(partitions(docs.sparkSession), -(-self.size // per_bucket))
        self.bucket_bits = int(np.ceil(np.log2(max(2, wanted))))
        self.texts = named.withColumn("block", self._block(sorted(set(stats[1] or [0])))).select("block", "doc_id", "text")
        self.packed = self.texts.mapInArrow(_compress, "block long, documents binary")

    def _block(self, cuts: list[int]) -> Column:
        """Equal numbers of ids in each of up to 64 ranges, which are cut evenly. Null ids are spread behind all blocks."""
        pieces = -(-self.count // CUTS)
        lows = F.array(*[F.lit(c) for c in cuts])
        at = F.greatest(F.lit(1), F.size(F.filter(lows, lambda c: c <= F.col("doc_id"))))
        low, high = lows[at - 1], F.coalesce(F.try_element_at(lows, at + 1), F.lit(cuts[-1] + 1))
        within = F.floor((F.col("doc_id") - low).cast("double") / (high - low).cast("double") * pieces)
        inside = F.greatest(F.lit(0), F.least(within, F.lit(pieces - 1)))
        nulls = F.lit((len(cuts) + 1) * pieces) + F.pmod(F.xxhash64("text"), F.lit(self.count))
        return F.coalesce(at * pieces + inside, nulls).cast("long")

    def by_block(self):
        return self.packed.groupBy("block")


def _compress(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of a batch by block: compressed they take two thirds of what they would in the shuffle."""
    packer = zstandard.ZstdCompressor(level=3)
    for batch in batches:
        if not batch.num_rows:
            continue
        block = batch.column("block").to_numpy()
        known = np.asarray(batch.column("doc_id").is_valid())
        ids = batch.column("doc_id").fill_null(0).to_numpy()
        values = batch.column("text")
        order = np.argsort(block, kind="stable")
        cuts = np.flatnonzero(np.append(True, block[order][1:] != block[order][:-1])).tolist() + [len(order)]
        for a, b in zip(cuts[:-1], cuts[1:]):
            rows = order[a:b]
            texts = [values[i].as_buffer().to_pybytes() for i in rows.tolist()]
            head = np.array([b - a], dtype="<i8").tobytes() + ids[rows].astype("<i8").tobytes() + known[rows].astype("<i8").tobytes()
            sizes = np.fromiter(map(len, texts), dtype="<i8", count=b - a).tobytes()
            yield pa.RecordBatch.from_arrays([pa.array([int(block[rows[0]])], pa.int64()),
                                              pa.array([packer.compress(head + sizes + b"".join(texts))], pa.binary())],
                                             ["block", "documents"])


def documents(table: pa.Table) -> tuple[list[int | None], list[bytes]]:
    """Ids and texts of a block in the order of ids, then texts; null ids last."""
    ids, texts = [], []
    for blob in table.column("documents"):
        raw = zstandard.ZstdDecompressor().decompress(blob.as_buffer())
        n = int(np.frombuffer(raw, dtype="<i8", count=1)[0])
        numbers, known, sizes = np.frombuffer(raw, dtype="<i8", count=3 * n, offset=8).reshape(3, n).tolist()
        ids += [i if k else None for i, k in zip(numbers, known)]
        at = 8 + 24 * n
        for size in sizes:
            texts.append(raw[at:at + size])
            at += size
    order = sorted(range(len(ids)), key=lambda i: (ids[i] is None, ids[i] or 0, texts[i]))
    return [ids[i] for i in order], [texts[i] for i in order]


def pack(values: np.ndarray) -> bytes:
    """Rising unsigned integers as differences in byte planes, compressed."""
    steps = np.diff(values, prepend=np.uint64(0)).astype("<u8")
    return zstandard.ZstdCompressor(level=1).compress(
        np.uint32(len(values)).tobytes() + np.ascontiguousarray(steps.view(np.uint8).reshape(-1, 8).T).tobytes())


def unpack(blob: bytes) -> np.ndarray:
    raw = zstandard.ZstdDecompressor().decompress(blob)
    n = int(np.frombuffer(raw[:4], dtype=np.uint32)[0])
    return np.cumsum(np.ascontiguousarray(np.frombuffer(raw, dtype=np.uint8, offset=4).reshape(8, n).T).view("<u8").ravel(), dtype=np.uint64)


def in_buckets(values: np.ndarray, bits: int) -> Iterator[tuple[int, slice]]:
    """Buckets of sorted 64-bit values by their leading bits, and where each lies."""
    which = (values >> np.uint64(64 - bits)).astype(np.int64)
    cuts = np.append(np.flatnonzero(np.append(True, which[1:] != which[:-1])), len(which)) if len(which) else []
    for a, b in zip(cuts[:-1], cuts[1:]):
        yield int(which[a]), slice(int(a), int(b))


def mail(rows: list[tuple[int, int, int, bytes]]) -> pa.Table:
    """Rows to a bucket or back to a block: `to`, `kind`, `place`, `blob`."""
    columns = list(zip(*rows)) if rows else [(), (), (), ()]
    return pa.table([pa.array(c, k) for c, k in zip(columns, (pa.int64(), pa.int32(), pa.int64(), pa.binary()))],
                    names=["to", "kind", "place", "blob"])


MAIL = "to long, kind int, place long, blob binary"


def letters(table: pa.Table, kind: int) -> dict[int, bytes]:
    """Blobs of one kind by their place."""
    kinds, places, blobs = (table.column(c) for c in ("kind", "place", "blob"))
    return {p.as_py(): b.as_py() for k, p, b in zip(kinds, places, blobs) if k.as_py() == kind}


def bits(flags: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.packbits(flags).tobytes())


def flags(blob: bytes, n: int) -> np.ndarray:
    return np.unpackbits(np.frombuffer(zstandard.ZstdDecompressor().decompress(blob), dtype=np.uint8), count=n).astype(bool)
