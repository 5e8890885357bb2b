"""Removal of repeated byte strings by blockwise suffix sorting with a difference-cover sample.

A difference cover D modulo v has, for any two positions i and j, a shift below v that puts both on sampled
residues. So if two suffixes agree in LENGTH bytes, the sampled suffixes at some common shift agree in
LENGTH - v + 1 bytes. First the sampled suffixes of all documents are sorted, one bucket of their value space at a
time, and ranked at that depth: a rank held by one suffix only settles every tie around it. Then only suffixes
near a shared rank are sorted, again by buckets, at the full depth. A bucket is sorted in one task; no suffix array
of the whole corpus is held anywhere.

Suffixes are bucketed and sorted by hashes of their first bytes instead of the bytes themselves, since equality at a
fixed depth is all that is asked; at the full depth a hash is wide enough (see `width`) that a collision anywhere
in the corpus has a chance below 2**-12.
"""
from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, functions as F

from .blocks import MAIL, Blocks, bits, documents, flags, in_buckets, letters, mail, pack, unpack
from .common import mix

LENGTH = 50
# Fixed: a perfect difference set; every residue modulo 31 but 0 is a difference of two of its members once.
MODULUS, COVER = 31, (1, 5, 11, 24, 25, 27)
DEPTH = LENGTH - MODULUS + 1
SAMPLES, ANSWER, CARRY, COPY, DIGESTS, FOUND = range(6)


class Text:
    """Texts of a block in one buffer; documents without an id or marked as copies take no part."""

    def __init__(self, ids: list[int | None], texts: list[bytes], copies: set[int]):
        self.texts = texts
        self.lengths = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
        self.active = np.array([i is not None and i not in copies for i in ids], dtype=bool)
        lengths = np.where(self.active, self.lengths, 0)
        joined = b"".join(t for t, a in zip(texts, self.active) if a)
        self.n = len(joined)
        padded = joined + bytes(64)
        self.buffer = np.frombuffer(padded, dtype=np.uint8)
        self.words = np.ndarray((len(padded) - 8,), dtype="<u8", buffer=padded, strides=(1,))
        self.ends = np.cumsum(lengths)
        self.starts = self.ends - lengths
        self.end = np.repeat(self.ends, lengths).astype(np.int64)
        offset = np.arange(self.n) - np.repeat(self.starts, lengths)
        # Rows of one id are one document here: only a smaller id counts as before.
        known = np.array([-1 if i is None else i for i in ids], dtype=np.int64)
        rank = np.cumsum(np.append(0, (known[1:] != known[:-1]).astype(np.int32))) if len(ids) else np.zeros(0, dtype=np.int64)
        self.rank = np.repeat(rank, lengths).astype(np.int32)
        sampled = np.zeros(MODULUS, dtype=bool)
        sampled[list(COVER)] = True
        self.sample = np.flatnonzero(sampled[offset % MODULUS] & (np.arange(self.n) + DEPTH <= self.end))

    def hashes(self, at: np.ndarray, depth: int, seed: int) -> np.ndarray:
        """A hash of the first `depth` bytes of each suffix, a million at a time."""
        offsets = [*range(0, depth - 8, 8), depth - 8]
        out = np.empty(len(at), dtype=np.uint64)
        for i in range(0, len(at), 1 << 20):
            part = at[i:i + (1 << 20)]
            h = np.full(len(part), seed, dtype=np.uint64)
            for o in offsets:
                h = (h ^ self.words[part + o]) * np.uint64(0x9E3779B97F4A7C15)
                h ^= h >> np.uint64(32)
            out[i:i + (1 << 20)] = mix(h)
        return out

    def near(self, shared: np.ndarray) -> np.ndarray:
        """Positions with LENGTH bytes left that have a flagged sample less than MODULUS ahead."""
        marks = np.zeros(self.n + MODULUS + 1, dtype=np.int32)
        marks[self.sample[shared] + 1] = 1
        seen = np.cumsum(marks)
        at = np.arange(self.n)
        return np.flatnonzero((seen[at + MODULUS] > seen[at]) & (at + LENGTH <= self.end))


def sample_values(text: Text, total_bits: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct values of the sampled suffixes (cut to `total_bits` leading bits), the index of each sample, and
    which values occur in several documents of the block."""
    h = text.hashes(text.sample, DEPTH, 1) >> np.uint64(64 - total_bits) << np.uint64(64 - total_bits)
    values, index = np.unique(h, return_inverse=True)
    low, high = np.full(len(values), 1 << 30, dtype=np.int32), np.full(len(values), -1, dtype=np.int32)
    owner = text.rank[text.sample]
    np.minimum.at(low, index, owner)
    np.maximum.at(high, index, owner)
    return values, index, low != high


def window_digests(text: Text, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Distinct digests (two words) of the suffixes `at`, the index of each, and the first document of each."""
    a, b = text.hashes(at, LENGTH, 2), text.hashes(at, LENGTH, 3)
    order = np.argsort(a, kind="stable")
    if ((a[order][1:] == a[order][:-1]) & (b[order][1:] != b[order][:-1])).any():
        order = np.lexsort((at, b, a))
    a, b = a[order], b[order]
    new = np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])) if len(a) else np.zeros(0, dtype=bool)
    index = np.empty(len(at), dtype=np.int64)
    index[order] = np.cumsum(new) - 1
    return a[new], b[new], index, text.rank[at[order][new]]


def repeated(ids: list[int | None]) -> set[int]:
    """Ids of several rows, which lie in one block; a digest speaks for one of them only, so all are sorted."""
    return {i for i, n in Counter(ids).items() if n > 1}


def copies_of(docs: DataFrame, texts: DataFrame) -> DataFrame:
    """`block`, `doc_id` of documents whose whole text also is that of a smaller id. Only digests are shuffled."""
    whole = texts.where("doc_id is not null").select("block", "doc_id", F.sha2(F.col("text").cast("binary"), 256).alias("same"))
    first = whole.groupBy("same").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first < last")
    return whole.join(first.select("same", "first"), "same").where("doc_id > first").select("block", "doc_id")


def remove_repeats(docs: DataFrame, block_bytes: int = 4_000_000, per_bucket: int = 6_000_000,
                   id_col: str = "doc_id", text_col: str = "text", content: bool = False) -> DataFrame:
    """`doc_id`, `n_bytes`, `n_removed`, `n_spans`, `kept_sha256` and, if asked for, `kept` (bytes).

    A byte goes if a 50-byte string over it also starts in a document with a smaller id; strings are judged on
    the input. Null texts are empty; texts under 50 bytes lose nothing. Rows without an id take no part and are kept
    whole. Rows that share an id are one document: they take nothing from each other. Whole copies of a
    text are settled by its digest and not sorted again.
    """
    blocks = Blocks(docs, block_bytes, per_bucket, id_col, text_col)
    spread = blocks.bucket_bits
    # One sampled suffix in a thousand may look shared without being so; that only costs another look.
    total_bits = min(64, max(spread + 16, int(np.ceil(np.log2(max(2, blocks.size) * len(COVER) / MODULUS))) + 10))
    width = max(1, int(np.ceil((2 * np.log2(max(2, blocks.size)) + 12 - 64) / 8)))
    width = min(8, width)

    def control(table: pa.Table) -> set[int]:
        return {p.as_py() for k, p in zip(table.column("kind"), table.column("place")) if k.as_py() == COPY}

    def send_samples(key: tuple, own: pa.Table, notes: pa.Table) -> pa.Table:
        if not own.num_rows:
            return mail([])
        ids, texts = documents(own)
        copies = control(notes) - repeated(ids)
        text = Text(ids, texts, copies)
        values, _, _ = sample_values(text, total_bits)
        block = key[0].as_py()
        rows = [(b, SAMPLES, block, pack(values[s] << np.uint64(spread) >> np.uint64(64 - total_bits + spread)))
                for b, s in in_buckets(values, spread)]
        if copies:
            rows.append((block, CARRY, block, np.array(sorted(copies), dtype="<i8").tobytes()))
        return mail(rows)

    def rank_samples(table: pa.Table) -> pa.Table:
        rows, places, parts = [], [], []
        for to, kind, place, blob in zip(*(table.column(c).to_pylist() for c in ("to", "kind", "place", "blob"))):
            if kind == CARRY:
                rows.append((place, CARRY, 0, blob))
            else:
                places.append((to, place))
                parts.append(unpack(blob))
        if parts:
            every, owner = np.concatenate(parts), np.repeat(np.arange(len(parts)), [len(p) for p in parts])
            order = np.argsort(every, kind="stable")
            same = np.append(False, every[order][1:] == every[order][:-1])
            shared = np.empty(len(every), dtype=bool)
            shared[order] = same | np.append(same[1:], False)
            ends = np.cumsum([len(p) for p in parts])
            for (to, place), a, b in zip(places, np.append(0, ends[:-1]), ends):
                rows.append((place, ANSWER, to, bits(shared[a:b])))
        return mail(rows)

    def answered(values: np.ndarray, notes: pa.Table, kind: int) -> np.ndarray:
        """Answers of all buckets in the order of the values."""
        got, out = letters(notes, kind), np.zeros(len(values), dtype=bool)
        for b, s in in_buckets(values, spread):
            out[s] = flags(got[b], s.stop - s.start)
        return out

    def state(own: pa.Table, copies: set[int], shared_of) -> tuple:
        text = Text(*documents(own), copies)
        values, index, several = sample_values(text, total_bits)
        return text, values, index, several, shared_of(values)

    def send_windows(key: tuple, own: pa.Table, notes: pa.Table) -> pa.Table:
        if not own.num_rows:
            return mail([])
        carried = letters(notes, CARRY).get(0, b"")
        copies = set(np.frombuffer(carried, dtype="<i8").tolist())
        text, values, index, _, shared = state(own, copies, lambda v: answered(v, notes, ANSWER))
        block = key[0].as_py()
        a, b, _, _ = window_digests(text, text.near(shared[index]))
        rows = [(to, DIGESTS, block, pack(a[s]) + b[s].astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].tobytes())
                for to, s in in_buckets(a, spread)]
        rows.append((block, CARRY, block, len(carried).to_bytes(8, "little") + carried + bits(shared)))
        return mail(rows)

    def rank_windows(table: pa.Table) -> pa.Table:
        rows, places, firsts, seconds = [], [], [], []
        for to, kind, place, blob in zip(*(table.column(c).to_pylist() for c in ("to", "kind", "place", "blob"))):
            if kind == CARRY:
                rows.append((place, CARRY, 0, blob))
                continue
            n, opened = _open(blob, width)
            places.append((to, place))
            firsts.append(opened)
            tail = np.zeros((n, 8), dtype=np.uint8)
            tail[:, :width] = np.frombuffer(blob[len(blob) - n * width:], dtype=np.uint8).reshape(n, width)
            seconds.append(tail.view("<u8").ravel())
        if places:
            sizes = [len(f) for f in firsts]
            block = np.repeat([p for _, p in places], sizes)
            a, b = np.concatenate(firsts), np.concatenate(seconds)
            order = np.lexsort((block, b, a))
            a, b = a[order], b[order]
            later = np.empty(len(a), dtype=bool)
            later[order] = np.append(False, (a[1:] == a[:-1]) & (b[1:] == b[:-1]))
            ends = np.cumsum(sizes)
            for (to, place), x, y in zip(places, np.append(0, ends[:-1]), ends):
                rows.append((place, FOUND, to, bits(later[x:y])))
        return mail(rows)

    def finish(key: tuple, own: pa.Table, notes: pa.Table) -> pa.Table:
        if not own.num_rows:
            return _result([], content)
        carried = letters(notes, CARRY)[0]
        cut = 8 + int.from_bytes(carried[:8], "little")
        copies = set(np.frombuffer(carried[8:cut], dtype="<i8").tolist())
        ids, texts = documents(own)
        text, _, index, several, shared = state(own, copies, lambda v: flags(carried[cut:], len(v)))
        at = text.near((shared | several)[index])
        a, _, mine, first = window_digests(text, at)
        sent = np.isin(at, text.near(shared[index]), assume_unique=True)
        asked = np.zeros(len(a), dtype=bool)
        asked[mine[sent]] = True
        before = np.zeros(len(a), dtype=bool)
        before[asked] = answered(a[asked], notes, FOUND)
        goes = at[before[mine] | (first[mine] < text.rank[at])]
        edges = np.zeros(text.n + LENGTH + 1, dtype=np.int32)
        edges[goes] += 1
        edges[goes + LENGTH] -= 1
        gone = np.cumsum(edges)[:text.n] > 0
        rows = []
        for i, (doc, whole) in enumerate(zip(ids, texts)):
            if doc in copies:
                removed = len(whole) >= LENGTH
                rows.append((doc, len(whole), len(whole) * removed, int(removed), b"" if removed else whole))
            elif not text.active[i]:
                rows.append((doc, len(whole), 0, 0, whole))
            else:
                mask = gone[text.starts[i]:text.ends[i]]
                removed = int(mask.sum())
                spans = int(mask[0]) + int((mask[1:] & ~mask[:-1]).sum()) if removed else 0
                kept = text.buffer[text.starts[i]:text.ends[i]][~mask].tobytes() if removed else whole
                rows.append((doc, len(whole), removed, spans, kept))
        return _result(rows, content)

    copies = copies_of(docs, blocks.texts).select(
        F.col("block").alias("to"), F.lit(COPY).alias("kind"), F.col("doc_id").alias("place"), F.lit(None).cast("binary").alias("blob"))
    ranks = (blocks.by_block().cogroup(copies.groupBy("to")).applyInArrow(send_samples, MAIL)
             .groupBy("to").applyInArrow(rank_samples, MAIL))
    found = (blocks.by_block().cogroup(ranks.groupBy("to")).applyInArrow(send_windows, MAIL)
             .groupBy("to").applyInArrow(rank_windows, MAIL))
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string" + (", kept binary" if content else "")
    return blocks.by_block().cogroup(found.groupBy("to")).applyInArrow(finish, schema)


def _open(blob: bytes, width: int) -> tuple[int, np.ndarray]:
    """The packed values at the head of a blob and how many they are."""
    raw = zstandard.ZstdDecompressor().decompressobj().decompress(blob)
    n = int(np.frombuffer(raw[:4], dtype=np.uint32)[0])
    planes = np.frombuffer(raw, dtype=np.uint8, offset=4).reshape(8, n)
    return n, np.cumsum(np.ascontiguousarray(planes.T).view("<u8").ravel(), dtype=np.uint64)


def _result(rows: list[tuple], content: bool) -> pa.Table:
    ids, sizes, removed, spans, kept = list(zip(*rows)) if rows else [(), (), (), (), ()]
    columns = {"doc_id": pa.array(ids, pa.int64()), "n_bytes": pa.array(sizes, pa.int64()), "n_removed": pa.array(removed, pa.int64()),
               "n_spans": pa.array(spans, pa.int64()), "kept_sha256": pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string())}
    if content:
        columns["kept"] = pa.array(kept, pa.binary())
    return pa.table(columns)
