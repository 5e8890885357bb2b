"""Byte-level BPE over many pre-tokens at once with a queue of merge ranks.

All pre-tokens of a batch lie in one linked list with gaps between them. A bucket per merge rank holds the
positions whose pair has that rank; a bitmap of three levels over the buckets gives the lowest rank that has
positions by find-first-set. A popped position is stale, and skipped, if its pair no longer has the bucket's rank.
One pop merges all live positions of the bucket, in every pre-token, so a long pre-token costs a number of
array operations that follows the ranks it uses and not the square of its length.
"""
from __future__ import annotations

import base64
import hashlib
import itertools
from collections import defaultdict
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from .common import ragged

NONE = np.int32(1 << 30)


def load_ranks(path: str) -> dict[bytes, int]:
    """Rank file: a base64 token and its rank on each line."""
    with open(path, "rb") as lines:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in lines if line.strip())}


class RankQueue:
    """Buckets of positions per rank under a bitmap of 64-bit words in three levels."""

    def __init__(self, ranks: int):
        self.buckets: dict[int, list[np.ndarray]] = {}
        self.levels = []
        while ranks > 1:
            ranks = -(-ranks // 64)
            self.levels.append([0] * ranks)

    def push(self, positions: np.ndarray, ranks: np.ndarray) -> None:
        live = ranks < NONE
        positions, ranks = positions[live], ranks[live]
        if not len(ranks):
            return
        order = np.argsort(ranks, kind="stable")
        positions, ranks = positions[order], ranks[order]
        cuts = np.flatnonzero(ranks[1:] != ranks[:-1]) + 1
        for rank, part in zip(ranks[np.concatenate([[0], cuts])].tolist(), np.split(positions, cuts)):
            if rank in self.buckets:
                self.buckets[rank].append(part)
                continue
            self.buckets[rank] = [part]
            for level in self.levels:
                word, bit = rank >> 6, rank & 63
                full = level[word]
                level[word] = full | 1 << bit
                if full:
                    break
                rank = word

    def pop(self) -> tuple[int, np.ndarray] | None:
        """The lowest rank and its positions in order; the bucket is empty afterwards."""
        if not self.levels[-1][0]:
            return None
        rank = 0
        for level in reversed(self.levels):
            word = level[rank]
            rank = rank << 6 | (word & -word).bit_length() - 1
        parts = self.buckets.pop(rank)
        at = rank
        for level in self.levels:
            level[at >> 6] &= ~(1 << (at & 63))
            if level[at >> 6]:
                break
            at >>= 6
        positions = np.sort(np.concatenate(parts))
        return rank, positions[np.concatenate([[True], positions[1:] != positions[:-1]])]


class Encoder:
    """Encodes byte strings by a table of ranks and decodes ids."""

    def __init__(self, ranks: dict[bytes, int]):
        self.size = max(ranks.values()) + 1
        self.token = {r: t for t, r in ranks.items()}
        missing = [b for b in range(256) if bytes([b]) not in ranks]
        if missing:
            raise ValueError(f"{len(missing)} single bytes have no rank")
        self.byte = np.array([ranks[bytes([b])] for b in range(256)], dtype=np.int32)
        self.end = self.size   # stands for the end of a piece
        pairs = [(ranks[t[:i]] * (self.size + 1) + ranks[t[i:]], r) for t, r in ranks.items() for i in range(1, len(t))
                 if t[:i] in ranks and t[i:] in ranks]
        codes = np.array([p[0] for p in pairs] or [0], dtype=np.int64)
        made = np.array([p[1] for p in pairs] or [NONE], dtype=np.int32)
        self._hash(codes, made)
        lengths = np.array([len(self.token.get(r, b"")) for r in range(self.size)], dtype=np.int64)
        self.ends = np.cumsum(lengths)
        self.lengths = lengths
        self.flat = np.frombuffer(b"".join(self.token.get(r, b"") for r in range(self.size)), dtype=np.uint8)

    def _hash(self, codes: np.ndarray, made: np.ndarray) -> None:
        """Open addressing: a pair lies at its slot or one of the next few."""
        self.bits = max(4, int(np.ceil(np.log2(len(codes) * 4))))
        size = 1 << self.bits
        self.keys = np.full(size + 64, -1, dtype=np.int64)
        self.values = np.full(size + 64, NONE, dtype=np.int32)
        self.probes = 1
        for code, value, slot in zip(codes.tolist(), made.tolist(), self._slot(codes).tolist()):
            steps = 1
            while self.keys[slot] not in (-1, code):
                slot, steps = slot + 1, steps + 1
            self.keys[slot], self.values[slot] = code, value
            self.probes = max(self.probes, steps)

    def _slot(self, codes: np.ndarray) -> np.ndarray:
        return ((codes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def rank(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of the token that the pair makes, NONE if there is no such token."""
        codes = a.astype(np.int64) * (self.size + 1) + b
        slot = self._slot(codes)
        found = np.where(self.keys[slot] == codes, self.values[slot], NONE)
        left = np.flatnonzero((self.keys[slot] != codes) & (self.keys[slot] != -1))
        for _ in range(self.probes):
            if not len(left):
                break
            slot[left] += 1
            here = self.keys[slot[left]]
            hit = here == codes[left]
            found[left[hit]] = self.values[slot[left[hit]]]
            left = left[~hit & (here != -1)]
        return found

    def encode(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all pieces one after the other, and the number of ids of each piece."""
        lengths = np.fromiter(map(len, pieces), dtype=np.int64, count=len(pieces))
        data = np.frombuffer(b"".join(pieces), dtype=np.uint8)
        n = len(data)
        if not n:
            return np.zeros(0, dtype=np.int32), np.zeros(len(pieces), dtype=np.int64)
        # Position n is the end that all pieces share.
        token = np.append(self.byte[data], np.int32(self.end))
        piece = np.repeat(np.arange(len(pieces), dtype=np.int32), lengths)
        nxt, prv = np.arange(1, n + 2, dtype=np.int32), np.arange(-1, n, dtype=np.int32)
        last = np.cumsum(lengths)[lengths > 0] - 1
        nxt[last] = n
        prv[np.append(0, last[:-1] + 1)] = n
        nxt[n] = prv[n] = n
        whole = self._whole(pieces, lengths)
        current = np.full(n + 1, NONE, dtype=np.int32)
        current[:n] = self.rank(token[:n], token[nxt[:n]])
        current[:n][np.repeat(whole >= 0, lengths)] = NONE
        queue = RankQueue(self.size)
        queue.push(np.arange(n, dtype=np.int32), current[:n])
        alive = np.ones(n + 1, dtype=bool)
        head, tail = np.zeros(n + 1, dtype=bool), np.zeros(n + 1, dtype=bool)
        while (popped := queue.pop()) is not None:
            rank, at = popped
            at = at[alive[at] & (current[at] == rank)]
            if not len(at):
                continue
            at = self._apart(at, nxt)
            gone = nxt[at]
            after = nxt[gone]
            head[at] = tail[gone] = True
            # The pair to the right before the right neighbour merges itself, as a merge one by one would see it.
            made = np.full(len(at), rank, dtype=np.int32)
            right = self.rank(made, token[after])
            before = prv[at]
            left = self.rank(np.where(tail[before], np.int32(rank), token[before]), made)
            head[at], early = False, np.minimum(right, left) < rank
            tail[gone] = False
            if early.any():
                at, gone, after = self._until(at, gone, after, early, piece, rank, queue)
                right, left = right[:0], left[:0]
            token[at] = rank
            alive[gone] = False
            current[gone] = NONE
            nxt[at] = after
            prv[after] = at
            nxt[n] = prv[n] = n
            before = prv[at]
            head[at] = True
            made = token[at]
            if len(right) != len(at):
                right, left = self.rank(made, token[after]), self.rank(token[before], made)
            else:
                merged = np.flatnonzero(head[after])
                right[merged] = self.rank(made[merged], token[after[merged]])
            head[at] = False
            current[at] = right
            has = before < n
            current[before[has]] = left[has]
            queue.push(at, right)
            queue.push(before[has], left[has])
        alive[n] = False
        counts = np.bincount(piece[alive[:n]], minlength=len(pieces)).astype(np.int64)
        ids = token[:n][alive[:n]]
        if (whole >= 0).any():
            keep = np.repeat(whole < 0, counts)
            first = np.cumsum(counts) - counts
            for_whole = first[whole >= 0]
            keep[for_whole] = True
            ids = ids.copy()
            ids[for_whole] = whole[whole >= 0]
            ids = ids[keep]
            counts[whole >= 0] = 1
        return ids, counts

    def _whole(self, pieces: list[bytes], lengths: np.ndarray) -> np.ndarray:
        """The rank of pieces that are tokens as they stand, -1 for the others."""
        if not hasattr(self, "ranks"):
            self.ranks = {t: r for r, t in self.token.items()}
        get = self.ranks.get
        return np.fromiter((get(p, -1) for p in pieces), dtype=np.int32, count=len(pieces))

    @staticmethod
    def _apart(at: np.ndarray, nxt: np.ndarray) -> np.ndarray:
        """Of positions that overlap in a chain (each the next of the one before), every second from the first."""
        chained = np.concatenate([[False], nxt[at[:-1]] == at[1:]])
        if not chained.any():
            return at
        index = np.arange(len(at))
        start = np.maximum.accumulate(np.where(chained, 0, index))
        return at[(index - start) % 2 == 0]

    @staticmethod
    def _until(at, gone, after, early, piece, rank, queue):
        """Per piece, the merges up to the first that makes a pair of lower rank; the others go back to the bucket."""
        owner = piece[at]
        first = np.concatenate([[True], owner[1:] != owner[:-1]])
        seen = np.cumsum(early) - early
        base = np.maximum.accumulate(np.where(first, np.arange(len(at)), 0))
        ok = seen - seen[base] == 0
        queue.push(at[~ok], np.full(int((~ok).sum()), rank, dtype=np.int32))
        return at[ok], gone[ok], after[ok]

    def decode(self, ids: np.ndarray) -> bytes:
        """Bytes of the ids; a number that is no id is an error."""
        if len(ids) and (ids.min() < 0 or ids.max() >= self.size or not self.lengths[ids].all()):
            raise ValueError("an id has no token")
        out = []
        for i in range(0, len(ids), 1 << 18):
            part = ids[i:i + (1 << 18)]
            out.append(self.flat[ragged(self.ends[part] - self.lengths[part], self.lengths[part])].tobytes())
        return b"".join(out)


class TextEncoder:
    """Texts to ids: pre-tokens by `pattern`, each new one encoded once per group of texts and remembered."""

    def __init__(self, ranks: dict[bytes, int], pattern: str, keep: int = 400_000):
        self.encoder = Encoder(ranks)
        # White space of the pattern means the Unicode property.
        self.pattern = regex.compile(pattern.replace(r"\s", r"\p{White_Space}").replace(r"\S", r"\P{White_Space}"))
        self.keep = keep
        self.clear()

    def clear(self) -> None:
        self.index: defaultdict[str, int] = defaultdict(itertools.count().__next__)   # numbers in order of coming
        self.ids = np.zeros(0, dtype=np.int32)
        self.starts = self.counts = np.zeros(0, dtype=np.int64)

    def _pieces(self, text: str) -> np.ndarray:
        number = self.index.__getitem__
        if len(text) <= 4_000_000:
            pieces = self.pattern.findall(text)
            return np.fromiter(map(number, pieces), dtype=np.int32, count=len(pieces))
        return np.fromiter((number(m.group()) for m in self.pattern.finditer(text)), dtype=np.int32)

    def encode(self, texts: Iterable[str], together: int = 8_000_000) -> Iterator[np.ndarray]:
        """Ids of each text in order. New pre-tokens of about `together` characters go through the queue at once."""
        held: list[np.ndarray] = []
        size = 0
        for text in texts:
            held.append(self._pieces(text))
            size += len(text)
            if size >= together:
                yield from self._finish(held)
                held, size = [], 0
        yield from self._finish(held)

    def _finish(self, held: list[np.ndarray]) -> Iterator[np.ndarray]:
        new = [p.encode() for p in list(self.index)[len(self.starts):]]
        if new:
            ids, counts = self.encoder.encode(new)
            starts = np.cumsum(counts) - counts + len(self.ids)
            self.ids = np.concatenate([self.ids, ids])
            self.starts = np.concatenate([self.starts, starts])
            self.counts = np.concatenate([self.counts, counts])
        for pieces in held:
            yield self.ids[ragged(self.starts[pieces], self.counts[pieces])]
        if len(self.index) > self.keep:
            self.clear()


def encode_texts(docs: DataFrame, ranks: dict[bytes, int], pattern: str, ids: bool = True,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """`doc_id`, `n_tokens`, `ids_sha256`, `decoded_sha256` and, if asked for, `ids`.

    Every match of `pattern` is encoded by itself, no special tokens; the ids are decoded again for the last
    digest. Null texts are empty. One row per input row, also for repeated rows and ids; other columns are not looked at. A pre-token of any
    length goes through one queue, so a very long text costs its length. An empty table gives an empty table. The rank table goes to the executors as a broadcast (the
    size of a vocabulary, whatever the data).
    """
    shared = docs.sparkSession.sparkContext.broadcast(ranks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = None
        for batch in batches:
            encoder = encoder or TextEncoder(shared.value, pattern)
            column = batch.column("text")
            at, size = 0, 0
            rows: list[tuple] = []
            for made in encoder.encode((v.as_py() or "" for v in column)):
                rows.append((len(made), hashlib.sha256(made.astype("<u4").tobytes()).hexdigest(),
                             hashlib.sha256(encoder.encoder.decode(made)).hexdigest(), made if ids else None))
                size += len(made)
                if size > 2_000_000:
                    yield _rows(batch.column("doc_id").slice(at, len(rows)), rows, ids)
                    at, size, rows = at + len(rows), 0, []
            yield _rows(batch.column("doc_id").slice(at, len(rows)), rows, ids)

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids array<int>" if ids else "")
    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
            .mapInArrow(run, schema))


def _rows(doc_ids: pa.Array, rows: list[tuple], ids: bool) -> pa.RecordBatch:
    arrays = [doc_ids, pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.string()),
              pa.array([r[2] for r in rows], pa.string())]
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    if ids:
        ends = np.cumsum([0] + [r[0] for r in rows]).astype(np.int32)
        flat = np.concatenate([r[3] for r in rows]) if rows else np.zeros(0, dtype=np.int32)
        arrays.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(flat, pa.int32())))
        names.append("ids")
    return pa.RecordBatch.from_arrays(arrays, names)


def decode_ids(encoded: DataFrame, ranks: dict[bytes, int], id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """`doc_id`, `content`: the bytes of an array of ids; a null array gives null."""
    shared = encoded.sparkSession.sparkContext.broadcast(ranks)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = None
        for batch in batches:
            encoder = encoder or Encoder(shared.value)
            made = [encoder.decode(np.asarray(v.values, dtype=np.int64)) if v.is_valid else None
                    for v in batch.column("ids")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(made, pa.binary())], ["doc_id", "content"])

    return (encoded.select(F.col(id_col).cast("long").alias("doc_id"), F.col(ids_col).cast("array<int>").alias("ids"))
            .mapInArrow(run, "doc_id long, content binary"))
