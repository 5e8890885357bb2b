"""Removal of repeated word windows by suffix automata of reference shards.

Every window of WINDOW words has an anchor: the shingle of SHINGLE words with the least hash in it. Windows that
follow each other and share their anchor form a segment, and equal windows have equal anchors. So segments are
sent to shards by their anchor, and only those whose anchor occurs more than once. A shard goes through the segments
of an anchor in the order of the corpus: it streams a segment over the suffix automaton of the segments before it, whose
matching statistics (the length of the longest match that ends at a word) of WINDOW or more tell the windows
that were there before, and then adds it to the automaton.

The reference is the corpus itself and has no size bound, so the automata are not broadcast: segments go to
the shard that could match them, and a shard's automaton covers one anchor at a time.
"""
from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame

from .blocks import MAIL, Blocks, bits, documents, flags, in_buckets, letters, mail, pack, unpack
from .common import mix, ragged

WINDOW, SHINGLE = 20, 10
SPAN = WINDOW - SHINGLE + 1
ANCHORS, ANSWER, SEGMENTS, FOUND, CARRY = range(5)
ODD = 0x9E3779B97F4A7C15


class SuffixAutomaton:
    """Automaton of the substrings of several sequences."""

    def __init__(self):
        self.next: list[dict] = [{}]
        self.link, self.length, self.last = [-1], [0], 0

    def _state(self, length: int, link: int, moves: dict) -> int:
        self.next.append(moves)
        self.link.append(link)
        self.length.append(length)
        return len(self.length) - 1

    def _split(self, state: int, item) -> int:
        """The state after `item` from `state`, cut off from longer strings if need be."""
        target = self.next[state][item]
        if self.length[target] == self.length[state] + 1:
            return target
        clone = self._state(self.length[state] + 1, self.link[target], dict(self.next[target]))
        while state >= 0 and self.next[state].get(item) == target:
            self.next[state][item] = clone
            state = self.link[state]
        self.link[target] = clone
        return clone

    def add(self, sequence) -> None:
        last = 0
        for item in sequence:
            if item in self.next[last]:
                last = self._split(last, item)
                continue
            new = self._state(self.length[last] + 1, 0, {})
            state = last
            while state >= 0 and item not in self.next[state]:
                self.next[state][item] = new
                state = self.link[state]
            self.link[new] = 0 if state < 0 else self._split(state, item)
            last = new

    def statistics(self, sequence) -> list[int]:
        """For every place, the length of the longest match that ends there."""
        state, length, out = 0, 0, []
        for item in sequence:
            while state and item not in self.next[state]:
                state = self.link[state]
                length = self.length[state]
            if item in self.next[state]:
                state = self.next[state][item]
                length += 1
            out.append(length)
        return out


class Words:
    """Words of a block's documents as numbers, and their segments."""

    def __init__(self, ids: list[int | None], texts: list[bytes]):
        joined = b" ".join(texts)
        buffer = np.frombuffer(joined, dtype=np.uint8)
        n = len(buffer)
        blank = (buffer == 32) | ((buffer >= 9) & (buffer <= 13))
        edge = np.diff(np.concatenate([[True], blank, [True]]).astype(np.int8))
        starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
        powers, inverse = _powers(n + 1)
        sums = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum((buffer.astype(np.uint64) + np.uint64(1)) * powers[:n], dtype=np.uint64)])
        self.words = mix((sums[ends] - sums[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))
        lengths = np.fromiter((len(t) + 1 for t in texts), dtype=np.int64, count=len(texts))
        heads = np.cumsum(lengths) - lengths
        self.doc = np.searchsorted(heads, starts, side="right") - 1
        self.first = np.searchsorted(self.doc, np.arange(len(texts)))
        self.count = np.bincount(self.doc, minlength=len(texts)) if len(texts) else np.zeros(0, dtype=np.int64)
        active = np.array([i is not None for i in ids], dtype=bool)
        self._segments(active)

    def _segments(self, active: np.ndarray) -> None:
        m = len(self.words)
        shingle = np.zeros(max(0, m - SHINGLE + 1), dtype=np.uint64)
        for j in range(SHINGLE):
            shingle = (shingle ^ self.words[j:j + len(shingle)]) * np.uint64(ODD)
            shingle ^= shingle >> np.uint64(32)
        shingle = mix(shingle)
        k = max(0, m - WINDOW + 1)
        at = np.flatnonzero((self.doc[:k] == self.doc[WINDOW - 1:WINDOW - 1 + k]) & active[self.doc[:k]]) if k else np.zeros(0, dtype=np.int64)
        least, anchor = shingle[at], at.copy()
        for j in range(1, SPAN):
            other = shingle[at + j]
            less = other < least
            least[less] = other[less]
            anchor[less] = at[less] + j
        new = np.append(True, (anchor[1:] != anchor[:-1]) | (at[1:] != at[:-1] + 1)) if len(at) else np.zeros(0, dtype=bool)
        self.start = at[new]                                   # first window of a segment
        self.windows = np.diff(np.append(np.flatnonzero(new), len(at)))
        self.key = least[new]


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse modulo 2**64."""
    back = pow(ODD, -1, 1 << 64)
    out = []
    for base in (ODD, back):
        p = np.full(n, base, dtype=np.uint64)
        p[0] = 1
        out.append(np.cumprod(p, dtype=np.uint64))
    return out[0], out[1]


def _counted(values: np.ndarray, times: np.ndarray) -> bytes:
    """Rising values and how often each occurs."""
    packed = pack(values)
    return np.uint32(len(packed)).tobytes() + packed + zstandard.ZstdCompressor(level=1).compress(np.minimum(times, 0xFFFF).astype("<u2").tobytes())


def _counts(blob: bytes) -> tuple[np.ndarray, np.ndarray]:
    n = 4 + int(np.frombuffer(blob[:4], dtype=np.uint32)[0])
    return unpack(blob[4:n]), np.frombuffer(zstandard.ZstdDecompressor().decompress(blob[n:]), dtype="<u2")


def digests(words: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """A hash of each run of words."""
    if not len(starts):
        return np.zeros(0, dtype=np.uint64)
    local = ragged(np.zeros(len(lengths), dtype=np.int64), lengths)
    powers, _ = _powers(int(lengths.max()) + 1)
    terms = mix(words[ragged(starts, lengths)]) * powers[local]
    return mix(np.add.reduceat(terms, np.cumsum(lengths) - lengths) + lengths.astype(np.uint64))


def earlier_windows(keys: np.ndarray, lengths: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Per segment, in the order of the corpus, a bit mask of the windows that occur in a segment before it.

    A segment is streamed over the automaton of those before it with its anchor; one that is in it as a whole is not added again.
    """
    starts = np.cumsum(lengths) - lengths
    masks = np.zeros(len(keys), dtype=np.uint16)
    order = np.argsort(keys, kind="stable")
    cuts = np.append(np.flatnonzero(np.append(True, keys[order][1:] != keys[order][:-1])), len(order)) if len(order) else []
    for a, b in zip(cuts[:-1], cuts[1:]):
        if b - a < 2:
            continue
        automaton = SuffixAutomaton()
        for k in range(a, b):
            i = order[k]
            segment = words[starts[i]:starts[i] + lengths[i]].tolist()
            if k > a:
                found = automaton.statistics(segment)
                masks[i] = sum(1 << j for j, m in enumerate(found[WINDOW - 1:]) if m >= WINDOW)
                if found[-1] == len(segment):
                    continue
            if k < b - 1:
                automaton.add(segment)
    return masks


def remove_repeats(docs: DataFrame, block_bytes: int = 4_000_000, per_bucket: int = 6_000_000, hot: int = 2048,
                   id_col: str = "doc_id", text_col: str = "text", content: bool = False) -> DataFrame:
    """`doc_id`, `n_words`, `n_removed`, `kept_sha256` and, if asked for, `kept` (text).

    Words are runs of bytes other than blanks, unchanged. A word goes if a window of 20 words over it also starts
    earlier: in a document with a smaller id or further ahead in its own. Windows are judged on the input. Null texts have
    no words; texts under 20 words lose nothing. Rows without an id take no part and are kept whole.
    Rows that share an id are taken one after the other, in the order of their texts. Words are compared by 64-bit hashes,
    so a window by 1280 bits.

    An anchor with more than `hot` segments would bring them all to one shard: those are split into their windows, which go
    to shards by themselves, each once per block; equal windows are one path of an automaton, so that it stays small.
    """
    blocks = Blocks(docs, block_bytes, per_bucket, id_col, text_col)
    spread = blocks.bucket_bits

    def send_anchors(key: tuple, own: pa.Table) -> pa.Table:
        words = Words(*documents(own))
        values, times = np.unique(words.key, return_counts=True)
        return mail([(b, ANCHORS, key[0].as_py(), _counted(values[s], times[s])) for b, s in in_buckets(values, spread)])

    def count_anchors(table: pa.Table) -> pa.Table:
        tos, places, blobs = (table.column(c).to_pylist() for c in ("to", "place", "blob"))
        parts, counts = zip(*map(_counts, blobs))
        _, index, times = np.unique(np.concatenate(parts), return_inverse=True, return_counts=True)
        segments = np.bincount(index, np.concatenate(counts))
        ends, rows = np.cumsum([len(p) for p in parts]), []
        for to, place, a, b in zip(tos, places, np.append(0, ends[:-1]), ends):
            own = index[a:b]
            rows.append((place, ANSWER, to, bits(np.concatenate([times[own] > 1, segments[own] > hot]))))
        return mail(rows)

    def chosen(shared: np.ndarray, large: np.ndarray, words: Words) -> dict[str, np.ndarray]:
        """Segments that may repeat, hot ones cut into windows, and which of them repeat one of this block."""
        values, index, times = np.unique(words.key, return_inverse=True, return_counts=True)
        pick = (shared | (times > 1))[index]
        start, windows, keys, big = words.start[pick], words.windows[pick], words.key[pick], large[index][pick]
        parts = np.where(big, windows, 1)
        starts = ragged(start, parts)
        lengths = np.repeat(np.where(big, WINDOW, windows + WINDOW - 1), parts)
        keys = np.repeat(keys, parts)
        whole = digests(words.words, starts, lengths)
        single = np.repeat(big, parts)
        keys[single] = mix(whole[single])
        order = np.lexsort((np.arange(len(keys)), whole, lengths, keys))
        again = np.zeros(len(keys), dtype=bool)
        if len(keys):
            again[order] = np.append(False, (keys[order][1:] == keys[order][:-1]) & (lengths[order][1:] == lengths[order][:-1])
                                     & (whole[order][1:] == whole[order][:-1]))
        return {"start": starts, "length": lengths, "key": keys, "again": again}

    def answers(words: Words, notes: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        values, got = np.unique(words.key), letters(notes, ANSWER)
        shared, large = np.zeros(len(values), dtype=bool), np.zeros(len(values), dtype=bool)
        for b, s in in_buckets(values, spread):
            n = s.stop - s.start
            both = flags(got[b], 2 * n)
            shared[s], large[s] = both[:n], both[n:]
        return shared, large

    def shipped(segments: dict[str, np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Segments to send, by key and then place, and their keys."""
        send = np.flatnonzero(~segments["again"])
        send = send[np.lexsort((send, segments["key"][send]))]
        return send, segments["key"][send]

    def send_segments(key: tuple, own: pa.Table, notes: pa.Table) -> pa.Table:
        if not own.num_rows:
            return mail([])
        block, words = key[0].as_py(), Words(*documents(own))
        shared, large = answers(words, notes)
        segments = chosen(shared, large, words)
        send, keys = shipped(segments)
        rows = []
        for to, s in in_buckets(keys, spread):
            at, lengths = segments["start"][send[s]], segments["length"][send[s]]
            body = words.words[ragged(at, lengths)].astype("<u8").tobytes()
            rows.append((to, SEGMENTS, block, np.uint32(len(at)).tobytes() + keys[s].astype("<u8").tobytes()
                         + lengths.astype(np.uint8).tobytes() + body))
        rows.append((block, CARRY, block, bits(np.concatenate([shared, large]))))
        return mail(rows)

    def match_segments(table: pa.Table) -> pa.Table:
        rows, got = [], []
        for to, kind, place, blob in zip(*(table.column(c).to_pylist() for c in ("to", "kind", "place", "blob"))):
            if kind == CARRY:
                rows.append((place, CARRY, 0, blob))
            else:
                got.append((place, to, blob))
        if got:
            got.sort(key=lambda g: g[0])
            keys, lengths, words = [], [], []
            for _, _, blob in got:
                n = int(np.frombuffer(blob[:4], dtype=np.uint32)[0])
                keys.append(np.frombuffer(blob, dtype="<u8", count=n, offset=4))
                lengths.append(np.frombuffer(blob, dtype=np.uint8, count=n, offset=4 + 8 * n).astype(np.int64))
                words.append(np.frombuffer(blob[4 + 9 * n:], dtype="<u8"))
            masks = earlier_windows(np.concatenate(keys), np.concatenate(lengths), np.concatenate(words))
            ends = np.cumsum([len(k) for k in keys])
            for (place, to, _), a, b in zip(got, np.append(0, ends[:-1]), ends):
                rows.append((place, FOUND, to, masks[a:b].astype("<u2").tobytes()))
        return mail(rows)

    def finish(key: tuple, own: pa.Table, notes: pa.Table) -> pa.Table:
        if not own.num_rows:
            return _result([], content)
        ids, texts = documents(own)
        words = Words(ids, texts)
        n = len(np.unique(words.key))
        carried = flags(letters(notes, CARRY)[0], 2 * n)
        segments = chosen(carried[:n], carried[n:], words)
        send, keys = shipped(segments)
        masks, got = np.zeros(len(segments["key"]), dtype=np.int64), letters(notes, FOUND)
        for to, s in in_buckets(keys, spread):
            masks[send[s]] = np.frombuffer(got[to], dtype="<u2")
        masks[segments["again"]] = (1 << SPAN) - 1
        edges = np.zeros(len(words.words) + 1, dtype=np.int32)
        for j in range(SPAN):
            here = segments["start"][(masks >> j & 1 == 1) & (j <= segments["length"] - WINDOW)] + j
            np.add.at(edges, here, 1)
            np.add.at(edges, here + WINDOW, -1)
        stay = np.cumsum(edges)[:-1] == 0
        rows = []
        for i, (doc, text) in enumerate(zip(ids, texts)):
            a, m = int(words.first[i]), int(words.count[i])
            mask, own_words = stay[a:a + m], text.split()
            removed = m - int(mask.sum())
            kept = [w for w, k in zip(own_words, mask.tolist()) if k] if removed else own_words
            rows.append((doc, m, removed, b" ".join(kept)))
        return _result(rows, content)

    anchors = (blocks.by_block().applyInArrow(send_anchors, MAIL).groupBy("to").applyInArrow(count_anchors, MAIL))
    found = (blocks.by_block().cogroup(anchors.groupBy("to")).applyInArrow(send_segments, MAIL)
             .groupBy("to").applyInArrow(match_segments, MAIL))
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string" + (", kept string" if content else "")
    return blocks.by_block().cogroup(found.groupBy("to")).applyInArrow(finish, schema)


def _result(rows: list[tuple], content: bool) -> pa.Table:
    ids, sizes, removed, kept = list(zip(*rows)) if rows else [(), (), (), ()]
    columns = {"doc_id": pa.array(ids, pa.int64()), "n_words": pa.array(sizes, pa.int64()), "n_removed": pa.array(removed, pa.int64()),
               "kept_sha256": pa.array([hashlib.sha256(k).hexdigest() for k in kept], pa.string())}
    if content:
        columns["kept"] = pa.array([k.decode() for k in kept], pa.string())
    return pa.table(columns)
