"""SentencePiece BPE with a table of distinct chunks.

A text is marked as the library does: one whitespace marker in front, one for each space. If no piece of the vocabulary has a
marker behind another character, no merge can cross the place before a run of markers. So a text is cut there, each distinct
chunk (a run of markers and the word behind it) is segmented once, and the ids come back by the chunks' positions. New short
chunks are merged many at once, in rounds over arrays; long ones have a heap each. The vocabulary is checked for this; a model
that normalizes or has other kinds of pieces is refused.
"""
from __future__ import annotations

import hashlib
import itertools
import re
from collections import defaultdict
from collections.abc import Iterable, Iterator
from heapq import heapify, heappop, heappush
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import ragged

MARK = "▁"
CHUNK = re.compile(f"{MARK}+[^{MARK}]*")
CROSSING = re.compile(f"[^{MARK}]{MARK}")
SHORT, FEW, BLOCK = 64, 256, 16_000     # characters of a short chunk; chunks that pay for a round; chunks of one call
NONE, GONE = np.iinfo(np.int32).max, -1


class Merges(NamedTuple):
    """Pairs of symbols that make a piece. A symbol is the id of a piece, or a number behind them for a character that is none."""
    chars: dict[str, int]   # symbols of the characters of pieces
    other: int              # symbol of all other characters
    keys: np.ndarray        # left * (other + 1) + right, ascending, and a last one that no pair has
    ranks: np.ndarray       # the better the score, the smaller; equal for equal scores
    made: np.ndarray


class Vocabulary(NamedTuple):
    scores: dict[str, float]      # of the pieces that merges may make
    ids: dict[str, int]
    first_byte: int               # id of the byte 0; the others follow
    surfaces: list[bytes | None]  # what an id decodes to; None for the unknown piece
    end: int
    merges: Merges


def _merges(scores: dict[str, float], ids: dict[str, int], n_ids: int) -> Merges:
    loose = sorted({c for piece in ids for c in piece} - ids.keys())
    numbers = ids | {c: n_ids + i for i, c in enumerate(loose)}
    other = n_ids + len(loose)
    ranks = np.unique([-s for s in scores.values()], return_inverse=True)[1].tolist()
    found = sorted((numbers[piece[:i]] * (other + 1) + numbers[piece[i:]], rank, ids[piece]) for piece, rank in zip(scores, ranks)
                   for i in range(1, len(piece)) if piece[:i] in numbers and piece[i:] in numbers)
    keys, ranks, made = np.array(found + [(np.iinfo(np.int64).max, NONE, GONE)], dtype=np.int64).T
    return Merges({c: n for c, n in numbers.items() if len(c) == 1}, other, keys.copy(), ranks.astype(np.int32), made.astype(np.int32))


def load_vocabulary(path: str) -> Vocabulary:
    """The pieces of a model file, read by the library; a few ten thousand, whatever the data."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    scores, ids, surfaces, byte_ids = {}, {}, [], []
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            surfaces.append(bytes([int(piece[3:5], 16)]))
            byte_ids.append((surfaces[-1][0], i))
        elif model.is_control(i):
            surfaces.append(b"")
        elif model.is_unknown(i):
            surfaces.append(None)
        elif model.is_unused(i) or CROSSING.search(piece):
            raise ValueError(f"piece {i} can't be cut at whitespace markers")
        else:
            scores[piece], ids[piece] = model.get_score(i), i
            surfaces.append(piece.replace(MARK, " ").encode())
    first = byte_ids[0][1] if byte_ids else 0
    if byte_ids != [(b, first + b) for b in range(256)]:
        raise ValueError("the model has no piece for each byte")
    sample = "   ａﬁ  ①é\t"
    if model.decode(model.encode(sample)) != sample or model.encode("a")[0] != ids.get(MARK + "a", -1):
        raise ValueError("the model changes texts before it cuts them")
    return Vocabulary(scores, ids, first, surfaces, model.eos_id(), _merges(scores, ids, len(surfaces)))


class Segmenter:
    """Merges of chunks, the best score first, of equal scores the leftmost."""

    def __init__(self, vocabulary: Vocabulary):
        self.scores, self.ids, self.first_byte = vocabulary.scores, vocabulary.ids, vocabulary.first_byte
        self.longest = max(map(len, self.scores), default=0)
        self.n_ids, self.merges = len(vocabulary.surfaces), vocabulary.merges
        self.symbols = np.full(0x110000, self.merges.other, dtype=np.int32)
        for char, symbol in self.merges.chars.items():
            self.symbols[ord(char)] = symbol

    def segment(self, chunk: str) -> list[int]:
        known = self.ids.get(chunk)
        if known is not None and len(chunk) == 1:
            return [known]
        parts: list[str | None] = list(chunk)
        n, get, longest = len(parts), self.scores.get, self.longest
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        queue = [(-s, i, i + 1, 2) for i in range(n - 1) if (s := get(chunk[i:i + 2])) is not None]
        heapify(queue)
        while queue:
            _, left, right, size = heappop(queue)
            a, b = parts[left], parts[right]
            if a is None or b is None or len(a) + len(b) != size:
                continue    # one of the two has been merged since
            whole = parts[left] = a + b
            parts[right] = None
            follow = after[right]
            after[left] = follow
            if follow < n:
                before[follow] = left
                size = len(whole) + len(parts[follow])
                if size <= longest and (s := get(whole + parts[follow])) is not None:
                    heappush(queue, (-s, left, follow, size))
            ahead = before[left]
            if ahead >= 0:
                size = len(whole) + len(parts[ahead])
                if size <= longest and (s := get(parts[ahead] + whole)) is not None:
                    heappush(queue, (-s, ahead, left, size))
        out: list[int] = []
        for part in parts:
            if part is not None:
                found = self.ids.get(part)
                if found is None:
                    out += [self.first_byte + b for b in part.encode()]
                else:
                    out.append(found)
        return out

    def _pairs(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank (or NONE) and result of each pair of symbols."""
        keys = left.astype(np.int64) * (self.merges.other + 1) + right
        at = np.searchsorted(self.merges.keys, keys)
        at[self.merges.keys[at] != keys] = -1
        return self.merges.ranks[at], self.merges.made[at]

    def segment_many(self, chunks: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of chunks, one chunk after the other, and their counts. In a round each chunk takes its next merge or is done."""
        points = np.frombuffer("".join(chunks).encode("utf-32-le"), dtype="<u4")
        counts = np.fromiter(map(len, chunks), dtype=np.int64, count=len(chunks))
        starts = first = np.cumsum(counts) - counts
        out = self.symbols[points]      # a merged symbol stands where its first character was
        now, places = out.copy(), np.arange(len(out))
        ranks, made = np.full(len(out), NONE, dtype=np.int32), np.full(len(out), GONE, dtype=np.int32)
        ranks[:-1], made[:-1] = self._pairs(now[:-1], now[1:])
        ranks[first[1:] - 1] = NONE
        while len(now):
            best = np.minimum.reduceat(ranks.astype(np.int64) << 32 | np.arange(len(now)), starts)
            live = best < NONE << 32
            left = best[live] & 0xFFFFFFFF
            out[places[left]] = now[left] = made[left]
            out[places[left + 1]] = GONE
            ranks[left] = NONE
            keep, before = np.repeat(live, counts), left - starts[live]
            keep[left + 1] = False
            now, places, ranks, made = now[keep], places[keep], ranks[keep], made[keep]
            counts = counts[live] - 1
            starts = np.cumsum(counts) - counts
            left = starts + before
            again = np.concatenate([left[before + 1 < counts], left[before > 0] - 1])
            ranks[again], made[again] = self._pairs(now[again], now[again + 1])
        width = (out != GONE).astype(np.int64)
        spelt = out >= self.n_ids       # characters without a piece are their bytes
        chars = points[spelt]
        width[spelt] += (chars >= 0x80).astype(np.int64) + (chars >= 0x800) + (chars >= 0x10000)
        ids = np.repeat(out, width)
        spelling = np.frombuffer(chars.tobytes().decode("utf-32-le").encode(), dtype=np.uint8)
        ids[np.repeat(spelt, width)] = spelling.astype(np.int32) + self.first_byte
        return ids, np.add.reduceat(width, first)


class ChunkTable:
    """Ids of the distinct chunks met so far; more than `keep` of them, or ids beyond `keep_ids`, are made anew."""

    def __init__(self, vocabulary: Vocabulary, keep: int = 500_000, keep_ids: int = 20_000_000):
        self.segmenter, self.keep, self.keep_ids = Segmenter(vocabulary), keep, keep_ids
        self.clear()

    def clear(self) -> None:
        self.index: defaultdict[str, int] = defaultdict(itertools.count().__next__)   # numbers in order of coming
        self.ids = np.zeros(0, dtype=np.int32)
        self.starts = self.counts = np.zeros(0, dtype=np.int64)

    def encode(self, texts: Iterable[str], together: int = 4_000_000) -> Iterator[np.ndarray]:
        """Ids of each text in order. New chunks of about `together` characters are segmented at once."""
        number, held, size = self.index.__getitem__, [], 0
        for text in texts:
            chunks = CHUNK.findall(MARK + text.replace(" ", MARK)) if text else []
            held.append(np.fromiter(map(number, chunks), dtype=np.int64, count=len(chunks)))
            size += len(text)
            if size >= together:
                yield from self._finish(held)
                held, size, number = [], 0, self.index.__getitem__
        yield from self._finish(held)

    def _finish(self, held: list[np.ndarray]) -> Iterator[np.ndarray]:
        new = list(itertools.islice(self.index, len(self.starts), None))
        if new:
            self._add(new)
        for chunks in held:
            yield self.ids[ragged(self.starts[chunks], self.counts[chunks])]
        if len(self.index) > self.keep or len(self.ids) > self.keep_ids:
            self.clear()

    def _add(self, new: list[str]) -> None:
        """Segment new chunks. Rounds cost up to the square of a chunk's length, so long ones, and a few, go one by one."""
        short = np.flatnonzero(np.fromiter(map(len, new), dtype=np.int64, count=len(new)) <= SHORT)
        short = short if len(short) >= FEW else short[:0]
        single = np.setdiff1d(np.arange(len(new)), short)
        counts, made = np.zeros(len(new), dtype=np.int64), [self.ids]
        for some in (short[i:i + BLOCK] for i in range(0, len(short), BLOCK)):
            ids, counts[some] = self.segmenter.segment_many([new[i] for i in some.tolist()])
            made.append(ids)
        alone = [self.segmenter.segment(new[i]) for i in single.tolist()]
        counts[single] = np.fromiter(map(len, alone), dtype=np.int64, count=len(alone))
        made.append(np.fromiter(itertools.chain.from_iterable(alone), dtype=np.int32, count=int(counts[single].sum())))
        order, starts = np.concatenate([short, single]), np.zeros(len(new), dtype=np.int64)
        starts[order] = len(self.ids) + np.cumsum(counts[order]) - counts[order]
        self.starts, self.counts = np.concatenate([self.starts, starts]), np.concatenate([self.counts, counts])
        self.ids = np.concatenate(made)


class Decoder:
    """Ids to texts: markers are spaces, the one that encoding puts in front goes, byte pieces are bytes."""

    def __init__(self, vocabulary: Vocabulary):
        surfaces = [" ⁇ ".encode() if s is None else s for s in vocabulary.surfaces]
        self.lengths = np.array([len(s) for s in surfaces], dtype=np.int64)
        self.starts = np.cumsum(self.lengths) - self.lengths
        self.flat = np.frombuffer(b"".join(surfaces), dtype=np.uint8)
        self.marked = np.array([s is not None and s[:1] == b" " for s in vocabulary.surfaces])
        self.marked[vocabulary.first_byte + 32] = False     # the byte of a space is no marker

    def decode(self, ids: np.ndarray) -> bytes:
        """UTF-8 of the text. Bytes that are no UTF-8 become U+FFFD; a number that is no id is an error."""
        if len(ids) and (ids.min() < 0 or ids.max() >= len(self.lengths)):
            raise ValueError("an id has no piece")
        shown = ids[self.lengths[ids] > 0]
        raw = b"".join(self.flat[ragged(self.starts[part], self.lengths[part])].tobytes()
                       for part in (shown[i:i + (1 << 18)] for i in range(0, len(shown), 1 << 18)))
        raw = raw[1:] if len(shown) and self.marked[shown[0]] else raw
        return raw.decode("utf-8", "replace").encode()


def encode_texts(docs: DataFrame, vocabulary: Vocabulary, ids: bool = True, id_col: str = "doc_id",
                 text_col: str = "text") -> DataFrame:
    """`doc_id`, `n_tokens`, `ids_sha256`, `decoded_sha256` and, if asked for, `ids` (the end id last).

    The digest of the ids is over their decimals joined by spaces; they are decoded again for the last digest. Null and empty
    texts have the end id alone. One row per input row: ids may be null or repeated, and equal texts get equal rows. A very
    long text costs its length, a chunk of n characters without a space n log n. An empty table gives an empty table; other
    columns are not looked at. The vocabulary is broadcast; no text leaves its task.
    """
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = decoder = decimals = None
        for batch in batches:
            if table is None:
                table, decoder = ChunkTable(shared.value), Decoder(shared.value)
                decimals = np.array([str(i) for i in range(len(shared.value.surfaces))], dtype=object)
            end = np.array([shared.value.end], dtype=np.int32)
            at, size, rows = 0, 0, []
            for made in table.encode((v.as_py() or "" for v in batch.column("text"))):
                whole = np.concatenate([made, end])
                rows.append((len(whole), hashlib.sha256(" ".join(decimals[whole].tolist()).encode()).hexdigest(),
                             hashlib.sha256(decoder.decode(whole)).hexdigest(), whole if ids else None))
                size += len(whole)
                if size > 2_000_000:
                    yield _rows(batch.column("doc_id").slice(at, len(rows)), rows, ids)
                    at, size, rows = at + len(rows), 0, []
            yield _rows(batch.column("doc_id").slice(at, len(rows)), rows, ids)

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + (", ids array<int>" if ids else "")
    return (docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
            .mapInArrow(run, schema))


def _rows(doc_ids: pa.Array, rows: list[tuple], ids: bool) -> pa.RecordBatch:
    kinds = (pa.int64(), pa.string(), pa.string())
    arrays = [doc_ids, *[pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)]]
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    if ids:
        flat = np.concatenate([r[3] for r in rows]) if rows else np.zeros(0, dtype=np.int32)
        ends = np.cumsum([0] + [r[0] for r in rows]).astype(np.int32)
        arrays.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(flat, pa.int32())))
        names.append("ids")
    return pa.RecordBatch.from_arrays(arrays, names)


def decode_ids(encoded: DataFrame, vocabulary: Vocabulary, id_col: str = "doc_id", ids_col: str = "ids") -> DataFrame:
    """`doc_id`, `text`: the text of an array of ids; a null array gives null, an empty one the empty text."""
    shared = encoded.sparkSession.sparkContext.broadcast(vocabulary)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = None
        for batch in batches:
            decoder = decoder or Decoder(shared.value)
            made = [decoder.decode(np.asarray(v.values, dtype=np.int64)).decode() if v.is_valid else None
                    for v in batch.column("ids")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(made, pa.string())], ["doc_id", "text"])

    return (encoded.select(F.col(id_col).cast("long").alias("doc_id"), F.col(ids_col).cast("array<int>").alias("ids"))
            .mapInArrow(run, "doc_id long, text string"))
