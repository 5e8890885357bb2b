"""Segmentation against the library, text by text."""
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from conftest import SF_DIR
from ledgerline.llm import pieces

MODEL = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def library():
    return sentencepiece.SentencePieceProcessor(model_file=MODEL)


@pytest.fixture(scope="module")
def vocabulary():
    return pieces.load_vocabulary(MODEL)


def odd_texts():
    rnd = random.Random(11)
    parts = [" ", "  ", "▁", "▁▁", "\n", "\t", "a", "ing", "the", "é", "é", "日本", "<s>", "</s>", "<unk>", "<0x41>", "\x00", "﷽", "😀", "\xa0", "1234", "=", "\\",
             "ﬁ", "", "İ", "   ", "x" * 30]
    out = ["".join(rnd.choice(parts) for _ in range(rnd.randint(1, 30))) for _ in range(600)]
    out += ["".join(chr(rnd.choice([rnd.randint(32, 0x2ff), rnd.randint(0x2000, 0x25ff), rnd.randint(0, 0xd7ff), rnd.randint(0x1f300, 0x1f6ff)]))
                    for _ in range(80)) for _ in range(200)]
    return out + ["", " ", "a" * 40_000, " " * 40_000, "ab " * 20_000, "".join(rnd.choice("ab1 ") for _ in range(60_000)), "日" * 5_000, "▁" * 77]


def test_equals_the_library(spark, library, vocabulary):
    texts = [r.text for r in spark.read.parquet(f"{SF_DIR}/documents.parquet").select("text").collect()] + odd_texts()
    rows = list(enumerate(texts)) + [(None, "no id"), (10 ** 6, None), (3, "the id again")] + [(10 ** 6 + k, "copy of a text") for k in range(3)]
    wide = spark.createDataFrame([(d, t, "x", 1) for d, t in rows], "doc_id long, text string, ids string, n_tokens int")
    got = pieces.encode_texts(wide, vocabulary)
    left = [(r.doc_id, r.ids, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got.collect()]
    want = []
    for d, t in rows:
        ids = library.encode(t or "", add_eos=True)
        want.append((d, ids, len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256(library.decode(ids).encode()).hexdigest()))
    assert sorted(left, key=str) == sorted(want, key=str)
    back = sorted(((r.doc_id, r.text) for r in pieces.decode_ids(got, vocabulary).collect()), key=str)
    assert back == sorted(((d, library.decode(library.encode(t or ""))) for d, t in rows), key=str)
    assert pieces.encode_texts(wide.limit(0), vocabulary).collect() == []


def test_table_is_made_anew(library, vocabulary):
    """A table that may hold few chunks gives the same ids."""
    rnd = random.Random(12)
    texts = [" ".join(rnd.choice(["one", "two", "three3", "x" * rnd.randint(1, 9)]) for _ in range(rnd.randint(0, 40))) for _ in range(300)]
    table = pieces.ChunkTable(vocabulary, keep=10)
    assert [ids.tolist() for ids in table.encode(texts, together=50)] == [library.encode(t) for t in texts]
    assert len(table.index) <= 60


def test_each_chunk_is_segmented_once(vocabulary):
    table, seen = pieces.ChunkTable(vocabulary), []
    inner = table.segmenter.segment
    table.segmenter.segment = lambda chunk: seen.append(chunk) or inner(chunk)
    list(table.encode(["to be or not to be"] * 50, together=30))
    assert sorted(seen) == ["▁be", "▁not", "▁or", "▁to"]


def test_new_short_chunks_are_merged_many_at_once(library, vocabulary):
    """Chunks of all kinds, many at once: the library's ids, and only long chunks go one by one."""
    texts = [t for t in odd_texts() if " " in t or len(t) < 100] + [f"w{i} {chr(0x4e00 + i)}\n\x00😀{i * i}" for i in range(3_000)]
    table, alone = pieces.ChunkTable(vocabulary), []
    inner = table.segmenter.segment
    table.segmenter.segment = lambda chunk: alone.append(len(chunk)) or inner(chunk)
    made = [ids.tolist() for ids in table.encode(texts, together=100_000_000)]
    assert made == [library.encode(t) for t in texts]
    assert len(table.index) > 5_000 and len(alone) < 300 and min(alone) > pieces.SHORT


def test_rounds_equal_the_heap(vocabulary):
    """Also for equal scores, where the leftmost pair goes first, and for characters that are in pieces but are none."""
    rnd = random.Random(14)
    scores = {"a": 0.0, "b": 0.0, "ab": -1.0, "ba": -1.0, "aa": -1.0, "aba": -2.0, "abab": -2.0, "bab": -2.5, "éa": -1.0, "aaé": -3.0, "a😀": -0.5}
    ids = {piece: 300 + i for i, piece in enumerate(scores)}
    surfaces = [b""] * 300 + [p.encode() for p in scores]
    small = pieces.Vocabulary(scores, ids, 3, surfaces, 2, pieces._merges(scores, ids, len(surfaces)))
    segmenter = pieces.Segmenter(small)
    chunks = ["".join(rnd.choice("aaabbé😀日") for _ in range(rnd.randint(1, 20))) for _ in range(3_000)]
    made, counts = segmenter.segment_many(chunks)
    want = [segmenter.segment(c) for c in chunks]
    assert counts.tolist() == [len(w) for w in want] and made.tolist() == [i for w in want for i in w]


def test_decoding_of_any_ids(library, vocabulary):
    rnd, decoder = random.Random(13), pieces.Decoder(vocabulary)
    for _ in range(300):
        ids = [rnd.choice([rnd.randint(259, 31999), 1, 2, 35, 68, 100]) for _ in range(rnd.randint(0, 20))]
        assert decoder.decode(np.array(ids, dtype=np.int64)).decode() == library.decode(ids)
    with pytest.raises(ValueError):
        decoder.decode(np.array([32_000]))
    assert decoder.decode(np.array([3 + 0xC3, 3 + 0xA9])).decode() == "é"
