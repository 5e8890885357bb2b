"""Language identification: word frequencies first, shorter and shorter character n-grams for unknown words."""
from __future__ import annotations

import itertools
import json
import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F, types as T

from .common import column, cut, map_all

WORD = re.compile(r"[^\W\d_]+")
LONGEST = 4          # characters of the longest n-gram
UNKNOWN = "und"


def words_of(text: str) -> list[str]:
    """Lower-cased runs of letters."""
    return WORD.findall(text.lower())


def has_letter(words: list[str]) -> bool:
    return any(any(map(str.isalpha, w)) for w in words)


def in_training(id_col: str = "doc_id") -> Column:
    """Rows that may be learned from: crc32 of the id, as text, is not 1 modulo 3. A null id is held back from both sides."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 != 1, F.lit(False))


def fit(docs: DataFrame, rows_per_language: int = 600,
        id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> dict:
    """The model: languages, word rows and n-gram rows with log frequencies per language.

    It learns from the whole texts of about `rows_per_language` rows of each language, picked by a hash of the id.
    This bound does not depend on the input's size, so the model can be collected and broadcast; all words and n-grams of
    these rows are kept. Rows with null text or language teach nothing, a language without any word in its rows is not
    learned. Repeated rows count as often as they come. An empty table gives a model without languages.

    A feature that a language lacks has the same floor in all languages, that of the one with most text: a language
    known from few words gains nothing from words it does not have.
    """
    known = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & in_training(id_col)).select(
        F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"), F.col(id_col).alias("id"))
    sizes = {r[0]: r[1] for r in known.groupBy("lang").agg(F.count("*")).collect()}
    if not sizes:
        return {"langs": [], "words": {}, "grams": {}}
    shares = F.from_json(F.lit(json.dumps({k: rows_per_language / n for k, n in sizes.items()})), "map<string,double>")
    draw = F.shiftrightunsigned(F.xxhash64(F.lit(4), "id"), 11) / F.lit(float(1 << 53))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found: dict[str, Counter] = {}
        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text")):
                found.setdefault(lang, Counter()).update(words_of(text.as_py()))
        for lang, words in found.items():
            features = Counter({f"w{w}": n for w, n in words.items()})
            for w, n in words.items():
                padded = f"<{w}>"
                for size in range(1, LONGEST + 1):
                    for i in range(len(padded) - size + 1):
                        features["g" + padded[i:i + size]] += n
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(features), pa.string()), pa.array(list(features), pa.string()),
                 pa.array(list(features.values()), pa.int64())], ["lang", "feature", "n"])

    counts = cut(known.where(draw < shares[F.col("lang")]).select("lang", "text")
                 .mapInArrow(count, "lang string, feature string, n long").groupBy("lang", "feature").agg(F.sum("n").alias("n")))
    found = counts.toArrow()
    langs = sorted(set(found.column("lang").to_pylist()))
    at = {lang: i for i, lang in enumerate(langs)}
    own: dict[str, dict[str, dict[int, int]]] = {"w": {}, "g": {}}
    for lang, feature, n in zip(*[found.column(c).to_pylist() for c in ("lang", "feature", "n")]):
        own[feature[0]].setdefault(feature[1:], {})[at[lang]] = n
    return {"langs": langs, "words": _frequencies(own["w"], len(langs)), "grams": _frequencies(own["g"], len(langs))}


def _frequencies(counts: dict[str, dict[int, int]], langs: int) -> dict[str, list[float]]:
    """Log frequencies per language of every feature, in the order of features."""
    totals = [0] * langs
    for by in counts.values():
        for k, n in by.items():
            totals[k] += n
    spread = 0.5 * len(counts)
    floor = math.log(0.5 / (max(totals, default=0) + spread)) if counts else 0.0
    return {feature: [math.log((by[k] + 0.5) / (totals[k] + spread)) if k in by else floor for k in range(langs)]
            for feature, by in sorted(counts.items())}


class Scorer:
    """Scores texts under a model. Vectors of words are kept for up to `keep` words and then made anew."""

    def __init__(self, model: dict, keep: int = 300_000):
        self.langs, self.keep = model["langs"], keep
        self.words = model["words"]
        self.grams = {g: i for i, g in enumerate(model["grams"])}
        # The last row is for words without any known n-gram: it favours no language.
        self.gram_rows = np.array(list(model["grams"].values()) + [[0.0] * len(self.langs)]).reshape(len(self.grams) + 1, len(self.langs))
        self.clear()

    def clear(self) -> None:
        self.index: dict[str, int] = {}
        self.rows = np.zeros((1024, max(1, len(self.langs))))

    def known_grams(self, word: str) -> list[int]:
        """Rows of the longest n-grams of the word that the model knows."""
        padded, get = f"<{word}>", self.grams.get
        for size in range(min(LONGEST, len(padded)), 0, -1):
            found = [i for k in range(len(padded) - size + 1) if (i := get(padded[k:k + size])) is not None]
            if found:
                return found
        return [len(self.gram_rows) - 1]

    def add(self, new: list[str]) -> None:
        """A row per word: its log frequencies if it is known, else the mean of those of its n-grams."""
        at = len(self.index)
        self.index.update(zip(new, range(at, at + len(new))))
        while len(self.index) > len(self.rows):
            self.rows = np.concatenate([self.rows, np.zeros_like(self.rows)])
        unseen, parts = [], []
        for i, word in enumerate(new, at):
            row = self.words.get(word)
            if row is not None:
                self.rows[i] = row
            else:
                unseen.append(i)
                parts.append(self.known_grams(word))
        if unseen:
            sizes = np.fromiter(map(len, parts), dtype=np.int64, count=len(parts))
            flat = np.fromiter(itertools.chain.from_iterable(parts), dtype=np.int64, count=int(sizes.sum()))
            self.rows[unseen] = np.add.reduceat(self.gram_rows[flat], np.cumsum(sizes) - sizes) / sizes[:, None]

    def predict(self, text: str | None) -> tuple[str, float]:
        words = words_of(text) if text else []
        if not self.langs or not has_letter(words):
            return UNKNOWN, 0.0
        if len(self.index) > self.keep:
            self.clear()
        counted = Counter(words)
        new = [w for w in counted if w not in self.index]
        if new:
            self.add(new)
        at = np.fromiter(map(self.index.__getitem__, counted), dtype=np.int64, count=len(counted))
        total = np.fromiter(counted.values(), dtype=float, count=len(counted)) @ self.rows[at]
        total -= total.max()
        best = int(np.argmax(total))
        return self.langs[best], float(1 / np.exp(total).sum())


def identify(docs: DataFrame, model: dict, id_col: str = "doc_id", text_col: str = "text", keep: tuple[str, ...] = (),
             names: tuple[str, str] = ("lang_pred", "score")) -> DataFrame:
    """The likeliest language and its share (columns called `names`) beside the id and the columns of `keep`.

    Only the text is looked at, all of it, whatever its length. Null texts, texts without a letter, and all texts under a
    model that has learned nothing are `und` with score 0. Of languages that are equally likely the first by name is
    taken. One row per input row; repeated rows get the same answer.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    columns = [id_col] + [c for c in keep if c != id_col]
    wanted = docs.select(*[column(c) for c in dict.fromkeys(columns + [text_col])])
    at = wanted.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for batch in batches:
            made = [scorer.predict(v.as_py()) for v in batch.column(at)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array([m[0] for m in made], pa.string()), pa.array([m[1] for m in made], pa.float64())],
                [*batch.schema.names, *names])

    made = map_all(wanted, run, [T.StructField(names[0], T.StringType()), T.StructField(names[1], T.DoubleType())])
    return made if text_col in columns else made.drop(text_col)
