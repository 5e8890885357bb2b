"""Mixing sources to target weights: iterative proportional fitting of token weights, then sampling."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..sources.sinks import stage
from .common import column, cut, free, unit


def tokens(text: str = "text") -> Column:
    """Words of a text; a null or blank text has none."""
    t = F.btrim(F.coalesce(text, F.lit("")), F.lit(" \t\n\r\f\x0b"))
    return F.when(t == "", 0).otherwise(F.size(F.split(t, r"[\s]+"))).cast("long")


def topic(text: str = "text") -> Column:
    """A coarse topic of a text by its form."""
    t = F.coalesce(F.col(text), F.lit(""))
    return (F.when(t.contains("|"), "table")
            .when(t.contains("http") | t.contains("@"), "contact")
            .when(F.length(t) < 1000, "note")
            .otherwise("prose"))


def tempered(cells: DataFrame, dim: str, power: float) -> DataFrame:
    """Targets for the values of `dim`: shares of tokens raised to `power` and scaled to one."""
    shares = cells.groupBy(dim).agg(F.sum("tokens").cast("double").alias("n")).where("n > 0")
    total = shares.agg(F.sum(F.pow("n", F.lit(power)))).scalar()
    return shares.select(dim, (F.pow("n", F.lit(power)) / total).alias("target"))


def rake(cells: DataFrame, targets: dict[str, DataFrame], tolerance: float = 1e-4, rounds: int = 100) -> DataFrame:
    """`cells` (dimensions, `tokens`) with `weight`: the tokens scaled until the share of every value of every
    dimension is its target.

    Values without a target, or with target zero, get weight zero; the other targets of a dimension are scaled to
    one. Each round fits each dimension once and is written to the checkpoint folder; the driver sees the largest
    deviation only. Stops within `tolerance`, or after `rounds` if targets contradict the empty cells.
    """
    now = cells.withColumn("weight", F.col("tokens").cast("double"))
    for dim, target in targets.items():
        now = (now.join(target.select(dim, F.col("target").alias(f"_{dim}")), dim, "left")
               .withColumn(f"_{dim}", F.coalesce(f"_{dim}", F.lit(0.0))))
    zero = F.lit(False)
    for dim in targets:
        zero = zero | (F.col(f"_{dim}") <= 0)
    now = cut(now.withColumn("weight", F.when(zero, 0.0).otherwise(F.col("weight"))).coalesce(8))
    for _ in range(rounds):
        off = F.lit(0.0)
        for dim in targets:
            sums = now.groupBy(dim).agg(F.sum("weight").alias("_sum"), F.max(f"_{dim}").alias("_want"))
            live = sums.where("_sum > 0")
            every = live.agg(F.sum("_want")).scalar()
            factor = live.select(dim, (F.col("_want") / every / F.col("_sum")).alias("_f"))
            now = (now.join(factor, dim, "left").withColumn("_f", F.coalesce("_f", F.lit(0.0)))
                   .withColumn("weight", F.col("weight") * F.col("_f")).withColumn(f"_g_{dim}", F.col("_f")).drop("_f"))
            off = F.greatest(off, F.when(F.col("weight") > 0, F.abs(F.ln(f"_g_{dim}"))).otherwise(0.0))
        now = cut(now.coalesce(8))
        worst = now.agg(F.max(off)).first()[0]
        now = now.drop(*[f"_g_{dim}" for dim in targets])
        if worst is None or worst < tolerance:
            break
    return now.drop(*[f"_{dim}" for dim in targets])


def calibrate(cells: DataFrame, share: float) -> DataFrame:
    """`probability` per cell: proportional to weight / tokens, at most one, keeping `share` of all tokens on average.

    The factor is found by a grid of candidates per pass over the cells, three passes; a budget beyond what the
    weighted cells hold gives probability one to all of them.
    """
    ratio = F.when(F.col("tokens") > 0, F.col("weight") / F.col("tokens")).otherwise(0.0)
    known = cells.withColumn("_ratio", ratio)
    low, high = -1.0, 40.0
    whole = known.agg(F.sum("tokens"), F.sum("weight")).first()
    if not whole[0] or not whole[1]:
        return known.withColumn("probability", F.lit(0.0)).drop("_ratio")
    budget = share * whole[0]
    base = whole[0] / whole[1]
    for _ in range(3):
        grid = [low + (high - low) * i / 40 for i in range(41)]
        kept = known.agg(*[F.sum(F.col("tokens") * F.least(F.lit(1.0), F.col("_ratio") * (base * 2.0 ** g * share)))
                           for g in grid]).first()
        enough = [i for i, k in enumerate(kept) if k >= budget * (1 - 1e-12)]
        i = enough[0] if enough else len(grid) - 1
        low, high = grid[max(0, i - 1)], grid[i]
    factor = base * share * 2.0 ** high
    return known.withColumn("probability", F.least(F.lit(1.0), F.col("_ratio") * factor)).drop("_ratio")


def mix_probabilities(docs: DataFrame, share: float = 0.5, power: float = 0.7,
                      targets: dict[str, DataFrame] | None = None) -> tuple[DataFrame, DataFrame, list[str]]:
    """Documents with four columns more (source, language, topic, tokens), the calibrated cells (one row per combination)
    and the names of the four columns, none of which `docs` has.

    Null sources and languages are the value `unknown`. Targets default to tempered shares; those given are by
    `source`, `lang` and `topic`.
    """
    names = free(docs.columns, "_source", "_lang", "_topic", "_tokens")
    values = [F.coalesce("source", F.lit("unknown")), F.coalesce("lang", F.lit("unknown")), topic(), tokens()]
    marked = docs.withColumns(dict(zip(names, values)))
    dims = ["source", "lang", "topic"]
    cells = cut(marked.groupBy(*[F.col(n).alias(d) for n, d in zip(names, dims)]).agg(F.sum(names[3]).alias("tokens")))
    wanted = targets or {d: tempered(cells, d, power) for d in dims}
    # A table of known size: Spark sends it to the documents instead of shuffling them.
    return marked, stage(docs.sparkSession, calibrate(rake(cells, wanted), share), "cells"), names


def draw(docs: DataFrame) -> Column:
    """Number in [0, 1) of a document, fixed by its id and text, so that a rerun draws the same sample."""
    return unit("doc_id", "text", seed=8)


def mix_sources(docs: DataFrame, share: float = 0.5, power: float = 0.7,
                targets: dict[str, DataFrame] | None = None) -> DataFrame:
    """`doc_id`, `source`, `lang`, `topic`, `tokens`, `probability`, `sampled`, one row per document.

    Null and empty texts have no tokens and a probability of zero unless their cell holds other texts. Repeated rows
    are drawn alike. An empty table gives an empty table; columns beyond id, text, source and language are not looked at.
    """
    marked, cells, (source, lang, kind, count) = mix_probabilities(docs, share, power, targets)
    small = marked.select("doc_id", F.col(source).alias("source"), F.col(lang).alias("lang"), F.col(kind).alias("topic"),
                          F.col(count).alias("tokens"), draw(docs).alias("u"))
    joined = small.join(cells.select("source", "lang", "topic", "probability"), ["source", "lang", "topic"])
    return joined.select("doc_id", "source", "lang", "topic", "tokens", "probability",
                         (F.col("u") < F.col("probability")).alias("sampled"))


def sample_documents(docs: DataFrame, share: float = 0.5, power: float = 0.7,
                     targets: dict[str, DataFrame] | None = None) -> DataFrame:
    """The sampled rows of `docs`, columns unchanged whatever they are called.

    The texts are not shuffled: the drawn rows are those whose number lies below their cell's probability, and
    cells come to the documents by a join on the small side, whose size Spark checks.
    """
    marked, cells, names = mix_probabilities(docs, share, power, targets)
    chance, u = free(marked.columns, "_probability", "_draw")
    known = cells.select(*[F.col(d).alias(n) for d, n in zip(("source", "lang", "topic"), names)], F.col("probability").alias(chance))
    return (marked.withColumn(u, draw(docs)).join(known, names[:3]).where(F.col(u) < F.col(chance))
            .select(*[column(c) for c in docs.columns]))
