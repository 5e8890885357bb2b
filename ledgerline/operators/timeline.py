"""Entities across ordered periods."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import exact_avg, exact_sum, percent, round_half_up

# Most parts into which the values of a group are cut for ranking, and how many values a part should have.
RANK_CUTS, CUT_VALUES = 1024, 100_000
# A value is hot if it has more rows than this and more than a 100,000th of all rows; its rows are dealt over so many tasks.
HOT_ROWS, HOT_TASKS = 10_000, 64


def period_order(df: DataFrame, order: DataFrame | None = None, descending: bool = False) -> DataFrame:
    """Distinct period labels with their position.

    Without an order table labels sort as strings. The window runs over the distinct labels only.
    """
    if order is not None:
        return df.select("period").distinct().join(order, "period").select("period", "period_order")
    labels = df.select("period").distinct()
    key = F.col("period").desc() if descending else F.col("period").asc()
    return labels.withColumn("period_order", F.row_number().over(Window.orderBy(key)))


def with_order(df: DataFrame, order: DataFrame) -> DataFrame:
    """Attach the period position to the facts."""
    return df.join(order.select("period", "period_order"), "period")


def latest_period(df: DataFrame) -> Column:
    """The greatest label as a scalar subquery; it never visits the driver."""
    return df.agg(F.max("period")).scalar()


def latest_rows(df: DataFrame) -> DataFrame:
    return df.filter(F.col("period") == latest_period(df))


def rank_within(df: DataFrame, by: str, measure: str, name: str) -> DataFrame:
    """Rank with shared ties and gaps, highest first and nulls last; no row is lost.

    Ranks are counted on the distinct measure values of each group. The values of a large group are cut at approximate
    quantiles: a window over the few cuts counts the rows of higher cuts, and values are sorted inside one cut only. The
    rank is exact wherever the cuts lie, and a measure without repeats is not sorted in one task. Ranks come back to the rows
    by a join in which the rows of a hot value are dealt over many tasks; there are fewer than 100,000 hot values, and
    only these are broadcast.
    """
    sizes = df.groupBy(F.col(by).alias("_by"), F.col(measure).alias("_measure")).agg(F.count("*").alias("_n"))
    quantiles = F.percentile_approx("_measure", [i / RANK_CUTS for i in range(1, RANK_CUTS)], F.lit(20 * RANK_CUTS))
    step = F.floor(RANK_CUTS / F.least(F.ceil(F.col("_values") / CUT_VALUES), F.lit(RANK_CUTS)))
    edges = (sizes.groupBy(F.col("_by").alias("_of")).agg(quantiles.alias("_all"), F.count("*").alias("_values"))
             .select("_of", F.filter("_all", lambda e, i: (i + 1) % step == 0).alias("_edges")))
    # Cut 0 holds the highest values, the last one the nulls.
    cut = F.when(F.col("_measure").isNull(), RANK_CUTS).otherwise(
        F.size(F.filter("_edges", lambda e: e > F.col("_measure"))))
    placed = (sizes.join(edges, F.col("_by").eqNullSafe(F.col("_of")))
              .select("_by", "_measure", "_n", cut.alias("_cut")))
    higher = Window.partitionBy("_in").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    cuts = (placed.groupBy(F.col("_by").alias("_in"), F.col("_cut").alias("_at")).agg(F.sum("_n").alias("_rows"))
            .withColumn("_higher", F.coalesce(F.sum("_rows").over(higher), F.lit(0))).drop("_rows"))
    above = (Window.partitionBy("_by", "_cut").orderBy(F.col("_measure").desc_nulls_last())
             .rowsBetween(Window.unboundedPreceding, -1))
    limit = F.greatest(F.lit(HOT_ROWS), sizes.agg(F.sum("_n")).scalar() / 100_000)
    tasks = F.when(F.col("_n") > limit, F.sequence(F.lit(0), F.lit(HOT_TASKS - 1))).otherwise(F.array(F.lit(0)))
    ranks = (placed.withColumn("_above", F.coalesce(F.sum("_n").over(above), F.lit(0)))
             .join(cuts, F.col("_by").eqNullSafe(F.col("_in")) & (F.col("_cut") == F.col("_at")))
             .select("_by", "_measure", (F.col("_higher") + F.col("_above") + 1).alias(name), F.explode(tasks).alias("_task")))
    hot = F.broadcast(sizes.filter(F.col("_n") > limit).select(F.col("_by").alias("_hot_by"), F.col("_measure").alias("_hot_measure"),
                                                               F.lit(True).alias("_hot")))
    own = F.col(by), F.col(measure)
    dealt = (df.join(hot, own[0].eqNullSafe(F.col("_hot_by")) & own[1].eqNullSafe(F.col("_hot_measure")), "left")
             .withColumn("_deal", F.when(F.col("_hot"), F.pmod(F.monotonically_increasing_id(), F.lit(HOT_TASKS))).otherwise(0).cast("int"))
             .drop("_hot", "_hot_by", "_hot_measure"))
    return (dealt.join(ranks, own[0].eqNullSafe(F.col("_by")) & own[1].eqNullSafe(F.col("_measure")) & (F.col("_deal") == F.col("_task")))
            .drop("_by", "_measure", "_task", "_deal"))


def rate_changes(timeline: DataFrame) -> DataFrame:
    """Previous rate, change, rank and previous rank per entity; first appearances are dropped last.

    One row per entity and period is expected, so an entity has at most as many rows as there are
    periods.
    """
    along = Window.partitionBy("entity").orderBy("period")
    return (rank_within(timeline.select("period", "entity", "use_rate"), "period", "use_rate", "rank_current")
            .withColumn("prev_use_rate", F.lag("use_rate").over(along))
            .withColumn("rank_prev", F.lag("rank_current").over(along))
            .withColumn("change_pct", round_half_up(F.col("use_rate") - F.col("prev_use_rate"), 2))
            .filter(F.col("prev_use_rate").isNotNull())
            .select("entity", "period", "use_rate", "prev_use_rate", "change_pct", "rank_current", "rank_prev"))


def recent_periods(timeline: DataFrame, n: int = 3) -> DataFrame:
    """The last n periods of each entity, `back` = 1 for the newest."""
    newest = Window.partitionBy("entity").orderBy(F.col("period").desc())
    return timeline.withColumn("back", F.row_number().over(newest)).filter(F.col("back") <= n)


def period_averages(timeline: DataFrame) -> DataFrame:
    """Mean, extremes and count over the periods, and the direction of the last three.

    One shuffle: the window and the aggregate share the partitioning by entity.
    """
    newest = Window.partitionBy("entity").orderBy(F.col("period").desc())

    def back(i: int) -> Column:
        return F.max(F.when(F.col("_back") == i, F.col("use_rate")))

    out = (timeline.withColumn("_back", F.row_number().over(newest))
           .groupBy("entity").agg(
               F.max("star").alias("star"),
               round_half_up(exact_avg("use_rate"), 2).alias("avg_use_rate"),
               F.max("use_rate").alias("max_use_rate"),
               F.min("use_rate").alias("min_use_rate"),
               F.count("*").alias("period_count"),
               back(1).alias("_r1"), back(2).alias("_r2"), back(3).alias("_r3")))
    # A missing third value puts no condition on the second step.
    up = (F.col("_r1") > F.col("_r2")) & F.coalesce(F.col("_r2") > F.col("_r3"), F.lit(True))
    down = (F.col("_r1") < F.col("_r2")) & F.coalesce(F.col("_r2") < F.col("_r3"), F.lit(True))
    return (out.withColumn("trend", F.when(up, "up").when(down, "down").otherwise("stable"))
            .drop("_r1", "_r2", "_r3"))


def normalize_by_max(rates: DataFrame) -> DataFrame:
    """Scale the rates of each period so that the largest is 100."""
    tops = rates.groupBy("period").agg(F.max("rate").alias("_top"))
    return rates.join(tops, "period").withColumn("norm", percent("rate", "_top", 1)).drop("_top")


def momentum(rates: DataFrame, latest: str | None = None, previous: str | None = None,
             min_change: float = 1.0) -> DataFrame:
    """Change of the max-normalised rate between two periods, missing sides as 0.

    Largest rise first. Without labels the two greatest ones are compared. Both periods are summed side by side in one
    aggregate, which gives the rows of a full outer join without joining.
    """
    if latest is None or previous is None:
        two = rates.select("period").distinct().orderBy(F.col("period").desc()).limit(2)
        two = two.withColumn("_back", F.row_number().over(Window.orderBy(F.col("period").desc())))
        picked = rates.join(two, "period")
    else:
        picked = rates.filter(F.col("period").isin(latest, previous)).withColumn(
            "_back", F.when(F.col("period") == latest, 1).otherwise(2))
    sums = picked.groupBy("_back", "entity").agg(exact_sum("rate").alias("_sum"))
    tops = sums.groupBy("_back").agg(F.max("_sum").alias("_top"))
    norm = sums.join(tops, "_back").withColumn("_norm", percent("_sum", "_top", 1))

    def side(back: int) -> Column:
        return F.coalesce(F.max(F.when(F.col("_back") == back, F.col("_norm"))), F.lit(0.0))

    return (norm.groupBy("entity").agg(side(2).alias("prev_rate"), side(1).alias("curr_rate"))
            .withColumn("change", round_half_up(F.col("curr_rate") - F.col("prev_rate"), 1))
            .filter(F.abs("change") >= min_change)
            .orderBy(F.col("change").desc(), "entity"))


def adjacent_change(rates: DataFrame, order: DataFrame) -> DataFrame:
    """Change between neighbouring periods of an explicit order; gaps do not match, zeros are dropped."""
    along = Window.partitionBy("entity").orderBy("period_order")
    return (with_order(rates, order)
            .withColumn("prev_rate", F.lag("rate").over(along))
            .withColumn("_prev_order", F.lag("period_order").over(along))
            .filter(F.col("_prev_order") == F.col("period_order") - 1)
            .withColumn("change", round_half_up(F.col("rate") - F.col("prev_rate"), 1))
            .filter(F.col("change") != 0)
            .select("period", "entity", "prev_rate", F.col("rate").alias("curr_rate"), "change"))


def rate_history(timeline: DataFrame, top: int = 15, by: str = "latest") -> DataFrame:
    """Period and rate lists of the leading entities.

    `by="latest"` ranks by the latest period of the whole timeline, `by="own_latest"` by the last
    period of each entity. The leaders come from a limit and are joined, never collected.
    """
    if by == "latest":
        heads = latest_rows(timeline).select("entity", F.col("use_rate").alias("_rate"))
    else:
        heads = timeline.groupBy("entity").agg(F.max_by("use_rate", "period").alias("_rate"))
    leaders = heads.orderBy(F.col("_rate").desc(), "entity").limit(top).select("entity")
    history = F.sort_array(F.collect_list(F.struct("period", "use_rate")))
    # One row per period and entity: the list is as long as the number of periods.
    return (timeline.join(leaders, "entity", "left_semi")
            .groupBy("entity").agg(F.max("star").alias("star"), history.alias("_h"))
            .select("entity", "star",
                    F.to_json(F.col("_h.period")).alias("periods"),
                    F.to_json(F.col("_h.use_rate")).alias("rates")))


def score_deltas(scores: DataFrame, bucket_seconds: int = 600) -> DataFrame:
    """Change against the previous score of the same entity, 0 for the first.

    `scores`: entity, ts, id, score. The look-back runs inside (entity, time bucket) and only the
    first row of a bucket looks up the close of an earlier one, so an entity with very many rows
    is spread over its buckets.
    """
    bucket = F.floor(F.unix_micros(F.col("ts").cast("timestamp")) / F.lit(bucket_seconds * 1_000_000))
    marked = scores.withColumn("_bucket", bucket)
    inside = Window.partitionBy("entity", "_bucket").orderBy("ts", "id")
    local = (marked.withColumn("_prev", F.lag("score").over(inside))
             .withColumn("_first", F.row_number().over(inside) == 1))
    closes = marked.groupBy("entity", "_bucket").agg(F.max_by("score", F.struct("ts", "id")).alias("_close"))
    carried = closes.select("entity", "_bucket", F.lag("_close").over(
        Window.partitionBy("entity").orderBy("_bucket")).alias("_carry"))
    prev = F.when(F.col("_first"), F.col("_carry")).otherwise(F.col("_prev"))
    return (local.join(carried, ["entity", "_bucket"], "left")
            .withColumn("delta", F.coalesce(round_half_up(F.col("score") - prev, 1), F.lit(0.0)))
            .drop("_bucket", "_prev", "_first", "_carry"))


def recent_values(scores: DataFrame, keep: int = 60, show: int = 22) -> DataFrame:
    """The newest `keep` scores per entity in order, and the last `show` of them.

    The row limit runs before the shuffle, so each task sends at most `keep` rows per entity.
    """
    newest = Window.partitionBy("entity").orderBy(F.col("ts").desc(), F.col("id").desc())
    kept = scores.withColumn("_rn", F.row_number().over(newest)).filter(F.col("_rn") <= keep)
    series = F.sort_array(F.collect_list(F.struct("ts", "id", "score")))["score"]
    return (kept.groupBy("entity").agg(series.alias("values"))
            .withColumn("shown", F.slice("values", F.greatest(F.lit(1), F.size("values") - show + 1), show)))


def group_series(df: DataFrame, group: str, value: str, groups: list) -> DataFrame:
    """Mean per period with one column per listed group; gaps stay null."""
    cols = [round_half_up(exact_avg(F.when(F.col(group) == g, F.col(value))), 2).alias(f"{group}_{g}")
            for g in groups]
    return df.groupBy("period").agg(*cols)


def period_maps(df: DataFrame, key: str = "entity", value: str = "n") -> DataFrame:
    """One map {entity: total} per period; entries are summed first, so a map has one per entity."""
    sums = df.groupBy("period", key).agg(F.sum(value).alias("total"))
    return sums.groupBy("period").agg(
        F.map_from_entries(F.sort_array(F.collect_list(F.struct(key, "total")))).alias("content"))
