"""Baskets: assembling, splitting, pairing, usage."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..functions import exact_sum, lenient_int, percent, round_half_up, sorted_set

UNKNOWN = "?"


def baskets(df: DataFrame, keys: list[str], item: str, min_items: int = 2) -> DataFrame:
    """Distinct items per key as a sorted array.

    Repeats collapse before the shuffle, so an array never outgrows the item vocabulary.
    """
    return (df.groupBy(*keys).agg(F.array_sort(F.collect_set(item)).alias("items"))
            .filter(F.size("items") >= min_items))


def split_basket(df: DataFrame, col: str = "basket", sep: str = r"\s*\+\s*") -> DataFrame:
    """Members of a joined text with their 1-based position; blanks and unknowns leave gaps."""
    others = [c for c in df.columns]
    return (df.select(*others, F.posexplode(F.split(F.col(col), sep)).alias("_i", "entity"))
            .withColumn("entity", F.trim("entity"))
            .filter(~F.col("entity").isin("", UNKNOWN))
            .withColumn("pos", F.col("_i") + 1).drop("_i"))


def _names_in(doc: Column) -> Column:
    """Member names from an array of strings or objects, or from JSON text holding one."""
    inner = F.try_parse_json(F.try_variant_get(doc, "$", "string"))
    items = F.coalesce(F.try_variant_get(doc, "$", "array<variant>"),
                       F.try_variant_get(inner, "$", "array<variant>"))
    return F.transform(items, lambda v: F.coalesce(
        F.try_variant_get(v, "$.name", "string"), F.try_variant_get(v, "$.role", "string"),
        F.when(F.schema_of_variant(v) == "STRING", F.try_variant_get(v, "$", "string")),
        F.lit(UNKNOWN)))


def explode_members(df: DataFrame, col: str = "doc") -> DataFrame:
    """Normalise the member list of a basket document (a variant): basket, pos, entity, weight.

    Weight is use_count, else count, else the rate in hundredths, else 1; baskets without members
    go away.
    """
    doc = F.col(col)
    # The first list that has members counts; an empty one gives way to the next.
    lists = [_names_in(F.try_variant_get(doc, p, "variant")) for p in ("$.roles", "$.members")]
    members = F.when(F.size(lists[0]) > 0, lists[0]).otherwise(lists[1])
    count = F.coalesce(F.try_variant_get(doc, "$.use_count", "double"),
                       F.try_variant_get(doc, "$.count", "double"), F.lit(0.0))
    hundredths = F.coalesce(F.try_variant_get(doc, "$.use_rate", "double"), F.lit(0.0)) * 100
    weight = F.coalesce(F.nullif(count.cast("bigint"), F.lit(0).cast("bigint")),
                        F.nullif(hundredths.cast("bigint"), F.lit(0).cast("bigint")),
                        F.lit(1).cast("bigint"))
    return (df.select(F.try_variant_get(doc, "$.name", "string").alias("basket"),
                      weight.alias("weight"), F.posexplode(members).alias("_i", "entity"))
            .select("basket", (F.col("_i") + 1).alias("pos"), "entity", "weight"))


def explode_tiers(df: DataFrame, col: str = "doc") -> DataFrame:
    """(tier, entity, constellation) rows from a tier document kept as a map or as a list."""
    doc = F.col(col)
    as_map = F.map_entries(F.try_variant_get(doc, "$", "map<string,variant>"))
    as_list = F.transform(F.try_variant_get(doc, "$", "array<variant>"), lambda t: F.struct(
        F.coalesce(F.try_variant_get(t, "$.tier", "string"), F.try_variant_get(t, "$.name", "string"),
                   F.lit(UNKNOWN)).alias("key"),
        F.try_variant_get(t, "$.chars", "variant").alias("value")))
    return (df.select(F.explode(F.coalesce(as_map, as_list)).alias("t"))
            .select(F.col("t.key").alias("tier"),
                    F.explode(F.try_variant_get(F.col("t.value"), "$", "array<variant>")).alias("c"))
            .select("tier",
                    F.coalesce(F.try_variant_get("c", "$.name", "string"),
                               F.when(F.schema_of_variant("c") == "STRING", F.try_variant_get("c", "$", "string")),
                               F.lit(UNKNOWN)).alias("entity"),
                    lenient_int(F.try_variant_get("c", "$.constellation", "string"), 0).alias("constellation")))


def _chunk(items: Column, i: Column, width: int) -> Column:
    return F.slice(items, i * width + 1, F.lit(width))


def cooccurrence(baskets_df: DataFrame, items: str = "items", min_weight: int = 1,
                 top: int | None = None, dim: DataFrame | None = None, tile: int = 128) -> DataFrame:
    """Unordered item pairs with the number of baskets that hold both.

    Baskets are cut into tiles of item chunks, equal tiles are counted once, and only then unfolded
    to pairs. A small basket is one tile; the tiles of a very large one spread over the cluster, and
    pair counts combine before their shuffle. `dim` (entity, attribute columns) is joined on both ends.
    """
    clean = sorted_set(F.filter(F.col(items), lambda n: n.isNotNull() & ~n.isin("", UNKNOWN)))
    last = F.floor((F.size("_s") - 1) / tile).cast("int")
    # Chunk i meets the chunks from i on; `b` stays empty for a chunk with itself.
    tiles = (baskets_df.select(clean.alias("_s")).filter(F.size("_s") >= 2)
             .select("_s", F.explode(F.sequence(F.lit(0), last)).alias("_i"))
             .select("_s", "_i", F.explode(F.sequence(F.col("_i"), last)).alias("_j"))
             .select(_chunk(F.col("_s"), F.col("_i"), tile).alias("a"),
                     F.when(F.col("_i") == F.col("_j"), F.slice("_s", 1, 0))
                     .otherwise(_chunk(F.col("_s"), F.col("_j"), tile)).alias("b"))
             .groupBy("a", "b").agg(F.count("*").alias("n")))
    inside = F.flatten(F.transform("a", lambda x, i: F.transform(
        F.slice("a", i + 2, F.size("a")), lambda y: F.struct(x.alias("x"), y.alias("y")))))
    across = F.flatten(F.transform("a", lambda x: F.transform(
        "b", lambda y: F.struct(x.alias("x"), y.alias("y")))))
    pairs = (tiles.select("n", F.explode(F.when(F.size("b") == 0, inside).otherwise(across)).alias("p"))
             .groupBy(F.col("p.x").alias("item_a"), F.col("p.y").alias("item_b"))
             .agg(F.sum("n").alias("weight"))
             .filter(F.col("weight") >= min_weight))
    if top is not None:
        pairs = pairs.orderBy(F.col("weight").desc(), "item_a", "item_b").limit(top)
    if dim is not None:
        attrs = [c for c in dim.columns if c != "entity"]
        for side in ("a", "b"):
            ends = dim.select(F.col("entity").alias(f"item_{side}"), *[F.col(c).alias(f"{c}_{side}") for c in attrs])
            pairs = pairs.join(ends, f"item_{side}", "left")
    return pairs


def basket_entity_rates(baskets_df: DataFrame, members: str = "items") -> DataFrame:
    """Sum of the basket rates per period and member, one term per occurrence."""
    return (baskets_df.select("period", "use_rate", F.explode(members).alias("entity"))
            .groupBy("period", "entity").agg(exact_sum("use_rate").alias("rate")))


def first_members(lineups: DataFrame, keys: list[str], size: int = 4) -> DataFrame:
    """The first `size` members of every lineup that has as many, in position order.

    Rows are numbered with a limit that already applies before the shuffle.
    """
    order = Window.partitionBy(*keys).orderBy("pos", "entity")
    slots = [F.max(F.when(F.col("_rn") == i, F.col("entity"))).alias(f"_m{i}") for i in range(1, size + 1)]
    return (lineups.withColumn("_rn", F.row_number().over(order)).filter(F.col("_rn") <= size)
            .groupBy(*keys).agg(F.count("*").alias("_n"), *slots)
            .filter(F.col("_n") == size)
            .select(*keys, F.array(*[f"_m{i}" for i in range(1, size + 1)]).alias("members")))


def basket_usage(lineups: DataFrame, users: Column, keys: list[str], ordered: bool = True,
                 size: int = 4) -> DataFrame:
    """Usage of each lineup of `size` members over all users; has_rate is 0.7 of it.

    `ordered=True` keeps the member order in the key ("+"), False sorts it (" + "). `users` is a
    literal or a scalar subquery.
    """
    members = first_members(lineups, keys, size)
    key = F.array_join("members", "+") if ordered else F.array_join(F.array_sort("members"), " + ")
    return (members.groupBy(key.alias("basket")).agg(F.count("*").alias("n"))
            .withColumn("use_rate", percent("n", users, 1))
            .withColumn("has_rate", round_half_up(percent("n", users) * F.lit(0.7), 1)))


def with_first_avatars(baskets_df: DataFrame, members: DataFrame, keys: list[str], dim: DataFrame,
                       ordered: bool = True) -> DataFrame:
    """Add `avatars`: those of the members in the order of the basket's first occurrence (least key).

    `members` comes from `first_members`; members without an avatar leave an empty text. Members are
    unfolded once per distinct basket, not per occurrence.
    """
    key = F.array_join("members", "+") if ordered else F.array_join(F.array_sort("members"), " + ")
    first = members.groupBy(key.alias("basket")).agg(F.min_by("members", F.struct(*keys)).alias("members"))
    named = (first.select("basket", F.posexplode("members").alias("_pos", "entity"))
             .join(dim.select("entity", "avatar"), "entity", "left")
             .groupBy("basket").agg(F.sort_array(F.collect_list(
                 F.struct("_pos", F.coalesce("avatar", F.lit("")).alias("avatar")))).alias("_a"))
             .select("basket", F.array_join(F.col("_a.avatar"), ",").alias("avatars")))
    return baskets_df.join(named, "basket", "left")


def basket_shares(teams: DataFrame, users: Column, members: str = "members") -> DataFrame:
    """Share of each member list (an array, order kept) among all lineups and among all users.

    The total is summed from the counts, so both come from the same shuffle.
    """
    counted = teams.groupBy(F.array_join(members, "+").alias("basket")).agg(F.count("*").alias("n"))
    total = counted.agg(F.sum("n")).scalar()
    return (counted.withColumn("use_rate", percent("n", total, 1))
            .withColumn("has_rate", percent("n", users, 1)))


def pair_usage(lineups: DataFrame, keys: list[str], top: int = 10) -> DataFrame:
    """How often two lineups of a record go together, with the share of all records."""
    records = lineups.groupBy(*keys).agg(
        F.min("basket_no").alias("a"), F.max("basket_no").alias("b"))
    counted = records.groupBy("a", "b").agg(F.count("*").alias("n"))
    total = counted.agg(F.sum("n")).scalar()
    return counted.withColumn("pct", percent("n", total, 1)).orderBy(F.col("n").desc(), "a", "b").limit(top)


def leading_baskets(baskets_df: DataFrame, rate: str = "use_rate", top: int = 100) -> DataFrame:
    """The `top` baskets by rate, numbered from 1; the numbering runs over the limited rows only."""
    head = baskets_df.orderBy(F.col(rate).desc(), "basket").limit(top)
    return head.withColumn("no", F.row_number().over(Window.orderBy(F.col(rate).desc(), "basket")))


def disjoint_pairs(leading: DataFrame, rate: str = "use_rate") -> DataFrame:
    """Pairs of numbered baskets that share no member, weight = product of the rates.

    Takes the rows of `leading_baskets`: their count is a parameter of the report. Each basket
    lists its higher-numbered partners and meets them through an equality join.
    """
    last = leading.agg(F.max("no")).scalar()
    left = (leading.withColumn("_last", last).filter(F.col("no") < F.col("_last"))
            .select(F.col("no").alias("a"), F.col("items").alias("_ia"), F.col(rate).alias("_ra"),
                    F.explode(F.sequence(F.col("no") + 1, F.col("_last"))).alias("b")))
    right = leading.select(F.col("no").alias("b"), F.col("items").alias("_ib"), F.col(rate).alias("_rb"))
    return (left.join(right, "b").filter(~F.arrays_overlap("_ia", "_ib"))
            .select("a", "b", (F.col("_ra") * F.col("_rb")).alias("weight")))


def feasible_baskets(leading: DataFrame, inventory: DataFrame) -> DataFrame:
    """Baskets whose every member a user owns (relational division).

    `inventory` has uid, entity; ownership is made distinct by the count over distinct members.
    """
    members = leading.select(F.col("no"), F.size("items").alias("_need"), F.explode("items").alias("entity"))
    owned = inventory.select("uid", "entity").distinct()
    return (owned.join(members, "entity")
            .groupBy("uid", "no").agg(F.count("*").alias("_have"), F.max("_need").alias("_need"))
            .filter(F.col("_have") == F.col("_need")).select("uid", "no"))


def feasible_pairs(pairs: DataFrame, feasible: DataFrame) -> DataFrame:
    """Disjoint pairs a user can field: both baskets must be feasible for that user.

    `feasible` is the result of `feasible_baskets`. A user's baskets come together as a list, no longer than the
    leading baskets, and meet the partners of each; the pairs themselves are never moved.
    """
    able = (feasible.filter(F.col("uid").isNotNull()).groupBy("uid").agg(F.collect_set("no").alias("_able")))
    partners = pairs.groupBy("a").agg(F.collect_set("b").alias("_partners"))
    return (able.select("uid", "_able", F.explode("_able").alias("a")).join(F.broadcast(partners), "a")
            .select("uid", "a", F.explode(F.array_intersect("_able", "_partners")).alias("b")))


def member_key(members: Column) -> Column:
    """Join key for baskets that are equal as sets."""
    return F.array_join(sorted_set(members), "\u0001")


def blend_baskets(base: DataFrame, other: DataFrame, w_base: float = 79, w_other: float = 2) -> DataFrame:
    """Weighted merge of two basket tables whose members match as sets.

    Both have basket, members, use_rate, has_rate; `other` also `ord`, and its first match wins.
    Baskets of `other` whose name is not in `base` are appended as they are.
    """
    from .reconcile import weighted
    firsts = (other.groupBy(member_key(F.col("members")).alias("_k"))
              .agg(F.min_by(F.struct("use_rate", "has_rate"), "ord").alias("_o")))
    merged = (base.withColumn("_k", member_key(F.col("members"))).join(firsts, "_k", "left")
              .select("basket", *[
                  F.when(F.col("_o").isNull(), F.col(c))
                  .otherwise(weighted(F.col(c), F.col(f"_o.{c}"), w_base, w_other)).alias(c)
                  for c in ("use_rate", "has_rate")]))
    extra = other.join(base.select("basket").distinct(), "basket", "left_anti").select("basket", "use_rate", "has_rate")
    return merged.unionByName(extra)
