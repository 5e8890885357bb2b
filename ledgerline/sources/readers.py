"""Scans."""
from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from ..functions import alternate_fields, round_half_up
from ..functions.lenient import CORRUPT, is_object, parse_checked


def scan_csv(spark: SparkSession, path: str, schema: str | T.StructType) -> DataFrame:
    """CSV with a header; columns are matched by position, whatever the header calls them."""
    return (spark.read.schema(schema).option("header", True).option("encoding", "UTF-8")
            .option("enforceSchema", True).csv(path))


def scan_table(spark: SparkSession, path: str | None = None, format: str = "parquet", **options) -> DataFrame:
    """Relational table: a table path, or `format="jdbc"` with url, dbtable and, for a parallel
    read, partitionColumn, lowerBound, upperBound and numPartitions."""
    reader = spark.read.format(format).options(**options)
    return reader.load(path) if path else reader.load()


def scan_jsonl(spark: SparkSession, path: str, schema: str | T.StructType, bad: str = "route") -> DataFrame:
    """JSON lines. A bad line never fails the job: "skip" drops it, "route" keeps it with
    `is_bad` and `raw`, "count" keeps only rows per `is_bad`."""
    return handle_bad_lines(spark.read.text(path), schema, bad)


def handle_bad_lines(lines: DataFrame, schema: str | T.StructType, bad: str = "route") -> DataFrame:
    parsed = (lines.filter(F.trim("value") != "")
              .select(F.when(is_object(F.col("value")), parse_checked(F.col("value"), schema)).alias("_j"), F.col("value").alias("raw"))
              .withColumn("is_bad", F.col("_j").isNull() | F.col(f"_j.{CORRUPT}").isNotNull()))
    if bad == "count":
        return parsed.groupBy("is_bad").agg(F.count("*").alias("n"))
    # A bad line keeps no values, also not those that could be read.
    out = parsed.withColumn("_j", F.when(~F.col("is_bad"), F.col("_j"))).select("_j.*", "is_bad", "raw").drop(CORRUPT)
    return out.filter(~F.col("is_bad")).drop("is_bad", "raw") if bad == "skip" else out


def split_text(lines: DataFrame, n_min: int, names: Sequence[str], sep: str = ",", key: str | None = None,
               col: str = "value") -> DataFrame:
    """Headerless delimited text: trailing empty fields count, short lines and empty keys go away.

    A line of the form key<TAB>value is read as its value part.
    """
    body = F.when(F.col(col).contains("\t"), F.substring_index(col, "\t", -1)).otherwise(F.col(col))
    fields = F.split(body, F.lit(sep), F.lit(-1))
    out = lines.filter(F.size(fields) >= n_min).select(
        *[F.trim(F.get(fields, i)).alias(n) for i, n in enumerate(names)])
    return out.filter(F.col(key) != "") if key else out


def scan_text_documents(spark: SparkSession, path: str) -> DataFrame:
    """Whole files: file name and body."""
    return spark.read.text(path, wholetext=True).select(
        F.col("_metadata.file_name").alias("file"), F.col("value").alias("body"))


def pick_list(doc: Column, path: str = "$.result") -> Column:
    """The nested row list: the second element when it is a list, else the list itself when it
    starts with an object, else empty."""
    second = F.try_variant_get(doc, f"{path}[1]", "array<variant>")
    first_kind = F.schema_of_variant(F.try_variant_get(doc, f"{path}[0]", "variant"))
    whole = F.when(first_kind.startswith("OBJECT"), F.try_variant_get(doc, path, "array<variant>"))
    return F.coalesce(second, whole)


# Fixed field names of the statistics documents: target, paths in order of preference, type, default.
USAGE_FIELDS = (
    ("entity", ("$.name",), "string", ""),
    ("star", ("$.star",), "int", 0),
    ("use_count", ("$.use", "$.use_count"), "bigint", 0),
    ("own_count", ("$.own", "$.own_count"), "bigint", 0),
    ("use_rate", ("$.use_rate",), "double", 0.0),
    ("own_rate", ("$.own_rate",), "double", 0.0),
    ("tier", ("$.rank_class", "$.tier", "$.rank"), "string", ""),
)


def read_documents(docs: DataFrame, label: Column | None = None, fields=USAGE_FIELDS,
                   list_path: str = "$.result", body: str = "body") -> DataFrame:
    """Statistics documents to rows, with defaults for absent fields."""
    parsed = docs.select(F.try_parse_json(body).alias("doc"))
    period = label if label is not None else F.coalesce(
        F.try_variant_get("doc", "$.title", "string"), F.lit(""))
    rows = parsed.select(period.alias("period"), F.explode(pick_list(F.col("doc"), list_path)).alias("v"))
    return rows.select("period", *[alternate_fields(F.col("v"), paths, kind, default).alias(name)
                                   for name, paths, kind, default in fields])


def scan_documents(spark: SparkSession, path: str, label: Column | None = None, fields=USAGE_FIELDS,
                   list_path: str = "$.result") -> DataFrame:
    return read_documents(scan_text_documents(spark, path), label, fields, list_path)


def pair_documents(left: DataFrame, right: DataFrame, period: str | Column,
                   left_suffix: str = "_box.json", right_suffix: str = "_record.json") -> DataFrame:
    """Join two document sets by the user id in their file names, one versioned line per left file.

    Both have file, body. A missing right document becomes a JSON null.
    """
    def side(df: DataFrame, suffix: str, name: str) -> DataFrame:
        uid = F.regexp_extract("file", "^(.*)" + suffix.replace(".", r"\.") + "$", 1)
        return df.select(uid.alias("uid"), F.try_parse_json("body").alias(name)).filter(F.col("uid") != "")

    label = F.lit(period) if isinstance(period, str) else period
    return (side(left, left_suffix, "box").join(side(right, right_suffix, "record"), "uid", "left")
            .select("uid", label.alias("version"), "box", "record"))


def scan_pairs(spark: SparkSession, path: str, period: str | Column | None = None, left_suffix: str = "_box.json",
               right_suffix: str = "_record.json") -> DataFrame:
    """Pair the files under `path`, at any depth, by their folder and the user id in their names; columns of `pair_documents`.

    The version is the name of the folder that holds the files, unless `period` gives one. Files of both kinds come from one
    listing and one scan, in which small files share tasks, and meet in one shuffle. Files with other names, right files
    without a left one and empty files are left out; a file that is no JSON is a null.
    """
    glob = "*{" + ",".join((left_suffix, right_suffix)) + "}"
    files = spark.read.option("recursiveFileLookup", True).option("pathGlobFilter", glob).text(path, wholetext=True)
    # Paths come encoded, with a plus sign left as it is.
    place = F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B")))
    named = files.select(place.alias("place"), F.col("value").alias("body")).select(
        F.regexp_extract("place", "^(.*)/[^/]*$", 1).alias("folder"), F.substring_index("place", "/", -1).alias("file"), "body")
    sides = [F.col("file").endswith(s) for s in (left_suffix, right_suffix)]
    lengths = F.when(sides[0], len(left_suffix)).otherwise(len(right_suffix))
    uid = F.col("file").substr(F.lit(1), F.length("file") - lengths)
    paired = (named.select("folder", uid.alias("uid"), *[F.when(s, F.col("body")).alias(n) for s, n in zip(sides, ("box", "record"))])
              .where("uid <> ''").groupBy("folder", "uid").agg(F.max("box").alias("box"), F.max("record").alias("record")))
    label = F.substring_index("folder", "/", -1) if period is None else F.lit(period) if isinstance(period, str) else period
    return paired.where("box is not null").select(
        "uid", label.alias("version"), F.try_parse_json("box").alias("box"), F.try_parse_json("record").alias("record"))


def to_lines(paired: DataFrame) -> DataFrame:
    """Records as JSON lines; null fields are written out."""
    return paired.select(F.to_json(F.struct(*paired.columns), {"ignoreNullFields": "false"}).alias("value"))


HISTORY_SCHEMA = (
    "t string, s bigint, "
    "chars array<struct<n:string, st:int, uc:bigint, oc:bigint, `or`:double, co:double>>, "
    "teams array<struct<m:array<struct<n:string>>, ur:double, hr:double>>")


def history_entities(docs: DataFrame) -> DataFrame:
    """Nested history to entity rows; the rate over the samples, owners default to the samples."""
    rows = docs.select("t", "s", F.explode("chars").alias("c"))
    zero = F.lit(0).cast("bigint")
    used = F.coalesce("c.uc", zero)
    rate = F.when(F.coalesce("s", zero) > 0, round_half_up(
        F.try_divide(used.cast("double"), F.col("s").cast("double")) * 100, 2)).otherwise(F.lit(0.0))
    return rows.select(
        F.col("t").alias("period"), F.col("c.n").alias("entity"), F.col("c.st").alias("star"),
        F.coalesce("c.oc", "s").alias("own_count"), used.alias("use_count"), F.col("s").alias("users"),
        rate.alias("use_rate"), round_half_up(F.coalesce("c.or", F.lit(0.0)), 2).alias("own_rate"),
        round_half_up(F.coalesce("c.co", F.lit(0.0)), 1).alias("avg_constellation"))


def history_baskets(docs: DataFrame, top: int = 50) -> DataFrame:
    """The first `top` baskets of each history document, in document order."""
    return (docs.select(F.col("t").alias("period"), F.posexplode(F.slice("teams", 1, top)).alias("i", "b"))
            .select("period", (F.col("i") + 1).alias("pos"), F.array_join("b.m.n", " + ").alias("basket"),
                    round_half_up(F.coalesce("b.ur", F.lit(0.0)), 1).alias("use_rate"),
                    round_half_up(F.coalesce("b.hr", F.lit(0.0)), 1).alias("has_rate")))


def prefix_label(name: Column, labels: Mapping[str, str]) -> Column:
    """Label of a file by its name prefix; null for an unknown prefix."""
    out = F.lit(None).cast("string")
    for prefix, label in reversed(list(labels.items())):
        out = F.when(name.startswith(prefix), F.lit(label)).otherwise(out)
    return out
