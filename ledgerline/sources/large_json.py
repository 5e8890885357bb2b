"""One large JSON document read by many tasks.

A file is cut at closing braces by Spark's own text splits, so no task reads it whole. A split does not know whether it begins inside a
string or in which containers; each one tells what it does to them: whether its quotes change the state, how many open containers
it closes and which it opens. These summaries are small and are combined from the first split on, which gives every split its
start. Then the splits parse the items of the wanted list where they begin, and an item across splits is put together from its parts.
"""
from __future__ import annotations

import re
import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from ..functions import alternate_fields
from .readers import USAGE_FIELDS
from .sinks import stage

# Functions of tasks travel with their code, so executors need no copy of this module.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

TOKEN = re.compile(rb'"(?:[^"\\]++|\\.)*+"?|[{}\[\],:]|[^\s"{}\[\],:]++', re.DOTALL)
IN_STRING = re.compile(rb'(?:[^"\\]++|\\.)*+"', re.DOTALL)
ESCAPED = re.compile(rb"\\.", re.DOTALL)
DEEPEST = 1000      # containers within each other; deeper documents are refused

# A container as text: its kind, and for one under a key of an object that key. The stack of a place is a list of these.


def quotes(content: bytes) -> int:
    """Quotes that begin or end a string. A split begins behind a brace, so never within an escape."""
    return ESCAPED.sub(b"", content).count(b'"')


def walk(content: bytes, within: bool, stack: list[str]) -> Iterator[tuple[str, int, int, list[str], str | None]]:
    """Events of a split: (`open`, `close`, `comma`, `value`, `string` (a name, or a text of a list), `more` or `cut`, start, end, stack around it, key), with the stack kept up to date.

    `within` says that the split begins inside a string, of which `more` is the rest or what there is of it; `cut` is a name that goes on in
    the next split (such names are not known). Closing what is not open is ignored: the last brace of a file is counted twice.
    """
    at, key, text = 0, None, None
    if within:
        m = IN_STRING.match(content)
        at = m.end() if m else len(content)
        yield "more", 0, at, stack, None
    for m in TOKEN.finditer(content, at):
        first = content[m.start()]
        if first in b"{[":
            if len(stack) >= DEEPEST:
                raise ValueError("containers lie too deep")
            yield "open", m.start(), m.end(), stack, key
            stack.append(chr(first) + (key or ""))
            key = text = None
        elif first in b"}]":
            if stack:
                stack.pop()
                yield "close", m.start(), m.end(), stack, None
            key = text = None
        elif first == 58:       # a colon
            key, text = text, None
        elif first == 44:       # a comma
            yield "comma", m.start(), m.end(), stack, None
            key = text = None
        else:
            if first == 34 and key is None and (m.end() - m.start() < 2 or content[m.end() - 1] != 34):
                yield "cut", m.start(), m.end(), stack, None
            if key is None and first == 34:
                yield "string", m.start(), m.end(), stack, None
            else:
                yield "value", m.start(), m.end(), stack, key
            text = content[m.start() + 1:m.end() - 1].decode("utf-8", "replace") if first == 34 else None


class _Open(list):
    """A stack that starts unknown: what is closed beyond its own goes on `closed`."""
    closed = 0

    def __bool__(self) -> bool:
        return True

    def pop(self, *_):
        if len(self):
            return super().pop()
        self.closed += 1
        return ""


def summarize(content: bytes, within: bool) -> tuple[int, list[str]]:
    """How many containers of before a split closes, and those that it leaves open."""
    stack = _Open()
    for _ in walk(content, within, stack):
        pass
    return stack.closed, list(stack)


def after(stack: list[str], closed: int, opened: list[str]) -> list[str]:
    return stack[:max(0, len(stack) - closed)] + opened


def list_depth(stack: list[str], name: str) -> int:
    """Depth of the list whose items may lie here: 2 in the list under `name` of the root object, 3 in a list in it, else 0."""
    if len(stack) < 2 or stack[0] != "{" or stack[1] != f"[{name}":
        return 0
    return 3 if len(stack) > 2 and stack[2] == "[" else 2


def parts_of(content: bytes, within: bool, stack: list[str], name: str) -> Iterator[tuple[str, int, int, bytes, str | None]]:
    """What a split has of items and fields of the root: (kind, depth of the list, commas of the outer list so far, text, key).

    Kinds: `item` (whole; `[]` stands for any list and `0` for any plain value, which have no fields), `head`, `middle` and `tail` (parts of one across splits), `field` (a plain value of the root; without a key
    what is none) and `more` (the rest of one that a split has cut), `commas` (those of the outer list in this split).
    """
    stack, commas = list(stack), 0
    depth = list_depth(stack, name)
    inside = depth if depth and len(stack) > depth and stack[depth].startswith("{") else 0
    begin, whole = 0, False
    for kind, start, end, now, key in walk(content, within, stack):
        if kind == "open" and not inside:
            here = list_depth(now, name)
            if here and len(now) == here:
                if content[start] == 123:
                    inside, begin, whole = here, start, True
                else:
                    yield "item", here, commas, b"[]", None
        elif kind in ("value", "string") and not inside and list_depth(now, name) == len(now):
            yield "item", len(now), commas, b"0", None
        elif kind == "close" and inside and len(now) == inside:
            yield "item" if whole else "tail", inside, commas, content[begin:end], None
            inside = 0
        elif kind == "comma" and len(now) == 2 and list_depth(now, name) == 2:
            commas += 1
        elif kind == "value" and len(now) == 1 and now[0] == "{" and key is not None:
            yield "field", 0, 0, content[start:end], key
        elif kind in ("cut", "more") and len(now) == 1 and now[0] == "{":
            yield "field" if kind == "cut" else "more", 0, 0, content[start:end], None
    if inside:
        yield "head" if whole else "middle", inside, commas, content[begin:], None
    yield "commas", 0, commas, b"", None


def read_splits(spark: SparkSession, path: str, split_bytes: int) -> DataFrame:
    """`file`, `block` (where a split begins), `content`: the files in splits of about `split_bytes`, written once."""
    setting = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(setting)
    spark.conf.set(setting, str(split_bytes))
    try:
        pieces = spark.read.option("lineSep", "}").text(path).select(
            F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("at"), F.col("value").cast("binary").alias("piece"))

        def join(table: pa.Table) -> pa.Table:
            order = sorted(zip(table.column("at").to_pylist(), range(table.num_rows)))
            column = table.column("piece")
            content = b"".join(column[i].as_py() + b"}" for _, i in order)
            return pa.table({"file": table.column("file").slice(0, 1), "block": table.column("block").slice(0, 1), "content": pa.array([content], pa.binary())})

        return stage(spark, pieces.groupBy("file", "block").applyInArrow(join, "file string, block long, content binary"), "splits")
    finally:
        spark.conf.set(setting, before)


def _with(rows: DataFrame, fn, fields: str) -> DataFrame:
    """`file`, `block` and what `fn` makes of (content, the other columns) for each split; each result is one row."""
    names = [f.split()[0] for f in fields.split(", ")]
    others = [c for c in rows.columns if c not in ("file", "block", "content")]
    kinds = {"int": pa.int32(), "long": pa.int64(), "string": pa.string(), "boolean": pa.bool_(), "array<string>": pa.list_(pa.string())}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                made = list(fn(batch.column("content")[i].as_py(), *[batch.column(c)[i].as_py() for c in others]))
                columns = list(zip(*made)) if made else [()] * len(names)
                arrays = [pa.array([batch.column(c)[i].as_py()] * len(made), k) for c, k in (("file", pa.string()), ("block", pa.int64()))]
                yield pa.RecordBatch.from_arrays(arrays + [pa.array(c, kinds[f.split()[1]]) for c, f in zip(columns, fields.split(", "))], ["file", "block", *names])

    return rows.mapInArrow(run, f"file string, block long, {fields}")


def _starts(summaries: DataFrame) -> DataFrame:
    """The stack before each split, from `closed` and `opened` of those before it: a scan over the few numbers of a file's splits."""
    def scan(table: pa.Table) -> pa.Table:
        stack: list[str] = []
        stacks, order = [], sorted(zip(table.column("block").to_pylist(), range(table.num_rows)))
        closed, opened = table.column("closed").to_pylist(), table.column("opened").to_pylist()
        for _, i in order:
            stacks.append(stack)
            stack = after(stack, closed[i], opened[i])
        return pa.table({"file": table.column("file"), "block": pa.array([b for b, _ in order], pa.int64()), "stack": pa.array(stacks, pa.list_(pa.string()))})

    return summaries.groupBy("file").applyInArrow(scan, "file string, block long, stack array<string>")


def scan_large_list(spark: SparkSession, path: str, name: str = "result", split_bytes: int = 8 << 20) -> tuple[DataFrame, DataFrame]:
    """Items and heads of large documents, each an object with a list under `name`.

    Items: `file`, `item` (the text of an object; `[]` or `0` for what is none). They come from the list that is the second element of the list under `name` if there
    is one, else from that list itself if it begins with an object. Heads: `file`, `head`, an object of the plain values of the root.
    Strings may hold anything, braces, brackets, quotes and escapes too. No part of a document but a single item is ever whole in one task.
    """
    splits = read_splits(spark, path, split_bytes)
    place = Window.partitionBy("file").orderBy("block")
    before = place.rowsBetween(Window.unboundedPreceding, -1)
    counted = _with(splits, lambda content: [(quotes(content),)], "n long")
    within = stage(spark, counted.select("file", "block", (F.coalesce(F.sum("n").over(before), F.lit(0)) % 2 == 1).alias("within")), "within")
    known = splits.join(within, ["file", "block"])
    summaries = _with(known, lambda content, w: [summarize(content, w)], "closed int, opened array<string>")
    starts = stage(spark, _starts(summaries), "stacks")
    parts = stage(spark, _with(known.join(starts, ["file", "block"]), lambda content, w, stack: [
        (n, kind, depth, commas, text.decode("utf-8", "replace"), key) for n, (kind, depth, commas, text, key) in enumerate(parts_of(content, w, stack, name))],
        "n int, kind string, depth int, commas int, text string, key string"), "parts")

    so_far = (parts.filter("kind = 'commas'").select("file", "block", F.coalesce(F.sum("commas").over(before), F.lit(0)).alias("earlier")))
    placed = parts.filter("depth > 0").join(so_far, ["file", "block"]).withColumn("element", F.col("commas") + F.col("earlier"))
    # Parts of one item: as many heads as there are up to here. There are two parts a split at most.
    cuts = placed.filter("kind <> 'item'").withColumn("no", F.sum((F.col("kind") == "head").cast("int")).over(
        Window.partitionBy("file").orderBy("block", "n").rowsBetween(Window.unboundedPreceding, 0)))
    joined = cuts.groupBy("file", "depth", "no").agg(
        F.min("element").alias("element"), F.min("block").alias("block"), F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("block", "n", "text"))),
                                                                                      lambda p: p["text"]), "").alias("text"))
    items = (placed.filter("kind = 'item'").select("file", "depth", "element", "text")
             .unionByName(joined.select("file", "depth", "element", "text")))
    inner = items.filter("depth = 3 AND element = 1").select("file", F.col("text").alias("item"))
    # Without a list as second element the outer one counts, if it begins with an object.
    outer = items.filter("depth = 2").select("file", "element", F.col("text").alias("item"))
    second = outer.filter("element = 1 AND item = '[]'").select("file").distinct()
    begins = outer.filter("element = 0 AND item LIKE '{%'").select("file").distinct()
    outer = outer.join(second, "file", "left_anti").join(begins, "file", "left_semi")
    fields = (parts.filter("kind IN ('field', 'more')").withColumn("no", F.sum((F.col("kind") == "field").cast("int")).over(
        Window.partitionBy("file").orderBy("block", "n").rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy("file", "no").agg(F.max("key").alias("key"), F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("block", "n", "text"))),
                                                                                       lambda p: p["text"]), "").alias("text")).filter("key IS NOT NULL"))
    named = F.to_json(F.array("key"))       # ["key"]
    heads = fields.groupBy("file").agg(F.concat(F.lit("{"), F.array_join(F.collect_list(
        F.concat(F.substr(named, F.lit(2), F.length(named) - 2), F.lit(":"), F.col("text"))), ","), F.lit("}")).alias("head"))
    return inner.unionByName(outer.select("file", "item")), heads


def scan_large_documents(spark: SparkSession, path: str, label: Column | None = None, fields=USAGE_FIELDS, name: str = "result",
                         split_bytes: int = 8 << 20) -> DataFrame:
    """What `readers.scan_documents` gives, for documents of any size; of one that breaks off, the items before that. `label` is made of the root's plain values (`doc`)."""
    items, heads = scan_large_list(spark, path, name, split_bytes)
    period = label if label is not None else F.coalesce(F.try_variant_get("doc", "$.title", "string"), F.lit(""))
    named = heads.select("file", F.try_parse_json("head").alias("doc")).select("file", period.alias("period"))
    rows = items.select("file", F.try_parse_json("item").alias("v")).join(named, "file", "left")
    return rows.select(F.coalesce("period", F.lit("")).alias("period"), *[alternate_fields(F.col("v"), paths, kind, default).alias(n)
                                                                         for n, paths, kind, default in fields])
