"""Reading loosely typed JSON values."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, functions as F, types as T


def lenient_int(text: Column, default: int) -> Column:
    """Integer from number or numeric text, fraction cut off; the default otherwise."""
    number = text.try_cast("double")
    whole = F.when(number < 0, F.ceil(number)).otherwise(F.floor(number))
    return F.coalesce(text.try_cast("int"), whole.try_cast("int"), F.lit(default))


def alternate_fields(doc: Column, paths: Sequence[str], kind: str, default) -> Column:
    """First path that yields a value of the wanted type, else the default."""
    return F.coalesce(*[F.try_variant_get(doc, p, kind) for p in paths], F.lit(default).cast(kind))


CORRUPT = "_corrupt"


def is_object(text: Column) -> Column:
    """Texts that can be a JSON object at all."""
    return F.ltrim(text).startswith("{")


def parse_checked(text: Column, schema: str | T.StructType) -> Column:
    """JSON by a schema, parsed once, with the text in `_corrupt` if it is malformed or a value has another type."""
    fields = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    return F.from_json(text, T.StructType([*fields.fields, T.StructField(CORRUPT, T.StringType())]),
                       {"columnNameOfCorruptRecord": CORRUPT})
