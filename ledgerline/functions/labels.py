"""Period label normalisation."""
from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, functions as F


def normalize_label(label: Column, markers: Sequence[str], prefix: str = "v") -> Column:
    """Strip the first marker phrase the label contains and add the prefix; else leave it as is."""
    out = label
    for marker in reversed(markers):
        out = F.when(label.contains(marker),
                     F.concat(F.lit(prefix), F.replace(label, F.lit(marker), F.lit("")))).otherwise(out)
    return out


def shorten_label(label: Column, remove: str, short: Mapping[str, str]) -> Column:
    """Drop a phrase and swap long suffixes for short ones."""
    out = F.replace(label, F.lit(remove), F.lit(""))
    for long_form, short_form in short.items():
        out = F.replace(out, F.lit(long_form), F.lit(short_form))
    return out
