"""Column expressions shared by the operators (built-ins only, no UDFs)."""
from .arrays import argmax_struct, distinct_names, sorted_set
from .labels import normalize_label, shorten_label
from .lenient import alternate_fields, lenient_int
from .numbers import (bubble_size, clamp, exact_avg, exact_sum, hash_unit, percent,
                      quadrant_label, round_half_up)

__all__ = [
    "alternate_fields", "argmax_struct", "bubble_size", "clamp", "distinct_names", "exact_avg",
    "exact_sum", "hash_unit", "lenient_int", "normalize_label", "percent",
    "quadrant_label", "round_half_up", "shorten_label", "sorted_set",
]
