"""Column expressions: no Python code runs per row."""

from claimloom.functions.codes import diagnosis_chapter, make_diagnosis_code
from claimloom.functions.expressions import (
    average_over,
    calendar_attributes,
    day_shift,
    days_between,
    differs,
    hash_uniform,
    pick,
    rate,
    safe_divide,
    same,
)

__all__ = [
    "average_over", "calendar_attributes", "day_shift", "days_between", "diagnosis_chapter", "differs",
    "hash_uniform", "make_diagnosis_code", "pick", "rate", "safe_divide", "same",
]
