"""Column expressions (all built-in Spark functions, no UDFs)."""

from touchline.functions.formats import percent_text, thousands_text
from touchline.functions.goals import conversions_expr, revenue_expr
from touchline.functions.source_code import (
    INSIGNIFICANT_CODES, is_direct, is_direct_click, is_significant, source_code,
)
from touchline.functions.time import epoch_seconds, ntz_from_seconds

__all__ = [
    "INSIGNIFICANT_CODES", "conversions_expr", "epoch_seconds", "is_direct",
    "is_direct_click", "is_significant", "ntz_from_seconds", "percent_text",
    "revenue_expr", "source_code", "thousands_text",
]
