"""Display formats of the report tables, as Spark string expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def thousands_text(c, decimals: int = 0) -> Column:
    """``1234567`` -> ``1,234,567``; with decimals=2 trailing zeros after the first are dropped
    (``12,345.50`` -> ``12,345.5``, ``7.00`` -> ``7.0``), as Python prints such floats."""
    c = F.col(c) if isinstance(c, str) else c
    s = F.format_number(c.cast("double"), decimals)
    if decimals == 2:
        s = F.regexp_replace(s, r"(\.\d)0$", "$1")
    return s


def percent_text(c, decimals: int = 2) -> Column:
    """Share 0.12345 -> ``12.35%`` (``12.3%`` with one decimal): the share times 100, rounded on its exact
    binary value, ties to even, as Python's ``%`` format does.

    With y the share times 100 and k the odd half-unit above it, the sign of y * 2 * scale - k decides;
    the product is split so that it is exact (26 leading bits of y and the rest).
    """
    c = F.col(c) if isinstance(c, str) else c
    scale = 10 ** decimals
    y = F.abs(c.cast("double")) * 100.0
    low = F.floor(y * float(scale)).cast("long")
    big = y * 134217729.0          # 2**27 + 1
    high = big - (big - y)
    over = (high * float(2 * scale) - (2 * low + 1).cast("double")) + (y - high) * float(2 * scale)
    units = low + F.when((over > 0) | ((over == 0) & (low % 2 == 1)), 1).otherwise(0)
    sign = F.when(c < 0, F.lit("-")).otherwise(F.lit(""))
    digits = (F.concat(F.lit("."), F.lpad((units % scale).cast("string"), decimals, "0")) if decimals
              else F.lit(""))
    return F.concat(sign, F.floor(units / scale).cast("string"), digits, F.lit("%"))
