"""Time as LONG epoch seconds; wall-clock TIMESTAMP_NTZ for display.

``unix_timestamp`` on a TIMESTAMP_NTZ value reads it as UTC wall-clock and
``timestampadd`` on an NTZ epoch keeps it zone-free, so nothing here depends
on ``spark.sql.session.timeZone``.
"""

from pyspark.sql import Column
from pyspark.sql import functions as F

_EPOCH_SQL = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def epoch_seconds(c) -> Column:
    """Whole seconds since 1970-01-01 of a TIMESTAMP_NTZ column (sub-seconds dropped)."""
    c = F.col(c) if isinstance(c, str) else c
    return F.unix_timestamp(c)


def ntz_from_seconds(c) -> Column:
    """TIMESTAMP_NTZ from LONG epoch seconds."""
    c = F.col(c) if isinstance(c, str) else c
    return F.timestamp_add("SECOND", c, F.expr(_EPOCH_SQL))


def epoch_ntz() -> Column:
    """The type default of a DateTime: 1970-01-01 00:00:00."""
    return F.expr(_EPOCH_SQL)
