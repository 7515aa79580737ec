"""Traffic-source code and the predicates the attribution models use."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values (they must equal the source system's for the same results):
# codes that are not "significant" for the last-significant-click model, the
# LIKE pattern of a direct-ad click (``_`` is a one-character wildcard) and
# the code of a direct-ad visit without a banner click.
INSIGNIFICANT_CODES = ("0", "-1", "4", "5", "6")
DIRECT_CLICK_PATTERN = "3_1_%"
DIRECT_CODE = "3_1"


def _s(c) -> Column:
    return (F.col(c) if isinstance(c, str) else c).cast("string")


def source_code(tsid="TraficSourceID", search="SearchEngineID", adv="AdvEngineID",
                social="SocialSourceNetworkID", banner="ClickBannerID",
                target="ClickTargetType", recsys="RecommendationSystemID",
                messenger="MessengerID") -> Column:
    """Text key ``<TraficSourceID>[_<detail>[_<detail>]]``; first matching rule wins.

    2 -> 2_<search engine>; 3 with engine 1 and a banner click -> 3_1_<click target>;
    3 -> 3_<ad engine>; 8 -> 8_<social network>; 9 -> 9_<recommender>;
    10 -> 10_<messenger>; anything else -> the id alone.
    """
    col = lambda c: F.col(c) if isinstance(c, str) else c
    t = col(tsid)
    us = F.lit("_")
    suffix = (
        F.when(t == 2, F.concat(us, _s(search)))
        .when((t == 3) & (col(adv) == 1) & (col(banner) != 0),
              F.concat(us, _s(adv), us, _s(target)))
        .when(t == 3, F.concat(us, _s(adv)))
        .when(t == 8, F.concat(us, _s(social)))
        .when(t == 9, F.concat(us, _s(recsys)))
        .when(t == 10, F.concat(us, _s(messenger)))
        .otherwise(F.lit(""))
    )
    return F.concat(_s(t), suffix)


def is_significant(code="SourceCode") -> Column:
    c = F.col(code) if isinstance(code, str) else code
    return ~c.isin(*INSIGNIFICANT_CODES)


def is_direct_click(code="SourceCode", exact_prefix: bool = False) -> Column:
    """``code LIKE '3_1_%'``; the wildcard also matches ``3_12``, ``3_17`` (kept on purpose).

    ``exact_prefix=True`` matches the literal prefix ``3_1_`` instead.
    """
    c = F.col(code) if isinstance(code, str) else code
    if exact_prefix:
        return c.startswith("3_1_")
    return c.like(DIRECT_CLICK_PATTERN)


def is_direct(code="SourceCode") -> Column:
    c = F.col(code) if isinstance(code, str) else code
    return c == DIRECT_CODE
