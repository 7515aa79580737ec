"""Build small visit tables by hand (schema.VISITS)."""

from __future__ import annotations

import datetime as dt

from touchline.schema import VISITS

BASE = dt.datetime(2024, 1, 10, 0, 0, 0)

# source code -> (TraficSourceID, SearchEngineID, AdvEngineID, ClickBannerID, ClickTargetType)
CODES = {
    "2_2": (2, 2, 0, 0, 0),
    "3_1_2": (3, 0, 1, 5, 2),
    "3_1": (3, 0, 1, 0, 0),
    "3_12": (3, 0, 12, 0, 0),
    "0": (0, 0, 0, 0, 0),
    "1": (1, 0, 0, 0, 0),
    "4": (4, 0, 0, 0, 0),
    "5": (5, 0, 0, 0, 0),
    "7": (7, 0, 0, 0, 0),
}


def visit_row(visit_id, t, code, conv=0, rev=0.0, duration=0, user=1, counter=1, local_offset=0):
    tsid, se, adv, banner, target = CODES[code]
    utc = BASE + dt.timedelta(seconds=t)
    local = BASE + dt.timedelta(seconds=t + local_offset)
    return (counter, user, visit_id, utc.date(), utc, local, duration, tsid, se, adv, 0, banner, target,
            0, 0, conv, float(rev))


def visits_df(spark, rows):
    return spark.createDataFrame([visit_row(*r) if isinstance(r, tuple) else visit_row(**r) for r in rows],
                                 VISITS)


def by_code(df, key="SourceCode"):
    return {r[key]: r.asDict() for r in df.collect()}
