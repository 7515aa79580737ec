"""Randomised: blocked path == plain path on arbitrary small histories."""

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from touchline.operators.touches import TOUCH_TYPES, touches
from tests.helpers import CODES, visits_df

CODE_LIST = sorted(CODES)

history = st.lists(
    st.tuples(st.integers(1, 3),                        # user
              st.integers(0, 400),                      # second
              st.sampled_from(CODE_LIST),
              st.integers(0, 2),                        # conversions
              st.integers(0, 300)),                     # duration
    min_size=1, max_size=40)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=history, gap=st.sampled_from([1.0, 15.5, 60.0, 1000.0]), block_rows=st.integers(1, 6))
def test_random_histories(spark, rows, gap, block_rows):
    visits = [(i + 1, t, code, conv, float(conv) * 1.25, dur, user)
              for i, (user, t, code, conv, dur) in enumerate(rows)]
    v = visits_df(spark, visits)
    cols = ["VisitID"] + list(TOUCH_TYPES)
    plain = {r["VisitID"]: r.asDict() for r in touches(v, gap, hot_user_rows=None).select(*cols).collect()}
    blocked = {r["VisitID"]: r.asDict()
               for r in touches(v, gap, hot_user_rows=0, block_rows=block_rows).select(*cols).collect()}
    assert plain.keys() == blocked.keys()
    for k, row in plain.items():
        for c, val in row.items():
            if isinstance(val, float):
                assert blocked[k][c] == pytest.approx(val, rel=1e-9, abs=1e-12), (k, c)
            else:
                assert blocked[k][c] == val, (k, c, val, blocked[k][c])
