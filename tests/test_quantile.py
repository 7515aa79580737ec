"""The two-pass exact quantile equals numpy's linear-interpolation percentile."""

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from touchline.operators.gaps import exact_quantile


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(gaps=st.lists(st.one_of(st.integers(0, 20000), st.sampled_from([4095, 4096, 8191, 8192, 12288])),
                     min_size=1, max_size=60),
       p=st.sampled_from([0.0, 0.05, 0.5, 0.95, 0.99, 1.0]))
def test_matches_numpy(spark, gaps, p):
    values, counts = np.unique(np.array(gaps), return_counts=True)
    hist = spark.createDataFrame([(int(v), int(c)) for v, c in zip(values, counts)], "gap long, n long")
    assert exact_quantile(hist, p) == pytest.approx(float(np.percentile(gaps, p * 100)), rel=1e-12, abs=1e-9)


def test_empty_histogram(spark):
    assert exact_quantile(spark.createDataFrame([], "gap long, n long"), 0.95) is None
