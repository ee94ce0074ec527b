"""Property: split LAG / running aggregates equal the single-window forms on
random data (hot keys, NULL keys and times, ties, any bucket width)."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from fraudmart.operators.lag import lag_columns, running_columns

BASE = dt.datetime(2021, 3, 1)
row = st.tuples(
    st.one_of(st.none(), st.sampled_from(["hot", "hot", "hot", "a", "b"])),
    st.one_of(st.none(), st.integers(min_value=0, max_value=4000)),   # seconds after BASE
    st.integers(min_value=-5, max_value=5),
)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=st.lists(row, min_size=1, max_size=60), bucket=st.sampled_from([1, 7, 60, 600, 86400]))
def test_split_forms_match_plain(spark, rows, bucket):
    data = [(card, None if s is None else BASE + dt.timedelta(seconds=s), i, float(v))
            for i, (card, s, v) in enumerate(rows)]
    df = spark.createDataFrame(data, "card string, ts timestamp_ntz, id long, v double")
    order = ["ts", "id"]
    lags = {"l1": ("v", 1), "l2": ("id", 2), "l3": ("ts", 3)}
    aggs = {"n": ("sum", F.lit(1)), "hi": ("max", F.col("v")), "lo": ("min", F.col("v"))}
    cols = ["id", "l1", "l2", "l3"]
    assert (sorted(map(tuple, lag_columns(df, ["card"], order, lags, None).select(*cols).collect()))
            == sorted(map(tuple, lag_columns(df, ["card"], order, lags, bucket, hot_rows=0).select(*cols).collect())))
    rcols = ["id", "n", "hi", "lo"]
    assert (sorted(map(tuple, running_columns(df, ["card"], order, aggs, None).select(*rcols).collect()))
            == sorted(map(tuple, running_columns(df, ["card"], order, aggs, bucket, hot_rows=0).select(*rcols).collect())))
