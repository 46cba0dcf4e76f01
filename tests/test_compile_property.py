"""Property test of the compile's date buckets and periods."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from hirebook.operators import statements as ST

DAY0 = dt.date(2020, 1, 1)
offsets = st.lists(st.integers(0, 60), min_size=2, max_size=5, unique=True)


def setup(ends_off, bf_off):
    ends = [DAY0 + dt.timedelta(days=o) for o in sorted(ends_off)]
    bf = DAY0 + dt.timedelta(days=bf_off)
    return ends, bf, ST.CompilePlan.build(bf, ends)


def bucket_of(plan, d):
    b = plan.boundaries
    if d <= b[0]:
        return None
    return next((j for j in range(1, len(b)) if d <= b[j]), None)


@settings(max_examples=200, deadline=None)
@given(ends_off=offsets, bf_off=st.integers(0, 60), d_off=st.integers(-5, 70))
def test_a_date_counts_in_the_half_open_periods(ends_off, bf_off, d_off):
    ends, bf, plan = setup(ends_off, bf_off)
    d = DAY0 + dt.timedelta(days=d_off)
    j = bucket_of(plan, d)
    fp = plan.period_of(j, "FP") if j else None
    flow = plan.period_of(j, "PL") if j else None
    for i, e in enumerate(ends):                     # balance at e: (bf, e], a running sum
        assert (fp is not None and fp <= i) == (bf < d <= e)
    for i, (s, e) in enumerate(zip(ends, ends[1:]), start=1):  # flows: (s, e]
        assert (flow == i) == (s < d <= e)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(ends_off=offsets, bf_off=st.integers(0, 60))
def test_spark_bucket_column_matches(spark, ends_off, bf_off):
    ends, bf, plan = setup(ends_off, bf_off)
    days = [DAY0 + dt.timedelta(days=k) for k in range(-3, 66)]
    df = spark.createDataFrame([(d,) for d in days], "d date").select("d", plan.bucket(F.col("d")).alias("b"))
    got = {r["d"]: r["b"] for r in df.collect()}
    assert got == {d: bucket_of(plan, d) for d in days}
